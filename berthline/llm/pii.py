"""Personal data by weak supervision.

Candidates come from the four base patterns, which always hold, and from looser patterns that
only propose. Labelers vote on every candidate: strict form, gazetteer, words before it that
speak for or against it, its borders and its digits. Expectation-maximisation estimates, per kind,
how reliable each labeler is from the agreement of the votes on proposals. Base matches (right) and
proposals whose checksum or number rules fail (wrong) are known, and anchor the estimate. The posteriors train the
final span classifier (logistic regression on votes, kind and shape), which scores every
proposal by its weights, also one whose votes the fit has not seen. Accepted proposals are added to the
base spans; one with a failed checksum never is.

Votes and shapes are discrete, so both models are fitted on counts of equal patterns over all
documents: one aggregation, whose result is bounded by the number of patterns. Only the *shares* of
the patterns of a kind count, as if every kind had ``EVIDENCE`` proposals, so that verdicts do not drift with
the size of the corpus. Texts are read twice, for the counts and for the spans; nothing is written in between.

Defined results: null texts are empty; spans are code points, end exclusive; an added span
never overlaps a base span or an earlier added one; rows may repeat or have no id; an empty
table gives an empty table.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

KINDS = ("email", "ip", "card", "phone", "iban", "name", "secret", "ssn")
LABELERS = ("form", "gazetteer", "cue", "counter", "border", "digits")
#: Expected chances of a vote against, none and for, of each labeler on a wrong and on a right proposal:
#: a failed form or a word against speaks loudest, a missing cue says little, borders and digits least.
EXPECTED = {"form": ((0.60, 0.30, 0.10), (0.10, 0.30, 0.60)), "gazetteer": ((0.40, 0.50, 0.10), (0.10, 0.40, 0.50)),
            "cue": ((0.05, 0.80, 0.15), (0.05, 0.45, 0.50)), "counter": ((0.50, 0.45, 0.05), (0.05, 0.90, 0.05)),
            "border": ((0.40, 0.20, 0.40), (0.10, 0.30, 0.60)), "digits": ((0.35, 0.30, 0.35), (0.10, 0.35, 0.55))}
CHECKED = ("card", "iban", "ssn")  # kinds whose form is a checksum or a rule: a failed one is wrong
ACCEPT = 0.5
EVIDENCE = 200    # proposals that a kind's shares stand for
ANCHORS = 50      # base matches, and failed checksums, that their shares stand for
PRIOR = 10        # proposals that a labeler's expected reliability stands for

Span = tuple[int, int]

# --------------------------------------------------------------------------- base patterns

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> list[Span]:
    """Matches of the e-mail pattern, found from each @ outwards (linear in the text)."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if all(_at_most_255(p) for p in m.group().split("."))]


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            d = _digits(m.group())
            if 16 <= len(d) <= 19 and luhn(d):
                out.append(m.span())
    return out


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]


def base_spans(text: str) -> dict[str, list[Span]]:
    """The base spans of each of the first four kinds."""
    number = _DIGIT.search(text) is not None
    return {"email": emails(text) if "@" in text else [], "ip": ips(text) if number else [],
            "card": cards(text) if number else [], "phone": phones(text) if number and "+" in text else []}


# --------------------------------------------------------------------------- proposals and votes

_PROPOSE = {  # in this order, the more specific first: later ones do not overlap earlier ones
    "iban": re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64}+ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}+"
                        r"(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]{1,63}+|\.[A-Za-z0-9-]{1,63}+)+", re.I),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "phone": re.compile(r"(?<![0-9+.-])(?:\([0-9]{2,4}\)|0[0-9]{2,4}|[0-9]{3})[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9-])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,4}(?![0-9])"),
    "name": re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra?)\b\.? [A-ZÀ-Þ][\w'-]+(?: [A-ZÀ-Þ][\w'-]+)?"),
    "secret": re.compile(r"\b(?:api[_ -]?key|access[_ -]?key|token|secret|password|passwd)\b ?[=:] ?[\"']?"
                         r"[A-Za-z0-9_+/-]{8,}", re.I),
}
_NEEDS_DIGIT = {"phone", "card", "iban", "ssn"}
_HINT = {"email": re.compile(r"[\[(] ?at ?[\])]", re.I), "secret": re.compile("[=:]")}

# Words that speak for a kind when they stand before a candidate, words that
# speak against personal data, and gazetteers of common endings, prefixes and names.
CUES = {
    "email": "mail email e-mail contact write reach courriel correo",
    "ip": "ip host server address login from client",
    "card": "card visa mastercard amex credit debit payment karte tarjeta carte",
    "phone": "call phone tel telephone mobile cell fax whatsapp telefon telefono appelez",
    "iban": "iban account konto cuenta compte bank",
    "name": "name contact from dear by signed",
    "secret": "export set config env authorization bearer",
    "ssn": "ssn social security",
}
COUNTER = "version v section chapter page figure table isbn issn doi order item part invoice no nr id ref build release"
TOP_DOMAINS = (
    "com org net edu gov mil int info biz name pro mobi travel jobs tel cat asia post xyz online site shop club top app dev "
    "blog cloud store tech live news space world email agency company group media network solutions systems today zone io ai "
    "co me tv cc ws fm ly gg sh ac ad ae af ag al am ao ar as at au aw az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bw by bz "
    "ca cd cf cg ch ci ck cl cm cn cr cu cv cy cz de dj dk dm do dz ec ee eg es et eu fi fj fr ga gd ge gh gi gl gm gn gr gt gy "
    "hk hn hr ht hu id ie il in iq ir is it jm jo jp ke kg kh kr kw kz la lb li lk lt lu lv ma mc md mg mk ml mn mt mu mx my na ng "
    "ni nl no np nz om pa pe ph pk pl pt py qa ro rs ru sa se sg si sk sn su sv sy th tn tr tw ua ug uk us uy uz ve vn za")
SECRET_STARTS = "ghp_ gho_ ghs_ ghu_ github_pat_ glpat- sk- pk- sk_live_ sk_test_ rk_live_ AKIA ASIA AIza ya29. xoxb- xoxp- xoxa- xapp- SG. npm_ pypi- dop_v1_ shpat_ hf_ eyJ"
FIRST_NAMES = (
    "james mary john patricia robert jennifer michael linda david elizabeth william barbara richard susan joseph jessica thomas "
    "sarah charles karen christopher lisa daniel nancy matthew betty anthony sandra mark ashley donald emily steven kimberly paul "
    "donna andrew michelle joshua laura kenneth amanda kevin melissa brian deborah george stephanie emma olivia sophia lucas "
    "hans karl klaus sabine peter anna maria monika ursula petra stefan andreas wolfgang martin markus julia katharina heike "
    "jens uwe dieter ralf birgit claudia christian matthias frank jan lukas lena lea hannah felix jonas "
    "pierre jean marie claire jacques philippe alain nicolas isabelle nathalie sylvie catherine francois michel louis camille "
    "chloe hugo manon antoine juliette guillaume benoit sophie helene luc "
    "juan jose carlos carmen pedro ana luis sofia antonio manuel francisco javier miguel isabel pilar dolores lucia elena "
    "rafael pablo diego alejandro fernando sergio raquel marta cristina jorge alvaro")
#: Countries of account numbers and their lengths.
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 "
    "GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 MC27 MD24 ME22 "
    "MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 "
    "VA22 VG24 XK20")

_CUES = {k: frozenset(v.split()) for k, v in CUES.items()}
_COUNTER, _TOP, _NAMES = (frozenset(x.split()) for x in (COUNTER, TOP_DOMAINS, FIRST_NAMES))
_STARTS, _LANDS = tuple(SECRET_STARTS.split()), {x[:2]: int(x[2:]) for x in IBAN_LENGTHS.split()}
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
_VALUE = re.compile(r"[=:] ?[\"']?([A-Za-z0-9_+/-]{8,})$")


def _iban_ok(span: str) -> bool:
    s = span.replace(" ", "")
    moved = s[4:] + s[:4]
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def votes(kind: str, text: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """One vote per labeler: 1 for, -1 against, 0 none."""
    span = text[start:end]
    d = _digits(span)
    value = _VALUE.search(span)
    if base:
        form = 1
    elif kind == "iban":
        form = 1 if _iban_ok(span) else -1
    elif kind == "card":
        form = 1 if 13 <= len(d) <= 19 and luhn(d) else -1
    elif kind == "ssn":
        form = -1 if d[:3] in ("000", "666") or d[0] == "9" or d[3:5] == "00" or d[5:] == "0000" else 1
    elif kind == "secret":
        v = value.group(1) if value else ""
        form = 1 if len(v) >= 16 and _DIGIT.search(v) and re.search("[A-Za-z]", v) else -1
    else:
        form = 0
    gazetteer = 0
    if kind == "email":
        gazetteer = 1 if re.split(r"[. \])]+", span.lower())[-1] in _TOP else 0
    elif kind == "iban":
        gazetteer = 1 if _LANDS.get(span[:2]) == len(span.replace(" ", "")) else -1
    elif kind == "secret":
        gazetteer = 1 if value and value.group(1).startswith(_STARTS) else 0
    elif kind == "name":
        gazetteer = 1 if any(w.lower() in _NAMES for w in _WORD.findall(span)) else 0
    near = [w.lower() for w in _WORD.findall(text[max(0, start - 40):start])[-3:]]
    cue = 1 if any(w in _CUES[kind] for w in near) else 0
    counter = -1 if near and near[-1] in _COUNTER else 0
    left, right = text[start - 1:start], text[end:end + 1]
    border = -1 if left.isalnum() or right.isalnum() else 1
    digits = -1 if len(d) >= 7 and len(set(d)) <= 2 else (1 if len(set(d)) >= 5 else 0)
    return form, gazetteer, cue, counter, border, digits


def candidates(text: str, base: dict[str, list[Span]]) -> list[tuple[str, int, int, bool]]:
    """Base spans and proposals ``(kind, start, end, base)``; proposals overlap nothing before them."""
    out = [(k, a, b, True) for k, spans in base.items() for a, b in spans]
    number = _DIGIT.search(text) is not None
    taken: list[Span] = []  # sorted and without overlaps
    for a, b in sorted((a, b) for _, a, b, _ in out):
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    for kind, pattern in _PROPOSE.items():
        if kind in _NEEDS_DIGIT and not number or kind in _HINT and not _HINT[kind].search(text):
            continue
        for m in pattern.finditer(text):
            a, b = m.span()
            at = bisect_left(taken, (a, b))
            if (at == 0 or taken[at - 1][1] <= a) and (at == len(taken) or b <= taken[at][0]):
                out.append((kind, a, b, False))
                taken.insert(at, (a, b))
    return out


def _pattern(kind: str, text: str, start: int, end: int, base: bool) -> str:
    n = end - start
    shape = (n > 10) + (n > 20) + (n > 40)
    share = 4 * len(_DIGIT.findall(text[start:end])) // (n + 1)
    return f"{kind} {int(base)} {' '.join(map(str, votes(kind, text, start, end, base)))} {shape} {share}"


# --------------------------------------------------------------------------- models

def _read(patterns: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kind, base flag, votes (0 against, 1 none, 2 for) and shape numbers of patterns."""
    rows = [p.split() for p in patterns]
    return (np.array([KINDS.index(r[0]) for r in rows], dtype=int), np.array([r[1] == "1" for r in rows], dtype=bool),
            np.array([[int(x) for x in r[2:8]] for r in rows], dtype=int).reshape(-1, len(LABELERS)) + 1,
            np.array([[int(x) for x in r[8:]] for r in rows], dtype=int).reshape(-1, 2))


def _failed(kind: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Patterns whose checksum or number rule fails."""
    return np.isin(kind, [KINDS.index(k) for k in CHECKED]) & (v[:, LABELERS.index("form")] == 0)


def _design(kind: np.ndarray, v: np.ndarray, shape: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones((len(kind), 1)), np.eye(len(KINDS))[kind], v == 2, v == 0, np.eye(4)[shape[:, 0]],
                           np.eye(4)[np.minimum(shape[:, 1], 3)]], axis=1).astype(float)


def _regression(x: np.ndarray, q: np.ndarray, weight: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Weighted logistic regression towards ``q`` with a ridge around ``start``; Newton steps, halved until they help."""
    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((weight * (np.logaddexp(0, z) - q * z)).sum() + 0.5 * ((w - start) ** 2).sum())

    w, now = start, loss(start)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(hess, x.T @ (weight * (p - q)) + (w - start))
        size = 1.0
        while (new := loss(w - size * step)) > now and size > 1e-6:
            size /= 2
        if now - new < 1e-10:
            break
        w, now = w - size * step, new
    return w


class Models:
    """Reliabilities and the span classifier, fitted on ``{pattern: count}``.

    ``tables[kind, wrong or right, labeler]`` has the chances of a vote against, none and for;
    ``reliability`` is their mean over the kinds that occur, by labeler.
    """

    def __init__(self, counts: dict[str, int], rounds: int = 200) -> None:
        patterns = sorted(counts)
        kind, base, v, shape = _read(patterns)
        count = np.array([counts[p] for p in patterns], dtype=float)
        failed = _failed(kind, v) & ~base
        weight = np.zeros(len(patterns))  # shares of a kind's open proposals, base matches and failed ones
        for part, total in ((~base & ~failed, EVIDENCE), (base, ANCHORS), (failed, ANCHORS)):
            for k in range(len(KINDS)):
                own = part & (kind == k)
                if own.any():
                    weight[own] = total * count[own] / count[own].sum()
        known = base | failed
        form = LABELERS.index("form")
        expected = np.array([EXPECTED[n] for n in LABELERS]).transpose(1, 0, 2)  # wrong or right, labeler, vote
        lift = np.log(expected[1] / expected[0])
        first = lift[np.arange(len(LABELERS)), v].sum(axis=1)
        q = np.where(base, 1.0, np.where(failed, 0.0, 1 / (1 + np.exp(-first))))
        self.tables = np.broadcast_to(expected[None], (len(KINDS), *expected.shape)).copy()
        for _ in range(rounds):
            table = PRIOR * np.broadcast_to(expected[None], self.tables.shape).copy()
            for k in range(len(LABELERS)):
                use = ~known if k == form else np.ones(len(q), dtype=bool)  # the form is what makes the anchors known
                np.add.at(table, (kind[use], 1, k, v[use, k]), (weight * q)[use])
                np.add.at(table, (kind[use], 0, k, v[use, k]), (weight * (1 - q))[use])
            self.tables = table / table.sum(axis=3, keepdims=True)
            right, total = np.full(len(KINDS), PRIOR / 2), np.full(len(KINDS), float(PRIOR))
            np.add.at(right, kind[~known], (weight * q)[~known])
            np.add.at(total, kind[~known], weight[~known])
            odds = np.log(right / (total - right))[kind]
            for k in range(len(LABELERS)):
                odds = odds + np.log(self.tables[kind, 1, k, v[:, k]] / self.tables[kind, 0, k, v[:, k]])
            new = np.where(known, q, 1 / (1 + np.exp(-np.clip(odds, -30, 30))))
            done = np.abs(new - q).max(initial=0) < 1e-9
            q = new
            if done:
                break
        seen = np.unique(kind) if len(kind) else np.arange(len(KINDS))
        self.reliability = {name: self.tables[seen][:, :, k].mean(axis=0).tolist() for k, name in enumerate(LABELERS)}
        x = _design(kind, v, shape)
        # votes without evidence in the corpus keep the direction of the expected reliabilities
        start = np.zeros(1 + len(KINDS) + 2 * len(LABELERS) + 8)
        start[1 + len(KINDS):1 + len(KINDS) + len(LABELERS)] = lift[:, 2]
        start[1 + len(KINDS) + len(LABELERS):1 + len(KINDS) + 2 * len(LABELERS)] = lift[:, 0]
        self.weights = _regression(x, q, weight, start)

    def score(self, patterns: list[str]) -> np.ndarray:
        """Probability that a proposal is right; 0 after a failed checksum, 1 for base matches."""
        if not patterns:
            return np.zeros(0)
        kind, base, v, shape = _read(patterns)
        p = 1 / (1 + np.exp(-np.clip(_design(kind, v, shape) @ self.weights, -30, 30)))
        return np.where(base, 1.0, np.where(_failed(kind, v), 0.0, p))

    def accepts(self, pattern: str) -> bool:
        return bool(self.score([pattern])[0] >= ACCEPT)


# --------------------------------------------------------------------------- Spark

def _patterns(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(source):
        count: dict[str, int] = {}
        for t in b.column(0).to_pylist():
            for c in candidates(t, base_spans(t)) if t else ():
                p = _pattern(c[0], t, *c[1:])
                count[p] = count.get(p, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())],
                                         names=["pattern", "n"])


def fit(docs: DataFrame) -> Models:
    """Fit the models on all of ``docs(text)``: one row per distinct pattern reaches the driver."""
    counts = (docs.select("text").mapInArrow(_patterns, "pattern string, n bigint")
              .groupBy("pattern").agg(F.sum("n").alias("n")).collect())
    return Models({r["pattern"]: r["n"] for r in counts})


_MADE = ("n_email", "n_ip", "n_card", "n_phone", "base", "spans", "masked_text")


def find_personal_data(docs: DataFrame, models: Models, keep: list[str] | None = None,
                       mask: bool = False) -> DataFrame:
    """Add ``n_email, n_ip, n_card, n_phone, base, spans`` to ``docs(doc_id, text)``; with
    ``mask`` also ``masked_text``.

    ``base`` and ``spans`` are ``kind:start:end`` joined by commas. ``keep`` names the columns
    carried along (all by default; columns named like the results are replaced).
    """
    made = _MADE if mask else _MADE[:-1]
    names = [c for c in (keep if keep is not None else docs.columns) if c not in made]
    held = docs.sparkSession.sparkContext.broadcast(models)
    types = [pa.int64()] * 4 + [pa.string()] * (len(made) - 4)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}  # as many as there are patterns
        order = {k: n for n, k in enumerate(KINDS)}

        def good(pattern: str) -> bool:
            if pattern not in known:
                known[pattern] = held.value.accepts(pattern)
            return known[pattern]

        for b in slices(source):
            rows = []
            for t in b.column(len(names)).to_pylist():
                t = t or ""
                base = base_spans(t)
                found = sorted((order[c[0]], c[1], c[2]) for c in candidates(t, base)
                               if c[3] or good(_pattern(c[0], t, *c[1:])))
                spans = ",".join(f"{KINDS[k]}:{x}:{y}" for k, x, y in found)
                row = [*(len(base[k]) for k in KINDS[:4]),
                       ",".join(f"{k}:{x}:{y}" for k in KINDS[:4] for x, y in base[k]), spans]
                rows.append(row + [masked(t, spans)] if mask else row)
            cols = list(zip(*rows)) or [()] * len(made)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(len(names))),
                                              *(pa.array(c, t) for c, t in zip(cols, types))], names=[*names, *made])

    schema = docs.select(*names).withColumns({c: F.lit(0).cast("bigint") for c in made[:4]}
                                             | {c: F.lit("") for c in made[4:]}).schema
    return docs.select(*names, F.col("text").alias("__llm_text")).mapInArrow(run, schema)


def masked(text: str, spans: str) -> str:
    """``text`` with every span replaced by its kind in angle brackets."""
    out, at = [], 0
    for kind, a, b in sorted((s.split(":") for s in spans.split(",") if s), key=lambda x: (int(x[1]), -int(x[2]))):
        if int(a) >= at:
            out += [text[at:int(a)], f"<{kind}>"]
        at = max(at, int(b))
    return "".join(out) + text[at:]
