"""The conversation trie against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from berthline.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def _plain(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((t is not None, t or 0, prefix_trie.turn_digest(role, text), role, text))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in turns.items()}
    members = defaultdict(list)
    whole = {}
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(turns.get(c - c % 20, [])[:h] + turns[c][h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    kids = defaultdict(int)
    for k in members:
        if k:
            kids[k[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].split()) if k else 0
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in m if whole[c] == k)
        out.append((m[0], len(k), members[k[:-1]][0] if k else None, len(m), kids[k], leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def _rows(df):
    cols = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def _conversations(rng, n):
    rows = []
    for c in rng.sample(range(4 * n), n):
        like = random.Random(rng.randint(0, 3))  # few different beginnings, many shared paths
        for t in range(rng.choice([1, 2, 3, 5, 9])):
            text = " ".join(like.choices(["a", "b b", "ç"], k=like.randint(0, 3)))
            rows.append((c, t, like.choice(["user", "assistant"]), text if rng.random() < 0.93 else f"own {c}"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("local", [4096, 6])
def test_nodes_and_sums_equal_plain_python(spark, local):
    rows = _conversations(random.Random(3), 160)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert _rows(prefix_trie.trie(df, local)) == _plain(rows)


def test_one_long_conversation_and_many_copies(spark):
    """A third of the rows in one conversation, which spans partitions; a third in equal ones."""
    long = [(41, t, "user", f"turn {t % 7}") for t in range(600)]
    copies = [(c, t, "user", f"turn {t % 7}") for c in range(60, 260) for t in range(3)]
    rows = long + copies + _conversations(random.Random(9), 100)
    rows = [r for k, r in enumerate(rows) if r not in rows[:k]]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert _rows(prefix_trie.trie(df, 50)) == _plain(rows)


def test_odd_rows_and_an_empty_table(spark):
    rows = [(None, 1, "user", "lost"), (1, None, None, None), (1, 1, "user", ""), (1, 1, "user", ""), (1, 1, "tool", "x" * 90_000),
            (2, 5, None, "a  b\tc"), (2, None, "user", "first"), (-21, 1, "user", "negative"), (-20, 1, "user", "base"),
            (20, 0, "user", "y"), (25, 0, "user", "y"), (25, 0, "user", "y"), (26, None, "user", "z")]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in "node parent depth top size state at n skip ends words owner total".split():
        df = df.withColumn(c, F.lit("old"))
    plain = _plain([r for r in rows if r[0] is None or r[0] >= 0])
    assert _rows(prefix_trie.trie(df.where("conv_id is null or conv_id >= 0"), 2)) == plain
    assert len(_rows(prefix_trie.trie(df, 2))) > len(plain)  # negative ids: their group is cut towards zero
    assert _rows(prefix_trie.trie(df.limit(0))) == []


def test_components_are_decomposed_exactly():
    rng = random.Random(1)
    for n, reach in ((1, 1), (2, 1), (300, 1), (300, 4), (400, 400)):
        rows = [[0, None, 0, 1, 5, 0, 0]]
        for k in range(1, n):
            up = rng.randint(max(0, k - reach), k - 1)
            rows.append([k, up, rows[up][2] + 1, rng.randint(0, 1), rng.randint(0, 9), 0, 0])
        expected = [[r[3], r[4]] for r in rows]
        for k in range(n - 1, 0, -1):
            for i in (0, 1):
                expected[rows[k][1]][i] += expected[k][i]
        by_depth = sorted(rows, key=lambda r: r[2])
        prefix_trie._decompose(by_depth)
        assert [r[5:] for r in sorted(by_depth, key=lambda r: r[0])] == expected
