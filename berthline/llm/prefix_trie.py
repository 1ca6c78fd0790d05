"""Prefix trie of conversations, rolled up by centroid decomposition.

Conversations are rebuilt first: conversation ``c`` becomes the first ``h`` original turns of
conversation ``c - c % 20`` (all if fewer, none if absent), then its own turns after its first
``h``, with ``h = crc32(decimal c) % 4``. Every distinct sequence of first ``d`` turns (role, text)
is a node of depth ``d``; the root has depth 0. Conversations that start with it are its members.

Nodes. A turn is a 127-bit digest of role and text; a sequence is the polynomial of its turns
modulo ``2^127 - 1``, which can be continued from any prefix. So turns are sorted once over all
conversations (by id, turn, digest), each partition runs over its rows, and the state at
a partition's start is filled in from the partitions before. A rebuilt sequence follows from the states at
its seams, without another sort. A conversation of any length spans partitions.

Rollup. The parent edges form a tree of nodes. :func:`roll_up` adds each node's values up its
ancestors by centroid decomposition: in a component of ``k`` nodes, those with at least ``k / 2``
nodes below them are one path from its top, whose lowest node is the centroid. The totals of the
centroid's side are added to the whole path; then the centroid leaves and splits the component
into its children's sides and the rest. The recursion halves components, so a chain as long as
the table takes a logarithm of rounds. Components of more than ``LOCAL`` nodes are split by joins
and aggregates over all of them at once; smaller ones are decomposed to the end within
tasks. The number of nodes below each node, which finds the first centroids, is a count over the
members: a member other than the smallest owns its whole unshared end below the node.

Conversation digests: the ids that end at a node are range-sorted over all nodes, joined into
pieces of ``PIECE`` ids, and a task that digests a node reads its pieces one after the other.
SHA-256 is sequential, so a node's ids pass one task as text, but are never held there together.

Odd input: null roles and texts are empty; rows without ``conv_id`` are left out; null turns come
first; equal turn numbers are ordered by digest; repeated rows are turns of their own; an empty
table has no nodes; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices
from .words import Words

PRIME = (1 << 127) - 1
BASE = 0x3B1F8A6D52C94E07A1D5E3769F0B2C48 % PRIME
INVERSE = pow(BASE, -1, PRIME)
GROUP = 20      # conversations that share the head of their first
HEADS = 4       # head lengths are below this
LOCAL = 4096    # nodes of a component that one task decomposes
PIECE = 4096    # ids joined into one text before digesting
ROOT = (0).to_bytes(16, "big")


def _pack(x: int) -> bytes:
    return x.to_bytes(16, "big")


def _number(b: bytes) -> int:
    return int.from_bytes(b, "big")


def turn_digest(role: str, text: str) -> int:
    r, t = role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")
    h = hashlib.blake2b(len(r).to_bytes(8, "big") + r + t, digest_size=16).digest()
    return 1 + _number(h) % (PRIME - 1)


def _turns(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and number of words of every turn: texts go no further."""
    for b in slices(source):
        roles = [r or "" for r in b.column("role").to_pylist()]
        texts = [t or "" for t in b.column("text").to_pylist()]
        words = np.diff(Words([t.encode("utf-8", "surrogatepass") for t in texts]).first)
        digest = pa.array([_pack(turn_digest(r, t)) for r, t in zip(roles, texts)], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turn"), digest, pa.array(words.astype(np.int64))],
                                         names=["conv_id", "turn", "digest", "words"])


_LOCAL_SCHEMA = "conv_id bigint, digest binary, words bigint, at bigint, state binary, part int, head boolean"


def _states(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within a sorted partition: place and state of every row in its conversation, from 0 where the
    conversation or the partition starts (``head``: the partition's first conversation)."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    conv, at, state, head, first = None, 0, 0, True, True
    for b in source:
        out = []
        for c, d in zip(b.column("conv_id").to_pylist(), b.column("digest").to_pylist()):
            if c != conv:
                conv, at, state, head, first = c, 0, 0, first, False
            at += 1
            state = (state * BASE + _number(d)) % PRIME
            out.append((at, _pack(state), head))
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), b.column("digest"), b.column("words"), pa.array([o[0] for o in out], pa.int64()),
             pa.array([o[1] for o in out], pa.binary()), pa.array([part] * len(out), pa.int32()),
             pa.array([o[2] for o in out], pa.bool_())],
            names=["conv_id", "digest", "words", "at", "state", "part", "head"])


def _ordered(convs: DataFrame) -> DataFrame:
    """``conv_id, at`` (from 1 in each conversation), ``digest``, ``words``, ``state`` (of the prefix ending here)."""
    spark = convs.sparkSession
    turns = convs.select(convs["conv_id"].cast("bigint").alias("conv_id"), convs["turn"].cast("bigint").alias("turn"),
                         convs["role"].cast("string").alias("role"), convs["text"].cast("string").alias("text"))
    turns = turns.where("conv_id is not null").mapInArrow(_turns, "conv_id bigint, turn bigint, digest binary, words bigint")
    turns = materialize(turns, "turns")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # equal rows are interchangeable; their number lets a range boundary fall between them
    turns = turns.withColumn("tie", F.monotonically_increasing_id())
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("tie")]
    local = turns.repartitionByRange(n, *keys).sortWithinPartitions(*keys).mapInArrow(_states, _LOCAL_SCHEMA)
    local = materialize(local, "states")
    ends = local.groupBy("part").agg(F.max_by(F.struct("conv_id", "at", "state", "head"), F.struct("conv_id", "at")).alias("e"))
    rows = sorted((r["part"], r["e"]) for r in ends.collect())  # one short row per partition
    before, conv, at, state = [], None, 0, 0
    for part, e in rows:
        # conversation, places and state that reach into this partition
        before.append((part, conv, at, _pack(state)))
        if e["head"] and e["conv_id"] == conv:
            at, state = at + e["at"], (state * pow(BASE, e["at"], PRIME) + _number(e["state"])) % PRIME
        else:
            conv, at, state = e["conv_id"], e["at"], _number(e["state"])
    carried = {part: (c, a, _number(s)) for part, c, a, s in before if c is not None}
    return local.mapInArrow(_carry(carried), "conv_id bigint, at bigint, digest binary, words bigint, state binary")


def _carry(carried: dict[int, tuple[int, int, int]]):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in source:
            convs, at, states = (b.column(c).to_pylist() for c in ("conv_id", "at", "state"))
            for k, (part, head) in enumerate(zip(b.column("part").to_pylist(), b.column("head").to_pylist())):
                if head and part in carried and carried[part][0] == convs[k]:
                    _, places, state = carried[part]
                    states[k] = _pack((state * pow(BASE, at[k], PRIME) + _number(states[k])) % PRIME)
                    at[k] += places
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), pa.array(at, pa.int64()), b.column("digest"), b.column("words"), pa.array(states, pa.binary())],
                names=["conv_id", "at", "digest", "words", "state"])
    return run


def head_turns(conv_id: Column) -> Column:
    """Turns that a conversation takes from the first of its group of ``GROUP``."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def _rebuilt_rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own turns after the head: depth, node, its parent."""
    for b in source:
        convs, at, digests, words, states = (b.column(c).to_pylist() for c in ("conv_id", "at", "digest", "words", "state"))
        skip, shared, own, base, n = (b.column(c).to_pylist() for c in ("skip", "shared", "own_state", "base_state", "n"))
        out = []
        for k, c in enumerate(convs):
            state = _number(states[k])
            if skip[k] or shared[k]:
                seam = (_number(base[k] or ROOT) - _number(own[k] or ROOT)) * pow(BASE, at[k] - skip[k], PRIME)
                state = (state + seam) % PRIME
            parent = (state - _number(digests[k])) * INVERSE % PRIME
            out.append((c, at[k] - skip[k] + shared[k], _pack(state), _pack(parent), words[k], at[k] == n[k]))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)],
                                         names=["conv_id", "depth", "node", "parent", "words", "ends"])


_ROWS = "conv_id bigint, depth bigint, node binary, parent binary, words bigint, ends boolean"


def rebuilt(convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of all rebuilt conversations (one per turn, with node and parent), and one row per
    conversation: ``conv_id, length``."""
    turns = materialize(_ordered(convs), "ordered")
    early = [F.max(F.when(F.col("at") == k, F.struct("state", "words"))).alias(f"t{k}") for k in range(1, HEADS)]
    each = materialize(turns.groupBy("conv_id").agg(F.max("at").alias("n"), *early), "conversations")
    own_h = head_turns(F.col("c.conv_id"))
    is_base = F.col("c.conv_id") % GROUP == 0
    found = each.alias("c").join(each.alias("b"), F.col("b.conv_id") == F.col("c.conv_id") - F.col("c.conv_id") % GROUP, "left")
    skip = F.when(is_base, 0).otherwise(F.least(own_h, F.col("c.n")))
    shared = F.when(is_base, 0).otherwise(F.least(own_h, F.coalesce("b.n", F.lit(0))))
    pick = [F.col(f"c.t{k}") for k in range(1, HEADS)], [F.col(f"b.t{k}") for k in range(1, HEADS)]
    found = found.select(F.col("c.conv_id").alias("conv_id"), F.col("c.n").alias("n"), skip.cast("bigint").alias("skip"),
                         shared.cast("bigint").alias("shared"), F.array(*pick[0]).alias("own"), F.array(*pick[1]).alias("base"))
    state = lambda turns, k: F.when(F.col(k) > 0, F.element_at(turns, F.col(k).cast("int"))["state"])
    found = found.select("*", state(F.col("own"), "skip").alias("own_state"), state(F.col("base"), "shared").alias("base_state"))
    found = materialize(found, "seams")
    own_rows = (turns.join(found.drop("own", "base"), "conv_id").where("at > skip")
                .select("conv_id", "at", "digest", "words", "state", "skip", "shared", "own_state", "base_state", "n")
                .mapInArrow(_rebuilt_rows, _ROWS))
    heads = (found.where("shared > 0").select("*", F.posexplode(F.slice("base", F.lit(1), F.col("shared").cast("int"))))
             .select("conv_id", (F.col("pos") + 1).cast("bigint").alias("depth"), F.col("col.state").alias("node"),
                     F.when(F.col("pos") == 0, F.lit(ROOT)).otherwise(F.element_at("base", F.greatest(F.col("pos"), F.lit(1)))["state"])
                     .alias("parent"), F.col("col.words").alias("words"),
                     ((F.col("pos") + 1 == F.col("shared")) & (F.col("n") <= F.col("skip"))).alias("ends")))
    rows = materialize(own_rows.unionByName(heads), "rebuilt")
    return rows, found.select("conv_id", (F.col("n") - F.col("skip") + F.col("shared")).alias("length"))


def _join_ids(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of up to PIECE sorted ids of one node as comma-joined texts."""
    def pieces():
        rows = ((n, c) for b in source for n, c in zip(b.column("node").to_pylist(), b.column("conv_id").to_pylist()))
        for node, group in groupby(rows, key=lambda r: r[0]):
            ids: list[int] = []
            for _, c in group:
                ids.append(c)
                if len(ids) == PIECE:
                    yield node, ids[0], ",".join(map(str, ids))
                    ids = []
            if ids:
                yield node, ids[0], ",".join(map(str, ids))

    yield from _batched(pieces(), (pa.binary(), pa.int64(), pa.string()), ["node", "low", "ids"], 64)


def _batched(rows, kinds, names: list[str], size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], t) for i, t in enumerate(kinds)], names=names)
            held = []
    yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], t) for i, t in enumerate(kinds)], names=names)


def _digest_pieces(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def digests():
        rows = ((n, t) for b in source for n, t in zip(b.column("node").to_pylist(), b.column("ids").to_pylist()))
        for node, group in groupby(rows, key=lambda r: r[0]):
            h = hashlib.sha256()
            for k, (_, t) in enumerate(group):
                h.update(("," * (k > 0) + t).encode())
            yield node, h.hexdigest()

    yield from _batched(digests(), (pa.binary(), pa.string()), ["node", "ends_sha256"])


def _end_digests(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of the ids that end at each node, in ascending order."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = (ends.repartitionByRange(n, "node", "conv_id").sortWithinPartitions("node", "conv_id")
              .mapInArrow(_join_ids, "node binary, low bigint, ids string"))
    return (pieces.repartition(n, "node").sortWithinPartitions("node", "low")
            .mapInArrow(_digest_pieces, "node binary, ends_sha256 string"))


def _decompose(rows: list[list]) -> None:
    """All rounds within one component of ``[node, parent, depth, leaves, saved, n_leaves, saved_tokens]``
    sorted by depth; adds to the last two."""
    place = {r[0]: k for k, r in enumerate(rows)}
    up = [place.get(r[1], -1) for r in rows]
    up[0] = -1
    todo = [list(range(len(rows)))]
    size = [0] * len(rows)
    side = [0] * len(rows)  # component number, unique while it is worked on
    names = 0
    while todo:
        part = todo.pop()
        if len(part) == 1:
            r = rows[part[0]]
            r[5], r[6] = r[5] + r[3], r[6] + r[4]
            continue
        names += 1
        for k in part:
            size[k], side[k] = 1, names
        for k in reversed(part):
            if up[k] >= 0 and side[up[k]] == names and k != part[0]:
                size[up[k]] += size[k]
        path = [k for k in part if 2 * size[k] >= len(part)]
        z = path[-1]
        # the centroid's side: its children's sides each become a component
        below: dict[int, list[int]] = {}
        rest: list[int] = []
        of: dict[int, int] = {}
        leaves, saved = rows[z][3], rows[z][4]
        for k in part:
            if k == z:
                continue
            u = up[k] if k != part[0] else -1
            c = k if u == z else of.get(u, -1)
            if c < 0:
                rest.append(k)
            else:
                of[k] = c
                below.setdefault(c, []).append(k)
                leaves, saved = leaves + rows[k][3], saved + rows[k][4]
        for k in path:
            rows[k][5], rows[k][6] = rows[k][5] + leaves, rows[k][6] + saved
        todo += list(below.values())
        if rest:
            todo.append(rest)


def _small_components(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components in rows sorted by top and depth, one after the other."""
    def done():
        names = ("top", "node", "parent", "depth", "leaves", "saved", "n_leaves", "saved_tokens")
        rows = (r for b in source for r in zip(*[b.column(c).to_pylist() for c in names]))
        for _, group in groupby(rows, key=lambda r: r[0]):
            part = [list(r[1:]) for r in group]
            _decompose(part)
            yield from ((r[0], r[5], r[6]) for r in part)

    yield from _batched(done(), (pa.binary(), pa.int64(), pa.int64()), ["node", "n_leaves", "saved_tokens"])


def roll_up(forest: DataFrame, paths: DataFrame, local: int = LOCAL) -> DataFrame:
    """``node, n_leaves, saved_tokens``: sums of ``leaves`` and ``saved`` below each node, itself included.

    ``forest`` has ``node, parent, owner, depth, size`` (nodes below, itself included), ``leaves,
    saved``; ``paths(conv_id, depth, node, parent)`` has the nodes of each owner's path. Each
    round splits every component of more than ``local`` nodes; sizes are halved, so
    there are as many rounds as the logarithm of nodes / local.
    """
    n = int(forest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = forest.agg(F.count(F.lit(1)).alias("total"), F.min(F.when(F.col("depth") == 0, F.col("node"))).alias("top"))
    total, top = whole.first()
    state = forest.select("node", "parent", "owner", "depth", F.lit(top).cast("binary").alias("top"), F.lit(total).cast("bigint").alias("total"),
                          "size", "leaves", "saved", F.lit(0).cast("bigint").alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"))
    over, small = [], []  # values of centroids; components for the tasks
    while True:
        small.append(state.where(F.col("total") <= local))
        state = state.where(F.col("total") > local)
        if not state.take(1):
            break
        # the centroid of each large component: the lowest node of the path of at least half
        z = (state.where(2 * F.col("size") >= F.col("total")).groupBy("top")
             .agg(F.min(F.struct("size", "node", "depth")).alias("z"))
             .select("top", F.col("z.node").alias("z"), F.col("z.size").alias("z_size"), F.col("z.depth").alias("z_depth")))
        seen = state.join(z, "top")
        # a node is on the centroid's side if its owner's path passes the centroid; then through which child
        step = paths.select(F.col("conv_id").alias("owner"), F.col("depth").alias("next"), F.col("node").alias("child"),
                            F.col("parent").alias("child_of"))
        seen = seen.withColumn("next", F.when(F.col("depth") > F.col("z_depth"), F.col("z_depth") + 1))
        seen = seen.join(step, ["owner", "next"], "left")
        below = F.coalesce(F.col("child_of") == F.col("z"), F.lit(False))
        is_z = F.col("node") == F.col("z")
        on_path = (2 * F.col("size") >= F.col("total"))
        seen = materialize(seen.select("node", "parent", "owner", "depth", "top", "total", "size", "leaves", "saved", "n_leaves",
                                       "saved_tokens", is_z.alias("is_z"), on_path.alias("on_path"), "z_size",
                                       F.when(below, F.col("child")).otherwise(F.col("top")).alias("new_top"),
                                       (below | is_z).alias("inside")), "split")
        sums = seen.where("inside").groupBy("top").agg(F.sum("leaves").alias("add_leaves"), F.sum("saved").alias("add_saved"))
        sizes = seen.where("node = new_top and not is_z and inside").select(F.col("node").alias("new_top"), F.col("size").alias("side"))
        nxt = seen.join(sums, "top").join(sizes, "new_top", "left")
        add = lambda c, s: F.col(c) + F.when(F.col("on_path"), F.col(s)).otherwise(0)
        nxt = nxt.select("node", "parent", "owner", "depth", F.col("new_top").alias("top"),
                         F.coalesce("side", F.col("total") - F.col("z_size")).alias("total"),
                         (F.col("size") - F.when(F.col("on_path"), F.col("z_size")).otherwise(0)).alias("size"), "leaves", "saved",
                         add("n_leaves", "add_leaves").alias("n_leaves"), add("saved_tokens", "add_saved").alias("saved_tokens"), "is_z")
        nxt = materialize(nxt, "round")
        over.append(nxt.where("is_z").select("node", "n_leaves", "saved_tokens"))
        state = nxt.where("not is_z").drop("is_z")
    rest = reduce(DataFrame.unionByName, small)
    rest = (rest.repartition(n, "top").sortWithinPartitions("top", "depth")
            .mapInArrow(_small_components, "node binary, n_leaves bigint, saved_tokens bigint"))
    return reduce(DataFrame.unionByName, over, rest)


def trie(convs: DataFrame, local: int = LOCAL) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``, and ``node, parent`` as 16-byte states. See the module."""
    rows, each = rebuilt(convs)
    counted = rows.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                       F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("words").alias("words"))
    root = (each.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
            .select(F.lit(ROOT).alias("node"), "conv_id", "n_convs", F.lit(0).cast("bigint").alias("depth"),
                    F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("words")))
    nodes = materialize(counted.unionByName(root), "nodes")
    kids = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    # nodes below: a member that is not the smallest owns its unshared end, the smallest what is left of its path
    owned = nodes.groupBy("conv_id").agg(F.count(F.when(F.col("depth") > 0, 1)).alias("owned"))
    spread = rows.select("conv_id", "node").unionByName(each.select("conv_id", F.lit(ROOT).alias("node")))
    spread = (spread.join(owned.where("owned > 0"), "conv_id").groupBy("node").agg(F.sum("owned").alias("all_owned")))
    smallest = owned.join(each, "conv_id").select("conv_id", "owned", "length")
    forest = (nodes.join(spread, "node", "left").join(smallest, "conv_id").join(kids, "node", "left")
              .select("node", "parent", F.col("conv_id").alias("owner"), "depth", "n_convs",
                      F.coalesce("n_children", F.lit(0)).alias("n_children"),
                      (F.coalesce("all_owned", F.lit(0)) - F.col("owned") + F.col("length") - F.col("depth") + 1).alias("size"),
                      F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("leaves"),
                      ((F.col("n_convs") - 1) * F.col("words")).alias("saved")))
    forest = materialize(forest, "forest")
    if not forest.take(1):
        return _empty(forest)
    sums = roll_up(forest.select("node", "parent", "owner", "depth", "size", "leaves", "saved"),
                   rows.select("conv_id", "depth", "node", "parent"), local)
    ends = rows.where("ends").select("node", "conv_id").unionByName(each.where("length = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    up = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = forest.join(sums, "node").join(_end_digests(ends), "node", "left").join(up, "parent", "left")
    return out.select(F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"), "node", "parent")


def _empty(forest: DataFrame) -> DataFrame:
    number = F.lit(0).cast("bigint")
    return forest.select(F.col("owner").alias("conv_id"), "depth", number.alias("parent_conv_id"), "n_convs", "n_children",
                         number.alias("n_leaves"), number.alias("saved_tokens"), F.lit("").alias("ends_sha256"), "node", "parent")
