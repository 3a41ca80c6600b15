"""Prefix trie of conversations: which turns many conversations start with.

Method: padded turn-id matrices. Conversations become rows of turn keys (hash of role
and text), range-shards hold neighbouring rows of the order by keys, then conv_id. In
a shard keys become small integers, rows are padded and sorted by ``numpy.lexsort``;
OR-accumulated masks of changed columns against the row above say how many leading
turns a row shares with it, and a node starts wherever they end. ``reduceat`` sums up
every depth. Matrices are built for 16 depths at a time, of rows still tied after the
depths before, so that one very long conversation pads no other.

Range-shard boundary nodes recombine: only nodes on the path of a shard's first or last
row can go on in another shard. Their parts are merged by a hash of the path; what
a shard counted for itself (a text once per shard, a leaf that has children elsewhere)
is corrected along the paths. The order by conv_id within equal rows cuts a large group
of equal conversations over several shards like any other rows.

Defined results: rows without conv_id belong to no conversation; a null turn comes
first, equal turns are ordered by the hash of role and text; null role or text is
empty; repeated rows are turns of their own; a conversation whose rebuilt turns are none is a
member of the root; an empty table has no node, not even a root. Extra columns are
ignored. The turns of one conversation form one row of 20 bytes a turn.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from pricelab.llm import common as C

HEAD_TURNS = 5              # most turns that a conversation takes from the first of its hundred
SHARD_TURNS = 500_000
MIN_SHARDS = 8              # work for small tables is spread, too
BLOCK = 16                  # depths of one padded matrix
CHUNK_IDS = 100_000         # member ids in one row of an open end list
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: for every conversation its turns ``(key, n)`` in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)
    turns = (conversations.where("conv_id is not null")
             .select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), key.alias("key"), F.length(text).alias("n")).alias("t")))
    return (turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
            .select("conv_id", F.transform("t", lambda x: F.struct(x["key"].alias("key"), x["n"].alias("n"))).alias("turns")))


def rebuilt(rows: DataFrame) -> DataFrame:
    """``rows`` with the first ``h = crc32(conv_id) % 6`` turns taken from the conversation that
    begins the hundred, where there is one."""
    h = (F.crc32(F.col("conv_id").cast("string")) % F.lit(6)).cast("int")
    heads = rows.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEAD_TURNS).alias("head"))
    none = F.array().cast("array<struct<key:binary,n:int>>")
    return (rows.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % 100).join(heads, "base", "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                                        F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))).alias("turns")))


# ------------------------------------------------------------------ one shard

def lex_order(ids: np.ndarray, ptr: np.ndarray, conv: np.ndarray):
    """Rows ``ids[ptr[i]:ptr[i + 1]]`` in order (shorter first, equal ones by ``conv``) and, by
    position, how many leading ids a row shares with the one above (-1 for the first)."""
    length = np.diff(ptr)
    order = np.argsort(conv, kind="stable")
    shared = np.zeros(len(order), np.int64)
    tie = np.zeros(len(order), np.int64)
    at, base = np.arange(len(order)), 0
    while len(at):
        rows = order[at]
        width = int(min(BLOCK, max(length[rows].max(initial=0) - base, 0)))
        if not width:
            shared[at[1:]] = np.where(tie[at][1:] == tie[at][:-1], base, shared[at[1:]])
            break
        col = base + np.arange(width)
        inside = col < length[rows][:, None]
        mat = np.where(inside, ids[np.where(inside, ptr[rows][:, None] + col, 0)] + 1, 0)
        mat = np.column_stack([mat, length[rows] > base + width])       # rows that end here come before those that go on
        by = np.lexsort((*mat.T[::-1], tie[at]))
        rows, mat, group = rows[by], mat[by], tie[at]
        order[at] = rows
        changed = np.logical_or.accumulate(mat[1:] != mat[:-1], axis=1)
        same = width + 1 - changed.sum(1)
        inner = group[1:] == group[:-1]
        shared[at[1:][inner]] = np.minimum(base + same, length[rows[1:]])[inner]
        new = np.concatenate([[True], ~inner | (same <= width)])
        number = np.cumsum(new) - 1
        stay = (np.bincount(number)[number] > 1) & (length[rows] > base + width)
        at = at[stay]
        tie[at] = number[stay]
        base += width
    if len(shared):
        shared[0] = -1
    return order, shared


def path_keys(keys: list[bytes]) -> list[bytes]:
    """Key of every prefix of a path, the root's first."""
    out = [hashlib.sha256(b"").digest()[:16]]
    for k in keys:
        out.append(hashlib.sha256(out[-1] + k).digest()[:16])
    return out


_ROWS = ("kind int, shard int, key binary, pkey binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved long, len long, first boolean, last boolean, ends string, blob binary")
_ARROW = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("key", pa.binary()), ("pkey", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
                    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()),
                    ("len", pa.int64()), ("first", pa.bool_()), ("last", pa.bool_()), ("ends", pa.string()), ("blob", pa.binary())])
INNER, EDGE, ENDS = 0, 1, 2


def shard_trie(conv: np.ndarray, keys: pa.Array, lens: np.ndarray, ptr: np.ndarray, shard: int) -> pa.Table:
    """Nodes of one shard's conversations: rows of kind INNER are complete (but for the
    parent's conv_id, where the parent is an edge), EDGE rows are parts on the path of the
    first or last row, ENDS rows list the members that end in an edge node."""
    n = len(conv)
    packed = np.frombuffer(b"".join(keys.to_pylist()), "S16") if len(keys) else np.empty(0, "S16")
    _, ids = np.unique(packed, return_inverse=True)
    order, shared = lex_order(ids.astype(np.int64), ptr, conv)
    member, length, begin = conv[order], np.diff(ptr)[order], ptr[:-1][order]
    deepest = max(int(shared.max()), 0)

    # every depth up to the deepest shared one: nodes start where the shared turns end
    cols: dict[str, list] = {c: [] for c in ("depth", "start", "parent", "n", "conv", "ends", "len")}
    node_of = np.full(n, -1)
    total = 0
    for d in range(deepest + 1):
        alive = np.flatnonzero(length >= d)
        first = np.flatnonzero(shared[alive] < d)
        start = alive[first]
        cols["depth"].append(np.full(len(first), d))
        cols["start"].append(start)
        cols["parent"].append(node_of[start])
        cols["n"].append(np.diff(np.append(first, len(alive))))
        cols["conv"].append(np.minimum.reduceat(member[alive], first))
        cols["ends"].append(np.add.reduceat((length[alive] == d).astype(np.int64), first))
        cols["len"].append(lens[begin[start] + d - 1] if d else np.zeros(len(first), np.int64))
        node_of[alive] = total + np.repeat(np.arange(len(first)), cols["n"][-1])
        total += len(first)
    # deeper nodes have one member each
    tail = np.maximum(length - deepest, 0)
    row = np.repeat(np.arange(n), tail)
    step = np.arange(len(row)) - np.repeat(np.cumsum(tail) - tail, tail)
    depth = deepest + 1 + step
    cols["depth"].append(depth)
    cols["start"].append(row)
    cols["parent"].append(np.where(step == 0, node_of[row], total + np.arange(len(row)) - 1))
    cols["n"].append(np.ones(len(row), np.int64))
    cols["conv"].append(member[row])
    cols["ends"].append((depth == length[row]).astype(np.int64))
    cols["len"].append(lens[begin[row] + depth - 1])
    c = {k: np.concatenate(v).astype(np.int64) for k, v in cols.items()}
    count = len(c["depth"])
    up = c["parent"]
    children = np.bincount(up[up >= 0], minlength=count)
    leaves, saved = (children == 0).astype(np.int64), (c["n"] - 1) * c["len"]
    # a tail has one leaf and saves nothing; shared depths are summed upwards
    leaves[total:] = 1
    heads = total + np.flatnonzero(step == 0)
    np.add.at(leaves, up[heads], 1)
    bounds = np.cumsum([0, *[len(x) for x in cols["depth"][:-1]]])
    for d in range(deepest, 0, -1):
        here = np.arange(bounds[d], bounds[d + 1])
        np.add.at(leaves, up[here], leaves[here])
        np.add.at(saved, up[here], saved[here])

    # the paths of the first and the last row; a node's members are neighbours
    key_of, on_first, on_last = {}, np.zeros(count, bool), np.zeros(count, bool)
    stop = c["start"] + c["n"]
    for pos, mark in ((0, on_first), (n - 1, on_last)):
        mark |= (c["start"] <= pos) & (pos < stop)
        path = np.flatnonzero(mark)
        path = path[np.argsort(c["depth"][path])]
        for node, k in zip(path, path_keys([keys[int(begin[pos]) + i].as_py() for i in range(int(length[pos]))])):
            key_of[int(node)] = k
    edge = on_first | on_last

    ends = np.full(count, NO_ENDS, object)
    blobs = []
    for node in np.flatnonzero(c["ends"]):
        mine = member[c["start"][node]:c["start"][node] + c["ends"][node]]
        if edge[node]:
            blobs += [(key_of[node], int(mine[i]), ",".join(map(str, mine[i:i + CHUNK_IDS].tolist())).encode()) for i in range(0, len(mine), CHUNK_IDS)]
        else:
            ends[node] = hashlib.sha256(",".join(map(str, mine.tolist())).encode()).hexdigest()

    inner_parent = (up >= 0) & ~edge[up]
    parent = pa.array(np.where(inner_parent, c["conv"][up], 0), mask=~inner_parent)
    nodes = pa.table({
        "kind": pa.array(np.where(edge, EDGE, INNER), pa.int32()), "shard": pa.array(np.full(count, shard), pa.int32()),
        "key": pa.array([key_of.get(i) for i in range(count)] if edge.any() else pa.nulls(count), pa.binary()),
        "pkey": pa.array([key_of.get(int(u)) if u >= 0 else None for u in up], pa.binary()),
        "depth": c["depth"], "conv_id": c["conv"], "parent_conv_id": parent, "n_convs": c["n"], "n_children": children, "n_leaves": leaves, "saved": saved,
        "len": c["len"], "first": on_first, "last": on_last, "ends": pa.array(ends.tolist(), pa.string()), "blob": pa.nulls(count, pa.binary())}, schema=_ARROW)
    k = len(blobs)
    lists = pa.table({f.name: pa.nulls(k, f.type) for f in _ARROW}, schema=_ARROW)
    for name, values in (("kind", [ENDS] * k), ("shard", [shard] * k), ("key", [b[0] for b in blobs]), ("conv_id", [b[1] for b in blobs]), ("blob", [b[2] for b in blobs])):
        lists = lists.set_column(_ARROW.get_field_index(name), _ARROW.field(name), pa.array(values, _ARROW.field(name).type))
    return pa.concat_tables([nodes, lists])


def _shard_rows(batches):
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    t = pa.Table.from_batches(parts)
    turns = pa.concat_arrays(t.column("turns").chunks)
    ptr = turns.offsets.to_numpy().astype(np.int64)
    flat = turns.values.slice(int(ptr[0]), int(ptr[-1] - ptr[0]))
    keys, lens = flat.flatten()
    out = shard_trie(t.column("conv_id").to_numpy(), keys, lens.to_numpy().astype(np.int64), ptr - ptr[0], TaskContext.get().partitionId())
    yield from out.combine_chunks().to_batches(max_chunksize=20_000)


def _hash_lists(batches):
    """Streams ``(key, conv_id, blob)``, sorted by both: one digest per key."""
    key, digest = None, None
    for t in batches:
        out = []
        for k, blob in zip(t.column(0).to_pylist(), t.column(2).to_pylist()):
            if k == key:
                digest.update(b",")
            else:
                if key is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            digest.update(blob)
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], ["key", "ends"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()], pa.string())], ["key", "ends"])


# -------------------------------------------------------------------- all shards

def trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, min_shards: int = MIN_SHARDS) -> DataFrame:
    """One row per node: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256)``."""
    spark = conversations.sparkSession
    C.prepare(spark)
    rows = rebuilt(C.written(turn_rows(conversations)))
    shards = max(min_shards, -(-conversations.count() // shard_turns))
    ranged = rows.repartitionByRange(shards, F.transform("turns", lambda x: x["key"]), "conv_id")
    found = C.written(ranged.mapInArrow(_shard_rows, _ROWS))

    parts = found.where(F.col("kind") == EDGE)
    merged = C.cut(parts.groupBy("key").agg(
        F.count(F.lit(1)).alias("k"), F.min("conv_id").alias("conv_id"), F.first("pkey").alias("pkey"), F.max("depth").alias("depth"), F.max("len").alias("len"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"),
        F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("bare")))
    # what a node in k shards was counted too often or too little, for itself and all above it
    split = merged.where("k > 1").select("key", ((F.col("k") - 1) * F.col("len")).alias("more"), (F.when(F.col("bare") == F.col("k"), 1).otherwise(0) - F.col("bare")).alias("leaf"))
    side = F.array_compact(F.array(F.when(F.col("first"), F.col("shard") * 2), F.when(F.col("last"), F.col("shard") * 2 + 1)))
    paths = parts.select("key", "depth", F.explode(side).alias("path")).join(split, "key")
    home = paths.groupBy("key").agg(F.min("path").alias("home"))
    below = Window.partitionBy("path").orderBy(F.col("depth").desc())
    own = lambda c: F.sum(F.when(F.col("path") == F.col("home"), F.col(c)).otherwise(0)).over(below)
    mended = paths.join(home, "key").select("key", own("more").alias("more"), own("leaf").alias("leaf")).groupBy("key").agg(F.sum("more").alias("more"), F.sum("leaf").alias("leaf"))
    twice = merged.where("k > 1 and pkey is not null").groupBy("pkey").agg(F.sum(F.col("k") - 1).alias("twice")).withColumnRenamed("pkey", "key")

    lists = found.where(F.col("kind") == ENDS).select("key", "conv_id", "blob")
    ends = lists.repartition(shards, "key").sortWithinPartitions("key", "conv_id").mapInArrow(_hash_lists, "key binary, ends string")
    name = merged.select("key", F.col("conv_id").alias("name"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    edges = (merged.join(mended, "key", "left").join(twice, "key", "left").join(ends, "key", "left")
             .join(name.withColumnRenamed("key", "pkey"), "pkey", "left")
             .select("conv_id", "depth", F.col("name").alias("parent_conv_id"), "n_convs", (F.col("n_children") - zero("twice")).alias("n_children"),
                     (F.col("n_leaves") + zero("leaf")).alias("n_leaves"), (F.col("saved") + zero("more")).alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256")))
    # parents on an edge, looked up per shard: the root is one row a shard there
    inner = found.where(F.col("kind") == INNER)
    named = parts.select("shard", F.col("key").alias("pkey")).join(name.withColumnRenamed("key", "pkey"), "pkey")
    hung = inner.where("pkey is not null").join(named, ["shard", "pkey"])
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256")]
    return (inner.where("pkey is null").select(*cols)
            .unionByName(hung.withColumn("parent_conv_id", F.col("name")).select(*cols)).unionByName(edges))
