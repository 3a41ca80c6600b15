"""Shared helpers of the training-data operators.

* text -> numpy: Arrow string buffers are read in place, in chunks of about
  1 MB that end at document borders, so a task never holds more than a few
  arrays of that size (or of one document, if that is longer).
* text groups: documents are dealt into groups of a few MB by a hash of their
  id, packed as compressed Arrow blobs; several steps of an operator read the
  same exchange.
* shared hashes: which 64-bit values occur in more than one group. Groups send
  their sorted values to hash-range buckets, buckets answer to the groups.
* link components: exact connected components of "share a key and are similar".
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricelab.session import ensure_checkpoint_dir, ship_package

NO_ID = np.iinfo(np.int64).max     # a null doc_id inside tasks: after every real id
CHUNK_BYTES = 1 << 20
GROUP_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder from the session, package on the workers, Arrow batches
    of bounded size (texts may be long)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: smaller than a
    checkpoint, with column pruning for steps that read it more than once."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def rows_of(docs: DataFrame, picked: DataFrame, bound: int) -> DataFrame:
    """``docs`` joined with a sample of about ``bound`` ids, ``picked (doc_id, ...)``. The
    sample is written and counted first, and broadcast if it keeps its bound, so that
    the other texts stay where they are."""
    picked = cut(picked)
    return docs.join(F.broadcast(picked) if picked.count() <= 2 * bound else picked, "doc_id")


_STORES: dict = {}


def worker_store(owner, make):
    """What an operator keeps in a Python worker from one task to the next, made by ``make()``. Workers
    outlive operators and models, so only the last ``owner`` keeps anything."""
    if owner not in _STORES:
        _STORES.clear()
        _STORES[owner] = make()
    return _STORES[owner]


def release(spark: SparkSession) -> None:
    """Lets Spark delete shuffle and checkpoint files that nothing refers to: its
    cleaner acts when the driver's JVM collects garbage, which iterative jobs reach
    long after their files have filled the disks."""
    spark.sparkContext._jvm.System.gc()


# ---------------------------------------------------------------- numpy on text

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64), vectorised."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        base = np.full(max(n, 2 * len(have)), _BASE if kind == "up" else _BASE_INV, np.uint64)
        base[0] = 1
        have = _powers[kind] = np.multiply.accumulate(base)
    return have[:n]


def span_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every ``b[start:end]``: differences of one polynomial prefix sum."""
    n = len(b)
    p = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_HASH[b] * _power("up", n + 1)[:n], out=p[1:])
    return mix((p[ends] - p[starts]) * _power("down", n + 1)[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k``-byte string of ``b`` by doubling (length ``len(b)-k+1``)."""
    if len(b) < k:
        return np.empty(0, np.uint64)
    out, done = None, 0
    h, width = BYTE_HASH[b], 1
    while width <= k:
        if k & width:
            if out is None:
                out, done = h, width
            else:
                m = min(len(out), len(h) - done)
                out = out[:m] * _U(pow(_BASE, width, 1 << 64)) + h[done:done + m]
                done += width
        if width * 2 <= k:
            h = h[:len(h) - width] * _U(pow(_BASE, width, 1 << 64)) + h[width:]
        width *= 2
    return mix(out[:len(b) - k + 1])


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES):
    """Yield ``(first, bytes, offsets)``: rows ``first ..`` of ``texts`` as one uint8
    array and the row borders in it; a null row is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE_WORD = np.ones(256, bool)            # words [^\x20\x09-\x0D]+
SPACE_WORD[[32, 9, 10, 11, 12, 13]] = False


def word_spans(b: np.ndarray, offs: np.ndarray, is_word: np.ndarray = SPACE_WORD):
    """``(starts, ends, ptr)`` of the words; words of row i are ``ptr[i]:ptr[i+1]``."""
    n = len(b)
    w = np.zeros(n + 2, bool)
    w[1:-1] = is_word[b]
    new = np.zeros(n + 1, bool)
    new[offs] = True
    starts = np.flatnonzero(w[1:-1] & (~w[:-2] | new[:n]))
    ends = np.flatnonzero(w[1:-1] & (~w[2:] | new[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def pack_u64(a: np.ndarray) -> bytes:
    """Sorted uint64 values as zstd over byte planes of their differences."""
    d = np.diff(a, prepend=_U(0)).astype("<u8")
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_u64(blob: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def pack_raw(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def unpack_raw(blob: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype)


def signed(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a).view(np.int64)


def flat(col):
    """An Arrow column as one array."""
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


def id_array(col) -> np.ndarray:
    """int64 ids of an Arrow column; null becomes ``NO_ID``."""
    return flat(col).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


# ------------------------------------------------------------------ text groups

def group_count(docs: DataFrame, group_bytes: int = GROUP_BYTES) -> int:
    """How many groups of about ``group_bytes`` the texts fill (one narrow scan)."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-int(total) // group_bytes))


def text_groups(docs: DataFrame, groups: int, columns: list[str] | None = None) -> DataFrame:
    """``(g, blob)``: the documents dealt by a hash of doc_id (of the text, where that is
    null) into ``groups`` groups.

    A blob is a zstd-compressed Arrow stream of the rows of one input batch that
    belong to group ``g``, with all ``columns`` (default: all), so one exchange
    moves the text compressed and every later step can read that exchange."""
    columns = columns or docs.columns
    dealt = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id")) if "text" in docs.columns else F.xxhash64("doc_id")
    key = F.pmod(dealt, F.lit(groups)).cast("int")
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), key.alias("g"))

    def pack(batches):
        opts = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            if not batch.num_rows:
                continue
            row = batch.column(0)
            tab = pa.RecordBatch.from_arrays(row.flatten(), schema=fields_of(row.type))
            g = batch.column(1).to_numpy()
            order = np.argsort(g, kind="stable")
            cuts = np.flatnonzero(np.diff(g[order], prepend=-1))
            keys, blobs, size = [], [], 0
            for lo, hi in zip(cuts, [*cuts[1:], len(g)]):
                sink = pa.BufferOutputStream()
                part = tab.take(pa.array(order[lo:hi]))
                with pa.ipc.new_stream(sink, part.schema, options=opts) as out:
                    out.write_batch(part)
                keys.append(int(g[order[lo]]))
                blobs.append(sink.getvalue().to_pybytes())
                size += len(blobs[-1])
                if size > (8 << 20):
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary())], ["g", "blob"])
                    keys, blobs, size = [], [], 0
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary())], ["g", "blob"])

    return src.mapInArrow(pack, "g int, blob binary")


def fields_of(t: pa.StructType) -> pa.Schema:
    return pa.schema([t.field(i) for i in range(t.num_fields)])


def group_rows(tab: pa.Table) -> pa.Table:
    """The packed rows of one group as one table, in a stable order."""
    parts = [pa.ipc.open_stream(x).read_all() for x in tab.column("blob").to_pylist()]
    return pa.concat_tables(parts).combine_chunks()


# ---------------------------------------------------------------- shared hashes

def bucket_rows(values: np.ndarray, counts: np.ndarray, g: int, bits: int) -> pa.Table:
    """Rows ``(bucket, g, singles, multis, counts)`` from sorted distinct ``values``;
    a value's bucket is its top ``bits`` bits."""
    edges = np.searchsorted(values >> _U(64 - bits), np.arange((1 << bits) + 1).astype(np.uint64)) if bits else np.array([0, len(values)])
    out = {"bucket": [], "g": [], "singles": [], "multis": [], "counts": []}
    for i in np.flatnonzero(np.diff(edges)):
        v, c = values[edges[i]:edges[i + 1]], counts[edges[i]:edges[i + 1]]
        many = c > 1
        out["bucket"].append(int(i))
        out["g"].append(g)
        out["singles"].append(pack_u64(v[~many]))
        out["multis"].append(pack_u64(v[many]))
        out["counts"].append(pack_raw(c[many].astype("<u4")))
    return pa.table(out, schema=BUCKET_ARROW)


BUCKET_ARROW = pa.schema([("bucket", pa.int32()), ("g", pa.int32()), ("singles", pa.binary()), ("multis", pa.binary()), ("counts", pa.binary())])
BUCKET_SCHEMA = "bucket int, g int, singles binary, multis binary, counts binary"
ANSWER_SCHEMA = "g int, keys binary, freq binary"
ANSWER_ARROW = pa.schema([("g", pa.int32()), ("keys", pa.binary()), ("freq", pa.binary())])


def answer_shared(tab):
    """For one bucket: to every group the values it holds that occur at least
    twice over all groups, with their total count."""
    gs = tab.column("g").to_pylist()
    parts, freqs = [], []
    for s, m, c in zip(tab.column("singles").to_pylist(), tab.column("multis").to_pylist(), tab.column("counts").to_pylist()):
        s, m = unpack_u64(s), unpack_u64(m)
        parts.append(np.concatenate([s, m]))
        freqs.append(np.concatenate([np.ones(len(s), np.int64), unpack_raw(c, "<u4").astype(np.int64)]))
    at = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    v = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    f = np.concatenate(freqs) if freqs else np.empty(0, np.int64)
    order = np.argsort(v, kind="stable")
    v, f, at = v[order], f[order], at[order]
    first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.empty(0, np.int64)
    run = np.diff(np.append(first, len(v)))
    total = np.repeat(np.add.reduceat(f, first), run) if len(v) else f
    keep = total >= 2
    v, total, at = v[keep], total[keep], at[keep]
    order = np.argsort(at, kind="stable")
    v, total, at = v[order], total[order], at[order]
    edges = np.searchsorted(at, np.arange(len(parts) + 1))
    out = {"g": [], "keys": [], "freq": []}
    for i in np.flatnonzero(np.diff(edges)):
        out["g"].append(gs[i])
        out["keys"].append(pack_u64(v[edges[i]:edges[i + 1]]))
        out["freq"].append(pack_raw(np.minimum(total[edges[i]:edges[i + 1]], 0xFFFFFFFF).astype("<u4")))
    return pa.table(out, schema=ANSWER_ARROW)


def shared_hashes(groups_df: DataFrame, values_of, groups: int, per_group: int) -> DataFrame:
    """``(g, keys, freq)``: for every group those of its values that occur at least
    twice anywhere. ``values_of(rows) -> (sorted distinct uint64, counts)``.
    ``per_group``: about how many values a group has (sets the bucket count)."""
    bits = max(0, int(groups * per_group / 2_000_000).bit_length())

    def send(key, tab):
        worker_store("hashes", dict)        # caches of an earlier stage's operator go
        values, counts = values_of(group_rows(tab))
        return bucket_rows(values, counts, key[0].as_py(), bits)

    sent = groups_df.groupBy("g").applyInArrow(send, BUCKET_SCHEMA)
    return sent.groupBy("bucket").applyInArrow(answer_shared, ANSWER_SCHEMA)


def read_answers(tab: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shared values of a group and their counts."""
    if not tab.num_rows:
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    v = np.concatenate([unpack_u64(x) for x in tab.column("keys").to_pylist()])
    f = np.concatenate([unpack_raw(x, "<u4") for x in tab.column("freq").to_pylist()])
    order = np.argsort(v, kind="stable")
    return v[order], f[order]


def lookup(values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(position in sorted keys, found)`` for each value."""
    if not len(keys):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return at, keys[at] == values


# ------------------------------------------------------------------- components

def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``(id, comp)`` with comp = smallest id reachable over ``edges (a, b)``.

    Large-star / small-star union-find on edge tables: every round is a grouped
    minimum and an equi-join, checkpointed to the shared folder; nothing is
    collected but the round's change count."""
    e = cut(edges.where(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(max_rounds):
        if all_stars(e):
            release(e.sparkSession)
            return e.select(F.col("u").alias("id"), F.col("v").alias("comp"))
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every larger neighbour of u hangs on the smallest one
        large = (both.where(F.col("v") > F.col("u")).join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")))
        # small star: u and its smaller neighbours hang on the smallest one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        e = cut(large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
                .union(least.select("u", F.col("m").alias("v"))).distinct())
    raise RuntimeError("components did not settle")


def all_stars(e: DataFrame) -> bool:
    """Whether every id of ``e (u, v)`` is either a centre ``v`` or hangs on exactly
    one: then the components are found, and no further round is needed."""
    ends = (e.select(F.col("u").alias("id"), F.lit(1).alias("hangs"), F.lit(0).alias("centre"))
            .union(e.select(F.col("v").alias("id"), F.lit(0).alias("hangs"), F.lit(1).alias("centre"))))
    mixed = ends.groupBy("id").agg(F.sum("hangs").alias("hangs"), F.max("centre").alias("centre"))
    return mixed.where("hangs + centre > 1").isEmpty()


def link_components(sets: DataFrame, similar, to_values, tile: int = 2048, rounds: int = 5) -> DataFrame:
    """Exact components of the sets that share a key and are ``similar``.

    ``sets``: (sid long, n int, keys array<long>, payload binary), one row per distinct set, already
    written out. ``to_values(payloads)`` gives the uint64 values of many as ``(hashes, ptr)`` (repeats
    allowed), ``similar(inter, na, nb)`` is the exact test. Of the keys that the same sets share
    only one goes on: the others have no pair of their own.

    1. Stars: each set is verified against one pivot that shares a key with it and
       is in another component, first the smallest, then (for keys whose sets are
       still apart) other ones chosen by a hash; components of all links so far.
    2. Rest: keys whose sets are still in different components. Their sets meet
       in size-banded tiles of bounded size; bitmap bit counts bound each
       overlap from above, and the surviving pairs are verified inside the tiles, so that
       a tile returns links that join components there, fewer than its rows, however
       many near misses meet in it. Stars end as soon as every key fits a tile.
    Pairs inside one component need no test, so large groups of copies cost
    linear work. The stars only save work: the rest covers every pair of a key
    that is not in one component. Returns (sid, comp) for components of two or more."""
    keys = sets.select("sid", "n", F.explode("keys").alias("key"))
    shared = (keys.groupBy("key").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi"), F.count(F.lit(1)).alias("size"),
                                      *[F.sum(F.shiftright(F.xxhash64("sid", F.lit(i)), 20)).alias(f"sum{i}") for i in range(2)])
              .where("lo <> hi").groupBy("lo", "hi", "size", "sum0", "sum1").agg(F.min("key").alias("key")).select("key"))
    keyed, seen, comp = cut(keys.join(shared, "key", "left_semi")).withColumn("comp", F.col("sid")), None, None
    for r in range(rounds):
        score = F.col("sid") if r == 0 else F.xxhash64("sid", F.lit(r))
        pivots = (keyed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(F.struct(score.alias("s"), "sid", "comp")).alias("p"))
                  .where("lo <> hi").select("key", F.col("p.sid").alias("pivot"), F.col("p.comp").alias("pcomp")))
        choice = F.struct((F.col("pivot") if r == 0 else F.xxhash64("key", F.lit(r))).alias("s"), "pivot")
        star = (keyed.join(pivots, "key").where("comp <> pcomp").groupBy("sid").agg(F.min(choice).alias("c"))
                .select(F.least("sid", "c.pivot").alias("a"), F.greatest("sid", "c.pivot").alias("b")).distinct())
        star = cut(star if seen is None else star.join(seen, ["a", "b"], "left_anti"))
        found = cut(verify_pairs(star, sets, to_values, similar))
        seen = star if seen is None else seen.union(star)
        fresh = found.count()
        if fresh or comp is None:
            comp = components(found if comp is None else comp.toDF("a", "b").union(found))
            # a key whose sets are in one component stays so: only the others go on
            now = keyed.drop("comp").join(comp.withColumnRenamed("id", "sid"), "sid", "left").select("key", "sid", "n", F.coalesce("comp", "sid").alias("comp"))
            apart = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
            keyed = cut(now.join(apart, "key", "left_semi"))
            del now, apart
        tried = star.count()
        del pivots, choice, star, found
        release(sets.sparkSession)
        if fresh * 50 < tried or not fresh:
            break
        if keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > tile).isEmpty():
            break

    mixed = (keyed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"),
                                      F.min("sid").alias("leader")).where("lo <> hi"))
    rest = keyed.join(mixed.select("key", "size", "weight", "leader"), "key")
    more = cut(tile_links(rest, sets, to_values, similar, tile))
    if not more.isEmpty():
        comp = components(comp.toDF("a", "b").union(more))
    return comp.select(F.col("id").alias("sid"), "comp")


def verify_pairs(pairs: DataFrame, sets: DataFrame, to_values, similar) -> DataFrame:
    """The ``pairs (a, b)`` whose sets pass the exact test."""
    side = sets.select("sid", "payload")
    both = (pairs.join(side.select(F.col("sid").alias("a"), F.col("payload").alias("pa")), "a")
            .join(side.select(F.col("sid").alias("b"), F.col("payload").alias("pb")), "b"))

    def test(batches):
        for t in batches:
            size = np.cumsum([len(x) + len(y) for x, y in zip(t.column(2).to_pylist(), t.column(3).to_pylist())])
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(size // CHUNK_BYTES)) + 1, [len(size)]]) if len(size) else [0]
            keep = np.concatenate([np.zeros(0, bool), *[similar_pairs(t.column(2)[lo:hi], t.column(3)[lo:hi], to_values, similar)
                                                        for lo, hi in zip(cuts[:-1], cuts[1:])]])
            yield pa.RecordBatch.from_arrays([t.column(0).filter(pa.array(keep)), t.column(1).filter(pa.array(keep))], ["a", "b"])

    return both.select("a", "b", "pa", "pb").mapInArrow(test, "a long, b long")


def similar_pairs(left: pa.Array, right: pa.Array, to_values, similar) -> np.ndarray:
    """For each pair of payloads whether their sets pass the exact test."""
    (a, pa_), (b, pb) = (to_values(x.to_pylist()) for x in (left, right))
    inter, sizes = [], []
    for i in range(len(left)):
        x, y = distinct(a[pa_[i]:pa_[i + 1]]), distinct(b[pb[i]:pb[i + 1]])
        inter.append(common_values(x, y))
        sizes.append((len(x), len(y)))
    na, nb = np.array(sizes, np.int64).reshape(-1, 2).T
    return similar(np.array(inter, np.int64), na, nb)


def distinct(a: np.ndarray) -> np.ndarray:
    """Sorted distinct values; ``np.unique`` hashes them first, which is slower."""
    a = np.sort(a)
    return a[np.append(True, a[1:] != a[:-1])] if len(a) else a


def common_values(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted arrays of distinct values share."""
    both = np.sort(np.concatenate([a, b]))
    return int(np.count_nonzero(both[1:] == both[:-1]))


LOT_ROWS = 4000
SLICE_ROWS = 20_000             # rows of the keys of one leader that go to one lot
PAIR_TABLE = 6000               # sets of a lot up to which failed pairs are remembered (36 MB)
FEW_ROWS = 48                   # rows of a tile up to which its pairs are listed
PAIR_ROWS = 1 << 19             # pairs listed at once
TILE_VALUES = 2 << 20           # set values on one side of a tile
WIDE_BITS = 4096


def bitmaps(hashes: np.ndarray, ptr: np.ndarray, bits: int) -> np.ndarray:
    """``bitmap`` of many sets ``hashes[ptr[i]:ptr[i + 1]]`` (repeats allowed), one row each."""
    step, out = 512, []
    for lo in range(0, len(ptr) - 1, step):
        hi = min(lo + step, len(ptr) - 1)
        own = hashes[ptr[lo]:ptr[hi]]
        mark = np.zeros((hi - lo) * bits, bool)
        mark[np.repeat(np.arange(hi - lo) * bits, np.diff(ptr[lo:hi + 1])) + (mix(own) >> _U(65 - bits.bit_length())).astype(np.int64)] = True
        out.append(np.packbits(mark).view(np.uint64).reshape(hi - lo, -1))
    return np.concatenate(out)


def tile_pairs(starts: np.ndarray, sizes: np.ndarray):
    """Yields rows ``(x, y)`` of all pairs in the tiles ``start .. start + size``, about ``PAIR_ROWS`` at once."""
    for size in np.unique(sizes[sizes > 1]):
        left, right = np.triu_indices(size, 1)
        of = starts[sizes == size]
        step = max(1, PAIR_ROWS // len(left))
        for lo in range(0, len(of), step):
            at = of[lo:lo + step, None]
            yield (at + left).ravel(), (at + right).ravel()


def tile_links(rest: DataFrame, sets: DataFrame, to_values, similar, tile: int) -> DataFrame:
    """Verified links between different components, found inside the tiles.

    ``rest``: (key, sid, comp, size, weight, leader, n), ``weight`` the sum of n over the key and
    ``leader`` its smallest sid; ``sets``: (sid, payload). A key of up to ``tile`` rows and ``TILE_VALUES``
    set values is one tile; a larger one is banded by size (base 1.26, so partners of similarity
    0.8 are one band apart at most) and cut into blocks, every pair of blocks being a tile.
    Tiles are worked on in lots. Keys with one leader mostly hold the same sets, so
    they go to the same lot, in slices of bounded size, and a set's values travel once a lot.
    A lot links its components like a union-find does, so it returns fewer links
    than it has rows; which ones depends on the order of rows, what they join
    does not. The pairs of small tiles are listed for the whole lot at once, each
    pair of sets once; larger tiles are gone through row by row."""
    blocks = F.greatest(F.ceil(F.col("size") / tile), F.ceil(F.col("weight") / F.lit(TILE_VALUES))).cast("int")
    own = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    band = F.floor(F.log(F.greatest(F.col("n"), F.lit(1)).cast("double")) / F.log(F.lit(1.26))).cast("int")
    cut_up = F.col("blocks") > 1
    led = rest.groupBy("leader").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("values"))
    slices = F.greatest(F.lit(1), F.ceil(F.col("rows") / SLICE_ROWS), F.ceil(F.col("values") / F.lit(4 * TILE_VALUES)))
    keys = rest.select("key", "leader").distinct().join(led, "leader").select("key", F.pmod(F.xxhash64("key"), slices).alias("slice"))
    dealt = written(rest.join(keys, "key").withColumn("blocks", blocks).withColumn("own", own)
             .withColumn("band", F.explode(F.when(cut_up, F.array(band, band + 1)).otherwise(F.array(F.lit(0)))))
             .withColumn("home", ~cut_up | (F.col("band") == band))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
             .select(F.xxhash64("key", "band", "i", "j").alias("tile"), F.xxhash64("leader", "slice", "blocks", "band", "i", "j").alias("unit"), "i", "j", "own", "home", "sid", "comp", "n"))
    total = dealt.agg(F.count(F.lit(1)), F.sum("n")).first()
    lots = max(1, (total[0] or 0) // LOT_ROWS, (total[1] or 0) // TILE_VALUES)
    dealt = dealt.withColumn("lot", F.pmod(F.xxhash64("unit"), F.lit(lots))).drop("unit")
    wanted = (dealt.select(F.col("lot").alias("to"), F.col("sid").alias("id")).distinct()
              .join(sets.select(F.col("sid").alias("id"), "payload"), "id"))

    def link(key, t, p):
        tiles = t.column("tile").to_numpy()
        order = np.argsort(tiles, kind="stable")
        home = t.column("home").to_numpy(zero_copy_only=False)[order]
        i, j, sid, comp, n, own = (t.column(c).to_numpy()[order] for c in ("i", "j", "sid", "comp", "n", "own"))
        names = p.column("id").to_numpy()
        by = np.argsort(names)
        which = by[np.searchsorted(names, sid, sorter=by)]
        hashes, ptr = to_values(p.column("payload").to_pylist())
        bits = bitmaps(hashes, ptr, WIDE_BITS)
        sets: dict[int, np.ndarray] = {}

        def values(k):
            if k not in sets:
                sets[k] = distinct(hashes[ptr[k]:ptr[k + 1]])
            return sets[k]

        # components that links of this lot joined: which tile found them does not matter
        root, group = np.unique(comp, return_inverse=True)
        root = np.arange(len(root))
        left, right = [], []

        def joined(x, y):
            """Notes the link of rows ``x`` and ``y``."""
            root[root == root[group[y]]] = root[group[x]]
            left.append(min(sid[x], sid[y]))
            right.append(max(sid[x], sid[y]))

        # pairs that failed under another key of the lot
        failed = np.zeros((len(names), len(names)), bool) if len(names) <= PAIR_TABLE else None
        cuts = np.append(np.flatnonzero(np.diff(tiles[order], prepend=tiles[order][0] - 1)), len(sid))
        few = np.diff(cuts) <= FEW_ROWS
        for x, y in tile_pairs(cuts[:-1][few], np.diff(cuts)[few]):
            m = (comp[x] != comp[y]) & (home[x] | home[y]) & ((i[x] == j[x]) | (own[x] != own[y])) & similar(np.minimum(n[x], n[y]), n[x], n[y])
            x, y = x[m], y[m]
            code = np.minimum(which[x], which[y]) * len(names) + np.maximum(which[x], which[y])
            once = np.unique(code, return_index=True)[1]
            x, y = x[once], y[once]
            if failed is not None:
                new = ~failed[which[x], which[y]]
                x, y = x[new], y[new]
            for lo in range(0, len(x), 2048):
                px, py = x[lo:lo + 2048], y[lo:lo + 2048]
                mine, other = bits[which[px]], bits[which[py]]
                bound = np.minimum(n[px] - np.bitwise_count(mine & ~other).sum(1, dtype=np.int64),
                                   n[py] - np.bitwise_count(other & ~mine).sum(1, dtype=np.int64))
                near = similar(bound, n[px], n[py])
                if failed is not None:
                    failed[which[px[~near]], which[py[~near]]] = failed[which[py[~near]], which[px[~near]]] = True
                for u, v in zip(px[near].tolist(), py[near].tolist()):
                    if root[group[u]] == root[group[v]]:
                        continue
                    a, c = values(which[u]), values(which[v])
                    if similar(common_values(a, c), len(a), len(c)):
                        joined(u, v)
                    elif failed is not None:
                        failed[which[u], which[v]] = failed[which[v], which[u]] = True
        for lo, hi in zip(cuts[:-1][~few], cuts[1:][~few]):
            label = root[group[lo:hi]]
            if (label == label[0]).all():
                continue
            here, m_ = which[lo:hi], n[lo:hi]
            for x in np.flatnonzero(home[lo:hi]):
                m = (label != label[x]) & (~home[lo:hi] | (sid[lo:hi] > sid[lo + x])) & similar(np.minimum(m_[x], m_), m_[x], m_)
                if i[lo] != j[lo]:
                    m &= own[lo:hi] != own[lo + x]
                if failed is not None:
                    m &= ~failed[here[x], here]
                y = np.flatnonzero(m)
                if not len(y):
                    continue
                mine, other = bits[here[x]], bits[here[y]]
                bound = np.minimum(m_[x] - np.bitwise_count(mine & ~other).sum(1, dtype=np.int64),
                                   m_[y] - np.bitwise_count(other & ~mine).sum(1, dtype=np.int64))
                y = y[similar(bound, m_[x], m_[y])]
                a = values(here[x])
                while len(y):                       # partners by the thousand values at a time
                    b = [values(here[y[0]])]
                    while len(b) < len(y) and sum(map(len, b)) < 50_000:
                        b.append(values(here[y[len(b)]]))
                    size = np.array([len(v) for v in b])
                    flat = np.concatenate(b)
                    hit = a[np.minimum(np.searchsorted(a, flat), len(a) - 1)] == flat
                    good = similar(np.add.reduceat(hit, np.cumsum(size) - size, dtype=np.int64), len(a), size)
                    if failed is not None:
                        miss = here[y[:len(b)][~good]]
                        failed[here[x], miss] = failed[miss, here[x]] = True
                    for z in y[:len(b)][good]:
                        if label[z] != label[x]:
                            label[label == label[z]] = label[x]
                            joined(lo + x, lo + z)
                    y = y[len(b):]
                    y = y[label[y] != label[x]]
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return dealt.groupBy("lot").cogroup(wanted.groupBy("to")).applyInArrow(link, "a long, b long").distinct()


def jaccard_80(inter, na, nb):
    """100 * intersection >= 80 * union, in integers."""
    return 100 * inter >= 80 * (na + nb - inter)
