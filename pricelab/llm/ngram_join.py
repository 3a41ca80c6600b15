"""N-gram Jaccard join: documents whose 5-word shingle sets have similarity >= 0.8.

Method: size-banded tiles with hashed bitmap signatures. Exact prefix filtering
picks the candidates: shingles are ordered by corpus frequency (rare first, then
by hash), and two sets of similarity 0.8 or more share one of their first
n - ceil(0.8 n) + 1 shingles. Frequencies are counted over the whole corpus, so
a passage that many documents share comes last and keys no group. Sets that
share a key meet in tiles banded by set size; bit counts of the hashed bitmaps
bound each overlap from above, and sorted arrays are intersected for the rest
(``common.link_components``). Only components are needed, so a pair already
inside one component is not tested again and no group of copies is expanded.

Defined results: null or wordless text has an empty set and links with nothing
(its component is its own doc_id); equal sets always link; a null doc_id takes
part as the largest id and is returned as null; rows that repeat a doc_id or have
none are documents of their own and link by their texts only; a component has the
smallest doc_id of its rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from pricelab.llm import common as C

SHINGLE = 5
_U = np.uint64
_MULT = [_U(C._power("up", 8)[i + 1]) for i in range(SHINGLE)]


def shingle_sets(texts: pa.Array):
    """Yield ``(row, sorted distinct uint64 shingle hashes)`` for every row."""
    for lo, raw, offs in C.chunks(texts):
        b = C.LOWER[raw]
        starts, ends, ptr = C.word_spans(b, offs)
        w = C.span_hashes(b, starts, ends)
        m = len(w) - SHINGLE + 1
        s = np.zeros(max(m, 0), np.uint64)
        for i, c in enumerate(_MULT):
            if m > 0:
                s += w[i:i + m] * c
        s = C.mix(s)
        for r in range(len(offs) - 1):
            a, z = ptr[r], ptr[r + 1]
            if z - a >= SHINGLE:
                yield lo + r, np.unique(s[a:z - SHINGLE + 1])
            elif z > a:   # fewer words: the whole sequence is the one shingle
                h = np.array([z - a], np.uint64)
                for x in w[a:z]:
                    h = C.mix(h * _MULT[0] + x)
                yield lo + r, h
            else:
                yield lo + r, np.empty(0, np.uint64)


def _distinct_sets(rows: pa.Table):
    """Per group: ``[(set hash, smallest id, array)]`` and ``(id, n, set hash)`` per row."""
    ids = C.id_array(rows.column("doc_id"))
    seen: dict[bytes, list] = {}
    member = []
    for r, arr in shingle_sets(rows.column("text")):
        if not len(arr):
            member.append((ids[r], 0, None))
            continue
        h = hashlib.blake2b(arr.tobytes(), digest_size=16).digest()
        have = seen.get(h)
        if have is None:
            seen[h] = [ids[r], arr]
        elif ids[r] < have[0]:
            have[0] = ids[r]
        member.append((ids[r], len(arr), h))
    return seen, member


def _group_values(rows: pa.Table):
    seen, _ = _distinct_sets(rows)
    if not seen:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.unique(np.concatenate([a for _, a in seen.values()]) >> _U(16) << _U(16), return_counts=True)


def many_sets(payloads: list[bytes]):
    """``(hashes, ptr)`` of many packed sets."""
    sets = [C.unpack_u64(x) for x in payloads]
    return np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])])


def prefix_length(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1


_SETS = "doc_id long, n_shingles long, local long, set_hash binary, text_hash binary, keys array<long>, payload binary"
_SETS_ARROW = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("local", pa.int64()), ("set_hash", pa.binary()), ("text_hash", pa.binary()),
                         ("keys", pa.list_(pa.int64())), ("payload", pa.binary())])


def text_hash(text: str | None) -> bytes:
    return hashlib.blake2b((text or "").encode(), digest_size=16).digest()


def _candidates(key, left, right):
    """One row per document with ``local``, the number of its set (unique over all
    groups); the first document of each distinct set of the group also carries its
    shared prefix keys and array, if it has any."""
    if not left.num_rows:
        return _SETS_ARROW.empty_table()
    shared, freq = C.read_answers(right)
    rows = C.group_rows(left)
    seen, member = _distinct_sets(rows)
    number = {h: (key[0].as_py() << 32) + i for i, h in enumerate(seen)}
    extra = {}
    for h, (_, arr) in seen.items():
        at, found = C.lookup(arr >> _U(16) << _U(16), shared)
        f = np.where(found, freq[at] if len(freq) else 1, 1)
        first = np.lexsort((arr, f))[:prefix_length(len(arr))]
        keys = arr[first][found[first]] >> _U(16) << _U(16)
        if len(keys):
            extra[h] = (C.signed(np.unique(keys)), C.pack_u64(arr))
    out = {n: [] for n in _SETS_ARROW.names}
    done = set()
    for r, (i, n, h) in enumerate(member):
        head = h is not None and seen[h][0] == i and h not in done
        if head:
            done.add(h)
        keys, payload = extra.get(h, (None, None)) if head else (None, None)
        for c, v in zip(out, (int(i), n, number.get(h), h if head else None, text_hash(rows.column("text")[r].as_py()) if head else None, keys, payload)):
            out[c].append(v)
    return pa.table(out, schema=_SETS_ARROW)


def _linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``_candidates`` and, for each ``local`` set, its component: ``sid`` (one set
    of it) and ``component`` (its smallest doc_id)."""
    spark = docs.sparkSession
    C.prepare(spark)
    docs = docs.select("doc_id", "text")
    groups = C.group_count(docs)
    packed = C.text_groups(docs, groups)
    shared = C.shared_hashes(packed, _group_values, groups, C.GROUP_BYTES // 6)
    found = C.written(packed.groupBy("g").cogroup(shared.groupBy("g")).applyInArrow(_candidates, _SETS))

    # equal sets: the set of the smallest id over all groups stands for them
    heads = found.where("set_hash is not null")
    reps = heads.groupBy("set_hash").agg(F.min(F.struct("doc_id", "local")).alias("r")).select("set_hash", F.col("r.doc_id").alias("rep"), F.col("r.local").alias("sid"))
    sets = (heads.where("keys is not null").join(reps.select("sid"), F.col("local") == F.col("sid"), "left_semi")
            .select(F.col("local").alias("sid"), F.col("n_shingles").alias("n"), "keys", "payload"))
    comp = C.cut(C.link_components(C.written(sets), C.jaccard_80, many_sets))
    # components are found over sets; the smallest doc_id of their sets names them
    named = comp.unionByName(comp.select(F.col("comp").alias("sid"), "comp")).distinct().join(reps.select("sid", "rep"), "sid")
    names = named.groupBy("comp").agg(F.min("rep").alias("name"))
    of = named.select("sid", "comp").join(names, "comp")
    to = (heads.select("set_hash", "local").join(reps, "set_hash").join(of, "sid", "left")
          .select("local", F.coalesce("comp", "sid").alias("sid"), F.coalesce("name", "rep").alias("component")))
    return found, to


def join_components(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``docs (doc_id, text)``."""
    found, to = _linked(docs)
    none = F.lit(int(C.NO_ID))
    return (found.select("doc_id", "n_shingles", "local").join(to.select("local", "component"), "local", "left")
            .select(F.nullif("doc_id", none).alias("doc_id"), "n_shingles",
                    F.nullif(F.coalesce("component", "doc_id"), none).alias("component_id")))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id, of
    several with that id (or all without one) any. Wordless documents stay."""
    found, to = _linked(docs)
    heads = found.where("set_hash is not null").select("local", "doc_id", "text_hash")
    keep = (heads.join(to, "local").groupBy("sid").agg(F.min(F.struct("doc_id", "local", "text_hash")).alias("k"))
            .select(F.shiftright("k.local", 32).cast("int").alias("g"), "k.doc_id", "k.text_hash"))
    packed = C.text_groups(docs, C.group_count(docs))

    def pick(left, right):
        rows = C.group_rows(left)
        want = set(zip(right.column("doc_id").to_pylist(), right.column("text_hash").to_pylist()))
        stay = []
        for i, text in zip(C.id_array(rows.column("doc_id")).tolist(), rows.column("text").to_pylist()):
            row = (i, text_hash(text))
            stay.append(row in want or not (text or "").strip(" \t\n\v\f\r"))
            want.discard(row)
        return rows.filter(pa.array(stay, pa.bool_()))

    return packed.groupBy("g").cogroup(keep.groupBy("g")).applyInArrow(pick, docs.schema)
