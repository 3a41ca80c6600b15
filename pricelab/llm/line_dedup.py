"""Fuzzy line dedup by MinHash: of similar lines over all documents one stays.

Lines are split at ``\\n`` and normalised (A-Z lower-cased, runs of white space one
space, outer white space gone). A line's set holds its 8-byte shingles (a shorter
line is its own single shingle). Signatures are one-permutation MinHash with
empty bins filled from the next full one; lines of few shingles, whose filled bins
would repeat one another, have a minimum under each of 48 salts instead, and sets of
``FEW`` up to ``1.25 * FEW`` shingles have both, so similar sets have one in common.
Bands of four rows, twelve bands: a pair of similarity 0.8 shares a band with
probability 0.998, whatever its length. Lines that share a band
are verified by exact Jaccard similarity (>= 0.8) of their sets, links form
components by distributed union-find, and the first line of each component by
(doc_id, line number) stays. Equal lines meet through a hash of their whole
normalised form.

Groups of documents ask for the band keys that occur at least twice anywhere
(``common.shared_hashes``), so only lines with a possible partner travel, once
per group and distinct text. Signatures are made once, for question and answer.

Defined results: blank lines are no candidates and always stay; null text stays
null with no lines; a document that loses every non-blank line keeps empty text
(``text`` is null only if it was null); ties between rows of one doc_id go to the
row that comes first in its group; null doc_id counts as the largest id; all
other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructType

from pricelab.llm import common as C

SHINGLE = 8
BANDS, ROWS = 12, 4
BINS = 64                       # one-permutation bins; BANDS * ROWS of them are used
FEW = 128                       # sets below 1.25 times this have salted minima, from this on bins
_U = np.uint64
_TO_LOWER_SPACE = bytes.maketrans(bytes(range(65, 91)) + b"\t\v\f\r", bytes(range(97, 123)) + b"    ")


def normalised_lines(raw: np.ndarray, offs: np.ndarray):
    """``(bytes, starts, ends, row, line_no)`` of the non-blank lines of some rows,
    in normalised form; each line is followed by one newline byte in ``bytes``."""
    n_rows = len(offs) - 1
    whole = raw.tobytes()
    data = b"\n".join([whole[offs[r]:offs[r + 1]] for r in range(n_rows)]) + b"\n"
    number = np.searchsorted(np.flatnonzero(raw == 10), offs)
    lines = np.diff(number) + 1                                 # of each row, blank ones too
    data = data.translate(_TO_LOWER_SPACE)
    while b"  " in data:
        data = data.replace(b"  ", b" ")
    b = np.frombuffer(data.replace(b" \n", b"\n").replace(b"\n ", b"\n").lstrip(b" "), np.uint8)
    ends = np.flatnonzero(b == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    row = np.repeat(np.arange(n_rows), lines)
    no = np.arange(len(ends)) - np.repeat(np.cumsum(lines) - lines, lines)
    full = ends > starts
    return b, starts[full], ends[full], row[full], no[full]


def line_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every non-empty line ``b[start:end]``: the sum of its eight-byte
    blocks, each mixed with its place; the last block ends with the line."""
    if not len(starts):
        return np.empty(0, np.uint64)
    width = ends - starts
    count = (width + 7) >> 3
    first = np.cumsum(count) - count
    k = np.arange(count.sum()) - np.repeat(first, count)
    at = np.minimum(np.repeat(starts, count) + 8 * k, np.repeat(np.maximum(ends - 8, starts), count))
    words = np.ndarray(len(b) + 1, "<u8", np.concatenate([b, np.zeros(8, np.uint8)]), 0, (1,))[at]
    short = np.flatnonzero(width < 8)
    words[first[short]] &= (_U(1) << (8 * width[short]).astype(np.uint64)) - _U(1)
    words = C.mix(words + (k + 1).astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    return C.mix(np.add.reduceat(words, first) + width.astype(np.uint64))


def shingle_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """``(hashes, ptr)``: the shingle hashes of each line, not yet distinct; lines come
    in the order of their bytes."""
    width = ends - starts
    count = np.maximum(width - SHINGLE + 1, 1)
    ptr = np.concatenate([[0], np.cumsum(count)])
    # eight bytes are one integer; the mixer is one to one, so equal hashes are equal shingles
    grams = np.ndarray(max(len(b) - SHINGLE + 1, 0), "<u8", b, 0, (1,)) * _U(0x9E3779B97F4A7C15)
    grams ^= grams >> _U(32)
    grams *= _U(0xD6E8FEB86659FD93)
    grams ^= grams >> _U(29)
    edge = np.zeros(len(b) + 1, np.int8)                       # 1 where a shingle of a line may start
    long = width >= SHINGLE
    edge[starts[long]] += 1
    edge[starts[long] + count[long]] -= 1
    inside = np.cumsum(edge[:len(grams)], dtype=np.int8).view(bool)
    out = np.empty(ptr[-1], np.uint64)
    few = np.flatnonzero(~long)
    if len(few):
        wide = np.ones(ptr[-1], bool)
        wide[ptr[few]] = False
        out[wide] = grams[inside]
        out[ptr[few]] = line_hashes(b, starts[few], ends[few])
    else:
        out[:] = grams[inside]
    return out, ptr


def signatures(hashes: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """One-permutation MinHash, shape (lines, BINS): the smallest hash of each bin;
    an empty bin takes the next full one's, salted by the distance."""
    lines = len(ptr) - 1
    sig = np.full(lines * BINS, ~_U(0))
    slot = np.repeat(np.arange(lines), np.diff(ptr)) * BINS + (hashes >> _U(58)).astype(np.int64)
    np.minimum.at(sig, slot, hashes)
    sig = sig.reshape(lines, BINS)
    full = sig != ~_U(0)
    far = np.zeros(sig.shape, np.uint64)
    gaps = np.flatnonzero(~full.all(1))
    if len(gaps):
        place = np.where(full[gaps], np.arange(BINS, dtype=np.int16), np.int16(2 * BINS))
        place = np.concatenate([place, place + np.int16(BINS)], 1)          # bins go round
        follow = np.minimum.accumulate(place[:, ::-1], 1)[:, ::-1][:, :BINS].astype(np.int64)
        far[gaps] = follow - np.arange(BINS)
        sig[gaps] = np.take_along_axis(sig[gaps], follow % BINS, 1)
    return sig + far * _U(0x9E3779B97F4A7C15)


_SALTS = C.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def salted_minima(hashes: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """MinHash of independent rows, shape (lines, BANDS * ROWS): the smallest hash under
    each salt; no line is empty."""
    out = np.empty((len(ptr) - 1, len(_SALTS)), np.uint64)
    lo = 0
    while lo < len(out):             # pieces that stay in the processor's cache
        hi = max(lo + 1, int(np.searchsorted(ptr, ptr[lo] + 16_384, "right")) - 1)
        own, first = hashes[ptr[lo]:ptr[hi]], ptr[lo:hi] - ptr[lo]
        for i, salt in enumerate(_SALTS):
            out[lo:hi, i] = np.minimum.reduceat((own ^ salt) * _U(0xD6E8FEB86659FD93), first)
        lo = hi
    return out


def line_keys(hashes: np.ndarray, ptr: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Band keys of lines with ``n`` distinct shingles, shape (lines, 2 * BANDS): by salted
    minima, then by bins; 0 where a line has no key. Sets of similarity 0.8 differ in
    size by a quarter at most, so they have the first in common or the second."""
    out = np.zeros((len(n), 2 * BANDS), np.uint64)
    for at, use, sig_of, seed in ((0, 4 * n < 5 * FEW, salted_minima, BANDS), (BANDS, n >= FEW, signatures, 0)):
        some = np.flatnonzero(use)
        if len(some):
            own = np.concatenate([[0], np.cumsum(np.diff(ptr)[some])])
            out[some, at:at + BANDS] = band_keys(sig_of(hashes[np.repeat(use, np.diff(ptr))], own), seed)
    return out


def band_keys(sig: np.ndarray, seed: int = 0) -> np.ndarray:
    """Keys of the bands, shape (lines, BANDS); rows of a band lie far apart."""
    out = np.empty((len(sig), BANDS), np.uint64)
    for band in range(BANDS):
        h = np.full(len(sig), _U(seed + band + 1))
        for r in range(ROWS):
            h = C.mix(h * _U(0x9E3779B97F4A7C15) + sig[:, (band + r * BANDS) % BINS])
        out[:, band] = h
    return out


def _lines(rows: pa.Table):
    """Per chunk of a group: bytes, spans, order key (row in group), line hash."""
    for lo, raw, offs in C.chunks(rows.column("text")):
        b, s, e, row, no = normalised_lines(raw, offs)
        if len(s):
            yield b, s, e, lo + row, no, line_hashes(b, s, e)


def _fresh(h: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """First place of each line hash that ``seen`` (sorted) does not hold."""
    u, at = np.unique(h, return_index=True)
    return np.sort(at[~C.lookup(u, seen)[1]])


def _signed(key, tab):
    """``(g, blob)``: the distinct lines of a group with set size and band keys. They are made
    here once; asking for partners and taking the answers both read them."""
    C.worker_store("hashes", dict)               # caches of an earlier stage's operator go
    seen, lines, sizes, keys = np.empty(0, np.uint64), [], [], []
    for b, s, e, _, _, h in _lines(C.group_rows(tab)):
        new = _fresh(h, seen)
        seen = C.distinct(np.concatenate([seen, h]))
        if len(new):
            hashes, ptr = shingle_hashes(b, s[new], e[new])
            n = distinct_counts(hashes, ptr)
            lines.append(h[new])
            sizes.append(n)
            keys.append(line_keys(hashes, ptr, n))
    if not lines:
        return _SIGNED.empty_table()
    k = np.concatenate(keys)
    ends = np.concatenate([[0], np.cumsum((k != 0).sum(1))])
    return _blob(key, np.concatenate(lines), np.concatenate(sizes), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(C.signed(k[k != 0]))))


def _blob(key, line: np.ndarray, n: np.ndarray, keys: pa.ListArray) -> pa.Table:
    """Lines of a group as one row ``(g, blob)``."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _LINE) as stream:
        stream.write_table(pa.table([pa.array(C.signed(line)), pa.array(n.astype(np.int32)), keys], schema=_LINE))
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], schema=_SIGNED)


def _group_values(rows: pa.Table):
    """Keys of a group's lines; equal lines: the hash of the whole line is a key too."""
    return np.unique(np.concatenate([C.mix(_u64(rows.column("line"))), _u64(C.flat(rows.column("keys")).values)]), return_counts=True)


def _u64(col) -> np.ndarray:
    return col.to_numpy().view(np.uint64)


_SIGNED = pa.schema([("g", pa.int32()), ("blob", pa.binary())])
_LINE = pa.schema([("line", pa.int64()), ("n", pa.int32()), ("keys", pa.list_(pa.int64()))])
_CAND = pa.schema([("g", pa.int32()), ("line", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int32()), ("no", pa.int32()),
                   ("n", pa.int32()), ("keys", pa.list_(pa.int64())), ("payload", pa.binary())])


def linking_keys(signed: pa.Table, shared: np.ndarray, freq: np.ndarray):
    """``(line, n, keys)`` of those of a group's signed lines that have a partner, ordered by
    line hash, with the keys that other texts have too. A key that occurs as often
    as its line comes from copies of that line alone."""
    line = _u64(signed.column("line"))
    lists = C.flat(signed.column("keys"))
    keys, ptr = _u64(lists.values), lists.offsets.to_numpy()
    at, copied = C.lookup(C.mix(line), shared)
    pos, hit = C.lookup(keys, shared)
    if len(freq):
        hit &= freq[pos] > np.repeat(np.where(copied, freq[at], 1), np.diff(ptr))
    ends = np.concatenate([[0], np.cumsum(hit)])[ptr]
    order = np.argsort(line)
    order = order[(copied | (np.diff(ends) > 0))[order]]
    own = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(C.signed(keys[hit])))
    return line[order], signed.column("n").to_numpy()[order], own.take(pa.array(order))


def _linking(key, left, right):
    """``(g, blob)`` like ``_signed`` of the lines with a partner and their linking keys."""
    if not left.num_rows or not right.num_rows:
        return _SIGNED.empty_table()
    return _blob(key, *linking_keys(C.group_rows(left), *C.read_answers(right)))


def distinct_counts(hashes: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """How many distinct values each ``hashes[ptr[i]:ptr[i + 1]]`` has: one sort of all
    lines' values, each under its line's number."""
    lines = len(ptr) - 1
    bits = max(1, int(lines).bit_length())
    line = np.repeat(np.arange(lines, dtype=np.uint64), np.diff(ptr))
    v = np.sort((line << _U(64 - bits)) | (hashes >> _U(bits)))
    new = np.concatenate([[True], v[1:] != v[:-1]])
    return np.bincount((v[new] >> _U(64 - bits)).astype(np.int64), minlength=lines)


def _candidates(key, left, right):
    """The lines of a group with a shared key, once per text: first place, set size,
    band keys shared with other texts and, if there are any, normalised text."""
    if not left.num_rows or not right.num_rows:
        return _CAND.empty_table()
    linking = C.group_rows(right)
    line, n, keys = _u64(linking.column("line")), linking.column("n").to_numpy(), C.flat(linking.column("keys"))
    has = np.diff(keys.offsets.to_numpy()) > 0
    if not len(line):
        return _CAND.empty_table()
    rows = C.group_rows(left)
    ids = C.id_array(rows.column("doc_id"))
    parts = []
    for b, s, e, row, no, h in _lines(rows):
        which, found = C.lookup(h, line)
        found = np.flatnonzero(found)
        place = found[np.lexsort((no[found], row[found], ids[row[found]]))]
        u, at = np.unique(which[place], return_index=True)
        if not len(u):
            continue
        at = place[at]
        text = b.tobytes()
        parts.append((u, ids[row[at]], row[at], no[at],
                      [text[x:y] if z else None for x, y, z in zip(s[at].tolist(), e[at].tolist(), has[u].tolist())]))
    # of a text that several chunks hold, the first place
    u, doc, row, no = (np.concatenate([p[i] for p in parts]) for i in range(4))
    payload = pa.array([x for p in parts for x in p[4]], pa.binary())
    order = np.lexsort((no, row, doc, u))
    order = order[np.diff(u[order], prepend=-1) != 0]
    u = u[order]
    return pa.table([pa.array(np.full(len(u), key[0].as_py(), np.int32)), pa.array(C.signed(line[u])), pa.array(doc[order]),
                     pa.array(row[order].astype(np.int32)), pa.array(no[order].astype(np.int32)), pa.array(n[u].astype(np.int32)),
                     keys.take(pa.array(u)), payload.take(pa.array(order))], schema=_CAND)


def line_set(payload: bytes) -> np.ndarray:
    """Sorted distinct shingle hashes of one normalised line."""
    b = np.frombuffer(payload, np.uint8)
    return np.unique(shingle_hashes(b, np.array([0]), np.array([len(b)]))[0])


def line_values(payloads: list[bytes]):
    """``(hashes, ptr)``: the shingle hashes of many normalised lines, not yet distinct."""
    ends = np.cumsum([len(x) + 1 for x in payloads]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return shingle_hashes(np.frombuffer(b"\n".join(payloads) + b"\n", np.uint8), starts, ends)


def dedup_lines(docs: DataFrame, counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """``docs`` with duplicate lines taken out of ``text`` and two more columns:
    non-blank lines before and lines removed (named by ``counts``)."""
    if set(counts) & set(docs.columns):
        raise ValueError(f"docs already has a column named like one of {counts}")
    spark = docs.sparkSession
    C.prepare(spark)
    groups = C.group_count(docs)
    packed = C.text_groups(docs, groups)
    # dealt out anew, so that both steps that read the signed lines share one exchange
    signed = packed.groupBy("g").applyInArrow(_signed, "g int, blob binary").repartition("g")
    shared = C.shared_hashes(signed, _group_values, groups, C.GROUP_BYTES // 25)
    linking = signed.groupBy("g").cogroup(shared.groupBy("g")).applyInArrow(_linking, "g int, blob binary")
    cand = C.written(packed.groupBy("g").cogroup(linking.groupBy("g")).applyInArrow(
        _candidates, "g int, line long, doc_id long, row int, no int, n int, keys array<long>, payload binary"))
    C.release(spark)
    place = F.struct("doc_id", "row", "no", "g")
    sets = C.written(cand.where(F.size("keys") > 0).groupBy(F.col("line").alias("sid"))
                     .agg(F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("payload").alias("payload")))
    comp = C.link_components(sets, C.jaccard_80, line_values)
    of = C.cut(cand.select("g", "line", "doc_id", "row", "no").join(comp.withColumnRenamed("sid", "line"), "line", "left")
               .withColumn("comp", F.coalesce("comp", "line")))
    keeper = of.groupBy("comp").agg(F.min(place).alias("k"))
    verdict = of.join(keeper, "comp").select("g", "line", (F.struct("doc_id", "row", "no", "g") == F.col("k")).alias("keeps"))

    schema = StructType([*docs.schema.fields])
    for c in counts:
        schema = schema.add(c, LongType())

    def strip(left, right):
        return _strip(C.group_rows(left), right, counts)

    return packed.groupBy("g").cogroup(verdict.groupBy("g")).applyInArrow(strip, schema)


def _strip(rows: pa.Table, verdict: pa.Table, counts: tuple[str, str]) -> pa.Table:
    """Rewrite the texts of one group. A line of the group stays if it is the first
    of its text here and the verdict, if there is one, says that it keeps."""
    line = verdict.column("line").to_numpy().view(np.uint64)
    keeps = verdict.column("keeps").to_numpy(zero_copy_only=False)
    order = np.argsort(line)
    line, keeps = line[order], keeps[order]
    ids = C.id_array(rows.column("doc_id"))
    parts = list(_lines(rows))
    none = np.empty(0, np.int64)
    h = np.concatenate([np.empty(0, np.uint64), *[p[5] for p in parts]])
    row = np.concatenate([none, *[p[3] for p in parts]]).astype(np.int64)
    no = np.concatenate([none, *[p[4] for p in parts]]).astype(np.int64)
    stay = np.zeros(len(h), bool)
    place = np.lexsort((no, row, ids[row])) if len(h) else none
    u, at = np.unique(h[place], return_index=True)
    at = place[at]
    pos, found = C.lookup(u, line)
    stay[at] = ~found | (keeps[pos] if len(keeps) else True)
    gone = np.flatnonzero(~stay)
    removed, lines = np.bincount(row[gone], minlength=len(ids)), np.bincount(row, minlength=len(ids))
    drop: dict[int, set] = {}
    for i in gone:
        drop.setdefault(int(row[i]), set()).add(int(no[i]))
    texts = rows.column("text").to_pylist()
    for r, numbers in drop.items():
        left = [x for i, x in enumerate(texts[r].split("\n")) if i not in numbers]
        texts[r] = "\n".join(left) if any(x.strip() for x in left) else ""
    out = {c: rows.column(c) for c in rows.column_names}
    out["text"] = pa.array(texts, rows.column("text").type)
    out[counts[0]], out[counts[1]] = pa.array(lines.astype(np.int64)), pa.array(removed.astype(np.int64))
    return pa.table(out)


def drop_duplicate_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns it has, without duplicate lines; a document that
    lost all of its lines goes, since every line of it stays elsewhere."""
    lines, removed = "line_dedup:lines", "line_dedup:removed"
    out = dedup_lines(docs, (lines, removed))
    gone = (F.col(f"`{removed}`") > 0) & (F.col(f"`{removed}`") == F.col(f"`{lines}`"))
    return out.where(~gone).select(*[F.col(f"`{c}`") for c in docs.columns])
