"""Suffix-array dedup: bytes covered by a 50-byte string that also starts in a
document with a smaller doc_id are removed; matches never cross documents.

Suffix arrays are built per shard by induced sorting. What has to meet in a shard
is found first: every 50-byte window has a minimiser (the smallest hash of its
24-byte strings), equal windows have equal minimisers, and groups of documents
learn which minimisers occur at least twice anywhere (``common.shared_hashes``).
Only runs of windows with such a minimiser travel, once per group and distinct
content, to the shard of the minimiser (of its mixed hash: a minimum of many hashes is
not uniform). A run is cut after ``RUN_WINDOWS`` windows, so runs of periodic text are as
short as others, and the number of runs bounds bytes. Windows of a minimiser with more than
``HOT_RUNS`` runs travel one by one to the shard of their own hash: its surroundings
may all differ, and would fill one shard. The count is that of all groups, so equal
windows travel alike.

A shard concatenates its distinct runs, classifies suffixes as S or L, sorts the
leftmost-smaller (LMS) substrings by induction, names them, sorts the string of
names (recursively, by doubling of ranks) and induces the whole array; bucket by
bucket, so every step is one vector operation. Permuted common prefixes come from
their irreducible values. Neighbours with a common prefix of 50 bytes or more
share a window; the smallest doc_id of each class goes back to the groups, which
mark the bytes.

Defined results: null or empty text has no bytes (nothing removed); texts under 50
bytes lose nothing; rows with equal doc_id never remove each other's bytes, nor
does a document its own repeats; a null doc_id counts as the largest and is
returned as null; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from pricelab.llm import common as C

LENGTH = 50
GRAM = 24
SHARD_BYTES = 1 << 19                            # of one suffix array, unless one minimiser has more
RUN_WINDOWS = LENGTH - GRAM + 1
HOT_RUNS = (2 << 20) // (RUN_WINDOWS + LENGTH - 1)    # so many distinct runs of one minimiser stay together
_U = np.uint64


# ------------------------------------------------------------------ suffix array

def classify(t: np.ndarray) -> np.ndarray:
    """True where the suffix is S-type (smaller than the next one); the last is S."""
    n = len(t)
    differs = np.append(t[1:] != t[:-1], True)
    nxt = np.minimum.accumulate(np.where(differs, np.arange(n, dtype=np.int32), np.int32(n))[::-1])[::-1]
    s = np.ones(n, bool)
    j = nxt[:-1]
    s[:-1] = t[j] < t[np.minimum(j + 1, n - 1)]
    s[n - 1] = True
    return s


def _spread(sa, prev, ch, fill, step):
    """Place ``prev`` (in order) at the fill positions of their buckets ``ch``."""
    order = np.argsort(ch, kind="stable")
    c = ch[order]
    first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    run = np.diff(np.append(first, len(c)))
    sa[fill[c] + step * (np.arange(len(c)) - np.repeat(first, run))] = prev[order]
    fill[c[first]] += step * run


def induce(t: np.ndarray, is_s: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """Suffix order induced from ``lms`` positions in their order."""
    n = len(t)
    size = np.bincount(t, minlength=k)
    end = np.cumsum(size)
    start = end - size
    sa = np.full(n, -1, np.int32)
    by = np.argsort(t[lms], kind="stable")
    seeds = lms[by]
    cut = np.searchsorted(t[seeds], np.arange(k + 1))
    head = start.copy()
    for c in np.flatnonzero(size):
        done = start[c]
        seeds_left = True
        while True:
            if done < head[c]:
                wave, done = sa[done:head[c]], head[c]
            elif seeds_left:
                wave, seeds_left = seeds[cut[c]:cut[c + 1]], False
            else:
                break
            prev = wave[wave > 0] - 1
            prev = prev[~is_s[prev]]
            if len(prev):
                _spread(sa, prev, t[prev], head, 1)
    l_end = head                                   # L-type suffixes are start[c]:l_end[c]
    tail = end - 1
    sa[0] = n - 1                                  # the sentinel
    for c in np.flatnonzero(size)[::-1]:
        done = end[c] - 1
        l_left = True
        while True:
            if done > tail[c]:
                wave, done = sa[tail[c] + 1:done + 1][::-1], tail[c]
            elif l_left:
                wave, l_left = sa[start[c]:l_end[c]][::-1], False
            else:
                break
            prev = wave[wave > 0] - 1
            prev = prev[is_s[prev]]
            if len(prev):
                _spread(sa, prev, t[prev], tail, -1)
    sa[0] = n - 1
    return sa


def sort_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names, by recursive doubling of ranks."""
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64)
    step, n = 1, len(names)
    while n and rank.max() + 1 < n:
        nxt = np.zeros(n, np.int64)
        nxt[:n - step] = rank[step:] + 1
        rank = np.unique(rank * (n + 1) + nxt, return_inverse=True)[1].astype(np.int64)
        step *= 2
    return np.argsort(rank, kind="stable")


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of ``t`` (values below ``k``; the last, 0, is unique)."""
    n = len(t)
    is_s = classify(t)
    is_lms = np.concatenate([[False], is_s[1:] & ~is_s[:-1]])
    lms = np.flatnonzero(is_lms).astype(np.int32)
    if len(lms) < 2:
        return induce(t, is_s, lms if len(lms) else np.array([n - 1]), k)
    sa = induce(t, is_s, lms, k)
    order = sa[is_lms[sa]]                         # LMS substrings, sorted
    # names: equal to the one before if bytes and length are
    until = np.append(lms[1:], n - 1)
    length = np.zeros(n, np.int32)
    length[lms] = until - lms + 1
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    live, depth = np.flatnonzero(same), 0
    while len(live):
        live = live[length[a[live]] > depth]
        bad = t[a[live] + depth] != t[b[live] + depth]
        same[live[bad]] = False
        live = live[~bad]
        depth += 1
    name = np.zeros(n, np.int32)
    name[order] = np.concatenate([[0], np.cumsum(~same)])
    del sa, order, length, until, a, b, same, live
    return induce(t, is_s, lms[sort_names(name[lms])], k)


def permuted_lcp(t: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of each position's suffix with its predecessor in ``sa``.

    Irreducible values (the bytes before differ) are compared directly, in steps of
    one byte over all that still match, up to the next irreducible position plus
    ``cap``; the others are one less than the value to their left."""
    n = len(t)
    phi = np.full(n, -1, np.int32)
    phi[sa[1:]] = sa[:-1]
    i = np.arange(n, dtype=np.int32)
    left = (i > 0) & (phi > 0)
    reducible = np.zeros(n, bool)
    x = np.flatnonzero(left)
    reducible[x] = t[x - 1] == t[phi[x] - 1]
    irr = np.flatnonzero(~reducible)
    need = np.diff(np.append(irr, n)) + cap        # values beyond this decide nothing
    value = np.zeros(len(irr), np.int32)
    live = np.flatnonzero(phi[irr] >= 0)
    depth = 0
    while len(live):
        p, q = irr[live] + depth, phi[irr[live]] + depth
        ok = (p < n) & (q < n)
        ok[ok] = t[p[ok]] == t[q[ok]]
        live = live[ok]
        depth += 1
        value[live] = depth
        live = live[need[live] > depth]
    size = np.diff(np.append(irr, n))
    return np.maximum(np.repeat(value, size) - (i - np.repeat(irr.astype(np.int32), size)), 0)


def smallest_owner(content: np.ndarray, lengths: np.ndarray, docs: np.ndarray, width: int = LENGTH) -> np.ndarray:
    """For the windows of all runs (concatenated, ``lengths - width + 1`` each): the
    smallest of ``docs`` over all runs that hold the same window."""
    runs = len(lengths)
    off = np.concatenate([[0], np.cumsum(lengths)])
    t = np.ones(len(content) + runs + 1, np.int32)          # 1 separates runs, 0 ends
    place = off[:-1] + np.arange(runs)
    at = np.repeat(place - off[:-1], lengths) + np.arange(len(content))
    t[at] = content.astype(np.int32) + 2
    t[-1] = 0
    del at
    sa = suffix_array(t, 258)
    lcp = permuted_lcp(t, sa, width)
    count = lengths - width + 1
    starts = np.concatenate([[0], np.cumsum(count)])
    window = np.full(len(t), -1, np.int32)
    window[np.repeat(place - starts[:-1], count) + np.arange(starts[-1])] = np.arange(starts[-1])
    owner = np.repeat(docs, count)
    sorted_windows = window[sa]
    new = lcp[sa] < width
    keep = sorted_windows >= 0
    group = np.cumsum(new)[keep]
    w = sorted_windows[keep]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    low = np.minimum.reduceat(owner[w], first)
    out = np.empty(starts[-1], np.int64)
    out[w] = np.repeat(low, np.diff(np.append(first, len(w))))
    return out


# ------------------------------------------------------------------------ groups

def window_runs(b: np.ndarray, offs: np.ndarray):
    """``(minimiser, start, end, row)`` of the runs of up to ``RUN_WINDOWS`` windows of one row
    with one minimiser; ``start:end`` are the bytes the run covers."""
    g = C.gram_hashes(b, GRAM)
    span = LENGTH - GRAM + 1
    low, width = g, 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:]) if len(low) > width else low[:0]
        width *= 2
    rest = span - width
    if rest:
        low = np.minimum(low[:-rest], low[rest:]) if len(low) > rest else low[:0]
    size = np.diff(offs)
    count = np.maximum(size - LENGTH + 1, 0)
    total = int(count.sum())
    if not total:
        e = np.empty(0, np.int64)
        return np.empty(0, np.uint64), e, e, e
    row = np.repeat(np.arange(len(size)), count)
    at = np.repeat(offs[:-1] - (np.cumsum(count) - count), count) + np.arange(total)
    m = low[at]
    first = np.flatnonzero(np.concatenate([[True], (m[1:] != m[:-1]) | (row[1:] != row[:-1])]))
    size = np.diff(np.append(first, total))
    pieces = -(-size // RUN_WINDOWS)
    step = (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * RUN_WINDOWS
    end = np.repeat(first + size, pieces)
    first = np.repeat(first, pieces) + step
    last = np.minimum(first + RUN_WINDOWS, end) - 1
    return C.mix(m[first]), at[first], at[last] + LENGTH, row[first]


def _group_values(rows: pa.Table):
    parts = [window_runs(raw, offs)[0] for _, raw, offs in C.chunks(rows.column("text"))]
    m = np.concatenate([np.empty(0, np.uint64), *parts])
    return np.unique(m, return_counts=True)


def single_windows(raw: np.ndarray, m: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, hot: np.ndarray):
    """The runs with each ``hot`` one cut into its windows, keyed by their own hashes."""
    count = (end - start - LENGTH + 1)[hot]
    at = np.repeat(start[hot] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    key = C.span_hashes(raw, at, at + LENGTH)
    return (np.concatenate([m[~hot], key]), np.concatenate([start[~hot], at]), np.concatenate([end[~hot], at + LENGTH]),
            np.concatenate([row[~hot], np.repeat(row[hot], count)]))


def _shared_runs(rows: pa.Table, shared: np.ndarray, freq: np.ndarray, hot_runs: int):
    """The runs with a shared minimiser (hot ones by window): occurrences (row, byte start
    in its row, index of its content) and distinct contents ordered by (minimiser, hash)."""
    ids = C.id_array(rows.column("doc_id"))
    occ_row, occ_at, occ_m, occ_h, occ_len, parts = [], [], [], [], [], []
    for lo, raw, offs in C.chunks(rows.column("text")):
        m, s, e, row = window_runs(raw, offs)
        pos, found = C.lookup(m, shared)
        hit = np.flatnonzero(found)
        if not len(hit):
            continue
        m, s, e, row = m[hit], s[hit], e[hit], row[hit]
        hot = freq[pos[hit]] > hot_runs
        if hot.any():
            m, s, e, row = single_windows(raw, m, s, e, row, hot)
        occ_row.append(row + lo)
        occ_at.append(s - offs[row])
        occ_m.append(m)
        occ_h.append(C.span_hashes(raw, s, e))
        occ_len.append(e - s)
        size = e - s
        parts.append(raw[np.repeat(s - (np.cumsum(size) - size), size) + np.arange(size.sum())])
    none, nou = np.empty(0, np.int64), np.empty(0, np.uint64)
    row, at, length = (np.concatenate([none, *x]).astype(np.int64) for x in (occ_row, occ_at, occ_len))
    m, h = np.concatenate([nou, *occ_m]), np.concatenate([nou, *occ_h])
    content = np.concatenate([np.empty(0, np.uint8), *parts])
    off = np.concatenate([[0], np.cumsum(length)])
    order = np.lexsort((ids[row], h, m)) if len(m) else none
    new = np.concatenate([[True], (m[order][1:] != m[order][:-1]) | (h[order][1:] != h[order][:-1])]) if len(m) else np.empty(0, bool)
    index = np.empty(len(m), np.int64)
    index[order] = np.cumsum(new) - 1
    head = order[new]                              # the smallest id of each content
    size = length[head]
    body = content[np.repeat(off[head] - (np.cumsum(size) - size), size) + np.arange(size.sum())] if len(head) else content
    return ids, (row, at, index), (m[head], h[head], size, ids[row[head]], body)


_RUNS = pa.schema([("shard", pa.int32()), ("g", pa.int32()), ("minimisers", pa.binary()), ("lengths", pa.binary()), ("docs", pa.binary()), ("body", pa.binary())])
_RUNS_SQL = "shard int, g int, minimisers binary, lengths binary, docs binary, body binary"
_BACK = pa.schema([("g", pa.int32()), ("shard", pa.int32()), ("owners", pa.binary())])


def _sender(bits: int, hot_runs: int):
    def send(key, left, right):
        if not left.num_rows or not right.num_rows:
            return _RUNS.empty_table()
        _, _, (m, _, size, docs, body) = _shared_runs(C.group_rows(left), *C.read_answers(right), hot_runs)
        edges = np.searchsorted(m >> _U(64 - bits), np.arange((1 << bits) + 1).astype(np.uint64)) if bits else np.array([0, len(m)])
        off = np.concatenate([[0], np.cumsum(size)])
        out = {c: [] for c in _RUNS.names}
        for i in np.flatnonzero(np.diff(edges)):
            lo, hi = edges[i], edges[i + 1]
            row = (int(i), key[0].as_py(), C.pack_u64(m[lo:hi]), C.pack_raw(size[lo:hi]), C.pack_raw(docs[lo:hi]), C.pack_raw(body[off[lo]:off[hi]]))
            for c, v in zip(out, row):
                out[c].append(v)
        return pa.table(out, schema=_RUNS)

    return send


def _shard(key, tab):
    """Owners of all windows of one shard, answered per group in the order sent."""
    gs = tab.column("g").to_pylist()
    m = [C.unpack_u64(x) for x in tab.column("minimisers").to_pylist()]
    size = [C.unpack_raw(x, np.int64) for x in tab.column("lengths").to_pylist()]
    docs = [C.unpack_raw(x, np.int64) for x in tab.column("docs").to_pylist()]
    body = [C.unpack_raw(x, np.uint8) for x in tab.column("body").to_pylist()]
    part = np.repeat(np.arange(len(m)), [len(x) for x in m])
    m, size, docs, body = np.concatenate(m), np.concatenate(size), np.concatenate(docs), np.concatenate(body)
    off = np.concatenate([[0], np.cumsum(size)])
    h = C.span_hashes(body, off[:-1], off[1:])
    order = np.lexsort((docs, h, m))
    new = np.concatenate([[True], (m[order][1:] != m[order][:-1]) | (h[order][1:] != h[order][:-1])])
    index = np.empty(len(m), np.int64)
    index[order] = np.cumsum(new) - 1
    head = order[new]                              # distinct contents by minimiser, smallest doc
    s = size[head]
    owners = np.empty(int((s - LENGTH + 1).sum()), np.int64)
    w_off = np.concatenate([[0], np.cumsum(s - LENGTH + 1)])
    # a minimiser with one content only: all its windows have that content's owner
    border = np.flatnonzero(np.concatenate([[True], m[head][1:] != m[head][:-1]]))
    alone = np.repeat(np.diff(np.append(border, len(head))) == 1, np.diff(np.append(border, len(head))))
    owners[:] = np.repeat(docs[head], s - LENGTH + 1)
    # the others: suffix arrays over ranges of minimisers of bounded size; one minimiser stays whole
    many = np.flatnonzero(~alone)
    border = np.append(np.flatnonzero(np.concatenate([[True], m[head[many]][1:] != m[head[many]][:-1]])) if len(many) else [], len(many)).astype(np.int64)
    csum = np.concatenate([[0], np.cumsum(s[many])])
    lo = 0
    while lo < len(many):
        hi = border[max(np.searchsorted(csum[border], csum[lo] + SHARD_BYTES, "right") - 1, np.searchsorted(border, lo, "right"))]
        pick, n = head[many[lo:hi]], s[many[lo:hi]]
        text = body[np.repeat(off[pick] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        c = n - LENGTH + 1
        owners[np.repeat(w_off[many[lo:hi]] - (np.cumsum(c) - c), c) + np.arange(c.sum())] = smallest_owner(text, n, docs[pick])
        lo = hi
    out = {"g": [], "shard": [], "owners": []}
    count = size - LENGTH + 1
    for i, g in enumerate(gs):
        mine = np.flatnonzero(part == i)
        c = count[mine]
        at = np.repeat(w_off[index[mine]] - (np.cumsum(c) - c), c) + np.arange(c.sum())
        out["g"].append(g)
        out["shard"].append(key[0].as_py())
        out["owners"].append(C.pack_raw(owners[at]))
    return pa.table(out, schema=_BACK)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _mark(left, right, hot_runs: int):
    """Bytes, removed bytes and spans, and the rest's checksum of each row of a group."""
    if not left.num_rows:
        return _OUT.empty_table()
    rows = C.group_rows(left)
    back = sorted((s, o) for s, o in zip(right.column("shard").to_pylist(), right.column("owners").to_pylist()) if o is not None)
    answers = C.read_answers(right.filter(right.column("keys").is_valid()))
    ids, (row, at, index), (_, _, size, _, _) = _shared_runs(rows, *answers, hot_runs)
    owners = np.concatenate([np.empty(0, np.int64), *[C.unpack_raw(o, np.int64) for _, o in back]])
    w_off = np.concatenate([[0], np.cumsum(size - LENGTH + 1)])
    # all windows that start in a document with a smaller id, as places in their rows
    count = (size - LENGTH + 1)[index]
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    dup = owners[np.repeat(w_off[index], count) + inside] < np.repeat(ids[row], count)
    dup_row, dup_at = np.repeat(row, count)[dup], (np.repeat(at, count) + inside)[dup]
    order = np.argsort(dup_row, kind="stable")
    dup_row, dup_at = dup_row[order], dup_at[order]
    out = {c: [] for c in _OUT.names}
    for lo, raw, offs in C.chunks(rows.column("text")):
        n_rows = len(offs) - 1
        a, z = np.searchsorted(dup_row, [lo, lo + n_rows])
        place = dup_at[a:z] + offs[dup_row[a:z] - lo]
        edge = np.bincount(place, minlength=len(raw) + 1) - np.bincount(place + LENGTH, minlength=len(raw) + 1)
        gone = np.cumsum(edge[:len(raw)]) > 0
        begins = gone & ~np.concatenate([[False], gone[:-1]])[:len(raw)]
        begins[offs[:-1][offs[:-1] < len(raw)]] |= gone[offs[:-1][offs[:-1] < len(raw)]]
        removed, spans = (np.diff(np.concatenate([[0], np.cumsum(x)])[offs]) for x in (gone, begins))
        for r in range(n_rows):
            text = raw[offs[r]:offs[r + 1]]
            if removed[r]:
                text = text[~gone[offs[r]:offs[r + 1]]]
            for c, v in zip(out, (int(ids[lo + r]), int(offs[r + 1] - offs[r]), int(removed[r]), int(spans[r]), hashlib.sha256(text.tobytes()).hexdigest())):
                out[c].append(v)
    return pa.table(out, schema=_OUT)


def dedup_substrings(docs: DataFrame, hot_runs: int = HOT_RUNS) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256. The windows of a minimiser
    with more than ``hot_runs`` runs are spread; the result does not depend on it."""
    C.prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    groups = C.group_count(docs)
    packed = C.text_groups(docs, groups)
    shared = C.shared_hashes(packed, _group_values, groups, C.GROUP_BYTES // 13)
    bits = max(0, (2 * groups - 1).bit_length())
    sent = packed.groupBy("g").cogroup(shared.groupBy("g")).applyInArrow(_sender(bits, hot_runs), _RUNS_SQL)
    owners = sent.groupBy("shard").applyInArrow(_shard, "g int, shard int, owners binary")
    none = F.lit(None)
    answers = (shared.select("g", none.cast("int").alias("shard"), "keys", "freq", none.cast("binary").alias("owners"))
               .union(owners.select("g", "shard", none.cast("binary").alias("keys"), none.cast("binary").alias("freq"), "owners")))

    def mark(left, right):
        return _mark(left, right, hot_runs)

    out = packed.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(mark, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(int(C.NO_ID))))
