"""The training-data operators against brute-force versions, and their edge cases."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from pricelab.llm import (common as C, decontam, langid, line_dedup, line_rules, ngram_join, packing, quality_lm, quotes,
                          suffix_dedup, toxicity)
from pricelab.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def real(spark):
    C.prepare(spark)
    df = spark.read.parquet(f"{SF}/documents.parquet")
    return df, df.collect()


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, an extra column."""
    base = " ".join(f"word{i}" for i in range(60))
    near = base.replace("word59", "other")
    rows = [(1, base), (2, base), (3, near), (4, None), (5, ""), (6, "   \n\n "), (7, "one two"), (8, "ONE  two"),
            (9, "x " * 60_000), (10, base + " Ünïcode ß"), (None, base), (11, "dup"), (11, "dup"), (12, "a" * 40), (13, "a" * 300)]
    return spark.createDataFrame([(i, t, None if i == 7 else "en", None, None, "row") for i, t in rows], DOCS + ", g string")


def empty(spark):
    return spark.createDataFrame([], DOCS)


def components(ids, linked):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: find(i) for i in ids}


# ------------------------------------------------------------------------- 10

def shingles(text):
    w = SPACE.findall(low(text))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near(a, b):
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)


def test_ngram_join_equals_brute_force(spark, real):
    df, rows = real
    sets = {r.doc_id: shingles(r.text) for r in rows}
    want = components(sorted(sets), lambda a, b: near(sets[a], sets[b]))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join_components(df).collect()}
    assert got == {i: (len(sets[i]), c) for i, c in want.items()}


def test_ngram_join_edges(spark):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join_components(odd(spark)).collect()]
    by = {i: (n, c) for i, n, c in got if i is not None}
    assert len(got) == 15 and by[2] == (56, 1) and by[3][1] == 1 and by[10][1] == 1
    assert by[4] == (0, 4) and by[5] == (0, 5) and by[6] == (0, 6)
    assert by[8] == (1, 7) and by[9] == (1, 9) and by[11] == (1, 11)
    assert [(n, c) for i, n, c in got if i is None] == [(56, 1)]
    assert ngram_join.join_components(empty(spark)).count() == 0


def test_ngram_join_rest_round_and_large_group(spark):
    """A chain whose ends are not similar, and a large group of near copies; small tiles."""
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(400)]
    docs, cur = [], words[:200]
    for i in range(12):
        docs.append((100 + i, " ".join(cur)))
        cur = cur[8:] + words[200 + 8 * i:208 + 8 * i]
    copy = [f"c{i}" for i in range(120)]
    for i in range(300):
        c = list(copy)
        c[int(rng.integers(0, 120))] = f"x{i}"
        docs.append((1000 + i, " ".join(c)))
    sets = {i: shingles(t) for i, t in docs}
    want = components(sorted(sets), lambda a, b: near(sets[a], sets[b]))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.join_components(df).collect()}
    assert got == want


def test_tile_links_join_what_all_pairs_join(spark, monkeypatch):
    """One key over blocks of three rows, of few values, or uncut: the verified links
    join what all similar pairs join, and stay fewer than the rows of the tiles."""
    sets = [np.sort(C.mix(np.arange(a, a + n, dtype=np.uint64))) for a, n in [(0, 20), (1, 20), (2, 21), (3, 20), (6, 20), (200, 20), (201, 19), (0, 16), (0, 24), (400, 1), (400, 1)]]
    frame = spark.createDataFrame([(i, bytearray(C.pack_u64(s))) for i, s in enumerate(sets)], "sid long, payload binary")
    # a second key of some of the sets, so that pairs meet twice, and one of a pair of strangers
    keys = {7: range(len(sets)), 8: [0, 1, 2, 5, 6], 9: [0, 9]}
    rows = [(k, i, i, len(own), sum(len(sets[x]) for x in own), 0, len(sets[i])) for k, own in keys.items() for i in own]
    rest = spark.createDataFrame(rows, "key long, sid long, comp long, size long, weight long, leader long, n int")
    near = lambda a, b: C.jaccard_80(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))
    want = components(range(len(sets)), near)

    def to_values(payloads):
        out = [C.unpack_u64(x) for x in payloads]
        return np.concatenate(out), np.concatenate([[0], np.cumsum([len(x) for x in out])])

    for tile, values, table in ((3, C.TILE_VALUES, 0), (2048, 40, 6000), (2048, C.TILE_VALUES, 6000)):
        monkeypatch.setattr(C, "TILE_VALUES", values)
        monkeypatch.setattr(C, "PAIR_TABLE", table)
        links = {(r.a, r.b) for r in C.tile_links(rest, frame, to_values, C.jaccard_80, tile).collect()}
        assert all(near(a, b) for a, b in links)
        assert components(range(len(sets)), lambda a, b: (a, b) in links or (b, a) in links) == want
        if tile == 2048 and values > 40:
            assert len(links) <= sum(len(own) - 1 for own in keys.values())


def test_line_hashes():
    """Equal lines have equal hashes wherever they stand; different ones differ."""
    rng = np.random.default_rng(5)
    lines = [bytes(rng.integers(97, 99, n, np.uint8)) for n in [*range(1, 40), *range(1, 40), 1000]]
    lines += [b"a" * 16 + b"b" * 8, b"b" * 8 + b"a" * 16, b"a" * 8, b"a" * 9, b"a" * 7, b"a" * 7 + b"\0"]
    got = {}
    for order in (range(len(lines)), rng.permutation(len(lines))):
        use = [lines[i] for i in order]
        ends = np.cumsum([len(x) + 1 for x in use]) - 1
        starts = ends - [len(x) for x in use]
        for x, h in zip(use, line_dedup.line_hashes(np.frombuffer(b"\n".join(use) + b"\n", np.uint8), starts, ends).tolist()):
            assert got.setdefault(x, h) == h
    assert len(set(got.values())) == len(set(lines))


def test_many_sets_at_once():
    rng = np.random.default_rng(3)
    lines = [rng.choice([b"ab ", b"word ", b"x", b"long piece of text "], k).tolist() for k in (1, 2, 9, 40, 700)]
    lines = [b"".join(x) for x in lines] + [b"z", b"z" * 500]
    hashes, ptr = line_dedup.line_values(lines)
    sets = [line_dedup.line_set(x) for x in lines]
    assert [np.unique(hashes[a:b]).tolist() for a, b in zip(ptr, ptr[1:])] == [x.tolist() for x in sets]
    assert line_dedup.distinct_counts(hashes, ptr).tolist() == [len(x) for x in sets]
    for got, values in zip(C.bitmaps(hashes, ptr, 4096), sets):
        marks = np.zeros(4096, bool)
        marks[[int(x) >> 52 for x in C.mix(values)]] = True
        assert got.tobytes() == np.packbits(marks).tobytes()


def test_keep_first(spark):
    out = ngram_join.keep_first(odd(spark))
    ids = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    assert ids == [1, 4, 5, 6, 7, 9, 11, 12, 13] and out.columns == odd(spark).columns


def test_ngram_join_null_and_repeated_ids(spark):
    """Rows without an id, and rows that share one, link by their texts only."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    docs = [(None, a), (None, a + " end"), (None, b), (None, c), (None, "  "), (7, b), (7, d), (7, d), (9, d + " end"), (3, c + " end")]
    df = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, lang string")
    got = sorted(map(tuple, ngram_join.join_components(df).collect()), key=str)
    want = [(None, 56, None), (None, 57, None), (None, 56, 7), (None, 56, 3), (None, 0, None), (7, 56, 7), (7, 56, 7), (7, 56, 7), (9, 57, 7), (3, 57, 3)]
    assert got == sorted(want, key=str)
    kept = [(r.doc_id, r.text[:1]) for r in ngram_join.keep_first(df).collect()]
    assert sorted(kept, key=str) == sorted([(None, "a"), (None, " "), (7, "b"), (7, "d"), (3, "c")], key=str)


# -------------------------------------------------------------------------- 1

def contaminated(docs, items):
    win = collections.defaultdict(set)
    for i, t in items:
        w = PLAIN.findall(low(t))
        for a in range(len(w) - min(10, len(w)) + 1 if w else 0):
            win[tuple(w[a:a + min(10, len(w))])].add(str(i))
    out = []
    for d, t in docs:
        w, hit, its = PLAIN.findall(low(t)), set(), set()
        for n in {len(k) for k in win}:
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in win:
                    hit.update(range(a, a + n))
                    its |= win[tuple(w[a:a + n])]
        out.append((d, len(w), len(hit), len(its), hashlib.sha256(",".join(sorted(its)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast_rows", [10 ** 6, 0])
def test_decontamination_equals_brute_force(spark, real, broadcast_rows):
    df, rows = real
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    more = spark.createDataFrame([(901, "Ed the"), (902, "the and of in is a"), (903, None), (904, " . "), (905, "ed the"), (None, "of")], bench.schema)
    bench = bench.union(more)
    got = decontam.contamination(df, bench, broadcast_rows=broadcast_rows).collect()
    want = contaminated([(r.doc_id, r.text) for r in rows], [(r.item_id, r.text) for r in bench.collect() if r.item_id is not None])
    assert sorted(map(tuple, got), key=str) == want


def test_decontamination_edges(spark):
    bench = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(20, 35))), (2, "x x x")], "item_id long, text string")
    got = decontam.contamination(odd(spark).dropDuplicates(), bench).collect()
    assert len(got) == 14
    by = {r.doc_id: r for r in got}
    assert by[1].n_hit == 15 and by[1].n_items == 1 and by[4].n_words == 0 and by[9].n_hit == 60_000 and not by[7].contaminated
    kept = decontam.keep_uncontaminated(odd(spark), bench)
    assert kept.columns == odd(spark).columns and 9 not in {r.doc_id for r in kept.collect()}
    assert decontam.contamination(empty(spark), bench).count() == 0
    none = bench.limit(0)
    assert not decontam.contamination(odd(spark), none).where("contaminated").count()


@pytest.mark.parametrize("broadcast_rows", [10 ** 6, 0])
def test_decontamination_null_and_repeated_ids(spark, broadcast_rows):
    """Of rows without an id, or with one id, only those that share a window go."""
    bench = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(12)))], "item_id long, text string")
    bad = "see " + " ".join(f"w{i}" for i in range(12)) + " there"
    docs = [(None, bad), (None, "clean text"), (None, None), (7, bad), (7, "another clean text"), (8, "w1 w2")]
    df = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, lang string")
    got = decontam.contamination(df, bench, broadcast_rows=broadcast_rows)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=str) == contaminated(docs, [(1, " ".join(f"w{i}" for i in range(12)))])
    kept = [(r.doc_id, r.text) for r in decontam.keep_uncontaminated(df, bench).collect()]
    assert sorted(kept, key=str) == sorted([d for d in docs if d[1] != bad], key=str)


# -------------------------------------------------------------------------- 2

def norm(line):
    return re.sub(r"[\x09\x0b\x0c\x0d\x20]+", " ", low(line)).strip(" ").encode()


def expected_lines(docs):
    occ = [(d, i, norm(x)) for d, t in docs for i, x in enumerate((t or "").split("\n")) if norm(x)]
    sets = {k: {k[i:i + 8] for i in range(max(1, len(k) - 7))} for _, _, k in occ}
    comp = components(sorted(sets), lambda a, b: near(sets[a], sets[b]))
    seen, gone = set(), collections.defaultdict(set)
    for d, i, k in occ:
        if comp[k] in seen:
            gone[d].add(i)
        seen.add(comp[k])
    out = {}
    for d, t in docs:
        left = [x for i, x in enumerate((t or "").split("\n")) if i not in gone[d]]
        text = t if not gone[d] else ("\n".join(left) if any(x.strip() for x in left) else "")
        out[d] = (text, len(gone[d]), sum(1 for e in occ if e[0] == d))
    return out


def test_line_dedup_equals_brute_force(spark, real):
    df, rows = real
    few = sorted(rows, key=lambda r: r.doc_id)[:60]
    sub = spark.createDataFrame([(r.doc_id, r.text) for r in few], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed, r.n_lines) for r in line_dedup.dedup_lines(sub).collect()}
    assert got == expected_lines([(r.doc_id, r.text) for r in few])


def test_line_dedup_edges(spark):
    line = "the quick brown fox jumps over the lazy dog near the river bank and rests"
    docs = [(3, line + "!\nunique tail\n\nend"), (1, "Start\n" + line.upper()), (2, None), (4, line), (5, ""), (6, "\n \n"), (7, "Start  \n  START\nx")]
    df = spark.createDataFrame([(i, t, i) for i, t in docs], "doc_id long, text string, g long")
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(df).collect()}
    assert got == {1: ("Start\n" + line.upper(), 0), 2: (None, 0), 3: ("unique tail\n\nend", 1), 4: ("", 1), 5: ("", 0), 6: ("\n \n", 0), 7: ("x", 2)}
    kept = line_dedup.drop_duplicate_lines(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5, 6, 7]
    assert line_dedup.dedup_lines(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(df.withColumnRenamed("g", "n_lines"))


def test_line_shingles_and_bands():
    a, b = b"a line of some forty characters, more or less", b"short"
    assert len(line_dedup.line_set(a)) == len({a[i:i + 8] for i in range(len(a) - 7)}) and len(line_dedup.line_set(b)) == 1


def test_line_bands_find_pairs_of_every_length():
    """Pairs of similarity 0.8 share a band key about as often as independent rows give
    (0.998), however few shingles they have, also across the border of the two signatures."""
    rng = np.random.default_rng(11)
    few = line_dedup.FEW
    for a, b, both in [(5, 4, 4), (9, 9, 8), (18, 18, 16), (27, 27, 24), (45, 45, 40), (72, 72, 64), (few - 1, few + 20, few - 5), (few, few * 5 // 4, few), (300, 300, 267)]:
        assert C.jaccard_80(both, a, b)
        values = rng.integers(1, 2 ** 64, (1000, a + b - both), dtype=np.uint64)
        hashes = np.concatenate([values[:, :a], values[:, -b:]], 1).ravel()
        ptr = np.concatenate([[0], np.cumsum(np.tile([a, b], 1000))])
        keys = line_dedup.line_keys(hashes, ptr, line_dedup.distinct_counts(hashes, ptr))
        shares = ((keys[::2] == keys[1::2]) & (keys[::2] != 0)).any(1)
        assert shares.mean() >= 0.99, (a, b)


def test_line_dedup_short_lines(spark):
    """Pairs of short lines, 12 and 16 bytes with one more, as all pairs find them."""
    rng = np.random.default_rng(12)
    docs = []
    for i in range(150):
        line = bytes(rng.integers(97, 123, 11 if i % 2 else 16, np.uint8)).decode()
        docs += [(2 * i, line), (2 * i + 1, line + "x")]
    got = {r.doc_id: (r.text, r.n_removed, r.n_lines) for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = expected_lines(docs)
    assert sum(got[i] != want[i] for i in want) <= 2


# -------------------------------------------------------------------------- 3

def test_quotations(spark):
    m = [(1, 0, "user", "Hello there\nHow are you?"), (1, 1, "assistant", "Fine.\n\nthanks a lot"),
         (1, 2, "user", "On Monday, X wrote:\n> fine.\n> thanks  a lot\n> > How are you?\nGood to hear"),
         (1, 3, "assistant", ">> Hello there\nold one"), (2, 0, "user", "> Good to hear\nme too"), (2, 1, "assistant", None),
         (3, 0, "user", "plain > text"), (None, 0, "user", "> Fine."), (4, 0, "user", "> Fine.\nsee"), (1, 5, "user", "late")]
    df = spark.createDataFrame([(*r, "x") for r in m], "conv_id long, turn long, role string, text string, level string")
    got = {(r.conv_id, r.turn): (r.thread_id, r.parent_conv, r.parent_turn, r.quote_level, r.body) for r in quotes.conversations(df).collect()}
    assert got[1, 2] == (1, 1, 1, 1, "Good to hear")
    assert got[1, 3] == (1, 1, 0, 2, "old one")
    assert got[2, 0] == (1, 1, 2, 1, "me too") and got[2, 1] == (1, 2, 0, 0, None)
    assert got[4, 0] == (1, 1, 1, 1, "see") and got[3, 0] == (3, None, None, 0, "plain > text")
    assert got[1, 5] == (1, None, None, 0, "late") and got[None, 0][0] is None
    assert len(got) == len(m)
    order = [(r.thread_id, r.conv_id, r.turn) for r in quotes.conversations(df).where("thread_id is not null").collect()]
    assert order == sorted(order)
    assert quotes.conversations(df.limit(0)).count() == 0


def test_quotations_interleaved_nested_rewrapped(spark):
    """Passages are found with replies between them, below introductions inside the
    quote, and with their lines wrapped anew."""
    m = [(1, 0, "user", "How old is the garden\nand its long fence?\n\nA part nobody quotes.\n\nWho built the old\nroof of the house?"),
         (1, 1, "assistant", "Wait."),
         (1, 2, "user", "> How old is the\n> garden and its long fence?\nTen years.\n> Who built the old roof\n> of the house?\nMy uncle."),
         (2, 0, "user", "Alpha beta gamma\ndelta epsilon."),
         (2, 1, "assistant", "On Monday, A wrote:\n> Alpha beta gamma\n> delta epsilon.\nI agree with all\nof that."),
         (2, 2, "user", "Wait."),
         (2, 3, "assistant", "On Tuesday, B wrote:\n> On Monday, A wrote:\n> > Alpha beta gamma delta\n> > epsilon.\n> I agree with\n> all of that.\nFine.")]
    df = spark.createDataFrame(m, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.parent_conv, r.parent_turn, r.quote_level, r.body) for r in quotes.conversations(df).collect()}
    assert got[1, 2] == (1, 0, 1, "Ten years.\nMy uncle.")
    assert got[2, 1] == (2, 0, 1, "I agree with all\nof that.")
    assert got[2, 3] == (2, 1, 1, "Fine.")


# -------------------------------------------------------------------------- 4

def test_packing(spark, real):
    from tokenizers import Tokenizer
    df, rows = real
    tok = Tokenizer.from_file(tokenizer_path())
    some = [(r.doc_id, r.text) for r in rows[:40]] + [(9001, None), (9002, ""), (9003, "a\tb  c d <|endoftext|> It's"), (None, "null id"), (9004, "same"), (9004, "same")]
    out = packing.pack_documents(spark.createDataFrame(some, "doc_id long, text string"), tokenizer_path(), 512).collect()
    want = []
    for d, t in some:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(d, i // 512, i, len(ids[i:i + 512]), zlib.crc32(np.array(ids[i:i + 512], "<u4").tobytes())) for i in range(0, len(ids), 512)]
    assert sorted([tuple(r)[:5] for r in out], key=str) == sorted(want, key=str)
    at = collections.defaultdict(list)
    for r in out:
        at[r.sequence_id].append((r.offset, r.length))
    for held in at.values():
        end = 0
        for o, n in sorted(held):
            assert o == end
            end += n
        assert end <= 512
    total = sum(r.length for r in out)
    assert len(at) <= 1.02 * total / 512 + 1


def test_pack_lengths_best_two_fit():
    # greedy fills 6+3 of 10; 3 goes for 2+2, which leaves no gap
    assert sorted(map(sorted, packing.pack_lengths(np.array([6, 3, 2, 2]), 10))) == [[2, 2, 6], [3]]
    assert packing.pack_lengths(np.array([], int), 10) == []
    rng = np.random.default_rng(2)
    x = rng.integers(1, 101, 3000)
    bins = packing.pack_lengths(x, 100)
    assert sorted(v for b in bins for v in b) == sorted(x.tolist()) and all(sum(b) <= 100 for b in bins)
    assert len(bins) <= 1.01 * x.sum() / 100 + 1


# -------------------------------------------------------------------------- 5

def test_suffix_array_and_lcp():
    rng = np.random.default_rng(3)
    for trial in range(25):
        n, k = int(rng.integers(1, 200)), int(rng.integers(1, 5))
        t = np.append(rng.integers(1, k + 1, n) if trial % 3 else np.tile(rng.integers(1, 3, 4), 60)[:n], 0)
        sa = suffix_dedup.suffix_array(t, k + 3)
        want = sorted(range(len(t)), key=lambda i: t[i:].tolist())
        assert sa.tolist() == want
        lcp = suffix_dedup.permuted_lcp(t, sa, 10 ** 6)
        for a, b in zip(want, want[1:]):
            c = 0
            while max(a, b) + c < len(t) and t[a + c] == t[b + c]:
                c += 1
            assert lcp[b] == c


def removed_bytes(docs):
    first, out = {}, []
    for d, t in sorted(docs, key=lambda x: x[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        ws = [b[i:i + 50] for i in range(len(b) - 49)]
        for i, w in enumerate(ws):
            if first.get(w, d) < d:
                gone[i:i + 50] = b"\1" * 50
        for w in ws:
            first[w] = min(first.get(w, d), d)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), len(bytes(gone).replace(b"\0", b" ").split()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_dedup_equals_brute_force(spark, real):
    df, rows = real
    extra = [(5001, "é" * 60), (5002, "x" + "é" * 40), (5003, "ab" * 70), (5004, "b" + "ab" * 30), (5005, None), (5006, ""), (5007, "z" * 49), (5008, "z" * 49),
             (5009, "ab" * 70), (5009, "ab" * 70)]
    docs = [(r.doc_id, r.text) for r in rows] + extra
    got = suffix_dedup.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == removed_bytes(docs)
    assert suffix_dedup.dedup_substrings(empty(spark)).count() == 0


def hot_phrase_docs():
    """One phrase with different neighbours everywhere, some of them alike."""
    rng = np.random.default_rng(8)
    word = lambda n: bytes(rng.integers(97, 123, n, np.uint8)).decode()     # noqa: E731
    ends = [word(40) for _ in range(5)]
    return [(i, word(40) + " a phrase that stands in every document " + (ends[i % 5] if i % 3 else word(40))) for i in range(80)]


def test_suffix_dedup_hot_minimisers_are_spread():
    """No key of a hot phrase gathers more than one content, whatever surrounds it."""
    import pyarrow as pa
    docs = hot_phrase_docs()
    rows = pa.table({"doc_id": pa.array([i for i, _ in docs], pa.int64()), "text": [t for _, t in docs]})
    keys, freq = suffix_dedup._group_values(rows)
    most = lambda hot: np.unique(suffix_dedup._shared_runs(rows, keys, freq, hot)[2][0], return_counts=True)[1].max()
    assert most(10 ** 6) > 20 and most(10) <= 10


@pytest.mark.parametrize("hot_runs", [0, 10])
def test_suffix_dedup_hot_minimisers_equal_brute_force(spark, hot_runs):
    docs = hot_phrase_docs() + [(501, "é" * 60), (502, "x" + "é" * 40), (503, "ab" * 70), (504, "b" + "ab" * 30), (505, None), (506, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, suffix_dedup.dedup_substrings(frame, hot_runs).collect())) == removed_bytes(docs)


# -------------------------------------------------------------------------- 6

def test_toxicity(spark):
    good = [f"this is a calm text about topic{i} and nothing else" for i in range(60)]
    bad = [f"you idiot{'' if i % 2 else 'ling'} this is a rude text about topic{i}" + (" you worthless idiot" if i % 3 == 0 else "") for i in range(40)]
    docs = [(i, t) for i, t in enumerate(good + bad)]
    df = spark.createDataFrame([(i, t, "en", i) for i, t in docs], "doc_id long, text string, lang string, p_clean long")
    labels = spark.createDataFrame([(i, 1, int(i >= 60)) for i in range(0, 100, 1) if i % 5] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(df, labels)
    assert model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r for r in toxicity.predict(df, model).collect()}
    assert all(got[i].toxic == (i >= 60) for i, _ in docs)
    assert all(abs(r.p_clean + r.p_toxic + r.p_severe - 1) < 1e-5 and 0 <= r.severity <= 2 for r in got.values())
    assert got[63].severity >= got[0].severity
    odd_docs = odd(spark)
    assert not toxicity.predict(odd_docs, model).where("toxic").count() and toxicity.keep_clean(odd_docs, model).columns == odd_docs.columns
    blank = toxicity.fit(df, labels.limit(0))
    assert toxicity.keep_clean(df, blank).count() == 100


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(5)
    x = rng.poisson(1.0, (600, 3)).astype(float)
    s = x @ np.array([2.0, 1.0, 0.0])
    y = np.digitize(s + rng.logistic(0, 0.5, 600), [3.0, 6.0])
    w, (a, b) = toxicity.fit_ordinal(x, y, steps=800)
    assert a < b and w[0] > w[1] > abs(w[2])


# -------------------------------------------------------------------------- 7

def test_language_id(spark, real):
    df, rows = real
    model = langid.fit(df)
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert held and all(got[r.doc_id].held_out == (r in held) for r in rows)
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.95 * len(held)
    out = langid.identify(odd(spark), model).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == 15 and {by[4].lang_pred, by[5].lang_pred, by[6].lang_pred} == {"und"} and 0 <= by[9].score <= 1
    assert langid.fit(empty(spark)) is None
    assert {r.lang_pred for r in langid.identify(odd(spark), None).collect()} == {"und"}


def test_forward_backward_equals_enumeration():
    import itertools
    rng = np.random.default_rng(4)
    score, trans = rng.normal(size=(7, 2)), rng.normal(size=(2, 2))
    starts, lengths = np.array([0, 3]), np.array([3, 4])
    m, *rest = langid.forward_backward(score, trans, starts, lengths)
    for s, n in zip(starts, lengths):
        z, want = 0.0, np.zeros((n, 2))
        best, arg = -1e9, None
        for y in itertools.product((0, 1), repeat=int(n)):
            v = sum(score[s + i, y[i]] for i in range(n)) + sum(trans[y[i - 1], y[i]] for i in range(1, n))
            z += np.exp(v)
            if v > best:
                best, arg = v, y
            for i in range(n):
                want[i, y[i]] += np.exp(v)
        assert np.allclose(m[s:s + n], want / z)
        assert line_rules.viterbi(score, trans, starts, lengths)[s:s + n].tolist() == list(arg)


# -------------------------------------------------------------------------- 8

def test_kneser_ney_probabilities_sum_to_one(spark):
    text = "the cat sat on the mat and the dog sat on the log " * 3
    df = spark.createDataFrame([(text, True), ("the cow", False)], "text string, trusted boolean")
    counts = quality_lm.gram_counts(df).cache()
    p = {r.gram: np.exp(r.logp) for r in quality_lm.probabilities(counts).collect()}
    own = collections.Counter(int(g) for g in quality_lm.gram_array(text))
    assert {r.gram: r.n for r in counts.collect()} == {g: own.get(g, 0) for g in set(own) | set(quality_lm.gram_array("the cow").tolist())}
    assert all(0 < v <= 1 for v in p.values())
    sums = collections.defaultdict(float)
    for g, v in p.items():
        sums[g >> 16] += v
    assert all(v <= 1 + 1e-9 for v in sums.values())
    assert sums[int(quality_lm.gram_array("sat ")[0]) >> 16] > 0.5


def test_quality_classifier(spark, real):
    df, rows = real
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r for r in quality_lm.classify(df, labels).collect()}
    assert len(got) == len(rows)
    q = {r.doc_id: r.quality for r in labels.collect()}
    good = [i for i in got if q.get(i) == 1]
    assert sum(got[i].kept for i in good) >= 0.97 * len(good)
    out = {r.doc_id: r for r in quality_lm.classify(odd(spark).where("doc_id <> 11"), labels.limit(0)).collect()}
    assert not out[4].kept and not out[5].kept and out[1].kept and out[1].perplexity is None
    trusted = spark.createDataFrame([(1, 1, 0), (10, 1, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality_lm.classify(odd(spark).where("doc_id <> 11"), trusted).collect()}
    assert out[2].kept and not out[13].kept and out[4].perplexity is None


# -------------------------------------------------------------------------- 9

def test_line_rules(spark, real):
    df, rows = real
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = line_rules.fit(df, labels)
    extra = odd(spark).select("doc_id", "text")
    both = df.select("doc_id", "text").union(extra)
    got = line_rules.judge(both, model).collect()
    want = []
    for d, t in [(r.doc_id, r.text) for r in both.collect()]:
        t = t or ""
        w, seen, dup = SPACE.findall(t), set(), 0
        for x in t.split("\n"):
            dup += bool(SPACE.search(x)) and x in seen
            seen.add(x)
        c, cov = collections.Counter(zip(w, w[1:], w[2:])), set()
        for i in range(len(w) - 2):
            if c[w[i], w[i + 1], w[i + 2]] > 1:
                cov.update((i, i + 1, i + 2))
        failed = len(w) < 50 or 100 * len(cov) > 50 * len(w)
        want.append((d, len(w), sum(map(len, w)), sum(t.count(s) for s in "#*$%&|<>"), dup, len(cov), failed))
    assert sorted([tuple(r)[:7] for r in got], key=str) == sorted(want, key=str)
    assert not any(r.kept and r.base_failed for r in got)
    q = {r.doc_id: r.quality for r in labels.collect()}
    ours = [r for r in got if r.doc_id in q and not r.base_failed]
    assert sum(r.kept == (q[r.doc_id] == 1) for r in ours) >= 0.95 * len(ours)
    assert line_rules.fit(df, labels.limit(0)) is None


# ------------------------------------------------------------------ helpers, all

def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 300), (200, 301), (299, 301)]
    got = {r.id: r.comp for r in C.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 300: 200, 301: 200, 299: 200}
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hashes():
    b = np.frombuffer(b"abcabcabcx", np.uint8)
    g = C.gram_hashes(b, 3)
    assert len(g) == 8 and g[0] == g[3] and len(set(g.tolist())) == 4
    s = C.span_hashes(b, np.array([0, 3, 0]), np.array([3, 6, 4]))
    assert s[0] == s[1] != s[2]
    v = np.unique(np.random.default_rng(0).integers(0, 2 ** 64, 1000, dtype=np.uint64))
    assert (C.unpack_u64(C.pack_u64(v)) == v).all() and len(C.unpack_u64(C.pack_u64(v[:0]))) == 0


def test_registry():
    assert {re.match(r"op(\d+)_", k)[1] for k in QUERIES if k != "pipeline"} == {str(i) for i in range(1, 14)}
