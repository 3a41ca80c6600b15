"""Best-two-fit packing of tokenised documents into sequences of fixed length.

A document is its token ids and an end id. Documents longer than a sequence are
cut into full pieces, the last may be shorter. Pieces are dealt into shards of
bounded size; each shard fills sequences greedily with the largest piece that
fits, and then tries to replace the sequence's smallest piece by two unpacked
pieces that fit its gap, enlarged by that piece, more tightly. Pieces of one
length are interchangeable, so a shard works on a count per length: its cost
follows the number of sequences. Each shard leaves at most a few sequences
unfilled, whatever the number of shards.

Defined results: null text counts as empty (the end id alone); a repeated
(doc_id, text) row is packed again as a document of its own; a null doc_id is
packed and returned as null; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from pricelab.llm import common as C

SEQUENCE = 4096
END_ID = 1
SHARD_PIECES = 25_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
CACHED = 800_000
_SIMPLE = re.compile(r"([A-Za-z]+)([.,!?;:]*)").fullmatch


def token_bytes(texts, path: str):
    """Little-endian uint32 ids of each text, without end id.

    The tokenizer's pre-tokenizer never joins across white space, so a text's ids
    are those of its space- and newline-separated chunks. A chunk of ASCII letters
    and closing marks is one word and one mark for it; its word goes to the
    tokenizer's model directly (normalisation only lower-cases it). Both kinds are
    kept in bounded caches per worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    def load():
        tok = Tokenizer.from_file(path)
        return tok, {"": b""}, {}, tok.model

    tok, cache, words, model = C.worker_store(("tokens", path), load)
    for text in texts:
        parts = (text or "").replace("\n", " ").split(" ")
        try:
            yield b"".join([cache[p] for p in parts])
            continue
        except KeyError:
            pass
        if len(cache) > CACHED:
            cache.clear()
            words.clear()
            cache[""] = b""
        other = []
        for p in set(parts):
            if p in cache:
                continue
            m = _SIMPLE(p)
            if m is None:
                other.append(p)
                continue
            word, mark = m.groups()
            word = word.lower()
            ids = words.get(word)
            if ids is None:
                ids = words[word] = struct.pack(f"<{len(t := model.tokenize(word))}I", *[x.id for x in t])
            if mark:
                if mark not in words:
                    words[mark] = np.array(tok.encode(mark, add_special_tokens=False).ids, "<u4").tobytes()
                ids += words[mark]
            cache[p] = ids
        if other:
            for p, e in zip(other, tok.encode_batch_fast(other, add_special_tokens=False)):
                cache[p] = np.array(e.ids, "<u4").tobytes()
        yield b"".join([cache[p] for p in parts])


def pieces(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: place in its document, length and checksum of its ids."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        for b in batches:
            ids = C.id_array(b.column(0))
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for doc, raw in zip(ids.tolist(), token_bytes(b.column(1).to_pylist(), tokenizer)):
                raw += end
                for i in range(0, len(raw), 4 * sequence):
                    part = raw[i:i + 4 * sequence]
                    for k, v in zip(out, (doc, i // (4 * sequence), i // 4, len(part) // 4, zlib.crc32(part))):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))

    return docs.select("doc_id", "text").mapInArrow(cut, _PIECES)


def pack_lengths(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Best-two-fit over the multiset of ``lengths`` (each 1..size): bins of lengths."""
    count = np.bincount(lengths, minlength=size + 1)
    bins = [[size] for _ in range(int(count[size]))]
    count[size] = 0
    left = int(count.sum())
    while left:
        gap, held = size, []
        while gap:                                   # greedy: the largest that fits
            fits = np.flatnonzero(count[1:gap + 1])
            if not len(fits):
                break
            x = int(fits[-1]) + 1
            times = min(gap // x, int(count[x]))
            held += [x] * times
            count[x] -= times
            left -= times
            gap -= x * times
        if gap and left > 1:
            small = held[-1]
            room = gap + small                       # smallest out, two others in
            have = np.flatnonzero(count[1:room]) + 1
            if len(have):
                # for each first length the largest second one that still fits
                at = np.searchsorted(have, room - have, "right") - 1
                ok = at >= 0
                a, b = have[ok], have[at[ok]]
                lone = (a == b) & (count[a] < 2)     # one piece cannot be used twice
                down = np.maximum(at[ok] - 1, 0)
                b = np.where(lone, np.where(at[ok] > 0, have[down], 0), b)
                total = np.where(b > 0, a + b, 0)
                best = int(np.argmax(total)) if len(total) else -1
                if best >= 0 and total[best] > small:
                    one, two = int(a[best]), int(b[best])
                    count[one] -= 1
                    count[two] -= 1
                    count[small] += 1
                    left -= 1
                    held[-1:] = [one, two]
        bins.append(held)
    return bins


def pack(cut: DataFrame, sequence: int = SEQUENCE, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``sequence_id`` and ``offset`` for every piece of ``cut`` (already written out)."""
    shards = max(1, -(-cut.count() // shard_pieces))
    # by document and piece, so one very long document or one null id spreads too
    shard = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "length"), F.lit(shards)).cast("int")

    def fill(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], kind="stable").reset_index(drop=True)
        length = pdf["length"].to_numpy()
        head = {int(v): int(i) for v, i in zip(*np.unique(length, return_index=True))}
        seq, off = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for s, held in enumerate(pack_lengths(length, sequence)):
            at = 0
            for x in held:
                r = head[x]
                head[x] = r + 1
                seq[r], off[r] = (int(key[0]) << 32) + s, at
                at += x
        return pdf.assign(sequence_id=seq, offset=off).drop(columns="shard")

    schema = _PIECES + ", sequence_id long, offset long"
    packed = cut.withColumn("shard", shard).groupBy("shard").applyInPandas(fill, schema)
    return packed.withColumn("doc_id", F.nullif("doc_id", F.lit(int(C.NO_ID))))


def pack_documents(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """All of ``docs`` as pieces in sequences of at most ``sequence`` tokens."""
    C.prepare(docs.sparkSession)
    return pack(C.written(pieces(docs, tokenizer, sequence, end_id)), sequence)
