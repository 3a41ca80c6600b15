"""Quotation links against a plain re-statement, short lines across conversations, wrapped introductions."""

import re

import numpy as np
import pytest

from pricelab.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string, hash int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)


def norm(t):
    return " ".join(t.lower().split())


def pieces(lines):
    """Quoted pieces of a message by level, and its own ones."""
    def runs(kind):
        out, last = [], None
        for x in lines:
            if kind(x) != last:
                out.append((x[0], []))
            out[-1][1].append(x[1])
            last = kind(x)
        return [(lv, " ".join(t)) for lv, t in out]

    blank = lambda x: (x[0], not x[1].strip())
    quoted = {x for x in lines if x[0]} | {r for k in (lambda x: x[0], blank) for r in runs(k) if r[0]}
    quoted |= {(lv, " ".join(t for v, t in lines if v == lv)) for lv in {x[0] for x in lines if x[0]}}
    own = {t for lv, t in lines if not lv} | {t for lv, t in runs(blank) if not lv} | {" ".join(t for lv, t in lines if not lv)}
    return {(lv, norm(t)) for lv, t in quoted if norm(t)}, {norm(t) for t in own if norm(t)}


def brute(rows):
    parsed = {}
    for c, t, _, text in rows:
        lines = []
        for line in text.split("\n"):
            m = re.match(r"^((\s*>)+)", line)
            lines.append((m.group(1).count(">") if m else 0, re.sub(r"^(\s*>)+\s?", "", line)))
        parsed[c, t] = pieces(lines)
    out = {}
    for (c, t), (quoted, _) in parsed.items():
        votes = {}
        for lv, h in quoted:
            near = [(c, u) for (d, u), (_, own) in parsed.items() if d == c and u < t and h in own]
            holders = sorted(k for k, (_, own) in parsed.items() if h in own)
            if near:
                key = (0, lv, *max(near))
            elif holders and holders[0][0] < c and (len(h.split()) >= quotes.FAR_WORDS or len({d for d, _ in holders}) == 1):
                key = (1, lv, *holders[0])
            else:
                continue
            votes[key] = votes.get(key, 0) + 1
        if votes:
            far, lv, pc, pt = min(votes, key=lambda k: (k[0], k[1], -votes[k], k[2], k[3]))
            out[c, t] = (lv, votes[far, lv, pc, pt], pc, pt)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_links_equal_plain_statement(spark, seed):
    rng = np.random.default_rng(seed)
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    short = ["Thanks!", "ok", "see you", "I agree"]
    rows, said = [], []
    for c in range(12):
        for t in range(int(rng.integers(1, 6))):
            lines = []
            for _ in range(int(rng.integers(0, 3))):
                if said and rng.random() < 0.6:
                    q = said[int(rng.integers(len(said)))]
                    k = int(rng.integers(1, len(q) + 1))
                    lines += [">" * int(rng.integers(1, 3)) + " " + x for x in q[:k]]
                    lines += [""] * int(rng.integers(0, 2))
            own = [short[int(rng.integers(4))] if rng.random() < 0.4 else " ".join(rng.choice(words, int(rng.integers(2, 12)))) for _ in range(int(rng.integers(1, 4)))]
            said.append(own)
            rows.append((c, t, "user", "\n".join(lines + own)))
    got = {(r.conv_id, r.turn): (r.quote_level, r.n_hits, r.parent_conv, r.parent_turn) for r in quotes.link(quotes.parse(frame(spark, rows))).collect()}
    assert got == brute(rows) and len(got) > 5


def test_common_short_lines_do_not_join_strangers(spark):
    rows = [(1, 0, "u", "Thanks!"), (2, 0, "u", "Thanks!"), (50, 0, "u", "> Thanks!\nYou are welcome."),
            (3, 0, "u", "A rare remark"), (60, 0, "u", "> A rare remark\nIndeed."),
            (4, 0, "u", "one two three four five six seven eight"), (5, 0, "u", "one two three four five six seven eight"),
            (70, 0, "u", "> one two three four five six seven eight\nYes.")]
    thread = {r.conv_id: r.thread_id for r in quotes.conversations(frame(spark, rows)).collect()}
    assert thread[50] == 50 and thread[60] == 3 and thread[70] == 4


def test_long_and_wrapped_introductions(spark):
    long = "On Monday, " + "a very long name " * 30 + "wrote:"
    rows = [(1, 0, "u", "The original line of this conversation."),
            (1, 1, "u", f"{long}\n> The original line of this conversation.\nAnswer one."),
            (1, 2, "u", "On Monday, somebody with a long name\nof the committee wrote:\n> Answer one.\nOn reflection\nanswer two."),
            (1, 3, "u", "Am Montag\nschrieb er:\n\nno quote follows"), (1, 4, "u", "x" * 200_000), (1, 4, "u", None)]
    body = {(r.turn, r.body if r.turn == 4 else None): r.body for r in quotes.conversations(frame(spark, rows)).collect()}
    assert body[1, None] == "Answer one." and body[2, None] == "On reflection\nanswer two."
    assert body[3, None] == "Am Montag\nschrieb er:\n\nno quote follows" and (4, "x" * 200_000) in body and (4, None) in body
