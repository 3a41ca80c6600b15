"""Quotation linking: quoted passages are joined to the messages they come from.

Each line's nested quote level is the number of leading ``>``; quoted lines, runs of
lines of one level, their paragraphs (between blank lines) and, per level, the whole
quoted passage are normalised (lower case, white space runs one space) and hashed, as
are the lines, paragraphs and the whole own text of every message. So a passage is
found although its lines were wrapped anew or replies stand between its parts. A
quoted hash is joined first to an earlier message of the same conversation (the
latest before it), else to the first message of an earlier conversation that has
it, if it is a passage of ``FAR_WORDS`` words or stands in one conversation only (short
lines that many write would chain strangers into one thread); each side of these joins is reduced to one row per hash beforehand, so common
lines do not multiply. The parent of a message is the original with most hits at
its lowest linked quote level, the earlier conversations last; without a quote it
is the turn before. Conversations linked by quotes form one thread (union-find),
ordered by (conv_id, turn), which puts every reply after what it answers. Bodies
come without quoted lines and without the line that introduces a quote, of any length
or wrapped over two lines; such lines inside a quote count for no passage either.

DataFrame functions only. Defined results: null text has a null body and quotes
nothing; blank lines never link; a null conv_id or turn takes part in no link and
gets a null thread; rows that repeat (conv_id, turn) keep their own bodies and
share the parent; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricelab.llm import common as C

_QUOTE = r"^(\s*>)+\s?"
FAR_WORDS = 8
_INTRO = r"^(on|am|le|el)\b.*\b(wrote|schrieb|écrit|escribió)\s*:\s*$"
_BLANK = r"^[\s\x{00A0}]*$"


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, r"^((\s*>)+)", 1), r"[^>]", ""))


def _norm(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\s\x{00A0}]+", " "))


def parse(messages: DataFrame) -> DataFrame:
    """Messages with ``lines``: array<struct<level, text>> in order, and ``body``."""
    lines = F.transform(F.split("text", "\r?\n", -1), lambda x: F.struct(_level(x).alias("level"), F.regexp_replace(x, _QUOTE, "").alias("text")))
    out = messages.select("conv_id", "turn", "role", "text", lines.alias("raw"))
    # an introduction is a line right before a quote of a higher level
    at = lambda i: F.get(F.col("raw"), i)
    deeper = lambda i, x: F.coalesce(at(i)["level"], F.lit(0)) > x["level"]
    same = lambda i, x: F.coalesce(at(i)["level"] == x["level"], F.lit(False))
    intro = lambda *parts: F.coalesce(F.lower(F.concat_ws(" ", *parts)).rlike(_INTRO), F.lit(False))

    def introduces(x: Column, i: Column) -> Column:
        one = intro(x["text"]) & deeper(i + 1, x)
        head = same(i + 1, x) & deeper(i + 2, x) & ~intro(at(i + 1)["text"]) & intro(x["text"], at(i + 1)["text"])
        tail = (i > 0) & same(i - 1, x) & deeper(i + 1, x) & ~intro(x["text"]) & intro(at(i - 1)["text"], x["text"])
        return one | head | tail

    clean = F.filter("raw", lambda x, i: ~introduces(x, i))
    own = F.filter("clean", lambda x: x["level"] == 0)
    quoted = F.size(F.filter("raw", lambda x: x["level"] > 0)) > 0
    body = F.when(quoted, F.trim(F.array_join(F.transform(own, lambda x: x["text"]), "\n"))).otherwise(F.col("text"))
    return out.withColumn("clean", clean).withColumn("own", own).withColumn("body", body)


def _hashed(text: Column) -> Column:
    return F.xxhash64(_norm(text))


def _blocks(lines: Column, paragraphs: bool) -> Column:
    """array<struct<level, text>> of the maximal runs of lines of one level, or of their
    paragraphs (blank lines are runs of their own then)."""
    def kind(x: Column) -> Column:
        return F.struct(x["level"], x["text"].rlike(_BLANK)) if paragraphs else x["level"]

    def cut(kinds: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: (i == 0) | (F.get(kinds, i) != F.get(kinds, i - 1)))
        return F.get(F.transform(F.array(first), lambda f: F.transform(f, lambda lo, k: _block(
            F.slice(lines, lo + 1, F.coalesce(F.get(f, k + 1), F.size(lines)) - lo)))), F.lit(0))

    some = F.get(F.transform(F.array(F.transform(lines, kind)), cut), F.lit(0))
    return F.when(F.size(lines) > 0, some).otherwise(F.array().cast("array<struct<level:int,text:string>>"))


def _block(lines: Column) -> Column:
    return F.struct(F.get(lines, F.lit(0))["level"].alias("level"), F.array_join(F.transform(lines, lambda x: x["text"]), " ").alias("text"))


def originals(parsed: DataFrame) -> DataFrame:
    """``(hash, conv_id, turn)`` of every own line, paragraph and whole body."""
    own_parts = F.filter(_blocks(F.col("clean"), True), lambda x: x["level"] == 0)
    texts = F.concat(F.transform("own", lambda x: x["text"]), F.transform(own_parts, lambda x: x["text"]),
                     F.array(F.array_join(F.transform("own", lambda x: x["text"]), " ")))
    return (parsed.where("conv_id is not null and turn is not null").select("conv_id", "turn", F.explode(texts).alias("t"))
            .where(_norm(F.col("t")) != "").select(_hashed(F.col("t")).alias("hash"), "conv_id", "turn").distinct())


def quotations(parsed: DataFrame) -> DataFrame:
    """``(conv_id, turn, level, hash, long)`` of every quoted line, run, paragraph and whole passage."""
    quoted = F.filter("clean", lambda x: x["level"] > 0)
    q = parsed.where("conv_id is not null and turn is not null").select("conv_id", "turn", "clean", quoted.alias("q")).where(F.size("q") > 0)
    parts = F.filter(F.concat(_blocks(F.col("clean"), False), _blocks(F.col("clean"), True)), lambda x: x["level"] > 0)
    line = q.select("conv_id", "turn", F.explode(F.concat("q", parts)).alias("x")).select("conv_id", "turn", "x.level", F.col("x.text").alias("t"))
    levels = F.array_distinct(F.transform("q", lambda x: x["level"]))
    passage = (q.select("conv_id", "turn", "q", F.explode(levels).alias("level"))
               .select("conv_id", "turn", "level", F.array_join(F.transform(F.filter("q", lambda x: x["level"] == F.col("level")), lambda x: x["text"]), " ").alias("t")))
    return line.unionByName(passage).where(_norm(F.col("t")) != "").select("conv_id", "turn", "level", _hashed(F.col("t")).alias("hash"), _long(F.col("t")).alias("long")).distinct()


def _long(text: Column) -> Column:
    return F.size(F.split(_norm(text), " ")) >= FAR_WORDS


def link(parsed: DataFrame) -> DataFrame:
    """``(conv_id, turn, level, n_hits, parent_conv, parent_turn)``: one parent per message."""
    orig, quotes = originals(parsed), quotations(parsed)
    # same conversation: the latest earlier message, by a running maximum over the
    # rows of one (conversation, hash)
    here = orig.select("conv_id", "hash", "turn", F.col("turn").alias("src"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("boolean").alias("long"))
    asks = quotes.select("conv_id", "hash", "turn", F.lit(None).cast(orig.schema["turn"].dataType).alias("src"), "level", "long")
    wanted = quotes.select("conv_id", "hash").distinct()
    before = F.expr("max(src) over (partition by conv_id, hash order by turn range between unbounded preceding and 1 preceding)")
    inner = (here.join(wanted, ["conv_id", "hash"], "left_semi").unionByName(asks).withColumn("parent_turn", before).where("level is not null"))
    near = inner.where("parent_turn is not null").select("conv_id", "turn", "level", F.lit(0).alias("far"), F.col("conv_id").alias("parent_conv"), "parent_turn")
    # else the first message of an earlier conversation
    first = (orig.join(quotes.select("hash").distinct(), "hash", "left_semi").groupBy("hash").agg(F.min(F.struct("conv_id", "turn")).alias("o"), F.max("conv_id").alias("last")))
    lone = inner.where("parent_turn is null").select("conv_id", "turn", "level", "hash", "long")
    far = (lone.join(first, "hash").where((F.col("o.conv_id") < F.col("conv_id")) & (F.col("long") | (F.col("o.conv_id") == F.col("last"))))
           .select("conv_id", "turn", "level", F.lit(1).alias("far"), F.col("o.conv_id").alias("parent_conv"), F.col("o.turn").alias("parent_turn")))
    votes = near.unionByName(far).groupBy("conv_id", "turn", "level", "far", "parent_conv", "parent_turn").agg(F.count(F.lit(1)).alias("n_hits"))
    best = F.min(F.struct("far", "level", (-F.col("n_hits")).alias("neg"), "parent_conv", "parent_turn")).alias("b")
    return (votes.groupBy("conv_id", "turn").agg(best)
            .select("conv_id", "turn", F.col("b.level").alias("quote_level"), (-F.col("b.neg")).alias("n_hits"), "b.parent_conv", "b.parent_turn"))


def conversations(messages: DataFrame) -> DataFrame:
    """Reply-ordered messages: thread_id, conv_id, turn, role, parent, quote level, body."""
    C.prepare(messages.sparkSession)
    parsed = parse(messages)
    links = C.cut(link(parsed))
    edges = links.where("parent_conv <> conv_id").select(F.col("conv_id").alias("a"), F.col("parent_conv").alias("b"))
    threads = C.components(edges).select(F.col("id").alias("conv_id"), F.col("comp").alias("thread"))
    turns = messages.where("conv_id is not null and turn is not null").select(F.col("conv_id").alias("pc"), F.col("turn").alias("pt")).distinct()
    out = (parsed.select("conv_id", "turn", "role", "body")
           .join(links, ["conv_id", "turn"], "left").join(threads, "conv_id", "left")
           .join(turns, (F.col("conv_id") == F.col("pc")) & (F.col("turn") - 1 == F.col("pt")), "left"))
    return (out.select(F.coalesce("thread", "conv_id").alias("thread_id"), "conv_id", "turn", "role",
                       F.coalesce("parent_conv", "pc").alias("parent_conv"), F.coalesce("parent_turn", "pt").alias("parent_turn"),
                       F.coalesce("quote_level", F.lit(0)).alias("quote_level"), F.coalesce("n_hits", F.lit(0)).alias("n_hits"), "body")
            .orderBy("thread_id", "conv_id", "turn"))
