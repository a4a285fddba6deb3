"""Chat formatting by quotation linking.

Every line of a message has a quote level, the number of ``>`` in front of it. Lines of one level that follow each other are a
passage, cut at blank lines. A passage is normalised (lower case, single blanks) and hashed, as a whole and line by line, so
that a re-wrapped quote and a quote of some lines are both recognised; so is all that a message has of a level. Quoted hashes are
joined to those of what messages of the same conversation wrote themselves; the first message with a hash is its origin.

Of the outermost level that has any origins, a message answers the one that it quotes in full; else the one with most characters in
quoted passages that no other message said, so that greetings and signatures do not decide; else the one with most characters in
quoted passages and lines (ties: the later message). Answers form trees, and a message's thread is the root of its tree. Ordered by (thread, turn), a conversation reads in reply order: every message
after the one it answers, threads together. Its text is what it says itself, without quotes and the line that introduces them.

Origins are minima per (conversation, hash), partial before the shuffle, so a passage in a third of all messages costs one row per
task; the join to them has one row per key on one side and can be split at a hot key. Messages are never collected by conversation.

Defined cases: a null text is empty, a null role is written as ``unknown``. Messages whose conversation or turn is null answer nothing
and are a thread of their own, with a null turn; they take no part in any join. Texts of any length are parsed whole. Other columns
are not read, whatever their names. Rows that repeat (conversation, turn) each stay and share what they answer. A quote
of something that no earlier message said is removed and links nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import forget, let, stored

MARKS = r"^(?:[ \t]?>)+"
INTRODUCTION = r"^(?:On|Am|Le|El) [^\n]{1,200}:[ \t\r]*\z"
LINE, PASSAGE, ALL = 0, 1, 2
TEMPLATE = ("<|", "|>\n", "<|end|>")


def parsed(text: Column) -> Column:
    """Lines as (level, body)."""
    def line(value: Column) -> Column:
        return let(F.regexp_extract(value, MARKS, 0), lambda marks: F.struct(
            F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
            F.substring(value, F.length(marks) + 1, F.length(value)).alias("body")))
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), line)


def passages(lines: Column, level: Column) -> Column:
    """What a message has of one level, each text once: (hash, chars, kind), kind ``LINE``, ``PASSAGE`` or ``ALL`` of it."""
    joined = F.array_join(F.transform(lines, lambda x: F.when(x["level"] == level, x["body"]).otherwise(F.lit(""))), "\n")
    normal = lambda x: F.trim(F.regexp_replace(F.lower(x), r"[ \t\n]+", " "))
    of = lambda pattern: F.array_distinct(F.transform(F.split(joined, pattern), normal))
    item = lambda x, kind, mark="": F.struct(F.md5(F.concat(F.lit(mark), x)).alias("hash"),
                                             F.length(x).cast("bigint").alias("chars"), F.lit(kind).alias("kind"))
    said = lambda texts: F.filter(texts, lambda x: x != "")

    def items(blocks: Column) -> Column:
        return F.concat(F.transform(said(blocks), lambda x: item(x, PASSAGE)),
                        F.transform(said(F.array_except(of(r"\n"), blocks)), lambda x: item(x, LINE)),
                        F.transform(said(F.array(normal(joined))), lambda x: item(x, ALL, "\n")))  # no text above has a line end
    return let(of(r"\n[ \t]*\n"), items)


def own_text(lines: Column) -> Column:
    """What a message says itself."""
    def keep(x: Column, i: Column) -> Column:
        follows = F.coalesce(F.get(lines, i + 1)["level"] > 0, F.lit(False))
        return F.when((x["level"] == 0) & ~(follows & x["body"].rlike(INTRODUCTION)), x["body"])
    said = F.filter(F.transform(lines, keep), lambda x: x.isNotNull())
    return F.regexp_replace(F.array_join(said, "\n"), r"^\s+|\s+\z", "")


def answers(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn) of the messages that quote an earlier one. ``messages`` has (conv_id, turn, lines)."""
    known = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    origins = (known.select("conv_id", "turn", F.explode(passages(F.col("lines"), F.lit(0))["hash"]).alias("hash"))
               .groupBy("conv_id", "hash").agg(F.min("turn").alias("origin"), (F.min("turn") == F.max("turn")).alias("alone")))
    levels = F.array_distinct(F.filter(F.col("lines")["level"], lambda x: x > 0))
    quoted = (known.select("conv_id", "turn", "lines", F.explode(levels).alias("level"))
              .select("conv_id", "turn", "level", F.inline(passages(F.col("lines"), F.col("level")))))
    own = F.when(F.col("alone") & (F.col("kind") >= PASSAGE), F.col("chars")).otherwise(F.lit(0))
    votes = (quoted.join(origins, ["conv_id", "hash"]).where("origin < turn").groupBy("conv_id", "turn", "level", "origin")
             .agg(F.max((F.col("kind") == ALL).cast("int")).alias("in_full"), F.sum(own).alias("own"), F.sum("chars").alias("chars")))
    best = F.min(F.struct("level", *((-F.col(c)).alias(c) for c in ("in_full", "own", "chars", "origin"))))
    return votes.groupBy("conv_id", "turn").agg(best.alias("best")).select("conv_id", "turn", (-F.col("best.origin")).alias("parent_turn"))


def threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, thread_turn): the root of each answer's tree, by doubling steps up the tree."""
    held = stored(links.withColumn("thread_turn", F.col("parent_turn")), "threads")
    while True:
        up = held.select("conv_id", F.col("turn").alias("thread_turn"), F.col("thread_turn").alias("higher"))
        step = held.join(up, ["conv_id", "thread_turn"], "left")
        if step.where("higher IS NOT NULL").isEmpty():
            return held
        old, held = held, stored(step.select("conv_id", "turn", "parent_turn",
                                             F.coalesce("higher", "thread_turn").alias("thread_turn")), "threads")
        forget(old)


def conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, parent_turn, thread_turn, quote_levels, message), one row per message; sort a conversation by
    thread_turn, then turn."""
    rows = messages.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                           F.col(f"`{role_col}`").alias("role"), parsed(F.col(f"`{text_col}`")).alias("lines"))
    linked = threads(answers(rows.select("conv_id", "turn", "lines")))
    opening, after_role, closing = TEMPLATE
    message = F.concat(F.lit(opening), F.coalesce("role", F.lit("unknown")), F.lit(after_role), own_text(F.col("lines")), F.lit(closing))
    said = rows.select("conv_id", "turn", "role", F.array_max(F.col("lines")["level"]).alias("quote_levels"), message.alias("message"))
    placed = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    answering = said.where(placed).join(linked, ["conv_id", "turn"], "left")
    others = said.where(~placed).select("*", *(F.lit(None).cast(linked.schema[c].dataType).alias(c) for c in ("parent_turn", "thread_turn")))
    return (answering.unionByName(others)  # messages without a key are many, maybe, and would all meet in one task
            .select("conv_id", "turn", "role", "parent_turn", F.coalesce("thread_turn", "turn").alias("thread_turn"),
                    "quote_levels", "message"))
