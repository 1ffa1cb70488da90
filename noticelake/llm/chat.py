"""Conversations as training texts with a loss mask, by Spark expressions alone.

Turns are collected per conversation as structs and sorted; adjacent turns of one role become one message. The template:

    message     <s>[INST] role<sep>text<sep>text [/INST]</s>\\n
    assistant   <s>assistant<sep>text<sep>text</s>\\n

A message begins at each turn whose role differs from the turn's before it, and every text follows a ``<sep>``, so merged turns
can be told apart again. Control strings inside roles and texts get one backslash behind their first character, and those that
have backslashes there get one more; taking one away everywhere restores the input.

``loss_spans`` are (start, end) in code points of the formatted text, one per assistant turn: its text and nothing else.
``read_back`` takes a formatted text and its spans apart again; nothing but the two is used for that.

Defined cases: turns are sorted by turn (null first), then role, then text; repeated rows are turns as often as they occur; a null
role or text is empty; rows with a null conv_id are one conversation; an empty table gives no rows; further columns take no part.
A conversation is one example and so one row, with Spark's limit of 2 GB per value. Running sums are made in blocks, so the work
on a conversation of n turns grows as n ** 1.5, with small numbers alone being copied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.text import let

#: Control strings as (first character, rest).
CONTROL = r"(<|\[)(\\*)(/?s>|sep>|/?INST\])"
ESCAPED = r"(<|\[)\\(\\*)(/?s>|sep>|/?INST\])"
OPEN, CLOSE, SEP = "<s>", "</s>\n", "<sep>"
ASK, ASKED = "[INST] ", " [/INST]"
LEARNED = "assistant"
BLOCK = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def running_sums(numbers: Column, block: int = BLOCK) -> Column:
    """[0, x0, x0 + x1, ...], as long as the array of long: sums within blocks, then of blocks."""

    def sums(values: Column) -> Column:
        return F.aggregate(
            values, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)),
        )

    def shifted(blocks: Column) -> Column:
        return let(
            sums(F.transform(blocks, lambda b: F.element_at(b, -1))),
            lambda before: F.transform(blocks, lambda b, i: F.transform(F.slice(b, 1, F.size(b) - 1), lambda x: x + F.get(before, i))),
        )

    return F.flatten(let(F.transform(sliced(numbers, block), sums), shifted))


def sliced(values: Column, block: int = BLOCK) -> Column:
    """An array as an array of arrays of at most block elements."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(block))
    return F.transform(starts, lambda at: F.slice(values, at, block))


def collected(turns: DataFrame) -> DataFrame:
    """conv_id and turns: array of struct<turn, role, text> in order, roles and texts not null."""
    empty = F.lit("")
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, formatted (the text) and loss_spans (array of struct<start: long, end: long>, in code points)."""
    # adjacent turns of one role: the first opens the message, the last closes it
    role = lambda i: F.get(F.col("turns"), i)["role"]
    learned = lambda t: t["role"] == LEARNED
    nothing = F.lit("")

    def marked(t: Column, i: Column) -> Column:
        opens = (i == 0) | (role(i - 1) != t["role"])
        closes = (i == F.size("turns") - 1) | (role(i + 1) != t["role"])
        opening = F.concat(F.lit(OPEN), F.when(learned(t), nothing).otherwise(F.lit(ASK)), escape(t["role"]))
        closing = F.concat(F.when(learned(t), nothing).otherwise(F.lit(ASKED)), F.lit(CLOSE))
        return F.struct(
            F.concat(F.when(opens, opening).otherwise(nothing), F.lit(SEP)).alias("before"), escape(t["text"]).alias("text"),
            F.when(closes, closing).otherwise(nothing).alias("after"), learned(t).alias("learned"),
        )

    parts = collected(turns).select("conv_id", F.transform("turns", marked).alias("parts"))
    sized = parts.select(
        "conv_id", "parts",
        F.transform("parts", lambda p: (F.length(p["before"]) + F.length(p["text"]) + F.length(p["after"])).cast("long")).alias("sizes"),
    ).withColumn("starts", running_sums(F.col("sizes")))

    def span(p: Column, at: Column) -> Column:
        start = at + F.length(p["before"])
        return F.struct(p["learned"].alias("learned"), start.alias("start"), (start + F.length(p["text"])).alias("end"))

    spans = F.filter(F.zip_with("parts", "starts", span), lambda s: s["learned"])
    return sized.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: F.concat(p["before"], p["text"], p["after"])), "").alias("formatted"),
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("loss_spans"),
    )


def read_back(texts: DataFrame) -> DataFrame:
    """conv_id, n_messages, turns (array of struct<role, text>), loss (array of texts) and formatted_chars of formatted texts."""
    found = F.filter(F.split("formatted", CLOSE, -1), lambda m: m != "")

    def message(m: Column) -> Column:
        asked = m.startswith(OPEN + ASK)
        head = F.when(asked, F.lit(len(OPEN + ASK))).otherwise(F.lit(len(OPEN)))
        tail = F.when(asked, F.lit(len(ASKED))).otherwise(F.lit(0))
        fields = F.split(F.substring(m, head + 1, F.length(m) - head - tail), SEP, -1)
        turn = lambda role, t: F.struct(role.alias("role"), unescape(t).alias("text"))
        return let(fields, lambda f: let(unescape(f[0]), lambda role: F.transform(F.slice(f, 2, F.size(f) - 1), lambda t: turn(role, t))))

    # a block of spans is cut out first, and the spans from that, so that a long text is not searched from its start for each
    cut = lambda text, start, end: F.substring(text, (start + 1).cast("int"), (end - start).cast("int"))
    masked = F.transform(
        sliced(F.col("loss_spans")),
        lambda spans: let(
            cut(F.col("formatted"), spans[0]["start"], F.element_at(spans, -1)["end"]),
            lambda part: F.transform(spans, lambda s: unescape(cut(part, s["start"] - spans[0]["start"], s["end"] - spans[0]["start"]))),
        ),
    )
    loss = F.when(F.size("loss_spans") > 0, F.flatten(masked)).otherwise(F.array().cast("array<string>"))
    return texts.select(
        "conv_id", F.size(found).cast("long").alias("n_messages"), F.flatten(F.transform(found, message)).alias("turns"), loss.alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def digests(texts: DataFrame) -> DataFrame:
    """What the formatted texts hold, read back from them: counts and SHA-256 of all turns and of all text under the mask."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return read_back(texts).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars", "n_messages",
    )
