"""URL verdicts from rules, and from a ratio of character language models where no rule fits.

URLs that a rule allows or blocks train two smoothed variable-order Markov models over host and path; a URL without a rule
is judged by the difference of its log-likelihoods per character, against a threshold calibrated on the ruled ones. Orders
0 to ORDER are mixed by Witten-Bell smoothing: p_k = (count + kinds * p_(k-1)) / (total + kinds), down to 1 / ALPHABET.
Digits are one character class, so URLs that differ in numbers alone are one string, scored once.

DataFrame functions only. Counts are combined before every shuffle; per-position rows exist for distinct strings alone, and
the model table is written first, so that Spark sees its size before it joins.

Defined cases: a null URL or one without :// has empty host and path and is scored as the empty string; a score at the
threshold is allowed; where one of the two models has no URL to learn from, the verdict is the other's (allow if both lack);
repeated rows are judged alike; an empty table gives no rows; further columns take no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

ORDER = 4
ALPHABET = 256
#: Fixed characters before and behind a string, which no URL holds.
BEGIN, END = "\u0002", "\u0003"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


def url_host(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), _PARTS, 1)
    return F.translate(host, ascii_uppercase, ascii_lowercase)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), _PARTS, 2)


def fitting(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls; of two as long, the one stated first."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.host) + len(r.path)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        rule, verdict = F.when(fits, r.host + r.path).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return rule, verdict


def _grams(strings: DataFrame) -> DataFrame:
    """strings (s, ...) with one row per character and for the end: context and next character."""
    marks = F.array(*[F.lit(BEGIN)] * ORDER)
    chars = F.concat(marks, F.when(F.col("s") == "", F.array().cast("array<string>")).otherwise(F.split("s", "")), F.array(F.lit(END)))
    rows = strings.withColumn("chars", chars).select("*", F.posexplode("chars").alias("at", "next")).filter(F.col("at") >= ORDER)
    # "at" counts from 0, slices from 1
    return rows.withColumn("context", F.array_join(F.slice("chars", F.col("at") - ORDER + 1, ORDER), "")).drop("chars", "at")


def train(strings: DataFrame) -> DataFrame:
    """strings (s, good, bad: how many URLs of either kind) to (context, next, gain) of every gram in them: gain is the
    difference of its log-probabilities under the two models."""
    top = _grams(strings).groupBy("context", "next").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    counts = [stored(top)]
    for _ in range(ORDER):
        counts.append(counts[-1].groupBy(F.substring("context", 2, ORDER).alias("context"), "next").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")))
    model = None
    for level in reversed(counts):
        of = Window.partitionBy("context")
        for kind in ("good", "bad"):
            level = level.withColumn(f"{kind}_total", F.sum(kind).over(of)).withColumn(f"{kind}_kinds", F.sum((F.col(kind) > 0).cast("long")).over(of))
        if model is None:
            level = level.withColumn("p_good", F.lit(1.0 / ALPHABET)).withColumn("p_bad", F.lit(1.0 / ALPHABET))
            grown = level
        else:
            shorter = model.select(F.col("context").alias("_short"), F.col("next").alias("_next"), "p_good", "p_bad")
            grown = level.join(shorter, (F.substring("context", 2, ORDER) == F.col("_short")) & (F.col("next") == F.col("_next")))
        for kind in ("good", "bad"):
            total, kinds = F.col(f"{kind}_total"), F.col(f"{kind}_kinds")
            p = F.when(total == 0, F.col(f"p_{kind}")).otherwise((F.col(kind) + F.greatest(kinds, F.lit(1)) * F.col(f"p_{kind}")) / (total + F.greatest(kinds, F.lit(1))))
            grown = grown.withColumn(f"p_{kind}", p)
        model = grown.select("context", "next", "p_good", "p_bad")
    return model.select("context", "next", (F.log("p_good") - F.log("p_bad")).alias("gain"))


def scores(strings: DataFrame, model: DataFrame) -> DataFrame:
    """strings with their score: mean gain per character, the end included."""
    grams = _grams(strings)
    return grams.join(model, ["context", "next"]).groupBy("s").agg(F.first("good").alias("good"), F.first("bad").alias("bad"), F.round(F.avg("gain"), 9).alias("score"))


def threshold(scored: DataFrame) -> float:
    """The score at which the shares of wrongly judged allowed and blocked URLs are least together; of several, that nearest
    to zero. Scores count in steps of a hundredth, of which there are no more than a few thousand."""
    steps = scored.groupBy(F.floor(F.col("score") * 100).alias("step")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    rows = steps.select("step", "good", "bad").collect()
    good, bad = sum(r["good"] for r in rows), sum(r["bad"] for r in rows)
    if not good or not bad:
        return float("-inf") if good or not bad else float("inf")
    lowest = min(r["step"] for r in rows)
    best, missed, passed = (1.0, abs(lowest), lowest), 0, bad
    for r in sorted(rows, key=lambda r: r["step"]):
        missed, passed = missed + r["good"], passed - r["bad"]
        best = min(best, (missed / good + passed / bad, abs(r["step"] + 1), r["step"] + 1))
    return best[2] / 100


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict and score (of the string; null where a rule decides)."""
    urls = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rule, verdict = fitting(rules, F.col("host"), F.col("path"))
    urls = urls.withColumn("rule", rule).withColumn("ruled", verdict).withColumn("s", F.regexp_replace(F.concat("host", F.lower("path")), r"\d", "0"))
    strings = stored(urls.groupBy("s").agg(F.sum((F.col("ruled") == "allow").cast("long")).alias("good"), F.sum((F.col("ruled") == "block").cast("long")).alias("bad")).na.fill(0, ["good", "bad"]))
    scored = stored(scores(strings, stored(train(strings))))
    limit = threshold(scored)
    joined = urls.join(scored.select("s", "score"), "s", "left")
    own = F.when(F.col("score") >= F.lit(limit), "allow").otherwise("block")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), F.when(F.col("rule").isNull(), F.col("score")).alias("score"))
