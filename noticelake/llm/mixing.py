"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source is dealt by hash into about sqrt(n) permuted blocks of its documents. A source's target is a number of whole
passes over its blocks plus a part of one more pass: every block that still fits in turn, then single documents of as many of
the other blocks as it takes to fill the rest.
These block quotas are exact. A binary tree splits the vector of quotas among the output shards: at each node the left half
gets a multivariate hypergeometric draw of its share of all blocks. Every leaf knows its range in each source's permuted
blocks from the path alone, so leaves are computed independently in tasks, and ranges are disjoint. A shard's documents
are shuffled locally by hash. Everything is fixed by the seed.

Per-document rows meet only the table of blocks (sqrt of the input) and one row per source; both are written first, so
Spark sees their size and broadcasts them only if they are small.

Defined cases: a null or empty text has size 0; a null source is a source, last in order; repeated rows are taken alike;
an empty table gives no rows; further columns take no part in the plan, and mixed() keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

WEIGHTS = (5, 2, 1)
MOST = 3
SHARD_WORDS = 5_000_000
#: Blocks at least, if there are, from which single documents complete a source's quota.
LAST = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, share: float = 1.0) -> DataFrame:
    """source, src (its rank by code point, null last), n_docs, source_size and target of every source.

    Sources share all words by weight; one whose share exceeds most times its size stops there. With sources in the order
    of most * size / weight, the first k are full for the least k at which the rest's level doesn't fill one more. Windows
    here see one row per source.
    """
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("src", F.row_number().over(order) - 1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.get(cycle, F.col("src") % len(weights))).withColumn("cap", most * F.col("source_size").cast("double"))
    fills = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    every = Window.partitionBy(F.lit(0))
    before = fills.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("level", (share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the level with the sources before this one full; it stands if this one is not filled by it
    stands = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "src", "level"))).over(every)
    per = per.withColumn("stands", stands)
    full = F.col("stands").isNull() | (F.struct(F.col("cap") / F.col("weight"), "src") < F.struct("stands.col1", "stands.src"))
    return per.select("source", "src", "n_docs", "source_size", F.when(full, F.col("cap")).otherwise(F.col("stands.level") * F.col("weight")).alias("target"))


def _whole(rows: pd.DataFrame) -> pd.DataFrame:
    """A source's blocks, each taken whole if it fits into what those before it left; room is what all of them leave."""
    rows = rows.sort_values("block")
    room, taken = float(rows["rest"].iloc[0]), []
    for words in rows["words"]:
        taken.append(0 < words <= room)
        room -= words if taken[-1] else 0
    return rows.assign(whole=taken, room=room)[["src", "block", "words", "passes", "whole", "room"]]


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    """The documents of a source's last blocks that fit into its room, larger ones first; then one more if that comes nearer."""
    room, taken = float(rows["room"].iloc[0]), []
    rows = rows.sort_values(["all", "doc_id"], ascending=[False, True])
    for size in rows["all"]:
        taken.append(size <= room)
        room -= size if size <= room else 0
    rows = rows.assign(part=taken)
    rest = rows.index[~rows["part"]]
    if len(rest) and rows.loc[rest[-1], "all"] < 2 * room:  # the smallest that is left
        rows.loc[rest[-1], "part"] = True
    return rows[["src", "doc_id", "size", "part"]]


def _leaves(batches: Iterator[pd.DataFrame], quotas: list[int], shards: int, seed: int) -> Iterator[pd.DataFrame]:
    """Every shard's range in each source's blocks: (shard, src, first, last), last excluded."""
    splits: dict[tuple[int, int], np.ndarray] = {}

    def left(lo: int, hi: int, have: np.ndarray) -> np.ndarray:
        """What shards lo to the middle get of have."""
        if (lo, hi) not in splits:
            middle = (lo + hi) // 2
            draw = int(have.sum()) * (middle - lo) // (hi - lo)
            rng = np.random.default_rng([seed, lo, hi])
            splits[lo, hi] = rng.multivariate_hypergeometric(have, draw, method="marginals") if draw else np.zeros_like(have)
        return splits[lo, hi]

    for batch in batches:
        for shard in batch["id"].tolist():
            lo, hi, have = 0, shards, np.array(quotas, np.int64)
            first = np.zeros_like(have)
            while hi - lo > 1:
                middle, part = (lo + hi) // 2, left(lo, hi, have)
                if shard < middle:
                    hi, have = middle, part
                else:
                    first, lo, have = first + part, middle, have - part
            src = np.flatnonzero(have)
            yield pd.DataFrame({"shard": shard, "src": src, "first": first[src], "last": (first + have)[src]})


class Mix:
    """sources, blocks and parts of a mix; draws says which shard each block goes to in each pass."""

    def __init__(self, sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, seed: int = 7, shard_words: int = SHARD_WORDS):
        """sizes: doc_id, source, size of every document."""
        spark, self.seed = sizes.sparkSession, seed
        self.sources = stored(source_targets(sizes, weights, most).withColumn("n_blocks", F.ceil(F.sqrt("n_docs")).cast("long")))
        placed = self.place(sizes)
        blocks = stored(placed.groupBy("src", "block").agg(F.sum("size").alias("words")))
        blocks = blocks.join(self.sources, "src").withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1)))
        blocks = blocks.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
        blocks = blocks.select("src", "block", "words", F.col("passes").cast("long").alias("passes"), F.col("rest").cast("double").alias("rest"))
        blocks = stored(blocks.groupBy("src").applyInPandas(_whole, "src int, block long, words long, passes long, whole boolean, room double"))
        # of the others, in order: as many as hold the room's words in documents that fit into it
        left = blocks.filter("not whole and room > 0 and words > 0")
        fits = placed.select("src", "block", "doc_id", "size").join(left.select("src", "block", "room"), ["src", "block"]).filter("size > 0 and size <= room")
        fits = fits.groupBy("src", "block", "doc_id", "size").agg(F.sum("size").alias("all"), F.first("room").alias("room")).filter("all <= room")
        left = left.join(fits.groupBy("src", "block").agg(F.sum("all").alias("fits")), ["src", "block"], "left")
        order = Window.partitionBy("src").orderBy("block")
        before = F.coalesce(F.sum("fits").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        left = left.withColumn("ending", (before < F.col("room")) | (F.row_number().over(order) <= LAST)).select("src", "block", "ending")
        blocks = blocks.join(left, ["src", "block"], "left").withColumn("ending", F.coalesce("ending", F.lit(False)))
        self.blocks = stored(blocks.select("src", "block", "passes", "room", "whole", "ending"))
        ending = placed.join(self.blocks.filter("ending").select("src", "block", "room"), ["src", "block"])
        ending = ending.groupBy("src", "doc_id", "size").agg(F.sum("size").alias("all"), F.first("room").alias("room"))
        self.parts = stored(ending.groupBy("src").applyInPandas(_fit, "src int, doc_id long, size long, part boolean").filter("part"))
        # draws: every pass over a block, in an order of its own per pass
        passes = F.col("passes") + F.when(F.col("whole") | F.col("ending"), 1).otherwise(0)
        drawn = self.blocks.filter(passes > 0).select("src", "block", F.explode(F.sequence(F.lit(0).cast("long"), passes - 1)).alias("pass"))
        drawn = drawn.withColumn("draw", F.row_number().over(Window.partitionBy("src").orderBy("pass", F.xxhash64("pass", "block", F.lit(seed)), "block")) - 1)
        # one number per source
        quotas = {r["src"]: r["n"] for r in drawn.groupBy("src").agg(F.count(F.lit(1)).alias("n")).collect()}
        total = self.sources.agg(F.sum("source_size")).first()[0] or 0
        self.shards = max(1, -(-total // shard_words))
        vector = [quotas.get(k, 0) for k in range(max(quotas, default=-1) + 1)]
        leaves = spark.range(self.shards).mapInPandas(partial(_leaves, quotas=vector, shards=self.shards, seed=seed), "shard long, src int, first long, last long")
        leaves = leaves.select("src", "shard", F.explode(F.sequence("first", F.col("last") - 1)).alias("draw"))
        self.draws = stored(drawn.join(leaves, ["src", "draw"]).select("src", "block", "pass", "shard"))

    def place(self, docs: DataFrame) -> DataFrame:
        """docs (doc_id, source, ...) with its source's columns and its block."""
        sources = self.sources.withColumnRenamed("source", "_source")
        joined = docs.join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        return joined.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(self.seed)), F.col("n_blocks")))

    def copies(self, docs: DataFrame) -> DataFrame:
        """docs (doc_id, source, size, ...) placed, with n_taken: how often the mix takes each."""
        per = stored(self.draws.groupBy("src", "block").agg(F.count(F.lit(1)).alias("drawn")).join(self.blocks.select("src", "block", "ending"), ["src", "block"]))
        joined = self.place(docs).join(per, ["src", "block"], "left").join(self.parts, ["src", "doc_id", "size"], "left")
        return joined.withColumn("n_taken", F.coalesce("drawn", F.lit(0)) - F.when(F.col("ending") & F.col("part").isNull(), 1).otherwise(0))

    def shuffled(self, docs: DataFrame) -> DataFrame:
        """One row per taken copy, docs' columns and shard; shards are shuffled within."""
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), F.struct(*docs.columns).alias("_row"))
        lists = stored(self.draws.groupBy("src", "block").agg(F.collect_list(F.struct("pass", "shard")).alias("drawn")).join(self.blocks.select("src", "block", "ending", "passes"), ["src", "block"]))
        placed = self.place(rows).join(lists, ["src", "block"]).join(self.parts, ["src", "doc_id", "size"], "left")
        taken = placed.select("_row", "doc_id", "ending", "passes", "part", F.explode("drawn").alias("_draw"))
        taken = taken.filter(~F.col("ending") | (F.col("_draw.pass") < F.col("passes")) | F.col("part").isNotNull())
        taken = taken.select("_row", F.col("_draw.shard").alias("_shard"), F.xxhash64("doc_id", "_draw.pass", F.lit(self.seed)).alias("_place"))
        # a shard holds about shard_words words, whatever its sources
        dealt = taken.repartition(F.col("_shard")).sortWithinPartitions("_shard", "_place")
        return dealt.select("_row.*")


def document_sizes(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every document."""
    sizes = stored(document_sizes(docs))
    found = Mix(sizes, **options).copies(sizes)
    return found.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("n_taken")).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """docs as the mix takes them: dropped, kept or repeated, in shards shuffled within."""
    return Mix(stored(document_sizes(docs)), **options).shuffled(docs)
