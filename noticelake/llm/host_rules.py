"""Quality rules judged per host: failure counts of a host, shrunk to a beta prior that is fitted to all hosts.

``document_figures`` counts what the rules need in each whole text; ``host_verdicts`` aggregates failures per host, fits a
beta prior to the hosts' rates by their mean and variance, and rejects a host whose shrunk rate exceeds a limit;
``host_rules`` joins that verdict back. In `documents` the host is `source`.

Defined cases: a null or empty text has no words and fails; a null host is a host of its own; repeated rows count as
often as they occur; an empty table gives no rows; further columns of the input take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.session import cut_lineage

from .text import FIRST, SPACES, Words, pieces, span_hashes, sums

SYMBOLS = np.zeros(256, bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
FIGURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
#: A host whose shrunk share of failing documents is above this is rejected as a whole.
HOST_LIMIT = 0.6


def _repeated_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier line of that text."""
    out = np.zeros(len(offsets) - 1, np.int64)
    breaks = sums(data == 10, offsets)
    for k in np.flatnonzero(breaks):
        lines = [x for x in data[offsets[k] : offsets[k + 1]].tobytes().split(b"\n") if x.strip(b"\x20\x09\x0a\x0b\x0c\x0d")]
        out[k] = len(lines) - len(set(lines))
    return out


def _repeat_words(words: Words) -> np.ndarray:
    """Words of each text inside 3-word windows that the text holds twice or more."""
    n = len(words.starts)
    docs = words.docs()
    covered = np.zeros(n + 1, np.int64)
    if n > 2:
        at = np.flatnonzero(docs[:-2] == docs[2:])
        keys = span_hashes(words.hashes(), at, at + 3) ^ (docs[at].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        order = np.argsort(keys)
        keys = keys[order]
        same = keys[1:] == keys[:-1]
        twice = np.zeros(len(at), bool)
        twice[1:] |= same
        twice[:-1] |= same
        for shift in range(3):
            covered[at[order[twice]] + shift] = 1
    return sums(covered[:n], words.first)


def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches (doc_id, host, text) to (doc_id, host, FIGURES)."""
    for batch in batches:
        for lo, hi, data, offsets in pieces(batch.column("text")):
            words = Words(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(lo, hi - lo),
                    batch.column("host").slice(lo, hi - lo),
                    *map(pa.array, (
                        words.counts, sums(FIRST[data] & ~SPACES[data], offsets), sums(SYMBOLS[data], offsets),
                        _repeated_lines(data, offsets), _repeat_words(words),
                    )),
                ],
                ["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
            )


def document_figures(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the figures of every document. One pass over the texts, no shuffle."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col(host).cast("string").alias("host"), "text")
    return rows.mapInArrow(figures, f"doc_id long, host string, {FIGURES}")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def host_verdicts(figured: DataFrame, failed: Column, limit: float = HOST_LIMIT) -> DataFrame:
    """host, n_docs, n_failed, host_rate (shrunk) and host_rejected, one row per host.

    Counts are combined before the shuffle, so a host with a third of all documents is a few rows. The prior has the mean and
    the variance of the hosts' rates, less the variance that sampling alone explains; with one host, or no variance beyond
    that, it is as strong as all documents of an average host.
    """
    hosts = figured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(failed.cast("long")).alias("n_failed")
    ).withColumn("rate", F.col("n_failed") / F.col("n_docs"))
    # four numbers about all hosts
    found = hosts.agg(
        (F.sum("n_failed") / F.sum("n_docs")).alias("mean"), F.var_pop("rate").alias("spread"),
        F.avg(1.0 / F.col("n_docs")).alias("inverse"), F.avg("n_docs").alias("size"),
    ).first()
    mean, strength = found["mean"] or 0.0, found["size"] or 1.0
    between = (found["spread"] or 0.0) - mean * (1 - mean) * (found["inverse"] or 0.0)
    if between > 0:
        strength = max(1.0, mean * (1 - mean) / between - 1)
    rate = (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength)
    return hosts.select("host", "n_docs", "n_failed", rate.alias("host_rate"), (rate > limit).alias("host_rejected"))


def host_rules(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Every document with its figures, base_failed, its host's shrunk rate, and kept."""
    figured = cut_lineage(document_figures(docs, host).withColumn("base_failed", base_failed()))
    verdicts = host_verdicts(figured, F.col("base_failed"), limit).withColumnRenamed("host", "of_host")
    joined = figured.join(verdicts, F.col("host").eqNullSafe(F.col("of_host")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")).drop("of_host")
