"""Exact removal of long word spans that an earlier document holds too, on a compacted de Bruijn graph of token k-mers.

Of all 16-word k-mers the graph has those that are the least of some window of 50 words: equal windows have equal ones. A k-mer
is an edge. An occurrence stands for a stretch of consecutive windows; its arc is their text. A document is the chain of its arcs.

1. Edges that only one document holds are dropped: none of their windows repeats.
2. The arcs of the other edges are the graph's nodes. A node whose occurrences all have one and the same next arc, which in turn always
   has this node before it, doesn't branch there. Joins of the nodes find these links, and joins of the links with themselves
   (each reaching twice as far as the one before) find each node's path head. A path's occurrences are then one row each, however many
   arcs it has: whoever comes after the smallest document that holds a path loses all its windows.
3. Where an edge branches (several arcs), the smallest document of each arc is compared window by window: the windows at
   its source coordinates are hashed from the text (128 bits), and the smallest document of each window decides.

Where equal k-mers lie within one window (a word or a line repeated over and over), a window takes the one that the window
before it took, or else the last one, so such texts have as few arcs as others.

Defined cases: null and empty texts have no words; fewer than 50 words are never removed; rows that repeat a doc_id are
judged each by itself against smaller ids; a null doc_id is neither removed from nor compared; an empty table gives no
rows; further columns take no part (without_repeats keeps them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch, fresh, stored
from .text import Words, pieces, span_hashes

WINDOW, KMER = 50, 16
_PLACE = np.uint64((1 << 28) - 1)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of width keys, by doubling."""
    have, out = 1, keys
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(keys) - width + 1], out[width - have :])


def _stretches(values: np.ndarray, last: np.ndarray, window_at: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, k-mer) of stretches: windows in a row with one least k-mer.

    values: hash of each k-mer; last: each window's last k-mer with the least hash; window_at, owner: windows and their documents.
    """
    least = values[last[window_at]]
    new = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])]))
    lo, count, chosen = window_at[new], np.diff(np.append(new, len(window_at))), last[window_at[new]]
    short = np.flatnonzero(chosen < lo + count - 1)  # equal k-mers follow each other
    if not len(short):
        return lo, count, chosen
    found = []
    for k in short.tolist():
        at, end = int(lo[k]), int(lo[k] + count[k])
        while at < end:
            to = min(end, int(last[at]) + 1)
            found.append((at, to - at, int(last[at])))
            at = to
    whole = np.ones(len(lo), bool)
    whole[short] = False
    parts = [np.concatenate([x[whole], np.array(y)]) for x, y in zip((lo, count, chosen), zip(*found, strict=True), strict=True)]
    order = np.argsort(parts[0], kind="stable")
    return parts[0][order], parts[1][order], parts[2][order]


def arcs_of(words: Words, window: int = WINDOW, kmer: int = KMER) -> tuple[np.ndarray, ...]:
    """(document, edge, arc, arc before, arc behind, first window, windows) of each stretch of windows with one least k-mer; 0: no arc."""
    n = len(words.starts)
    none = (np.zeros(0, np.int64), *(np.zeros(0, np.uint64) for _ in range(4)), np.zeros(0, np.int64), np.zeros(0, np.int64))
    if n < window:
        return none
    at = np.arange(n - kmer + 1)
    edges = span_hashes(words.hashes(), at, at + kmer)
    # a smaller number for a later place, so that of equal hashes the last is the least
    last = (_PLACE - (_least((edges & ~_PLACE) | (_PLACE - at.astype(np.uint64)), window - kmer + 1) & _PLACE)).astype(np.int64)
    docs = words.docs()
    valid = np.flatnonzero(docs[: n - window + 1] == docs[window - 1 :])
    if not len(valid):
        return none
    lo, count, chosen = _stretches(edges & ~_PLACE, last, valid, docs[valid])
    owner = docs[lo]
    spaced, starts = words.spaced()
    raw, digest = spaced.tobytes(), xxhash.xxh3_64_intdigest
    begins, ends = starts[lo].tolist(), (starts[lo + count - 1 + window] - 1).tolist()
    arcs = np.array([digest(raw[a:b], k) or 1 for a, b, k in zip(begins, ends, (chosen - lo).tolist(), strict=True)], np.uint64)
    chained = owner[1:] == owner[:-1]
    before, behind = np.zeros_like(arcs), np.zeros_like(arcs)
    before[1:][chained] = arcs[:-1][chained]
    behind[:-1][chained] = arcs[1:][chained]
    return owner, edges[chosen] & ~_PLACE, arcs, before, behind, lo - words.first[owner], count


ARCS = "edge long, arc long, before long, behind long, doc_id long, text_key long, lo int, n int"


def _arc_rows(batches: Iterator[pa.RecordBatch], window: int, kmer: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("text_key").to_numpy(zero_copy_only=False)
        for lo, hi, data, offsets in pieces(batch.column("text")):
            doc, *keys, first, count = arcs_of(Words(data, offsets), window, kmer)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(k.view(np.int64)) for k in keys), pa.array(ids[lo:hi][doc], pa.int64()), pa.array(texts[lo:hi][doc], pa.int64()), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))],
                ["edge", "arc", "before", "behind", "doc_id", "text_key", "lo", "n"],
            )


def _window_rows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_key, text, los, ns) to one row per window of these stretches."""
    digest = xxhash.xxh3_128_intdigest
    for batch in batches:
        for lo, hi, data, offsets in pieces(batch.column("text")):
            words = Words(data, offsets)
            spaced, starts = words.spaced()
            raw = spaced.tobytes()
            los, ns = batch.column("los").slice(lo, hi - lo), batch.column("ns").slice(lo, hi - lo)
            each = np.array(los.value_lengths().fill_null(0), np.int64)
            first, count = np.array(los.flatten(), np.int64), np.array(ns.flatten(), np.int64)
            doc = np.repeat(np.repeat(np.arange(hi - lo), each), count)
            place = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at = place + words.first[doc]
            hashes = [digest(raw[a:b]) for a, b in zip(starts[at].tolist(), (starts[at + window] - 1).tolist(), strict=True)]
            high = np.array([x >> 64 for x in hashes], np.uint64).view(np.int64)
            low = np.array([x & 0xFFFFFFFFFFFFFFFF for x in hashes], np.uint64).view(np.int64)
            ids, keys = (batch.column(c).slice(lo, hi - lo).take(pa.array(doc)) for c in ("doc_id", "text_key"))
            yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(low), ids, keys, pa.array(place.astype(np.int32))], ["high", "low", "doc_id", "text_key", "lo"])


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def _lists(spans: DataFrame) -> DataFrame:
    """One row per document, with its stretches as arrays."""
    listed = spans.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("lo", "n")).alias("spans"))
    return listed.select("doc_id", "text_key", F.col("spans.lo").alias("los"), F.col("spans.n").alias("ns"))


def path_heads(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """nodes (edge, arc, n, before_least, before_most, behind_least, behind_most) to (edge, arc, head_edge, head_arc): the head of
    each node's nonbranching path.

    Links join nodes; then each node points to the one before it, and every round makes the pointers reach twice as far, so rounds grow
    as the logarithm of the longest path. A document's first arc has nothing before it, so there is no circle.
    """
    own = nodes.select("edge", "arc", "before_least", "before_most")
    only = nodes.filter("behind_least = behind_most and behind_least <> 0").select(F.col("edge").alias("to_edge"), F.col("arc").alias("to_arc"), F.col("behind_least").alias("follows"))
    linked = own.filter("before_least = before_most and before_least <> 0").join(only, (F.col("follows") == F.col("arc")) & (F.col("to_arc") == F.col("before_least")))
    pointers = scratch.stored(linked.select("edge", "arc", "to_edge", "to_arc"))
    heads = nodes.select("edge", "arc")
    moved = pointers.count()
    while moved:
        there = pointers.select(F.col("edge").alias("to_edge"), F.col("arc").alias("to_arc"), F.col("to_edge").alias("far_edge"), F.col("to_arc").alias("far_arc"))
        longer = pointers.join(there, ["to_edge", "to_arc"], "left")
        last, pointers = pointers, scratch.stored(longer.select(
            "edge", "arc", F.coalesce("far_edge", "to_edge").alias("to_edge"), F.coalesce("far_arc", "to_arc").alias("to_arc"), F.col("far_arc").isNotNull().alias("moved")
        ))
        scratch.drop(last)
        moved = pointers.filter("moved").limit(1).count()
        pointers = pointers.drop("moved") if moved else pointers
    found = heads.join(pointers.select("edge", "arc", "to_edge", "to_arc"), ["edge", "arc"], "left")
    return found.select("edge", "arc", F.coalesce("to_edge", "edge").alias("head_edge"), F.coalesce("to_arc", "arc").alias("head_arc"))


def compacted(hits: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(nodes, paths) of the arcs of repeated edges: nodes with their first occurrence's coordinates; paths by their head node,
    with the smallest document and the number of windows of the whole path."""
    least, most = (lambda c: F.min(c).alias(f"{c}_least")), (lambda c: F.max(c).alias(f"{c}_most"))
    nodes = scratch.stored(hits.groupBy("edge", "arc").agg(
        F.min(F.struct("doc_id", "text_key", "lo", "branches")).alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("times"), F.min("n").alias("n"),
        least("before"), most("before"), least("behind"), most("behind"),
    ))
    heads = path_heads(nodes, scratch)
    sized = heads.join(nodes.select("edge", "arc", "n", F.col("first.doc_id").alias("first"), "last"), ["edge", "arc"])
    paths = sized.groupBy(F.col("head_edge").alias("edge"), F.col("head_arc").alias("arc")).agg(
        F.sum("n").cast("int").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    return nodes, scratch.stored(paths.filter("first < last").drop("last"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """doc_id, text_key, lo, n: stretches of windows (first window, how many) to remove from a document.

    Each join is of two stored tables, the smaller one unique in its keys, so that Spark may split what an edge with very many
    occurrences adds to one task.
    """
    keyed = _keyed(docs).filter("doc_id is not null")
    scratch = Scratch()
    arcs = scratch.stored(keyed.mapInArrow(partial(_arc_rows, window=window, kmer=kmer), ARCS))
    edges = arcs.groupBy("edge").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), (F.min("arc") < F.max("arc")).alias("branches"))
    repeated = scratch.stored(edges.filter("a < b").select("edge", "branches"))
    hits = scratch.stored(arcs.join(repeated, "edge"))
    scratch.drop(arcs, repeated)
    nodes, paths = compacted(hits, scratch)
    settled = scratch.stored(hits.select("edge", "arc", "doc_id", "text_key", "lo").join(paths, ["edge", "arc"]).filter("doc_id > first").select("doc_id", "text_key", "lo", "n"))
    # where an edge branches, all that the smallest document has of an arc is asked for
    branching = nodes.filter("first.branches")
    once = branching.filter("times = 1").select("first.doc_id", "first.text_key", "first.lo", "n")
    often = scratch.stored(branching.filter("times > 1").select("edge", "arc", "first.doc_id"))
    asked = scratch.stored(once.union(hits.filter("branches").join(often, ["edge", "arc", "doc_id"]).select("doc_id", "text_key", "lo", "n")))
    scratch.drop(hits, paths, often)
    asked = _lists(asked)
    windows = keyed.join(asked, ["doc_id", "text_key"], "left").filter("los is not null").select("doc_id", "text_key", "text", "los", "ns")
    windows = windows.mapInArrow(partial(_window_rows, window=window), "high long, low long, doc_id long, text_key long, lo int")
    windows = scratch.stored(windows)
    earlier = windows.groupBy("high", "low").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    compared = windows.join(scratch.stored(earlier), ["high", "low"]).filter("doc_id > first").select("doc_id", "text_key", "lo", F.lit(1).alias("n"))
    spans = stored(settled.union(compared))
    scratch.drop()
    return spans


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, los, ns) to (doc_id, text_key, kept, n_words, n_removed, sha256)."""
    for batch in batches:
        los, ns = batch.column("los"), batch.column("ns")
        for lo, hi, data, offsets in pieces(batch.column("text")):
            words = Words(data, offsets)
            spaced, starts = words.spaced()
            each = np.array(los.slice(lo, hi - lo).value_lengths().fill_null(0), np.int64)
            first, count = np.array(los.slice(lo, hi - lo).flatten(), np.int64), np.array(ns.slice(lo, hi - lo).flatten(), np.int64)
            at = first + words.first[np.repeat(np.arange(hi - lo), each)]
            change = np.zeros(len(words.starts) + 1, np.int64)
            np.add.at(change, at, 1)
            np.add.at(change, at + count - 1 + window, -1)
            gone = np.cumsum(change)[:-1] > 0
            raw, flat = spaced.tobytes(), data.tobytes()
            kept, shas, removed = [], [], []
            for d in range(hi - lo):
                a, b = int(words.first[d]), int(words.first[d + 1])
                out = gone[a:b]
                n_out = int(out.sum())
                removed.append(n_out)
                if not n_out:
                    kept.append(None)
                    shas.append(hashlib.sha256(raw[starts[a] : max(starts[a], starts[b] - 1)]).hexdigest())
                    continue
                edges = np.flatnonzero(np.diff(np.concatenate([[1], out, [1]]).astype(np.int8)))
                runs = [(a + int(x), a + int(y)) for x, y in zip(edges[::2], edges[1::2], strict=True)]
                kept.append(b"\n".join(flat[words.starts[x] : words.ends[y - 1]] for x, y in runs))
                shas.append(hashlib.sha256(b" ".join(raw[starts[x] : starts[y] - 1] for x, y in runs)).hexdigest())
            part = [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_key")]
            yield pa.RecordBatch.from_arrays(
                [*part, pa.array(kept, pa.binary()).cast(pa.string()), pa.array(words.counts), pa.array(removed, pa.int64()), pa.array(shas, pa.string())],
                ["doc_id", "text_key", "kept", "n_words", "n_removed", "kept_sha256"],
            )


def cut_documents(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """doc_id, text_key, kept (the text that is left; null: all of it), n_words, n_removed, kept_sha256, for every row."""
    spans = _lists(repeated_spans(docs, window, kmer))
    texts = _keyed(docs).join(spans, ["doc_id", "text_key"], "left").select("doc_id", "text_key", "text", "los", "ns")
    return texts.mapInArrow(partial(_cut, window=window), "doc_id long, text_key long, kept string, n_words long, n_removed long, kept_sha256 string")


def _rewrite(batches: Iterator[pa.RecordBatch], window: int, text_at: int) -> Iterator[pa.RecordBatch]:
    """Rows with the arrays of their stretches last: the text replaced by what is left of it."""
    for batch in batches:
        n = batch.num_columns
        small = pa.RecordBatch.from_arrays([pa.nulls(len(batch), pa.int64()), pa.nulls(len(batch), pa.int64()), batch.column(text_at), batch.column(n - 2), batch.column(n - 1)], ["doc_id", "text_key", "text", "los", "ns"])
        kept = pa.chunked_array([x.column("kept") for x in _cut(iter([small]), window)] or [pa.array([], pa.string())]).combine_chunks()
        columns = list(batch.columns[: n - 2])
        columns[text_at] = pc.coalesce(kept, batch.column(text_at).cast(pa.string()))
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names[: n - 2])


def without_repeats(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """docs with repeated spans cut from their texts (a line feed stands where one was); other texts stay as they are."""
    doc, key, los, ns = fresh(docs.columns, "_doc", "_key", "_los", "_ns")
    spans = _lists(repeated_spans(docs, window, kmer)).withColumnsRenamed({"doc_id": doc, "text_key": key, "los": los, "ns": ns})
    on = (F.col("doc_id").cast("long") == F.col(doc)) & (F.xxhash64(F.col("text").cast("string")) == F.col(key))
    joined = docs.join(spans, on, "left").select(*docs.columns, los, ns)
    cut = joined.mapInArrow(partial(_rewrite, window=window, text_at=docs.columns.index("text")), docs.schema)
    return cut
