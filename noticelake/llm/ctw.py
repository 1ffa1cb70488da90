"""Language-model scores by context-tree weighting over bytes, beside a smoothed word unigram.

A text becomes its lower-cased words (A-Z), one blank behind each, and an end mark; bytes are decomposed into eight binary
decisions, each with a context tree over the preceding DEPTH bytes. With KT the Krichevsky-Trofimov estimate of a node's
counts, a node's weighted probability is

    Pw(s) = KT(s) / 2 + product of Pw(children) / 2   (KT(s) at full depth),

and a decision's probability mixes the KT estimates along its context by the posterior weights KT / 2 Pw. Counts,
weights and mixtures are made once per distinct context, from full depth up and down again. Unseen contexts count nothing,
so they predict evenly, as the tree says.

Texts are dealt by hash into blocks of about BLOCK bytes. A block's distinct words and byte grams (keys) are counted, summed
over blocks, valued by the model and joined back to the blocks, which then look up every byte. So the corpus decides the
size of the model, nothing of it is sent to all tasks, and no row is made per byte. Words are known by a 64-bit hash: among
4 million different words two collide with a chance of 1 in 2 million.

Defined cases: a null or empty text is the end mark alone; a null doc_id is learned from and not held out; repeated rows count
as often as they occur; with nothing to learn from all counts are zero; an empty table gives no rows; further columns take
no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Scratch, stored
from .text import Words, pieces, sums

DEPTH = 5
BLOCK = 20 << 20
#: Bytes of texts worked on at once: where keys are counted, every part is merged with those before; where texts are scored, parts only cost memory.
PART, SCORED = 2 << 20, 1 << 19
#: Stands before a text and is its end mark; no word and no blank holds it.
END = 10
WORD, GRAM = 0, 1


def byte_grams(words: Words, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(context bytes and the next byte as one number, of every byte and end mark; each text's first one and one end)."""
    spaced, starts = words.spaced()
    bounds = starts[words.first]
    sizes = np.diff(bounds)
    n = len(sizes)
    buffer = np.full(len(spaced) + n * (depth + 1), END, np.uint8)
    # in place: a part's numbers take eight times its bytes, each
    place = np.repeat(np.arange(n) * (depth + 1) + depth, sizes)
    place += np.arange(len(spaced))
    buffer[place] = spaced
    del place
    first = np.concatenate([[0], np.cumsum(sizes + 1)])
    at = np.arange(first[-1]) + np.repeat((np.arange(n) + 1) * depth, sizes + 1)
    grams = np.zeros(len(buffer), np.uint64)
    for k in range(depth + 1):
        grams[depth:] <<= np.uint64(8)
        grams[depth:] |= buffer[k : len(buffer) - depth + k]
    return grams[at], first


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their counts summed."""
    key, count = np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0, np.int64), *counts])
    if not len(key):
        return key, count
    order = np.argsort(key)
    key, count = key[order], count[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[new], np.add.reduceat(count, new)


def _counted(keys: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how many learned occurrences each has."""
    some, n = np.unique(keys[learned], return_counts=True)
    others = np.unique(keys[~learned])
    return _merged([some, others], [n, np.zeros(len(others), np.int64)])


def _parts(block: pa.Table, size: int):
    """A block's texts, some at a time: (from row, to row, words, grams, each text's first gram and one end)."""
    base = 0
    for chunk in block["text"].chunks:
        for lo, hi, data, offsets in pieces(chunk, size):
            words = Words(data, offsets, lower=True)
            yield base + lo, base + hi, words, *byte_grams(words)
        base += len(chunk)


def _block_keys(key: tuple, block: pa.Table) -> pa.Table:
    """A block's distinct keys in order. Parts are merged as they come, so that a block's own grams are never held together."""
    learned = ~np.asarray(block["held_out"].combine_chunks().to_numpy(zero_copy_only=False), bool)
    found = [_merged([], []), _merged([], [])]
    for lo, hi, words, grams, first in _parts(block, PART):
        for k, (keys, each) in enumerate(((words.hashes(), words.counts), (grams, np.diff(first)))):
            some, n = _counted(keys, np.repeat(learned[lo:hi], each))
            found[k] = _merged([found[k][0], some], [found[k][1], n])
    total = sum(len(k) for k, _ in found)
    return pa.table({
        "block": pa.array(np.full(total, key[0].as_py(), np.int64)),
        "kind": pa.array(np.repeat(np.array([WORD, GRAM], np.int32), [len(k) for k, _ in found])),
        "key": pa.array(np.concatenate([k for k, _ in found]).view(np.int64)),
        "n": pa.array(np.concatenate([c for _, c in found])),
    })


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function, for x > 0."""
    shift = sum(np.log(x + i) for i in range(8))
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - shift


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a node's decisions."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def _suffix(nodes: np.ndarray, depth: int) -> np.ndarray:
    """Node numbers (context bytes, then 1 and the bits so far in a byte) with the context's last depth bytes alone."""
    return nodes & np.uint64((1 << 8 * (depth + 1)) - 1)


class Level:
    """All nodes of one depth in order, with their counts, weighted probability (ln) and the weight at which a path stops there."""

    def __init__(self, nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None, weighted: np.ndarray | None = None):
        """Rows of one node are summed. below: ln of the children's probabilities; none at full depth. weighted: known already."""
        order = np.argsort(nodes, kind="stable")
        nodes = nodes[order]
        new = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]])) if len(nodes) else np.zeros(0, np.int64)
        add = lambda x: np.add.reduceat(x[order], new) if len(new) else np.zeros(0)
        self.nodes, self.zeros, self.ones = nodes[new], add(zeros.astype(float)), add(ones.astype(float))
        own = estimate(self.zeros, self.ones)
        if below is None:
            self.weighted, self.stop = own, np.ones(len(own))
        else:
            self.weighted = np.logaddexp(own, add(below)) - math.log(2)
            self.stop = np.exp(own - math.log(2) - self.weighted)
        if weighted is not None:
            self.weighted, self.stop = weighted[order][new], np.exp(own - math.log(2) - weighted[order][new])

    def shorter(self, depth: int) -> Level:
        return Level(_suffix(self.nodes, depth), self.zeros, self.ones, self.weighted)

    def mixed(self, depth: int, above: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nodes, P(1) mixed so far, weight not yet given away), from the same of the depth above."""
        one = (self.ones + 0.5) / (self.zeros + self.ones + 1)
        if above is None:
            return self.nodes, self.stop * one, 1 - self.stop
        at = np.searchsorted(above[0], _suffix(self.nodes, depth - 1))
        return self.nodes, above[1][at] + above[2][at] * self.stop * one, above[2][at] * (1 - self.stop)


def _steps(grams: np.ndarray):
    """(node, bit) of the eight decisions of every gram's last byte."""
    symbol = grams & np.uint64(255)
    for k in range(8):
        yield (grams & ~np.uint64(255)) | ((symbol | np.uint64(256)) >> np.uint64(8 - k)), (symbol >> np.uint64(7 - k)) & np.uint64(1)


def _leaves(grams: np.ndarray, counts: np.ndarray) -> Level:
    steps = list(_steps(grams))
    bits = np.concatenate([b for _, b in steps]) == 1
    n = np.tile(counts, 8)
    return Level(np.concatenate([x for x, _ in steps]), np.where(bits, 0, n), np.where(bits, n, 0), None)


def _columns(batches: Iterator[pa.RecordBatch], *names: str) -> list[np.ndarray]:
    got = [[b.column(c).to_numpy(zero_copy_only=False) for c in names] for b in batches]
    return [np.concatenate(x) for x in zip(*got, strict=True)] if got else [np.zeros(0, np.int64) for _ in names]


LEVEL = "node long, zeros double, ones double, weighted double"
MIXED = "node long, p double, rest double"


def _level_batch(x: Level) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.nodes.view(np.int64)), pa.array(x.zeros), pa.array(x.ones), pa.array(x.weighted)], ["node", "zeros", "ones", "weighted"])


def _grams_up(batches: Iterator[pa.RecordBatch], depth: int, to: int) -> Iterator[pa.RecordBatch]:
    """Grams that share their contexts' last bytes, to the level of depth to."""
    grams, counts = _columns(batches, "gram", "n")
    level = _leaves(grams.view(np.uint64), counts)
    for d in range(depth - 1, to - 1, -1):
        level = level.shorter(d)
    yield _level_batch(level)


def _levels_up(batches: Iterator[pa.RecordBatch], depth: int, to: int) -> Iterator[pa.RecordBatch]:
    level = _known_level(batches)
    for d in range(depth - 1, to - 1, -1):
        level = level.shorter(d)
    yield _level_batch(level)


def _known_level(batches: Iterator[pa.RecordBatch]) -> Level:
    nodes, zeros, ones, weighted = _columns(batches, "node", "zeros", "ones", "weighted")
    return Level(nodes.view(np.uint64), zeros, ones, weighted * 0, weighted)


def _levels_down(batches: Iterator[pa.RecordBatch], depth: int, above: tuple, at: int) -> Iterator[pa.RecordBatch]:
    """A level's mixtures from those of the depth at."""
    levels = [_known_level(batches)]
    for d in range(depth - 1, at, -1):
        levels.append(levels[-1].shorter(d))
    for d, level in zip(range(at + 1, depth + 1), reversed(levels), strict=True):
        above = level.mixed(d, above)
    yield pa.RecordBatch.from_arrays([pa.array(above[0].view(np.int64)), pa.array(above[1]), pa.array(above[2])], ["node", "p", "rest"])


def _grams_down(batches: Iterator[pa.RecordBatch], depth: int, at: int) -> Iterator[pa.RecordBatch]:
    """Grams (node null) with the mixtures of depth at that they need, to log10 of each gram's probability."""
    gram, n, node, p, rest = _columns(batches, "gram", "n", "node", "p", "rest")
    is_gram = ~np.isnan(n.astype(float))
    grams, counts = gram[is_gram].astype(np.int64).view(np.uint64), n[is_gram].astype(np.int64)
    order = np.argsort(node[~is_gram].astype(np.int64).view(np.uint64))
    above = node[~is_gram].astype(np.int64).view(np.uint64)[order], p[~is_gram][order], rest[~is_gram][order]
    levels = [_leaves(grams, counts)]
    for d in range(depth - 1, at, -1):
        levels.append(levels[-1].shorter(d))
    for d, level in zip(range(at + 1, depth + 1), reversed(levels), strict=True):
        above = level.mixed(d, above)
    value = np.zeros(len(grams))
    for nodes, bits in _steps(grams):
        one = above[1][np.searchsorted(above[0], nodes)] if len(grams) else np.zeros(0)
        value += np.log10(np.where(bits == 1, one, 1 - one))
    yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(value)], ["gram", "value"])


def gram_values(grams: DataFrame, depth: int = DEPTH) -> DataFrame:
    """grams (gram, n: learned occurrences) to (gram, value: log10 of the mixed probability of its last byte in its context).

    The trees are cut at depths 3 and 1. What shares the last 3 bytes of its context is worked through in one task, from full
    depth up; then what shares the last byte; the 255 nodes of each last byte (65,280 at most) meet on the driver. The
    mixtures come down the same way.
    """
    scratch, low, high = Scratch(), min(3, depth - 1), 1
    by = lambda df, d, name: df.repartition(F.expr(f"{name} & {((1 << 8 * d) - 1) << 8}L"))
    middle = scratch.stored(by(grams, low, "gram").mapInArrow(partial(_grams_up, depth=depth, to=low), LEVEL))
    top = by(middle, high, "node").mapInArrow(partial(_levels_up, depth=low, to=high), LEVEL).collect()  # at most 65,280 rows
    nodes, zeros, ones, weighted = (np.array([r[k] for r in top], kind) for k, kind in enumerate((np.int64, float, float, float)))
    first = Level(nodes.view(np.uint64), zeros, ones, weighted * 0, weighted)
    above = first.mixed(1, first.shorter(0).mixed(0, None))
    mixed = scratch.stored(by(middle, high, "node").mapInArrow(partial(_levels_down, depth=low, above=above, at=high), MIXED))
    none = F.lit(None)
    rows = grams.select("gram", F.col("n").cast("double").alias("n"), none.cast("long").alias("node"), none.cast("double").alias("p"), none.cast("double").alias("rest"))
    # a node's context stands where a gram's does
    rows = rows.union(mixed.select(F.col("node"), none.cast("double"), "node", "p", "rest"))
    values = stored(by(rows, low, "gram").mapInArrow(partial(_grams_down, depth=depth, at=low), "gram long, value double"))
    scratch.drop()
    return values


def _score(key: tuple, block: pa.Table, values: pa.Table, tokens: int, kinds: int, ends: int) -> pa.Table:
    kind, keys, value = (values[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("kind", "key", "value"))
    own = {}
    for which in (WORD, GRAM):
        mine = kind == which
        order = np.argsort(keys[mine].view(np.uint64))
        own[which] = keys[mine].view(np.uint64)[order], value[mine][order]
    del kind, keys, value, mine, order

    def look_up(which: int, wanted: np.ndarray) -> np.ndarray:
        known, worth = own[which]
        if not len(wanted):
            return np.zeros(0)
        at = np.searchsorted(known, wanted)
        assert np.array_equal(known[np.minimum(at, len(known) - 1)], wanted), "a key of the block has no value"
        return worth[at]

    unit, columns = float(tokens + kinds + 1), []
    for _, _, words, grams, first in _parts(block, SCORED):
        counts = look_up(WORD, words.hashes())
        base = sums(np.log10((counts + 1) / unit), words.first) + math.log10((ends + 1) / unit)
        columns.append((words.counts + 1, sums(counts > 0, words.first) + (ends > 0), base, sums(look_up(GRAM, grams), first), np.diff(first)))
    n_tokens, n_known, base, score, n_bytes = (np.concatenate(x) for x in zip(*columns, strict=True)) if columns else [np.zeros(0)] * 5
    return pa.table({
        "doc_id": block["doc_id"], "held_out": block["held_out"], "n_tokens": pa.array(n_tokens, pa.int64()), "n_known": pa.array(n_known, pa.int64()),
        "train_tokens": pa.array(np.full(len(block), tokens, np.int64)), "base_score": pa.array(base), "score": pa.array(score), "n_bytes": pa.array(n_bytes, pa.int64()),
    })


def scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), n_bytes of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size, ends = rows.agg(F.sum(F.octet_length("text") + 1), F.sum((~F.col("held_out")).cast("long"))).first()
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, -(-(size or 0) // BLOCK)))))
    keys = stored(rows.groupBy("block").applyInArrow(_block_keys, "block long, kind int, key long, n long"), ascending=True)
    words = keys.filter(F.col("kind") == WORD).groupBy("key").agg(F.sum("n").alias("n"))
    scratch = Scratch()
    words = scratch.stored(words)
    known = words.agg(F.sum("n"), F.sum((F.col("n") > 0).cast("long"))).first()
    ends = ends or 0
    tokens, kinds = (known[0] or 0) + ends, (known[1] or 0) + (ends > 0)
    grams = scratch.stored(keys.filter(F.col("kind") == GRAM).groupBy(F.col("key").alias("gram")).agg(F.sum("n").alias("n")))
    valued = gram_values(grams)
    scratch.tables.append(valued)
    model = stored(words.select(F.lit(WORD).alias("kind"), "key", F.col("n").cast("double").alias("value")).union(valued.select(F.lit(GRAM), "gram", "value")))
    scratch.drop()
    values = keys.select("block", "kind", "key").join(model, ["kind", "key"])
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"
    return rows.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(partial(_score, tokens=tokens, kinds=kinds, ends=ends), schema)
