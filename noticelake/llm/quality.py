"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its emission scores see its own figures and those of its neighbours; transition scores tie
consecutive labels. Forward-backward gives each line's marginal, a document's value is their mean weighted by line length,
and a logistic curve calibrates it to the share of good labels. The model is fitted in numpy on a bounded sample of labelled
documents (SAMPLE; by hash of doc_id, whole texts), each line labelled as its document. Scoring is one pass over the texts,
no shuffle.

Defined cases: a null or empty text is one empty line; without labels of both kinds the score is the share of good ones (0.5
without any); repeated rows score alike; a doc_id labelled twice counts with its smaller label; an empty table gives no rows;
further columns take no part (good_documents keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import fresh
from .text import Words, mix, pieces, sums

SAMPLE = 3000
CHUNK = 2 << 20


def _kinds(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(chars, np.uint8)] = True
    return out


_UPPER, _DIGIT = _kinds(bytes(range(65, 91))), _kinds(b"0123456789")
_MARK, _CALL, _BAR = _kinds(b"#*$%&<>=_~^{}[]\\"), _kinds(b"!?"), _kinds(b"|")
_POINT, _HIGH = _kinds(b".,;:"), np.arange(256) > 127
FIGURES = 24


def line_figures(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(figures of every line, its length in bytes, first line of every text and one end)."""
    breaks = np.flatnonzero(data == 10)
    counts = np.bincount(np.searchsorted(offsets, breaks, "right") - 1, minlength=len(offsets) - 1) + 1
    first = np.concatenate([[0], np.cumsum(counts)])
    starts = np.empty(first[-1], np.int64)
    starts[first[:-1]] = offsets[:-1]
    inner = np.ones(first[-1], bool)
    inner[first[:-1]] = False
    starts[inner] = breaks + 1
    ends = np.append(starts[1:], len(data))
    ends[:-1] -= inner[1:]  # the line feed itself; a text's last line has none
    words = Words(data, offsets)
    at = np.searchsorted(words.starts, np.append(starts, len(data)))
    n = np.diff(at)
    sizes = ends - starts
    hashes = words.hashes()
    line = np.repeat(np.arange(len(n)), n)
    adjacent = np.zeros(len(hashes), bool)
    adjacent[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    keys = mix(hashes ^ (line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(keys)
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    some, wide = np.maximum(n, 1), np.maximum(sizes, 1)

    def share(kind: np.ndarray, per: np.ndarray) -> np.ndarray:
        hits = np.zeros(len(data) + 1, np.int64)
        np.cumsum(kind[data], out=hits[1:])
        return (hits[ends] - hits[starts]) / per

    base = [
        share(_UPPER, wide), share(_MARK, some), share(_CALL, some), share(_BAR, some), share(_DIGIT, wide), share(_POINT, some),
        share(_HIGH, wide), sums(adjacent, at) / some, sums(again, at) / some,
    ]
    out = np.empty((len(n), FIGURES))
    for k, x in enumerate(base):
        out[:, 2 * k], out[:, 2 * k + 1] = np.minimum(x, 1), np.sqrt(np.minimum(x, 1))
    rest = [np.minimum(np.log1p(n) / 6, 1.5), np.minimum(sizes / some / 12, 2), n == 0, n < 4, sums(again, at) > 0.5 * some, np.ones(len(n))]
    out[:, 18:] = np.stack(rest, 1)
    return out, sizes, first


def with_neighbours(figures: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's figures, then those of the line before and after it (zero at a text's ends)."""
    n = len(figures)
    before, after = np.zeros_like(figures), np.zeros_like(figures)
    before[1:], after[:-1] = figures[:-1], figures[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.concatenate([figures, before, after], 1) if n else np.zeros((0, 3 * FIGURES))


@dataclass
class Model:
    weights: np.ndarray  # emission score of good over bad
    moves: np.ndarray  # 2 x 2 transition scores
    slope: float
    shift: float


def marginals(scores: np.ndarray, moves: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(P(good) of each line, expected transitions summed, log partition of each text), all texts step by step at once."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    begin, length = first[:-1][order], counts[order]
    still = np.searchsorted(-length, -np.arange(1, (length.max() if len(length) else 0) + 1), "right")  # texts with that many lines
    emit = np.exp(np.stack([np.minimum(0, -scores), np.minimum(0, scores)], 1))  # scaled so that the larger one is 1
    base = np.where(scores > 0, scores, 0.0)
    move = np.exp(moves)
    alpha, scale = np.empty_like(emit), np.empty(len(scores))
    for t, k in enumerate(still):
        at = begin[:k] + t
        a = emit[at] if t == 0 else (alpha[at - 1] @ move) * emit[at]
        scale[at] = a.sum(1)
        alpha[at] = a / scale[at][:, None]
    beta, pairs = np.ones_like(emit), np.zeros((2, 2))
    for t in range(len(still) - 1, 0, -1):
        at = begin[: still[t]] + t
        back = emit[at] * beta[at] / scale[at][:, None]
        beta[at - 1] = back @ move.T
        pairs += move * (alpha[at - 1].T @ back)
    both = alpha * beta
    total = np.zeros(len(counts))
    filled = np.flatnonzero(counts)
    total[filled] = np.add.reduceat(np.log(scale) + base, first[filled]) if len(filled) else 0
    return both[:, 1] / both.sum(1), pairs, total


def document_values(model: Model, figures: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean marginal of a text's lines by length, as a log-odds."""
    good, _, _ = marginals(with_neighbours(figures, first) @ model.weights, model.moves, first)
    weight = sizes + 1.0
    mean = np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1]) if len(first) > 1 else np.zeros(0)
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    return np.log(mean / (1 - mean))


def sampled_figures(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """line_figures() of these texts, some at a time to bound the memory in between."""
    parts = [line_figures(data, offsets) for lo in range(0, len(texts), 200) for _, _, data, offsets in pieces(pa.array(texts[lo : lo + 200], pa.large_string()), 1 << 20)]
    counts = np.concatenate([np.diff(first) for _, _, first in parts])
    return np.concatenate([f for f, _, _ in parts]), np.concatenate([s for _, s, _ in parts]), np.concatenate([[0], np.cumsum(counts)])


def fit(texts: list[str], labels: list[int], steps: int = 200, decay: float = 1e-4) -> Model:
    """Penalised maximum likelihood by Adam on the whole sample, then the logistic curve on top."""
    share = float(np.mean(labels)) if labels else 0.5
    constant = Model(np.zeros(3 * FIGURES), np.zeros((2, 2)), 0.0, float(np.log(max(share, 1e-3) / max(1 - share, 1e-3))))
    if len(set(labels)) < 2:
        return constant
    figures, sizes, first = sampled_figures(texts)
    x, y = with_neighbours(figures, first), np.repeat(np.array(labels), np.diff(first))
    # each text counts alike, however many lines it has
    per = np.repeat(1.0 / np.diff(first), np.diff(first))
    same = np.ones(len(y), bool)
    same[first[:-1]] = False
    seen = np.diag([np.sum(same & (y == 0)), np.sum(same & (y == 1))]).astype(float)
    w, moves = np.zeros(x.shape[1]), np.zeros((2, 2))
    first_m, second_m = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    for step in range(1, steps + 1):
        good, pairs, _ = marginals(x @ w, moves, first)
        grad = np.concatenate([x.T @ ((y - good) * per) / len(labels) - decay * w, ((seen - pairs) / len(y) - decay * moves).ravel()])
        first_m = 0.9 * first_m + 0.1 * grad
        second_m = 0.99 * second_m + 0.01 * grad**2
        move = 0.1 * (first_m / (1 - 0.9**step)) / (np.sqrt(second_m / (1 - 0.99**step)) + 1e-9)
        w, moves = w + move[:-4], np.clip(moves + move[-4:].reshape(2, 2), -2, 2)
    model = Model(w, moves, 1.0, 0.0)
    value, target = document_values(model, figures, sizes, first), np.array(labels, float)
    slope, shift = 0.5, 0.0
    for _ in range(50):  # Newton steps of the curve, lightly penalised
        p = 1 / (1 + np.exp(-(slope * value + shift)))
        g = np.array([np.sum((target - p) * value) - 1e-2 * slope, np.sum(target - p) - 1e-2 * shift])
        v = p * (1 - p)
        hess = np.array([[np.sum(v * value * value) + 1e-2, np.sum(v * value)], [np.sum(v * value), np.sum(v) + 1e-2]])
        step_by = np.linalg.solve(hess, g)
        slope, shift = slope + np.clip(step_by[0], -0.5, 0.5), shift + np.clip(step_by[1], -1, 1)
    return Model(w, moves, float(slope), float(shift))


def _score(batches: Iterator[pa.RecordBatch], model: Model, text_at: int, name: str) -> Iterator[pa.RecordBatch]:
    """Batches with a score column behind the others."""
    for batch in batches:
        scores = [np.zeros(0)]
        for _, _, data, offsets in pieces(batch.column(text_at), CHUNK):
            value = document_values(model, *line_figures(data, offsets))
            scores.append(1 / (1 + np.exp(-(model.slope * value + model.shift))))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores))], [*batch.schema.names, name])


def fold(doc_id: Column, n: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def fit_quality(docs: DataFrame, labels: DataFrame, held_out: int = 5, sample: int = SAMPLE) -> Model:
    """A model from at most sample labelled documents outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter("doc_id is not null and quality is not null")
    known = known.filter(fold(F.col("doc_id"), held_out) != 0).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most sample rows
    rows = texts.join(F.broadcast(picked), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(sample).toLocalIterator()
    pairs = [(r["text"] or "", int(r["quality"])) for r in rows]
    return fit([text for text, _ in pairs], [quality for _, quality in pairs])


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs and the score of each, in a column of this new name."""
    schema = docs.withColumn(name, F.lit(0.0)).schema
    return docs.mapInArrow(partial(_score, model=model, text_at=docs.columns.index("text"), name=name), schema)


def good_documents(docs: DataFrame, labels: DataFrame, limit: float = 0.3) -> DataFrame:
    """docs whose score is limit or more."""
    (name,) = fresh(docs.columns, "score")
    return scored(docs, fit_quality(docs, labels), name).filter(F.col(name) >= limit).select(docs.columns)
