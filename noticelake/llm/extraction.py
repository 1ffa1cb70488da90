"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks. A bidirectional LSTM in numpy reads for each block its tag path (hashed tags, class and
id words), its hashed words and a few figures, and classifies it with the whole page as context. It is fitted on a bounded
sample of pages (SAMPLE, by hash of page_id), once as they are, labelled by their sectioning elements, and rebuilt in random
layouts (menus, notices, adverts, sidebars, forms, comments around and inside the article) whose labels are known. Labelling
is one pass over the pages, no shuffle.

Defined cases: null or empty html has no text; a page of which nothing is labelled main has the empty string; repeated rows
are labelled alike; without any page to learn from the random layouts use filler words; further columns take no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_blocks import Block, blocks
from .text import Words, buffers

SAMPLE = 240
PATH, WORDS, FIGURES = 160, 24, 8
INPUT = PATH + WORDS + FIGURES
HIDDEN = 16
SEED = 11

#: What frames an article, by element and by the words of class and id.
ASIDE_TAGS = frozenset("nav header footer aside form button select textarea title noscript dialog menu".split())
ASIDE_NAMES = frozenset(
    f".{x}" for x in "ad ads advert advertisement banner sponsor sponsored promo sidebar menu nav navbar navigation breadcrumb breadcrumbs header footer "
    "comment comments reply replies cookie cookies consent notice notices alert popup modal newsletter subscribe signup share social related "
    "widget toolbar pagination login search copyright".split()
)
MAIN_TAGS = ("article", "main")
MAIN_NAMES = tuple(f".{x}" for x in ("content", "post", "entry", "story", "body", "text"))


def vectors(pages: list[list[Block]], known: dict[tuple[str, ...], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(one row per block of all pages, first row of every page and one end)."""
    first = np.concatenate([[0], np.cumsum([len(p) for p in pages])]).astype(np.int64)
    flat = [b for p in pages for b in p]
    out = np.zeros((len(flat), INPUT), np.float32)
    for i, b in enumerate(flat):
        path = known.get(b.path)
        if path is None:
            path = np.zeros(PATH, np.float32)
            for step in b.path:
                path[zlib.crc32(step.encode()) % (PATH - 1)] = 1
            if b.path:
                path[PATH - 1] = 0.1 * len(b.path)
            if len(known) < 20_000:
                known[b.path] = path
        out[i, :PATH] = path
    data, offsets = buffers(pa.array([b.text for b in flat], pa.large_string()))
    words = Words(data, offsets, lower=True)
    buckets = (words.hashes() % np.uint64(WORDS)).astype(np.int64)
    n = np.maximum(words.counts, 1)
    out[:, PATH : PATH + WORDS] = np.bincount(words.docs() * WORDS + buckets, minlength=len(flat) * WORDS).reshape(-1, WORDS)[: len(flat)] / n[:, None]
    size = np.array([len(b.text) for b in flat], float)
    place = np.arange(len(flat)) - np.repeat(first[:-1], np.diff(first))
    pages_of = np.repeat(np.diff(first), np.diff(first))
    stops = np.array([b.text.count(".") + b.text.count(",") for b in flat], float)
    figures = [np.log1p(words.counts) / 5, np.log1p(size) / 8, np.array([b.linked for b in flat]) / np.maximum(size, 1), np.minimum(stops / n, 1), place / np.maximum(pages_of, 1), place == 0, place == pages_of - 1, np.ones(len(flat))]
    out[:, PATH + WORDS :] = np.stack(figures, 1) if len(flat) else np.zeros((0, FIGURES))
    return out, first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Labeller:
    """Input, recurrent and bias weights of both directions (gates: input, forget, output, candidate) and the output layer."""

    weights: list[np.ndarray]

    @staticmethod
    def fresh(rng: np.random.Generator) -> Labeller:
        w = []
        for _ in range(2):
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN : 2 * HIDDEN] = 1
            w += [rng.normal(0, 0.1, (INPUT, 4 * HIDDEN)), rng.normal(0, 0.1, (HIDDEN, 4 * HIDDEN)), bias]
        return Labeller([*w, rng.normal(0, 0.1, (2 * HIDDEN + INPUT, 1)), np.zeros(1)])

    def run(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list]:
        """Scores of all rows, and what the gradient needs. Pages go step by step together, longest first."""
        count = np.diff(first)
        order = np.argsort(-count, kind="stable")
        begin, length = first[:-1][order], count[order]
        alive = np.searchsorted(-length, -np.arange(1, (length.max() if len(length) else 0) + 1), "right")
        states, trace = np.zeros((len(x), 2 * HIDDEN), x.dtype), []
        for side in range(2):
            w, u, b = self.weights[3 * side : 3 * side + 3]
            given = x @ w + b
            h, c = np.zeros((len(begin), HIDDEN), x.dtype), np.zeros((len(begin), HIDDEN), x.dtype)
            steps = []
            for t, k in enumerate(alive):
                at = begin[:k] + t if side == 0 else begin[:k] + length[:k] - 1 - t
                z = given[at] + h[:k] @ u
                gates = _sigmoid(z[:, : 3 * HIDDEN])
                i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
                g = np.tanh(z[:, 3 * HIDDEN :])
                old_c, old_h = c[:k].copy(), h[:k].copy()
                c[:k] = f * old_c + i * g
                th = np.tanh(c[:k])
                h[:k] = o * th
                states[at, side * HIDDEN : (side + 1) * HIDDEN] = h[:k]
                steps.append((at, i, f, o, g, old_c, old_h, th))
            trace.append(steps)
        both = np.concatenate([states, x], 1)
        return (both @ self.weights[6])[:, 0] + self.weights[7][0], [both, trace, len(begin)]

    def gradient(self, x: np.ndarray, errors: np.ndarray, kept: list) -> list[np.ndarray]:
        """Of the summed loss, given its derivatives by the scores."""
        both, trace, n = kept
        out: list[np.ndarray] = []
        back = errors[:, None] * self.weights[6][:, 0][None]
        for side in range(2):
            w, u, b = self.weights[3 * side : 3 * side + 3]
            dz_all, du = np.zeros((len(x), 4 * HIDDEN)), np.zeros_like(u)
            dh, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
            for at, i, f, o, g, old_c, old_h, th in reversed(trace[side]):
                k = len(at)
                dht = dh[:k] + back[at, side * HIDDEN : (side + 1) * HIDDEN]
                dct = dc[:k] + dht * o * (1 - th**2)
                dz = np.concatenate([dct * g * i * (1 - i), dct * old_c * f * (1 - f), dht * th * o * (1 - o), dct * i * (1 - g**2)], 1)
                dz_all[at] = dz
                du += old_h.T @ dz
                dh[:k], dc[:k] = dz @ u.T, dct * f
            out += [x.T @ dz_all, du, dz_all.sum(0)]
        return [*out, both.T @ errors[:, None], np.array([errors.sum()])]


def by_elements(page: list[Block]) -> list[bool]:
    """Weak labels of a page as it is: inside an article or main element, or a block named like one, and in nothing that frames it."""
    def held(b: Block, marks) -> bool:
        return any(x in marks for x in b.path)

    framed = [held(b, ASIDE_TAGS) or held(b, ASIDE_NAMES) for b in page]
    for marks in (MAIN_TAGS, MAIN_NAMES):
        inside = [held(b, marks) for b in page]
        if any(inside):
            return [a and not f for a, f in zip(inside, framed, strict=True)]
    return [not f and b.linked * 2 < len(b.text) and len(b.text) > 60 for f, b in zip(framed, page, strict=True)]


def layout(texts: list[str], rng: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """A page in a random layout around an article of some of these texts, with labels."""
    page: list[Block] = []
    labels: list[bool] = []
    pick = lambda options: options[rng.integers(len(options))]

    def words(lo: int, hi: int) -> str:
        source = pick(texts).split() or ["word"]
        at = rng.integers(len(source))
        return " ".join((source[at:] + source)[: int(rng.integers(lo, hi + 1))])

    def add(path: tuple[str, ...], text: str, main: bool = False, linked: bool = False) -> None:
        if text := " ".join(text.split()):
            page.append(Block(text, path, len(text) if linked else 0))
            labels.append(main)

    root: tuple[str, ...] = ("html", "body")
    if rng.random() < 0.5:
        root += ("div", *pick([(), (".page",), (".wrapper",), (".container",), (".site",)]))

    def menu(path: tuple[str, ...]) -> None:
        for _ in range(rng.integers(2, 9)):
            add((*path, *pick([("ul", "li", "a"), ("a",), ("li", "a"), ("div", "a"), ("ol", "li", "a")])), words(1, 3), linked=True)

    def noise(base: tuple[str, ...]) -> None:
        kind = rng.integers(9)
        if kind == 0:
            menu((*base, *pick([("nav",), ("div", ".menu"), ("div", ".nav"), ("ul", ".navigation"), ("nav", ".breadcrumbs")])))
        elif kind == 1:
            place = (*base, *pick([("div", ".ad"), ("div", ".ads"), ("aside", ".advertisement"), ("div", ".banner"), ("div", ".sponsored"), ("section", ".promo")]))
            for _ in range(rng.integers(1, 3)):
                add((*place, *pick([(), ("p",), ("a",), ("span",)])), words(3, 30))
        elif kind == 2:
            place = (*base, *pick([("aside",), ("div", ".sidebar"), ("aside", ".sidebar"), ("div", ".widget"), ("div", ".related")]))
            add((*place, pick(["h2", "h3", "h4"])), words(1, 5))
            for _ in range(rng.integers(1, 5)):
                add((*place, *pick([("p",), ("ul", "li"), ("ul", "li", "a"), ()])), words(2, 40))
        elif kind == 3:
            place = (*base, *pick([("section", ".comments"), ("div", ".comments"), ("div", ".comment"), ("ol", ".comment", ".list", "li"), ("section", ".replies")]))
            add((*place, "h3"), words(1, 4))
            for _ in range(rng.integers(1, 7)):
                add((*place, *pick([("p",), ("div", ".comment", "p"), ("article", ".comment", "p"), ("li", "p"), ("div", ".reply")])), words(3, 80))
        elif kind == 4:
            place = (*base, *pick([("form",), ("form", ".newsletter"), ("div", ".subscribe", "form"), ("div", ".login", "form"), ("form", ".search")]))
            for _ in range(rng.integers(1, 5)):
                add((*place, *pick([("label",), ("button",), ("p",), ("select", "option"), ("textarea",), ("div",)])), words(1, 14))
        elif kind == 5:
            add((*base, *pick([("div", ".cookie"), ("div", ".notice"), ("div", ".consent"), ("div", ".alert"), ("dialog",), ("div", ".popup"), ("p", ".notice")])), words(5, 40))
        elif kind == 6:
            add((*base, *pick([("header", "h1"), ("header", "p"), ("div", ".header"), ("div", ".header", "h1"), ("header", "a")])), words(1, 12))
        elif kind == 7:
            for _ in range(rng.integers(1, 4)):
                add((*base, *pick([("footer",), ("footer", "p"), ("div", ".footer"), ("div", ".footer", "p"), ("footer", "div", ".copyright")])), words(3, 40))
        else:
            add((*base, *pick([("div", ".share"), ("ul", ".social", "li"), ("div", ".social"), ("div", ".pagination")]), "a"), words(1, 6), linked=True)

    add(("html", "head", "title"), words(2, 10))
    for _ in range(rng.integers(0, 4)):
        noise(root)
    place = (*root, *pick([("article",), ("main",), ("main", "article"), ("article", ".post"), ("div", ".content"), ("div", ".post", ".content"), ("div", ".entry", ".content"), ("div", ".article", ".body"), ("section", ".story"), ("div",), ("div", ".main", "article"), ("main", "div", ".text")]))
    if rng.random() < 0.7:
        add((*place, pick(["h1", "h2"])), words(3, 14), True)
    for _ in range(rng.integers(1, 16)):
        add((*place, *pick([("p",), ("p",), ("p",), ("p", "b"), ("p", "a"), ("blockquote", "p"), ("ul", "li"), ("h2",), ("h3",), (), ("pre",), ("figure", "figcaption"), ("table", "tr", "td"), ("div", "p"), ("p", "em")])), words(2, 120), True)
        if rng.random() < 0.1:
            noise(place)
    for _ in range(rng.integers(0, 5)):
        noise(root)
    if rng.random() < 0.6:
        add((*root, "footer"), words(3, 40))
    return page, labels


def train(pages: list[list[Block]], made: int = 700, epochs: int = 14, batch: int = 40) -> Labeller:
    """Fit on sampled pages and on random layouts of their texts by Adam; the summed log-loss of all blocks."""
    rng = np.random.default_rng(SEED)
    texts = [b.text for p in pages for b in p if len(b.text) > 80] or ["some filler words stand here, where no page is given."]
    examples = [(p, by_elements(p)) for p in pages if p] + [layout(texts, rng) for _ in range(made)]
    known: dict = {}
    net = Labeller.fresh(rng)
    means, squares, step = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights], 0
    ready = []
    for lo in range(0, len(order := rng.permutation(len(examples))), batch):
        part = [examples[i] for i in order[lo : lo + batch]]
        x, first = vectors([p for p, _ in part], known)
        ready.append((x.astype(float), first, np.array([y for _, labels in part for y in labels], float)))
    for epoch in range(epochs):
        rate = 0.02 * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for k in rng.permutation(len(ready)):
            x, first, y = ready[k]
            scores, kept = net.run(x, first)
            grads = net.gradient(x, (_sigmoid(scores) - y) / len(y), kept)
            step += 1
            for w, g, m, s in zip(net.weights, grads, means, squares, strict=True):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8) + rate * 1e-4 * w
    return net


def fit_labeller(pages: DataFrame, sample: int = SAMPLE) -> Labeller:
    some = pages.filter("page_id is not null and html is not null")
    # at most sample ids, then at most one page of each
    ids = [r[0] for r in some.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample).collect()]
    rows = some.filter(F.col("page_id").isin(ids)).groupBy("page_id").agg(F.min("html").alias("html")).collect()
    return train([blocks(r["html"]) for r in sorted(rows, key=lambda r: ids.index(r["page_id"]))])


def _extract(batches: Iterator[pa.RecordBatch], net: Labeller) -> Iterator[pa.RecordBatch]:
    net = Labeller([w.astype(np.float32) for w in net.weights])
    known: dict = {}
    for batch in batches:
        for lo in range(0, len(batch), 256):
            part = batch.slice(lo, 256)
            pages = [blocks(x.as_py() or "") for x in part.column("html")]
            x, first = vectors(pages, known)
            scores, _ = net.run(x, first)
            texts = ["\n\n".join(b.text for b, s in zip(p, scores[a:], strict=False) if s > 0) for p, a in zip(pages, first[:-1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )


def main_text(pages: DataFrame, net: Labeller) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(partial(_extract, net=net), "page_id long, url string, text string, n_chars long")
