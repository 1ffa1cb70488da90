"""How far each source's words are from the other sources' of its language, and by which words.

Inside the scanning tasks terms are packed by length: up to 8 bytes become one unsigned 64-bit word, up to 16 bytes two, padded
with zero bytes, so that numbers sort as the bytes do (no term holds a zero byte). Each bucket is sorted by radix passes of 16 bits
(group, then term; documents stay in order) and its runs are counted in numpy. Longer terms are sorted as bytes in a bucket of
their own. What leaves a task is one row per group and term of some millions of words. Spark adds these up, keeps a language's
terms found in enough documents, and compares:

* part `term` is a window of the first ranks per group, which Spark limits before the shuffle;
* part `pair` deals each language's kept terms into blocks of bounded size, sums every pair of sources over a block in numpy, and
  adds up the blocks. Terms that a group lacks count too, with the share of a count of zero.

All arithmetic is exact: shares are floors of quotients taken in decimals (Spark) or three steps of 1,000 (numpy; right while a
group has fewer than 9 * 10**15 words).

Defined cases: null lang, source and text are empty strings; documents without terms make a group all the same; rows are documents
as often as they occur; a language with one source has no pairs; without kept terms a pair's value is 0; an empty table gives no
rows; further columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.session import cut_lineage

from .tables import Scratch, stored
from .text import LOWER, pieces, spans

#: Bytes of terms: letters, and all bytes of code points beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True
UNIT = 1_000_000_000
LEAST_DOCS, RANKS = 3, 200
CHUNK = 1 << 22
#: Rows that a task gathers before it merges its runs, and rows of a block of terms.
HELD, ROWS = 1 << 20, 1 << 18
SALTS = 64
COUNTS = "lang string, source string, term string, n long, df long"


def radix_order(*keys: np.ndarray) -> np.ndarray:
    """Stable order by unsigned keys, the last one first, in passes of 16 bits. Passes that can't change anything are left out."""
    order = None
    for key in keys:
        for shift in range(0, 8 * key.itemsize, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                found = np.argsort(digit if order is None else digit[order], kind="stable")
                order = found if order is None else order[found]
    return np.arange(len(keys[0])) if order is None else order


def packed(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Up to 8 bytes from each start as a big-endian number, zero bytes behind. data: at least 8 bytes longer than any start."""
    view = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    shift = (8 * (8 - np.clip(sizes, 0, 8))).astype(np.uint64)
    words = view[starts].astype(np.uint64)
    # a shift by 64 bits is undefined, so it is made in two
    half = shift >> np.uint64(1)
    return ((words >> half) >> (shift - half)) << half << (shift - half)


def unpacked(*words: np.ndarray) -> pa.Array:
    """Terms of packed words."""
    table = np.stack(words, axis=1).astype(">u8").view(np.uint8).reshape(len(words[0]), -1)
    filled = table != 0
    offsets = np.zeros(len(table) + 1, np.int32)
    np.cumsum(filled.sum(axis=1), out=offsets[1:])
    return pa.StringArray.from_buffers(len(table), pa.py_buffer(offsets), pa.py_buffer(table[filled]))


class Runs:
    """Counts of packed terms: keys (the last one the group), n, and documents that hold the term."""

    def __init__(self, keys: int):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.keys, self.rows = keys, 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.rows += len(columns[0])

    def count(self, docs: np.ndarray, *keys: np.ndarray) -> None:
        """Sort these terms and count their runs. docs never falls."""
        if not len(docs):
            return
        order = radix_order(*keys)
        keys, docs = tuple(k[order] for k in keys), docs[order]
        new = np.ones(len(docs), bool)
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
        other = new.copy()
        other[1:] |= docs[1:] != docs[:-1]
        at = np.flatnonzero(new)
        self.add(*(k[at] for k in keys), np.diff(np.append(at, len(docs))), np.add.reduceat(other.astype(np.int64), at))

    def merged(self) -> tuple[np.ndarray, ...]:
        """All runs as one."""
        if not self.parts:
            return ()
        columns = [np.concatenate(c) for c in zip(*self.parts, strict=True)]
        order = radix_order(*columns[: self.keys])
        keys = [c[order] for c in columns[: self.keys]]
        new = np.ones(len(order), bool)
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
        at = np.flatnonzero(new)
        merged = (*(k[at] for k in keys), *(np.add.reduceat(c[order], at) for c in columns[self.keys :]))
        self.parts, self.rows = [merged], len(at)
        return merged


class Counter:
    """Counts of the terms of a task's documents, bucketed by length."""

    def __init__(self, held: int = HELD):
        self.held = held
        self.groups: dict[tuple[str, str], int] = {}
        self.clear()

    def clear(self) -> None:
        self.one, self.two = Runs(2), Runs(3)
        self.long: dict[tuple[int, bytes], list[int]] = {}

    @property
    def rows(self) -> int:
        return self.one.rows + self.two.rows + len(self.long)

    def group(self, lang: str, source: str) -> int:
        return self.groups.setdefault((lang, source), len(self.groups))

    def terms(self, data: np.ndarray, offsets: np.ndarray, groups: np.ndarray) -> None:
        """Count the terms of some texts; groups has each text's group."""
        starts, ends, docs = spans(data, offsets, LETTERS[data])
        data = np.concatenate([LOWER[data], np.zeros(16, np.uint8)])
        sizes = ends - starts
        of = groups[docs].astype(np.uint16)
        short, mid = sizes <= 8, (sizes > 8) & (sizes <= 16)
        self.one.count(docs[short], packed(data, starts[short], sizes[short]), of[short])
        high = packed(data, starts[mid], sizes[mid])
        self.two.count(docs[mid], packed(data, starts[mid] + 8, sizes[mid] - 8), high, of[mid])
        at = np.flatnonzero(sizes > 16)
        raw = data.tobytes() if len(at) else b""
        bucket = sorted((int(of[k]), raw[starts[k] : ends[k]], int(docs[k])) for k in at)
        before = None
        for group, term, doc in bucket:
            found = self.long.setdefault((group, term), [0, 0])
            found[0] += 1
            found[1] += (group, term, doc) != before
            before = group, term, doc

    def long_text(self, data: np.ndarray, group: int) -> None:
        """Count one text in parts that end outside of terms; a term's documents are then this one."""
        part, lo = Counter(), 0
        while lo < len(data):
            hi = min(lo + CHUNK, len(data))
            while hi < len(data) and LETTERS[data[hi]]:
                hi += 1
            part.terms(data[lo:hi], np.array([0, hi - lo]), np.array([group]))
            if part.one.rows > self.held or part.two.rows > self.held:
                part.one.merged(), part.two.merged()
            lo = hi
        for mine, other in ((self.one, part.one), (self.two, part.two)):
            if found := other.merged():
                mine.add(*found[:-1], np.ones_like(found[-1]))
        for key, (n, _) in part.long.items():
            found = self.long.setdefault(key, [0, 0])
            found[0] += n
            found[1] += 1

    def batches(self) -> Iterator[pa.RecordBatch]:
        """All counts; the counter keeps its groups alone."""
        names = list(self.groups)
        langs, sources = (pa.array([g[k] for g in names], pa.string()) for k in (0, 1))

        def batch(of: np.ndarray, terms: pa.Array, n: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
            at = pa.array(of.astype(np.int64))
            return pa.RecordBatch.from_arrays([langs.take(at), sources.take(at), terms, pa.array(n), pa.array(df)], ["lang", "source", "term", "n", "df"])

        if found := self.one.merged():
            yield batch(found[1], unpacked(found[0]), *found[2:])
        if found := self.two.merged():
            yield batch(found[2], unpacked(found[1], found[0]), *found[3:])
        if self.long:
            keys = sorted(self.long)
            figures = np.array([self.long[k] for k in keys], np.int64)
            yield batch(np.array([k[0] for k in keys]), pa.array([k[1].decode() for k in keys], pa.string()), figures[:, 0], figures[:, 1])
        self.clear()


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches (lang, source, text) to COUNTS, each group and term once per HELD rows or so."""
    counter = Counter()
    for batch in batches:
        if len(counter.groups) + batch.num_rows > 1 << 16:  # a group is one 16-bit digit
            yield from counter.batches()
            counter.groups.clear()
        groups = np.array([counter.group(*g) for g in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)])
        for lo, hi, data, offsets in pieces(batch.column("text"), CHUNK):
            if len(data) > 2 * CHUNK:
                counter.long_text(data, groups[lo])
            else:
                counter.terms(data, offsets, groups[lo:hi])
            if counter.rows > counter.held:
                counter.one.merged(), counter.two.merged()
                if counter.rows > counter.held // 2:
                    yield from counter.batches()
    yield from counter.batches()


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, term, n, and of the language n_lang and least_source, for the terms that enough of a language's documents hold.

    One shuffle, by (lang, term): a term has as many rows there as tasks and sources hold it.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    found = docs.select(empty("lang"), empty("source"), empty("text")).mapInArrow(counted, COUNTS)
    summed = found.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    of_lang = Window.partitionBy("lang", "term")
    return (
        summed.withColumn("df_lang", F.sum("df").over(of_lang)).withColumn("n_lang", F.sum("n").over(of_lang))
        .withColumn("least_source", F.min("source").over(of_lang)).filter(F.col("df_lang") >= least_docs).drop("df", "df_lang")
    )


def group_figures(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, words (of kept terms), and of the language words_lang, terms and rows, for every group that occurs."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    groups = docs.select(empty("lang"), empty("source")).distinct()
    first = (F.col("source") == F.col("least_source")).cast("long")
    per_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"), F.sum(first).alias("terms"), F.count(F.lit(1)).alias("rows"))
    per_lang = per_group.groupBy("lang").agg(F.sum("words").alias("words_lang"), F.sum("terms").alias("terms"), F.sum("rows").alias("rows"))
    return groups.join(per_group.select("lang", "source", "words"), ["lang", "source"], "left").join(per_lang, "lang", "left").fillna(0)


def with_figures(kept: DataFrame, figures: DataFrame, salts: int = SALTS) -> DataFrame:
    """Kept terms with their group's figures. Groups meet in salted parts, so one with most of the terms is spread over many tasks."""
    salted = figures.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return kept.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(salts)).cast("int")).join(salted, ["lang", "source", "salt"]).drop("salt")


def share(count: Column, total: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / total)."""
    wide = (count + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return 1 + F.call_function("div", wide, total.cast("decimal(20,0)"))


def telling_terms(kept: DataFrame, figures: DataFrame, ranks: int = RANKS) -> DataFrame:
    """Part `term`: each group's terms that it uses more than its language does, by how much."""
    p = share(F.col("n"), F.col("words") + F.col("terms"))
    q = share(F.col("n_lang"), F.col("words_lang") + F.col("terms"))
    rows = with_figures(kept, figures).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    valued = rows.select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return valued.withColumn("rank", rank).filter(F.col("rank") <= ranks)


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (counts + 1) / totals), by three steps of long division."""
    quotient, rest = np.zeros_like(counts), counts + 1
    for _ in range(3):
        rest = rest * 1000
        quotient = quotient * 1000 + rest // totals
        rest %= totals
    return quotient + 1


def pair_sums(counts: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums over a block's terms for all pairs of its language's sources."""
    names = sources.column("source").combine_chunks()
    totals = (sources.column("words").to_numpy() + sources.column("terms").to_numpy()).astype(np.int64)
    place = {s: k for k, s in enumerate(names.to_pylist())}
    terms = counts.column("term").combine_chunks().dictionary_encode()
    column, width = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(terms.dictionary)
    row = np.array([place[s] for s in counts.column("source").to_pylist()], np.int64)
    n = counts.column("n").to_numpy().astype(np.int64)
    values = np.zeros((len(names), len(names)), np.int64)
    step = max(1, (1 << 20) // max(1, len(names)))
    order = np.argsort(column, kind="stable")
    row, column, n = row[order], column[order], n[order]
    for lo in range(0, width, step):
        a, b = np.searchsorted(column, [lo, lo + step])
        dense = np.zeros((len(names), min(step, width - lo)), np.int64)
        dense[row[a:b], column[a:b] - lo] = n[a:b]
        p = shares(dense, totals[:, None])
        for k in range(len(names)):
            apart = p[k] - p
            values[k] += (apart * apart // p).sum(axis=1)
    one, other = np.nonzero(~np.eye(len(names), dtype=bool))
    lang = sources.column("lang")[0]
    return pa.table({
        "lang": pa.array([lang.as_py()] * len(one), pa.string()), "source": names.take(pa.array(one)), "item": names.take(pa.array(other)),
        "value": pa.array(values[one, other]),
    })


def source_pairs(kept: DataFrame, figures: DataFrame, block_rows: int = ROWS) -> DataFrame:
    """Part `pair`: how far each source is from each other source of its language, over all kept terms."""
    blocks = F.greatest(F.ceil(F.col("rows") / block_rows), F.lit(1)).cast("long")
    of = figures.withColumn("blocks", blocks)
    counts = with_figures(kept, of).select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "source", "term", "n")
    sources = of.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "source", "words", "terms")
    sums = counts.groupBy("lang", "block").cogroup(sources.groupBy("lang", "block")).applyInArrow(
        pair_sums, "lang string, source string, item string, value long"
    )
    summed = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return summed.withColumn("rank", rank)


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> DataFrame:
    """lang, source, part (`pair` or `term`), item, value and rank of every group of documents."""
    scratch = Scratch()
    kept = scratch.stored(kept_terms(docs, least_docs))
    figures = cut_lineage(group_figures(docs, kept))
    columns = ["lang", "source", F.col("part"), "item", "value", "rank"]
    pair = source_pairs(kept, figures).withColumn("part", F.lit("pair")).select(columns)
    result = stored(pair.union(telling_terms(kept, figures, ranks).withColumn("part", F.lit("term")).select(columns)))
    scratch.drop()
    return result
