"""Phrases of two and three words that stand together more often than their parts do, counted in HAT-tries.

A task counts phrases in one trie per language. Its alphabet are the task's word ids; a leaf is a hash container over a range of
phrases. A container that grows too large bursts: between two first words if it covers several, below its first word if it covers
one, and so on. When the tries are full, their largest subtrees leave as sorted runs, dealt by their prefix (the first word);
a run carries its own sorted words, so runs of all tasks can be merged. Every prefix partition is merged by one call, which
keeps the phrases that are frequent enough.

Words are counted first, by the same tries. Their counts give the number of prefix partitions, and the first words that hold so many
phrases that one partition is too small: words with more than 1 / HOT of all occurrences, so HOT words at most, are dealt
by the whole phrase; with more partitions than HOT, all others are spread over their share of them.

Scores need frequent phrases alone: a phrase is at most as frequent as its parts. They are joins of the merged table.

Defined cases: a null text is empty, a null lang is `und`; rows count as often as they occur; a text without words adds nothing;
languages without a frequent phrase have no rows; ties are in the order of the phrase's bytes; an empty table gives no rows; further
columns take no part. Long texts are read in parts, with the last two words carried on. Words are known by 128 bits of hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import Scratch, stored
from .text import LOWER, mix, pieces, span_hashes, spans

BREAKS = np.zeros(256, bool)
BREAKS[np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8)] = True
INSIDE = ~BREAKS
INSIDE[[9, 32]] = False
LEAST, PERCENT, RANKS = 10, 50, 2000
#: Entries of a container before it bursts, of a task's tries before they spill, and words of a task before all goes.
BURST, ENTRIES, WORDS = 1 << 15, 1 << 20, 1 << 19
#: Phrases (with repetitions) of a prefix partition.
PART = 1 << 21
HOT = 1024
#: A phrase is three word ids of 21 bits, 0 where there is no word.
BITS = 21
_LOW = np.uint64((1 << BITS) - 1)
_CHUNK = 1 << 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_TABLES = np.random.default_rng(77).integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Container:
    """Counts of phrases in an array hash: open addressing, many keys at once. 0 is an empty slot; no phrase is 0."""

    def __init__(self, slots: int = 1 << 10):
        self.keys, self.counts, self.size = np.zeros(slots, np.uint64), np.zeros(slots, np.int64), 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Count distinct keys."""
        while 2 * (self.size + len(keys)) > len(self.keys):
            old = self.items()
            self.keys, self.counts, self.size = np.zeros(2 * len(self.keys), np.uint64), np.zeros(2 * len(self.keys), np.int64), 0
            self._put(*old)
        self._put(keys, counts)

    def _put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        mask = np.uint64(len(self.keys) - 1)
        at = (keys * _SPREAD) >> np.uint64(65 - len(self.keys).bit_length())
        while len(keys):
            free = self.keys[at] == 0
            # of several keys that want a free slot one gets it
            self.keys[at[free]] = keys[free]
            mine = self.keys[at] == keys
            self.size += int((mine & free).sum())
            self.counts[at[mine]] += counts[mine]
            keys, counts, at = keys[~mine], counts[~mine], (at[~mine] + np.uint64(1)) & mask

    def items(self, ordered: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(keys, counts)."""
        full = np.flatnonzero(self.keys)
        if ordered:
            full = full[np.argsort(self.keys[full])]
        return self.keys[full], self.counts[full]


class Trie:
    """Counts of phrases: containers, each for the phrases from its low bound to the next one's."""

    def __init__(self, burst: int = BURST):
        self.lows, self.containers, self.burst = [0], [Container()], burst

    def add(self, keys: np.ndarray, counts: np.ndarray) -> int:
        """Count distinct keys in order; how many were new."""
        cuts = [0, *np.searchsorted(keys, np.array(self.lows[1:], np.uint64)).tolist(), len(keys)]
        full, new = [], 0
        for k, container in enumerate(self.containers):
            if cuts[k] < cuts[k + 1]:
                had = container.size
                container.add(keys[cuts[k] : cuts[k + 1]], counts[cuts[k] : cuts[k + 1]])
                new += container.size - had
                if container.size > self.burst:
                    full.append(k)
        for k in reversed(full):
            self._burst(k)
        return new

    def _burst(self, k: int) -> None:
        """Split a container, at the highest level at which it can be split, into such as fit."""
        done, waiting = [], [(self.lows[k], *self.containers[k].items(ordered=True))]
        while waiting:
            low, keys, counts = waiting.pop()
            at = self._cut(keys) if len(keys) > self.burst else 0
            if at:
                waiting += [(int(keys[at]), keys[at:], counts[at:]), (low, keys[:at], counts[:at])]
            else:
                part = Container()
                part.add(keys, counts)
                done.append((low, part))
        self.lows[k : k + 1] = [low for low, _ in done]
        self.containers[k : k + 1] = [container for _, container in done]

    @staticmethod
    def _cut(keys: np.ndarray) -> int:
        """The place nearest to the middle where the first word changes; or the second; or the third."""
        middle = len(keys) // 2
        for bits in (np.uint64(2 * BITS), np.uint64(BITS), np.uint64(0)):
            heads = keys >> bits
            if heads[0] != heads[-1]:
                lo, hi = np.searchsorted(heads, heads[middle], "left"), np.searchsorted(heads, heads[middle], "right")
                return int(lo if lo and (hi == len(keys) or middle - lo <= hi - middle) else hi)
        return 0

    def take(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The phrases and counts of the largest subtrees, until at most so many are left."""
        sizes = [c.size for c in self.containers]
        left, gone = sum(sizes), []
        for k in sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True):
            if left <= most:
                break
            gone.append(k)
            left -= sizes[k]
        gone.sort()
        runs = [self.containers[k].items() for k in gone] or [Container().items()]
        for k in reversed(gone):
            if k:
                del self.lows[k], self.containers[k]
            else:
                self.containers[0] = Container()
        return np.concatenate([x for x, _ in runs]), np.concatenate([x for _, x in runs])


class Tally:
    """The words of a task and the tries of its languages."""

    def __init__(self, depth: int, entries: int = ENTRIES, words: int = WORDS, chunk: int = _CHUNK):
        self.depth, self.limit, self.most_words, self.chunk = depth, entries, words, chunk
        self.forget()

    def forget(self) -> None:
        self.names: list[bytes] = [b""]
        self.hashes = np.zeros((2, 1 << 12), np.uint64)
        # first hashes in order, and their words; words that share one with an earlier word
        self.known, self.places, self.odd = np.zeros(0, np.uint64), np.zeros(0, np.int64), {}
        self.tries: dict[str, Trie] = {}
        self.entries = 0

    def _named(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """New words' ids."""
        lo = len(self.names)
        self.names += [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        while self.hashes.shape[1] < len(self.names):
            self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)], axis=1)
        self.hashes[:, lo : len(self.names)] = first, second
        return np.arange(lo, len(self.names))

    def ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        first, second = (span_hashes(t[data], starts, ends) for t in _TABLES)
        order = np.argsort(first)
        new = np.ones(len(order), bool)
        new[1:] = first[order[1:]] != first[order[:-1]]
        at = order[new]
        values = first[at]
        place = np.searchsorted(self.known, values)
        here = np.zeros(len(values), bool)
        inside = place < len(self.known)
        here[inside] = self.known[place[inside]] == values[inside]
        found = np.zeros(len(values), np.int64)
        found[here] = self.places[place[here]]
        raw, unseen = data.tobytes(), at[~here]
        found[~here] = self._named(raw, starts[unseen], ends[unseen], first[unseen], second[unseen])
        self.known = np.insert(self.known, place[~here], values[~here])
        self.places = np.insert(self.places, place[~here], found[~here])
        out = np.empty(len(order), np.int64)
        out[order] = found[np.cumsum(new) - 1]
        for i in np.flatnonzero(self.hashes[1][out] != second).tolist():
            word = raw[starts[i] : ends[i]]
            if word not in self.odd:
                self.odd[word] = int(self._named(raw, *(x[i : i + 1] for x in (starts, ends, first, second)))[0])
            out[i] = self.odd[word]
        return out.astype(np.uint64)

    def texts(self, langs: list[str], data: np.ndarray, offsets: np.ndarray) -> None:
        """Count the phrases of some texts. Languages are numbered within the call, so that one sort parts them."""
        numbers = {lang: k for k, lang in enumerate(dict.fromkeys(langs))}
        of = np.array([numbers[x] for x in langs], np.uint16)
        if len(langs) == 1:
            self._long(langs[0], data)
            return
        starts, ends, docs = spans(data, offsets, INSIDE[data])
        piece = np.cumsum(BREAKS[data])[starts]
        data = LOWER[data]
        self._count(list(numbers), of[docs], self.ids(data, starts, ends), np.stack([docs, piece]), 0)

    def _long(self, lang: str, data: np.ndarray) -> None:
        """One text, in parts that end outside of words."""
        lo, breaks = 0, 0
        ids, places = np.zeros(0, np.uint64), np.zeros((2, 0), np.int64)
        while lo < len(data):
            hi = min(lo + self.chunk, len(data))
            while hi < len(data) and INSIDE[data[hi]]:
                hi += 1
            part = LOWER[data[lo:hi]]
            starts, ends, _ = spans(part, np.array([0, len(part)]), INSIDE[part])
            piece = breaks + np.cumsum(BREAKS[part])
            new = self.ids(part, starts, ends)
            carried = len(ids)
            ids = np.concatenate([ids, new])
            places = np.concatenate([places, np.stack([np.zeros(len(starts), np.int64), piece[starts]])], axis=1)
            self._count([lang], np.zeros(len(ids), np.uint16), ids, places, carried)
            ids, places, breaks, lo = ids[-2:], places[:, -2:], piece[-1], hi

    def _count(self, langs: list[str], of: np.ndarray, ids: np.ndarray, places: np.ndarray, new: int) -> None:
        """Phrases that end at words from number new on."""
        top, mid = np.uint64(2 * BITS), np.uint64(BITS)
        keys, kinds = [ids[new:] << top], [of[new:]]
        if self.depth > 1 and len(ids) > 1:
            linked = (places[:, 1:] == places[:, :-1]).all(axis=0)  # word i + 1 follows word i
            two = np.flatnonzero(linked)
            two = two[two + 1 >= new]
            three = np.flatnonzero(linked[1:] & linked[:-1])
            three = three[three + 2 >= new]
            keys = [ids[two] << top | ids[two + 1] << mid, ids[three] << top | ids[three + 1] << mid | ids[three + 2]]
            kinds = [of[two], of[three]]
        elif self.depth > 1:
            return
        keys, kinds = np.concatenate(keys), np.concatenate(kinds)
        if len(langs) > 1:
            order = np.argsort(kinds, kind="stable")
            keys, kinds = keys[order], kinds[order]
        bounds = np.searchsorted(kinds, np.arange(len(langs) + 1))
        for k, lang in enumerate(langs):
            if bounds[k] < bounds[k + 1]:
                self.entries += self.tries.setdefault(lang, Trie()).add(*np.unique(keys[bounds[k] : bounds[k + 1]], return_counts=True))

    def spills(self, all_of_it: bool) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """Phrases that leave (language, phrases, counts), where the tries are full, or of all."""
        crowded = len(self.names) > self.most_words
        if not (all_of_it or crowded or self.entries > self.limit):
            return
        # every language gives up half of what it has
        for lang, trie in self.tries.items():
            had = sum(c.size for c in trie.containers)
            keys, counts = trie.take(0 if all_of_it or crowded else had // 2)
            self.entries -= len(keys)
            if len(keys):
                yield lang, keys, counts
        if all_of_it or crowded:
            self.forget()


def _tallied(batches: Iterator[pa.RecordBatch], tally: Tally) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lo, hi, data, offsets in pieces(batch.column("text"), tally.chunk):
            tally.texts(langs[lo:hi], data, offsets)
            yield from tally.spills(False)
    yield from tally.spills(True)


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches (lang, text) to (lang, word, n), and with a null word the number of words."""
    tally = Tally(1)
    for lang, keys, counts in _tallied(batches, tally):
        words = [tally.names[k].decode() for k in (keys >> np.uint64(2 * BITS)).tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(words) + 1), pa.string()), pa.array([*words, None], pa.string()), pa.array([*counts.tolist(), int(counts.sum())], pa.int64())],
            ["lang", "word", "n"],
        )


def encoded(names: list[bytes], words: np.ndarray, counts: np.ndarray, rank: np.ndarray) -> tuple[int, bytes]:
    """(size, compressed) run with its own words: both in the order of bytes. words: three rows of ids; rank: room for a number per name."""
    used = np.unique(words)
    own = [names[k] for k in used.tolist()]
    order = sorted(range(len(own)), key=own.__getitem__)
    rank[used[order]] = np.arange(len(own), dtype=np.uint64)
    wide = rank[words]
    sort = np.argsort(wide[0] << np.uint64(2 * BITS) | wide[1] << np.uint64(BITS) | wide[2])
    body = b"\n".join(own[k] for k in order)
    head = np.array([len(body), len(counts)], "<u8").tobytes()
    raw = head + body + wide[:, sort].astype("<u4").tobytes() + counts[sort].astype("<i8").tobytes()
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def decoded(run: bytes, size: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words, three rows of ranks, counts) of a run."""
    raw = pa.decompress(run, decompressed_size=size, codec="zstd", asbytes=True)
    body, n = np.frombuffer(raw, "<u8", 2).tolist()
    ranks = np.frombuffer(raw, "<u4", 3 * n, 16 + body).reshape(3, n)
    return raw[16 : 16 + body].split(b"\n"), ranks, np.frombuffer(raw, "<i8", n, 16 + body + 12 * n)


def phrase_runs(batches: Iterator[pa.RecordBatch], parts: int, hot: dict[str, set[bytes]]) -> Iterator[pa.RecordBatch]:
    """Arrow batches (lang, text) to runs of phrases (part, lang, size, run)."""
    tally = Tally(3)
    for lang, keys, counts in _tallied(batches, tally):
        words = np.stack([keys >> np.uint64(2 * BITS), keys >> np.uint64(BITS) & _LOW, keys & _LOW]).astype(np.int64)
        hashes = tally.hashes[0][words]
        base = mix(hashes[0] + np.uint64(zlib.crc32(lang.encode())))
        whole = mix(base + hashes[1] * np.uint64(3)) + hashes[2] * np.uint64(5)
        spread = np.full(len(keys), max(1, parts // HOT), np.uint64)
        if own := hot.get(lang):
            seen, back = np.unique(words[0], return_inverse=True)
            spread[np.array([tally.names[k] in own for k in seen.tolist()])[back]] = parts
        part = ((base % np.uint64(parts) + mix(whole) % spread) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
        found, at = np.unique(part[order], return_index=True)
        rows, room = [], np.empty(len(tally.names), np.uint64)
        for number, of in zip(found.tolist(), np.split(order, at[1:]), strict=True):
            rows.append((number, lang, *encoded(tally.names, words[:, of], counts[of], room)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.binary()), strict=True)], ["part", "lang", "size", "run"]
        )


def merged(runs: pa.Table, least: int) -> pa.Table:
    """The phrases of a prefix partition that occur often enough."""
    out = []
    langs = runs.column("lang").to_pylist()
    for lang in sorted(set(langs)):
        got = [decoded(run.as_py(), size.as_py()) for x, run, size in zip(langs, runs.column("run"), runs.column("size"), strict=True) if x == lang]
        names = sorted(set().union(*(words for words, _, _ in got)))
        place = {word: k for k, word in enumerate(names)}
        keys = []
        for words, ranks, _ in got:
            ids = np.array([place[w] for w in words], np.uint64)[ranks]
            keys.append(ids[0] << np.uint64(2 * BITS) | ids[1] << np.uint64(BITS) | ids[2])
        # each run is sorted; a stable sort merges sorted runs
        keys, counts = np.concatenate(keys), np.concatenate([n for _, _, n in got])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n = np.add.reduceat(counts[order], at)
        for key, a in zip(keys[at[n >= least]].tolist(), n[n >= least].tolist(), strict=True):
            words = [names[key >> shift & int(_LOW)].decode() for shift in (2 * BITS, BITS, 0)]
            out.append((lang, words[0], words[1], words[2] or None, a))
    columns = list(zip(*out, strict=True)) if out else [[]] * 5
    return pa.table({k: pa.array(c, t) for k, c, t in zip(("lang", "w1", "w2", "w3", "a"), columns, [pa.string()] * 4 + [pa.int64()], strict=True)})


def frequent(docs: DataFrame, scratch: Scratch, least: int = LEAST, part: int = PART) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, totals, phrases): (lang, word, f), (lang, n) and (lang, w1, w2, w3 or null, a), of what occurs often enough."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = scratch.stored(counted.filter(F.col("word").isNull() | (F.col("n") >= least)))
    totals = counted.filter("word is null").select("lang", "n")
    words = counted.filter("word is not null").select("lang", "word", F.col("n").alias("f"))
    total = totals.agg(F.sum("n")).first()[0] or 0
    hot: dict[str, set[bytes]] = {}
    for row in words.filter(F.col("f") > total / HOT).collect():  # HOT rows at most
        hot.setdefault(row["lang"], set()).add(row["word"].encode())
    parts = 2 * total // part + 1
    runs = texts.mapInArrow(partial(phrase_runs, parts=parts, hot=hot), "part long, lang string, size long, run binary")
    def merge(found: pa.Table) -> pa.Table:
        return merged(found, least)

    phrases = runs.groupBy("part").applyInArrow(merge, "lang string, w1 string, w2 string, w3 string, a long")
    return words, totals, scratch.stored(phrases)


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)"), wide(left) * wide(right))


def collocations(docs: DataFrame, least: int = LEAST, percent: int = PERCENT, ranks: int = RANKS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases."""
    scratch = Scratch()
    words, totals, phrases = frequent(docs, scratch, least)
    two = phrases.filter("w3 is null").select("lang", "w1", "w2", "a")
    three = phrases.filter("w3 is not null")

    def word(name: str, to: str) -> DataFrame:
        return words.select("lang", F.col("word").alias(name), F.col("f").alias(to))

    def pair(first: str, second: str, to: str) -> DataFrame:
        return two.select("lang", F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(to))

    # a phrase of two goes where one of three holds it often enough
    inside = three.select("lang", "w1", "w2", "a").union(three.select("lang", F.col("w2"), F.col("w3"), "a"))
    longest = inside.groupBy("lang", "w1", "w2").agg(F.max("a").alias("most"))
    free = two.join(longest, ["lang", "w1", "w2"], "left").filter(F.col("most").isNull() | (100 * F.col("most") < percent * F.col("a"))).drop("most")
    scored = free.join(word("w1", "l"), ["lang", "w1"]).join(word("w2", "r"), ["lang", "w2"]).select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score")
    )
    parts = three.join(pair("w1", "w2", "l2"), ["lang", "w1", "w2"]).join(pair("w2", "w3", "r1"), ["lang", "w2", "w3"])
    parts = parts.join(word("w1", "l1"), ["lang", "w1"]).join(word("w3", "r2"), ["lang", "w3"])
    cut = lambda k: F.struct(
        _score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")
    )
    lowest = parts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.least(cut(1), cut(2)).alias("cut"))
    both = scored.union(lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = both.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= ranks).join(totals, "lang")
    result = stored(ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
    scratch.drop()
    return result
