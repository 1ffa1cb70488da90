"""SimHash fingerprints, links between near ones found in BK-trees, and near-duplicate groups.

``fingerprints`` makes one 64-bit SimHash per text from the XXH64 of its word shingles. ``link_fingerprints`` finds all
fingerprints within a small radius exactly: whoever differs in at most r of 64 bits agrees on one of r + 1 parts, so the
shards are the values of a part. A shard that is too large is split again by the parts of its other bits, a few times; what stays large
lies dense and is joined by flipping bits. A small shard becomes a BK-tree (children keyed by their Hamming distance to the parent); a lookup
follows only edges within the radius. Trees stay in the task that owns the shard: sent to all tasks, they would grow with
the data.

``near_duplicates`` is for larger differences (five-word shingles, Jaccard similarity 0.8 or more, which is about 10 bits): shards are
pairs of min-hashes, each shard's fingerprints go into BK-trees, and each text is tried with those nearest to it in its tree. An exact
check follows: all pairs of a shard whose texts these links have not joined yet are tried, in blocks against blocks. Pairs are left out by
a bound alone that no similar pair exceeds (odd sketches of the distinct shingles), and every link is verified on the texts' shingle sets.

Defined cases: a text with fewer words than a shingle is one shingle; a null or empty text has fingerprint zero, which is
linked like any other; repeated rows and ids fall into one group; a null doc_id has no component of its own; an empty table
gives no rows; further columns take no part (near_duplicates keeps them).
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.session import cut_lineage

from .graph import components
from .tables import Scratch, fresh, stored
from .text import Words, mix, pieces

#: A shard above this many fingerprints is split by further bits.
SHARD = 1500
#: So often; a shard that is large even then is joined by flipped bits.
LEVELS = 4
SEED = 42
BANDS = 8
NEAREST = 4
#: About so many texts of a (band, key) shard look for their nearest ones together.
CELL = 500
#: About so many texts of a shard in which groups remain apart are compared with as many others in one piece.
BLOCK = 1000
#: 64-bit words of a sketch.
WIDTH = 16


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle and each text's first one (and one end)."""
    out, starts = words.spaced()
    counts = words.counts
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(shingles)])
    at = np.arange(first[-1]) - np.repeat(first[:-1], shingles) + np.repeat(words.first[:-1], shingles)
    begins = starts[at].tolist()
    ends = (starts[at + np.repeat(np.minimum(counts, size), shingles)] - 1).tolist()
    raw, digest = out.tobytes(), xxhash.xxh64_intdigest
    return np.array([digest(raw[a:b], SEED) for a, b in zip(begins, ends, strict=True)], np.uint64), first


def simhash(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A bit is 1 if more than half of a text's hashes have it."""
    out = np.zeros(len(first) - 1, np.uint64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, first[full], axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > np.diff(first)[full, None], axis=1).view(">u8")[:, 0].astype(np.uint64)
    return out


def _fingerprint(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in pieces(batch.column("text")):
            hashes, first = shingle_hashes(Words(data, offsets, lower=True), size)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(simhash(hashes, first).view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, fp. One pass over the texts, no shuffle."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(partial(_fingerprint, size=size), "doc_id long, fp long")


class BKTree:
    """Fingerprints by Hamming distance to their parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        self.values.append(value)
        self.children.append({})
        new = len(self.values) - 1
        at = 0
        while at != new:
            d = (self.values[at] ^ value).bit_count()
            at = self.children[at].setdefault(d, new)
        return new

    def near(self, value: int, radius: int) -> list[tuple[int, int]]:
        """(distance, index) of all values within the radius."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append((d, at))
            todo += [c for edge, c in self.children[at].items() if d - radius <= edge <= d + radius]
        return found

    def nearest(self, value: int, k: int) -> list[tuple[int, int]]:
        """(distance, index) of the k values nearest to this one, ties to the earlier; the radius shrinks to the worst of those found."""
        found, todo = [], [(0, 0)] if self.values else []
        while todo:
            bound, at = todo.pop()
            if len(found) == k and bound > found[-1][0]:
                continue
            d = (self.values[at] ^ value).bit_count()
            insort(found, (d, at))
            del found[k:]
            # the most promising edge is followed first
            todo += sorted(((abs(edge - d), c) for edge, c in self.children[at].items()), reverse=True)
        return found


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[bool, list[np.ndarray]]]:
    """Batches sorted by keys, as (starts a new group, columns) of stretches that belong to one group."""
    before = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not batch.num_rows:
            continue
        key = [columns[batch.schema.get_field_index(k)] for k in keys]
        change = np.any([k[1:] != k[:-1] for k in key], axis=0)
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:], strict=False):
            now = tuple(k[a] for k in key)
            yield now != before, [c[a:b] for c in columns]
            before = now


def _tree_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Shards sorted by (mask, part) to links that join all fingerprints of a shard that reach each other in it."""
    tree, ids, parent, out = BKTree(), [], [], []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for new, (_, _, fps, reps) in _runs(batches, ["mask", "part"]):
        if new:
            tree, ids, parent = BKTree(), [], []
        for fp, rep in zip(fps.view(np.uint64).tolist(), reps.tolist(), strict=True):
            hits = tree.near(fp, radius)
            me = tree.add(fp)
            ids.append(rep)
            parent.append(me)
            for _, i in hits:
                if (r := root(i)) != root(me):
                    parent[r] = me
                    out.append((rep, ids[i]))
        if len(out) > 50_000:
            yield pa.RecordBatch.from_pydict({"a": [x[0] for x in out], "b": [x[1] for x in out]})
            out = []
    if out:
        yield pa.RecordBatch.from_pydict({"a": [x[0] for x in out], "b": [x[1] for x in out]})


def _parts(mask: int, parts: int) -> list[int]:
    """mask with one more of the equal parts of the bits that it lacks."""
    free = [i for i in range(64) if not mask >> i & 1]
    bounds = [len(free) * k // parts for k in range(parts + 1)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(bounds, bounds[1:], strict=False) if b > a]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _dense_links(rows: DataFrame, radius: int) -> DataFrame:
    """Links of fingerprints so close together that no further bits part them.

    Two fingerprints within the radius become one value by flipping half of the radius (rounded up) in one and the rest in the other.
    So everybody looks for the smallest document at each value that it reaches: what it finds is within the radius, and
    whoever is within the radius finds the same. 65 values a fingerprint at radius 2, however dense they lie.
    """
    distinct = rows.select("fp", "rep").distinct()

    def reached(flips: int) -> DataFrame:
        masks = [_signed(sum(1 << i for i in bits)) for k in range(flips + 1) for bits in combinations(range(64), k)]
        return distinct.withColumn("mask", F.explode(F.array(*[F.lit(m) for m in masks]))).select(F.col("fp").bitwiseXOR(F.col("mask")).alias("value"), "rep")

    least = reached(radius // 2).groupBy("value").agg(F.min("rep").alias("b"))
    return reached((radius + 1) // 2).join(least, "value").filter("rep <> b").select(F.col("rep").alias("a"), "b").distinct()


def link_fingerprints(nodes: DataFrame, radius: int = 2, shard: int = SHARD, levels: int = LEVELS) -> DataFrame:
    """nodes (fp, rep: distinct fingerprints and their smallest document) to links (a, b) of documents, enough to join all
    fingerprints that reach each other by steps of at most radius bits.

    Masks that still hold a large shard are split further, levels times at most; what is large then lies so dense that flipped bits
    join it.
    """
    spark = nodes.sparkSession
    masks = _parts(0, radius + 1)
    rows, links = nodes.withColumn("mask", F.explode(F.array(*[F.lit(_signed(m)) for m in masks]))), None
    for level in range(levels):
        rows = rows.withColumn("part", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = rows.groupBy("mask", "part").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        sized = cut_lineage(rows.join(sizes, ["mask", "part"]))
        small = sized.filter(F.col("n") <= shard).select("mask", "part", "fp", "rep")
        found = small.repartition("mask", "part").sortWithinPartitions("mask", "part", "rep").mapInArrow(partial(_tree_links, radius=radius), "a long, b long")
        links = found if links is None else links.union(found)
        rows = sized.filter(F.col("n") > shard).select("mask", "fp", "rep")
        # at most (radius + 1) ** levels masks
        crowded = [r["mask"] % (1 << 64) for r in rows.select("mask").distinct().collect()]
        if not crowded:
            return links
        if level < levels - 1:
            finer = [(_signed(m), _signed(x)) for m in crowded for x in _parts(m, radius + 1)]
            table = spark.createDataFrame(finer, "mask long, finer long")
            rows = rows.join(F.broadcast(table), "mask").select("fp", "rep", F.col("finer").alias("mask"))
    return links.union(_dense_links(rows, radius))


def simhash_components(docs: DataFrame, size: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fp and component_id: the smallest doc_id reachable over fingerprints within the radius, itself included."""
    made = cut_lineage(fingerprints(docs, size))
    nodes = cut_lineage(made.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    groups = components(link_fingerprints(nodes.filter("rep is not null"), radius))
    named = nodes.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return made.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _distinct(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct hashes, and each text's first one (and one end)."""
    sets = [np.unique(hashes[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)
    return np.concatenate(sets) if sets else hashes[:0], ends


def odd_sketches(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text 64 * WIDTH bits: whether an odd number of its (distinct) hashes fall on each.

    Hashes that two texts share cancel out, so their sketches differ in no more bits than their sets differ in hashes.
    """
    out = np.zeros((len(first) - 1) * WIDTH, np.uint64)
    place = mix(hashes ^ np.uint64(0xD1B54A32D192ED03))
    word = np.repeat(np.arange(len(first) - 1), np.diff(first)) * WIDTH + (place >> np.uint64(8)).astype(np.int64) % WIDTH
    np.bitwise_xor.at(out, word, np.uint64(1) << (place & np.uint64(63)))
    return out.reshape(-1, WIDTH)


def _sketch(batches: Iterator[pa.RecordBatch], size: int, bands: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in pieces(batch.column("text")):
            hashes, first = shingle_hashes(Words(data, offsets, lower=True), size)
            fps = pa.array(simhash(hashes, first).view(np.int64))
            hashes, first = _distinct(hashes, first)
            keys = np.zeros((len(first) - 1, bands), np.uint64)
            full = np.flatnonzero(np.diff(first))
            for k in range(2 * bands):
                least = np.minimum.reduceat(mix(hashes ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64)), first[full]) if len(full) else hashes[:0]
                keys[full, k // 2] = mix(keys[full, k // 2] * np.uint64(31) + least)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), pa.array(keys.view(np.int64).ravel()))
            sketches = pa.array([x.tobytes() for x in odd_sketches(hashes, first)], pa.binary())
            columns = [*(batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_key")), pa.array(np.diff(first)), fps, sketches, lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n", "fp", "sketch", "bands"])


def _shards(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Batches sorted by keys, as columns of all rows of a group; sketches as rows of WIDTH numbers."""
    names, held = [], []

    def named() -> dict[str, np.ndarray]:
        out = dict(zip(names, (np.concatenate(c) if len(held) > 1 else c[0] for c in zip(*held, strict=True)), strict=True))
        return out | {"sketch": np.frombuffer(b"".join(out["sketch"]), np.uint64).reshape(-1, WIDTH)}

    def seen() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names[:] = batch.schema.names
            yield batch

    for new, columns in _runs(seen(), keys):
        if new and held:
            yield named()
            held = []
        held.append(columns)
    if held:
        yield named()


def _possible(x: dict[str, np.ndarray], y: dict[str, np.ndarray], apart: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row of x, bits, possible) of some rows of x after others against all of y. What isn't possible differs in more than
    this part of both sets' shingles, so that no similar pair is lost."""
    step = max(1, (1 << 20) // (WIDTH * len(y["n"])))
    for lo in range(0, len(x["n"]), step):
        bits = np.bitwise_count(x["sketch"][lo : lo + step, None] ^ y["sketch"][None]).sum(axis=2, dtype=np.int32)
        yield lo, bits, bits <= apart * (x["n"][lo : lo + step, None] + y["n"][None]) + 1e-6


def _packed(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Pairs of ids as batches of a (the larger) and b."""
    held, rows = [], 0
    for a, b in found:
        held.append((np.maximum(a, b), np.minimum(a, b)))
        rows += len(a)
        if rows > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], ["a", "b"])
            held, rows = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], ["a", "b"])


def _nearest(batches: Iterator[pa.RecordBatch], apart: float) -> Iterator[pa.RecordBatch]:
    """Cells sorted by (band, key, salt, id) to pairs of each text and those of the NEAREST fingerprints among the smaller ids in its
    cell that are possible. Texts of one fingerprint are one node of the cell's BK-tree; each is tried with the last few before it."""

    def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for cell in _shards(batches, ["band", "key", "salt"]):
            tree, at, members, pairs = BKTree(), {}, [], []
            for i, fp in enumerate(cell["fp"].view(np.uint64).tolist()):
                near = [j for _, node in tree.nearest(fp, NEAREST) for j in members[node]]
                pairs += [(i, j) for j in near[:NEAREST]]
                if fp not in at:
                    at[fp] = tree.add(fp)
                    members.append([])
                members[at[fp]] = [i, *members[at[fp]]][:NEAREST]
            if pairs:
                x, y = np.array(pairs).T
                n, sketch = cell["n"], cell["sketch"]
                possible = np.bitwise_count(sketch[x] ^ sketch[y]).sum(axis=1, dtype=np.int32) <= apart * (n[x] + n[y]) + 1e-6
                yield cell["id"][x[possible]], cell["id"][y[possible]]

    return _packed(found())


def _across(batches: Iterator[pa.RecordBatch], apart: float) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks sorted by (band, key, i, j) to all possible pairs of block i and block j whose groups differ."""

    def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for shard in _shards(batches, ["band", "key", "i", "j"]):
            i, j = shard["i"][0], shard["j"][0]
            x, y = ({c: v[shard["block"] == k] for c, v in shard.items()} for k in (i, j))
            if not len(x["n"]) or not len(y["n"]) or (min(x["component"].min(), y["component"].min()) == max(x["component"].max(), y["component"].max())):
                continue
            for lo, bits, possible in _possible(x, y, apart):
                possible &= x["component"][lo : lo + len(bits), None] != y["component"][None]
                if i == j:
                    possible &= x["id"][lo : lo + len(bits), None] > y["id"][None]
                row, k = np.nonzero(possible)
                yield x["id"][lo + row], y["id"][k]

    return _packed(found())


def _shingle_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in pieces(batch.column("text")):
            hashes, first = _distinct(*shingle_hashes(Words(data, offsets, lower=True), size))
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), lists], ["doc_id", "shingles"])


def _hashed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key that only equal texts share, of the rows with a doc_id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("text_key")).filter("doc_id is not null")


def _verified(docs: DataFrame, firsts: DataFrame, pairs: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have at least this Jaccard similarity."""
    scratch = Scratch()
    wanted = scratch.stored(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct().join(firsts, "doc_id"))
    sets = docs.join(wanted, ["doc_id", "text_key"]).select("doc_id", "text")
    sets = scratch.stored(sets.mapInArrow(partial(_shingle_sets, size=size), "doc_id long, shingles array<long>"))
    joined = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
    both = F.size(F.array_intersect("x", "y"))
    links = stored(joined.filter(both >= similarity * (F.size("x") + F.size("y") - both)).select("a", "b"))
    scratch.drop()
    return links


def similar_groups(docs: DataFrame, firsts: DataFrame, size: int = 5, similarity: float = 0.8, bands: int = BANDS) -> DataFrame:
    """(node, component) of all documents that reach others over pairs that share a shard and whose shingle sets have at least
    this Jaccard similarity; component is the smallest of them.

    docs: doc_id, text, text_key; firsts: the (unique) doc_id and text_key that count. A pair at 0.8 shares one of 8 pairs of
    min-hashes with probability 0.9997. The first round tries each text with the nearest fingerprints, found in BK-trees of salted parts of
    the shards. The second one tries all other pairs of a shard that the first round's links have not joined.
    """
    scratch = Scratch()
    apart = (1 - similarity) / (1 + similarity)
    rows = docs.select("doc_id", "text", "text_key")
    made = rows.mapInArrow(partial(_sketch, size=size, bands=bands), "doc_id long, text_key string, n long, fp long, sketch binary, bands array<long>")
    made = scratch.stored(made.join(firsts, ["doc_id", "text_key"], "left_semi").drop("text_key").dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "id"))
    sketches = made.select("id", "n", "sketch")
    rows = made.select(F.posexplode("bands").alias("band", "key"), "id")
    shared = rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    rows = scratch.stored(rows.join(shared, ["band", "key"]))
    cells = rows.withColumn("salt", F.pmod(F.xxhash64("band", "id"), F.ceil(F.col("texts") / CELL))).join(made.select("id", "n", "fp", "sketch"), "id").select("band", "key", "salt", "id", "n", "fp", "sketch")
    cells = cells.repartition("band", "key", "salt").sortWithinPartitions("band", "key", "salt", "id")
    tried = scratch.stored(cells.mapInArrow(partial(_nearest, apart=apart), "a long, b long").distinct())
    links = _verified(docs, firsts, tried, size, similarity)

    # in smaller shards a text's nearest ones are all others
    groups = components(links)
    rows = scratch.stored(rows.filter(F.col("texts") > NEAREST + 1).join(groups.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id")))
    open_ = rows.groupBy("band", "key").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least <> most").select("band", "key")
    blocks = F.ceil(F.col("texts") / BLOCK)
    rows = rows.join(open_, ["band", "key"]).withColumn("block", F.pmod(F.xxhash64("band", "id"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    rows = rows.select("band", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "component")
    rows = rows.join(sketches, "id").select("band", "key", "i", "j", "block", "id", "component", "n", "sketch")
    rows = rows.repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j")
    rest = scratch.stored(rows.mapInArrow(partial(_across, apart=apart), "a long, b long").distinct().join(tried, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        links = _verified(docs, firsts, rest, size, similarity)
        if not links.isEmpty():
            # the groups found before are stars already
            groups = components(links.union(groups.select("node", "component")))
    scratch.drop()
    return groups


def near_duplicates(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs without all but the smallest doc_id of each group of equal or similar texts; rows without a doc_id stay.

    Null and empty texts are equal texts. Of rows that repeat a doc_id the one with the least text key stays, once.
    """
    keyed = _hashed(docs)
    firsts = keyed.groupBy("doc_id").agg(F.min("text_key").alias("text_key")).groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
    firsts = stored(firsts)
    groups = similar_groups(keyed, firsts, size, similarity)
    dropped = groups.filter("node <> component").select(F.col("node").alias("doc_id"))
    of, key = fresh(docs.columns, "_of", "_key")
    kept = stored(firsts.join(dropped, "doc_id", "left_anti").select(F.col("doc_id").alias(of), F.col("text_key").alias(key)))
    text = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    out = docs.join(kept, (F.col("doc_id").cast("long") == F.col(of)) & (text == F.col(key)), "left_semi")
    twice = keyed.join(kept, (keyed.doc_id == F.col(of)) & (keyed.text_key == F.col(key)), "left_semi").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not twice.isEmpty():
        out = out.dropDuplicates(["doc_id"])
    return out.unionByName(docs.filter("doc_id is null"))
