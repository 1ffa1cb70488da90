"""Near-duplicates against all pairs, where shards are large or texts repeat their lines."""

import numpy as np
import pyarrow as pa

from noticelake.llm import simhash

from .conftest import lower, words


def kept(rows):
    """The smallest doc_id of each group that pairs at 0.8 join, from all pairs."""
    sets = {}
    for d, t in rows:
        w = words(lower(t))
        sets[d] = {" ".join(w[k : k + 5]) for k in range(max(len(w) - 4, min(len(w), 1)))}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return [d for d in ids if root(d) == d]


def found(spark, rows):
    return sorted(r.doc_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def family(rng, n, copies, passage=170, own=30, changed=18):
    """n texts that share a passage (0.73 similar) and, for some of them, a copy with some of its own words changed (0.83)."""
    shared = [f"p{k}" for k in range(passage)]
    texts = [shared + [f"d{i}w{k}" for k in range(own)] for i in range(n)]
    texts += [t[: len(t) - changed] + [f"c{i}w{k}" for k in range(changed)] for i, t in enumerate(texts[:copies])]
    return [(int(d), " ".join(t)) for d, t in zip(rng.permutation(len(texts)), texts, strict=True)]


def test_family_with_a_shared_passage(spark):
    rows = family(np.random.default_rng(1), 300, 60)
    want = kept(rows)
    assert len(want) == 300
    assert found(spark, rows) == want


def test_large_shards_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 20)
    monkeypatch.setattr(simhash, "BLOCK", 50)
    rows = family(np.random.default_rng(2), 200, 40)
    assert found(spark, rows) == kept(rows)


def test_repeated_lines_do_not_part_equal_sets(spark):
    rng, rows = np.random.default_rng(3), []
    footer = " ".join(f"f{k}" for k in range(14))
    for i in range(40):
        text = " ".join(f"t{i}x{rng.integers(10**6)}" for _ in range(500))
        rows += [(2 * i, f"{text} {' '.join([footer] * 200)}"), (2 * i + 1, f"{text} {' '.join([footer] * 2)}")]
    want = kept(rows)
    assert len(want) == 40
    assert found(spark, rows) == want


def test_sketches_never_differ_in_more_than_the_sets():
    rng = np.random.default_rng(4)
    for n in (0, 3, 200, 5000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[n // 4 :], rng.integers(0, 2**63, n // 5 + 1, dtype=np.uint64)]))
        x, y = simhash.odd_sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_a_repeated_id_takes_no_other_documents_text_along(spark):
    # of id 1 the text with the least key stays; the other text must stay as document 2
    for one, two in (("alpha beta", "gamma delta"), ("gamma delta", "alpha beta")):
        rows = simhash.near_duplicates(spark.createDataFrame([(1, one), (1, two), (2, two), (3, one)], "doc_id long, text string")).collect()
        assert {r.text for r in rows} == {one, two}
        assert [r.doc_id for r in rows].count(1) == 1


def test_trees_give_the_nearest_fingerprints():
    rng = np.random.default_rng(5)
    values = [int(x) for x in rng.integers(0, 2**63, 300)]
    values += [v ^ (1 << int(b)) ^ (1 << int(c)) for v, b, c in zip(values[:100], rng.integers(0, 63, 100), rng.integers(0, 63, 100), strict=True)]
    values = list(dict.fromkeys(values))
    tree = simhash.BKTree()
    for at, value in enumerate(values):
        want = sorted(((v ^ value).bit_count(), i) for i, v in enumerate(values[:at]))[:4]
        assert tree.nearest(value, 4) == want
        assert tree.add(value) == at


def test_links_between_near_copies_come_from_the_trees(spark, monkeypatch):
    # 40 pairs at 0.9, about 5 bits apart: without the check of the rest all are found, and each text is looked up in a tree
    rng, rows = np.random.default_rng(6), []
    for i in range(40):
        text = [f"t{i}x{rng.integers(10**6)}" for _ in range(200)]
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join([*text[:190], *(f"c{i}w{k}" for k in range(10))]))]
    cell = sorted(rows)
    docs = [t for _, t in cell]
    (batch,) = simhash._sketch(iter([pa.RecordBatch.from_pydict({"doc_id": range(80), "text_key": docs, "text": docs})]), 5, 8)
    one = pa.array(np.zeros(80, np.int64))
    batch = pa.RecordBatch.from_arrays([one, one, one, *(batch.column(k) for k in ("doc_id", "n", "fp", "sketch"))], ["band", "key", "salt", "id", "n", "fp", "sketch"])
    looked, nearest = [], simhash.BKTree.nearest
    monkeypatch.setattr(simhash.BKTree, "nearest", lambda self, value, k: looked.append(value) or nearest(self, value, k))
    pairs = {(r["a"], r["b"]) for out in simhash._nearest(iter([batch]), 0.2 / 1.8) for r in out.to_pylist()}
    assert pairs >= {(2 * i + 1, 2 * i) for i in range(40)}
    assert len(looked) == 80
    assert found(spark, rows) == kept(rows) == list(range(0, 80, 2))


def test_groups_are_made_once_where_nothing_remains_apart(spark, monkeypatch):
    text = " ".join(f"w{k}" for k in range(60))
    made, components = [], simhash.components
    monkeypatch.setattr(simhash, "components", lambda links: made.append(1) or components(links))
    assert found(spark, [(1, text), (2, f"{text} end"), (3, "other words")]) == [1, 3]
    assert len(made) == 1
