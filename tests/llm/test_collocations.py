"""Collocations against brute force; tries, runs and long texts by themselves."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from noticelake.llm import collocations
from noticelake.llm.tables import Scratch

from .conftest import lower

PIECE, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def phrases(text):
    for piece in PIECE.split(lower(text)):
        words = WORD.findall(piece)
        for size in (1, 2, 3):
            for i in range(len(words) - size + 1):
                yield tuple(words[i : i + size])


def brute(rows, least=10, percent=50, ranks=2000):
    """rows: (text, lang)."""
    counts = collections.defaultdict(collections.Counter)
    for text, lang in rows:
        counts["und" if lang is None else lang].update(phrases(text))
    out = []
    for lang, f in counts.items():
        n = sum(a for p, a in f.items() if len(p) == 1)
        found, inside = [], collections.Counter()
        for p, a in f.items():
            if len(p) == 3 and a >= least:
                for part in (p[:2], p[1:]):
                    inside[part] = max(inside[part], a)
        for p, a in f.items():
            if len(p) > 1 and a >= least and not (len(p) == 2 and 100 * inside[p] >= percent * a):
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:ranks], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


ODD = [
    (None, "en"), ("", None), (" \t", "en"), ("New  York\tCity. new york city", "en"), ("new york city, new york\nnew york", "en"), ("a a a a", "xx"),
    ("日本 語 テスト。 日本 語", "ja"), ("x　y z", "en"), ("one", None), ("tie b, tie c; tie b: tie c", "zz"),
]
SCHEMA = "text string, lang string, part int, run string, a string, f string, w1 string, n long"


def test_against_brute_force(spark, docs):
    rows = [(r.text, r.lang) for r in docs.collect()] + ODD * 12
    made = spark.createDataFrame([(*r, 1, "r", "a", "f", "w", 0) for r in rows], SCHEMA).repartition(5)
    assert sorted(map(tuple, collocations.collocations(made).collect())) == brute(rows)
    assert sorted(map(tuple, collocations.collocations(made, least=3, percent=90, ranks=7).collect())) == brute(rows, 3, 90, 7)
    assert collocations.collocations(made.filter("false")).collect() == []


def test_many_partitions_with_hot_words(spark):
    """More prefix partitions than phrases; hot words are dealt by the whole phrase."""
    draw = random.Random(4)
    rows = [(" ".join(draw.choice(["the", "the", "of", "cat", "dog", "sun"]) for _ in range(200)), draw.choice(["en", "de"])) for _ in range(60)]
    made = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    scratch = Scratch()
    _, _, found = collocations.frequent(made, scratch, least=1, part=16)
    want = collections.Counter((lang, *p) for text, lang in rows for p in phrases(text) if len(p) > 1)
    got = {(r.lang, r.w1, r.w2, r.w3) if r.w3 else (r.lang, r.w1, r.w2): r.a for r in found.collect()}
    assert got == want
    scratch.drop()


@pytest.mark.parametrize(("entries", "words", "chunk"), [(30, 1 << 19, 64), (1 << 20, 3, 64), (1 << 20, 1 << 19, 1 << 20), (500, 40, 16)])
def test_runs_of_a_task(monkeypatch, entries, words, chunk):
    """Spilled subtrees, a forgotten vocabulary, long texts in parts and equal first hashes add up to the same counts."""
    monkeypatch.setattr(collocations.Tally.__init__, "__defaults__", (entries, words, chunk))
    monkeypatch.setattr(collocations.Trie.__init__, "__defaults__", (7,))
    monkeypatch.setattr(collocations, "_TABLES", np.stack([collocations._TABLES[0] & np.uint64(0xF0000001), collocations._TABLES[1]]))
    draw = random.Random(8)
    vocabulary = ["a", "B", "ab", "é", "日本", "x" * 30, "longer", "the"]
    rows = [("".join(draw.choice(vocabulary) + draw.choice([" ", "  ", "\t", ". ", "\n", ","]) for _ in range(draw.randint(0, 90))), draw.choice("pq")) for _ in range(50)]
    batches = lambda: iter([
        pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[i : i + 9]], pa.string()) for k in (1, 0)], ["lang", "text"]) for i in range(0, 50, 9)
    ])
    want = collections.defaultdict(collections.Counter)
    for text, lang in rows:
        want[lang].update(phrases(text))
    found = collections.defaultdict(collections.Counter)
    for batch in collocations.word_counts(batches()):
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found[lang][(word,) if word is not None else None] += n
    for lang, f in want.items():
        assert found[lang].pop(None) == sum(n for p, n in f.items() if len(p) == 1)
        assert found[lang] == {p: n for p, n in f.items() if len(p) == 1}
    runs = pa.Table.from_batches(list(collocations.phrase_runs(batches(), 3, {"p": {b"the"}})))
    got = collections.defaultdict(dict)
    for part in range(3):
        of = runs.filter(pa.array([x == part for x in runs.column("part").to_pylist()], pa.bool_()))
        for lang, one, two, three, a in zip(*(c.to_pylist() for c in collocations.merged(of, 1).columns), strict=True):
            phrase = (one, two, three) if three else (one, two)
            assert phrase not in got[lang]  # a phrase lies in one partition
            got[lang][phrase] = a
    assert got == {lang: {p: n for p, n in f.items() if len(p) > 1} for lang, f in want.items()}


def test_bursting_keeps_ranges():
    trie, want = collocations.Trie(burst=5), collections.Counter()
    draw = np.random.default_rng(6)
    for _ in range(40):
        keys = (draw.integers(1, 4, 50) << 42 | draw.integers(0, 4, 50) << 21 | draw.integers(0, 40, 50)).astype(np.uint64)
        trie.add(*np.unique(keys, return_counts=True))
        want.update(keys.tolist())
    assert trie.lows == sorted(trie.lows) and max(c.size for c in trie.containers) <= 5
    for low, high, container in zip(trie.lows, [*trie.lows[1:], 1 << 63], trie.containers, strict=True):
        assert all(low <= k < high for k in container.items()[0].tolist())
    keys, counts = trie.take(100)
    assert sum(c.size for c in trie.containers) <= 100 and len(set(keys.tolist())) == len(keys)
    rest_keys, rest = trie.take(0)
    assert dict(zip([*keys.tolist(), *rest_keys.tolist()], [*counts.tolist(), *rest.tolist()], strict=True)) == want
