"""Source divergence against brute force, its packed counts, and odd rows."""

import collections
import re
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
import pytest

from noticelake.llm import divergence

from .conftest import lower

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=3, ranks=200):
    """rows: (text, lang, source)."""
    docs = [([lower(t) for t in TERM.findall(text or "")], lang or "", source or "") for text, lang, source in rows]
    out = []
    for lang in {x for _, x, _ in docs}:
        found, groups = collections.Counter(), {s: collections.Counter() for _, x, s in docs if x == lang}
        for terms, x, source in docs:
            if x == lang:
                found.update(set(terms))
                groups[source].update(terms)
        kept = [t for t, n in found.items() if n >= least]
        groups = {s: {t: c[t] for t in kept} for s, c in groups.items()}
        whole = {t: sum(c[t] for c in groups.values()) for t in kept}
        share = lambda c: {t: 1 + floor(Fraction(10**9 * (c[t] + 1), sum(c.values()) + len(kept))) for t in kept}
        q, ps = share(whole), {s: share(c) for s, c in groups.items()}
        for s, p in ps.items():
            pair = [(sum((p[t] - o[t]) ** 2 // o[t] for t in kept), x) for x, o in ps.items() if x != s]
            term = [((p[t] - q[t]) ** 2 // q[t], t) for t in kept if groups[s][t] and p[t] > q[t]]
            for part, items in (("pair", pair), ("term", term)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(items, 1) if part == "pair" or k <= ranks]
    return sorted(out)


ODD = [
    (None, None, None), ("", "en", "empty"), ("a b a", "en", "s1"), ("A b c", "en", "s2"), ("a-b 1c", "en", None), ("b a", "en", "s1"), ("b a", "en", "s1"),
    ("eightlet ninelette sixteenletterwd seventeenletterw", "en", "s2"), ("EIGHTLET Ninelette sixteenletterwd seventeenletterw", "en", "s1"),
    ("eightlet ninelette sixteenletterwd seventeenletterw seventeenletterw", "en", "s3"), ("日本語テスト。 ü Ü é", "xx", "one"), ("日本語テスト。 ü", "xx", "one"),
    ("日本語テスト。 ü \x00 ß\x7fß", "xx", "one"), ("solo", "yy", "p"), ("duo", "yy", "q"), ("word " * 3000 + "last", "en", "s2"), ("tie tye", "zz", "a"), ("tie tye", "zz", "b"),
    ("tie tye", "zz", "c"),
]
SCHEMA = "text string, lang string, source string, n long, term string, item string, value string, block int, words int, part string"


def test_against_brute_force(spark, docs):
    rows = [(r.text, r.lang, r.source) for r in docs.collect()] + ODD
    made = spark.createDataFrame([(*r, 1, "t", "i", "v", 0, 0, "p") for r in rows], SCHEMA).repartition(7)
    want = brute(rows)
    assert sorted(map(tuple, divergence.divergence(made).collect())) == want
    # small blocks give the same sums
    kept = divergence.kept_terms(made).cache()
    small = divergence.source_pairs(kept, divergence.group_figures(made, kept), block_rows=50).collect()
    assert sorted((*r[:2], "pair", *r[2:]) for r in small) == [r for r in want if r[2] == "pair"]
    assert divergence.divergence(made.filter("false")).collect() == []


@pytest.mark.parametrize("held", [5, 200, 1 << 20])
def test_counts_of_a_task(monkeypatch, held):
    """Runs merged or emitted early, and texts counted in parts, add up to the same counts."""
    draw = np.random.default_rng(2)
    words = ["a", "ab", "ABCDEFGH", "abcdefghi", "p" * 16, "q" * 17, "é" * 4, "日本語テスト長い語", "zz", "Zz"]
    rows = [(" ".join(draw.choice(words, draw.integers(0, 60))) or None, str(draw.integers(2)), str(draw.integers(3))) for _ in range(300)]
    rows.append(("zz abcdefghi, " + "q" * 17 + " a" * 500, "0", "0"))
    monkeypatch.setattr(divergence, "CHUNK", 64)
    monkeypatch.setattr(divergence, "HELD", held)
    monkeypatch.setattr(divergence.Counter.__init__, "__defaults__", (held,))
    want = collections.defaultdict(lambda: [0, 0])
    for text, lang, source in rows:
        for term, n in collections.Counter(lower(t) for t in TERM.findall(text or "")).items():
            want[lang, source, term][0] += n
            want[lang, source, term][1] += 1
    batches = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[i : i + 40]], pa.string()) for k in (1, 2, 0)], ["lang", "source", "text"]) for i in range(0, len(rows), 40)]
    got = collections.defaultdict(lambda: [0, 0])
    for batch in divergence.counted(iter(batches)):
        for lang, source, term, n, df in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            got[lang, source, term][0] += n
            got[lang, source, term][1] += df
    assert got == want


def test_shares_are_exact():
    counts, totals = np.array([0, 1, 5, 10**13, 3 * 10**14]), np.array([1, 3, 7, 9 * 10**14, 9 * 10**14])
    assert divergence.shares(counts[1:], totals[1:]).tolist() == [1 + 10**9 * (int(c) + 1) // int(t) for c, t in zip(counts[1:], totals[1:], strict=True)]
