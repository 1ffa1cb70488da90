"""Operators on documents against brute force, on odd rows, and on an empty table."""

import collections
import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from noticelake.llm import ctw, host_rules, mixing, packing, quality, simhash, substrings

from .conftest import lower, words

CODER = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def groups(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_packing_round_trip(docs, rows):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter((d, tuple(coder.encode(t or "", add_special_tokens=False).ids) + (0,)) for d, t, _ in rows)
    pieces = packing.pack(docs, CODER).collect()
    sequences, whole, open_docs = collections.defaultdict(list), collections.Counter(), []
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == sum(x.length for x in sequences[p.sequence_id])
        sequences[p.sequence_id].append(p)
        ids = tuple(np.frombuffer(p.ids, "<u4").tolist())
        assert len(ids) == p.length
        open_docs = [] if p.start == 0 else open_docs
        assert p.start == len(open_docs)
        open_docs = [*open_docs, *ids]
        if len(open_docs) == p.doc_tokens:
            whole[p.doc_id, tuple(open_docs)] += 1
    assert whole == want
    assert max(sum(x.length for x in s) for s in sequences.values()) <= 1024
    parts = docs.rdd.getNumPartitions()
    used = sum(p.length for p in pieces)
    assert len(sequences) * 1024 - used <= parts * 1024 + 0.02 * used
    digests = packing.with_digests(packing.pack(docs, CODER)).select("ids_crc32").collect()
    assert sorted(r[0] for r in digests) == sorted(zlib.crc32(p.ids) for p in pieces)


def test_ids_of_long_blanks_and_special_strings():
    from tokenizers import Tokenizer

    coder, ids = Tokenizer.from_file(CODER[0]), packing.Ids(*CODER)
    texts = [" " * 2_000_000, "\n" * 2_000_000, "a" + " \t" * 1_000_000 + "b", "\u3000" * 20_000 + "x", "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext|"]
    texts += [" " * packing.BLANKS, " " * (packing.BLANKS - 1) + "x", "a" * 200_000, "=" * 100_000, "x \n" * 100_000, "é" * 50_000, ""]
    for text in texts:
        assert np.array_equal(np.frombuffer(ids.of(text), "<u4"), np.array(coder.encode(text, add_special_tokens=False).ids, np.uint32)), text[:20]
    assert len(ids.marks) > 50256


def test_window_cuts_are_optimal():
    rng = np.random.default_rng(3)
    for _ in range(20):
        n = int(rng.integers(1, 60))
        sentence = rng.random(n) < 0.2
        ends = np.append(np.flatnonzero(rng.random(n) < 0.1) + 1, n)
        got = packing.cuts(ends, sentence, 16, 0.5, 2.0, 4)
        allowed = {}
        last = 0
        for j in range(1, n + 1):
            cost = 0.0 if j in ends or j == n else 0.5 if sentence[j - 1] else None
            if cost is not None:
                for k in range(last + 4, j, 4):
                    allowed[k] = 2.0
                allowed[j], last = cost, j
        best = {0: 0.0}
        for j in sorted(allowed):
            best[j] = min(best[i] + 16 - (j - i) + allowed[j] for i in best if j - i <= 16)
        assert sum(allowed[b] + 16 - (b - a) for a, b in zip([0, *got], got, strict=False)) == pytest.approx(best[n])


def test_host_figures_and_verdicts(docs, rows, spark):
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.kept) for r in host_rules.host_rules(docs).collect())
    base, hosts = [], collections.defaultdict(list)
    for d, t, s in rows:
        w, seen, repeated = words(t), set(), 0
        for line in (t or "").split("\n"):
            if words(line):
                repeated += line in seen
                seen.add(line)
        windows = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        base.append((d, s, (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), repeated, len(covered)), failed))
        hosts[s].append(failed)
    rates = {s: np.mean(f) for s, f in hosts.items()}
    mean = np.mean([f for _, _, _, f in base])
    between = np.var(list(rates.values())) - mean * (1 - mean) * np.mean([1 / len(f) for f in hosts.values()])
    strength = max(1, mean * (1 - mean) / between - 1) if between > 0 else np.mean([len(f) for f in hosts.values()])
    bad = {s for s, f in hosts.items() if (sum(f) + mean * strength) / (len(f) + strength) > host_rules.HOST_LIMIT}
    assert got == collections.Counter((d, *figures, not failed and s not in bad) for d, s, figures, failed in base)
    # a host of which nearly all fails goes as a whole
    made = spark.createDataFrame([(i, ("w%d " % i * 5) if i < 400 and i % 20 else " ".join(f"v{i}x{k}" for k in range(60)), "bad" if i < 400 else f"s{i % 9}") for i in range(1500)], "doc_id long, text string, source string")
    kept = {(r.host, r.kept) for r in host_rules.host_rules(made).select("host", "kept").distinct().collect()}
    assert ("bad", True) not in kept and ("s1", True) in kept and ("s1", False) not in kept


def test_simhash_components(docs, rows):
    got = collections.Counter((r.doc_id, int(r.fp) % 2**64, r.component_id) for r in simhash.simhash_components(docs).collect())
    made = []
    for d, t, _ in rows:
        w = words(lower(t))
        hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(len(w) - 2, min(len(w), 1)))]
        made.append((d, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))))
    fps = sorted({fp for _, fp in made})
    of = groups(fps, [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 2])
    least = {}
    for d, fp in made:
        if d is not None:
            least[of[fp]] = min(least.get(of[fp], d), d)
    assert got == collections.Counter((d, fp, least.get(of[fp])) for d, fp in made)


@pytest.mark.parametrize(("shard", "levels", "radius"), [(2, 2, 2), (5, 4, 2), (60, 3, 2), (1500, 4, 2), (2, 2, 3), (3, 1, 1)])
def test_small_shards_lose_no_link(spark, shard, levels, radius):
    """Dense balls around a few centres, and one large ball of all that is one bit away from its centre."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 6)
    fps = {int(b) ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in rng.integers(0, 63, (15, 2))}
    fps = list(fps | {int(base[0]) ^ (1 << i) for i in range(63)})
    nodes = spark.createDataFrame([(fp, i) for i, fp in enumerate(fps)], "fp long, rep long")
    want = groups(range(len(fps)), [(i, j) for i, a in enumerate(fps) for j in range(i) if (a ^ fps[j]).bit_count() <= radius])
    got = {r.node: r.component for r in simhash.components(simhash.link_fingerprints(nodes, radius, shard, levels)).collect()}
    assert {i: got.get(i, i) for i in want} == want


def test_near_duplicates_keep_one_of_each_group(spark):
    rng = np.random.default_rng(8)
    rows, i = [], 0
    for _ in range(30):
        text = [f"t{rng.integers(5000)}" for _ in range(200)]
        for _ in range(rng.integers(1, 6)):
            copy = list(text)
            for at in rng.integers(0, 200, rng.integers(0, 4)):
                copy[at] = f"u{rng.integers(10**6)}"
            rows.append((i, " ".join(copy), "extra"))
            i += 1
    rows += [(1000, rows[0][1].upper(), "extra"), (1001, None, "extra"), (1002, "", "extra"), (None, rows[0][1], "extra"), (2, rows[2][1], "extra")]
    out = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, _key string")).collect()
    sets = {}
    for d, t, _ in rows:
        w = words(lower(t))
        sets.setdefault(d, frozenset(" ".join(w[k : k + 5]) for k in range(max(len(w) - 4, min(len(w), 1)))))
    ids = [d for d in sets if d is not None]
    near = [(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = groups(ids, near)
    assert sorted(r.doc_id for r in out if r.doc_id is not None) == sorted({d for d in want if want[d] == d})
    assert sum(r.doc_id is None for r in out) == 1


def test_substrings(docs, rows):
    first = {}
    for d, t, _ in rows:
        w = words(t)
        for i in range(len(w) - 49 if d is not None else 0):
            key = tuple(w[i : i + 50])
            first[key] = min(first.get(key, d), d)

    def kept(d, t):
        w = words(t)
        gone = {i + k for i in range(len(w) - 49 if d is not None else 0) if first[tuple(w[i : i + 50])] < d for k in range(50)}
        return [x for i, x in enumerate(w) if i not in gone]

    want = collections.Counter((d, len(words(t)), len(words(t)) - len(kept(d, t)), hashlib.sha256(" ".join(kept(d, t)).encode()).hexdigest()) for d, t, _ in rows)
    got = substrings.cut_documents(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert collections.Counter(map(tuple, got)) == want
    out = substrings.without_repeats(docs)
    assert out.columns == docs.columns
    assert collections.Counter((r.doc_id, " ".join(words(r.text))) for r in out.collect()) == collections.Counter((d, " ".join(kept(d, t))) for d, t, _ in rows)


def test_mixing(docs, rows):
    got = mixing.taken_words(docs, shard_words=2000).collect()
    size, order = collections.defaultdict(int), sorted({s for _, _, s in rows if s is not None}) + [None]
    for _, t, s in rows:
        size[s] += len(words(t))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(size.values()))
    while over := [s for s in free if left / sum(weight[x] for x in free) * weight[s] > 3 * size[s] + 1e-9]:
        for s in over:
            target[s] = 3.0 * size[s]
        left -= sum(target[s] for s in over)
        free -= set(over)
    target |= {s: left / sum(weight[x] for x in free) * weight[s] for s in free}
    taken, largest = collections.defaultdict(int), collections.defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == size[r.source] and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert len(got) == len(rows)
    assert all(abs(taken[s] - target[s]) <= max(0.05 * target[s], largest[s] / 2) for s in order)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.taken_words(docs.repartition(3), shard_words=2000).collect()), key=str)
    out = mixing.mixed(docs, shard_words=2000)
    assert out.columns == docs.columns
    copies = collections.Counter()
    for r in out.collect():
        copies[r.doc_id] += len(words(r.text))
    assert {d: n for d, n in copies.items() if n} == {d: n for d, n in ((d, sum(r.taken for r in got if r.doc_id == d)) for d in {r.doc_id for r in got}) if n}


def test_tree_gives_each_shard_its_share(spark):
    import pandas as pd

    quotas = [1000, 37, 1]
    leaves = pd.concat(mixing._leaves(iter([pd.DataFrame({"id": [3, 0, 6]}), pd.DataFrame({"id": [1, 2, 4, 5]})]), quotas, 7, 1))
    for src, n in enumerate(quotas):
        taken = sorted(x for _, r in leaves[leaves.src == src].iterrows() for x in range(r["first"], r["last"]))
        assert taken == list(range(n))
    sizes = leaves.assign(n=leaves["last"] - leaves["first"]).groupby("shard")["n"].sum()
    assert sizes.max() - sizes.min() <= 3


def test_quality_learns_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    judged = quality.scored(docs, quality.fit_quality(docs, labels), "p").join(labels, "doc_id")
    found = judged.filter(quality.fold(F.col("doc_id"), 5) == 0).select("quality", (F.col("p") >= 0.3).cast("int").alias("kept")).collect()
    assert np.mean([r.quality == r.kept for r in found]) >= 0.97


def test_chain_marginals_by_enumeration():
    import itertools

    rng = np.random.default_rng(2)
    first, scores, moves = np.array([0, 3, 4, 8]), rng.normal(0, 2, 8), rng.normal(0, 1, (2, 2))
    good, pairs, total = quality.marginals(scores, moves, first)
    want_pairs = np.zeros((2, 2))
    for k in range(3):
        a, b = first[k], first[k + 1]
        weights = {y: math.exp(sum(scores[a + i] * y[i] for i in range(b - a)) + sum(moves[y[i], y[i + 1]] for i in range(b - a - 1))) for y in itertools.product((0, 1), repeat=b - a)}
        z = sum(weights.values())
        assert total[k] == pytest.approx(math.log(z))
        for i in range(b - a):
            assert good[a + i] == pytest.approx(sum(w for y, w in weights.items() if y[i]) / z)
        for y, w in weights.items():
            for i in range(b - a - 1):
                want_pairs[y[i], y[i + 1]] += w / z
    assert np.allclose(pairs, want_pairs)


def test_quality_of_odd_rows(docs, spark):
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(100)] + [(1, None, 0), (2, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(docs, labels)
    out = quality.scored(docs, model, "p")
    assert out.count() == docs.count() and out.filter("p is null or p < 0 or p > 1 or isnan(p)").isEmpty()
    assert quality.good_documents(docs, labels).columns == docs.columns
    assert quality.fit_quality(docs, labels.filter("quality = 1")).slope == 0.0


def test_context_tree_weighting(docs, spark):
    some = docs.filter("doc_id < 25 or doc_id > 900000 or doc_id is null").filter("doc_id is null or doc_id <> 900013")
    held = F.coalesce(quality.fold(F.col("doc_id"), 7) == 2, F.lit(False))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in ctw.scores(some, held).collect())
    depth, counts, bits = ctw.DEPTH, collections.Counter(), collections.defaultdict(lambda: [0, 0])

    def steps(w):
        s = b"\n" * depth + b"".join(x.encode() + b" " for x in w) + b"\n"
        for i in range(depth, len(s)):
            node = 1
            for k in range(8):
                bit = s[i] >> (7 - k) & 1
                yield s[i - depth : i], node, bit
                node = 2 * node + bit

    texts = [(r.doc_id, words(lower(r.text))) for r in some.select("doc_id", "text").collect()]
    out = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in texts}
    for d, w in texts:
        if not out[d]:
            counts.update([*w, "\n"])
            for context, node, bit in steps(w):
                for k in range(depth + 1):
                    bits[context[depth - k :], node][bit] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    weighted, below = {}, collections.defaultdict(float)
    for k in range(depth, -1, -1):
        for (context, node), (a, b) in [x for x in bits.items() if len(x[0][0]) == k]:
            own = kt(a, b) if k == depth else math.log(0.5) + np.logaddexp(kt(a, b), below[context, node])
            weighted[context, node] = own
            if k:
                below[context[1:], node] += own

    def probability(context, node, bit):
        p, rest = 0.0, 1.0
        for k in range(depth + 1):
            at = context[depth - k :], node
            n = bits.get(at, (0, 0))
            stop = 1.0 if k == depth else math.exp(kt(*n) + math.log(0.5) - weighted[at]) if at in weighted else 0.5
            p, rest = p + rest * stop * (n[bit] + 0.5) / (sum(n) + 1), rest * (1 - stop)
        return p

    total, kinds = sum(counts.values()), len(counts)
    want = []
    for d, w in texts:
        tokens = [*w, "\n"]
        base = sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in tokens)
        want.append((-1 if d is None else d, out[d], len(tokens), sum(counts[x] > 0 for x in tokens), total, base, sum(math.log10(probability(*s)) for s in steps(w))))
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("apply", [
    lambda d: packing.pack(d, CODER), host_rules.host_rules, simhash.simhash_components, simhash.near_duplicates, substrings.cut_documents,
    substrings.without_repeats, mixing.taken_words, mixing.mixed, lambda d: ctw.scores(d, F.lit(False)),
    lambda d: quality.good_documents(d, d.selectExpr("doc_id", "1 AS quality")),
])
def test_empty_table(empty, apply):
    assert apply(empty).collect() == []


def test_repeated_words_and_passages_compact(spark):
    """Runs of equal k-mers make few arcs; a passage that many documents hold is one row in each."""
    from noticelake.llm.tables import Scratch
    from noticelake.llm.text import Words, buffers

    import pyarrow as pa

    rng = np.random.default_rng(21)
    draw = lambda n: [f"v{x}" for x in rng.integers(0, 10**6, n)]
    passage, line = draw(400), draw(20)
    texts = [[*draw(int(rng.integers(0, 60))), *passage, *draw(int(rng.integers(0, 60)))] for _ in range(12)]
    texts += [["spam"] * n for n in (49, 50, 51, 300, 700)] + [["spam", "egg"] * 200, ["egg", "spam"] * 150, [*line * 9], [*draw(5), *line * 12, *draw(70)]]
    texts += [[*passage[:200], *draw(30), *passage[100:]], [*passage[50:120], *draw(3), *passage[50:120]]]
    texts = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    first = {}
    for d, t in texts:
        for i in range(len(words(t)) - 49):
            key = tuple(words(t)[i : i + 50])
            first[key] = min(first.get(key, d), d)
    want = {}
    for d, t in texts:
        w = words(t)
        want[d] = len({i + k for i in range(len(w) - 49) if first[tuple(w[i : i + 50])] < d for k in range(50)})
    assert {r.doc_id: r.n_removed for r in substrings.cut_documents(docs).collect()} == want
    data, offsets = buffers(pa.array(["spam " * 700]))
    assert len(substrings.arcs_of(Words(data, offsets))[0]) <= 20
    scratch = Scratch()
    from functools import partial

    arcs = substrings._keyed(docs.filter("doc_id < 12")).mapInArrow(partial(substrings._arc_rows, window=50, kmer=16), substrings.ARCS)
    edges = arcs.groupBy("edge").agg((F.min("arc") < F.max("arc")).alias("branches"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b")
    hits = scratch.stored(arcs.join(edges.select("edge", "branches"), "edge"))
    nodes, paths = substrings.compacted(hits, scratch)
    shared = hits.groupBy("arc").agg(F.countDistinct("doc_id").alias("n")).filter("n = 12").count()
    assert shared > 10 and paths.filter("n > 250").count() == 1 and paths.count() < 5
    scratch.drop()
