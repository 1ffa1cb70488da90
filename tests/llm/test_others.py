"""Operators on pages and embeddings against brute force, the queries' contracts, and the pipeline."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticelake.llm import extraction, queries, topk, url_filter
from noticelake.llm.html_blocks import blocks

URLS = [
    "http://A.COM/x", None, "nothing", "http://x.example.com/en/a", "http://www.example.com/en/", "http://example.com/en", "http://net/fr/q?x://b.com/", "ftp://b.net/fr",
    "http://q.org", "https://com/?a", "http://héé.org/ü/１", "http://notcom/", "//a://b/c", "http://q.org/" + "long/" * 3000, "http://a.com/en/1", "http://a.com/en/1",
]


def test_url_verdicts(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url")
    pages = pages.union(spark.createDataFrame([(10**6 + i, u) for i, u in enumerate(URLS)], "page_id long, url string")).withColumn("s", F.lit("clash")).withColumn("host", F.lit(1))
    got = {r.page_id: r for r in url_filter.judge(pages, queries.URL_RULES).collect()}
    parsed = {}
    for page, url in pages.select("page_id", "url").collect():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
        fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        parsed[page] = host, path, max(fits, key=lambda r: len(r.host + r.path), default=None)
    k = url_filter.ORDER
    string = lambda host, path: "\2" * k + re.sub("[0-9]", "0", host + path.lower()) + "\3"

    def model(verdict):
        counts = collections.defaultdict(collections.Counter)
        for host, path, rule in parsed.values():
            if rule and rule.verdict == verdict:
                s = string(host, path)
                for i in range(k, len(s)):
                    for n in range(k + 1):
                        counts[s[i - n : i]][s[i]] += 1
        return counts

    def gain(counts, context, char):
        p = 1 / url_filter.ALPHABET
        for n in range(k + 1):
            if seen := counts.get(context[k - n :]):
                p = (seen[char] + len(seen) * p) / (sum(seen.values()) + len(seen))
        return math.log(p)

    good, bad = model("allow"), model("block")
    assert set(got) == set(parsed)
    scores = []
    for page, (host, path, rule) in parsed.items():
        r = got[page]
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.host + rule.path)
        if rule:
            assert r.verdict == rule.verdict and r.score is None
        else:
            s = string(host, path)
            want = np.mean([gain(good, s[i - k : i], s[i]) - gain(bad, s[i - k : i], s[i]) for i in range(k, len(s))])
            assert r.score == pytest.approx(want, abs=1e-6)
            scores.append((r.score, r.verdict))
    assert max((s for s, v in scores if v == "block"), default=-9) < min(s for s, v in scores if v == "allow")
    assert url_filter.judge(pages.filter("false"), queries.URL_RULES).collect() == []


def test_top_k(spark):
    rng = np.random.default_rng(4)
    vectors = [[float(x) for x in rng.normal(0, 0.2, 8)] for _ in range(300)]
    rows = [(i, vectors[i % 290]) for i in range(300)] + [(400, None), (420, [None] * 8), (440, [float("nan")] * 8), (460, [float("inf")] + [0.0] * 7), (480, [1.5, -2.0]), (500, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit("clash"))
    got = topk.top_k(topk.quantized(table, 64), F.col("vec_id") % 20 == 0, k=7, pivots=4).collect()
    whole = {i: np.pad(np.floor(64 * np.array(v, np.float32).astype(float)).astype(int), (0, 8 - len(v))) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in whole if i % 20 == 0):
        near = sorted((-int(whole[q] @ whole[x]), x) for x in whole if x != q)[:7]
        want += [(q, k + 1, x, -s) for k, (s, x) in enumerate(near)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.top_k(topk.quantized(table.filter("false"), 64), F.col("vec_id") % 20 == 0).collect() == []


def test_pivots_spare_products():
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 40, (20, 8))
    x = (centres[rng.integers(0, 20, 6000)] + rng.normal(0, 2, (6000, 8))).astype(np.int64)
    top = int((x**2).sum(1).max())
    found, evaluated = topk.best(x[:40], np.arange(40), x, np.arange(6000), topk.spread_pivots(x[:500], 16), top, 10)
    assert evaluated < 0.9 * 40 * 6000
    for q, ids, scores in found:
        near = sorted((-int(x[q] @ x[i]), i) for i in range(6000) if i != q)[:10]
        assert [(-s, i) for s, i in near] == list(zip(scores.tolist(), ids.tolist(), strict=True))


def test_blocks():
    page = blocks("<p>a <b>b&amp;<br>c<p>d&nbsp;  e<ul><li>f<li><a href='x>y'>g</a> h</ul><script>'<p>no'</script><style>p</style><!-- <p>no -->i<title>t &lt;</title><textarea><p></textarea>j</div>")
    assert [b.text for b in page] == ["a b& c", "d e", "f", "g h", "i", "t <", "<p>", "j"]
    assert page[3].linked == 1 and page[1].path == ("p",) and page[2].path == ("ul", "li")
    assert [b.text for b in blocks("<p>a<b>c</p>d < e <x")] == ["ac", "d < e"]
    assert blocks("") == [] and blocks("<script>never closed <p>x") == []


def test_gradients():
    rng = np.random.default_rng(1)
    net = extraction.Labeller.fresh(rng)
    x, first, y = rng.normal(0, 1, (7, extraction.INPUT)), np.array([0, 3, 3, 7]), rng.integers(0, 2, 7)
    loss = lambda: float(np.sum(np.logaddexp(0, (s := net.run(x, first)[0])) - y * s))
    scores, kept = net.run(x, first)
    grads = net.gradient(x, 1 / (1 + np.exp(-scores)) - y, kept)
    for w, g in zip(net.weights, grads, strict=True):
        at = tuple(rng.integers(0, n) for n in w.shape)
        w[at] += 1e-5
        up = loss()
        w[at] -= 2e-5
        down = loss()
        w[at] += 1e-5
        assert g[at] == pytest.approx((up - down) / 2e-5, abs=1e-5)


def test_main_text(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    odd = "<html><body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class='cookie-notice'>We use cookies here.</div><article><h1>News of today</h1><p>First part &amp; more of it.<p>Second part.<aside class=related>Related: x</aside></article><section class=comments><p>I like it.</p></section><footer>&copy; us</footer>"
    rows = pages.select("page_id", "url", "html").union(spark.createDataFrame([(10**6, None, None), (10**6 + 1, "u", ""), (10**6 + 2, "v", odd)], "page_id long, url string, html string")).withColumn("text", F.lit(0))
    got = {r.page_id: r for r in extraction.main_text(rows, extraction.fit_labeller(rows, sample=40)).collect()}
    assert got[10**6].text == "" and got[10**6 + 1].n_chars == 0
    assert got[10**6 + 2].text == "News of today\n\nFirst part & more of it.\n\nSecond part."
    right = 0
    for r in rows.filter("page_id < 1000000").collect():
        inside = "\n\n".join(b.text for b in blocks(r.html) if "article" in b.path)
        right += got[r.page_id].text == inside
        assert got[r.page_id].n_chars == len(got[r.page_id].text)
    assert right >= 0.98 * pages.count()
    assert extraction.main_text(rows.filter("false"), extraction.train([], made=20, epochs=1)).collect() == []


def test_queries_have_their_columns(spark):
    sf = "/root/testdata/sf0.001"
    want = {
        "op2_quality": {"doc_id", "held_out", "score", "predicted"}, "op4_pivot_top_k": {"query_id", "rank", "vec_id", "score"}, "op5_mixing": {"doc_id", "size", "source_size", "target", "taken"},
        "op7_simhash": {"doc_id", "fingerprint", "component_id"}, "op9_url_filter": {"page_id", "host", "path", "rule", "verdict"},
    }
    for name, columns in want.items():
        assert columns <= set(queries.QUERIES[name](spark, sf).columns)


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]
    packed = corpus_pipeline.run(spark, sf)
    ends = packed.filter("start + length = doc_tokens").count()
    assert ends == sizes[4]
