"""Mixes whose quota ends in a block of long documents or among blocks without words."""

import collections

import pytest

from noticelake.llm import mixing


def missed(spark, sizes, **options):
    """By source: target less taken words."""
    table = spark.createDataFrame(sizes, "doc_id long, source string, size long")
    out = collections.defaultdict(int)
    target = {}
    for r in mixing.Mix(table, **options).copies(table).collect():
        out[r.source] += r.size * r.n_taken
        target[r.source] = r.target
        assert 0 <= r.n_taken
    return {s: target[s] - n for s, n in out.items()}


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_later_blocks_fill_the_room_before_a_long_document(spark, seed):
    rows = [(i, "a", 100) for i in range(2500)] + [(2500, "a", 200_000), (2501, "b", 450_000)]
    for weights in ((1, 1), (2, 1), (3, 4), (1, 5)):
        for source, miss in missed(spark, rows, weights=weights, most=1, seed=seed).items():
            assert source == "b" or abs(miss) <= 50


def test_blocks_without_words_leave_their_places(spark):
    rows = [(i, "a", 1000 if i % 101 == 0 else 0) for i in range(10_000)] + [(10_000, "b", 300_000)]
    for weights in ((1, 5), (1, 9)):
        assert abs(missed(spark, rows, weights=weights, most=1)["a"]) <= 500
