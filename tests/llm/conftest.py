import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (900001, None, "en", None, 0), (900002, "", "en", "src1", 0), (900003, " \n\t ", None, "src1", None), (900004, "a", "en", "only", 1),
    (900005, "A b", "en", "only", 3), (900006, "a\tb\n\nc  d ", "fr", None, 9), (900007, "日本語 テスト。 x\u3000y", "ja", "src2", 9),
    (900008, " ".join(f"w{i}" for i in range(70)), "en", "src2", 0), (900009, "\n".join(f"w{i}" for i in range(3, 80)), "en", "src2", 0),
    (900010, "x " * 60, "en", "src3", 0), (900011, "x " * 60, "en", "src3", 0), (900012, "it's  don't\t\t<|endoftext|> 12!! ..", "en", "src3", 0),
    (900013, " ".join(f"long{i % 977}" for i in range(30_000)), "en", "src0", 0), (None, " ".join(f"w{i}" for i in range(70)), "en", "src0", 0),
    (900014, "twice the same row", "en", "src0", 0), (900014, "twice the same row", "en", "src0", 0),
]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="session")
def docs(spark):
    """Some documents, odd ones, and columns whose names the operators use themselves."""
    some = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("doc_id < 120")
    odd = spark.createDataFrame(ODD, some.schema)
    both = some.unionByName(odd)
    return both.selectExpr("*", "'x' AS fp", "'y' AS size", "'z' AS score", "1 AS block", "2 AS src", "'q' AS _row", "3 AS los", "'k' AS text_key", "'h' AS host").cache()


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.collect()]


@pytest.fixture(scope="session")
def empty(docs):
    return docs.filter("false")
