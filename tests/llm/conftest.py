import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    from cartograph.llm import common
    common.prepare(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text) of the smallest test table."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def edge_texts():
    """Null, empty, blank, short, odd and very long texts, ties and repeated rows."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three"), (6, "Ünï 日本語 ẞ don't 😀 <|endoftext|> x"),
            (7, long), (8, long), (8, long), (9, "a" * 50_000), (10, "one"), (None, "no id"), (11, "a\x1fb\x85c\xa0d \x0b e")]


@pytest.fixture(scope="session")
def edges(spark):
    """The edge texts with nulls in every column and further columns whose names clash."""
    rows = [(i, t, None, None, None, 1, "x", 2.0, None) for i, t in edge_texts()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "block int, copy string, node double, spans string").repartition(3)


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.where("doc_id < -5")
