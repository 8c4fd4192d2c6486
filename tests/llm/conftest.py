import pytest

from muniscope.llm.common import ship

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def corpus(spark):
    """The smallest documents in Spark and as sorted (doc_id, text) pairs."""
    docs = ship(spark).read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    return docs, rows


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names the operators use themselves."""
    ship(spark)
    long = "the cat sat on the mat and then it ran. " * 400
    rows = [
        (1, "one two three", "a", 1), (2, None, None, None), (3, "", "b", 2), (None, "no id here at all", "c", 3), (4, "12 34 !!", None, 4),
        (5, long, "a", 5), (5, long, "a", 5), (6, long, "b", None), (7, "x", "a", 7), (8, "straße café\nzwei\ndrei\nvier " + "ü" * 130, "a", 8),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n long").selectExpr(
        "*", "n AS bucket", "n AS part", "source AS lang", "n AS tie", "n AS doc", "source AS rest", "n AS start", "source AS spans", "n AS n_words",
        "n AS shard", "source AS fingerprint", "n AS score", "source AS lang_pred", "n AS n_lines", "n AS registers", "n AS length", "n AS rank", "n AS __id",
    )
