"""Small frames for the operators' edge cases."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(i: int, n: int = 120) -> str:
    words = "alder brook cedar delta ember field grove harbor island juniper kettle lantern meadow north orchard pebble".split()
    return " ".join(words[(i * 7 + k * (i + 3) + k * k) % len(words)] + ("." if k % 9 == 8 else "") for k in range(n))


def edge_rows():
    """Nulls in every column, empty and blank texts, repeated rows, a very long text, odd characters."""
    rows = [(i, prose(i, 60 + i), ("en", "xx")[i % 2], f"s{i % 4}", 1) for i in range(24)]
    rows += [(100, None, "en", "s1", None), (101, "", "en", "s1", 0), (102, " \t\n\x0b\x0c\r ", None, None, 3), (None, prose(3), "en", None, 1),
             (103, prose(5, 65), None, "s9", 1), (103, prose(5, 65), None, "s9", 1), (104, prose(5, 65), "xx", "s9", 1),
             (105, "x", "en", "s2", 1), (106, "12 34 ... !!", "en", "s2", 1), (107, prose(9, 30_000), "en", "s3", 1),
             (108, "é ü 中文 🙂 \x1f \x85", "xx", "é", 1), (109, "same same same same same same", "en", "s1", 1)]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(docs):
    """The edge rows with further columns named like outputs and working columns."""
    from pyspark.sql import functions as F

    names = ("kept", "score", "fingerprint", "component_id", "spans", "size", "start", "rule", "labels", "sid", "rejected",
             "__llm_row", "n_words", "row", "block", "of", "node", "h", "shard")
    return docs.withColumns({n: F.lit("clash") for n in names})
