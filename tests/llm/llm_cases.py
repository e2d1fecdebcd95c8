"""Cases and fixtures that the tests of this folder share."""

import pytest

SF = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i} and{i % 7}" for i in range(20_000))

#: Null ids and texts, empty and very long texts, repeated rows, tied ids.
EDGE_ROWS = [
    (1, "one two three four five six seven"),
    (1, "one two three four five six seven"),
    (2, None), (3, ""), (None, "one two three four five six seven"), (None, None),
    (4, LONG), (5, LONG), (6, " \n\t\n "), (7, "short"), (7, "another text with one id more than once here"),
    (8, "üß ñandú 漢字 😀 \x00 end"), (9, "½ ² ① Ⅳ 12_"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Edge rows with columns whose names clash with what operators add."""
    rows = [(i, t, "en", "s", len(t or ""), 9, 9, 9, 9, 9) for i, t in EDGE_ROWS]
    schema = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
              "score int, spans int, uid int, gone_id int, text_key int")
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
