import pytest


@pytest.fixture()
def docs(spark):
    """Documents with every odd case: nulls, empty and long texts, repeated rows and clashing column names."""

    def make(rows):
        full = [(i, t, "en", s, None if t is None else len(t), "x", 1) for i, t, s in rows]
        return spark.createDataFrame(
            full,
            "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, node int",
        )

    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
