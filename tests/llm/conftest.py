import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """Documents from (doc_id, text) pairs, with columns whose names clash with results."""
        full = [(i, t, None, "s", None, 7, "x", 3) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA + ", length int, score string, node int")

    return make


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
