import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text, source) tuples, or fewer fields,
    with a column that clashes with names the operators use inside."""

    def make(rows, extra=True):
        full = [(*r, *[None] * (3 - len(r)), "x") for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, source string, text_key string")
        return df if extra else df.drop("text_key")

    return make
