import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept string, row string, key string"


@pytest.fixture
def docs_of(spark):
    """Documents with columns whose names clash with those of the operators."""

    def make(rows):
        full = [(i, t, None, "s", None, "mine", "r", "k") for i, t in rows]
        return spark.createDataFrame(full, COLUMNS).repartition(3)

    return make


@pytest.fixture
def pages_of(spark):
    def make(rows):
        return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)

    return make


LONG = " ".join(f"w{i % 977} z{i % 13}" for i in range(40_000))
