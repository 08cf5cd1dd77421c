import pytest
from llm_rows import ODD


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with other columns whose names clash, all NULL; ``doc_id`` and ``text`` are the real ones."""
    schema = "doc_id long, text string, id long, fp long, key string, n long, keep string, row string, digest string, block long, lang string, source string, n_chars long, score double, label int"
    rows = [(i, t, None, 7, None, None, None, None, None, None, "en", "s", len(t or ""), None, None) for i, t in ODD]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(texts):
        rows = [(i, t) for i, t in texts] if texts and isinstance(texts[0], tuple) else list(enumerate(texts))
        return spark.createDataFrame(rows, "doc_id long, text string")

    return make
