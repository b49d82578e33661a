import pytest

from eventlake.llm.common import importable

@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture
def docs(spark):
    """Builds documents from (doc_id, text, source), with columns that operators use inside."""

    def build(rows):
        rows = [(k, t, "en", s, len(t or ""), "x", 1) for k, t, s in rows]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, key string, fp int"
        )

    return build
