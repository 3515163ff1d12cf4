import pytest

from threadmill.llm.common import prepare

DOC = "doc_id long, text string, lang string, source string"


@pytest.fixture(autouse=True)
def settings(spark):
    prepare(spark)


@pytest.fixture
def docs_of(spark):
    """docs_of(texts) -> documents numbered from 0; docs_of(rows=...) -> given rows."""

    def make(texts=None, rows=None):
        rows = rows if rows is not None else [(i, t, "en", f"s{i % 3}") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOC).repartition(3)

    return make
