import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from (id, text) rows, with the other columns null."""
    def make(rows, extra=""):
        columns = DOC + extra
        blank = (None,) * (columns.count(",") - 1)
        return spark.createDataFrame([(*r, *blank) for r in rows], columns)
    return make
