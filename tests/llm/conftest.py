import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Makes a documents table, with a further column whose name clashes with results."""

    def make(*rows):
        full = [(*row, *(None,) * (4 - len(row))) for row in rows]
        return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None, "x") for r in full], COLUMNS + ", score string").coalesce(2)

    return make


@pytest.fixture(scope="session")
def sample():
    return "/root/testdata/sf0.001"
