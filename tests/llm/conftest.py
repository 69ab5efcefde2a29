import os

import pytest

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    return SF


@pytest.fixture()
def documents(spark):
    """(rows) -> documents with nulls allowed everywhere and two clashing extra columns."""

    def build(rows, extra=True):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        df = spark.createDataFrame(rows, schema)
        return df.selectExpr("*", "1 as score", "'x' as size") if extra else df

    return build
