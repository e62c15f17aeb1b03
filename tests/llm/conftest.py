import pytest


@pytest.fixture
def documents(spark):
    """A frame (doc_id, text) of the given pairs; numbers count up where only texts are given."""
    def make(rows, kinds="doc_id long, text string"):
        rows = list(rows)
        if rows and not isinstance(rows[0], tuple):
            rows = list(enumerate(rows))
        return spark.createDataFrame(rows, kinds)
    return make
