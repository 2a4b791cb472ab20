import pytest
from pyspark.sql import functions as F

from tests_support import CLASHING


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) rows, with columns whose names the operators use inside."""

    def make(rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        extra = {n: F.lit(n) for n in CLASHING}
        return docs.withColumns(extra)

    return make
