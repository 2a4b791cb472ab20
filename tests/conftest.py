import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_annotated(spark):
    """Annotated rows from ``{doc_id: (text, [(set, type, start, end, features)])}``."""
    from pyspark.sql import types as T

    from annoflow.model import ANNOTATIONS, DOCUMENT

    schema = T.StructType(
        list(DOCUMENT.fields)
        + [
            T.StructField("annotations", ANNOTATIONS),
            T.StructField("execution_ms", T.LongType()),
            T.StructField("error", T.StringType()),
        ]
    )

    def make(docs, features=None):
        rows = [
            (
                doc_id, {}, text, (features or {}).get(doc_id, {}), None, "UTF-8",
                len(text.encode()), len(text), None,
                [(s, i, t, b, e, f) for i, (s, t, b, e, f) in enumerate(anns)], 5, None,
            )
            for doc_id, (text, anns) in docs.items()
        ]
        return spark.createDataFrame(rows, schema)

    return make
