"""Small helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

#: Bytes of a batch that a Python function works on at a time.
SLICE_BYTES = 4 << 20

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator works on, as ``doc_id`` and ``text`` (null: empty).

    Every other column stays behind, so none can clash with an operator's own.
    """
    return docs.select(
        docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    )


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType
) -> DataFrame:
    """Run ``fn`` over Arrow batches, cut so that each holds about ``SLICE_BYTES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                out = fn(batch.slice(at, step))
                if out is not None:
                    yield out

    return df.mapInArrow(run, schema)


#: Rows up to which a table of short keys is sent to every task (16 MB of digests).
BROADCAST_KEYS = 1_000_000


def shielded(docs: DataFrame, *own: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with every column but ``own`` under a name that no operator uses, and how to get the
    old names (and these columns alone) back."""
    names = docs.columns
    mark = uuid.uuid4().hex
    safe = [n if n in own else f"_{i}_{mark}" for i, n in enumerate(names)]
    return docs.toDF(*safe), lambda df: df.select(*safe).toDF(*names)


def with_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` as they are, and their ``content_key``."""
    return docs.withColumn("key", content_key(docs[id_col], F.coalesce(docs[text_col], F.lit(""))))


def content_key(doc_id, text) -> F.Column:
    """Digest of a row's ID and text: names a document where IDs may be null or repeat."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\x00"), text)
    return F.unhex(F.md5(name.cast("binary")))


def keep_matching(rows: DataFrame, keys: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """Rows whose ``on`` is among the ``keys``, or with ``left_anti`` those whose is not.

    A set counted to be small is broadcast; a larger one is joined by a shuffle.
    """
    keys = keys.select(on).distinct()
    if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return rows.join(keys, on, how)


#: Rows up to which a counted table of words or rules is sent to every task.
BROADCAST_ROWS = 200_000


def join_counted(rows: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` with a table that is usually small: broadcast if its rows are
    counted to be few, else left to a shuffle."""
    if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    return rows.join(small, on, how)


def one_row_each(rows: DataFrame, key: str = "key") -> DataFrame:
    """``rows`` with one of those that share a ``key``: only these are shuffled."""
    repeated = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key)
    few = repeated.limit(BROADCAST_KEYS + 1).count()
    if not few:
        return rows
    if few <= BROADCAST_KEYS:
        repeated = F.broadcast(repeated)
    return rows.join(repeated, key, "left_anti").union(rows.join(repeated, key, "left_semi").dropDuplicates([key]))


#: Keys that more rows than one in so many have are hot; there are no more of them than this.
HOT_KEYS = 100_000
#: Rows of a key that one task takes in any case.
KEY_ROWS = 1_000


def join_split(rows: DataFrame, table: DataFrame, on: str | list[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """Join ``rows``, ``total`` at most, with a ``table`` of one row a key, whose ``size`` says how many rows have it.

    Hot keys are so few that their part of the table can be sent to every task, so their rows stay where
    they are; only the others are shuffled, and none of these keys has many rows. ``how`` is inner or left.
    """
    on = [on] if isinstance(on, str) else on
    many = max(KEY_ROWS, total // HOT_KEYS)
    names = [c for c in table.columns if c not in on]
    marked = rows.join(F.broadcast(table.where(F.col(size) > many)), on, "left")
    rest = marked.where(F.col(size).isNull()).drop(*names).join(table.where(F.col(size) <= many), on, how)
    return marked.where(F.col(size).isNotNull()).unionByName(rest)
