"""Exact running totals over any number of rows, without a single-task window.

Rows are put in order by a range shuffle whose key ends in a tie-breaker, so
even a group, or one repeated key, that holds a third of all rows is spread over
many tasks. Each task keeps a running total of its own rows. What a task must
add for the rows before it is at most one number per task (only the group that
straddles its left edge has any), so that table is broadcast whatever the size
of the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.column import Column

from annoflow.session import written


def with_running_total(
    df: DataFrame,
    value: Column,
    name: str,
    *,
    order_by: Sequence[str | Column] | None = None,
    group_by: str | None = None,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows before this one.

    With ``group_by`` (a column without nulls) totals start again in each group.
    Without ``order_by`` rows count in the order they are stored, which costs no
    shuffle but can be used only without groups. The rows are written to scratch
    space once, because sampled range bounds may differ between two runs.
    """
    if group_by is not None and order_by is None:
        raise ValueError("grouped totals need an order")
    rows = df.withColumn("_value", value.cast("long"))
    if order_by is not None:
        keys = [F.col(group_by)] if group_by else []
        keys += [F.col(c) if isinstance(c, str) else c for c in order_by]
        rows = rows.withColumn("_tie", F.monotonically_increasing_id())
        keys.append(F.col("_tie"))
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")

    schema = T.StructType(
        [f for f in rows.schema.fields]
        + [T.StructField("_part", T.IntegerType()), T.StructField("_within", T.LongType())]
    )
    counted = written(rows.mapInArrow(_totals_within_task(group_by), schema), "running-total")

    carried = _carried_by_group(counted, group_by) if group_by else _carried(counted)
    keys = ["_part", group_by] if group_by else ["_part"]
    return (
        counted.join(F.broadcast(carried), keys, "left")
        .withColumn(name, F.col("_within") + F.coalesce("_carry", F.lit(0)))
        .select(*df.columns, name)
    )


def _carried(counted: DataFrame) -> DataFrame:
    """Per task, the total of all tasks before it: one number per task."""
    totals = counted.groupBy("_part").agg(F.sum("_value")).collect()
    rows, total = [], 0
    for part, value in sorted(totals):
        rows.append((part, total))
        total += value
    return counted.sparkSession.createDataFrame(rows, "_part int, _carry long")


def _carried_by_group(counted: DataFrame, group_by: str) -> DataFrame:
    """Per task, the total before it of the one group that straddles its edge.

    The window sees one row per task and group, the result has at most one row
    per task.
    """
    earlier = (
        Window.partitionBy(group_by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        counted.groupBy("_part", group_by)
        .agg(F.sum("_value").alias("_total"))
        .withColumn("_carry", F.sum("_total").over(earlier))
        .filter("_carry <> 0")
        .select("_part", group_by, "_carry")
    )


def _totals_within_task(group_by: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        total, group = 0, None
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            value = pc.fill_null(batch.column("_value"), 0).to_numpy()
            before = np.cumsum(value) - value
            if group_by is None:
                within = before + total
                total = int(within[-1] + value[-1])
            else:
                column = batch.column(group_by)
                new = np.ones(n, dtype=bool)
                changed = pc.not_equal(column.slice(1), column.slice(0, n - 1))
                new[1:] = changed.to_numpy(zero_copy_only=False)
                new[0] = group is None or column[0].as_py() != group
                base = np.where(new, before, 0)
                base[0] = before[0] if new[0] else -total
                base = base[np.maximum.accumulate(np.where(new | (np.arange(n) == 0), np.arange(n), 0))]
                within = before - base
                total, group = int(within[-1] + value[-1]), column[n - 1].as_py()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(within)],
                names=[*batch.schema.names, "_part", "_within"],
            )

    return run


def with_chunk(
    df: DataFrame,
    size: Column,
    chunk_bytes: int,
    *,
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Add ``chunk``: the number of the output file each row belongs to.

    A row opens a new file once the bytes before it pass the next multiple of
    ``chunk_bytes``, so a file is larger than that by less than one row.
    """
    return with_running_total(df, size, "bytes_before", order_by=order_by).withColumn(
        "chunk", F.floor(F.col("bytes_before") / F.lit(chunk_bytes)).cast("long")
    )
