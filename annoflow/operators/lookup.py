"""Joining IDs to a table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """The document of every ID; an ID without one carries a ``load_error``.

    Attributes come from the ID. The documents are scanned once: a semi join keeps those that are asked for (a
    small set of IDs is broadcast to the scan), and an outer join from the IDs, by the same key and so without another
    shuffle of the documents, gives found and missing ones alike. An ID that is asked for very often is split by AQE.
    """
    wanted = ids.select("doc_id", "id_attrs")
    asked = docs.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    met = wanted.join(asked.drop("id_attrs").withColumn("_there", F.lit(True)), "doc_id", "left")
    error = F.concat(F.lit("Unknown document "), F.col("doc_id"))
    problem = F.when(F.col("_there").isNull(), error).otherwise(F.col("load_error"))
    return met.withColumn("load_error", problem).select(docs.columns)
