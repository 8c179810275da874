"""A bounded sample of labelled documents for the classifiers that learn from `labels`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm import common


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """doc_id, text and y (0 or 1) of about `most` labelled documents that aren't held out.

    Only ids and labels are shuffled or sent; their number is bounded by `most`, whatever the tables' size. An id that
    several labels speak of has the largest one. What is collected of the rows is bounded by common.bounded().
    """
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    y = y.where(F.col("y").isin(0, 1) & (common.fold("doc_id") != 0))
    rows = y.agg(F.count("*")).first()[0]
    y = y.where(common.drawn(rows, most, "doc_id")).groupBy("doc_id").agg(F.max("y").alias("y"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(y), "doc_id")
