"""Logical inputs of the pipeline, read from the star schema and the text tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.functions import dates

#: Rows of facts that a task sums, about.
IN_TASK = 500_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where it comes from fewer files than there are cores, and from fewer splits that hold rows.

    Only footers are read to tell that: a table of few large files is left as it is read where their row groups are enough
    for all cores, like one of many files. Nothing is shuffled then.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if not 0 < len(df.inputFiles()) < cores:
        return df
    enough = df.rdd.getNumPartitions() >= cores and df.select(F.spark_partition_id().alias("split")).distinct().count() >= cores
    return df if enough else df.repartition(cores)


def tasks_for(df: DataFrame) -> int:
    """Into how many partitions a table is dealt so that each holds about IN_TASK rows, and every core has one."""
    return max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / IN_TASK))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df by keys, in as many partitions as its rows ask for: neither a split nor a fixed number of partitions sets their size."""
    return df.repartition(tasks_for(df), *keys)


def weekly_keywords(spark: SparkSession, folder: str) -> DataFrame:
    """(week, keyword, source, count): quantities shipped, by ISO week, part name and brand, and supplier.

    Facts are summed by key before they meet the names, so the shuffle carries four numbers. Few of them share a key: they
    are dealt first, into as many partitions as their number asks for, and summed there. A task that summed what it reads
    would hold nearly all of a file's split, and a fixed number of partitions would grow with the table. Sums by name are
    dealt as well, as names may differ as much as keys.
    """
    lines = table(spark, folder, "lineitem")
    n = tasks_for(lines)
    keys = ["monday", "l_partkey", "l_suppkey"]
    rows = lines.select(F.trunc(F.col("l_shipdate").cast("date"), "week").alias("monday"), "l_partkey", "l_suppkey", "l_quantity").repartition(n, *keys)
    sums = rows.groupBy(*keys).agg(F.sum("l_quantity").alias("quantity"))
    parts = table(spark, folder, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand").alias("keyword")).repartition(n, "p_partkey")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", F.col("s_name").alias("source")).repartition(n, "s_suppkey")
    named = sums.join(parts, sums.l_partkey == parts.p_partkey).join(suppliers, sums.l_suppkey == suppliers.s_suppkey)
    named = named.select("monday", "keyword", "source", "quantity").repartition(n, "monday", "keyword", "source")
    counted = named.groupBy("monday", "keyword", "source").agg(F.sum("quantity").cast("int").alias("count"))
    return counted.select(dates.iso_week(F.col("monday")).alias("week"), "keyword", "source", "count")


def articles(spark: SparkSession, folder: str, spread_out: bool = True) -> DataFrame:
    """Documents as dated articles: id, date (YYYYMMDD), week, press, title (first line), body; over all cores, or as they lie."""
    docs = table(spark, folder, "documents")
    docs = spread(docs) if spread_out else docs
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 70).cast("int"))
    return docs.select(F.col("doc_id").alias("news_id"), F.date_format(day, "yyyyMMdd").alias("date"), dates.iso_week(day).alias("week"), F.col("source").alias("press"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), F.col("text").alias("body"))
