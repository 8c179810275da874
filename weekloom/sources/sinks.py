"""Writers with the reference's update rules over Parquet folders: replace by week, upsert, insert-ignore, export."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def replace_partitions(df: DataFrame, path: str, *keys: str) -> None:
    """Replaces the partitions that df has rows for and leaves the others: a week that is run again is idempotent."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*(keys or ("week",))).parquet(path)


def upserted(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """old with new's rows put in by key; of several new rows with a key, the one with the largest `order` stays."""
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    fresh = new.withColumn("_nth", last).where("_nth = 1").drop("_nth")
    return old.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)


def inserted(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """old with those rows of new whose key it lacks, the first by `order` of each key."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    fresh = new.withColumn("_nth", first).where("_nth = 1").drop("_nth")
    return old.unionByName(fresh.join(old.select(*keys), keys, "left_anti"))


def without(old: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return old.join(gone.select(*keys).distinct(), keys, "left_anti")


def replaced_range(old: DataFrame, new: DataFrame, meta: DataFrame, low: str, high: str) -> tuple[DataFrame, DataFrame]:
    """Members with those of a range of weeks replaced by new ones, and the metas of threads that had no member there."""
    inside = F.col("week").between(low, high)
    return old.where(~inside).unionByName(new), without(meta, old.where(inside), ["thread_id"])


def without_nan(df: DataFrame) -> DataFrame:
    """df with null for every double that isn't a number."""
    doubles = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles})


def write_new_version(df: DataFrame, path: str, version: int) -> str:
    """A full result as a new folder, so that readers of the old one never see it half written."""
    out = f"{path}/v{version:06d}"
    df.write.parquet(out)
    return out


def export(df: DataFrame, path: str, step: str, kind: str = "csv", most_rows: int = 200_000, sample: int = 200) -> dict:
    """Writes df as CSV or JSON lines, or only a sample of it where it has too many rows, and a manifest beside it."""
    n = df.count()
    compact = n > most_rows
    shown = df.limit(sample) if compact else df
    getattr(shown.write.mode("overwrite").option("header", True), kind)(f"{path}/data")
    manifest = {"step": step, "rows": n, "columns": df.columns, "compact": compact}
    df.sparkSession.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")
    return manifest


def new_files(spark: SparkSession, path: str, known: DataFrame) -> DataFrame:
    """(source_file, checksum) of the files under a path whose contents are not among `known`. Files are hashed where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("path").alias("source_file"), F.sha2("content", 256).alias("checksum"))
    return files.join(known.select("source_file", "checksum"), ["source_file", "checksum"], "left_anti")


def stable_id(*columns: str) -> Column:
    """A deterministic id of a row from its own fields."""
    return F.sha2(F.concat_ws("||", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), 256)
