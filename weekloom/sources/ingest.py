"""Files that are loaded by content: a file is read again only if its checksum is another one, and then its rows are replaced.

The table is a folder of batches and, for each batch, a ledger of which batch holds which file, with its checksum. The
ledger is written after the rows and is the commit: a run that breaks before it leaves no trace, and a run that finds no
file new or changed writes nothing. Files are hashed and parsed where they are read; no list of them comes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom import session
from weekloom.operators.similar import few

LEDGER = "source_file string, checksum string, batch long"


class FileTable:
    """Rows of files. parse: from (source_file, content) to the rows of `schema`, source_file among them.

    `all_again` loads every file anew; `gone` drops the rows of files that are no longer there, which otherwise stay.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, parse: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.schema, self.parse = spark, path.rstrip("/"), schema, parse

    def version(self) -> int:
        """The number of the last run that was committed; -1 before the first."""
        done = [int(n) for n in session.names(self.spark, f"{self.path}/ledger") if n.isdigit() and session.exists(self.spark, f"{self.path}/ledger/{n}/_SUCCESS")]
        return max(done, default=-1)

    def ledger(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        return self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger/{version}") if version >= 0 else self.spark.createDataFrame([], LEDGER)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of all files as of a run."""
        now = self.ledger(version)
        batches = [r[0] for r in now.select("batch").distinct().collect()]  # as many as there were runs
        if not batches:
            return self.spark.createDataFrame([], self.schema)
        schema = self.spark.createDataFrame([], self.schema).schema
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*(f"{self.path}/data/batch={b}" for b in sorted(batches)))
        return rows.withColumn("batch", F.col("batch").cast("long")).join(few(now.select("source_file", "batch")), ["source_file", "batch"], "left_semi").select(schema.names)

    def load(self, folder: str, all_again: bool = False, gone: bool = False) -> dict[str, int]:
        """Loads what is new or changed in a folder; how many files were new, changed, and as before."""
        last = self.version()
        known = self.ledger(last)
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(F.col("path").alias("source_file"), "content")
        seen = session.stored(files.select("source_file", F.sha2("content", 256).alias("checksum")), "seen")
        against = session.stored(seen.join(known.withColumnRenamed("checksum", "was"), "source_file", "left"), "against")
        fresh = against if all_again else against.where("was IS NULL OR was <> checksum")
        count = against.agg(F.count_if(F.col("was").isNull()), F.count_if(F.col("was") != F.col("checksum")), F.count_if(F.col("was") == F.col("checksum"))).first()
        new, changed, same = (int(x or 0) for x in count)
        lost = known.join(seen, "source_file", "left_anti")
        if new + changed + (same if all_again else 0) or gone and lost.limit(1).count():
            fresh = session.stored(fresh.select("source_file", "checksum"), "fresh")
            rows = self.parse(files.join(few(fresh.select("source_file")), "source_file", "left_semi"))
            names = self.spark.createDataFrame([], self.schema).schema.names
            rows.select(names).write.mode("overwrite").parquet(f"{self.path}/data/batch={last + 1}")
            kept = known.join(fresh, "source_file", "left_anti")
            kept = kept.join(seen.select("source_file"), "source_file", "left_semi") if gone else kept
            kept.unionByName(fresh.withColumn("batch", F.lit(last + 1).cast("long"))).write.mode("overwrite").parquet(f"{self.path}/ledger/{last + 1}")
        return {"new": new, "changed": changed, "same": same}


def json_lines(schema: str) -> Callable[[DataFrame], DataFrame]:
    """A parser of files with one JSON object a line; lines that aren't objects are left out."""

    def parse(files: DataFrame) -> DataFrame:
        lines = files.select("source_file", F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line")).where("trim(line) <> ''")
        return lines.select("source_file", F.from_json("line", schema).alias("r")).where("r IS NOT NULL").select("source_file", "r.*")

    return parse
