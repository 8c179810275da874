"""A table of weeks that micro-batches are merged into, each batch once.

A batch writes the weeks that it touches anew, whole, under its own number, and then a list of which number holds which
week. That list is the commit: readers take the newest list that is complete, so they see all of a batch or nothing of it,
and a batch that is run again after a failure finds its commit and changes nothing, or finds none and writes its folder
again. Weeks that a batch doesn't touch are not read. The list has one row for each week, however many rows these have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom import session

DIGITS = 12


class WeekTable:
    """Rows by week, in a folder. keys: what names a row, the week among them. schema: of the rows, as DDL.

    add: numeric columns in which rows of one key are summed up; without them a new row replaces the old one of its key.
    A table belongs to one stream, whose batch numbers only grow. Rows without a week are refused.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], add: tuple[str, ...] = (), week: str = "week"):
        self.spark, self.path, self.schema, self.keys, self.add, self.week = spark, path.rstrip("/"), schema, keys, add, week

    def version(self) -> int | None:
        """The number of the last batch that was committed."""
        names = session.names(self.spark, f"{self.path}/commits")
        done = [int(n) for n in names if n.isdigit() and session.exists(self.spark, f"{self.path}/commits/{n}/_SUCCESS")]
        return max(done, default=None)

    def _list(self, version: int | None) -> dict[str, int]:
        """Which batch holds each week."""
        if version is None:
            return {}
        return {r[0]: r[1] for r in self.spark.read.schema("week string, batch long").parquet(f"{self.path}/commits/{version:0{DIGITS}d}").collect()}

    def read(self, weeks: list[str] | None = None, version: int | None = None) -> DataFrame:
        """The rows of these weeks, or of all, as of the last commit or an earlier one."""
        where = self._list(self.version() if version is None else version)
        paths = [f"{self.path}/data/batch={b:0{DIGITS}d}/{self.week}={w}" for w, b in where.items() if weeks is None or w in weeks]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data").parquet(*sorted(paths))
        return rows.select([f.name for f in self.spark.createDataFrame([], self.schema).schema])

    def merge(self, batch: DataFrame, number: int) -> bool:
        """Puts a batch's rows in; False if that batch is already there. Its rows are written once before they are used."""
        last = self.version()
        if last is not None and number <= last:
            return False
        at = f"{number:0{DIGITS}d}"
        changes = f"{self.path}/changes/{at}"
        batch.select([f.name for f in self.spark.createDataFrame([], self.schema).schema]).write.mode("overwrite").parquet(changes)
        new = self.spark.read.schema(self.schema).parquet(changes)
        weeks = [r[0] for r in new.select(self.week).distinct().collect()]  # as many as there are weeks
        if None in weeks:
            raise ValueError("a row without a week")
        old = self.read(weeks, last) if last is not None else self.read([])
        if self.add:
            sums = {f.name: F.sum(f.name).cast(f.dataType).alias(f.name) for f in new.schema if f.name in self.add}
            merged = old.unionByName(new).groupBy(*self.keys).agg(*(sums[c] for c in self.add))
        else:
            merged = old.join(new.select(*self.keys), self.keys, "left_anti").unionByName(new)
        if weeks:
            # By range, so that a large week is several tasks and files, and a small one is one.
            merged.repartitionByRange(self.week, *(k for k in self.keys if k != self.week)).write.mode("overwrite").partitionBy(self.week).parquet(f"{self.path}/data/batch={at}")
        where = self._list(last) | {w: number for w in weeks}
        self.spark.createDataFrame(sorted(where.items()), "week string, batch long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/{at}")
        return True

    def follow(self, stream: DataFrame, checkpoint: str, mode: str = "update") -> None:
        """Merges what has arrived in a stream and stops; the next call goes on from the checkpoint."""
        started = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        started.foreachBatch(lambda batch, number: self.merge(batch, number) and None).start().awaitTermination()

    def vacuum(self) -> int:
        """Deletes folders of batches that the last commit doesn't name, and earlier commits; how many went."""
        last = self.version()
        if last is None:
            return 0
        held = {f"batch={b:0{DIGITS}d}" for b in self._list(last).values()}
        gone = [f"data/{n}" for n in session.names(self.spark, f"{self.path}/data") if n.startswith("batch=") and n not in held]
        for kind in ("commits", "changes"):
            gone += [f"{kind}/{n}" for n in session.names(self.spark, f"{self.path}/{kind}") if n.isdigit() and int(n) < last]
        for name in gone:
            session.delete(self.spark, f"{self.path}/{name}")
        return len(gone)
