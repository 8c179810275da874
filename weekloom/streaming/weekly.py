"""The weekly facts as a stream: event-time weeks with a watermark, duplicates within a time to live, restartable ingest."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from weekloom.functions import dates
from weekloom.streaming.versioned import WeekTable


def week_window(ts: str) -> Column:
    """Weeks from Monday to Sunday, in UTC."""
    return F.window(ts, "7 days", "7 days", "4 days")


def weekly_rollup(events: DataFrame, late: str = "7 days") -> DataFrame:
    """(week, keyword, source, count) of an event stream or table; events later than the watermark are left out."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    counted = rows.groupBy(week_window("ts").alias("w"), F.col("event_type").alias("keyword"), F.col("user_id").cast("string").alias("source")).agg(F.count("*").cast("int").alias("count"))
    return counted.select(dates.iso_week(F.col("w.start").cast("date")).alias("week"), "keyword", "source", "count")


def first_of_key(events: DataFrame, key: list[str], ttl: str = "300 seconds") -> DataFrame:
    """The first event of a key within the time to live; state goes with the watermark."""
    return events.withWatermark("ts", ttl).dropDuplicatesWithinWatermark(key)


def _firsts(rows: pd.DataFrame, key: str, ttl: float, expires: float, first: int) -> tuple[pd.DataFrame, float, int]:
    """What each event of one key is, in order: the first of its time to live, or a repetition of such a one."""
    out = []
    for at, event in zip(rows["at"], rows["event_id"], strict=True):
        fresh = at >= expires
        if fresh:
            expires, first = at + ttl, event
        out.append((event, fresh, first))
    found = pd.DataFrame(out, columns=["event_id", "is_first", "first_id"])
    found.insert(0, "key", key)
    return found, expires, first


def first_within(events: DataFrame, key: Column, ttl: float = 300.0, late: str = "0 seconds") -> DataFrame:
    """(key, event_id, is_first, first_id): the first event of a key opens its time to live (in seconds); those within repeat it.

    A key is free again when the time is over, whoever came meanwhile. events: event_id, ts; null keys and times are left
    out. In a stream the state of a key is its expiry and the first event, and a timer drops it; micro-batches are to come
    in the order of time, and what comes later than the watermark is left out. A table is sorted and goes by as a stream.
    """
    rows = events.select(key.cast("string").alias("key"), F.col("event_id").cast("long").alias("event_id"), F.col("ts").cast("timestamp").alias("ts")).where("key IS NOT NULL AND ts IS NOT NULL")
    schema = "key string, event_id long, is_first boolean, first_id long"
    if not rows.isStreaming:
        timed = rows.withColumn("at", F.unix_micros("ts") / 1e6).drop("ts")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own, expires, first = None, -math.inf, 0
            for batch in batches:
                for name, part in batch.groupby("key", sort=False):
                    if name != own:
                        own, expires, first = name, -math.inf, 0
                    found, expires, first = _firsts(part, name, ttl, expires, first)
                    yield found

        return timed.repartition("key").sortWithinPartitions("key", "at", "event_id").mapInPandas(run, schema)

    def update(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        expires, first = state.get if state.exists else (-math.inf, 0)
        part = pd.concat([b[["ts", "event_id"]] for b in batches]).assign(at=lambda x: x["ts"].astype("datetime64[us]").astype("int64") / 1e6).sort_values(["at", "event_id"])
        found, expires, first = _firsts(part, name[0], ttl, expires, first)
        state.update((expires, int(first)))
        state.setTimeoutTimestamp(max(int(expires * 1000), state.getCurrentWatermarkMs() + 1))
        yield found

    watched = rows.withWatermark("ts", late)
    return watched.groupBy("key").applyInPandasWithState(update, schema, "expires double, first_id long", "append", GroupStateTimeout.EventTimeTimeout)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Processes what is there and stops; a second run goes on from the checkpoint."""
    query = stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


FACTS = "week string, keyword string, source string, count int"


def fact_table(spark: SparkSession, path: str) -> WeekTable:
    """The weekly facts as a table that streams keep up to date."""
    return WeekTable(spark, path, FACTS, ["week", "keyword", "source"], add=("count",))


def changed_weeks(spark: SparkSession, events: DataFrame, path: str, checkpoint: str) -> WeekTable:
    """Adds the events that have arrived to the weekly facts: each micro-batch rewrites the weeks that it touches, once.

    A batch is counted by itself and added to what the table has, so no state is held between batches, and an event counts
    however late it comes.
    """
    table = fact_table(spark, path)

    def add(batch: DataFrame, number: int) -> None:
        table.merge(weekly_rollup(batch), number)

    events.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(add).start().awaitTermination()
    return table
