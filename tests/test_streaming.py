"""Tables that streams keep up to date: arrivals, restarts, retried and broken batches against the batch answer."""

import pytest
from pyspark.sql import functions as F

from weekloom import session
from weekloom.sources import ingest
from weekloom.streaming import weekly
from weekloom.streaming.versioned import WeekTable

EVENTS = "ts timestamp, event_type string, user_id long"


def shown(df):
    return sorted(tuple(r) for r in df.collect())


def events_of(spark, rows):
    return spark.createDataFrame(rows, "ts string, event_type string, user_id long").withColumn("ts", F.col("ts").cast("timestamp"))


def test_arrivals_and_restarts_equal_the_batch(spark, tmp_path):
    arrivals = [
        [("2024-01-08 01:00:00", "a", 1), ("2024-01-09 01:00:00", "b", 1), ("2024-01-17 05:00:00", "a", 2)],
        [("2024-01-10 01:00:00", "c", 1), ("2024-01-08 09:00:00", "a", 1)],  # the same week again: a new key, and one that grows
        [("2023-03-01 00:00:00", "a", 1), (None, "a", 1)],  # much later than it happened; without a time
        [("2024-01-21 23:59:59", "a", None), ("2024-01-22 00:00:00", "a", None)],
    ]
    seen = []
    for rows in arrivals:
        events_of(spark, rows).write.mode("append").parquet(str(tmp_path / "in"))
        seen += rows
        source = spark.readStream.schema(EVENTS).parquet(str(tmp_path / "in"))
        table = weekly.changed_weeks(spark, source, str(tmp_path / "out"), str(tmp_path / "mark"))
        assert shown(table.read().na.fill("-")) == shown(weekly.weekly_rollup(events_of(spark, seen)).na.fill("-"))
    version = table.version()
    assert weekly.changed_weeks(spark, source, str(tmp_path / "out"), str(tmp_path / "mark")).version() == version  # nothing new
    before = shown(table.read().na.fill("-"))
    assert table.vacuum() > 0 and shown(table.read().na.fill("-")) == before and table.vacuum() == 0


def test_retried_and_broken_batches(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "week string, k string, n long")
    table = WeekTable(spark, str(tmp_path / "t"), "week string, k string, n long", ["week", "k"])
    assert shown(table.read()) == [] and table.version() is None
    assert table.merge(rows(("w1", "a", 1), ("w1", "b", 1), ("w2", "a", 1)), 0)
    assert table.merge(rows(("w1", "b", 5), ("w1", "c", 5)), 1)
    now = [("w1", "a", 1), ("w1", "b", 5), ("w1", "c", 5), ("w2", "a", 1)]
    assert shown(table.read()) == now
    assert not table.merge(rows(("w1", "b", 5), ("w1", "c", 5)), 1) and shown(table.read()) == now
    assert shown(table.read(version=0)) == [("w1", "a", 1), ("w1", "b", 1), ("w2", "a", 1)] and shown(table.read(["w2"])) == [("w2", "a", 1)]
    # A batch that broke after its data and before its commit: readers don't see it, and its second run does it all.
    rows(("w1", "x", 9)).write.partitionBy("week").parquet(str(tmp_path / "t" / "data" / f"batch={2:012d}"))
    assert shown(table.read()) == now
    assert table.merge(rows(("w2", "b", 2)), 2) and shown(table.read()) == [*now, ("w2", "b", 2)]
    # One that broke while it wrote its commit.
    session.delete(spark, str(tmp_path / "t" / "commits" / f"{2:012d}" / "_SUCCESS"))
    assert shown(table.read()) == now and table.merge(rows(("w2", "b", 2)), 2) and shown(table.read()) == [*now, ("w2", "b", 2)]
    assert table.merge(spark.createDataFrame([], "week string, k string, n long"), 3) and shown(table.read()) == [*now, ("w2", "b", 2)]
    with pytest.raises(ValueError, match="week"):
        table.merge(rows((None, "a", 1)), 4)


def test_groups_of_an_update_stream_replace_theirs(spark, tmp_path):
    """Groups that a stateful count changed come whole, so they replace the old rows of their keys and no others."""
    table = WeekTable(spark, str(tmp_path / "t"), weekly.FACTS, ["week", "keyword", "source"])
    seen = []
    for rows in ([("2024-01-08 01:00:00", "a", 1), ("2024-01-09 01:00:00", "b", 1)], [("2024-01-10 01:00:00", "c", 1), ("2024-01-11 01:00:00", "a", 1)]):
        events_of(spark, rows).write.mode("append").parquet(str(tmp_path / "in"))
        seen += rows
        source = spark.readStream.schema(EVENTS).parquet(str(tmp_path / "in"))
        table.follow(weekly.weekly_rollup(source), str(tmp_path / "mark"))
        assert shown(table.read()) == shown(weekly.weekly_rollup(events_of(spark, seen)))


def plain_firsts(rows, ttl):
    """By definition: events of a key in order, each the first or a repetition of the last first within its time to live."""
    out, open_ = [], {}
    for key, at, event in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if key not in open_ or at >= open_[key][0] + ttl:
            open_[key] = (at, event)
        out.append((str(key), event, event == open_[key][1], open_[key][1]))
    return sorted(out)


def test_keys_are_free_again_after_their_time(spark, tmp_path):
    at = [0, 10, 299, 300, 301, 599, 600, 900, 5000, 5000, 5299.5, 5300]
    rows = [(k % 2, float(a + 1_700_000_000 + 37 * (k % 2)), 10 * n + k) for n, a in enumerate(at) for k in range(2)]
    frame = lambda part: spark.createDataFrame(part, "k long, s double, event_id long").selectExpr("k", "timestamp_micros(CAST(s * 1000000 AS BIGINT)) AS ts", "event_id")
    whole = frame(rows + [(None, 1.0, 999)])
    batch = weekly.first_within(whole, F.col("k"), 300.0)
    assert shown(batch) == plain_firsts(rows, 300)
    rows.sort(key=lambda r: r[1])
    for part in (rows[:5], rows[5:14], rows[14:]):
        frame(part).write.mode("append").parquet(str(tmp_path / "in"))
        arrived = spark.readStream.schema(whole.schema).parquet(str(tmp_path / "in"))
        weekly.run_to_table(weekly.first_within(arrived, F.col("k"), 300.0, "1 hour"), str(tmp_path / "out"), str(tmp_path / "mark"))
    assert shown(spark.read.parquet(str(tmp_path / "out"))) == plain_firsts(rows, 300)


def test_files_are_loaded_once_and_replaced_when_they_change(spark, tmp_path):
    table = ingest.FileTable(spark, str(tmp_path / "t"), "source_file string, a long", ingest.json_lines("a long"))
    (tmp_path / "in" / "deep").mkdir(parents=True)
    write = lambda name, *values: (tmp_path / "in" / name).write_text("\n".join([*(f'{{"a": {v}}}' for v in values), "", "no json"]))
    held = lambda: sorted(r.a for r in table.read().collect() if r.a is not None)
    assert held() == []
    write("x", 1, 2)
    write("deep/y", 3)
    assert table.load(str(tmp_path / "in")) == {"new": 2, "changed": 0, "same": 0} and held() == [1, 2, 3]
    assert table.load(str(tmp_path / "in")) == {"new": 0, "changed": 0, "same": 2} and table.version() == 0
    write("x", 2, 2, 5)
    write("z", 9)
    assert table.load(str(tmp_path / "in")) == {"new": 1, "changed": 1, "same": 1} and held() == [2, 2, 3, 5, 9]
    session.delete(spark, str(tmp_path / "t" / "ledger" / "1" / "_SUCCESS"))  # a run that broke before its commit
    assert held() == [1, 2, 3] and table.load(str(tmp_path / "in"))["changed"] == 1 and held() == [2, 2, 3, 5, 9]
    (tmp_path / "in" / "z").unlink()
    table.load(str(tmp_path / "in"))
    assert held() == [2, 2, 3, 5, 9]
    table.load(str(tmp_path / "in"), gone=True)
    assert held() == [2, 2, 3, 5]
    assert table.load(str(tmp_path / "in"), all_again=True)["same"] == 2 and held() == [2, 2, 3, 5]
