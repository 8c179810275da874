"""Writers, pages, graph components and streams."""

import pytest
from pyspark.sql import functions as F

from weekloom import session
from weekloom.operators import graph, similar
from weekloom.plans import stages
from weekloom.sources import html, sinks
from weekloom.streaming import weekly as stream


def test_replace_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([("w1", "a", 1), ("w2", "b", 2)], "week string, keyword string, count int")
    for _ in range(2):
        sinks.replace_partitions(one, path)
    sinks.replace_partitions(spark.createDataFrame([("w2", "c", 3)], one.schema), path)
    assert sorted((r.week, r.keyword, r["count"]) for r in spark.read.parquet(path).collect()) == [("w1", "a", 1), ("w2", "c", 3)]


def test_upsert_and_insert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 5), ("c", 4)], "k string, v int")
    assert sorted(tuple(r) for r in sinks.inserted(old, new, ["k"], ["v"]).collect()) == [("a", 1), ("b", 2), ("c", 4)]
    got = {r.k: r.v for r in sinks.upserted(old, new, ["k"], "v").collect()}
    assert got == {"a": 1, "b": 3, "c": 5}
    assert [r.k for r in sinks.without(old, new, ["k"]).collect()] == ["a"]


def test_export_and_new_files(spark, tmp_path):
    df = spark.range(10)
    assert sinks.export(df, str(tmp_path / "full"), "s")["compact"] is False
    assert sinks.export(df, str(tmp_path / "part"), "s", "json", most_rows=5, sample=3)["compact"] is True
    assert spark.read.json(str(tmp_path / "part" / "data")).count() == 3
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("1")
    known = sinks.new_files(spark, str(tmp_path / "in"), spark.createDataFrame([], "source_file string, checksum string"))
    known = spark.createDataFrame(known.collect(), known.schema)
    assert known.count() == 1 and sinks.new_files(spark, str(tmp_path / "in"), known).count() == 0
    (tmp_path / "in" / "a.csv").write_text("2")
    assert sinks.new_files(spark, str(tmp_path / "in"), known).count() == 1


def test_records(spark):
    page = '<ul><li class="x">One <a href="/1">go</a></li><li class="x y">Two<br></li><li>Three</li><li class="x"></li></ul><p id="q">P</p>'
    pages = spark.createDataFrame([(1, page), (2, None)], "page_id long, html string")
    got = lambda s: [(r.title, r.url) for r in html.records(pages, s).orderBy("nr").collect()]
    assert got(".x") == got("li.x") == [("One go", "/1"), ("Two", "")] and got("#q") == [("P", "")] and len(got("li")) == 3
    items = spark.createDataFrame([("a", "u"), ("b", "u"), ("c", None), ("d", None)], "title string, url string")
    assert html.distinct_items(items).count() == 3


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 20)] + [(30, 31)], "a long, b long")
    got = {r.node: r.component for r in graph.components(spark.range(1, 40).withColumnRenamed("id", "node"), links).collect()}
    assert {got[k] for k in range(1, 21)} == {1} and got[31] == 30 and got[35] == 35


def test_cohesion_of_one_vector(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0]), ("b", [0.0, 2.0])], "g string, e array<double>")
    assert {r.g: round(r.cohesion, 6) for r in similar.cohesion(df, ["g"], "e").collect()} == {"a": 1.0, "b": 0.0}


def test_stream_equals_batch(spark, tmp_path):
    rows = [(f"2024-01-{d:02d} 10:00:00", "view" if d % 2 else "buy", d % 3) for d in range(1, 29)]
    events = spark.createDataFrame(rows, "ts string, event_type string, user_id long").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 10).parquet(str(tmp_path / "in"))
    for _ in range(2):
        table = stream.changed_weeks(spark, source, str(tmp_path / "out"), str(tmp_path / "cp"))
    shown = lambda df: sorted((r.week, r.keyword, r.source, r["count"]) for r in df.collect())
    assert shown(table.read()) == shown(stream.weekly_rollup(events))
    first = stream.first_of_key(source, ["user_id", "event_type"], "100 days")
    stream.run_to_table(first, str(tmp_path / "first"), str(tmp_path / "cp2"))
    assert spark.read.parquet(str(tmp_path / "first")).count() == 6


def test_range_replace_and_not_a_number(spark):
    old = spark.createDataFrame([(1, "w1"), (1, "w2"), (2, "w2"), (3, "w4")], "thread_id int, week string")
    new = spark.createDataFrame([(9, "w2")], old.schema)
    meta = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "thread_id int, kind string")
    members, left = sinks.replaced_range(old, new, meta, "w2", "w3")
    assert sorted(map(tuple, members.collect())) == [(1, "w1"), (3, "w4"), (9, "w2")] and [r.thread_id for r in left.collect()] == [3]
    rows = spark.createDataFrame([(float("nan"), 1), (None, 2), (1.5, 3)], "x double, k int")
    assert [r.x for r in sinks.without_nan(rows).orderBy("k").collect()] == [None, None, 1.5]


def test_items_held_to_their_schema_and_distinct_by_place(spark):
    bodies = ['{"items": [{"title": " a ", "source_url": "u", "selector": "s", "raw_snippet": "r"}]}', '{"items": [{"title": "a"}]}', '{"items": {}}', "x", None, '{"items": []}']
    rows = spark.createDataFrame(list(enumerate(bodies)), "k int, body string").select("k", html.checked_items(F.col("body")).alias("c")).orderBy("k").collect()
    assert [r.c.ok for r in rows] == [True, False, False, False, False, True] and rows[0].c["items"][0].title == "a"
    page = [("t", "https://x/1"), ("u", "https://x/2"), ("t", "https://x/1")]
    items = spark.createDataFrame([(n, *i) for n in range(3) for i in page] + [(9, "no", None), (9, "no", None)], "page_id int, title string, url string")
    got = html.distinct_items(items, order=("page_id",)).collect()
    assert sorted((r.page_id, r.url or "") for r in got) == [(0, "https://x/1"), (0, "https://x/2"), (9, ""), (9, "")]


def test_page_summary(spark):
    pages = spark.createDataFrame([(1, "<html><body><script>x</script><h1>A  b</h1><p>c<br>d <a href='u'>e</a></p><div>no</div></body></html>"), (2, None), (3, "<p>open")], "page_id long, html string")
    got = {r.page_id: r.summary for r in html.summaries(pages).collect()}
    assert got == {1: "h1: A b\na: e\np: cd", 2: "", 3: ""}


def test_shared_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_stages_follow_their_sources(spark, tmp_path):
    path, calls = f"{tmp_path}/events.parquet", []

    def make(s, folder):
        calls.append(folder)
        return s.read.parquet(f"{folder}/events.parquet").groupBy().count()

    spark.range(5).write.parquet(path)
    count = lambda: stages.stage(spark, str(tmp_path), "counted", make, "events").first()["count"]
    assert [count(), count()] == [5, 5] and len(calls) == 1
    spark.range(7).write.mode("overwrite").parquet(path)
    assert [count(), count()] == [7, 7] and len(calls) == 2


def test_stages_follow_files_within_partitions(spark, tmp_path):
    """A file that is put into a partition's folder is seen, also where the table's own folder keeps its time."""
    path = f"{tmp_path}/parted.parquet"
    spark.range(4).selectExpr("id", "id % 2 AS part").write.partitionBy("part").parquet(path)
    before = session.state_of(spark, path)
    assert session.state_of(spark, path) == before
    spark.range(9, 10).write.mode("append").parquet(f"{path}/part=1")
    assert session.state_of(spark, path) != before


def test_few_files_are_spread_only_where_row_groups_are_few(spark, tmp_path):
    """A shuffle of all texts is for tables that too few tasks would read: large files of many row groups go to all cores."""
    import random

    import pyarrow as pa
    import pyarrow.parquet as pq

    from weekloom.operators import contexts
    from weekloom.sources import tables

    rng = random.Random(19)
    rows = pa.table({"doc_id": list(range(800)), "source": ["p"] * 800, "text": [" ".join(f"{rng.getrandbits(60):x}" for _ in range(40)) for _ in range(800)]})
    for name, in_group in (("many", 50), ("one", 800)):
        (tmp_path / name / "documents.parquet").mkdir(parents=True)
        pq.write_table(rows, tmp_path / name / "documents.parquet" / "part-0.parquet", row_group_size=in_group)
    small = {"spark.sql.files.maxPartitionBytes": "60000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan(tables.articles(spark, str(tmp_path / "many")))
        assert "Exchange RoundRobin" in plan(tables.articles(spark, str(tmp_path / "one")))
        assert plan(contexts.contexts(tables.articles(spark, str(tmp_path / "many"), spread_out=False))).count("Exchange") == 1
        assert "Exchange" not in plan(tables.articles(spark, str(tmp_path / "one"), spread_out=False))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
