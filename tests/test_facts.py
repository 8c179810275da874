"""Weekly facts from lines, parts and suppliers: how they are dealt."""

import datetime

from weekloom.sources import tables


def _tables(spark, folder, lines):
    day = datetime.date(2024, 1, 3)
    rows = [(day + datetime.timedelta(days=k % 9), k % 7, k % 5, 1.0 + k % 3) for k in range(lines)]
    spark.createDataFrame(rows, "l_shipdate date, l_partkey long, l_suppkey long, l_quantity double").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(k, f"p{k % 3}", "b") for k in range(7)], "p_partkey long, p_name string, p_brand string").write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(k, f"s{k % 2}") for k in range(5)], "s_suppkey long, s_name string").write.parquet(f"{folder}/supplier.parquet")
    return rows


def test_facts_are_dealt_by_key_before_they_are_summed(spark, tmp_path, monkeypatch):
    """A task that summed what it reads would hold a file's split; dealt lines make partitions as their number grows."""
    rows = _tables(spark, tmp_path, 400)
    monkeypatch.setattr(tables, "IN_TASK", 50)
    made = tables.weekly_keywords(spark, str(tmp_path))
    expected = {}
    for day, part, supplier, quantity in rows:
        key = day.strftime("%G-W%V"), f"p{part % 3} b", f"s{supplier % 2}"
        expected[key] = expected.get(key, 0) + quantity
    assert {tuple(r)[:3]: r["count"] for r in made.collect()} == expected
    lines = made._jdf.queryExecution().sparkPlan().toString().splitlines()
    above = lines[: next(k for k, line in enumerate(lines) if "l_shipdate" in line and "FileScan" in line)]
    dealt = max(k for k, line in enumerate(above) if "Exchange" in line)
    assert "hashpartitioning(monday" in above[dealt] and ", 8)" in above[dealt]
    assert not any("Aggregate" in line for line in above[dealt:])


def test_sums_by_name_are_dealt_as_their_number_asks_for(spark, tmp_path, monkeypatch):
    """Facts, weekly sums and what ranks them: no step rests on the session's four partitions or on the size of a split."""
    from weekloom.operators import weekly
    from weekloom.plans import catalog, weekly_queries

    _tables(spark, tmp_path, 400)
    folder, plan = str(tmp_path), lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(tables, "IN_TASK", 50)
    assert ", 8), REPARTITION_BY_NUM" in plan(tables.weekly_keywords(spark, folder)).split("Join")[0]
    monkeypatch.setattr(tables, "IN_TASK", 1)
    f = weekly_queries.freq(spark, folder)
    n = f.count()
    assert n > 4
    prompts = catalog.queries()["enr01_prompts"](spark, folder)
    assert f", {n}), REPARTITION_BY_NUM" in plan(prompts)
    assert ", 9), REPARTITION_BY_NUM" in plan(weekly.baseline(f, tasks=9))
    assert sorted(map(tuple, weekly.baseline(f, 1, 1.0, tasks=9).collect())) == sorted(map(tuple, weekly.baseline(f, 1, 1.0).collect()))
