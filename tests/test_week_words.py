"""Which words of its week a text holds."""

from pyspark.sql import functions as F

from weekloom.plans import more_queries


def test_texts_meet_the_words_of_their_week_alone(spark, monkeypatch):
    """No text is cut into parts or shuffled: there are few words of a week, and they come to it."""
    words = spark.createDataFrame([("a", "alpha", 1), ("a", "bravo", 2), ("b", "alpha", 1)], "week string, keyword string, place int")
    monkeypatch.setattr(more_queries, "week_words", lambda spark, d: words)
    texts = [("a", 1, "alphabravo", 10), ("a", 2, "xalpha alpha", 20), ("b", 3, "bravo", 30), ("b", 4, "ALPHA alpha", 40), ("c", 5, "alpha", 50), ("a", 6, None, 60)]
    rows = spark.createDataFrame(texts, "week string, id long, text string, size int")
    found = more_queries.week_hits(spark, "", rows)
    assert sorted(map(tuple, found.collect())) == [("a", 1, "alpha", 1, 10), ("a", 1, "bravo", 2, 10), ("a", 2, "alpha", 1, 20), ("b", 4, "alpha", 1, 40)]
    plan = found.select(F.sum("size"))._jdf.queryExecution().sparkPlan().toString()
    assert "Generate" not in plan and "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1
