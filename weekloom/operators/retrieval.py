"""Contexts of a keyword in a week: vector search under a filter, a bump for the keyword, and a scan where there is no hit.

points: id, weeks (labels of the weeks that a row belongs to, by its date or the range of its file), vector, text.
asked: query_id, week, keyword, vector (null where a query has none).

The filter is the week, so rows and queries meet by it; within a week the search is exact (blocked.py). Rows are normalised
as keywords are before a keyword is looked for in them. Hits of the wide search are ranked by score with the bump, ties as
the search has them; rows of a scan by whether they hold the keyword, then by id as a text. A query is never its own hit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions import text, vectors
from weekloom.operators import blocked, contained
from weekloom.operators.similar import few
from weekloom.session import stored

#: What a keyword in the text adds, and how many hits are looked at: so many times k, and so many at least.
BUMP, TIMES, LEAST = 0.005, 3, 30
COLUMNS = ("query_id", "id", "score", "rank", "path")


def by_vector(points: DataFrame, asked: DataFrame, vector: str, k: int) -> DataFrame:
    """The k best rows of the week for each query with a vector, after the bump."""
    rows = points.select(F.explode("weeks").alias("week"), "id", vector)
    queries = asked.where(F.col(vector).isNotNull()).select("week", F.col("query_id").alias("id"), vector)
    wide = stored(blocked.nearest(rows, queries, ["week"], vector, max(LEAST, TIMES * k)), "hits")
    words = asked.select("query_id", text.normalise_keyword(F.col("keyword")).alias("word"))
    near = wide.join(words, "query_id").join(points.select("id", "text"), "id")
    holds = (F.col("word") != "") & F.contains(text.normalise_keyword(F.col("text")), F.col("word"))
    bumped = near.withColumn("score", F.col("score") + F.when(holds, BUMP).otherwise(0.0))
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("score", blocked.PLACES)), "rank"))
    return bumped.withColumn("rank", nth).where(F.col("rank") <= k).withColumn("path", F.lit("vector")).select(*COLUMNS)


def by_scan(points: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The first k rows of the week for each query: those with the keyword first, then by id as a text.

    Rows with a keyword come from an index of keywords; of the others the first 2k of a week are enough, as fewer than k
    of these are among a query's hits where its hits don't fill its list.
    """
    words = stored(asked.select("query_id", "week", text.normalise_keyword(F.col("keyword")).alias("word")), "asked")
    rows = stored(points.select("id", text.normalise_keyword(F.col("text")).alias("text"), "weeks"), "texts")
    there = rows.select("id", F.explode("weeks").alias("week"))
    found = contained.contained(rows.select("id", "text"), words.select("word"))
    hits = found.join(there, "id").join(few(words), ["week", "word"]).where("id <> query_id").select("query_id", "id", F.lit(1.0).alias("score"))
    order = F.col("id").cast("string")
    first = Window.partitionBy("query_id").orderBy(order)
    hits = stored(hits.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k).drop("nth"), "hits")
    early = there.withColumn("nth", F.row_number().over(Window.partitionBy("week").orderBy(order))).where(F.col("nth") <= 2 * k + 1).drop("nth")
    rest = early.join(words, "week").where("id <> query_id").select("query_id", "id").join(hits.select("query_id", "id"), ["query_id", "id"], "left_anti").withColumn("score", F.lit(0.0))
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), order))
    return hits.unionByName(rest).withColumn("rank", nth).where(F.col("rank") <= k).withColumn("path", F.lit("scan")).select(*COLUMNS)


def contexts(points: DataFrame, asked: DataFrame, vector: str, k: int = 10) -> DataFrame:
    """(query_id, id, score, rank, path): by vector, and by a scan for the queries that this leaves without a row."""
    near = stored(by_vector(points, asked, vector, k), "near")
    left = asked.join(near.select("query_id").distinct(), "query_id", "left_anti")
    return near.unionByName(by_scan(points, left, k))


def two_phases(points: DataFrame, asked: DataFrame, vector: str, k: int = 10, summary: int = 3) -> DataFrame:
    """Contexts found from what the first search of a query brings: a second search with the mean of its `summary` first rows.

    asked has `active` too: what isn't is not searched at all. A query whose first search brings no vector keeps its own.
    """
    live = stored(asked.where("active"), "active")
    first = stored(contexts(points, live, vector, k), "first").where(F.col("rank") <= summary)
    means = vectors.mean_vector(first.join(points.select("id", vector), "id"), ["query_id"], vector, "_mean")
    seeded = live.join(means, "query_id", "left").withColumn(vector, F.coalesce("_mean", vector)).drop("_mean")
    return contexts(points, stored(seeded, "seeded"), vector, k)
