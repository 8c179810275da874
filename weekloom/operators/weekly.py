"""Stages 2 to 4: weekly frequencies, TF-IDF with a rolling baseline, and z-scores of the smoothed signal.

All tables stay long. The document-frequency filter comes before weeks are filled in, so only surviving keywords are
made dense; each keyword is one window partition with one row for each week.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bounds of the filter, weeks of the baseline, span of the smoothing, short window, threshold.
MIN_DF, MAX_DF, LONG_WEEKS, SPAN, SHORT_WEEKS, HIGH_Z = 50, 0.7, 104, 4, 1, 2.0
#: A deviation below this is rounding, and counts as none.
NO_DEVIATION = 1e-9


def frequencies(weekly: DataFrame) -> DataFrame:
    return weekly.groupBy("week", "keyword").agg(F.sum("count").cast("int").alias("count"))


def sources(weekly: DataFrame) -> DataFrame:
    return weekly.groupBy("week", "keyword").agg(F.concat_ws("|", F.sort_array(F.collect_set("source"))).alias("sources"))


def document_frequencies(freq: DataFrame) -> DataFrame:
    return freq.where("count > 0").groupBy("keyword").agg(F.count_distinct("week").alias("df"))


def week_index(freq: DataFrame) -> DataFrame:
    """(week, week_idx, n_weeks) of all weeks that occur: one row a week."""
    weeks = freq.select("week").distinct()
    w = Window.orderBy("week")
    return weeks.select("week", F.row_number().over(w).alias("week_idx")).crossJoin(weeks.agg(F.count("*").cast("int").alias("n_weeks")))


def filtered_keywords(freq: DataFrame, min_df: int = MIN_DF, max_df: float = MAX_DF) -> DataFrame:
    """Keywords within the document-frequency band. The lower bound gives way on few weeks; the upper one if none is left."""
    n = F.col("n_weeks")
    low = F.greatest(F.lit(1), F.least(F.lit(min_df), n))
    high = F.greatest(low, F.greatest(F.lit(1), F.floor(F.lit(max_df) * n)))
    counted = document_frequencies(freq).crossJoin(F.broadcast(freq.agg(F.count_distinct("week").alias("n_weeks"))))
    marked = counted.where(F.col("df") >= low).withColumn("inside", F.col("df") <= high)
    some = marked.agg(F.coalesce(F.max("inside"), F.lit(False)).alias("some"))
    return marked.crossJoin(F.broadcast(some)).where(F.col("inside") | ~F.col("some")).select("keyword", "df")


def dense(freq: DataFrame, keywords: DataFrame) -> DataFrame:
    """(keyword, week, week_idx, count) for every given keyword and every week, zeros included."""
    grid = keywords.select("keyword").crossJoin(F.broadcast(week_index(freq)))
    return grid.join(freq, ["keyword", "week"], "left").select("keyword", "week", "week_idx", F.coalesce("count", F.lit(0)).alias("count"))


def baseline(freq: DataFrame, min_df: int = MIN_DF, max_df: float = MAX_DF, long_weeks: int = LONG_WEEKS, tasks: int | None = None) -> DataFrame:
    """(week, keyword, week_idx, tfidf, base_mean, base_std). The idf is of the week, over the surviving keywords.

    tasks: into how many partitions of whole keywords the weeks are dealt; the session's number if none.
    """
    kept = filtered_keywords(freq, min_df, max_df)
    full = dense(freq, kept)
    idf = full.groupBy("week").agg(F.count("*").alias("n"), F.count_if(F.col("count") > 0).alias("df"))
    idf = idf.select("week", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))
    scored = full.join(F.broadcast(idf), "week").withColumn("tfidf", F.col("count") * F.col("idf"))
    scored = scored.repartition(tasks, "keyword") if tasks else scored
    w = Window.partitionBy("keyword").orderBy("week_idx").rowsBetween(1 - long_weeks, 0)
    deviation = F.stddev_pop("tfidf").over(w)
    return scored.select("week", "keyword", "week_idx", "tfidf", F.avg("tfidf").over(w).alias("base_mean"), F.when(deviation > NO_DEVIATION, deviation).alias("base_std"))


def smoothed(df: DataFrame, value: str, span: int = SPAN, short_weeks: int = SHORT_WEEKS, name: str = "ewm") -> DataFrame:
    """df with the exponentially weighted mean of `value` (seeded with the first one), by keyword in order of week_idx.

    y_t = q^t (x_0 + a * sum_{i<=t} x_i q^-i) is a running sum, so no row waits for another in Python. It starts anew with
    every block of weeks within which q^-i stays in the range of a double; what the block before ended with goes on.
    """
    a = 2.0 / (span + 1)
    by = Window.partitionBy("keyword").orderBy("week_idx")
    short = F.avg(value).over(by.rowsBetween(1 - short_weeks, 0))
    if a >= 1:
        return df.withColumn(name, short)
    q = 1 - a
    size = max(1, int(250 / -math.log10(q)))
    placed = df.withColumn("_t", F.row_number().over(by) - 1).withColumn("_x", short)
    placed = placed.withColumn("_b", F.floor(F.col("_t") / size)).withColumn("_r", F.col("_t") % size)
    part = F.when(F.col("_t") == 0, F.col("_x")).otherwise(a * F.col("_x") * F.pow(F.lit(1 / q), F.col("_r")))
    within = Window.partitionBy("keyword", "_b").orderBy("week_idx").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("_y", F.sum(part).over(within) * F.pow(F.lit(q), F.col("_r")))
    ended = F.last(F.when(F.col("_r") == size - 1, F.col("_y")), ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))
    carried = F.coalesce(ended, F.lit(0.0)) * F.pow(F.lit(q), F.col("_r") + 1)
    return placed.withColumn(name, F.col("_y") + carried).drop("_t", "_x", "_b", "_r", "_y")


def z_scores(base: DataFrame, weekly: DataFrame, span: int = SPAN, short_weeks: int = SHORT_WEEKS) -> DataFrame:
    """(week, keyword, z_score, sources); z is 0 where the baseline has no deviation."""
    scored = smoothed(base, "tfidf", span, short_weeks).withColumn("z_score", F.coalesce((F.col("ewm") - F.col("base_mean")) / F.col("base_std"), F.lit(0.0)))
    return scored.join(sources(weekly), ["week", "keyword"], "left").select("week", "keyword", "z_score", F.coalesce("sources", F.lit("unknown")).alias("sources"))


def high(z: DataFrame, threshold: float = HIGH_Z) -> DataFrame:
    return z.where(F.col("z_score") >= threshold)
