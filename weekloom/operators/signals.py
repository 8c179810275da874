"""Long-term and period signals of keywords, and the recurrence of their spikes over years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions import dates

#: Weights of the long-term score, its least values, tracking.
WEIGHTS = {"active_ratio": 0.35, "mean_z": 0.2, "p75_z": 0.15, "slope": 0.15, "consecutive": 0.15}
LEAST = {"active_ratio": 0.2, "active_weeks": 36, "mean_z": 0.15, "p75_z": 0.5, "slope": -0.002, "score": 0.55}
WINDOW_WEEKS, SPIKE_Z, TRACKED = 156, 2.5, 80
#: Jump in percent, regression weeks and bounds, strong momentum.
MICRO, MACRO_WEEKS, MACRO_BETA, MACRO_R2, STRONG = 200.0, 13, 0.0, 0.7, 2.0


def candidates(z: DataFrame, week: str, threshold: float, clustered: DataFrame | None = None, excluded: DataFrame | None = None) -> DataFrame:
    """Keywords of a week that spike or are clustered, without the excluded ones."""
    found = z.where((F.col("week") == week) & (F.col("z_score") >= threshold)).select("keyword")
    if clustered is not None:
        found = found.union(clustered.where(F.col("week") == week).select("keyword"))
    found = found.distinct()
    return found if excluded is None else found.join(excluded.select("keyword"), "keyword", "left_anti")


def _dense(history: DataFrame, value: str, last: int | None) -> DataFrame:
    """(keyword, idx, n, x): each keyword at each of the last weeks that occur, from 0; a missing value is 0."""
    weeks = history.select("week").distinct().withColumn("back", F.row_number().over(Window.orderBy(F.desc("week"))))
    weeks = weeks.where(F.col("back") <= last) if last else weeks
    weeks = weeks.crossJoin(weeks.agg(F.max("back").alias("n"))).select("week", "n", (F.col("n") - F.col("back")).alias("idx"))
    grid = history.select("keyword").distinct().crossJoin(F.broadcast(weeks))
    known = history.groupBy("keyword", "week").agg(F.max(value).cast("double").alias("x"))
    return grid.join(known, ["keyword", "week"], "left").select("keyword", "idx", "n", F.coalesce("x", F.lit(0.0)).alias("x"))


def _scaled(x: str) -> Column:
    """Min-max over the cohort; 0 where all are alike."""
    return F.when(F.col(f"hi_{x}") > F.col(f"lo_{x}"), (F.col(x) - F.col(f"lo_{x}")) / (F.col(f"hi_{x}") - F.col(f"lo_{x}"))).otherwise(0.0)


def long_term(history: DataFrame, keywords: DataFrame, week: str, window_weeks: int = WINDOW_WEEKS, tracked: int = TRACKED) -> DataFrame:
    """Persistence of keywords over the last weeks up to `week`, their score, and which are tracked."""
    past = history.where(F.col("week") <= week).join(keywords, "keyword", "left_semi")
    full = _dense(past, "z_score", window_weeks)
    on = F.col("x") > 0
    rows = full.groupBy("keyword").agg(
        F.first("n").alias("window_weeks"), F.count_if(on).alias("active_weeks"),
        F.avg(F.when(on, F.col("x"))).alias("mean_on"), F.avg("x").alias("mean_all"),
        F.percentile(F.when(on, F.col("x")), 0.5).alias("median_on"), F.percentile("x", 0.5).alias("median_all"),
        F.percentile(F.when(on, F.col("x")), 0.75).alias("p75_on"), F.percentile("x", 0.75).alias("p75_all"),
        F.coalesce(F.regr_slope("x", "idx"), F.lit(0.0)).alias("slope"), F.max("x").alias("peak_week_z"),
        (F.first("n") - 1 - F.coalesce(F.max(F.when(~on, F.col("idx"))), F.lit(-1))).alias("consecutive"),
    )
    rows = rows.select("keyword", "window_weeks", "active_weeks", (F.col("active_weeks") / F.col("window_weeks")).alias("active_ratio"), F.coalesce("mean_on", "mean_all").alias("mean_z"), F.coalesce("median_on", "median_all").alias("median_z"), F.coalesce("p75_on", "p75_all").alias("p75_z"), "slope", "peak_week_z", "consecutive")
    scaled = ("mean_z", "p75_z", "slope", "consecutive")
    bounds = rows.agg(*(f(c).alias(f"{p}_{c}") for c in scaled for p, f in (("lo", F.min), ("hi", F.max))))
    rows = rows.crossJoin(F.broadcast(bounds))
    score = WEIGHTS["active_ratio"] * F.col("active_ratio")
    for c in scaled:
        score = score + WEIGHTS[c] * _scaled(c)
    rows = rows.withColumn("long_term_score", score).drop(*(f"{p}_{c}" for c in scaled for p in ("lo", "hi")))
    passes = (F.col("active_ratio") >= LEAST["active_ratio"]) & (F.col("active_weeks") >= LEAST["active_weeks"]) & (F.col("mean_z") >= LEAST["mean_z"]) & (F.col("p75_z") >= LEAST["p75_z"]) & (F.col("slope") >= LEAST["slope"]) & (F.col("long_term_score") >= LEAST["score"])
    rows = rows.withColumn("passes_thresholds", passes).withColumn("eligible", F.col("passes_thresholds") | (F.col("peak_week_z") >= SPIKE_Z))
    top = rows.where("eligible").orderBy(F.desc("long_term_score"), "keyword").limit(tracked).select("keyword", F.lit(True).alias("selected"))
    return rows.join(F.broadcast(top), "keyword", "left").select(F.lit(week).alias("week"), *(c for c in rows.columns if c != "eligible"), F.coalesce("selected", F.lit(False)).alias("selected_for_tracking"))


def period(freq: DataFrame, keywords: DataFrame, week: str) -> DataFrame:
    """Jump, trend, season and momentum of keywords at the last week up to `week` that any of them has."""
    past = freq.where(F.col("week") <= week).join(keywords, "keyword", "left_semi")
    full = _dense(past, "count", None)
    back = F.col("n") - 1 - F.col("idx")
    at = lambda k: F.coalesce(F.max(F.when(back == k, F.col("x"))), F.lit(0.0))
    tail = lambda c: F.when(back < MACRO_WEEKS, c)
    before = F.when((back >= 1) & (back <= 30), F.col("x"))
    rows = full.groupBy("keyword").agg(
        at(0).alias("cur"), at(1).alias("prev"), F.max(F.when(back == 52, F.col("x"))).alias("year_ago"),
        F.count(tail(F.col("x"))).alias("points"), F.regr_slope(tail(F.col("x")), tail(F.col("idx"))).alias("slope"), F.regr_r2(tail(F.col("x")), tail(F.col("idx"))).alias("r2"),
        F.stddev_pop(tail(F.col("x"))).alias("spread"), F.avg(before).alias("base"), F.stddev_pop(before).alias("base_dev"), F.count(before).alias("base_n"),
    )
    some = F.col("points") >= 4
    rows = rows.select(
        "keyword", F.col("cur").alias("point_mentions"),
        F.when(F.col("prev") > 0, (F.col("cur") - F.col("prev")) / F.col("prev") * 100).when(F.col("cur") > 0, 100.0).otherwise(0.0).alias("wow_7d_pct"),
        F.when(some, F.col("slope")).otherwise(0.0).alias("macro_beta"), F.when(some & (F.col("spread") > 0), F.col("r2")).otherwise(0.0).alias("macro_r2"),
        F.when(F.col("year_ago") > 0, F.col("cur") / F.col("year_ago")).alias("seasonal_ratio"),
        F.when((F.col("base_n") >= 2) & (F.col("base_dev") > 0), (F.col("cur") - F.col("base")) / F.col("base_dev")).otherwise(0.0).alias("z_baseline"),
    )
    rows = rows.withColumns({"micro": F.col("wow_7d_pct") >= MICRO, "macro_up": (F.col("macro_beta") > MACRO_BETA) & (F.col("macro_r2") >= MACRO_R2), "strong": F.col("z_baseline") >= STRONG})
    label = F.when(F.col("micro") & F.col("macro_up"), "mixed").when(F.col("micro") | F.col("strong"), "short").when(F.col("macro_up"), "long").otherwise("neutral")
    return rows.withColumn("label", label).withColumn("as_of_week", F.lit(week))


def seasonality(spikes: DataFrame, tolerance: int = 1) -> DataFrame:
    """Per keyword of (week, keyword): most years that share a week of the year within the tolerance, of all its years."""
    seen = spikes.select("keyword", dates.week_year(F.col("week")).alias("year"), dates.week_number(F.col("week")).alias("nr")).distinct()
    # Each spike counts for the 2 * tolerance + 1 weeks around it: an equi-join on the week instead of a self join on ranges.
    weeks = seen.select("keyword", "nr").distinct()
    near = seen.withColumn("nr", F.explode(F.sequence(F.col("nr") - tolerance, F.col("nr") + tolerance)))
    years = near.join(weeks, ["keyword", "nr"]).groupBy("keyword", "nr").agg(F.count_distinct("year").alias("years"))
    best = years.groupBy("keyword").agg(F.max(F.struct("years", (-F.col("nr")).alias("back"))).alias("best"))
    whole = seen.groupBy("keyword").agg(F.count_distinct("year").alias("years_observed"), F.count_distinct("nr").alias("distinct_weeks"), F.count("*").alias("n_spikes"))
    joined = best.join(whole, "keyword")
    return joined.select("keyword", F.col("best.years").alias("seas_yrs"), "years_observed", (F.col("best.years") / F.col("years_observed")).alias("ratio"), (-F.col("best.back")).alias("best_wk"), "distinct_weeks", "n_spikes")


def seasonal_classes(found: DataFrame, years: int = 3, ratio: float = 0.6) -> DataFrame:
    rows = found.where((F.col("seas_yrs") >= years) & (F.col("ratio") >= ratio))
    return rows.select("keyword", F.lit("seasonal").alias("class"), F.col("ratio").alias("score"), F.lit("recurrence").alias("method"), F.to_json(F.struct("seas_yrs", "years_observed", "best_wk")).alias("detail"))
