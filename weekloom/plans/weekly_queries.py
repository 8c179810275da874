"""Queries over the weekly tables: frequencies, baselines, spikes, signals and lifecycles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekloom.functions import dates, text
from weekloom.operators import lifecycle, signals, weekly
from weekloom.plans.registry import define, query
from weekloom.plans.stages import stage
from weekloom.sources import tables

R = 6  # places to which compared doubles are rounded

define("weekly_keywords", "SELECT strftime(l_shipdate, '%G-W%V') AS week, p_name || ' ' || p_brand AS keyword, s_name AS source, CAST(sum(l_quantity) AS INTEGER) AS count FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL")
define("freq", "SELECT week, keyword, CAST(sum(count) AS INTEGER) AS count FROM weekly_keywords GROUP BY ALL", "weekly_keywords")
define("week_dim", "SELECT week, CAST(row_number() OVER (ORDER BY week) AS INTEGER) AS week_idx FROM (SELECT DISTINCT week FROM freq)", "freq")
define("kw_df", "SELECT keyword, count(DISTINCT week) AS df, (SELECT count(*) FROM week_dim) AS n FROM freq WHERE count > 0 GROUP BY keyword", "freq", "week_dim")
define("kw_low", "SELECT keyword, df, df <= greatest(greatest(1, least(50, n)), greatest(1, CAST(floor(CAST(0.7 AS DOUBLE) * n) AS BIGINT))) AS inside FROM kw_df WHERE df >= greatest(1, least(50, n))", "kw_df")
define("kw_kept", "SELECT keyword, df FROM kw_low WHERE inside OR NOT (SELECT coalesce(bool_or(inside), false) FROM kw_low)", "kw_low")
define("dense", "SELECT k.keyword, w.week, w.week_idx, coalesce(f.count, 0) AS count FROM kw_kept k CROSS JOIN week_dim w LEFT JOIN freq f ON f.keyword = k.keyword AND f.week = w.week", "kw_kept", "week_dim", "freq")
define("idf", "SELECT week, ln(CAST(1 + count(*) AS DOUBLE) / (1 + count(*) FILTER (WHERE count > 0))) + 1 AS idf FROM dense GROUP BY week", "dense")
define("base", """SELECT d.week, d.keyword, d.week_idx, d.count * i.idf AS tfidf,
  avg(d.count * i.idf) OVER w AS base_mean,
  CASE WHEN stddev_pop(d.count * i.idf) OVER w > 1e-9 THEN stddev_pop(d.count * i.idf) OVER w END AS base_std
  FROM dense d JOIN idf i ON i.week = d.week WINDOW w AS (PARTITION BY d.keyword ORDER BY d.week_idx ROWS BETWEEN 103 PRECEDING AND CURRENT ROW)""", "dense", "idf")
define("series", "SELECT keyword, list(tfidf ORDER BY week_idx) AS xs FROM base GROUP BY keyword", "base")
define("ewm", """SELECT keyword, unnest(range(1, len(xs) + 1)) AS week_idx, unnest(list_transform(range(1, len(xs) + 1), lambda t: list_reduce(xs[1:t], lambda y, x: CAST(0.4 AS DOUBLE) * x + CAST(0.6 AS DOUBLE) * y))) AS ewm FROM series""", "series")
define("sources", "SELECT week, keyword, string_agg(DISTINCT source, '|' ORDER BY source) AS sources FROM weekly_keywords GROUP BY ALL", "weekly_keywords")
define("z", """SELECT b.week, b.keyword, coalesce((e.ewm - b.base_mean) / b.base_std, 0.0) AS z_score, coalesce(s.sources, 'unknown') AS sources
  FROM base b JOIN ewm e ON e.keyword = b.keyword AND e.week_idx = b.week_idx LEFT JOIN sources s ON s.week = b.week AND s.keyword = b.keyword""", "base", "ewm", "sources")

define("spike_weeks", "SELECT DISTINCT keyword, CAST(week[1:4] AS INTEGER) AS year, CAST(week[7:8] AS INTEGER) AS nr FROM z WHERE z_score >= 1.0", "z")

define("top5", "SELECT week, keyword FROM (SELECT *, row_number() OVER (PARTITION BY week ORDER BY round(z_score, 9) DESC, keyword) AS place FROM z) WHERE place <= 5", "z")


_SOURCES = "lineitem", "part", "supplier"


def facts(spark: SparkSession, d: str) -> DataFrame:
    return stage(spark, d, "weekly_keywords", tables.weekly_keywords, *_SOURCES)


def freq(spark: SparkSession, d: str) -> DataFrame:
    return stage(spark, d, "weekly_keyword_freq", lambda s, f: weekly.frequencies(tables.dealt(facts(s, f), "week", "keyword")), *_SOURCES)


def base(spark: SparkSession, d: str) -> DataFrame:
    return stage(spark, d, "base_calculation", lambda s, f: weekly.baseline(freq(s, f), tasks=tables.tasks_for(freq(s, f))), *_SOURCES)


def z(spark: SparkSession, d: str) -> DataFrame:
    return stage(spark, d, "z_score_keywords", lambda s, f: weekly.z_scores(tables.dealt(base(s, f), "keyword"), facts(s, f)), *_SOURCES)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, R) for c in columns})


@query("scl20_iso_weeks", "SELECT DISTINCT CAST(l_shipdate AS DATE) AS day, strftime(l_shipdate, '%G-W%V') AS week FROM lineitem")
def iso_weeks(spark, d):
    return tables.table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("day")).distinct().withColumn("week", dates.iso_week(F.col("day")))


@query("scl21_week_days", """SELECT DISTINCT strftime(ts, '%G-W%V') AS week, CAST(date_trunc('week', ts) AS DATE) AS monday, CAST(date_trunc('week', ts) + INTERVAL 6 DAY AS DATE) AS sunday,
  array_to_string([strftime(date_trunc('week', ts) + to_days(CAST(i AS INTEGER)), '%Y%m%d') for i in range(7)], ',') AS days FROM (SELECT ts FROM events UNION ALL SELECT l_shipdate FROM lineitem)""")
def week_days(spark, d):
    days = tables.table(spark, d, "events").select("ts").union(tables.table(spark, d, "lineitem").select("l_shipdate"))
    week = F.col("week")
    return days.select(dates.iso_week(F.col("ts").cast("date")).alias("week")).distinct().select("week", dates.monday(week).alias("monday"), dates.sunday(week).alias("sunday"), F.array_join(dates.days_of(week), ",").alias("days"))


@query("scl22_weeks_in_range", "SELECT DISTINCT strftime(x, '%G-W%V') AS week FROM (SELECT unnest(generate_series(date_trunc('week', min(o_orderdate)), date_trunc('week', max(o_orderdate)), INTERVAL 7 DAY)) AS x FROM orders)")
def weeks_in_range(spark, d):
    bounds = tables.table(spark, d, "orders").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    return bounds.select(F.explode(dates.weeks_between(F.col("a"), F.col("b"))).alias("week"))


@query("src22_date_chunks", "SELECT CAST(x AS DATE) AS start_day, CAST(least(x + INTERVAL 29 DAY, b) AS DATE) AS end_day FROM (SELECT unnest(generate_series(a, b, INTERVAL 30 DAY)) AS x, b FROM (SELECT date_trunc('day', min(o_orderdate)) AS a, date_trunc('day', max(o_orderdate)) AS b FROM orders))")
def date_chunks(spark, d):
    bounds = tables.table(spark, d, "orders").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    return bounds.select(F.explode(dates.date_chunks(F.col("a"), F.col("b"), 30)).alias("c")).select(F.col("c.start").alias("start_day"), F.col("c.end").alias("end_day"))


@query("src23_week_blocks", "SELECT week, CAST(floor((row_number() OVER (ORDER BY week) - 1) / 13) AS INTEGER) AS block FROM (SELECT DISTINCT week FROM freq)", "freq")
def week_blocks(spark, d):
    return weekly.week_index(freq(spark, d)).select("week", F.floor((F.col("week_idx") - 1) / 13).cast("int").alias("block"))


@query("scl23_gap_weeks", "SELECT week, CAST(floor(abs(date_diff('day', CAST(date_trunc('week', strptime(week || '-1', '%G-W%V-%u')) AS DATE), DATE '1994-01-03')) / 7) AS INTEGER) AS gap FROM (SELECT DISTINCT week FROM freq)", "freq")
def gap_weeks(spark, d):
    return freq(spark, d).select("week").distinct().select("week", dates.gap_weeks(F.col("week"), F.lit("1994-W01")).alias("gap"))


@query("src10_weekly_freq_range", "SELECT week, keyword, count FROM freq WHERE week >= '1995-W01' AND week <= '1995-W26'", "freq")
def freq_range(spark, d):
    return freq(spark, d).where(dates.in_weeks(F.col("week"), "1995-W01", "1995-W26"))


@query("agg01_weekly_keywords", "SELECT week, keyword, source, count FROM weekly_keywords", "weekly_keywords")
def agg01(spark, d):
    return facts(spark, d)


@query("agg02_weekly_freq", "SELECT week, keyword, count FROM freq", "freq")
def agg02(spark, d):
    return freq(spark, d)


@query("agg03_sources", "SELECT week, keyword, sources FROM sources", "sources")
def agg03(spark, d):
    return weekly.sources(facts(spark, d))


@query("agg13_document_frequency", "SELECT keyword, count(DISTINCT week) AS df FROM freq WHERE count > 0 GROUP BY keyword", "freq")
def agg13(spark, d):
    return weekly.document_frequencies(freq(spark, d))


@query("flt05_df_band", "SELECT keyword, df FROM kw_kept", "kw_kept")
def flt05(spark, d):
    return weekly.filtered_keywords(freq(spark, d))


@query("set09_densify", "SELECT keyword, week, week_idx, count FROM dense", "dense")
def set09(spark, d):
    f = freq(spark, d)
    return weekly.dense(f, weekly.filtered_keywords(f))


@query("win01_base_calculation", f"SELECT week, keyword, round(tfidf, {R}) AS tfidf, round(base_mean, {R}) AS base_mean, round(base_std, {R}) AS base_std FROM base", "base")
def win01(spark, d):
    return rounded(base(spark, d).drop("week_idx"), "tfidf", "base_mean", "base_std")


@query("win04_ewm", f"SELECT keyword, CAST(week_idx AS INTEGER) AS week_idx, round(ewm, {R}) AS ewm FROM ewm", "ewm")
def win04(spark, d):
    return rounded(weekly.smoothed(base(spark, d), "tfidf").select("keyword", "week_idx", "ewm"), "ewm")


@query("z_score_keywords", f"SELECT week, keyword, round(z_score, {R}) + 0.0 AS z_score, sources FROM z", "z")
def z_score_keywords(spark, d):
    return rounded(z(spark, d), "z_score").withColumn("z_score", F.col("z_score") + 0.0)


@query("flt02_high_z", f"SELECT week, keyword, round(z_score, {R}) AS z_score, sources FROM z WHERE z_score >= 2.0", "z")
def flt02(spark, d):
    return rounded(weekly.high(z(spark, d)), "z_score")


@query("flt03_high_z_threshold", f"SELECT week, keyword, round(z_score, {R}) AS z_score, sources FROM z WHERE z_score >= 1.2", "z")
def flt03(spark, d):
    return rounded(weekly.high(z(spark, d), 1.2), "z_score")


@query("flt04_spikes", "SELECT keyword, week FROM z WHERE z_score >= 1.0", "z")
def flt04(spark, d):
    return weekly.high(z(spark, d), 1.0).select("keyword", "week")


@query("top01_anchors", f"SELECT week, keyword, round(round(z_score, 9), {R}) + 0.0 AS z_score, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY week ORDER BY round(z_score, 9) DESC, keyword) AS INTEGER) AS place FROM z) WHERE place <= 5", "z")
def top01(spark, d):
    scored = z(spark, d).withColumn("z_score", F.round("z_score", 9))
    return lifecycle.ranked(scored).where("place <= 5").select("week", "keyword", (F.round("z_score", R) + 0.0).alias("z_score"), "place")


@query("agg22_seasonality", """SELECT keyword, max(years) AS seas_yrs, any_value(years_observed) AS years_observed, CAST(max(years) AS DOUBLE) / any_value(years_observed) AS ratio,
  min(nr) FILTER (WHERE years = best) AS best_wk, any_value(distinct_weeks) AS distinct_weeks, any_value(n_spikes) AS n_spikes
  FROM (SELECT *, max(years) OVER (PARTITION BY keyword) AS best FROM (
    SELECT a.keyword, a.nr, count(DISTINCT b.year) AS years FROM (SELECT DISTINCT keyword, nr FROM spike_weeks) a JOIN spike_weeks b ON a.keyword = b.keyword AND abs(a.nr - b.nr) <= 1 GROUP BY ALL)
  JOIN (SELECT keyword AS k, count(DISTINCT year) AS years_observed, count(DISTINCT nr) AS distinct_weeks, count(*) AS n_spikes FROM spike_weeks GROUP BY ALL) ON k = keyword) GROUP BY keyword""", "spike_weeks")
def agg22(spark, d):
    return signals.seasonality(weekly.high(z(spark, d), 1.0))


AS_OF = "1997-W26"
define("cands", f"SELECT DISTINCT keyword FROM z WHERE week = '{AS_OF}' AND z_score >= 0.5", "z")
define("lt_weeks", f"SELECT week, CAST(row_number() OVER (ORDER BY week) - 1 AS INTEGER) AS idx, count(*) OVER () AS n FROM (SELECT DISTINCT week FROM z WHERE week <= '{AS_OF}' AND keyword IN (SELECT keyword FROM cands) ORDER BY week DESC LIMIT 156)", "z", "cands")
define("lt_dense", "SELECT c.keyword, w.idx, w.n, coalesce(z.z_score, 0.0) AS x FROM cands c CROSS JOIN lt_weeks w LEFT JOIN z ON z.keyword = c.keyword AND z.week = w.week", "cands", "lt_weeks", "z")
define("lt_rows", """SELECT keyword, any_value(n) AS window_weeks, count(*) FILTER (WHERE x > 0) AS active_weeks, CAST(count(*) FILTER (WHERE x > 0) AS DOUBLE) / any_value(n) AS active_ratio,
  coalesce(avg(x) FILTER (WHERE x > 0), avg(x)) AS mean_z, coalesce(quantile_cont(x, 0.5) FILTER (WHERE x > 0), quantile_cont(x, 0.5)) AS median_z, coalesce(quantile_cont(x, 0.75) FILTER (WHERE x > 0), quantile_cont(x, 0.75)) AS p75_z,
  coalesce(regr_slope(x, idx), 0.0) AS slope, max(x) AS peak_week_z, any_value(n) - 1 - coalesce(max(idx) FILTER (WHERE NOT x > 0), -1) AS consecutive FROM lt_dense GROUP BY keyword""", "lt_dense")
_scaled = lambda c: f"CASE WHEN max({c}) OVER () > min({c}) OVER () THEN ({c} - min({c}) OVER ()) / CAST(max({c}) OVER () - min({c}) OVER () AS DOUBLE) ELSE 0.0 END"
define("lt", f"SELECT *, CAST(0.35 AS DOUBLE) * active_ratio + CAST(0.2 AS DOUBLE) * {_scaled('mean_z')} + CAST(0.15 AS DOUBLE) * {_scaled('p75_z')} + CAST(0.15 AS DOUBLE) * {_scaled('slope')} + CAST(0.15 AS DOUBLE) * {_scaled('consecutive')} AS long_term_score FROM lt_rows", "lt_rows")
define("lt_sel", f"""SELECT '{AS_OF}' AS week, keyword, window_weeks, active_weeks, active_ratio, mean_z, median_z, p75_z, slope, peak_week_z, consecutive, long_term_score, passes_thresholds,
  eligible AND row_number() OVER (PARTITION BY eligible ORDER BY long_term_score DESC, keyword) <= 80 AS selected_for_tracking
  FROM (SELECT *, passes_thresholds OR peak_week_z >= 2.5 AS eligible FROM (SELECT *, active_ratio >= 0.2 AND active_weeks >= 36 AND mean_z >= 0.15 AND p75_z >= 0.5 AND slope >= -0.002 AND long_term_score >= 0.55 AS passes_thresholds FROM lt))""", "lt")


def long_term(spark, d):
    scores = z(spark, d)
    return signals.long_term(scores, signals.candidates(scores, AS_OF, 0.5), AS_OF)


def period(spark, d):
    f = freq(spark, d)
    return signals.period(f, signals.candidates(z(spark, d), AS_OF, 0.5), AS_OF)


_LT = ("active_ratio", "mean_z", "median_z", "p75_z", "slope", "peak_week_z", "long_term_score")


@query("agg16_long_term_signals", f"SELECT week, keyword, CAST(window_weeks AS BIGINT) AS window_weeks, active_weeks, {', '.join(f'round({c}, {R}) + 0.0 AS {c}' for c in _LT)}, CAST(consecutive AS BIGINT) AS consecutive, passes_thresholds, selected_for_tracking FROM lt_sel", "lt_sel")
def agg16(spark, d):
    df = long_term(spark, d)
    return df.withColumns({c: F.round(c, R) + 0.0 for c in _LT} | {c: F.col(c).cast("long") for c in ("window_weeks", "consecutive")})


define("pt_dense", f"""SELECT c.keyword, w.week, w.back, coalesce(f.count, 0)::DOUBLE AS x, -w.back AS idx FROM (SELECT DISTINCT keyword FROM freq WHERE week <= '{AS_OF}' AND keyword IN (SELECT keyword FROM cands)) c
  CROSS JOIN (SELECT week, row_number() OVER (ORDER BY week DESC) - 1 AS back FROM (SELECT DISTINCT week FROM freq WHERE week <= '{AS_OF}' AND keyword IN (SELECT keyword FROM cands))) w LEFT JOIN freq f ON f.keyword = c.keyword AND f.week = w.week""", "freq", "cands")
define("pt_rows", """SELECT keyword, coalesce(max(x) FILTER (WHERE back = 0), 0.0) AS cur, coalesce(max(x) FILTER (WHERE back = 1), 0.0) AS prev, max(x) FILTER (WHERE back = 52) AS year_ago, count(*) FILTER (WHERE back < 13) AS points,
  regr_slope(x, idx) FILTER (WHERE back < 13) AS slope, regr_r2(x, idx) FILTER (WHERE back < 13) AS r2, stddev_pop(x) FILTER (WHERE back < 13) AS spread,
  avg(x) FILTER (WHERE back BETWEEN 1 AND 30) AS base, stddev_pop(x) FILTER (WHERE back BETWEEN 1 AND 30) AS dev, count(*) FILTER (WHERE back BETWEEN 1 AND 30) AS base_n FROM pt_dense GROUP BY keyword""", "pt_dense")
define("pt", f"""SELECT *, CASE WHEN micro AND macro_up THEN 'mixed' WHEN micro OR strong THEN 'short' WHEN macro_up THEN 'long' ELSE 'neutral' END AS label, '{AS_OF}' AS as_of_week FROM (
  SELECT *, wow_7d_pct >= 200 AS micro, macro_beta > 0 AND macro_r2 >= 0.7 AS macro_up, z_baseline >= 2.0 AS strong FROM (
  SELECT keyword, cur AS point_mentions, CASE WHEN prev > 0 THEN (cur - prev) / prev * 100 WHEN cur > 0 THEN 100.0 ELSE 0.0 END AS wow_7d_pct,
  CASE WHEN points >= 4 THEN slope ELSE 0.0 END AS macro_beta, CASE WHEN points >= 4 AND spread > 0 THEN r2 ELSE 0.0 END AS macro_r2, CASE WHEN year_ago > 0 THEN cur / year_ago END AS seasonal_ratio,
  CASE WHEN base_n >= 2 AND dev > 0 THEN (cur - base) / dev ELSE 0.0 END AS z_baseline FROM pt_rows))""", "pt_rows")
_PT = ("point_mentions", "wow_7d_pct", "macro_beta", "macro_r2", "seasonal_ratio", "z_baseline")


@query("agg18_period_trend_signals", f"SELECT keyword, {', '.join(f'round({c}, {R}) + 0.0 AS {c}' for c in _PT)}, micro, macro_up, strong, label, as_of_week FROM pt", "pt")
def agg18(spark, d):
    df = period(spark, d)
    return df.withColumns({c: F.round(c, R) + 0.0 for c in _PT})


# What a week follows: states of a keyword go on from week to week.
define("lc_rows", "SELECT r.keyword, r.week, w.week_idx, r.s AS z, coalesce(f.count, 0) AS n, r.place <= 5 AS anchored FROM (SELECT week, keyword, round(z_score, 9) AS s, row_number() OVER (PARTITION BY week ORDER BY round(z_score, 9) DESC, keyword) AS place FROM z) r JOIN week_dim w ON w.week = r.week LEFT JOIN freq f ON f.week = r.week AND f.keyword = r.keyword WHERE r.keyword IN (SELECT keyword FROM top5)", "z", "week_dim", "freq", "top5")
define("followed", """/*RECURSIVE*/ SELECT DISTINCT keyword, CAST(0 AS INTEGER) AS week_idx, '' AS week, false AS picked, '' AS anchor, CAST(NULL AS VARCHAR) AS status, CAST(0 AS DOUBLE) AS ratio, CAST(0 AS DOUBLE) AS z, CAST(0 AS INTEGER) AS n, CAST(0 AS DOUBLE) AS prev_z, CAST(0 AS INTEGER) AS prev_n, CAST(0 AS INTEGER) AS streak, false AS seen, false AS carried FROM lc_rows
  UNION ALL SELECT keyword, week_idx, week, picked, anchor, CASE WHEN picked THEN now ELSE status END, ratio, z, n, prev_z, prev_n, CASE WHEN picked THEN CASE WHEN now = 'Fading' THEN streak + 1 ELSE 0 END ELSE streak END, seen OR picked, picked AND NOT (now = 'Fading' AND streak + 1 >= 2)
  FROM (SELECT *, CASE WHEN z >= 2.0 AND NOT seen THEN 'Emerging' WHEN z <= 0.8 AND ratio <= 0.4 THEN 'Fading' WHEN ratio >= 0.7 OR (status IN ('Emerging', 'Active') AND n > 0) THEN 'Active' ELSE 'Fading' END AS now FROM (
    SELECT r.keyword, r.week_idx, r.week, r.anchored OR t.carried AS picked, concat_ws('+', CASE WHEN r.anchored THEN 'A' END, CASE WHEN t.carried THEN 'B' END) AS anchor, t.status, CASE WHEN t.n > 0 THEN CAST(r.n AS DOUBLE) / t.n WHEN r.n > 0 THEN 1.0 ELSE 0.0 END AS ratio, r.z, r.n, t.z AS prev_z, t.n AS prev_n, t.streak, t.seen, t.carried
    FROM followed t JOIN lc_rows r ON r.keyword = t.keyword AND r.week_idx = t.week_idx + 1))""", "lc_rows")
define("trend", "SELECT week, keyword, week_idx, anchor, status, CASE status WHEN 'Emerging' THEN 'create_slot' WHEN 'Active' THEN 'update_slot' ELSE 'close_slot_archive' END AS action, status <> 'Fading' AS is_major, z AS z_score, n AS count, prev_n AS prev_count, ratio AS count_ratio, z - prev_z AS delta_z, n - prev_n AS delta_count, streak AS fading_streak, carried FROM followed WHERE picked", "followed")


def trend(spark, d):
    """The weekly time series of followed keywords."""
    rounded_z = lambda s, f: z(s, f).withColumn("z_score", F.round("z_score", 9))
    return stage(spark, d, "trend_timeseries", lambda s, f: lifecycle.lifecycle(rounded_z(s, f), freq(s, f), weekly.week_index(freq(s, f))), *_SOURCES)


@query("sta02_lifecycle", f"SELECT week, keyword, week_idx, anchor, status, action, is_major, round(z_score, {R}) + 0.0 AS z_score, count, prev_count, round(count_ratio, {R}) AS count_ratio, round(delta_z, {R}) + 0.0 AS delta_z, delta_count, fading_streak, carried FROM trend", "trend")
def sta02(spark, d):
    return trend(spark, d).withColumns({"z_score": F.round("z_score", R) + 0.0, "count_ratio": F.round("count_ratio", R), "delta_z": F.round("delta_z", R) + 0.0})


@query("win13_deltas", f"""SELECT week, keyword, count, count - prev AS delta_count, CASE WHEN prev > 0 THEN round(CAST(count AS DOUBLE) / prev, {R}) WHEN count > 0 THEN 1.0 ELSE 0.0 END AS count_ratio FROM (SELECT *, coalesce(lag(count) OVER (PARTITION BY keyword ORDER BY week_idx), 0) AS prev FROM dense)""", "dense")
def win13(spark, d):
    f = freq(spark, d)
    full = weekly.dense(f, weekly.filtered_keywords(f))
    prev = F.coalesce(F.lag("count").over(Window.partitionBy("keyword").orderBy("week_idx")), F.lit(0))
    rows = full.withColumn("prev", prev)
    ratio = F.when(F.col("prev") > 0, F.round(F.col("count") / F.col("prev"), R)).when(F.col("count") > 0, 1.0).otherwise(0.0)
    return rows.select("week", "keyword", "count", (F.col("count") - F.col("prev")).alias("delta_count"), ratio.alias("count_ratio"))


@query("join11_previous_week", "SELECT a.week, a.keyword, a.count, coalesce(b.count, 0) AS prev_count FROM freq a JOIN week_dim w ON w.week = a.week LEFT JOIN week_dim p ON p.week_idx = w.week_idx - 1 LEFT JOIN freq b ON b.week = p.week AND b.keyword = a.keyword", "freq", "week_dim")
def join11(spark, d):
    f = freq(spark, d)
    idx = F.broadcast(weekly.week_index(f).select("week", "week_idx"))
    now = f.join(idx, "week")
    before = now.select("keyword", (F.col("week_idx") + 1).alias("week_idx"), F.col("count").alias("prev_count"))
    return now.join(before, ["keyword", "week_idx"], "left").select("week", "keyword", "count", F.coalesce("prev_count", F.lit(0)).alias("prev_count"))


@query("win15_last_series", "SELECT week, keyword, count FROM (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY week DESC) AS back FROM freq) WHERE back <= 12", "freq")
def win15(spark, d):
    back = F.row_number().over(Window.partitionBy("keyword").orderBy(F.desc("week")))
    return freq(spark, d).withColumn("back", back).where("back <= 12").select("week", "keyword", "count")


@query("agg30_background_vocabulary", f"""SELECT keyword, weeks, round(CAST(weeks AS DOUBLE) / (SELECT count(*) FROM week_dim), {R}) AS wpr, total, round(CAST(total AS DOUBLE) / (SELECT sum(count) FROM freq), 9) AS share FROM (SELECT keyword, count(DISTINCT week) AS weeks, sum(count)::BIGINT AS total FROM freq GROUP BY keyword)""", "freq", "week_dim")
def agg30(spark, d):
    f = freq(spark, d)
    whole = f.agg(F.count_distinct("week").alias("n"), F.sum("count").alias("s"))
    rows = f.groupBy("keyword").agg(F.count_distinct("week").alias("weeks"), F.sum("count").alias("total")).crossJoin(F.broadcast(whole))
    return rows.select("keyword", "weeks", F.round(F.col("weeks") / F.col("n"), R).alias("wpr"), "total", F.round(F.col("total") / F.col("s"), 9).alias("share"))


@query("agg35_audit", "SELECT 'weekly_keyword_freq' AS name, count(*) AS n_rows, min(week) AS first_week, max(week) AS last_week, count(DISTINCT week) AS weeks, count(*) FILTER (WHERE count > 0) * 1.0 / count(*) AS fill FROM freq", "freq")
def agg35(spark, d):
    return freq(spark, d).agg(F.count("*").alias("n_rows"), F.min("week").alias("first_week"), F.max("week").alias("last_week"), F.count_distinct("week").alias("weeks"), (F.count_if(F.col("count") > 0) / F.count("*")).alias("fill")).select(F.lit("weekly_keyword_freq").alias("name"), "n_rows", "first_week", "last_week", "weeks", "fill")


@query("set01_weeks_without_z", "SELECT DISTINCT week FROM weekly_keywords EXCEPT SELECT DISTINCT week FROM z WHERE z_score >= 1.0", "weekly_keywords", "z")
def set01(spark, d):
    return facts(spark, d).select("week").distinct().subtract(weekly.high(z(spark, d), 1.0).select("week"))


@query("set03_anchor_union", """SELECT week, keyword, string_agg(tag, '+' ORDER BY tag) AS anchor FROM (SELECT week, keyword, 'A' AS tag FROM top5 UNION ALL SELECT n.week, t.keyword, 'B' AS tag FROM top5 t JOIN week_dim w ON w.week = t.week JOIN week_dim n ON n.week_idx = w.week_idx + 1) GROUP BY ALL""", "top5", "week_dim")
def set03(spark, d):
    f = freq(spark, d)
    idx = F.broadcast(weekly.week_index(f).select("week", "week_idx"))
    top = lifecycle.ranked(z(spark, d).withColumn("z_score", F.round("z_score", 9))).where("place <= 5").select("week", "keyword").join(idx, "week")
    after = top.select("keyword", (F.col("week_idx") + 1).alias("week_idx"), F.lit("B").alias("tag")).join(idx, "week_idx")
    both = top.select("week", "keyword", F.lit("A").alias("tag")).union(after.select("week", "keyword", "tag"))
    return both.groupBy("week", "keyword").agg(F.concat_ws("+", F.sort_array(F.collect_set("tag"))).alias("anchor"))




@query("scl04_slot_ids", "SELECT DISTINCT keyword, 'slot_' || coalesce(nullif(regexp_replace(lower(keyword), '[^0-9a-z가-힣]+', '', 'g')[1:48], ''), 'unknown') AS slot FROM freq", "freq")
def scl04(spark, d):
    return freq(spark, d).select("keyword").distinct().select("keyword", text.slot_id(F.col("keyword")).alias("slot"))
