"""Queries of the dashboard: threads and clusters side by side, trends, groups, products, exclusions, range reads."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weekloom import session
from weekloom.functions import dates, vectors
from weekloom.operators import similar, threads
from weekloom.plans.registry import define, query
from weekloom.plans.stages import stage
from weekloom.plans.vector_queries import clusters as weekly_clusters
from weekloom.plans.vector_queries import vec
from weekloom.plans.view_queries import article_words, cluster_keywords, ctx, keyword_class
from weekloom.plans.view_queries import clusters as keyword_clusters
from weekloom.plans.weekly_queries import AS_OF, R, facts, freq, long_term, period, trend, z
from weekloom.sources import sinks, tables

_SOURCES = "lineitem", "part", "supplier"

# Threads: weekly clusters of one label, with their keywords, weights and centroids, as the linker links them.
define("tc", "SELECT week, CAST(label AS INTEGER) AS cluster_id, CAST(count(*) AS INTEGER) AS weight, 't' || label AS label, ['k' || label, 'k' || ((label + 1) % 10), 'w' || week[7:8] || '-' || label] AS keywords FROM vec GROUP BY week, label", "vec")
define("threads", "SELECT thread AS thread_id, week, cluster_id, seq FROM link_walk WHERE nr > 0", "link_walk")
define("thread_meta", "SELECT thread_id, count(*) AS n_weeks, min(t.week) AS start_week, max(t.week) AS end_week, max(weight) AS peak_weight, CASE WHEN count(*) = 1 THEN 'single' ELSE 'multi' END AS kind FROM threads t JOIN tc ON tc.week = t.week AND tc.cluster_id = t.cluster_id WHERE thread_id < 8 GROUP BY thread_id", "threads", "tc")


def tc(spark, d):
    return stage(spark, d, "weekly_trend_clusters", weekly_clusters, "embeddings")


def thread_rows(spark, d):
    """The weekly clusters as the linker links them."""
    return stage(spark, d, "threads", lambda s, f: threads.link(tc(s, f)), "embeddings").select("thread_id", "week", "cluster_id", "seq")


def thread_meta(spark, d):
    """Meta rows of threads; those numbered 8 and 9 have none, as after an incomplete run."""
    rows = thread_rows(spark, d).where("thread_id < 8").join(tc(spark, d).select("week", "cluster_id", "weight"), ["week", "cluster_id"])
    return rows.groupBy("thread_id").agg(F.count("*").alias("n_weeks"), F.min("week").alias("start_week"), F.max("week").alias("end_week"), F.max("weight").alias("peak_weight"), F.when(F.count("*") == 1, "single").otherwise("multi").alias("kind"))


@query("join08_thread_display", "SELECT t.thread_id, m.kind, t.seq, t.week, c.weight, c.label FROM threads t JOIN tc c ON c.week = t.week AND c.cluster_id = t.cluster_id LEFT JOIN thread_meta m ON m.thread_id = t.thread_id", "threads", "tc", "thread_meta")
def join08(spark, d):
    shown = thread_rows(spark, d).join(tc(spark, d).select("week", "cluster_id", "weight", "label"), ["week", "cluster_id"])
    return shown.join(thread_meta(spark, d).select("thread_id", "kind"), "thread_id", "left").select("thread_id", "kind", "seq", "week", "weight", "label")


@query("join09_threads_in_range", "SELECT t.thread_id, t.seq, array_to_string(c.keywords, ', ') AS top_keywords, c.weight FROM threads t JOIN tc c ON c.week = t.week AND c.cluster_id = t.cluster_id WHERE t.week BETWEEN '2024-W02' AND '2024-W06'", "threads", "tc")
def join09(spark, d):
    inside = F.col("week").between("2024-W02", "2024-W06")
    return thread_rows(spark, d).where(inside).join(tc(spark, d).where(inside), ["week", "cluster_id"]).select("thread_id", "seq", F.array_join("keywords", ", ").alias("top_keywords"), "weight")


@query("join10_meta_without_range", "SELECT * FROM thread_meta WHERE thread_id NOT IN (SELECT DISTINCT thread_id FROM threads WHERE week BETWEEN '2024-W01' AND '2024-W02')", "threads", "thread_meta")
def join10(spark, d):
    return sinks.without(thread_meta(spark, d), thread_rows(spark, d).where(F.col("week").between("2024-W01", "2024-W02")), ["thread_id"])


@query("join19_dashboard", "SELECT m.thread_id, m.kind, m.n_weeks, count(*) AS points, CAST(sum(c.weight) AS BIGINT) AS total_weight, string_agg(c.week || '=' || c.weight, ' ' ORDER BY c.week) AS path FROM thread_meta m JOIN threads t ON t.thread_id = m.thread_id JOIN tc c ON c.week = t.week AND c.cluster_id = t.cluster_id GROUP BY m.thread_id, m.kind, m.n_weeks", "threads", "tc", "thread_meta")
def join19(spark, d):
    """Threads with their clusters; metas without a member, and members without a meta, don't show."""
    rows = thread_rows(spark, d).join(tc(spark, d).select("week", "cluster_id", "weight"), ["week", "cluster_id"]).join(thread_meta(spark, d).select("thread_id", "kind", "n_weeks"), "thread_id")
    path = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("week", "weight"))), lambda s: F.concat(s["week"], F.lit("="), s["weight"].cast("string"))), " ")
    return rows.groupBy("thread_id", "kind", "n_weeks").agg(F.count("*").alias("points"), F.sum("weight").alias("total_weight"), path.alias("path"))


define("quality_steps", "SELECT t.thread_id, t.seq, c.keywords, c.weight, lag(c.keywords) OVER (PARTITION BY t.thread_id ORDER BY t.seq) AS was FROM threads t JOIN tc c ON c.week = t.week AND c.cluster_id = t.cluster_id", "threads", "tc")
define("quality_threads", "SELECT thread_id, count(*) AS n, avg(CAST(len(list_intersect(keywords, was)) AS DOUBLE) / len(list_distinct(list_concat(keywords, was)))) FILTER (WHERE was IS NOT NULL) AS j, max(weight) AS peak, count(*) FILTER (WHERE list_contains(keywords, 'k3')) AS anchored FROM quality_steps GROUP BY thread_id", "quality_steps")
define("quality_all", "SELECT count(*) AS threads, count(*) FILTER (WHERE n > 1) AS multi_threads, coalesce(sum(j * peak) FILTER (WHERE n > 1) / sum(peak) FILTER (WHERE n > 1), 0.0) AS coherence, coalesce(avg(CAST(anchored AS DOUBLE) / n) FILTER (WHERE anchored > 0 AND n > 1), 0.0) AS anchor_purity, count(*) FILTER (WHERE anchored > 0) AS anchor_threads, CAST(count(*) FILTER (WHERE n = 1) AS DOUBLE) / count(*) AS single_rate FROM quality_threads", "quality_threads")
define("quality_labels", "SELECT CAST(count(DISTINCT label) AS DOUBLE) / count(*) AS label_div, avg(len(string_split(label, ' '))) AS avg_label_tokens FROM tc", "tc")


@query("agg32_thread_quality", "SELECT threads, multi_threads, anchor_threads, round(coherence, 4) AS coherence, round(anchor_purity, 4) AS anchor_purity, round(label_div, 4) AS label_div, round(single_rate, 4) AS single_rate, round(0.45 * coherence + 0.35 * anchor_purity + 0.2 * label_div - greatest(0.0, single_rate - 0.6) * 0.2, 4) AS overall, round(avg_label_tokens, 4) AS avg_label_tokens FROM quality_all CROSS JOIN quality_labels", "quality_all", "quality_labels")
def agg32(spark, d):
    rows = thread_rows(spark, d).join(tc(spark, d).select("week", "cluster_id", "weight", "keywords"), ["week", "cluster_id"])
    return threads.quality(rows, tc(spark, d).select("label"), ["k3"])


@query("msc02_clusters_range", "SELECT week, cluster_id, weight, label FROM tc WHERE week BETWEEN '2024-W03' AND '2024-W05' ORDER BY week, weight DESC, cluster_id", "tc")
def msc02(spark, d):
    return tc(spark, d).where(F.col("week").between("2024-W03", "2024-W05")).orderBy("week", F.desc("weight"), "cluster_id").select("week", "cluster_id", "weight", "label")


@query("api09_cluster_display", "SELECT week, cluster_id, weight, label, array_to_string(keywords, ', ') AS keywords, m.kind FROM tc JOIN threads t USING (week, cluster_id) LEFT JOIN thread_meta m ON m.thread_id = t.thread_id WHERE week = '2024-W04'", "tc", "threads", "thread_meta")
def api09(spark, d):
    """The clusters of a week as the reader shows them, with the kind of their thread."""
    rows = tc(spark, d).where("week = '2024-W04'").select("week", "cluster_id", "weight", "label", F.array_join("keywords", ", ").alias("keywords"))
    linked = rows.join(thread_rows(spark, d).select("week", "cluster_id", "thread_id"), ["week", "cluster_id"])
    return linked.join(thread_meta(spark, d).select("thread_id", "kind"), "thread_id", "left").select("week", "cluster_id", "weight", "label", "keywords", "kind")


@query("src17_replaced_threads", "SELECT thread_id, week, seq, replaced, m.kind FROM (SELECT thread_id, week, seq, false AS replaced FROM threads WHERE week NOT BETWEEN '2024-W03' AND '2024-W05' UNION ALL SELECT thread_id + 100, week, seq, true FROM threads WHERE week BETWEEN '2024-W03' AND '2024-W05' AND thread_id % 2 = 0) r LEFT JOIN (SELECT * FROM thread_meta WHERE thread_id NOT IN (SELECT thread_id FROM threads WHERE week BETWEEN '2024-W03' AND '2024-W05')) m USING (thread_id)", "threads", "thread_meta")
def src17(spark, d):
    """Members of a range of weeks replaced by a new run; metas of threads that had a member there go."""
    old = thread_rows(spark, d).select("thread_id", "week", "seq")
    inside = F.col("week").between("2024-W03", "2024-W05")
    new = old.where(inside & (F.col("thread_id") % 2 == 0)).withColumn("thread_id", F.col("thread_id") + 100)
    members, meta = sinks.replaced_range(old.withColumn("replaced", F.lit(False)), new.withColumn("replaced", F.lit(True)), thread_meta(spark, d), "2024-W03", "2024-W05")
    return members.join(meta.select("thread_id", "kind"), "thread_id", "left").select("thread_id", "week", "seq", "replaced", "kind")


# Trends of a week.
@query("flt16_trends_by_status", f"SELECT week, keyword, status, round(z_score, {R}) + 0.0 AS trend_strength FROM trend WHERE week = '1996-W20' AND status = 'Active' ORDER BY z_score DESC, keyword", "trend")
def flt16(spark, d):
    return trends_of(trend(spark, d), "1996-W20", "Active")


def trends_of(rows, week, status=None):
    """The trends of a week, of one status or all."""
    found = rows.where(F.col("week") == week)
    found = found if status is None else found.where(F.col("status") == status)
    return found.orderBy(F.desc_nulls_last("z_score"), "keyword").select("week", "keyword", "status", (F.round("z_score", R) + 0.0).alias("trend_strength"))


@query("api04_trends", f"SELECT week, keyword, status, round(z_score, {R}) + 0.0 AS trend_strength FROM trend WHERE week = '1996-W20'", "trend")
def api04(spark, d):
    return trends_of(trend(spark, d), "1996-W20")


@query("api07_range_lifecycle", "SELECT week, status, count(*) AS n FROM trend WHERE week BETWEEN '1996-W10' AND '1996-W20' GROUP BY ALL", "trend")
def api07(spark, d):
    low, high = sorted(("1996-W20", "1996-W10"))  # bounds may come reversed
    return trend(spark, d).where(F.col("week").between(low, high)).groupBy("week", "status").agg(F.count("*").alias("n"))


# Groups: a week's clustered keywords, scored.
define("groups", f"SELECT week, cluster_id, sum_z, sum_count, round(0.35 * sum_z + 0.2 * sqrt(CAST(sum_count + 1 AS DOUBLE)), {R}) AS group_score, CAST(row_number() OVER (PARTITION BY week ORDER BY round(0.35 * sum_z + 0.2 * sqrt(CAST(sum_count + 1 AS DOUBLE)), {R}) DESC, cluster_id) AS INTEGER) AS group_rank, keywords FROM (SELECT k.week, k.cluster_id, sum(greatest(round(k.z_score, 9), 0)) AS sum_z, sum(coalesce(f.count, 0)) AS sum_count, string_agg(k.keyword, '|' ORDER BY k.keyword) AS keywords FROM cluster_keywords k LEFT JOIN freq f ON f.week = k.week AND f.keyword = k.keyword GROUP BY k.week, k.cluster_id)", "cluster_keywords", "freq")


def groups(spark, d):
    """Groups of a week by 0.35 * sum of positive z + 0.2 * sqrt(count + 1), numbered by score."""

    def make(s, f):
        rows = cluster_keywords(z(s, f)).join(freq(s, f), ["week", "keyword"], "left").groupBy("week", "cluster_id")
        rows = rows.agg(F.sum(F.greatest(F.round("z_score", 9), F.lit(0.0))).alias("sum_z"), F.sum(F.coalesce("count", F.lit(0))).alias("sum_count"), F.concat_ws("|", F.sort_array(F.collect_list("keyword"))).alias("keywords"))
        scored = rows.withColumn("group_score", F.round(0.35 * F.col("sum_z") + 0.2 * F.sqrt(F.col("sum_count") + 1), R))
        return scored.withColumn("group_rank", F.row_number().over(Window.partitionBy("week").orderBy(F.desc("group_score"), "cluster_id")))

    return stage(spark, d, "trend_groups", make, *_SOURCES)


@query("agg29_group_metrics", f"SELECT week, cluster_id, round(sum_z, {R}) AS sum_z, CAST(sum_count AS BIGINT) AS sum_count, group_score, keywords FROM groups", "groups")
def agg29(spark, d):
    return groups(spark, d).select("week", "cluster_id", F.round("sum_z", R).alias("sum_z"), "sum_count", "group_score", "keywords")


@query("win14_group_ranks", "SELECT week, group_rank, week || '_g' || group_rank AS group_id, cluster_id FROM groups", "groups")
def win14(spark, d):
    return groups(spark, d).select("week", "group_rank", F.concat("week", F.lit("_g"), F.col("group_rank").cast("string")).alias("group_id"), "cluster_id")


@query("top06_solo_groups", "SELECT week, CASE WHEN group_rank <= 2 THEN week || '_g' || group_rank ELSE week || '_solo_' || regexp_replace(lower(k), '[^0-9a-z가-힣]+', '', 'g')[1:24] END AS group_id, k AS keyword FROM (SELECT week, group_rank, unnest(string_split(keywords, '|')) AS k FROM groups)", "groups")
def top06(spark, d):
    """The two best groups of a week stay; every keyword of the others is a group of its own."""
    from weekloom.functions import text

    rows = groups(spark, d).select("week", "group_rank", F.explode(F.split("keywords", r"\|")).alias("keyword"))
    solo = F.concat("week", F.lit("_solo_"), F.substring(text.normalise_keyword(F.col("keyword")), 1, 24))
    return rows.select("week", F.when(F.col("group_rank") <= 2, F.concat("week", F.lit("_g"), F.col("group_rank").cast("string"))).otherwise(solo).alias("group_id"), "keyword")


@query("sta04_slot_inheritance", "SELECT week, cluster_id, slot FROM (SELECT g.week, g.cluster_id, w.week_idx - row_number() OVER (PARTITION BY g.cluster_id ORDER BY w.week_idx) AS run, w.week_idx FROM groups g JOIN week_dim w ON w.week = g.week) x JOIN (SELECT cluster_id, run, 'trendgrp_' || lpad(CAST(row_number() OVER (ORDER BY first_idx, cluster_id) AS VARCHAR), 6, '0') AS slot FROM (SELECT cluster_id, run, min(week_idx) AS first_idx FROM (SELECT g.cluster_id, w.week_idx, w.week_idx - row_number() OVER (PARTITION BY g.cluster_id ORDER BY w.week_idx) AS run FROM groups g JOIN week_dim w ON w.week = g.week) GROUP BY ALL)) s USING (cluster_id, run)", "groups", "week_dim")
def sta04(spark, d):
    """A group linked to one of the week before keeps its slot; others open the next one."""
    from weekloom.functions import text
    from weekloom.operators import weekly

    rows = groups(spark, d).select("week", "cluster_id").join(F.broadcast(weekly.week_index(freq(spark, d)).select("week", "week_idx")), "week")
    run = F.col("week_idx") - F.row_number().over(Window.partitionBy("cluster_id").orderBy("week_idx"))
    rows = rows.withColumn("run", run)
    first = rows.groupBy("cluster_id", "run").agg(F.min("week_idx").alias("first_idx"))
    # Numbers by week first and then within the week, so that no task sorts all slots.
    opened = first.groupBy("first_idx").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("first_idx").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("first_idx").orderBy("cluster_id"))
    numbered = first.withColumn("nr", within).join(F.broadcast(opened.select("first_idx", before.alias("before"))), "first_idx")
    slots = numbered.select("cluster_id", "run", text.group_id((F.col("before") + F.col("nr")).cast("int")).alias("slot"))
    return rows.join(slots, ["cluster_id", "run"]).select("week", "cluster_id", "slot")


@query("api05_groups", f"SELECT g.week, g.group_rank, g.group_score, g.keywords, t.n AS followed FROM groups g LEFT JOIN (SELECT week, count(*) AS n FROM trend GROUP BY week) t ON t.week = g.week WHERE g.week = '{AS_OF}' ORDER BY group_rank", "groups", "trend")
def api05(spark, d):
    followed = trend(spark, d).where(F.col("week") == AS_OF).groupBy("week").agg(F.count("*").alias("followed"))
    return groups(spark, d).where(F.col("week") == AS_OF).join(followed, "week", "left").orderBy("group_rank").select("week", "group_rank", "group_score", "keywords", "followed")


@query("agg12_group_keywords", f"SELECT k AS keyword, max(group_score) AS best_score, count(*) AS n FROM (SELECT group_score, unnest(string_split(keywords, '|')) AS k FROM groups) GROUP BY k", "groups")
def agg12_groups(spark, d):
    return groups(spark, d).select("group_score", F.explode(F.split("keywords", r"\|")).alias("keyword")).groupBy("keyword").agg(F.max("group_score").alias("best_score"), F.count("*").alias("n"))


# Products: the best-selling keywords of a week, with a report.
define("products", "SELECT week, CAST(rank AS INTEGER) AS rank, keyword AS name, 'sold ' || count AS reason FROM (SELECT *, row_number() OVER (PARTITION BY week ORDER BY count DESC, keyword) AS rank FROM freq) WHERE rank <= 5", "freq")


def products(spark, d):
    rank = F.row_number().over(Window.partitionBy("week").orderBy(F.desc("count"), "keyword"))
    return freq(spark, d).withColumn("rank", rank).where("rank <= 5").select("week", "rank", F.col("keyword").alias("name"), F.concat(F.lit("sold "), F.col("count").cast("string")).alias("reason"))


@query("api03_recommendations", "SELECT p.week, p.rank, p.name, p.reason, r.report FROM products p LEFT JOIN (SELECT week, count(*) || ' products, first ' || min_by(name, rank) AS report FROM products GROUP BY week) r ON r.week = p.week WHERE p.week = '1996-W10' ORDER BY p.rank", "products")
def api03(spark, d):
    rows = products(spark, d).where("week = '1996-W10'")
    report = rows.groupBy("week").agg(F.concat(F.count("*").cast("string"), F.lit(" products, first "), F.min_by("name", "rank")).alias("report"))
    return rows.join(report, "week", "left").orderBy("rank").select("week", "rank", "name", "reason", "report")


@query("msc05_products_of_week", "SELECT week, rank, name FROM products WHERE week BETWEEN '1996-W08' AND '1996-W10' ORDER BY week, rank", "products")
def msc05(spark, d):
    return products(spark, d).where(F.col("week").between("1996-W08", "1996-W10")).orderBy("week", "rank").select("week", "rank", "name")


@query("api08_enrichment", f"SELECT part, count(*) AS n FROM (SELECT 'clusters' AS part FROM clusters WHERE week = '{AS_OF}' UNION ALL SELECT 'keywords' FROM cluster_keywords WHERE week = '{AS_OF}' UNION ALL SELECT 'long_term' FROM lt_sel UNION ALL SELECT 'period' FROM pt UNION ALL SELECT 'products' FROM products WHERE week = '{AS_OF}') GROUP BY part", "clusters", "cluster_keywords", "lt_sel", "pt", "products")
def api08(spark, d):
    """How many rows each part of the enrichment of a week has."""
    members = cluster_keywords(z(spark, d)).where(F.col("week") == AS_OF)
    parts = {"clusters": keyword_clusters(members), "keywords": members, "long_term": long_term(spark, d), "period": period(spark, d), "products": products(spark, d).where(F.col("week") == AS_OF)}
    out = None
    for name, rows in parts.items():
        one = rows.select(F.lit(name).alias("part"))
        out = one if out is None else out.unionAll(one)
    return out.groupBy("part").agg(F.count("*").alias("n"))


# Exclusions.
@query("api11_exclusions", "SELECT keyword, CASE WHEN keyword LIKE 'red%' THEN 'twice' ELSE 'once' END AS reason FROM exclusions WHERE keyword NOT LIKE '%green%'", "exclusions")
def api11(spark, d):
    """A list of excluded keywords: some are put in again with another reason (the last one stays), some are taken out."""
    old = freq(spark, d).select("keyword").distinct().where(F.col("keyword").endswith("#1")).select("keyword", F.lit("once").alias("reason"), F.lit(1).alias("at"))
    again = old.where(F.col("keyword").startswith("red")).withColumns({"reason": F.lit("twice"), "at": F.lit(2)})
    put = sinks.upserted(old, again.unionByName(again.withColumns({"reason": F.lit("earlier"), "at": F.lit(0)})), ["keyword"], "at")
    return sinks.without(put, put.where(F.contains("keyword", F.lit("green"))), ["keyword"]).select("keyword", "reason")


@query("msc06_excluded_newest_first", "SELECT keyword FROM exclusions ORDER BY keyword DESC LIMIT 100", "exclusions")
def msc06(spark, d):
    return freq(spark, d).select("keyword").distinct().where(F.col("keyword").endswith("#1")).orderBy(F.desc("keyword")).limit(100)


# Scans with optional equality.
@query("msc03_clusters_of_week", f"SELECT week, cluster_id, keyword_count, round(avg_z_score, {R}) AS avg_z_score FROM clusters WHERE week = '{AS_OF}' ORDER BY keyword_count DESC NULLS LAST, cluster_id", "clusters")
def msc03(spark, d):
    rows = keyword_clusters(cluster_keywords(z(spark, d)).where(F.col("week") == AS_OF))
    return rows.orderBy(F.desc_nulls_last("keyword_count"), "cluster_id").select("week", "cluster_id", "keyword_count", F.round("avg_z_score", R).alias("avg_z_score"))


@query("msc04_class_scan", "SELECT keyword, class FROM keyword_class WHERE class = 'person'", "keyword_class")
def msc04(spark, d):
    return keyword_class(freq(spark, d)).where("class = 'person'")


@query("msc07_table_counts", "SELECT 'weekly_keywords' AS name, count(*) AS n FROM weekly_keywords UNION ALL SELECT 'freq', count(*) FROM freq UNION ALL SELECT 'trend', count(*) FROM trend", "weekly_keywords", "freq", "trend")
def msc07(spark, d):
    one = lambda name, rows: rows.agg(F.lit(name).alias("name"), F.count("*").alias("n"))
    return one("weekly_keywords", facts(spark, d)).unionAll(one("freq", freq(spark, d))).unionAll(one("trend", trend(spark, d)))


@query("msc20_classes", "SELECT class, count(*) AS n FROM keyword_class GROUP BY class UNION ALL SELECT 'vocabulary', count(DISTINCT keyword) FROM z WHERE z_score >= 1.5", "keyword_class", "z")
def msc20(spark, d):
    """Each classification that was asked for, by name."""
    kinds = {"person": lambda: keyword_class(freq(spark, d)).where("class = 'person'"), "seasonal": lambda: keyword_class(freq(spark, d)).where("class = 'seasonal'"), "vocabulary": lambda: z(spark, d).where("z_score >= 1.5").select("keyword").distinct().withColumn("class", F.lit("vocabulary"))}
    out = None
    for make in kinds.values():
        rows = make().select("class")
        out = rows if out is None else out.unionAll(rows)
    return out.groupBy("class").agg(F.count("*").alias("n"))


@query("flt14_coverage", "SELECT week, keyword, count FROM (SELECT *, dense_rank() OVER (ORDER BY week) AS nr FROM freq WHERE week BETWEEN '1993-W01' AND '1997-W52') WHERE nr > 10 AND nr <= 40", "freq")
def flt14(spark, d):
    """Weeks clamped to those that are covered, then an offset and a number of weeks."""
    rows = freq(spark, d).where(dates.in_weeks(F.col("week"), "1993-W01", "1997-W52"))
    weeks = rows.select("week").distinct().withColumn("nr", F.row_number().over(Window.orderBy("week"))).where("nr > 10 AND nr <= 40").select("week")
    return rows.join(F.broadcast(weeks), "week", "left_semi").select("week", "keyword", "count")


@query("flt01_week_ranges", "SELECT 'both' AS bound, count(*) AS n FROM freq WHERE week BETWEEN '1995-W01' AND '1995-W10' UNION ALL SELECT 'from', count(*) FROM freq WHERE week >= '1997-W01' UNION ALL SELECT 'to', count(*) FROM freq WHERE week <= '1993-W10' UNION ALL SELECT 'open', count(*) FROM freq", "freq")
def flt01(spark, d):
    out = None
    for name, low, high in (("both", "1995-W01", "1995-W10"), ("from", "1997-W01", None), ("to", None, "1993-W10"), ("open", None, None)):
        one = freq(spark, d).where(dates.in_weeks(F.col("week"), low, high)).agg(F.lit(name).alias("bound"), F.count("*").alias("n"))
        out = one if out is None else out.unionAll(one)
    return out


@query("join21_map_lookups", f"SELECT c.week, c.cluster_id, c.cluster_theme, k.keywords, CAST(coalesce(v.volume, 0) AS BIGINT) AS volume FROM clusters c LEFT JOIN (SELECT week, cluster_id, string_agg(keyword, '|' ORDER BY keyword) AS keywords FROM cluster_keywords GROUP BY ALL) k ON k.week = c.week AND k.cluster_id = c.cluster_id LEFT JOIN (SELECT k.week, k.cluster_id, sum(f.count) AS volume FROM cluster_keywords k JOIN freq f ON f.week = k.week AND f.keyword = k.keyword GROUP BY ALL) v ON v.week = c.week AND v.cluster_id = c.cluster_id WHERE c.week = '{AS_OF}'", "clusters", "cluster_keywords", "freq")
def join21(spark, d):
    members = cluster_keywords(z(spark, d)).where(F.col("week") == AS_OF)
    rolled = members.join(freq(spark, d), ["week", "keyword"], "left").groupBy("week", "cluster_id").agg(F.concat_ws("|", F.sort_array(F.collect_list("keyword"))).alias("keywords"), F.sum(F.coalesce("count", F.lit(0))).alias("volume"))
    return keyword_clusters(members).select("week", "cluster_id", "cluster_theme").join(rolled, ["week", "cluster_id"], "left")


@query("top11_numeric_aware", "SELECT week, cluster_id, label, CAST(row_number() OVER (PARTITION BY week ORDER BY weight DESC NULLS LAST, TRY_CAST(label[2:] AS INTEGER)) AS INTEGER) AS place FROM tc", "tc")
def top11(spark, d):
    """Rows of a table as its reader sorts them: nulls last, then numbers within texts by their value."""
    number = F.expr("substring(label, 2)").try_cast("int")
    place = F.row_number().over(Window.partitionBy("week").orderBy(F.desc_nulls_last("weight"), number))
    return tc(spark, d).select("week", "cluster_id", "label", place.alias("place"))


# Key sentences: the best context of a week's most frequent words.
define("keysentence", "SELECT week, keyword, before || ' ' || keyword || ' ' || after AS sentence, occ_count AS evidence_count FROM (SELECT *, row_number() OVER (PARTITION BY week ORDER BY occ_count DESC, keyword) AS nr FROM ctx WHERE rank = 1) WHERE nr <= 8", "ctx")


def keysentences(spark, d):
    nr = F.row_number().over(Window.partitionBy("week").orderBy(F.desc("occ_count"), "keyword"))
    return ctx(spark, d).where("rank = 1").withColumn("nr", nr).where("nr <= 8").select("week", "keyword", F.concat("before", F.lit(" "), "keyword", F.lit(" "), "after").alias("sentence"), F.col("occ_count").alias("evidence_count"))


@query("agg11_keysentences", "SELECT week, count(*) AS n, CAST(coalesce(sum(evidence_count), 0) AS BIGINT) AS evidence FROM keysentence GROUP BY week", "keysentence")
def agg11(spark, d):
    return keysentences(spark, d).groupBy("week").agg(F.count("*").alias("n"), F.coalesce(F.sum("evidence_count"), F.lit(0)).alias("evidence"))


@query("agg25_keyword_cluster_weights", "SELECT week, source, keyword, CAST(sum(count) AS BIGINT) AS weight, round(CAST(sum(count) AS DOUBLE) / sum(sum(count)) OVER (PARTITION BY week, keyword), 6) AS share FROM (SELECT week, keyword, coalesce(nullif(press, ''), 'unknown') AS source, count(*) AS count FROM occ GROUP BY ALL) GROUP BY week, source, keyword", "occ")
def agg25(spark, d):
    """Weight of a keyword in each cluster (here: a source) of a week, and its share of the keyword's weight."""
    rows = article_words(spark, d).groupBy("week", "source", "keyword").agg(F.sum("count").alias("weight"))
    whole = F.sum("weight").over(Window.partitionBy("week", "keyword"))
    return rows.withColumn("share", F.round(F.col("weight") / whole, 6))


@query("vec19_sense_map", f"SELECT v.id, v.week, c.label AS sense_id, round(list_cosine_similarity(v.e, c.c), {R}) AS sim FROM vec v JOIN label_cent c ON c.label = v.label WHERE list_cosine_similarity(v.e, c.c) >= 0.2", "vec", "label_cent")
def vec19(spark, d):
    """The sense of every context over all weeks: that of its global cluster, where it lies near enough."""
    rows = vec(spark, d)
    cents = vectors.mean_vector(rows, ["label"], "e")
    near = similar.few(cents).join(rows, "label").withColumn("sim", vectors.cosine(F.col("e"), F.col("centroid")))
    return near.where("sim >= 0.2").select("id", "week", F.col("label").alias("sense_id"), F.round("sim", R).alias("sim"))


@query("msc13_week_senses", "SELECT week, keyword, sense_id, count, CAST(sum(count) OVER (PARTITION BY week, keyword) AS BIGINT) AS total FROM senses WHERE sense_id < 2", "senses")
def msc13(spark, d):
    rows = ctx(spark, d).select("week", "keyword", (F.col("rank") - 1).alias("sense_id"), F.col("occ_count").alias("count")).where("sense_id < 2")
    return rows.withColumn("total", F.sum("count").over(Window.partitionBy("week", "keyword")))


@query("src11_base_written", f"SELECT week, keyword, round(tfidf, {R}) AS tfidf, round(base_std, {R}) AS base_std FROM base", "base")
def src11(spark, d):
    """The baseline written as a whole table, not a number written as null, and read again."""
    from weekloom.plans.weekly_queries import base

    rows = base(spark, d).select("week", "keyword", "tfidf", F.coalesce("base_std", F.lit(float("nan"))).alias("base_std"))
    path = sinks.write_new_version(sinks.without_nan(rows), session.new_path(spark, "base"), 1)
    return spark.read.parquet(path).select("week", "keyword", F.round("tfidf", R).alias("tfidf"), F.round("base_std", R).alias("base_std"))


@query("src14_week_replaced", "SELECT week, keyword, CASE WHEN week = '1996-W10' THEN count * 2 ELSE count END AS count FROM freq WHERE week BETWEEN '1996-W09' AND '1996-W11'", "freq")
def src14(spark, d):
    """A week written again in a partitioned table: only that week changes, and a second run changes nothing."""
    path = session.new_path(spark, "freq-by-week")
    rows = freq(spark, d).where(F.col("week").between("1996-W09", "1996-W11"))
    sinks.replace_partitions(rows, path, "week")
    for _ in range(2):
        sinks.replace_partitions(rows.where("week = '1996-W10'").withColumn("count", F.col("count") * 2), path, "week")
    return spark.read.schema(rows.schema).parquet(path).select("week", "keyword", "count")


@query("src15_cluster_replaced", f"SELECT week, cluster_id, keyword, CASE WHEN cluster_id = 1 THEN 0.0 ELSE round(z_score, {R}) END AS z_score FROM cluster_keywords WHERE week = '{AS_OF}'", "cluster_keywords")
def src15(spark, d):
    """One cluster of a week written again, by two keys."""
    path = session.new_path(spark, "by-cluster")
    rows = cluster_keywords(z(spark, d)).where(F.col("week") == AS_OF).select("week", "cluster_id", "keyword", F.round("z_score", R).alias("z_score"))
    sinks.replace_partitions(rows, path, "week", "cluster_id")
    sinks.replace_partitions(rows.where("cluster_id = 1").withColumn("z_score", F.lit(0.0)), path, "week", "cluster_id")
    return spark.read.schema(rows.schema).parquet(path).select("week", "cluster_id", "keyword", "z_score")


@query("src16_class_replaced", "SELECT keyword, class, 'recurrence' AS method FROM keyword_class WHERE class <> 'person' OR length(keyword) % 2 = 0 UNION ALL SELECT keyword, class, 'rules' FROM keyword_class WHERE class = 'person'", "keyword_class")
def src16(spark, d):
    """Classes in a table by class and method: a second run of one method replaces its rows of that class and no others."""
    rows, path = keyword_class(freq(spark, d)), session.new_path(spark, "classes")
    named = lambda part, method: part.withColumn("method", F.lit(method))
    sinks.replace_partitions(named(rows, "recurrence"), path, "class", "method")
    person = rows.where("class = 'person'")
    sinks.replace_partitions(named(person.where("length(keyword) % 2 = 0"), "recurrence"), path, "class", "method")
    sinks.replace_partitions(named(person, "rules"), path, "class", "method")
    return spark.read.schema("keyword string, class string, method string").parquet(path)


@query("src18_categories_replaced", "SELECT DISTINCT p_type AS name, p_brand AS parent FROM part")
def src18(spark, d):
    """A small table written anew as a whole; readers of the old version keep it."""
    root = session.new_path(spark, "categories")
    sinks.write_new_version(tables.table(spark, d, "part").select(F.col("p_type").alias("name"), F.lit(None).cast("string").alias("parent")).distinct(), root, 1)
    now = sinks.write_new_version(tables.table(spark, d, "part").select(F.col("p_type").alias("name"), F.col("p_brand").alias("parent")).distinct(), root, 2)
    return spark.read.parquet(now)


@query("src19_export", "SELECT 'freq' AS step, count(*) AS n_rows, count(*) > 200000 AS compact, CASE WHEN count(*) > 200000 THEN 200 ELSE count(*) END AS written FROM freq", "freq")
def src19(spark, d):
    """A CSV export and its manifest, read again: a sample where the table has more than 200,000 rows."""
    path = session.new_path(spark, "export")
    sinks.export(freq(spark, d), path, "freq")
    manifest = spark.read.json(f"{path}/meta").select("step", F.col("rows").alias("n_rows"), "compact")
    return manifest.crossJoin(spark.read.option("header", True).csv(f"{path}/data").agg(F.count("*").alias("written")))


@query("src08_new_files")
def src08(spark, d):
    """Files of an input folder that are not yet known by checksum: here one of three has been read before, one has changed."""
    path = session.new_path(spark, "incoming")
    rows = tables.table(spark, d, "region").select(F.to_json(F.struct("*")).alias("value"), (F.col("r_regionkey") % 3).alias("part"))
    rows.write.partitionBy("part").text(path)
    files = sinks.new_files(spark, path, spark.createDataFrame([], "source_file string, checksum string"))
    known = files.where(F.contains("source_file", F.lit("part=0"))).union(files.where(F.contains("source_file", F.lit("part=1"))).withColumn("checksum", F.lit("old")))
    return sinks.new_files(spark, path, known).select(F.regexp_extract("source_file", r"part=(\d)", 1).alias("part")).distinct()
