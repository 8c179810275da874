"""Further queries of the inventory: predicates, theta joins, top-k lists, set operations, scalars, enrichment."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from weekloom.functions import dates, text, vectors
from weekloom.operators import contexts, enrich, linkage, percentiles, similar, weekly
from weekloom.plans.registry import define, query
from weekloom.plans.vector_queries import clusters as weekly_clusters
from weekloom.plans.vector_queries import vec
from weekloom.plans.view_queries import article_words, ctx
from weekloom.plans.weekly_queries import R, facts, freq, trend, z
from weekloom.session import stored
from weekloom.sources import html, tables


@query("flt06_week_payload", "SELECT news_id FROM articles WHERE (date BETWEEN '20240108' AND '20240114') OR (date <= '20240114' AND strftime(strptime(date, '%Y%m%d') + INTERVAL 3 DAY, '%Y%m%d') >= '20240108')", "articles")
def flt06(spark, d):
    rows = tables.articles(spark, d).withColumn("until", F.date_format(F.date_add(F.to_date("date", "yyyyMMdd"), 3), "yyyyMMdd"))
    return rows.where(F.col("date").between("20240108", "20240114") | ((F.col("date") <= "20240114") & (F.col("until") >= "20240108"))).select("news_id")


@query("flt15_any_of", "SELECT p_partkey FROM part WHERE contains(p_type, 'ECON') OR contains(p_type, 'STAND') OR contains(p_type, 'red')")
def flt15(spark, d):
    wanted = F.array(*map(F.lit, ("ECON", "STAND", "red")))
    return tables.table(spark, d, "part").where(F.exists(wanted, lambda v: F.contains(F.col("p_type"), v))).select("p_partkey")


@query("flt19_dictionary", "SELECT DISTINCT keyword FROM freq WHERE keyword IN (SELECT p_name || ' ' || p_brand FROM part WHERE p_size < 10)", "freq")
def flt19(spark, d):
    words = tables.table(spark, d, "part").where("p_size < 10").select(F.concat_ws(" ", "p_name", "p_brand").alias("keyword"))
    return freq(spark, d).select("keyword").distinct().join(words, "keyword", "left_semi")


@query("flt20_clean_items")
def flt20(spark, d):
    items = html.records(tables.table(spark, d, "pages"), "a").where(~F.lower("title").isin("home", "more"))
    return html.distinct_items(items.withColumn("url", F.nullif("url", F.lit(""))), order=("page_id", "nr")).select("url", "title")


@query("join12_year_ago", "SELECT week, keyword, count, lag(count, 52) OVER (PARTITION BY keyword ORDER BY week_idx) AS year_ago FROM dense", "dense")
def join12(spark, d):
    f = freq(spark, d)
    full = weekly.dense(f, weekly.filtered_keywords(f))
    return full.select("week", "keyword", "count", F.lag("count", 52).over(Window.partitionBy("keyword").orderBy("week_idx")).alias("year_ago"))


define("words6", "SELECT keyword, CAST(row_number() OVER (ORDER BY n DESC, keyword) AS INTEGER) AS place FROM (SELECT keyword, count(*) AS n FROM occ WHERE length(keyword) >= 6 GROUP BY keyword) ORDER BY n DESC, keyword LIMIT 30", "occ")
define("title_hits", "SELECT * FROM (SELECT a.news_id, a.title, w.keyword, w.place, row_number() OVER (PARTITION BY a.news_id ORDER BY w.place) AS nth FROM articles a JOIN words6 w ON contains(lower(a.title), w.keyword)) WHERE nth = 1", "articles", "words6")


def top_words(spark, d):
    counted = article_words(spark, d).where("length(keyword) >= 6").groupBy("keyword").agg(F.sum("count").alias("n"))
    top = counted.orderBy(F.desc("n"), "keyword").limit(30)
    return top.select("keyword", F.row_number().over(Window.orderBy(F.desc("n"), "keyword")).alias("place"))


def title_hits(spark, d):
    """Titles that hold one of 30 words, each claimed by the best-placed one. The word list is a top-k, so it is broadcast."""
    rows = tables.articles(spark, d).select("news_id", "title")
    hits = rows.join(F.broadcast(top_words(spark, d)), F.contains(F.lower("title"), F.col("keyword")))
    return hits.groupBy("news_id", "title").agg(F.min_by(F.struct("keyword", "place"), "place").alias("k")).select("news_id", "title", "k.keyword", "k.place")


@query("join13_keyword_titles", "SELECT news_id, keyword, CAST(nr AS INTEGER) AS nr FROM (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY news_id) AS nr FROM title_hits) WHERE nr <= 15", "title_hits")
def join13(spark, d):
    nr = F.row_number().over(Window.partitionBy("keyword").orderBy("news_id"))
    return title_hits(spark, d).withColumn("nr", nr).where("nr <= 15").select("news_id", "keyword", "nr")


@query("join14_char_budget", "SELECT news_id, keyword FROM (SELECT *, sum(length(title)) OVER (PARTITION BY keyword ORDER BY news_id) AS used FROM title_hits) WHERE used <= 2000", "title_hits")
def join14(spark, d):
    used = F.sum(F.length("title")).over(Window.partitionBy("keyword").orderBy("news_id").rowsBetween(Window.unboundedPreceding, 0))
    return title_hits(spark, d).withColumn("used", used).where("used <= 2000").select("news_id", "keyword")


# Many keywords of a week in its titles and articles, then the rules of order.
KEYWORDS, PER_KEYWORD, TITLES, CHARS = 60, 15, 8000, 20_000
define("week_words", f"SELECT week, keyword, place FROM (SELECT week, keyword, CAST(row_number() OVER (PARTITION BY week ORDER BY count(*) DESC, keyword) AS INTEGER) AS place FROM occ WHERE length(keyword) >= 5 GROUP BY week, keyword) WHERE place <= {KEYWORDS}", "occ")
define("week_title_hits", "SELECT a.week, a.news_id, list(w.place ORDER BY w.place) AS places FROM (SELECT week, lower(title) AS title, min(news_id) AS news_id FROM articles GROUP BY ALL) a JOIN week_words w ON a.week = w.week AND contains(a.title, w.keyword) GROUP BY a.week, a.news_id", "articles", "week_words")
define("week_title_order", "SELECT *, row_number() OVER (PARTITION BY week ORDER BY news_id) AS nr FROM week_title_hits", "week_title_hits")
_TAKEN = f"list_filter(o.places, lambda p: c.counts[p] < {PER_KEYWORD})[1]"
define("week_claims", f"""/*RECURSIVE*/SELECT week, CAST(0 AS BIGINT) AS nr, CAST(NULL AS BIGINT) AS news_id, CAST(NULL AS INTEGER) AS place, list_transform(range({KEYWORDS}), lambda x: 0) AS counts FROM (SELECT DISTINCT week FROM week_title_order)
  UNION ALL SELECT o.week, o.nr, o.news_id, {_TAKEN}, list_transform(c.counts, lambda n, i: n + CASE WHEN i = {_TAKEN} THEN 1 ELSE 0 END) FROM week_claims c JOIN week_title_order o ON o.week = c.week AND o.nr = c.nr + 1""", "week_title_order")


def week_words(spark, d):
    """(week, keyword, place): the most frequent words of each week, of five letters or more."""
    counted = article_words(spark, d).where("length(keyword) >= 5").groupBy("week", "keyword").agg(F.sum("count").alias("n"))
    place = F.row_number().over(Window.partitionBy("week").orderBy(F.desc("n"), "keyword"))
    return counted.withColumn("place", place).where(F.col("place") <= KEYWORDS).select("week", "keyword", "place")


def week_hits(spark, d, rows):
    """(week, id, keyword, place): the words of its week that each of some texts (week, id, text) contains.

    A text meets the words of its own week alone, KEYWORDS at most, so looking for each grows with the texts; to cut texts
    into parts for an index costs several times as much and pays for many more words only.
    """
    words = similar.few(week_words(spark, d))
    return rows.join(words, "week").where(F.contains("text", F.col("keyword"))).select("week", "id", "keyword", "place", *(c for c in rows.columns if c not in ("week", "id", "text")))


@query("join13_claimed_titles", f"SELECT week, c.news_id, w.keyword FROM week_claims c JOIN week_words w USING (week, place) WHERE c.news_id IS NOT NULL", "week_claims", "week_words")
def join13_claimed(spark, d):
    """Titles of a week in order, each claimed by its first keyword that has had fewer than fifteen; at most 8,000 a week.

    Until a keyword is full, every title with it is claimed by some keyword, and there are fifteen claims a keyword in
    all: so no more than that many first titles of a keyword matter, and a week's order rule sees no more rows.
    """
    titles = tables.articles(spark, d).groupBy("week", F.lower("title").alias("text")).agg(F.min("news_id").alias("id"))
    hits = week_hits(spark, d, stored(titles, "titles"))
    nth = F.row_number().over(Window.partitionBy("week", "keyword").orderBy("id"))
    near = hits.withColumn("nth", nth).where(F.col("nth") <= min(TITLES, PER_KEYWORD * KEYWORDS)).drop("nth")

    def claim(group):
        had, rows = {}, []
        for id_, own in group.sort_values(["id", "place"]).groupby("id", sort=False):
            for place, keyword in zip(own["place"], own["keyword"], strict=True):
                if had.get(place, 0) < PER_KEYWORD:
                    had[place] = had.get(place, 0) + 1
                    rows.append((group["week"].iloc[0], id_, keyword))
                    break
            if len(rows) >= TITLES:
                break
        return pd.DataFrame(rows, columns=["week", "news_id", "keyword"])

    return near.groupBy("week").applyInPandas(claim, "week string, news_id long, keyword string")


@query("join14_context_budget", f"SELECT week, keyword, CAST(count(*) AS BIGINT) AS n, CAST(sum(least(size, {CHARS} - before)) AS BIGINT) AS chars, min(news_id) AS first_id FROM (SELECT *, coalesce(sum(size) OVER (PARTITION BY week, keyword ORDER BY news_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT a.week, w.keyword, a.news_id, length(trim(a.title || ' ' || a.body)) AS size FROM articles a JOIN week_words w ON a.week = w.week AND contains(lower(a.title || chr(10) || a.body), w.keyword))) WHERE before < {CHARS} GROUP BY week, keyword", "articles", "week_words")
def join14_budget(spark, d):
    """How many articles of a week fill a keyword's 20,000 characters of context, in order, the last one cut to fit."""
    rows = tables.articles(spark, d).select("week", F.col("news_id").alias("id"), F.lower(F.concat("title", F.lit("\n"), "body")).alias("text"), F.length(F.trim(F.concat_ws(" ", "title", "body"))).alias("size"))
    hits = week_hits(spark, d, rows).drop("place")
    by = Window.partitionBy("week", "keyword").orderBy("id")
    # Every article has a character at least, so later ones can't be needed.
    hits = hits.withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= CHARS)
    used = hits.withColumn("before", F.coalesce(F.sum("size").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where(F.col("before") < CHARS)
    return used.groupBy("week", "keyword").agg(F.count("*").alias("n"), F.sum(F.least("size", CHARS - F.col("before"))).alias("chars"), F.min("id").alias("first_id"))


@query("join20_interval_overlap", "SELECT strftime(w.monday, '%G-W%V') AS week, count(*) AS open_orders FROM (SELECT DISTINCT date_trunc('week', o_orderdate) AS monday FROM orders) w JOIN orders o ON o.o_orderdate < w.monday + INTERVAL 7 DAY AND o.o_orderdate + INTERVAL 20 DAY >= w.monday GROUP BY ALL")
def join20(spark, d):
    # Each interval is dealt to the weeks that it touches, so the overlap is an equi-join on the week.
    orders = tables.table(spark, d, "orders").select(F.col("o_orderdate").cast("timestamp").alias("a"))
    touched = orders.select(F.explode(F.sequence(F.date_trunc("week", "a"), F.date_trunc("week", F.col("a") + F.expr("interval 20 days")), F.expr("interval 7 days"))).alias("monday"))
    weeks = orders.select(F.date_trunc("week", "a").alias("monday")).distinct()
    return touched.groupBy("monday").agg(F.count("*").alias("open_orders")).join(weeks, "monday").select(dates.iso_week(F.col("monday").cast("date")).alias("week"), "open_orders")


@query("join18_shared_keywords", f"""SELECT a.week, a.label AS label, b.week AS prev_week, b.label AS prev_label, round(CAST((CASE WHEN a.label = b.label THEN 2 ELSE 1 END) AS DOUBLE) / (CASE WHEN a.label = b.label THEN 4 ELSE 5 END), {R}) AS overlap
  FROM members a JOIN members b ON CAST(b.week[7:8] AS INTEGER) = CAST(a.week[7:8] AS INTEGER) - 1 AND (a.thread_id = b.thread_id OR (a.thread_id + 1) % 10 = b.thread_id OR (b.thread_id + 1) % 10 = a.thread_id)""", "members")
def join18(spark, d):
    c = stored(weekly_clusters(spark, d).select("week", F.substring("week", 7, 2).cast("int").alias("nr"), "label", "keywords"), "clusters")
    now, before = c.withColumn("k", F.explode("keywords")), c.select((F.col("nr") + 1).alias("nr"), F.col("week").alias("prev_week"), F.col("label").alias("prev_label"), F.size("keywords").alias("m"), F.explode("keywords").alias("k"))
    shared = now.join(before, ["nr", "k"]).groupBy("week", "label", "prev_week", "prev_label").agg(F.count("*").alias("s"), F.first(F.size("keywords")).alias("n"), F.first("m").alias("m"))
    return shared.select("week", "label", "prev_week", "prev_label", F.round(F.col("s") / (F.col("n") + F.col("m") - F.col("s")), R).alias("overlap"))


@query("agg08_status_counts", "SELECT week, status, count(*) AS n FROM trend GROUP BY ALL", "trend")
def agg08(spark, d):
    return trend(spark, d).groupBy("week", "status").agg(F.count("*").alias("n"))


@query("agg26_sentence_terms", f"SELECT press, keyword, cf, round(cf * ln(1 + CAST((SELECT count(DISTINCT news_id) FROM occ) AS DOUBLE) / df), {R}) AS score FROM (SELECT press, keyword, count(*) AS cf FROM occ GROUP BY ALL) JOIN (SELECT keyword AS k, count(DISTINCT news_id) AS df FROM occ GROUP BY ALL) ON k = keyword WHERE cf >= 5", "occ")
def agg26(spark, d):
    per_doc = stored(contexts.tokens(tables.articles(spark, d)).groupBy("press", "keyword", "news_id").agg(F.count("*").alias("c")), "per_doc")
    cf = per_doc.groupBy("press", "keyword").agg(F.sum("c").alias("cf")).where("cf >= 5")
    df = per_doc.groupBy("keyword").agg(F.count_distinct("news_id").alias("df"))
    n = per_doc.agg(F.count_distinct("news_id").alias("n"))
    return cf.join(df, "keyword").crossJoin(F.broadcast(n)).select("press", "keyword", "cf", F.round(F.col("cf") * F.log(1 + F.col("n") / F.col("df")), R).alias("score"))


@query("agg28_majority", "SELECT user_id, arg_max(event_type, (n, event_type)) AS event_type, max(n) AS n FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY user_id")
def agg28(spark, d):
    counted = tables.table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return counted.groupBy("user_id").agg(F.max_by("event_type", F.struct("n", "event_type")).alias("event_type"), F.max("n").alias("n"))


@query("agg33_cohesion_percentiles", f"SELECT v.label, round(quantile_cont(s, 0.5), {R}) AS p50, round(quantile_cont(s, 0.1), {R}) AS p10, round(quantile_cont(s, 0.25), {R}) AS p25, round(min(s), {R}) AS low, round(avg(CASE WHEN s >= 0.3 THEN 1.0 ELSE 0.0 END), {R}) AS share FROM (SELECT v.label, list_cosine_similarity(v.e, c.c) AS s FROM vec v JOIN label_cent c ON c.label = v.label) v GROUP BY v.label", "vec", "label_cent")
def agg33(spark, d):
    v = vec(spark, d)
    near = v.join(similar.few(vectors.mean_vector(v, ["label"], "e")), "label").select("label", vectors.cosine(F.col("e"), F.col("centroid")).alias("s"))
    near = stored(near, "closeness")
    marks = percentiles.percentiles(near, ["label"], "s", {"p50": 0.5, "p10": 0.1, "p25": 0.25})
    rest = near.groupBy("label").agg(F.round(F.min("s"), R).alias("low"), F.round(F.avg(F.when(F.col("s") >= 0.3, 1.0).otherwise(0.0)), R).alias("share"))
    return marks.withColumns({c: F.round(c, R) for c in ("p50", "p10", "p25")}).join(rest, "label")


@query("agg36_describability", f"SELECT press, count(*) AS n, round(avg(len(regexp_extract_all(title, '[가-힣A-Za-z0-9]{{2,}}'))), {R}) AS tokens, round(CAST(count(DISTINCT title) AS DOUBLE) / count(*), {R}) AS distinct_ratio FROM articles GROUP BY press", "articles")
def agg36(spark, d):
    return tables.articles(spark, d).groupBy("press").agg(F.count("*").alias("n"), F.round(F.avg(F.size(text.tokens(F.col("title")))), R).alias("tokens"), F.round(F.count_distinct("title") / F.count("*"), R).alias("distinct_ratio"))


@query("top02_top30", f"SELECT keyword, round(z_score, {R}) AS z_score FROM z WHERE week = '1996-W20' AND z_score >= 0.5 ORDER BY round(z_score, 9) DESC, keyword LIMIT 30", "z")
def top02(spark, d):
    return z(spark, d).where("week = '1996-W20' AND z_score >= 0.5").orderBy(F.desc(F.round("z_score", 9)), "keyword").limit(30).select("keyword", F.round("z_score", R).alias("z_score"))


@query("top03_top8", f"SELECT week, keyword FROM (SELECT week, keyword, row_number() OVER (PARTITION BY week ORDER BY round(z_score, 9) DESC, keyword) AS nr FROM z WHERE z_score >= 0.5) WHERE nr <= 8", "z")
def top03(spark, d):
    nr = F.row_number().over(Window.partitionBy("week").orderBy(F.desc(F.round("z_score", 9)), "keyword"))
    return z(spark, d).where("z_score >= 0.5").withColumn("nr", nr).where("nr <= 8").select("week", "keyword")


@query("top07_sense_gate", "SELECT week, keyword, sense_id, count FROM (SELECT *, sum(count) OVER (PARTITION BY week, keyword) AS total FROM senses) WHERE sense_id = 0 OR (count >= greatest(1, total * 0.12) AND sense_id < 4)", "senses")
def top07(spark, d):
    rows = ctx(spark, d).select("week", "keyword", (F.col("rank") - 1).alias("sense_id"), F.col("occ_count").alias("count"))
    total = F.sum("count").over(Window.partitionBy("week", "keyword"))
    return rows.withColumn("total", total).where((F.col("sense_id") == 0) | ((F.col("count") >= F.greatest(F.lit(1.0), F.col("total") * 0.12)) & (F.col("sense_id") < 4))).drop("total")


@query("top13_extractive_summary", r"""SELECT news_id, nr, s, score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY news_id ORDER BY score DESC, i) AS INTEGER) AS nr FROM (SELECT news_id, i, s, 3 * len(list_intersect(list_distinct(regexp_extract_all(lower(s), '[가-힣A-Za-z0-9]{2,}')), list_distinct(regexp_extract_all(lower(coalesce(title, '')), '[가-힣A-Za-z0-9]{2,}')))) + least(length(s) // 40, 3) AS score FROM sents WHERE length(s) >= 12)) WHERE nr <= 2""", "sents")
def top13(spark, d):
    """The two best sentences of each article: three points for each title word, one for each 40 characters up to three."""
    rows = tables.articles(spark, d).select("news_id", F.array_distinct(text.tokens(F.lower("title"))).alias("ks"), F.posexplode(text.sentences(F.col("body"))).alias("i", "s"))
    hits = F.size(F.array_intersect(F.array_distinct(text.tokens(F.lower("s"))), F.col("ks")))
    scored = rows.where("length(s) >= 12").withColumn("score", 3 * hits + F.least(F.floor(F.length("s") / 40), F.lit(3)))
    nr = F.row_number().over(Window.partitionBy("news_id").orderBy(F.desc("score"), "i"))
    return scored.withColumn("nr", nr).where("nr <= 2").select("news_id", "nr", "s", "score")


@query("top14_first_ids", "SELECT press, array_to_string(list_sort(list(DISTINCT news_id))[1:10], ',') AS ids FROM articles GROUP BY press", "articles")
def top14(spark, d):
    nr = F.row_number().over(Window.partitionBy("press").orderBy("news_id"))
    rows = tables.articles(spark, d).select("press", "news_id").distinct().withColumn("nr", nr).where("nr <= 10")
    return rows.groupBy("press").agg(F.array_join(F.transform(F.sort_array(F.collect_list("news_id")), lambda x: x.cast("string")), ",").alias("ids"))


@query("set02_catalog", "SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'documents', count(*) FROM documents")
def set02(spark, d):
    one = lambda n: tables.table(spark, d, n).agg(F.lit(n).alias("name"), F.count("*").alias("n"))
    return one("orders").unionAll(one("lineitem")).unionAll(one("documents"))


@query("set07_best_score", "SELECT user_id, max(value) AS best, arg_max(event_id, (value, -event_id)) AS event_id FROM events GROUP BY user_id")
def set07(spark, d):
    return tables.table(spark, d, "events").groupBy("user_id").agg(F.max("value").alias("best"), F.max_by("event_id", F.struct("value", (-F.col("event_id")).alias("b"))).alias("event_id"))


@query("set10_pivot", "SELECT event_type, count(*) FILTER (WHERE user_id % 3 = 0) AS g0, count(*) FILTER (WHERE user_id % 3 = 1) AS g1, count(*) FILTER (WHERE user_id % 3 = 2) AS g2 FROM events GROUP BY event_type")
def set10(spark, d):
    rows = tables.table(spark, d, "events").withColumn("g", F.concat(F.lit("g"), (F.col("user_id") % 3).cast("string")))
    return rows.groupBy("event_type").pivot("g", ["g0", "g1", "g2"]).count().na.fill(0)


@query("set12_article_dedupe", "SELECT min(news_id) AS news_id, press, key FROM (SELECT news_id, press, regexp_replace(lower(title), '[^0-9a-z가-힣]+', '', 'g') AS key FROM articles) GROUP BY press, key", "articles")
def set12(spark, d):
    return tables.articles(spark, d).groupBy("press", text.normalise_keyword(F.col("title")).alias("key")).agg(F.min("news_id").alias("news_id"))


@query("scl24_coerce_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def scl24(spark, d):
    return tables.table(spark, d, "orders").select("o_orderkey", dates.coerce_date(F.date_format("o_orderdate", "yyyyMMdd")).alias("day"))


@query("scl30_safe_numbers", "SELECT doc_id, coalesce(TRY_CAST(source[4:] AS DOUBLE), 0.0) AS number, coalesce(TRY_CAST(lang AS DOUBLE), 0.0) AS none FROM documents")
def scl30(spark, d):
    return tables.table(spark, d, "documents").select("doc_id", F.coalesce(F.expr("substring(source, 4)").try_cast("double"), F.lit(0.0)).alias("number"), F.coalesce(F.col("lang").try_cast("double"), F.lit(0.0)).alias("none"))


@query("scl33_clamp", "SELECT p_partkey, greatest(2, least(20, least(p_size // 3, p_size))) AS k FROM part")
def scl33(spark, d):
    n = F.col("p_size")
    return tables.table(spark, d, "part").select("p_partkey", F.greatest(F.lit(2), F.least(F.lit(20), F.floor(n / 3).cast("int"), n)).alias("k"))


@query("scl40_pipe_lists", "SELECT week, keyword, len(string_split(sources, '|')) AS n FROM sources", "sources")
def scl40(spark, d):
    return weekly.sources(facts(spark, d)).select("week", "keyword", F.size(text.pipe_list(F.col("sources"))).cast("long").alias("n"))


@query("enr01_prompts", "SELECT week, 'Week ' || week || ': ' || string_agg(nr || '. ' || keyword, '; ' ORDER BY nr) AS prompt FROM (SELECT week, keyword, row_number() OVER (PARTITION BY week ORDER BY count DESC, keyword) AS nr FROM freq) WHERE nr <= 5 GROUP BY week", "freq")
def enr01(spark, d):
    return prompts(spark, d)


def prompts(spark, d):
    nr = F.row_number().over(Window.partitionBy("week").orderBy(F.desc("count"), "keyword"))
    top = tables.dealt(freq(spark, d), "week", "keyword").withColumn("nr", nr).where("nr <= 5")
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nr", "keyword"))), lambda s: F.concat(s["nr"].cast("string"), F.lit(". "), s["keyword"])), "; ")
    return top.groupBy("week").agg(lines.alias("lines")).select("week", text.fill("Week {{week}}: {{lines}}", {"week": F.col("week"), "lines": F.col("lines")}).alias("prompt"))


@query("enr03_products")
def enr03(spark, d):
    return enrich.ranked_items(enrich.replies(prompts(spark, d), F.col("prompt")).drop("prompt"), "reply", 5)


@query("vec12_senses")
def vec12(spark, d):
    return linkage.split_senses(vec(spark, d), ["week", "label"], "id", "e", 0.8)


@query("sta07_token_bucket")
def sta07(spark, d):
    return enrich.token_bucket(tables.table(spark, d, "events"), "user_id", "ts", 3, 1 / 86_400)


@query("api02_summary", "SELECT f.week, keywords, coalesce(spikes, 0) AS spikes FROM (SELECT week, count(*) AS keywords FROM freq GROUP BY week) f LEFT JOIN (SELECT week, count(*) AS spikes FROM z WHERE z_score >= 2.0 GROUP BY week) s ON s.week = f.week", "freq", "z")
def api02(spark, d):
    f = freq(spark, d)
    spikes = weekly.high(z(spark, d)).groupBy("week").agg(F.count("*").alias("spikes"))
    return f.groupBy("week").agg(F.count("*").alias("keywords")).join(spikes, "week", "left").select("week", "keywords", F.coalesce("spikes", F.lit(0)).alias("spikes"))


@query("msc01_history", f"SELECT week, keyword, round(z_score, {R}) + 0.0 AS z_score FROM (SELECT *, max(z_score) FILTER (WHERE week = '1996-W20') OVER (PARTITION BY keyword) AS z_end FROM z) WHERE week <= '1996-W20' AND z_end >= 1.5", "z")
def msc01(spark, d):
    scores = z(spark, d)
    wanted = scores.where("week = '1996-W20' AND z_score >= 1.5").select("keyword")
    return scores.where("week <= '1996-W20'").join(wanted, "keyword", "left_semi").select("week", "keyword", (F.round("z_score", R) + 0.0).alias("z_score"))


@query("msc08_vocabulary", "SELECT DISTINCT keyword FROM z WHERE z_score >= 1.5", "z")
def msc08(spark, d):
    return weekly.high(z(spark, d), 1.5).select("keyword").distinct()
