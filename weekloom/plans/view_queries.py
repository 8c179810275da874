"""Queries of the read views: joins of clusters, classes, contexts and signals, and the endpoints over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions import text
from weekloom.operators import contexts, signals, weekly
from weekloom.plans.registry import define, query
from weekloom.plans.stages import stage
from weekloom.plans.weekly_queries import AS_OF, R, facts, freq, long_term, period, z
from weekloom.sources import tables

define("cluster_keywords", "SELECT week, CAST(length(keyword) % 4 AS INTEGER) AS cluster_id, keyword, z_score FROM z WHERE z_score >= 1.2", "z")
define("clusters", "SELECT week, cluster_id, min(keyword) AS cluster_theme, count(*) AS keyword_count, avg(z_score) AS avg_z_score, max(z_score) AS max_z_score FROM cluster_keywords GROUP BY ALL", "cluster_keywords")
define("keyword_class", "SELECT keyword, 'seasonal' AS class FROM freq GROUP BY keyword HAVING count(*) % 3 = 0 UNION ALL SELECT keyword, 'person' AS class FROM freq GROUP BY keyword HAVING sum(count) % 4 = 0", "freq")
define("exclusions", "SELECT DISTINCT keyword FROM freq WHERE keyword LIKE '%#1'", "freq")


def cluster_keywords(scores: DataFrame) -> DataFrame:
    return weekly.high(scores, 1.2).select("week", (F.length("keyword") % 4).alias("cluster_id"), "keyword", "z_score")


def clusters(members: DataFrame) -> DataFrame:
    return members.groupBy("week", "cluster_id").agg(F.min("keyword").alias("cluster_theme"), F.count("*").alias("keyword_count"), F.avg("z_score").alias("avg_z_score"), F.max("z_score").alias("max_z_score"))


def keyword_class(f: DataFrame) -> DataFrame:
    rows = f.groupBy("keyword").agg(F.count("*").alias("n"), F.sum("count").alias("s"))
    return rows.where("n % 3 = 0").select("keyword", F.lit("seasonal").alias("class")).union(rows.where("s % 4 = 0").select("keyword", F.lit("person").alias("class")))


@query("agg15_cluster_meta", f"SELECT week, cluster_id, cluster_theme, keyword_count, round(avg_z_score, {R}) AS avg_z_score, round(max_z_score, {R}) AS max_z_score FROM clusters", "clusters")
def agg15(spark, d):
    return clusters(cluster_keywords(z(spark, d))).withColumns({c: F.round(c, R) for c in ("avg_z_score", "max_z_score")})


@query("agg14_cluster_series", f"SELECT k.week, k.cluster_id, CAST(sum(coalesce(f.count, 0)) AS BIGINT) AS volume, round(avg(k.z_score), {R}) AS intensity, count(*) AS keyword_count, avg(k.z_score) >= 0.5 AS is_active, false AS stop_tracking FROM cluster_keywords k LEFT JOIN freq f ON f.week = k.week AND f.keyword = k.keyword GROUP BY ALL", "cluster_keywords", "freq")
def agg14(spark, d):
    f = freq(spark, d)
    members = cluster_keywords(z(spark, d)).join(f, ["week", "keyword"], "left")
    rows = members.groupBy("week", "cluster_id").agg(F.sum(F.coalesce("count", F.lit(0))).alias("volume"), F.avg("z_score").alias("intensity"), F.count("*").alias("keyword_count"))
    return rows.select("week", "cluster_id", "volume", F.round("intensity", R).alias("intensity"), "keyword_count", (F.col("intensity") >= 0.5).alias("is_active"), F.lit(False).alias("stop_tracking"))


@query("join02_keyword_enriched", f"SELECT k.week, k.keyword, k.cluster_id, c.cluster_theme, round(k.z_score, {R}) AS z_score, round(l.long_term_score, {R}) AS long_term_score, l.selected_for_tracking, p.label AS window_primary_label, p.macro_up, round(p.wow_7d_pct, {R}) AS wow_7d_pct FROM cluster_keywords k LEFT JOIN clusters c ON c.week = k.week AND c.cluster_id = k.cluster_id LEFT JOIN lt_sel l ON l.week = k.week AND l.keyword = k.keyword LEFT JOIN pt p ON p.as_of_week = k.week AND p.keyword = k.keyword", "cluster_keywords", "clusters", "lt_sel", "pt")
def join02(spark, d):
    members = cluster_keywords(z(spark, d))
    lt = long_term(spark, d).select("week", "keyword", F.round("long_term_score", R).alias("long_term_score"), "selected_for_tracking")
    pt = period(spark, d).select(F.col("as_of_week").alias("week"), "keyword", F.col("label").alias("window_primary_label"), "macro_up", F.round("wow_7d_pct", R).alias("wow_7d_pct"))
    named = members.join(clusters(members).select("week", "cluster_id", "cluster_theme"), ["week", "cluster_id"], "left")
    return named.join(lt, ["week", "keyword"], "left").join(pt, ["week", "keyword"], "left").withColumn("z_score", F.round("z_score", R))


@query("join03_cluster_enriched", f"""SELECT c.week, c.cluster_id, c.cluster_theme, c.keyword_count, round(r.avg_lt, {R}) AS avg_long_term_score, round(r.max_lt, {R}) AS max_long_term_score, r.tracked AS tracked_keyword_count, r.members AS member_keywords FROM clusters c LEFT JOIN LATERAL (
  SELECT avg(l.long_term_score) AS avg_lt, max(l.long_term_score) AS max_lt, count(*) FILTER (WHERE l.selected_for_tracking) AS tracked, string_agg(k.keyword, '|' ORDER BY round(k.z_score, 9) DESC NULLS LAST, k.keyword) AS members FROM cluster_keywords k LEFT JOIN lt_sel l ON l.week = k.week AND l.keyword = k.keyword WHERE k.week = c.week AND k.cluster_id = c.cluster_id) r ON true""", "clusters", "cluster_keywords", "lt_sel")
def join03(spark, d):
    members = cluster_keywords(z(spark, d))
    lt = long_term(spark, d).select("week", "keyword", "long_term_score", "selected_for_tracking")
    order = F.sort_array(F.collect_list(F.struct((-F.round("z_score", 9)).alias("o"), "keyword")))
    rolled = members.join(lt, ["week", "keyword"], "left").groupBy("week", "cluster_id").agg(F.round(F.avg("long_term_score"), R).alias("avg_long_term_score"), F.round(F.max("long_term_score"), R).alias("max_long_term_score"), F.count_if("selected_for_tracking").alias("tracked_keyword_count"), F.array_join(F.transform(order, lambda s: s["keyword"]), "|").alias("member_keywords"))
    return clusters(members).select("week", "cluster_id", "cluster_theme", "keyword_count").join(rolled, ["week", "cluster_id"], "left").withColumn("tracked_keyword_count", F.coalesce("tracked_keyword_count", F.lit(0)))


@query("join04_review_excluded", f"SELECT z.week, z.keyword, round(z.z_score, {R}) AS z_score, string_agg(DISTINCT k.class, '|' ORDER BY k.class) AS noise_classes FROM z JOIN keyword_class k ON k.keyword = z.keyword WHERE z.z_score >= 2.0 GROUP BY z.week, z.keyword, z.z_score", "z", "keyword_class")
def join04(spark, d):
    f = freq(spark, d)
    high = weekly.high(z(spark, d))
    return high.join(keyword_class(f), "keyword").groupBy("week", "keyword", F.round("z_score", R).alias("z_score")).agg(F.concat_ws("|", F.sort_array(F.collect_set("class"))).alias("noise_classes"))


@query("flt08_exclusion", f"SELECT week, keyword, round(z_score, {R}) AS z_score FROM z WHERE z_score >= 1.2 AND keyword NOT IN (SELECT keyword FROM keyword_class WHERE class IN ('seasonal') UNION SELECT keyword FROM exclusions)", "z", "keyword_class", "exclusions")
def flt08(spark, d):
    f = freq(spark, d)
    out = keyword_class(f).where(F.col("class").isin("seasonal")).select("keyword").union(f.where(F.col("keyword").endswith("#1")).select("keyword")).distinct()
    return weekly.high(z(spark, d), 1.2).join(out, "keyword", "left_anti").select("week", "keyword", F.round("z_score", R).alias("z_score"))


@query("set04_candidates", f"SELECT DISTINCT keyword FROM (SELECT keyword FROM cluster_keywords WHERE week = '{AS_OF}' UNION SELECT keyword FROM z WHERE week = '{AS_OF}' AND z_score >= 0.5) WHERE keyword NOT IN (SELECT keyword FROM exclusions)", "cluster_keywords", "z", "exclusions")
def set04(spark, d):
    scores = z(spark, d)
    out = scores.where(F.col("keyword").endswith("#1")).select("keyword").distinct()
    return signals.candidates(scores, AS_OF, 0.5, cluster_keywords(scores), out)


@query("top09_top_keywords", f"SELECT keyword, round(max(z_score), {R}) AS max_z, count(*) AS n_weeks FROM z WHERE z_score >= 1.2 GROUP BY keyword ORDER BY max(z_score) DESC NULLS LAST, keyword LIMIT 50", "z")
def agg12(spark, d):
    rows = weekly.high(z(spark, d), 1.2).groupBy("keyword").agg(F.max("z_score").alias("m"), F.count("*").alias("n_weeks"))
    return rows.orderBy(F.desc_nulls_last("m"), "keyword").limit(50).select("keyword", F.round("m", R).alias("max_z"), "n_weeks")


@query("agg09_keywords_per_week", "SELECT week, count(*) AS keywords FROM freq GROUP BY week", "freq")
def agg09(spark, d):
    return freq(spark, d).groupBy("week").agg(F.count("*").alias("keywords"))


@query("agg10_source_distribution", "SELECT source, sum(count)::BIGINT AS total FROM weekly_keywords GROUP BY source", "weekly_keywords")
def agg10(spark, d):
    return facts(spark, d).groupBy("source").agg(F.sum("count").alias("total"))


@query("api01_weeks", "SELECT week, week = (SELECT max(week) FROM freq) AS latest FROM (SELECT DISTINCT week FROM freq)", "freq")
def api01(spark, d):
    weeks = freq(spark, d).select("week").distinct()
    return weeks.crossJoin(F.broadcast(weeks.agg(F.max("week").alias("m")))).select("week", (F.col("week") == F.col("m")).alias("latest"))


@query("api06_range_zscore", f"SELECT week, keyword, round(z_score, {R}) + 0.0 AS z_score FROM z WHERE week BETWEEN '1997-W01' AND '1997-W26' AND keyword IN (SELECT keyword FROM z WHERE week BETWEEN '1997-W01' AND '1997-W26' GROUP BY keyword ORDER BY round(max(z_score), 9) DESC, keyword LIMIT 20)", "z")
def api06(spark, d):
    scores = z(spark, d).where(F.col("week").between("1997-W01", "1997-W26"))
    top = scores.groupBy("keyword").agg(F.max("z_score").alias("m")).orderBy(F.desc(F.round("m", 9)), "keyword").limit(20)
    return scores.join(F.broadcast(top), "keyword", "left_semi").select("week", "keyword", (F.round("z_score", R) + 0.0).alias("z_score"))


@query("flt17_raw_page", "SELECT week, keyword, count, (SELECT count(*) FROM freq WHERE week = '1996-W10') AS total FROM freq WHERE week = '1996-W10' ORDER BY count DESC, keyword LIMIT 50 OFFSET 50", "freq")
def flt17(spark, d):
    rows = freq(spark, d).where("week = '1996-W10'")
    page = rows.orderBy(F.desc("count"), "keyword").offset(50).limit(50)
    return page.crossJoin(F.broadcast(rows.agg(F.count("*").alias("total"))))


@query("flt13_scope", "SELECT week, keyword, count FROM (SELECT *, dense_rank() OVER (ORDER BY week) AS nr FROM freq WHERE contains(lower(keyword), 'red') AND week >= '1995-W01' AND week <= '1996-W52') WHERE nr > 4 AND nr <= 24", "freq")
def flt13(spark, d):
    rows = freq(spark, d).where(F.contains(F.lower("keyword"), F.lit("red")) & F.col("week").between("1995-W01", "1996-W52"))
    weeks = rows.select("week").distinct().withColumn("nr", F.row_number().over(Window.orderBy("week"))).where("nr > 4 AND nr <= 24")
    return rows.join(F.broadcast(weeks), "week", "left_semi")


@query("set05_week_diff", "SELECT coalesce(a.keyword, b.keyword) AS keyword, CASE WHEN a.keyword IS NULL THEN 'added' WHEN b.keyword IS NULL THEN 'dropped' ELSE 'kept' END AS change FROM (SELECT keyword FROM freq WHERE week = '1996-W10') a FULL OUTER JOIN (SELECT keyword FROM freq WHERE week = '1996-W11') b ON a.keyword = b.keyword", "freq")
def set05(spark, d):
    f = freq(spark, d)
    a, b = (f.where(F.col("week") == w).select("keyword", F.lit(True).alias(n)) for w, n in (("1996-W10", "was"), ("1996-W11", "now")))
    return a.join(b, "keyword", "full").select("keyword", F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "dropped").otherwise("kept").alias("change"))


@query("set06_latest_week", "SELECT max(week) AS week FROM freq", "freq")
def set06(spark, d):
    return freq(spark, d).agg(F.max("week").alias("week"))


# Articles: words, contexts, sentences.
_NORM = "regexp_replace(lower(w), '[^0-9a-z가-힣]+', '', 'g')"
define("articles", "SELECT doc_id AS news_id, strftime(DATE '2024-01-01' + CAST(doc_id % 70 AS INTEGER), '%Y%m%d') AS date, strftime(DATE '2024-01-01' + CAST(doc_id % 70 AS INTEGER), '%G-W%V') AS week, source AS press, string_split(text, chr(10))[1] AS title, text AS body FROM documents")
define("words", r"SELECT week, news_id, press, list_filter(string_split_regex(body, '\s+'), lambda x: x <> '') AS ws FROM articles", "articles")
define("occ", f"SELECT * FROM (SELECT week, news_id, press, {_NORM} AS keyword, array_to_string(ws[greatest(1, i - 2):i - 1], ' ') AS before, array_to_string(ws[i + 1:i + 2], ' ') AS after FROM (SELECT *, ws[i] AS w FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM words))) WHERE length(keyword) >= 2 AND (regexp_matches(keyword, '[가-힣]') OR regexp_matches(keyword, '[A-Za-z].*[A-Za-z]'))", "words")


def article_words(spark, d):
    """(week, keyword, source, count) of the words of all articles."""
    return stage(spark, d, "article_keywords", lambda s, f: contexts.weekly_keywords(contexts.tokens(tables.articles(s, f))), "documents")


def context_lists(spark, d):
    return stage(spark, d, "weekly_keyword_context", lambda s, f: contexts.context_lists(tables.articles(s, f, spread_out=False)), "documents")


def ctx(spark, d):
    return contexts.in_rows(context_lists(spark, d))


def nbr(spark, d):
    return stage(spark, d, "weekly_keyword_neighbor", lambda s, f: contexts.neighbours(tables.articles(s, f, spread_out=False)), "documents")


@query("src01_week_articles", "SELECT news_id, date, week, press, title FROM articles WHERE date BETWEEN '20240108' AND '20240114'", "articles")
def src01(spark, d):
    rows = tables.articles(spark, d).where(F.col("date").between("20240108", "20240114"))
    return rows.dropDuplicates(["news_id"]).drop("body")


@query("msc11_article_keywords", "SELECT week, keyword, coalesce(nullif(press, ''), 'unknown') AS source, CAST(count(*) AS INTEGER) AS count FROM occ GROUP BY ALL", "occ")
def msc11(spark, d):
    return article_words(spark, d)


define("ctx", "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY week, keyword ORDER BY occ_count DESC, before, after) AS INTEGER) AS rank FROM (SELECT week, keyword, before, after, CAST(count(*) AS INTEGER) AS occ_count FROM occ GROUP BY ALL)) WHERE rank <= 3", "occ")


@query("agg23_contexts", "SELECT week, keyword, before, after, occ_count, rank FROM ctx", "ctx")
def agg23(spark, d):
    return ctx(spark, d)


define("nbr", "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY week, keyword, position ORDER BY count DESC, term) AS INTEGER) AS rank FROM (SELECT week, keyword, position, term, CAST(count(*) AS INTEGER) AS count FROM (SELECT week, keyword, 'before' AS position, unnest(string_split(before, ' ')) AS term FROM occ UNION ALL SELECT week, keyword, 'after', unnest(string_split(after, ' ')) FROM occ) WHERE term <> '' GROUP BY ALL)) WHERE rank <= 5", "occ")


@query("top04_neighbours", "SELECT week, keyword, position, term, count, rank FROM nbr", "nbr")
def top04(spark, d):
    return nbr(spark, d)


@query("join05_with_context", """SELECT w.week, w.keyword, w.source, w.count, c.shown, n.around FROM (SELECT week, keyword, coalesce(nullif(press, ''), 'unknown') AS source, CAST(count(*) AS INTEGER) AS count FROM occ GROUP BY ALL) w
  JOIN (SELECT week, keyword, string_agg('…' || before || ' [' || keyword || '] ' || after || '… (×' || occ_count || ')', chr(10) ORDER BY rank) AS shown FROM ctx GROUP BY ALL) c ON c.week = w.week AND c.keyword = w.keyword
  LEFT JOIN (SELECT week, keyword, coalesce(string_agg(term, ', ' ORDER BY rank) FILTER (WHERE position = 'before'), '-') || ' / ' || coalesce(string_agg(term, ', ' ORDER BY rank) FILTER (WHERE position = 'after'), '-') AS around FROM nbr GROUP BY ALL) n ON n.week = w.week AND n.keyword = w.keyword""", "occ", "ctx", "nbr")
def join05(spark, d):
    """Counts, contexts and neighbours have one key and come from the same blocks, so nothing is joined."""
    rows = contexts.described(tables.articles(spark, d, spread_out=False)).where("week IS NOT NULL")
    line = lambda c: F.concat(F.lit("…"), c["before"], F.lit(" ["), F.col("keyword"), F.lit("] "), c["after"], F.lit("… (×"), c["occ_count"].cast("string"), F.lit(")"))
    side = lambda p: F.coalesce(F.nullif(F.array_join(p, ", "), F.lit("")), F.lit("-"))
    around = F.when(F.size("before") + F.size("after") > 0, F.concat(side("before"), F.lit(" / "), side("after")))
    rows = rows.select("week", "keyword", F.array_join(F.transform("contexts", line), "\n").alias("shown"), around.alias("around"), F.explode("presses").alias("p"))
    return rows.select("week", "keyword", F.col("p.press").alias("source"), "p.count", "shown", "around")


@query("join06_without_context", "SELECT f.week, f.keyword, f.count FROM freq f WHERE NOT EXISTS (SELECT 1 FROM cluster_keywords c WHERE c.week = f.week AND c.keyword = f.keyword)", "freq", "cluster_keywords")
def join06(spark, d):
    f = freq(spark, d)
    return f.join(cluster_keywords(z(spark, d)), ["week", "keyword"], "left_anti")


# Senses: one for each side word of a keyword's best contexts.
define("senses", "SELECT week, keyword, CAST(rank - 1 AS INTEGER) AS sense_id, occ_count AS count, nullif(string_split(after, ' ')[1], '') AS label, before, after FROM ctx", "ctx")


@query("agg06_multi_sense", "SELECT week, keyword, count(*) AS senses, string_agg('▸' || coalesce(label, '(?)') || ' ' || count, '   ' ORDER BY sense_id) AS shown, sum(count)::BIGINT AS total FROM senses GROUP BY ALL HAVING count(*) >= 2", "senses")
def agg06(spark, d):
    """The senses of a keyword of a week are its contexts, which lie in one row: nothing is grouped."""
    part = lambda c: F.concat(F.lit("▸"), F.coalesce(F.nullif(F.split(c["after"], " ")[0], F.lit("")), F.lit("(?)")), F.lit(" "), c["occ_count"].cast("string"))
    total = F.aggregate("contexts", F.lit(0).cast("long"), lambda n, c: n + c["occ_count"])
    rows = context_lists(spark, d).where(F.size("contexts") >= 2)
    return rows.select("week", "keyword", F.size("contexts").cast("long").alias("senses"), F.array_join(F.transform("contexts", part), "   ").alias("shown"), total.alias("total"))


@query("join07_single_sense", "SELECT week, keyword, count, label, '…' || before || ' [' || keyword || '] ' || after || '…' AS shown FROM senses WHERE (week, keyword) IN (SELECT week, keyword FROM senses GROUP BY ALL HAVING count(*) = 1)", "senses")
def join07(spark, d):
    """Senses that are their keyword's only one: rows of a week and keyword that have one context."""
    one = context_lists(spark, d).where("size(contexts) = 1 AND week IS NOT NULL AND keyword IS NOT NULL").select("week", "keyword", F.col("contexts")[0].alias("c"))
    label = F.nullif(F.split("c.after", " ")[0], F.lit(""))
    return one.select("week", "keyword", F.col("c.occ_count").alias("count"), label.alias("label"), F.concat(F.lit("…"), "c.before", F.lit(" ["), "keyword", F.lit("] "), "c.after", F.lit("…")).alias("shown"))


@query("agg27_distinctive_terms", f"""SELECT week, term, tf, round(score, {R}) AS score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY week ORDER BY round(score, 9) DESC, term) AS INTEGER) AS rank FROM (SELECT t.week, t.term, tf, tf * (ln((1 + (SELECT count(DISTINCT week) FROM occ)) / CAST(1 + df AS DOUBLE)) + 1) AS score FROM (SELECT week, keyword AS term, count(*) AS tf FROM occ GROUP BY ALL) t JOIN (SELECT keyword AS term, count(DISTINCT week) AS df FROM occ GROUP BY ALL) f ON f.term = t.term)) WHERE rank <= 10""", "occ")
def agg27(spark, d):
    words = contexts.tokens(tables.articles(spark, d)).select("week", F.col("keyword").alias("term"))
    return contexts.distinctive_terms(words, "week", 10).withColumn("score", F.round("score", R))


@query("scl01_collapse", r"SELECT doc_id, md5(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))) AS digest FROM documents")
def scl01(spark, d):
    return tables.table(spark, d, "documents").select("doc_id", F.md5(text.collapse(F.col("text"))).alias("digest"))


@query("scl05_tokens", "SELECT doc_id, len(regexp_extract_all(text, '[가-힣A-Za-z0-9]{2,}')) AS n, regexp_extract_all(text, '[가-힣A-Za-z0-9]{2,}')[1] AS first_token FROM documents")
def scl05(spark, d):
    found = text.tokens(F.col("text"))
    return tables.table(spark, d, "documents").select("doc_id", F.size(found).cast("long").alias("n"), F.try_element_at(found, F.lit(1)).alias("first_token"))


# A sentence ends behind one of six signs before white space. DuckDB has no look-behind, so the end is marked first.
define("sents", r"""SELECT week, news_id, title, CAST(unnest(range(0, len(p))) AS INTEGER) AS i, unnest(p) AS s FROM (SELECT week, news_id, title, list_filter(list_transform(string_split(regexp_replace(trim(coalesce(body, '')), '([.!?。！？])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS p FROM articles)""", "articles")


@query("win16_sentence_weights", r"""SELECT week, sentence, round(sum(weight), 6) AS weight FROM (SELECT week, trim(regexp_replace(coalesce(title, ''), '\s+', ' ', 'g')) AS sentence, CAST(3.0 AS DOUBLE) AS weight FROM articles
  UNION ALL SELECT week, trim(regexp_replace(s, '\s+', ' ', 'g')), greatest(pow(CAST(0.8 AS DOUBLE), i), CAST(0.2 AS DOUBLE)) FROM sents) WHERE sentence <> '' GROUP BY ALL""", "articles", "sents")
def win16(spark, d):
    return contexts.weighted_sentences(tables.articles(spark, d)).withColumn("weight", F.round("weight", R))


@query("flt11_boilerplate", r"SELECT doc_id FROM documents WHERE regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}') OR contains(lower(text), 'licensed under') OR contains(lower(text), 'copyright')")
def flt11(spark, d):
    t = F.col("text")
    return tables.table(spark, d, "documents").where(t.rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}") | F.contains(F.lower(t), F.lit("licensed under")) | F.contains(F.lower(t), F.lit("copyright"))).select("doc_id")


@query("flt10_valid_tokens", "SELECT keyword, count(*) AS n FROM occ GROUP BY keyword", "occ")
def flt10(spark, d):
    return article_words(spark, d).groupBy("keyword").agg(F.sum("count").alias("n"))
