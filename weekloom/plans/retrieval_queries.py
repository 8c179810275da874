"""Queries of retrieval and enrichment: scans of articles, filter chains, re-ranking, prompts, parsed replies, streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weekloom import session
from weekloom.functions import dates, text, vectors
from weekloom.operators import blocked, density, enrich, retrieval, similar, threads
from weekloom.operators import groups as groups_of
from weekloom.plans.reader_queries import groups, keysentences, products, tc
from weekloom.plans.registry import define, query
from weekloom.plans.scalar_queries import said
from weekloom.plans.stages import stage
from weekloom.plans.vector_queries import vec
from weekloom.plans.view_queries import cluster_keywords
from weekloom.plans.view_queries import clusters as keyword_clusters
from weekloom.plans.weekly_queries import R, freq, z
from weekloom.session import stored
from weekloom.sources import ingest, tables
from weekloom.streaming import weekly as stream

WEEK = "2024-W02"


# Scans.
@query("src02_week_points", "SELECT news_id, date FROM (SELECT DISTINCT news_id, date FROM articles WHERE week = '2024-W02') ORDER BY news_id LIMIT 200", "articles")
def src02(spark, d):
    """The articles of a week, once each, at most so many as asked for."""
    return tables.articles(spark, d).where(F.col("week") == WEEK).dropDuplicates(["news_id"]).orderBy("news_id").limit(200).select("news_id", "date")


@query("src03_week_points_checked", "SELECT week, press, count(DISTINCT news_id) AS n FROM articles WHERE date BETWEEN '20240108' AND '20240114' AND week = '2024-W02' GROUP BY week, press", "articles")
def src03(spark, d):
    """The same by day bounds and checked by week again."""
    rows = tables.articles(spark, d).where(F.col("date").between("20240108", "20240114") & (F.col("week") == WEEK))
    return rows.groupBy("week", "press").agg(F.count_distinct("news_id").alias("n"))


@query("src04_body_matches", "SELECT news_id FROM articles WHERE contains(body, 'the') ORDER BY news_id LIMIT 300", "articles")
def src04(spark, d):
    return tables.articles(spark, d).where(F.contains("body", F.lit("the"))).orderBy("news_id").limit(300).select("news_id")


@query("src20_melted", "SELECT event_type, 'g' || g AS name, n FROM (SELECT event_type, user_id % 3 AS g, count(*) AS n FROM events GROUP BY ALL)")
def src20(spark, d):
    """A wide table with a column for each group, long again without its zeros."""
    rows = tables.table(spark, d, "events").withColumn("g", F.concat(F.lit("g"), (F.col("user_id") % 3).cast("string")))
    wide = rows.groupBy("event_type").pivot("g", ["g0", "g1", "g2"]).count().na.fill(0)
    return wide.unpivot(["event_type"], ["g0", "g1", "g2"], "name", "n").where("n <> 0")


@query("flt07_week_or_file_range", "SELECT news_id FROM articles WHERE date IN ('20240108', '20240109', '20240110', '20240111', '20240112', '20240113', '20240114') OR (strftime(date_trunc('month', strptime(date, '%Y%m%d')), '%Y%m%d') <= '20240114' AND strftime(date_trunc('month', strptime(date, '%Y%m%d')) + INTERVAL 9 DAY, '%Y%m%d') >= '20240108')", "articles")
def flt07(spark, d):
    """Articles dated on one of a week's days, or from a file whose range of days meets the week."""
    start = F.date_trunc("month", F.to_date("date", "yyyyMMdd")).cast("date")
    rows = tables.articles(spark, d).withColumns({"low": F.date_format(start, "yyyyMMdd"), "high": F.date_format(F.date_add(start, 9), "yyyyMMdd")})
    days = dates.days_of(F.lit(WEEK))
    return rows.where(F.array_contains(days, F.col("date")) | ((F.col("low") <= F.element_at(days, 7)) & (F.col("high") >= F.element_at(days, 1)))).select("news_id")


@query("flt18_row_guards", "SELECT CAST(doc_id AS VARCHAR) AS id, length(text[1:2000]) AS n FROM documents WHERE doc_id IS NOT NULL AND CAST(doc_id AS VARCHAR) <> '' AND text IS NOT NULL")
def flt18(spark, d):
    """Rows with an id, their snippet cut to the length that the table holds."""
    rows = tables.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.substring("text", 1, 2000).alias("snippet"))
    return rows.where("id IS NOT NULL AND id <> '' AND snippet IS NOT NULL").select("id", F.length("snippet").cast("long").alias("n"))


# Articles for a keyword: its sources and the word, else its sources, else all.
_KEY = "regexp_replace(lower(coalesce({0}, '')), '[^0-9a-z가-힣]+', '', 'g')"
define("asked", "SELECT week, keyword, source FROM (SELECT week, keyword, coalesce(nullif(press, ''), 'unknown') AS source, row_number() OVER (PARTITION BY week ORDER BY count(*) DESC, keyword, press) AS nr FROM occ WHERE length(keyword) >= 5 GROUP BY week, keyword, press) WHERE nr <= 3", "occ")
define("tiers", f"SELECT q.week, q.keyword, q.source AS hint, a.news_id, a.press, a.title, CASE WHEN a.press = q.source AND contains({_KEY.format('a.title || a.body')}, q.keyword) THEN 0 WHEN a.press = q.source THEN 1 ELSE 2 END AS tier FROM asked q JOIN articles a ON a.week = q.week", "asked", "articles")


def asked(spark, d):
    from weekloom.plans.view_queries import article_words

    rows = article_words(spark, d).where("length(keyword) >= 5")
    nr = F.row_number().over(Window.partitionBy("week").orderBy(F.desc("count"), "keyword", "source"))
    return rows.withColumn("nr", nr).where("nr <= 3").select("week", "keyword", "source")


@query("join15_tiered_articles", f"SELECT week, keyword, hint, tier, CAST(count(*) AS BIGINT) AS n, min(news_id) AS first_id FROM (SELECT *, min(tier) OVER (PARTITION BY week, keyword, hint) AS best FROM (SELECT week, keyword, hint, tier, min(news_id) AS news_id FROM tiers GROUP BY week, keyword, hint, tier, {_KEY.format('press')} || {_KEY.format('title')})) WHERE tier = best GROUP BY ALL", "tiers")
def join15(spark, d):
    """Articles of the best tier that has any, one for each source and title. The few asked keywords of a week meet its articles."""
    a = tables.articles(spark, d).select("week", "news_id", "press", text.normalise_keyword(F.concat("title", "body")).alias("whole"), F.concat(text.normalise_keyword(F.col("press")), text.normalise_keyword(F.col("title"))).alias("key"))
    rows = a.join(similar.few(asked(spark, d)), "week")
    tier = F.when((F.col("press") == F.col("source")) & F.contains("whole", F.col("keyword")), 0).when(F.col("press") == F.col("source"), 1).otherwise(2)
    once = rows.select("week", "keyword", F.col("source").alias("hint"), tier.alias("tier"), "key", "news_id").groupBy("week", "keyword", "hint", "tier", "key").agg(F.min("news_id").alias("news_id"))
    best = F.min("tier").over(Window.partitionBy("week", "keyword", "hint"))
    return once.withColumn("best", best).where("tier = best").groupBy("week", "keyword", "hint", "tier").agg(F.count("*").alias("n"), F.min("news_id").alias("first_id"))


@query("top12_keyword_rerank", f"SELECT week, keyword, news_id, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY week, keyword ORDER BY score DESC, CAST(news_id AS VARCHAR)) AS rank FROM (SELECT DISTINCT q.week, q.keyword, a.news_id, CASE WHEN contains({_KEY.format('a.title || a.body')}, q.keyword) THEN CAST(1 AS DOUBLE) ELSE 0 END AS score FROM (SELECT DISTINCT week, keyword FROM asked) q JOIN articles a ON a.week = q.week)) WHERE rank <= 10", "asked", "articles")
def top12(spark, d):
    """The ten articles of a keyword and week: those with the word first, then by id as a text."""
    a = tables.articles(spark, d).select("week", "news_id", text.normalise_keyword(F.concat("title", "body")).alias("whole"))
    hits = a.join(similar.few(asked(spark, d).select("week", "keyword").distinct()), "week").select("week", "keyword", "news_id", F.when(F.contains("whole", F.col("keyword")), 1.0).otherwise(0.0).alias("score")).distinct()
    rank = F.row_number().over(Window.partitionBy("week", "keyword").orderBy(F.desc("score"), F.col("news_id").cast("string")))
    return hits.withColumn("rank", rank).where("rank <= 10")


# Vectors: filter chains and two phases.
_SIM = "list_cosine_similarity({0}, {1})"
define("q20", "SELECT id AS query_id, e AS q, week AS qweek, label AS qlabel FROM vec WHERE id % 20 = 0", "vec")


@query("top05_retrieval_hits", f"SELECT query_id, id, round(score, {R}) AS score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS INTEGER) AS rank FROM (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS wide FROM (SELECT query_id, id, {_SIM.format('e', 'q')} AS score, label, qlabel FROM q20 JOIN vec ON week = qweek AND id <> query_id)) WHERE wide <= 30) WHERE rank <= 10", "q20", "vec")
def top05(spark, d):
    """The ten best of a wide first search: three times as many hits, 30 at least, of the query's week."""
    v = vec(spark, d)
    wide = blocked.nearest(v, v.where("id % 20 = 0"), ["week"], "e", max(30, 3 * 10))
    return wide.where("rank <= 10").withColumn("score", F.round("score", R))


@query("vec06_filter_chain", f"SELECT query_id, tier, CAST(count(*) AS BIGINT) AS n, min(id) AS first_id FROM (SELECT *, min(tier) OVER (PARTITION BY query_id) AS best FROM (SELECT query_id, id, CASE WHEN label = qlabel AND {_SIM.format('e', 'q')} >= 0.35 THEN 0 WHEN {_SIM.format('e', 'q')} >= 0.35 THEN 1 ELSE 2 END AS tier FROM q20 JOIN vec ON week = qweek AND id <> query_id)) WHERE tier = best GROUP BY ALL", "q20", "vec")
def vec06(spark, d):
    """Hits under the strictest filter that leaves any: label and score, score alone, then the week alone.

    Vectors meet in blocks, which count hits by tier. Those that have no cosine, or none in blocks (null or zero vectors,
    components that are no numbers, other lengths than most, labels below 0), are compared one by one.
    """
    v, size = vec(spark, d), vectors.norm(F.col("e"))
    dim = v.groupBy(F.size("e").alias("dim")).count().where("dim > 0").agg(F.max_by("dim", F.struct("count", "dim"))).first()[0]
    plain = (F.size("e") == F.lit(dim)) & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (size > 1e-150) & (F.col("label") >= 0) & F.col("id").isNotNull()
    v = stored(v.withColumn("plain", F.coalesce(plain, F.lit(False))), "vectors")
    q = v.where("id % 20 = 0")
    blocks = blocked.tiers(v.where("plain"), q.where("plain"), ["week"], "e", "label", 0.35)
    asked = q.select("week", F.col("id").alias("query_id"), F.col("e").alias("q"), F.col("label").alias("qlabel"), F.col("plain").alias("qplain"))
    near = vectors.cosine(F.col("e"), F.col("q")) >= 0.35
    tier = F.when(near & (F.col("label") == F.col("qlabel")), 0).when(near, 1).otherwise(2).alias("tier")
    apart = [v.where("NOT plain").join(asked, "week"), v.where("plain").join(asked.where("NOT qplain"), "week")]
    pairs = apart[0].unionByName(apart[1]).where("id <> query_id").select("query_id", tier, F.lit(1).cast("long").alias("n"), F.col("id").alias("first_id"))
    counted = blocks.unionByName(pairs).groupBy("query_id", "tier").agg(F.sum("n").alias("n"), F.min("first_id").alias("first_id"))
    best = F.min("tier").over(Window.partitionBy("query_id"))
    return counted.withColumn("best", best).where("tier = best").drop("best")


# The whole chain: points are vectors with their articles; one query in three has no vector.
_NORM = "regexp_replace(lower({0}), '[^0-9a-z가-힣]+', '', 'g')"
define("points", f"SELECT v.id, v.e, strptime(a.date, '%Y%m%d') AS day, {_NORM.format("a.title || ' ' || a.body")} AS norm FROM vec v JOIN articles a ON a.news_id = v.id", "vec", "articles")
define("asked_points", "SELECT p.id AS query_id, date_trunc('week', p.day) AS monday, w.keyword AS word, CASE WHEN p.id % 60 <> 0 THEN p.e END AS q, p.id % 40 = 0 AS active FROM points p JOIN week_words w ON w.week = strftime(p.day, '%G-W%V') AND w.place = p.id % 7 + 1 WHERE p.id % 20 = 0", "points", "week_words")


def _chain(asked: str, vector: str) -> str:
    """The chain in SQL over a table of queries: query_id, monday, word, and the vector."""
    return f"""inside AS (SELECT q.query_id, q.word, q.{vector} AS q, p.id, p.e, p.norm FROM {asked} q JOIN points p ON p.id <> q.query_id AND (date_trunc('week', p.day) = q.monday OR (date_trunc('month', p.day) < q.monday + INTERVAL 7 DAY AND date_trunc('month', p.day) + INTERVAL 9 DAY >= q.monday))),
    wide AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, id) AS nr FROM (SELECT *, list_cosine_similarity(e, q) AS s FROM inside WHERE q IS NOT NULL)),
    bumped AS (SELECT query_id, id, nr, s + CASE WHEN contains(norm, word) THEN 0.005 ELSE 0 END AS score FROM wide WHERE nr <= 30),
    near AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, nr) AS rank, 'vector' AS path FROM bumped),
    scan AS (SELECT query_id, id, CASE WHEN contains(norm, word) THEN 1.0 ELSE 0.0 END AS score, row_number() OVER (PARTITION BY query_id ORDER BY contains(norm, word) DESC, CAST(id AS VARCHAR)) AS rank, 'scan' AS path FROM inside WHERE q IS NULL),
    chain AS (SELECT * FROM near WHERE rank <= 10 UNION ALL SELECT * FROM scan WHERE rank <= 10)"""


def points(spark, d):
    a = tables.articles(spark, d).withColumn("day", F.to_date("date", "yyyyMMdd"))
    start = F.trunc("day", "month")
    low, high = (F.date_trunc("week", x).cast("date") for x in (start, F.date_add(start, 9)))
    of_file = F.transform(F.sequence(low, high, F.expr("interval 7 days")), dates.iso_week)
    rows = a.select(F.col("news_id").alias("id"), "week", F.array_union(F.array("week"), of_file).alias("weeks"), F.concat_ws(" ", "title", "body").alias("text"))
    return rows.join(vec(spark, d).select("id", "e"), "id")


def asked_points(spark, d, rows):
    from weekloom.plans.more_queries import week_words

    q = rows.where("id % 20 = 0").select(F.col("id").alias("query_id"), "week", (F.col("id") % 7 + 1).alias("place"), F.when(F.col("id") % 60 != 0, F.col("e")).alias("e"), (F.col("id") % 40 == 0).alias("active"))
    return q.join(week_words(spark, d), ["week", "place"]).select("query_id", "week", "keyword", "e", "active")


@query("vec06_retrieval_chain", f"SELECT query_id, id, round(score, {R}) AS score, CAST(rank AS INTEGER) AS rank, path FROM (WITH {_chain('asked_points', 'q')} SELECT * FROM chain)", "points", "asked_points")
def vec06_chain(spark, d):
    """Ten contexts for each query: its week's rows by vector with the keyword's bump, or a scan where it has no vector."""
    rows = stored(points(spark, d), "points")
    found = retrieval.contexts(rows, stored(asked_points(spark, d, rows), "asked"), "e")
    return found.withColumn("score", F.round("score", R))


@query("vec08_summary_search", f"""SELECT query_id, id, round(score, {R}) AS score, CAST(rank AS INTEGER) AS rank, path FROM (WITH active AS (SELECT * FROM asked_points WHERE active), {_chain('active', 'q')},
    means AS (SELECT query_id, list(m ORDER BY i) AS m FROM (SELECT query_id, i, avg(x) AS m FROM (SELECT c.query_id, unnest(p.e) AS x, unnest(range(1, len(p.e) + 1)) AS i FROM chain c JOIN points p USING (id) WHERE c.rank <= 3) GROUP BY ALL) GROUP BY ALL),
    seeded AS (SELECT a.query_id, a.monday, a.word, coalesce(m.m, a.q) AS q FROM active a LEFT JOIN means m USING (query_id)) SELECT * FROM (WITH {_chain('seeded', 'q')} SELECT * FROM chain))""", "points", "asked_points")
def vec08_summary(spark, d):
    """The second phase: contexts found with the mean of the first three; carried-over queries that aren't active are skipped."""
    rows = stored(points(spark, d), "points")
    found = retrieval.two_phases(rows, stored(asked_points(spark, d, rows), "asked"), "e")
    return found.withColumn("score", F.round("score", R))


define("first_hit", f"SELECT query_id, arg_max(id, (round({_SIM.format('e', 'q')}, 9), -id)) AS seed FROM q20 JOIN vec ON week = qweek AND id <> query_id GROUP BY query_id", "q20", "vec")


@query("vec08_two_phases", f"SELECT query_id, seed, id, round(score, {R}) AS score FROM (SELECT f.query_id, f.seed, v.id, {_SIM.format('v.e', 's.e')} AS score, row_number() OVER (PARTITION BY f.query_id ORDER BY round({_SIM.format('v.e', 's.e')}, 9) DESC, v.id) AS rank FROM first_hit f JOIN vec s ON s.id = f.seed JOIN vec v ON v.week = s.week AND v.id <> f.seed AND v.id <> f.query_id) WHERE rank <= 5", "first_hit", "vec")
def vec08(spark, d):
    """A second search from what the first one found best."""
    v = vec(spark, d)
    first = blocked.nearest(v, v.where("id % 20 = 0"), ["week"], "e", 1).select("query_id", F.col("id").alias("seed"))
    seeds = stored(v.join(first, F.col("id") == F.col("seed")).select("week", "query_id", "seed", "e"), "seeds")
    # One hit more than asked, as the first query itself may be among them; a seed never finds itself.
    hits = blocked.nearest(v, seeds.select("week", F.col("seed").alias("id"), "e").distinct(), ["week"], "e", 6)
    own = hits.withColumnRenamed("query_id", "seed").join(seeds.select("query_id", "seed"), "seed").where("id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))
    return own.withColumn("nr", rank).where("nr <= 5").select("query_id", "seed", "id", F.round("score", R).alias("score"))


@query("vec18_sense_gate", f"SELECT label, n, round(coh, {R}) AS cohesion, coh >= 0.4 OR n < 3 AS single FROM (SELECT label, count(*) AS n, avg(s) AS coh FROM (SELECT v.label, {_SIM.format('v.e', 'c.c')} AS s FROM vec v JOIN label_cent c ON c.label = v.label) GROUP BY label)", "vec", "label_cent")
def vec18(spark, d):
    """Whether the contexts of a keyword are one sense: they lie near their centroid, or are too few to be split."""
    v = vec(spark, d)
    near = v.join(similar.few(vectors.mean_vector(v, ["label"], "e")), "label").select("label", vectors.cosine(F.col("e"), F.col("centroid")).alias("s"))
    rows = near.groupBy("label").agg(F.count("*").alias("n"), F.avg("s").alias("c"))
    return rows.select("label", "n", F.round("c", R).alias("cohesion"), ((F.col("c") >= 0.4) | (F.col("n") < 3)).alias("single"))


define("grid", "SELECT a AS alpha, CAST(1 AS DOUBLE) - a AS beta, t AS least FROM (SELECT unnest([0.15, 0.3, 0.5]::DOUBLE[]) AS a) CROSS JOIN (SELECT unnest([0.3, 0.42, 0.6]::DOUBLE[]) AS t)")
define("steps", f"SELECT a.label, a.week, CAST((CASE WHEN a.label = b.label THEN 2 ELSE 1 END) AS DOUBLE) / (CASE WHEN a.label = b.label THEN 4 ELSE 5 END) AS overlap, {_SIM.format('a.c', 'b.c')} AS cos FROM cent a JOIN cent b ON CAST(b.week[7:8] AS INTEGER) = CAST(a.week[7:8] AS INTEGER) - 1 AND a.label = b.label", "cent")


@query("vec21_linker_grid", f"SELECT alpha, beta, least, CAST(count(*) FILTER (WHERE score >= least) AS BIGINT) AS links, round(avg(score), {R}) AS mean_score FROM (SELECT *, alpha * cos + beta * overlap AS score FROM steps CROSS JOIN grid) GROUP BY alpha, beta, least", "steps", "grid")
def vec21(spark, d):
    """How many links each setting of the linker would accept. The grid is a parameter; candidates are scored once."""
    c = tc(spark, d).select("week", F.substring("week", 7, 2).cast("int").alias("nr"), "label", "keywords", "centroid")
    before = c.select((F.col("nr") + 1).alias("nr"), "label", F.col("keywords").alias("was"), F.col("centroid").alias("p"))
    steps = c.join(before, ["nr", "label"]).select(text.jaccard(F.col("keywords"), F.col("was")).alias("overlap"), vectors.cosine(F.col("centroid"), F.col("p")).alias("cos"))
    grid = spark.createDataFrame([(a, 1 - a, t) for a in (0.15, 0.3, 0.5) for t in (0.3, 0.42, 0.6)], "alpha double, beta double, least double")
    score = F.col("alpha") * F.col("cos") + F.col("beta") * F.col("overlap")
    return steps.crossJoin(F.broadcast(grid)).groupBy("alpha", "beta", "least").agg(F.count_if(score >= F.col("least")).alias("links"), F.round(F.avg(score), R).alias("mean_score"))


@query("vec21_best_setting")
def vec21_best(spark, d):
    """The 36 settings of the linker by the quality of the threads that each makes of the weekly clusters, the best first."""
    return threads.grid_search(tc(spark, d), ["k1", "k3", "k5"])


@query("vec15_density_components")
def vec15(spark, d):
    """Density clusters of each week's vectors: at least five rows each, the nearest row as the core distance."""
    return density.clusters(vec(spark, d), ["week"], "e", 5, 1)


# Groups of keywords by what their articles are about, and the slots that groups keep.
define("word_stats", "SELECT week, keyword, n, CASE WHEN stddev_pop(n) OVER k > 0 THEN (n - avg(n) OVER k) / stddev_pop(n) OVER k ELSE 0.0 END AS z FROM (SELECT week, keyword, count(*) AS n FROM occ WHERE length(keyword) >= 5 GROUP BY ALL) WINDOW k AS (PARTITION BY keyword)", "occ")
define("word_rows", "SELECT w.week, w.keyword, w.place, v.e FROM week_words w JOIN articles a ON a.week = w.week AND contains(lower(a.title || chr(10) || a.body), w.keyword) JOIN vec v ON v.id = a.news_id", "week_words", "articles", "vec")
define("word_means", "SELECT week, keyword, place, list(m ORDER BY i) AS v FROM (SELECT week, keyword, place, i, avg(x) AS m FROM (SELECT week, keyword, place, unnest(e) AS x, unnest(range(1, len(e) + 1)) AS i FROM word_rows) GROUP BY ALL) GROUP BY ALL", "word_rows")
define("features", "SELECT m.week, CAST(m.week[1:4] AS BIGINT) * 1000000 + CAST(m.week[7:8] AS BIGINT) * 10000 + m.place AS node, m.keyword, s.z, s.n AS count, c.ctx, m.v FROM word_means m JOIN word_stats s USING (week, keyword) JOIN (SELECT r.week, r.keyword, avg(list_cosine_similarity(r.e, m.v)) AS ctx FROM word_rows r JOIN word_means m USING (week, keyword) GROUP BY ALL) c USING (week, keyword)", "word_means", "word_stats", "word_rows")
define("alike", "SELECT a.node AS a, b.node AS b FROM features a JOIN features b ON a.week = b.week AND list_cosine_similarity(a.v, b.v) >= 0.72", "features")
define("reach", "/*RECURSIVE*/SELECT node, node AS seen FROM features UNION SELECT r.node, e.b FROM reach r JOIN alike e ON e.a = r.seen", "features", "alike")
define("members_of", "SELECT f.*, c.component FROM features f JOIN (SELECT node, min(seen) AS component FROM reach GROUP BY node) c USING (node)", "features", "reach")
define("group_cent", "SELECT week, component, list(m ORDER BY i) AS c FROM (SELECT week, component, i, avg(x) AS m FROM (SELECT week, component, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM members_of) GROUP BY ALL) GROUP BY ALL", "members_of")
define("group_scores", """SELECT *, sum_z + 1.2 * sqrt(sum_count + 1) + mean_ctx + cohesion AS score FROM (SELECT week, component, sum(greatest(z, 0.0)) AS sum_z, CAST(sum(count) AS BIGINT) AS sum_count, avg(ctx) AS mean_ctx, string_agg(keyword, ', ' ORDER BY round(z, 9) DESC, keyword) AS keywords FROM members_of GROUP BY ALL)
  JOIN (SELECT m.component, coalesce(avg(list_cosine_similarity(m.v, o.v)), 1.0) AS cohesion FROM members_of m LEFT JOIN members_of o ON o.component = m.component AND o.node > m.node GROUP BY m.component) USING (component)""", "members_of")
define("week_groups", "SELECT *, dense_rank() OVER (ORDER BY week) AS nr FROM (SELECT *, row_number() OVER (PARTITION BY week ORDER BY round(score, 9) DESC, component) AS rank FROM group_scores) WHERE rank <= 5", "group_scores")
define("group_links", "SELECT component, prev, sim FROM (SELECT g.component, p.component AS prev, list_cosine_similarity(c.c, d.c) AS sim, row_number() OVER (PARTITION BY g.component ORDER BY round(list_cosine_similarity(c.c, d.c), 9) DESC, p.rank) AS nth FROM week_groups g JOIN week_groups p ON p.nr = g.nr - 1 JOIN group_cent c ON c.component = g.component JOIN group_cent d ON d.component = p.component) WHERE nth = 1 AND sim >= 0.75", "week_groups", "group_cent")
define("group_slots", "/*RECURSIVE*/SELECT component, 'trendgrp_' || lpad(CAST(row_number() OVER (ORDER BY nr, rank) AS VARCHAR), 6, '0') AS slot_id FROM week_groups WHERE component NOT IN (SELECT component FROM group_links) UNION ALL SELECT l.component, s.slot_id FROM group_slots s JOIN group_links l ON l.prev = s.component", "week_groups", "group_links")


def features(spark, d):
    """A week's words with the mean vector of the articles that hold them, how close these lie to it, and their z and count."""
    from weekloom.plans.more_queries import week_hits, week_words
    from weekloom.plans.view_queries import article_words

    counts = article_words(spark, d).where("length(keyword) >= 5").groupBy("week", "keyword").agg(F.sum("count").alias("count"))
    by = Window.partitionBy("keyword")
    far = F.stddev_pop("count").over(by)
    stats = counts.withColumn("z", F.when(far > 0, (F.col("count") - F.avg("count").over(by)) / far).otherwise(0.0))
    texts = tables.articles(spark, d).select("week", F.col("news_id").alias("id"), F.lower(F.concat("title", F.lit("\n"), "body")).alias("text"))
    rows = stored(week_hits(spark, d, texts).join(vec(spark, d).select("id", "e"), "id"), "word_rows")
    means = stored(vectors.mean_vector(rows, ["week", "keyword", "place"], "e", "v"), "means")
    close = rows.join(means, ["week", "keyword", "place"]).groupBy("week", "keyword").agg(F.avg(vectors.cosine(F.col("e"), F.col("v"))).alias("ctx"))
    node = dates.week_year(F.col("week")).cast("long") * 1_000_000 + dates.week_number(F.col("week")) * 10_000 + F.col("place")
    return means.join(close, ["week", "keyword"]).join(stats, ["week", "keyword"]).select("week", node.alias("node"), "keyword", "z", "count", "ctx", "v")


def week_groups(spark, d):
    return stage(spark, d, "keyword_groups", lambda s, f: groups_of.slotted(stored(groups_of.linked(groups_of.scored(stored(groups_of.grouped(stored(features(s, f), "features")), "members"))), "linked")), "documents", "embeddings")


@query("agg29_keyword_groups", f"SELECT week, rank, keywords, round(sum_z, {R}) AS sum_z, sum_count, round(mean_ctx, {R}) AS mean_ctx, round(cohesion, {R}) AS cohesion, round(score, {R}) AS score FROM (SELECT week, CAST(rank AS INTEGER) AS rank, keywords, sum_z, sum_count, mean_ctx, cohesion, score FROM week_groups)", "week_groups")
def agg29_groups(spark, d):
    """The five best groups of each week by z, counts, contexts and closeness."""
    four = {c: F.round(c, R) for c in ("sum_z", "mean_ctx", "cohesion", "score")}
    return week_groups(spark, d).select("week", "rank", F.array_join("keywords", ", ").alias("keywords"), "sum_z", "sum_count", "mean_ctx", "cohesion", "score").withColumns(four)


@query("sta04_group_slots", f"SELECT g.week, CAST(g.rank AS INTEGER) AS rank, g.week || '_g' || g.rank AS group_id, s.slot_id, p.week || '_g' || p.rank AS prev_group_id, round(l.sim, {R}) AS prev_sim FROM week_groups g JOIN group_slots s USING (component) LEFT JOIN group_links l USING (component) LEFT JOIN week_groups p ON p.component = l.prev", "week_groups", "group_slots", "group_links")
def sta04_slots(spark, d):
    """Slots of groups: inherited along the links to the nearest group of the week before, or new."""
    rows = week_groups(spark, d)
    named = rows.select(F.col("component").alias("prev"), F.concat("week", F.lit("_g"), F.col("rank").cast("string")).alias("prev_group_id"))
    return rows.join(named, "prev", "left").select("week", "rank", F.concat("week", F.lit("_g"), F.col("rank").cast("string")).alias("group_id"), "slot_id", "prev_group_id", F.round("prev_sim", R).alias("prev_sim"))


# Enrichment: prompts, and rows parsed from replies.
@query("enr02_group_prompts", "SELECT week, cluster_id, group_rank, keywords, CASE WHEN group_rank = 1 THEN 'Emerging' ELSE 'Active' END AS status, 'Group ' || group_rank || ' of ' || week || ': ' || keywords AS prompt FROM groups WHERE group_rank <= 3", "groups")
def enr02(spark, d):
    rows = groups(spark, d).where("group_rank <= 3")
    prompt = text.fill("Group {rank} of {week}: {kws}", {"rank": F.col("group_rank"), "week": F.col("week"), "kws": F.col("keywords")})
    return rows.select("week", "cluster_id", "group_rank", "keywords", F.when(F.col("group_rank") == 1, "Emerging").otherwise("Active").alias("status"), prompt.alias("prompt"))


@query("enr04_briefs", "SELECT week, k.keyword, p.name, 'Which goods go with ' || k.keyword || ' and ' || p.name || '?' AS prompt FROM (SELECT week, keyword FROM freq WHERE week = '1996-W10') k JOIN products p USING (week) WHERE p.rank <= 2", "freq", "products")
def enr04(spark, d):
    """A brief for each keyword of a week and each of its two best products."""
    words = freq(spark, d).where("week = '1996-W10'").select("week", "keyword")
    best = products(spark, d).where("week = '1996-W10' AND rank <= 2").select("week", "name")
    return words.join(F.broadcast(best), "week").select("week", "keyword", "name", text.fill("Which goods go with {kw} and {p}?", {"kw": F.col("keyword"), "p": F.col("name")}).alias("prompt"))


@query("enr05_cluster_prompts", f"SELECT week, cluster_id, 'Theme: ' || cluster_theme || chr(10) || 'Keywords: ' || kws || chr(10) || 'Mean z: ' || CAST(CAST(round(avg_z_score * 100) AS BIGINT) AS VARCHAR) AS prompt FROM clusters JOIN (SELECT week, cluster_id, string_agg(keyword, ', ' ORDER BY keyword) AS kws FROM (SELECT *, row_number() OVER (PARTITION BY week, cluster_id ORDER BY keyword) AS nr FROM cluster_keywords) WHERE nr <= 20 GROUP BY ALL) USING (week, cluster_id)", "clusters", "cluster_keywords")
def enr05(spark, d):
    """The prompt that interprets a cluster: theme, its first 20 keywords, and the mean z in hundredths."""
    members = cluster_keywords(z(spark, d))
    nr = F.row_number().over(Window.partitionBy("week", "cluster_id").orderBy("keyword"))
    kws = members.withColumn("nr", nr).where("nr <= 20").groupBy("week", "cluster_id").agg(F.array_join(F.sort_array(F.collect_list("keyword")), ", ").alias("kws"))
    rows = keyword_clusters(members).join(kws, ["week", "cluster_id"])
    prompt = text.fill("Theme: {theme}\nKeywords: {kws}\nMean z: {z}", {"theme": F.col("cluster_theme"), "kws": F.col("kws"), "z": F.round(F.col("avg_z_score") * 100).cast("long")})
    return rows.select("week", "cluster_id", prompt.alias("prompt"))


@query("enr06_cluster_queries", "SELECT week, cluster_id, CAST(rank AS INTEGER) AS rank, cluster_theme || ' ' || kind AS search_query FROM clusters CROSS JOIN (VALUES (1, 'review'), (2, 'price')) t(rank, kind)", "clusters")
def enr06(spark, d):
    """Queries for a cluster from a model's JSON; a reply without JSON gives the two of the template."""
    rows = keyword_clusters(cluster_keywords(z(spark, d))).select("week", "cluster_id", "cluster_theme")
    replied = enrich.replies(rows, F.concat(F.lit("queries for "), "cluster_theme"))
    parsed = F.from_json(text.json_part(F.col("reply")), "array<struct<search_query: string>>")
    template = F.transform(F.array(F.lit("review"), F.lit("price")), lambda kind: F.struct(F.concat("cluster_theme", F.lit(" "), kind).alias("search_query")))
    items = replied.select("week", "cluster_id", F.posexplode(F.coalesce(parsed, template)).alias("nr", "q"))
    return items.select("week", "cluster_id", (F.col("nr") + 1).alias("rank"), F.col("q.search_query").alias("search_query"))


@query("enr07_market_report", f"SELECT p_brand, n, round(mean, 2) AS mean, 'brand ' || p_brand || ': ' || n || ' offers' AS report FROM (SELECT p_brand, count(*) AS n, avg(p_retailprice) AS mean FROM part GROUP BY p_brand)")
def enr07(spark, d):
    rows = tables.table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n"), F.avg("p_retailprice").alias("mean"))
    return rows.select("p_brand", "n", F.round("mean", 2).alias("mean"), text.fill("brand {b}: {n} offers", {"b": F.col("p_brand"), "n": F.col("n")}).alias("report"))


@query("enr08_grounding_report", "SELECT CAST(count(*) AS BIGINT) AS names, CAST(count(*) FILTER (WHERE grounded) AS BIGINT) AS grounded FROM (SELECT a.name, bool_or(b.t IS NOT NULL) AS grounded FROM toks a LEFT JOIN (SELECT DISTINCT unnest(regexp_extract_all(lower(n_name), '[가-힣A-Za-z0-9]{2,}')) AS t FROM nation UNION SELECT 'red') b ON a.t = b.t GROUP BY a.name)", "toks")
def enr08(spark, d):
    """How many product names share a token with a small dictionary of categories."""
    names = tables.table(spark, d, "part").select(F.col("p_name").alias("name")).distinct().select("name", F.explode(F.array_distinct(text.tokens(F.lower("name")))).alias("t"))
    known = tables.table(spark, d, "nation").select(F.explode(text.tokens(F.lower("n_name"))).alias("t")).union(spark.createDataFrame([("red",)], "t string")).distinct().withColumn("known", F.lit(True))
    rows = names.join(known, "t", "left").groupBy("name").agg(F.bool_or(F.coalesce("known", F.lit(False))).alias("grounded"))
    return rows.agg(F.count("*").alias("names"), F.count_if("grounded").alias("grounded"))


@query("msc19_signal_rows", f"SELECT week, keyword, round(least(1.0, log10(greatest(1, evidence_count)) / 8), {R}) AS v, length(sentence) AS n FROM keysentence", "keysentence")
def msc19(spark, d):
    """A signal row for each key sentence of a week."""
    return keysentences(spark, d).select("week", "keyword", F.round(F.least(F.lit(1.0), F.log10(F.greatest(F.lit(1), F.col("evidence_count"))) / 8), R).alias("v"), F.length("sentence").cast("long").alias("n"))


@query("msc22_contracts", "SELECT conv_id, turn, tool, concat_ws('|', CASE WHEN tool IS NULL THEN 'tool' END, CASE WHEN turn % 2 = 1 THEN 'q' END, CASE WHEN turn % 4 = 3 THEN 'evidence' END) AS missing FROM (SELECT conv_id, turn, CASE WHEN turn % 3 <> 2 THEN role END AS tool FROM said)", "said")
def msc22(spark, d):
    """Which required fields an envelope lacks: a tool's name, an argument, and one piece of evidence."""
    args = F.struct(F.when(F.col("turn") % 2 == 0, F.concat(F.lit("x"), "a")).alias("q"))
    sent = F.struct(F.when(F.col("turn") % 3 != 2, F.col("role")).otherwise(F.lit("")).alias("tool"), args.alias("args"), F.when(F.col("turn") % 4 != 3, F.array("b")).otherwise(F.array()).alias("evidence"))
    rows = said(spark, d).select("conv_id", "turn", F.to_json(sent).alias("body")).withColumn("b", F.from_json("body", "tool string, args struct<q: string>, evidence array<string>"))
    rows = rows.select("conv_id", "turn", F.nullif("b.tool", F.lit("")).alias("tool"), F.col("b.args.q").alias("q"), F.size(F.coalesce("b.evidence", F.array())).alias("k"))
    lacks = F.array_compact(F.array(F.when(F.col("tool").isNull(), "tool"), F.when(F.col("q").isNull(), "q"), F.when(F.col("k") == 0, "evidence")))
    return rows.select("conv_id", "turn", "tool", F.array_join(lacks, "|").alias("missing"))


# All that is known of a week, part by part: query, key, value, whether it has a week, and how many rows are shown.
PARTS = {
    "keyword_enriched": ("join02_keyword_enriched", "keyword", "z_score", True, None),
    "cluster_enriched": ("join03_cluster_enriched", "cluster_id", "avg_long_term_score", True, None),
    "clusters": ("agg15_cluster_meta", "cluster_theme", "avg_z_score", True, None),
    "cluster_interpretation": ("enr05_cluster_prompts", "prompt", "cluster_id", True, None),
    "related_products": ("msc05_products_of_week", "name", "rank", False, None),
    "search_queries": ("enr06_cluster_queries", "search_query", "rank", True, None),
    "video_signals": ("msc19_signal_rows", "keyword", "v", True, None),
    "market_competition": ("enr07_market_report", "p_brand", "mean", False, None),
    "long_term_signals": ("agg16_long_term_signals", "keyword", "long_term_score", True, 50),
    "period_trend_signals": ("agg18_period_trend_signals", "keyword", "z_baseline", False, 50),
    "product_grounding": ("join16_category_grounding", "name", "score", False, None),
}
PART_WEEK = "1997-W26"


def _parts_sql() -> str:
    from weekloom.plans import registry

    def one(part: str, source: str, key: str, value: str, weekly: bool, most: int | None) -> str:
        body, needs = registry.SQL[source]
        where = f"WHERE week = '{PART_WEEK}'" if weekly else ""
        shown = f"SELECT '{part}' AS part, row_number() OVER (ORDER BY round(value, 6) DESC NULLS LAST, key) AS nr, key, value FROM (SELECT CAST({key} AS VARCHAR) AS key, CAST({value} AS DOUBLE) AS value FROM ({registry.with_tables(body, *needs)}) {where})"
        return f"SELECT * FROM ({shown})" + (f" WHERE nr <= {most}" if most else "")

    return f"SELECT part, CAST(nr AS INTEGER) AS nr, key, round(value, {R}) + 0.0 AS value FROM (" + " UNION ALL ".join(one(part, *spec) for part, spec in PARTS.items()) + ")"


@query("api08_enrichment_rows", _parts_sql)
def api08_rows(spark, d):
    """The rows of every part of a week's enrichment, each part in the order of its value; signals are the first fifty."""
    from weekloom.plans import registry

    out = None
    for part, (source, key, value, weekly, most) in PARTS.items():
        rows = registry.QUERIES[source](spark, d)
        rows = (rows.where(F.col("week") == PART_WEEK) if weekly else rows).select(F.lit(part).alias("part"), F.col(key).cast("string").alias("key"), F.col(value).cast("double").alias("value"))
        nr = F.row_number().over(Window.partitionBy("part").orderBy(F.round("value", 6).desc_nulls_last(), "key"))
        rows = rows.withColumn("nr", nr)
        rows = rows.where(F.col("nr") <= most) if most else rows
        out = rows if out is None else out.unionByName(rows)
    return out.select("part", "nr", "key", (F.round("value", R) + 0.0).alias("value"))


# Streams that have a batch answer.
def _events_stream(spark, d):
    """The events as a file stream with their time in UTC."""
    path = session.new_path(spark, "events-in")
    tables.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type").write.parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


@query("sta06_restarted_ingest", "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type")
def sta06(spark, d):
    """An ingest that stops and goes on from its checkpoint: the second run adds nothing that was there."""
    out, mark = session.new_path(spark, "events-out"), session.new_path(spark, "events-mark")
    events = _events_stream(spark, d)
    for _ in range(2):
        stream.run_to_table(events, out, mark)
    return spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))


@query("sta09_first_within_ttl", "SELECT CAST(count(DISTINCT user_id || ':' || event_type) AS BIGINT) AS n FROM events")
def sta09(spark, d):
    """The first event of each key, where the time to live is longer than the stream: each key once."""
    out, mark = session.new_path(spark, "first-out"), session.new_path(spark, "first-mark")
    stream.run_to_table(stream.first_of_key(_events_stream(spark, d), ["user_id", "event_type"], "3650 days"), out, mark)
    return spark.read.parquet(out).agg(F.count("*").alias("n"))


_TTL = 43_200


@query("sta09_keys_with_ttl", f"""WITH RECURSIVE e AS (SELECT user_id, epoch_us(ts) / 1e6 AS t, event_id FROM events), opened AS (SELECT user_id, arg_min(event_id, struct_pack(a := t, b := event_id)) AS event_id, min(t) AS t FROM e GROUP BY user_id
  UNION ALL SELECT e.user_id, arg_min(e.event_id, struct_pack(a := e.t, b := e.event_id)), min(e.t) FROM opened f JOIN e ON e.user_id = f.user_id AND e.t >= f.t + {_TTL} GROUP BY e.user_id, f.t)
  SELECT CAST(e.user_id AS VARCHAR) AS key, e.event_id, e.event_id = f.event_id AS is_first, f.event_id AS first_id FROM e ASOF JOIN (SELECT * FROM opened ORDER BY t) f ON e.user_id = f.user_id AND e.t >= f.t""")
def sta09_ttl(spark, d):
    """Which events of a user open half a day and which come within one, from a stream whose files come in the order of time."""
    into, out, mark = (session.new_path(spark, n) for n in ("timed-in", "timed-out", "timed-mark"))
    events = tables.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
    for low, high in ((None, "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", None)):
        part = events.where(F.col("ts") >= low) if low else events
        (part.where(F.col("ts") < high) if high else part).write.mode("append").parquet(into)
        arrived = spark.readStream.schema(events.schema).parquet(into)
        stream.run_to_table(stream.first_within(arrived, F.col("user_id"), _TTL), out, mark)
    return spark.read.parquet(out)


@query("src08_loaded_files", "SELECT c_custkey, CASE WHEN c_custkey % 5 = 1 THEN upper(c_mktsegment) || '!' ELSE c_mktsegment END AS segment, c_custkey % 5 = 4 OR c_custkey % 5 = 1 AS later FROM customer")
def src08_loaded(spark, d):
    """Rows of files after three arrivals: four files, then one of them changed and a new one, then the same again."""
    rows = tables.table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), (F.col("c_custkey") % 5).alias("part"))
    first = rows.where("part < 4").withColumn("later", F.lit(False))
    second = rows.where("part IN (1, 4)").select("c_custkey", F.when(F.col("part") == 1, F.concat(F.upper("segment"), F.lit("!"))).otherwise(F.col("segment")).alias("segment"), "part", F.lit(True).alias("later"))
    into, schema = session.new_path(spark, "files-in"), "c_custkey long, segment string, later boolean"
    table = ingest.FileTable(spark, session.new_path(spark, "files"), f"source_file string, {schema}", ingest.json_lines(schema))
    for part in (first, second, None):
        if part is not None:
            part = part.select("part", F.to_json(F.struct("c_custkey", "segment", "later")).alias("value"))
            # One file for each part: the new text of a part takes the place of the old one.
            part.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").text(into)
        table.load(into, gone=True)
    return table.read().drop("source_file")
