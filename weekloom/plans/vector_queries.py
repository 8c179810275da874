"""Queries over vectors, pages, products and streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weekloom import session
from weekloom.functions import text, vectors
from weekloom.operators import blocked, graph, kmeans, setjoin, similar, threads
from weekloom.plans.registry import define, query
from weekloom.plans.weekly_queries import R
from weekloom.session import stored
from weekloom.sources import html, sinks, tables
from weekloom.streaming import weekly as stream

_DOUBLES = "list_transform(embedding, lambda v: CAST(v AS DOUBLE))"
define("vec", f"SELECT vec_id AS id, {_DOUBLES} AS e, label, '2024-W' || lpad(CAST(vec_id % 8 + 1 AS VARCHAR), 2, '0') AS week FROM embeddings")
define("cent_flat", "SELECT week, label, i, avg(x) AS m FROM (SELECT week, label, unnest(e) AS x, unnest(range(1, len(e) + 1)) AS i FROM vec) GROUP BY ALL", "vec")
define("cent", "SELECT week, label, list(m ORDER BY i) AS c FROM cent_flat GROUP BY ALL", "cent_flat")
define("label_cent", "SELECT label, list(m ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(e) AS x, unnest(range(1, len(e) + 1)) AS i FROM vec) GROUP BY ALL) GROUP BY label", "vec")


def vec(spark, d):
    week = F.format_string("2024-W%02d", (F.col("vec_id") % 8 + 1).cast("int"))
    return tables.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("e"), "label", week.alias("week"))


def clusters(spark, d):
    """Weekly clusters: one for each label, with a weight, keywords and the mean vector."""
    v = vec(spark, d)
    sizes = v.groupBy("week", "label").agg(F.count("*").cast("int").alias("weight"))
    words = F.array(F.concat(F.lit("k"), F.col("label").cast("string")), F.concat(F.lit("k"), ((F.col("label") + 1) % 10).cast("string")), F.concat(F.lit("w"), F.substring("week", 7, 2), F.lit("-"), F.col("label").cast("string")))
    return sizes.join(vectors.mean_vector(v, ["week", "label"], "e"), ["week", "label"]).select("week", F.col("label").cast("int").alias("cluster_id"), "weight", words.alias("keywords"), F.concat(F.lit("t"), F.col("label").cast("string")).alias("label"), "centroid")


@query("vec03_cosine", f"SELECT a.id AS id, round(list_cosine_similarity(a.e, b.e), {R}) AS cosine FROM vec a JOIN vec b ON b.id = a.id + 1", "vec")
def vec03(spark, d):
    v = vec(spark, d)
    after = v.select((F.col("id") - 1).alias("id"), F.col("e").alias("f"))
    return v.join(after, "id").select("id", F.round(vectors.cosine(F.col("e"), F.col("f")), R).alias("cosine"))


@query("vec04_centroids", f"SELECT week, label, CAST(i AS INTEGER) AS i, round(m, {R}) + 0.0 AS m FROM cent_flat", "cent_flat")
def vec04(spark, d):
    return vectors.mean_vector(vec(spark, d), ["week", "label"], "e").select("week", "label", F.posexplode("centroid").alias("i", "m")).select("week", "label", (F.col("i") + 1).alias("i"), (F.round("m", R) + 0.0).alias("m"))


@query("vec05_exact_knn", f"SELECT query_id, id, round(score, {R}) AS score, rank FROM (SELECT q.id AS query_id, v.id AS id, list_cosine_similarity(v.e, q.e) AS score, CAST(row_number() OVER (PARTITION BY q.id ORDER BY round(list_cosine_similarity(v.e, q.e), 9) DESC, v.id) AS INTEGER) AS rank FROM vec v JOIN vec q ON q.week = v.week AND q.id <> v.id WHERE q.id % 20 = 0) WHERE rank <= 10", "vec")
def vec05(spark, d):
    v = vec(spark, d)
    return blocked.nearest(v, v.where("id % 20 = 0"), ["week"], "e", 10).withColumn("score", F.round("score", R))


@query("vec10_cohesion", f"SELECT week, label, count(*) AS n, round(coalesce((SELECT avg(list_cosine_similarity(a.e, b.e)) FROM vec a JOIN vec b ON a.week = b.week AND a.label = b.label AND a.id < b.id WHERE a.week = v.week AND a.label = v.label), 1.0), {R}) + 0.0 AS cohesion FROM vec v GROUP BY week, label", "vec")
def vec10(spark, d):
    return similar.cohesion(vec(spark, d), ["week", "label"], "e").withColumn("cohesion", F.round("cohesion", R) + 0.0)


@query("vec13_tail_trim", f"SELECT v.id, v.label, CASE WHEN list_cosine_similarity(v.e, c.c) < 0.3 THEN -1 ELSE v.label END AS kept FROM vec v JOIN label_cent c ON c.label = v.label", "vec", "label_cent")
def vec13(spark, d):
    v = vec(spark, d)
    return v.join(similar.few(vectors.mean_vector(v, ["label"], "e")), "label").select("id", "label", F.when(vectors.cosine(F.col("e"), F.col("centroid")) < 0.3, -1).otherwise(F.col("label")).alias("kept"))


@query("vec14_representatives", f"SELECT label, arg_max(id, (round(s, 9), -id)) AS id, round(max(s), {R}) AS sim FROM (SELECT v.id, v.label, list_cosine_similarity(v.e, c.c) AS s FROM vec v JOIN label_cent c ON c.label = v.label) GROUP BY label", "vec", "label_cent")
def vec14(spark, d):
    v = vec(spark, d)
    near = v.join(similar.few(vectors.mean_vector(v, ["label"], "e")), "label").withColumn("s", vectors.cosine(F.col("e"), F.col("centroid")))
    return near.groupBy("label").agg(F.max_by("id", F.struct(F.round("s", 9), -F.col("id"))).alias("id"), F.round(F.max("s"), R).alias("sim"))


@query("vec16_contrastive", f"""SELECT id, label, best, round(sim, {R}) AS sim, runner_up, round(sim - second, {R}) AS margin FROM (SELECT v.id, v.label, c.label AS best, list_cosine_similarity(v.e, c.c) AS sim, lead(c.label) OVER w AS runner_up, lead(list_cosine_similarity(v.e, c.c)) OVER w AS second, row_number() OVER w AS rank FROM vec v CROSS JOIN label_cent c WINDOW w AS (PARTITION BY v.id ORDER BY list_cosine_similarity(v.e, c.c) DESC)) WHERE rank = 1""", "vec", "label_cent")
def vec16(spark, d):
    v = vec(spark, d)
    cents = vectors.mean_vector(v, ["label"], "e").withColumnRenamed("label", "name")
    return similar.to_centroids(v.select("id", "label", "e"), cents, "e", "name").withColumns({"sim": F.round("sim", R), "margin": F.round("margin", R)})


@query("join17_previous_group", f"""SELECT week, label, prev_label, round(sim, {R}) AS sim FROM (SELECT a.week, a.label, b.label AS prev_label, list_cosine_similarity(a.c, b.c) AS sim, row_number() OVER (PARTITION BY a.week, a.label ORDER BY round(list_cosine_similarity(a.c, b.c), 9) DESC, b.label) AS rank FROM cent a JOIN cent b ON CAST(b.week[7:8] AS INTEGER) = CAST(a.week[7:8] AS INTEGER) - 1) WHERE rank = 1 AND sim >= 0.3""", "cent")
def join17(spark, d):
    c = stored(vectors.mean_vector(vec(spark, d), ["week", "label"], "e"), "centroids").withColumn("nr", F.substring("week", 7, 2).cast("int"))
    before = c.select((F.col("nr") + 1).alias("nr"), F.col("label").alias("prev_label"), F.col("centroid").alias("p"))
    scored = c.join(before, "nr").withColumn("sim", vectors.cosine(F.col("centroid"), F.col("p")))
    best = scored.groupBy("week", "label").agg(F.max_by(F.struct("prev_label", "sim"), F.struct(F.round("sim", 9), -F.col("prev_label"))).alias("b"))
    return best.where("b.sim >= 0.3").select("week", "label", "b.prev_label", F.round("b.sim", R).alias("sim"))


@query("vec09_components", f"""WITH RECURSIVE c AS (SELECT week || ':' || label AS node, c FROM (SELECT week, label, list(m ORDER BY i) AS c FROM (SELECT week, label, i, avg(x) AS m FROM (SELECT '2024-W' || lpad(CAST(vec_id % 8 + 1 AS VARCHAR), 2, '0') AS week, label, unnest({_DOUBLES}) AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY ALL) GROUP BY ALL)),
  e AS (SELECT a.node AS a, b.node AS b FROM c a JOIN c b ON list_cosine_similarity(a.c, b.c) >= 0.45),
  r(node, seen) AS (SELECT node, node FROM c UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen) SELECT node, min(seen) AS component FROM r GROUP BY node""")
def vec09(spark, d):
    c = vectors.mean_vector(vec(spark, d), ["week", "label"], "e").select(F.concat_ws(":", "week", F.col("label").cast("string")).alias("node"), "centroid")
    c = stored(c, "groups")
    return graph.components(c.select("node"), similar.links_above(c, "node", "centroid", 0.45))


@query("vec11_kmeans")
def vec11(spark, d):
    """Clusters of all vectors by mini-batches: one for every fifty rows, ten at least and forty at most."""
    rows = stored(vec(spark, d).select("id", "e"), "vectors")
    return kmeans.clusters(rows, "e", kmeans.clamp(rows.count(), 10, 40, 50))[0].select("id", "cluster_id")


# The linker as one walk over the clusters, weeks in order and heavier ones first; threads are numbered as they open.
define("link_order", "SELECT row_number() OVER (ORDER BY t.week, t.weight DESC, t.cluster_id) AS nr, t.week, t.cluster_id, CAST(date_diff('day', DATE '1970-01-05', CAST(strptime(t.week || '-1', '%G-W%V-%u') AS DATE)) // 7 AS INTEGER) AS wk, t.keywords AS ws, c.c AS c FROM tc t JOIN cent c ON c.week = t.week AND c.label = t.cluster_id", "tc", "cent")
define("link_walk", """/*RECURSIVE*/SELECT CAST(0 AS BIGINT) AS nr, CAST(NULL AS VARCHAR) AS week, CAST(NULL AS INTEGER) AS cluster_id, CAST(0 AS INTEGER) AS thread, CAST(0 AS INTEGER) AS seq, CAST(0 AS DOUBLE) AS score, '' AS kind, CAST([] AS STRUCT(last INTEGER, n INTEGER, ws VARCHAR[], c DOUBLE[])[]) AS open
  UNION ALL SELECT nr, week, cluster_id, CAST(coalesce(b.i - 1, len(open)) AS INTEGER), CASE WHEN b IS NULL THEN 0 ELSE open[b.i].n END, coalesce(-b.s, 0.0), CASE WHEN b IS NULL THEN 'seed' WHEN b.gap = 1 THEN 'near' ELSE 'gap' END,
    CASE WHEN b IS NULL THEN list_append(open, struct_pack(last := wk, n := 1, ws := list_distinct(ws), c := c)) ELSE list_transform(open, lambda t, i: CASE WHEN i = b.i THEN struct_pack(last := wk, n := t.n + 1, ws := list_distinct(list_concat(t.ws, ws)), c := c) ELSE t END) END
  FROM (SELECT nr, week, cluster_id, wk, ws, c, open, list_sort(list_filter(list_transform(list_transform(open, lambda t, i: struct_pack(i := i, gap := wk - t.last, cos := list_cosine_similarity(c, t.c), ov := CAST(len(list_intersect(ws, t.ws)) AS DOUBLE) / len(list_distinct(list_concat(ws, t.ws))))), lambda x: struct_pack(s := -(0.15 * x.cos + 0.85 * x.ov), i := x.i, gap := x.gap, ov := x.ov)),
      lambda x: (x.gap = 1 AND x.ov >= 0.10 AND -x.s >= 0.42) OR (x.gap BETWEEN 2 AND 30 AND x.ov >= 0.25 AND -x.s >= 0.47)))[1] AS b
    FROM (SELECT o.nr, o.week, o.cluster_id, o.wk, o.ws, o.c, w.open FROM link_walk w JOIN link_order o ON o.nr = w.nr + 1))""", "link_order")


@query("sta03_threads", f"SELECT thread AS thread_id, week, cluster_id, seq, round(score, {R}) AS link_score, kind AS link_type FROM link_walk WHERE nr > 0", "link_walk")
def sta03(spark, d):
    return threads.link(stored(clusters(spark, d), "clusters")).withColumn("link_score", F.round("link_score", R))


define("members", "SELECT label AS thread_id, week, CAST(count(*) AS INTEGER) AS weight, 't' || label AS label FROM vec GROUP BY ALL", "vec")


@query("agg31_thread_meta", f"""SELECT m.thread_id, count(*) AS n_weeks, min(m.week) AS start_week, max(m.week) AS end_week, CAST(max(CAST(m.week[7:8] AS INTEGER)) - min(CAST(m.week[7:8] AS INTEGER)) + 1 AS INTEGER) AS span_weeks, round(coalesce(avg(s), 1.0), {R}) AS drift, max(weight) AS peak_weight, string_agg(m.label, ' → ' ORDER BY m.week) AS label_path
  FROM members m JOIN (SELECT week, label AS thread_id, list_cosine_similarity(c, lag(c) OVER (PARTITION BY label ORDER BY week)) AS s FROM cent) x ON x.week = m.week AND x.thread_id = m.thread_id GROUP BY m.thread_id""", "members", "cent")
def agg31(spark, d):
    rows = clusters(spark, d).select(F.col("cluster_id").alias("thread_id"), "week", "weight", "label", "keywords", "centroid")
    return threads.describe(rows).select("thread_id", "n_weeks", "start_week", "end_week", "span_weeks", F.round("drift", R).alias("drift"), "peak_weight", "label_path")


# Pages.
@query("scl08_strip_tags", "SELECT page_id, md5(trim(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&quot;', '\"'), '&amp;', '&'))) AS digest FROM pages")
def scl08(spark, d):
    return tables.table(spark, d, "pages").select("page_id", F.md5(text.strip_tags(F.col("html"))).alias("digest"))


@query("agg37_link_patterns", """SELECT pattern, count(*) AS n FROM (SELECT regexp_replace(regexp_replace(u, '[0-9a-f]{8,}', '*', 'g'), '[0-9]+', '*', 'g') AS pattern FROM (SELECT unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS u FROM pages)) GROUP BY pattern ORDER BY n DESC, pattern LIMIT 8""")
def agg37(spark, d):
    found = tables.table(spark, d, "pages").select(F.explode(html.links(F.col("html"))).alias("u")).select(html.link_pattern(F.col("u")).alias("pattern"))
    return found.groupBy("pattern").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "pattern").limit(8)


@query("src25_records")
def src25(spark, d):
    return html.records(tables.table(spark, d, "pages"), "p")


@query("set11_distinct_urls", "SELECT url, min(page_id) AS page_id FROM pages GROUP BY url")
def set11(spark, d):
    return tables.table(spark, d, "pages").groupBy("url").agg(F.min("page_id").alias("page_id"))


@query("scl15_page_url", r"""SELECT page_id, CASE WHEN regexp_matches(url, '[?&](page|p|pg|pageNo|pageNum)=\d+') THEN regexp_replace(url, '([?&](?:page|p|pg|pageNo|pageNum)=)\d+', '\1' || 3, 'g') WHEN regexp_matches(url, '/page/\d+') THEN regexp_replace(url, '/page/\d+', '/page/3', 'g') ELSE url || CASE WHEN contains(url, '?') THEN '&page=' ELSE '?page=' END || 3 END AS next_url FROM pages""")
def scl15(spark, d):
    return tables.table(spark, d, "pages").select("page_id", text.page_url(F.col("url"), F.lit(3)).alias("next_url"))


# Products, categories, hierarchies.
@query("agg21_price_stats", f"SELECT p_brand, count(*) AS total, round(min(p_retailprice), 2) AS low, round(avg(p_retailprice), 0) AS mean, round(max(p_retailprice), 2) AS high, array_to_string(list_sort(list(DISTINCT p_name))[1:10], '|') AS titles FROM part GROUP BY p_brand")
def agg21(spark, d):
    part = tables.table(spark, d, "part")
    nth = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_name"))
    titles = part.select("p_brand", "p_name").distinct().withColumn("nth", nth).where("nth <= 10").groupBy("p_brand").agg(F.array_join(F.sort_array(F.collect_list("p_name")), "|").alias("titles"))
    stats = part.groupBy("p_brand").agg(F.count("*").alias("total"), F.round(F.min("p_retailprice"), 2).alias("low"), F.round(F.avg("p_retailprice"), 0).alias("mean"), F.round(F.max("p_retailprice"), 2).alias("high"))
    return stats.join(titles, "p_brand")


define("toks", "SELECT DISTINCT p_name AS name, unnest(list_distinct(regexp_extract_all(lower(p_name), '[가-힣A-Za-z0-9]{2,}'))) AS t FROM part")
define("cats", "SELECT DISTINCT p_type || ' ' || p_name AS cat, unnest(list_distinct(regexp_extract_all(lower(p_type || ' ' || p_name), '[가-힣A-Za-z0-9]{2,}'))) AS t FROM part")


@query("join16_category_grounding", f"""SELECT name, cat, round(score, {R}) AS score FROM (SELECT s.name, s.cat, CAST(shared AS DOUBLE) / (a.n + b.n - shared) AS score, row_number() OVER (PARTITION BY s.name ORDER BY round(CAST(shared AS DOUBLE) / (a.n + b.n - shared), 9) DESC, s.cat) AS rank
  FROM (SELECT name, cat, count(*) AS shared FROM toks JOIN cats ON toks.t = cats.t GROUP BY ALL) s JOIN (SELECT name, count(*) AS n FROM toks GROUP BY ALL) a ON a.name = s.name JOIN (SELECT cat, count(*) AS n FROM cats GROUP BY ALL) b ON b.cat = s.cat) WHERE rank = 1""", "toks", "cats")
def join16(spark, d):
    """The nearest category of each product name by its tokens."""
    part = tables.table(spark, d, "part")
    sets = lambda c: part.select(c.alias("id")).distinct().withColumn("items", F.array_distinct(text.tokens(F.lower("id"))))
    best = setjoin.best_match(sets(F.col("p_name")), sets(F.concat_ws(" ", "p_type", "p_name")))
    return best.select(F.col("a").alias("name"), F.col("b").alias("cat"), F.round("jaccard", R).alias("score"))


@query("src21_category_tree", """WITH RECURSIVE node AS (SELECT 'r' || r_regionkey AS id, CAST(NULL AS VARCHAR) AS parent, r_name AS name FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation), tree AS (SELECT id, name AS full_path, 1 AS level FROM node WHERE parent IS NULL UNION ALL SELECT n.id, t.full_path || '>' || n.name, t.level + 1 FROM node n JOIN tree t ON n.parent = t.id) SELECT id, full_path, level, NOT EXISTS (SELECT 1 FROM node c WHERE c.parent = tree.id) AS leaf FROM tree""")
def src21(spark, d):
    region = tables.table(spark, d, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id"), F.lit(None).cast("string").alias("parent"), F.col("r_name").alias("name"))
    nation = tables.table(spark, d, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("parent"), F.col("n_name").alias("name"))
    return spark.sql("WITH RECURSIVE tree AS (SELECT id, name AS full_path, 1 AS level FROM {node} WHERE parent IS NULL UNION ALL SELECT n.id, concat(t.full_path, '>', n.name), t.level + 1 FROM {node} n JOIN tree t ON n.parent = t.id) SELECT t.id, t.full_path, t.level, c.parent IS NULL AS leaf FROM tree t LEFT JOIN (SELECT DISTINCT parent FROM {node} WHERE parent IS NOT NULL) c ON c.parent = t.id", node=region.union(nation))


@query("src09_stable_ids", "SELECT doc_id, sha256(coalesce(CAST(doc_id AS VARCHAR), '') || '||' || coalesce(source, '') || '||' || coalesce(text, '')) AS point_id FROM documents")
def src09(spark, d):
    return tables.table(spark, d, "documents").select("doc_id", sinks.stable_id("doc_id", "source", "text").alias("point_id"))


@query("src12_upsert", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, 'X', o_totalprice + 1 FROM orders WHERE o_orderkey % 3 = 0")
def src12(spark, d):
    orders = tables.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = orders.where("o_orderkey % 3 = 0").select("o_orderkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("at"), "o_totalprice")
    new = new.select("o_orderkey", F.when(F.col("at") == 2, "X").otherwise("Y").alias("o_orderstatus"), (F.col("o_totalprice") + F.col("at") - 1).alias("o_totalprice"), "at")
    return sinks.upserted(orders.withColumn("at", F.lit(0)), new, ["o_orderkey"], "at").drop("at")


@query("src13_insert_ignore", "SELECT user_id, arg_min(event_id, event_id) AS event_id FROM events GROUP BY user_id")
def src13(spark, d):
    events = tables.table(spark, d, "events").select("user_id", "event_id")
    known = events.where("user_id % 2 = 0").groupBy("user_id").agg(F.min("event_id").alias("event_id"))
    return sinks.inserted(known, events, ["user_id"], ["event_id"])


# Events: the weekly rollup that the stream keeps, and sequential rules in batch form.
@query("sta05_weekly_rollup", "SELECT strftime(ts, '%G-W%V') AS week, event_type AS keyword, CAST(user_id AS VARCHAR) AS source, CAST(count(*) AS INTEGER) AS count FROM events GROUP BY ALL")
def sta05(spark, d):
    return stream.weekly_rollup(tables.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")))


@query("sta05_weekly_stream", "SELECT strftime(ts, '%G-W%V') AS week, event_type AS keyword, CAST(user_id AS VARCHAR) AS source, CAST(count(*) AS INTEGER) AS count FROM events GROUP BY ALL")
def sta05_stream(spark, d):
    """The same, kept by a stream over three arrivals whose times interleave, with a restart after each."""
    into, mark, out = (session.new_path(spark, n) for n in ("arrivals", "arrivals-mark", "weekly-facts"))
    events = tables.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    for k in range(3):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == k).write.mode("append").parquet(into)
        table = stream.changed_weeks(spark, spark.readStream.schema(events.schema).parquet(into), out, mark)
    return table.read()


@query("sta08_breaker", "SELECT event_id, n, fails, n >= 5 AND fails * 2 >= n AS open FROM (SELECT event_id, count(*) OVER w AS n, count(*) FILTER (WHERE event_type IN ('error', 'purchase')) OVER w AS fails FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW))")
def sta08(spark, d):
    w = Window.partitionBy("user_id").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-86_400_000_000, 0)
    bad = F.col("event_type").isin("error", "purchase")
    rows = tables.table(spark, d, "events").select("event_id", F.count("*").over(w).alias("n"), F.count(F.when(bad, 1)).over(w).alias("fails"))
    return rows.withColumn("open", (F.col("n") >= 5) & (F.col("fails") * 2 >= F.col("n")))


@query("sta11_first_per_domain", "SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source")
def sta11(spark, d):
    return tables.table(spark, d, "documents").groupBy("source").agg(F.min("doc_id").alias("doc_id"))


@query("agg20_event_scores", f"""SELECT event_type, n, round(v, {R}) AS v, round(a, {R}) AS a, round(0.5 * v + 0.5 * a, {R}) AS p FROM (SELECT event_type, count(*) AS n, least(1.0, log10(1 + sum(value)) / 6) AS v, count(*) FILTER (WHERE value > 50) * 1.0 / count(*) AS a FROM events GROUP BY event_type)""")
def agg20(spark, d):
    rows = tables.table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.least(F.lit(1.0), F.log10(1 + F.sum("value")) / 6).alias("v"), (F.count_if(F.col("value") > 50) / F.count("*")).alias("a"))
    return rows.select("event_type", "n", F.round("v", R).alias("v"), F.round("a", R).alias("a"), F.round(0.5 * F.col("v") + 0.5 * F.col("a"), R).alias("p"))


@query("scl42_json_fields", "SELECT event_id, json_extract_string(props, '$.k') AS k, props IS NOT NULL AS has_props FROM events")
def scl42(spark, d):
    return tables.table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.col("props").isNotNull().alias("has_props"))
