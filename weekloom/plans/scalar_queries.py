"""Queries of scalar functions and predicates over keywords, articles, pages and replies."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weekloom.functions import dates, text
from weekloom.operators import predicates, setjoin
from weekloom.plans.registry import define, query
from weekloom.plans.view_queries import ctx
from weekloom.plans.weekly_queries import R, freq
from weekloom.sources import html, tables

#: Made-up Korean words and lines, since the tables have Latin text only: as a table for both engines.
WORDS = ("홍길동", "김철수", "김치", "도핑", "박영", "경찰청", "이순신씨", "red", "최a", "정부", "강원", "윤")
LINES = ("[부고] 홍길동 별세", "새로 뽑힌 김철수 회장.", "사진은 연합뉴스", "정부는 오늘 새 정책을 길게 발표했다고 밝혔다", "짧다", "시장 상황이 좋아지고 있다는 말이 나온다")

_rows = lambda values: ", ".join("(" + str(k) + ", '" + v.replace("'", "''").replace("\n", "' || chr(10) || '") + "')" for k, v in enumerate(values))
define("made_words", f"SELECT nr, word FROM (VALUES {_rows(WORDS)}) t(nr, word)")
define("made_lines", f"SELECT nr, line FROM (VALUES {_rows(LINES)}) t(nr, line)")


def made(spark, values, name):
    return spark.createDataFrame(list(enumerate(values)), f"nr int, {name} string")


_IN = lambda values: ", ".join(f"'{v}'" for v in values)


@query("flt09_name_like", f"SELECT word FROM (SELECT word FROM made_words UNION SELECT keyword FROM freq) WHERE regexp_full_match(word, '[가-힣]+') AND length(word) BETWEEN 2 AND 3 AND word[1] IN ({_IN(predicates.SURNAMES)}) AND word NOT IN ({_IN(predicates.NOT_NAMES)}) AND NOT list_bool_or(list_transform([{_IN(predicates.NOT_NAME_ENDS)}], lambda e: ends_with(word, e)))", "made_words", "freq")
def flt09(spark, d):
    words = made(spark, WORDS, "word").select("word").union(freq(spark, d).select("keyword")).distinct()
    return words.where(predicates.name_like(F.col("word")))


@query("flt12_captions", f"SELECT line, length(trim(line)) <= 8 OR regexp_matches(trim(line), '{predicates.CAPTION}') AS caption FROM (SELECT line FROM made_lines UNION ALL SELECT title FROM articles)", "made_lines", "articles")
def flt12(spark, d):
    lines = made(spark, LINES, "line").select("line").unionAll(tables.articles(spark, d).select("title"))
    return lines.select("line", predicates.caption(F.col("line"), 8).alias("caption"))


# Lines of the kinds that models reply with, made from the words of conversations.
_W = "regexp_replace(split_part(text, ' ', {0}), '[^0-9A-Za-zÀ-ÿ]+', '', 'g')"
_LINE = "CASE turn % 4 WHEN 0 THEN (turn + 1) || '. ' || a || ' - ' || b WHEN 1 THEN '- ' || a || ': ' || b WHEN 2 THEN '추천 상품군 1: ' || a || ' / 선정 이유: ' || b ELSE a || ' ' || b END"
define("said", f"SELECT conv_id, turn, role, a, b, {_LINE} AS line FROM (SELECT conv_id, turn, role, {_W.format(1)} AS a, {_W.format(2)} AS b FROM conversations)")


def said(spark, d):
    """conv_id, turn, role, a and b (the first two words of a turn), line."""
    word = lambda k: F.regexp_replace(F.split_part("text", F.lit(" "), F.lit(k)), "[^0-9A-Za-zÀ-ÿ]+", "")
    rows = tables.table(spark, d, "conversations").select("conv_id", "turn", "role", word(1).alias("a"), word(2).alias("b"))
    number = (F.col("turn") + 1).cast("string")
    kinds = (F.concat(number, F.lit(". "), "a", F.lit(" - "), "b"), F.concat(F.lit("- "), "a", F.lit(": "), "b"), F.concat(F.lit("추천 상품군 1: "), "a", F.lit(" / 선정 이유: "), "b"), F.concat_ws(" ", "a", "b"))
    return rows.withColumn("line", F.get(F.array(*kinds), (F.col("turn") % 4).cast("int")))


@query("agg34_title_adjacent", f"SELECT word, count(*) AS hits FROM (SELECT DISTINCT word, nr FROM (SELECT conv_id * 1000 + turn AS nr, a AS word, conv_id FROM said WHERE turn % 2 = 0 AND length(a) >= 2) WHERE word IN (SELECT a FROM said WHERE turn = 0)) GROUP BY word", "said")
def agg34(spark, d):
    """In how many lines a word stands right before a title: here every other turn opens with a word and a title."""
    rows = said(spark, d).where("length(a) >= 2")
    title = F.get(F.array(*map(F.lit, predicates.TITLES)), (F.col("conv_id") % len(predicates.TITLES)).cast("int"))
    line = F.when(F.col("turn") % 2 == 0, F.concat_ws(" ", "a", title, "b")).otherwise(F.concat_ws(" ", "a", "b"))
    words = rows.where("turn = 0").select(F.col("a").alias("word")).distinct()
    return predicates.before_titles(rows.select((F.col("conv_id") * 1000 + F.col("turn")).alias("nr"), line.alias("line")), "nr", "line", words, "word")


@query("scl03_nouns", "SELECT DISTINCT keyword, regexp_replace(keyword, '[^0-9A-Za-z가-힣]+', '', 'g') AS noun FROM freq", "freq")
def scl03(spark, d):
    return freq(spark, d).select("keyword").distinct().select("keyword", text.normalise_noun(F.col("keyword")).alias("noun"))


@query("scl06_sentences", "SELECT news_id, i, length(s) AS n, s[1:40] AS head FROM sents", "sents")
def scl06(spark, d):
    rows = tables.articles(spark, d).select("news_id", F.posexplode(text.sentences(F.col("body"))).alias("i", "s"))
    return rows.select("news_id", "i", F.length("s").cast("long").alias("n"), F.substring("s", 1, 40).alias("head"))


@query("scl07_weighted_cells", "SELECT keyword, trim(regexp_replace(c, '\\([^)]*\\)', '', 'g')) AS name FROM (SELECT DISTINCT keyword, unnest(string_split(replace(keyword, ' ', '(0.51), '), ',')) AS c FROM freq) WHERE trim(regexp_replace(c, '\\([^)]*\\)', '', 'g')) <> ''", "freq")
def scl07(spark, d):
    cell = F.replace("keyword", F.lit(" "), F.lit("(0.51), "))
    return freq(spark, d).select("keyword").distinct().select("keyword", F.explode(text.weighted_cell(cell)).alias("name")).distinct()


@query("scl09_html_summary")
def scl09(spark, d):
    return html.summaries(tables.table(spark, d, "pages"))


@query("scl10_list_items", r"SELECT conv_id, turn, trim(string_split_regex(item, '\s+-\s+')[1]) AS name, coalesce(trim(string_split_regex(item, '\s+-\s+')[2]), '') AS reason FROM (SELECT *, trim(regexp_replace(line, '^\s*(?:[-*•]|\d+[.)])\s*', '')) AS item FROM said)", "said")
def scl10(spark, d):
    item = text.name_and_reason(F.col("line"))
    return said(spark, d).select("conv_id", "turn", item["name"].alias("name"), item["reason"].alias("reason"))


@query("scl11_product_lines", r"""SELECT conv_id, turn, CASE WHEN m THEN trim(regexp_extract(line, '추천\s*상품군\s*\d+\s*:\s*(.+?)\s*/\s*선정\s*이유\s*:\s*(.+)', 1)) ELSE trim(string_split(trim(trim(line, '- ')), ':')[1]) END AS name, CASE WHEN m THEN trim(regexp_extract(line, '추천\s*상품군\s*\d+\s*:\s*(.+?)\s*/\s*선정\s*이유\s*:\s*(.+)', 2)) ELSE trim(string_split(trim(trim(line, '- ')), ':')[2]) END AS reason FROM (SELECT *, regexp_matches(line, '추천\s*상품군\s*\d+\s*:\s*(.+?)\s*/\s*선정\s*이유\s*:\s*(.+)') AS m FROM said) WHERE m OR contains(line, ':')""", "said")
def scl11(spark, d):
    item = text.product_line(F.col("line"))
    return said(spark, d).where(item.isNotNull()).select("conv_id", "turn", item["name"].alias("name"), item["reason"].alias("reason"))


@query("scl13_labels", "SELECT week, keyword, CASE WHEN len(e) > 0 AND len(a) > 0 THEN e[1] || ' ' || a[1] WHEN len(e) > 0 THEN array_to_string(e[1:2], ' ') ELSE array_to_string(a[1:2], ' ') END AS label FROM (SELECT week, keyword, list_filter(ws, lambda w: NOT ends_with(w, 'ed')) AS e, list_filter(ws, lambda w: ends_with(w, 'ed')) AS a FROM (SELECT week, keyword, list_filter(string_split(before || ' ' || after, ' '), lambda w: w <> '') AS ws FROM ctx WHERE rank = 1))", "ctx")
def scl13(spark, d):
    """A label of one entity and one action, or of two of a kind. Here words that end with -ed are the actions."""
    words = F.filter(F.split(F.concat_ws(" ", "before", "after"), " "), lambda w: w != "")
    return ctx(spark, d).where("rank = 1").select("week", "keyword", text.label_of(words, lambda w: F.endswith(w, F.lit("ed"))).alias("label"))


@query("scl14_templates", "SELECT DISTINCT keyword, 'Buy ' || keyword || ' (' || keyword || ') in 1996-W10' AS prompt FROM freq WHERE week = '1996-W10'", "freq")
def scl14(spark, d):
    rows = freq(spark, d).where("week = '1996-W10'")
    return rows.select("keyword", text.fill("Buy {kw} ({{kw}}) in {week}", {"kw": F.col("keyword"), "week": F.col("week")}).alias("prompt"))


@query("scl16_fallback_sentence", "SELECT press, press || ': ' || coalesce(array_to_string(list(title ORDER BY news_id) FILTER (WHERE trim(title) <> '' AND nr <= 2), ' / '), 'no article') AS sentence FROM (SELECT *, row_number() OVER (PARTITION BY press, trim(coalesce(title, '')) <> '' ORDER BY news_id) AS nr FROM articles) GROUP BY press", "articles")
def scl16(spark, d):
    """A sentence from the first two titles of each press that aren't empty."""
    rows = tables.articles(spark, d).where("trim(title) <> ''")
    first = rows.withColumn("nr", F.row_number().over(Window.partitionBy("press").orderBy("news_id"))).where("nr <= 2")
    titles = first.groupBy("press").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("news_id", "title"))), lambda s: s["title"]), " / ").alias("titles"))
    every = tables.articles(spark, d).select("press").distinct().join(titles, "press", "left")
    return every.select("press", F.concat("press", F.lit(": "), F.coalesce("titles", F.lit("no article"))).alias("sentence"))


@query("scl17_polarity", "SELECT doc_id, CASE WHEN contains(lower(text), 'decline') OR regexp_matches(text, '약화|감소|축소') THEN 'Fading' ELSE 'Active' END AS status FROM documents WHERE text IS NOT NULL")
def scl17(spark, d):
    return tables.table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", predicates.polarity(F.col("text")).alias("status"))


@query("scl25_recency", "SELECT event_id, days BETWEEN 0 AND 28 AS recent, days BETWEEN -7 AND 28 AS nearly FROM (SELECT event_id, date_diff('day', CAST(ts AS DATE), (SELECT CAST(max(ts) AS DATE) FROM events) - 3) AS days FROM events)")
def scl25(spark, d):
    events = tables.table(spark, d, "events").select("event_id", F.col("ts").cast("date").alias("day"))
    as_of = events.agg(F.date_sub(F.max("day"), 3).alias("as_of"))
    rows = events.crossJoin(F.broadcast(as_of))
    return rows.select("event_id", dates.recent(F.col("day"), F.col("as_of"), 0).alias("recent"), dates.recent(F.col("day"), F.col("as_of"), -7).alias("nearly"))


@query("scl31_capped_logs", f"SELECT user_id, round(least(1.0, log10(greatest(1, total)) / 8), {R}) AS v, round(least(1.0, likes / greatest(1, total) / 0.08), {R}) AS e FROM (SELECT user_id, sum(value) AS total, sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END) AS likes FROM events GROUP BY user_id)")
def scl31(spark, d):
    rows = tables.table(spark, d, "events").groupBy("user_id").agg(F.sum("value").alias("total"), F.sum(F.when(F.col("event_type") == "click", F.col("value")).otherwise(0)).alias("likes"))
    whole = F.greatest(F.lit(1.0), F.col("total"))
    return rows.select("user_id", F.round(F.least(F.lit(1.0), F.log10(whole) / 8), R).alias("v"), F.round(F.least(F.lit(1.0), F.col("likes") / whole / 0.08), R).alias("e"))


@query("scl32_logs_and_roots", f"SELECT week, keyword, round(ln(1 + count), {R}) AS log_count, round(sqrt(count), {R}) AS root FROM freq WHERE week = '1996-W10'", "freq")
def scl32(spark, d):
    return freq(spark, d).where("week = '1996-W10'").select("week", "keyword", F.round(F.log1p("count"), R).alias("log_count"), F.round(F.sqrt("count"), R).alias("root"))


@query("scl41_filled_arrays", "SELECT week, count(*) FILTER (WHERE len(list_filter(string_split(before, ' '), lambda w: w <> '')) > 0) AS filled, count(*) AS n FROM ctx GROUP BY week", "ctx")
def scl41(spark, d):
    words = F.filter(F.split("before", " "), lambda w: w != "")
    return ctx(spark, d).groupBy("week").agg(F.count_if(F.size(words) > 0).alias("filled"), F.count("*").alias("n"))


@query("scl43_json_detail", """SELECT keyword, '{"weeks":' || count(*) || ',"first":"' || min(week) || '"}' AS detail FROM freq GROUP BY keyword""", "freq")
def scl43(spark, d):
    rows = freq(spark, d).groupBy("keyword").agg(F.count("*").alias("weeks"), F.min("week").alias("first"))
    return rows.select("keyword", F.to_json(F.struct("weeks", "first")).alias("detail"))


define("said_json", "SELECT *, CASE turn % 3 WHEN 0 THEN 'so:' || chr(10) || '```json' || chr(10) || '{\"a\": \"' || a || '\"}' || chr(10) || '``` yes' WHEN 1 THEN a || ' [\"' || b || '\"] ' || b ELSE a || ' {' || b END AS reply FROM said", "said")


@query("scl44_json_in_text", "SELECT conv_id, turn, CASE turn % 3 WHEN 2 THEN NULL ELSE CASE WHEN json_valid(part) THEN part END END AS part FROM (SELECT *, nullif(regexp_extract(CASE WHEN fenced <> '' THEN fenced ELSE reply END, '(?s)(\\{.*\\}|\\[.*\\])', 1), '') AS part FROM (SELECT *, regexp_extract(reply, '(?s)```(?:json)?\\s*(.*?)```', 1) AS fenced FROM said_json))", "said_json")
def scl44(spark, d):
    """The JSON in replies: fenced, within a sentence, or none that can be read."""
    nr = F.col("turn") % 3
    fenced = F.concat(F.lit('so:\n```json\n{"a": "'), "a", F.lit('"}\n``` yes'))
    inside = F.concat("a", F.lit(' ["'), "b", F.lit('"] '), "b")
    rows = said(spark, d).withColumn("reply", F.when(nr == 0, fenced).when(nr == 1, inside).otherwise(F.concat("a", F.lit(" {"), "b")))
    return rows.select("conv_id", "turn", text.json_part(F.col("reply")).alias("part"))


@query("scl45_ordered_distinct", "SELECT news_id, array_to_string(list_transform(list_filter(range(1, len(ws) + 1), lambda i: list_position(ws, ws[i]) = i), lambda i: ws[i]), ' ') AS words FROM (SELECT news_id, list_filter(string_split_regex(title, '\\s+'), lambda w: w <> '') AS ws FROM articles WHERE title IS NOT NULL)", "articles")
def scl45(spark, d):
    """The different words of a title, in their order."""
    words = F.filter(F.split("title", r"\s+"), lambda w: w != "")
    return tables.articles(spark, d).where("title IS NOT NULL").select("news_id", F.array_join(F.array_distinct(words), " ").alias("words"))


@query("scl46_item_schema", "SELECT page_id, page_id % 5 <> 0 AND title <> '' AS ok, CASE WHEN page_id % 5 <> 0 AND title <> '' THEN title END AS first_title FROM (SELECT page_id, trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)) AS title FROM pages)")
def scl46(spark, d):
    """Scraped results held to their schema: a list of items, each with four texts that aren't empty. A fifth lacks one."""
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    item = F.struct(title.alias("title"), F.col("url").alias("source_url"), F.when(F.col("page_id") % 5 != 0, "h1").alias("selector"), F.lit("text").alias("raw_snippet"))
    checked = html.checked_items(F.col("body"))
    rows = tables.table(spark, d, "pages").select("page_id", F.to_json(F.struct(F.array(item).alias("items"))).alias("body"))
    return rows.select("page_id", checked["ok"].alias("ok"), F.try_element_at(checked["items"], F.lit(1))["title"].alias("first_title"))


@query("set08_jaccard", f"SELECT a.name AS name, b.name AS other, round(CAST(count(*) AS DOUBLE) / (any_value(a.n) + any_value(b.n) - count(*)), {R}) AS jaccard FROM (SELECT *, count(*) OVER (PARTITION BY name) AS n FROM toks) a JOIN (SELECT *, count(*) OVER (PARTITION BY name) AS n FROM toks) b ON a.t = b.t AND a.name < b.name GROUP BY ALL HAVING count(*) >= 1", "toks")
def set08(spark, d):
    """Token overlap of product names that share a token; pairs come from an equi-join on the token."""
    names = tables.table(spark, d, "part").select(F.col("p_name").alias("name")).distinct().withColumn("ts", F.array_distinct(text.tokens(F.lower("name"))))
    one = names.select("name", F.explode("ts").alias("t"))
    pairs = one.join(one.select(F.col("name").alias("other"), "t"), "t").where("name < other").select("name", "other").distinct()
    both = pairs.join(names, "name").join(names.select(F.col("name").alias("other"), F.col("ts").alias("us")), "other")
    return both.select("name", "other", F.round(text.jaccard(F.col("ts"), F.col("us")), R).alias("jaccard"))


@query("set08_similar_names", f"SELECT a.name AS name, b.name AS other, round(CAST(count(*) AS DOUBLE) / (any_value(a.n) + any_value(b.n) - count(*)), {R}) AS jaccard FROM (SELECT *, count(*) OVER (PARTITION BY name) AS n FROM toks) a JOIN (SELECT *, count(*) OVER (PARTITION BY name) AS n FROM toks) b ON a.t = b.t AND a.name < b.name GROUP BY a.name, b.name HAVING CAST(count(*) AS DOUBLE) / (any_value(a.n) + any_value(b.n) - count(*)) >= 0.3 - 1e-9", "toks")
def set08_similar(spark, d):
    """Names that share three tenths of their tokens: found by their rarest tokens, so that a common one pairs nobody."""
    names = tables.table(spark, d, "part").select(F.col("p_name").alias("id")).distinct().withColumn("items", F.array_distinct(text.tokens(F.lower("id"))))
    found = setjoin.similar_sets(names, names, 0.3)
    return found.where("a < b").select(F.col("a").alias("name"), F.col("b").alias("other"), F.round("jaccard", R).alias("jaccard"))


@query("msc09_parsed_weeks", "SELECT DISTINCT week, CAST(week[1:4] AS INTEGER) AS year, CAST(week[7:8] AS INTEGER) AS nr FROM freq", "freq")
def msc09(spark, d):
    return freq(spark, d).select("week").distinct().select("week", dates.week_year(F.col("week")).alias("year"), dates.week_number(F.col("week")).alias("nr"))


@query("msc10_stopwords", "SELECT keyword, count(*) AS n FROM occ WHERE keyword NOT IN ('the', 'and', 'of') GROUP BY keyword", "occ")
def msc10(spark, d):
    """Words without those of a list file, in which lines with # are comments."""
    from weekloom import session
    from weekloom.plans.view_queries import article_words

    path = session.new_path(spark, "stopwords")
    spark.createDataFrame([(line,) for line in ("# words", "the", " and ", "", "of")], "value string").coalesce(1).write.text(path)
    listed = text.word_list(spark.read.text(path))
    return article_words(spark, d).join(listed.select(F.col("word").alias("keyword")), "keyword", "left_anti").groupBy("keyword").agg(F.sum("count").alias("n"))


@query("msc12_context_sentences", "SELECT week, keyword, rank, trim(concat_ws(' ', nullif(before, ''), nullif(keyword, ''), nullif(after, ''))) AS sentence FROM ctx", "ctx")
def msc12(spark, d):
    return ctx(spark, d).select("week", "keyword", "rank", text.context_sentence("before", "keyword", "after").alias("sentence"))


@query("agg24_sentence_counters", "SELECT week, count(*) AS sentences, CAST(sum(n) AS BIGINT) AS words FROM (SELECT DISTINCT week, news_id, s, len(list_distinct(regexp_extract_all(lower(s), '[가-힣A-Za-z0-9]{2,}'))) AS n FROM sents) GROUP BY week", "sents")
def agg24(spark, d):
    rows = tables.articles(spark, d).select("week", "news_id", F.explode(text.sentences(F.col("body"))).alias("s")).distinct()
    return rows.groupBy("week").agg(F.count("*").alias("sentences"), F.sum(F.size(F.array_distinct(text.tokens(F.lower("s"))))).alias("words"))


@query("msc14_range_of_weeks", "SELECT DISTINCT week, CAST(date_trunc('week', strptime(week || '-1', '%G-W%V-%u')) AS DATE) AS monday, CAST(date_trunc('week', strptime(week || '-1', '%G-W%V-%u')) + INTERVAL 6 DAY AS DATE) AS sunday FROM freq", "freq")
def msc14(spark, d):
    week = F.col("week")
    return freq(spark, d).select("week").distinct().select("week", dates.monday(week).alias("monday"), dates.sunday(week).alias("sunday"))


@query("msc17_prompts", "SELECT week, cluster_id, 'Terms: ' || string_agg(keyword, ', ' ORDER BY keyword) AS prompt, string_agg(keyword, ' ' ORDER BY keyword)[1:30] AS theme FROM (SELECT *, row_number() OVER (PARTITION BY week, cluster_id ORDER BY keyword) AS nr FROM cluster_keywords WHERE week >= '1997-W20') WHERE nr <= 5 GROUP BY ALL", "cluster_keywords")
def msc17(spark, d):
    """The prompt for a cluster's theme from its first terms, and the theme that is used without a model: 30 characters."""
    from weekloom.plans.view_queries import cluster_keywords
    from weekloom.plans.weekly_queries import z

    nr = F.row_number().over(Window.partitionBy("week", "cluster_id").orderBy("keyword"))
    rows = cluster_keywords(z(spark, d)).where("week >= '1997-W20'").withColumn("nr", nr).where("nr <= 5")
    terms = F.sort_array(F.collect_list("keyword"))
    return rows.groupBy("week", "cluster_id").agg(F.concat(F.lit("Terms: "), F.array_join(terms, ", ")).alias("prompt"), F.substring(F.array_join(terms, " "), 1, 30).alias("theme"))


# Names of files as the collector writes them: a range of days, one day, days the wrong way round, or none.
define("files", "SELECT DISTINCT CASE WHEN press = 'src1' THEN 'notes_' || press || '.txt' WHEN press = 'src2' THEN 'NewsResult_' || date || '_x.xlsx' WHEN press = 'src3' THEN 'x_' || strftime(d + INTERVAL 6 DAY, '%Y%m%d') || '-' || date || '.csv' ELSE 'NewsResult_' || date || '-' || strftime(d + INTERVAL 6 DAY, '%Y%m%d') || '.xlsx' END AS file FROM (SELECT press, date, strptime(date, '%Y%m%d') AS d FROM articles)", "articles")
define("file_ranges", r"SELECT file, least(a, b) AS low, greatest(a, b) AS high FROM (SELECT file, nullif(regexp_extract(file, '(\d{8})', 1), '') AS a, coalesce(nullif(regexp_extract(file, '\d{8}-(\d{8})', 1), ''), nullif(regexp_extract(file, '(\d{8})', 1), '')) AS b FROM files)", "files")


def files(spark, d):
    until = F.date_format(F.date_add(F.to_date("date", "yyyyMMdd"), 6), "yyyyMMdd")
    press = F.col("press")
    name = F.when(press == "src1", F.concat(F.lit("notes_"), press, F.lit(".txt"))).when(press == "src2", F.concat(F.lit("NewsResult_"), "date", F.lit("_x.xlsx")))
    name = name.when(press == "src3", F.concat(F.lit("x_"), until, F.lit("-"), "date", F.lit(".csv"))).otherwise(F.concat(F.lit("NewsResult_"), "date", F.lit("-"), until, F.lit(".xlsx")))
    return tables.articles(spark, d).select(name.alias("file")).distinct()


@query("msc15_file_ranges", "SELECT file, low, high FROM file_ranges", "file_ranges")
def msc15(spark, d):
    span = dates.file_range(F.col("file"))
    return files(spark, d).select("file", span["low"].alias("low"), span["high"].alias("high"))


@query("src07_pruned_files", "SELECT file FROM file_ranges WHERE low IS NULL OR (low <= '20240114' AND high >= '20240106')", "file_ranges")
def src07(spark, d):
    """Files whose name has no range, or one that meets the days that are asked for."""
    span = dates.file_range(F.col("file"))
    return files(spark, d).where(span["low"].isNull() | ((span["low"] <= "20240114") & (span["high"] >= "20240106"))).select("file")
