"""Hand-computed cases of the weekly operators."""

import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from weekloom.functions import dates, text
from weekloom.operators import enrich, graph, lifecycle, linkage, predicates, signals, similar, threads, weekly

COUNTS = {"a": (4, 0, 2, 2), "b": (1, 1, 0, 0), "c": (0, 3, 0, 9)}


@pytest.fixture(scope="module")
def freq(spark):
    return spark.createDataFrame([(f"2024-W0{k + 1}", w, n) for w, row in COUNTS.items() for k, n in enumerate(row) if n], "week string, keyword string, count int")


def test_baseline_and_z(spark, freq):
    base = weekly.baseline(freq, min_df=1, max_df=1.0)
    rows = {(r.keyword, r.week[-1]): r for r in base.collect()}
    assert len(rows) == 12
    for key, tfidf, mean, std in [(("a", "1"), 5.150728, 5.150728, None), (("a", "3"), 3.386294, 2.845674, 2.137242), (("b", "4"), 0, 0.643841, 0.643841), (("c", "4"), 11.589139, 3.863046, 4.731246), (("c", "1"), 0, 0, None)]:
        r = rows[key]
        assert (round(r.tfidf, 5), round(r.base_mean, 5)) == (round(tfidf, 5), round(mean, 5))
        assert r.base_std is None if std is None else abs(r.base_std - std) < 1e-5
    wk = freq.withColumn("source", F.lit("s"))
    z = {(r.keyword, r.week[-1]): r for r in weekly.z_scores(base, wk).collect()}
    for key, want in {("a", "1"): 0, ("a", "2"): 0.2, ("a", "3"): 0.169895, ("a", "4"): 0.095609, ("b", "4"): -0.28, ("c", "2"): -0.2, ("c", "4"): 0.280875}.items():
        assert abs(z[key].z_score - want) < 1e-5
    assert z["a", "2"].sources == "unknown" and z["a", "1"].sources == "s"


def test_filter_bounds(spark):
    rows = [(f"2024-W{w:02d}", k, 1) for k, weeks in {"rare": 1, "some": 3, "all": 10}.items() for w in range(1, weeks + 1)]
    f = spark.createDataFrame(rows, "week string, keyword string, count int")
    kept = lambda **k: sorted(r.keyword for r in weekly.filtered_keywords(f, **k).collect())
    assert kept(min_df=2, max_df=0.7) == ["some"]
    assert kept(min_df=5, max_df=0.7) == ["all"]  # the upper bound gives way
    assert kept(min_df=50, max_df=0.7) == ["all"]  # the lower bound is at most the number of weeks
    assert not weekly.baseline(f.limit(0)).collect()


def test_lifecycle(spark):
    z, n = (2.5, 1.0, 0.5, 0.2, 2.4, 0.9, 0.5, 0.1), (10, 8, 4, 1, 12, 0, 0, 3)
    weeks = [f"2024-W{k:02d}" for k in range(1, 9)]
    rows = [(w, "x", v, "s") for w, v in zip(weeks, z, strict=True)] + [(w, "y", 9.0 if k not in (0, 4) else -1.0, "s") for k, w in enumerate(weeks)]
    zs = spark.createDataFrame(rows, "week string, keyword string, z_score double, sources string")
    freq = spark.createDataFrame([(w, "x", c) for w, c in zip(weeks, n, strict=True) if c], "week string, keyword string, count int")
    idx = spark.createDataFrame([(w, k) for k, w in enumerate(weeks)], "week string, week_idx int")
    got = [(r.anchor, r.status, r.fading_streak, r.carried) for r in lifecycle.lifecycle(zs, freq, idx, top_n=1).where("keyword = 'x'").orderBy("week").collect()]
    assert got == [("A", "Emerging", 0, True), ("B", "Active", 0, True), ("B", "Active", 0, True), ("B", "Fading", 1, True), ("A+B", "Active", 0, True), ("B", "Fading", 1, True), ("B", "Fading", 2, False)]


@pytest.mark.parametrize(("z", "want"), [((0, 1, 2, 3), (3, 0.75, 2, 2, 2.5, 1, 3, 3)), ((-1, 0, 0, 0), (0, 0, -0.25, 0, 0, 0.3, 0, 0)), ((1, 0, 2, 2), (3, 0.75, 1.666667, 2, 2, 0.5, 2, 2))])
def test_long_term(spark, z, want):
    weeks = [f"2024-W0{k}" for k in range(1, 5)]
    history = spark.createDataFrame([(w, "k", float(v)) for w, v in zip(weeks, z, strict=True)], "week string, keyword string, z_score double")
    r = signals.long_term(history, history.select("keyword").distinct(), weeks[-1]).first()
    assert tuple(round(v, 6) for v in (r.active_weeks, r.active_ratio, r.mean_z, r.median_z, r.p75_z, r.slope, r.consecutive, r.peak_week_z)) == want


def test_period(spark):
    weeks = [f"2024-W0{k}" for k in range(1, 7)]
    freq = spark.createDataFrame([(w, "k", c) for w, c in zip(weeks, (1, 2, 3, 4, 5, 20), strict=True)], "week string, keyword string, count int")
    r = signals.period(freq, freq.select("keyword").distinct(), "2024-W30").first()
    assert (round(r.wow_7d_pct), r.micro, round(r.macro_beta, 6), round(r.macro_r2, 6), r.macro_up, round(r.z_baseline, 6), r.label, r.seasonal_ratio) == (300, True, 3, 0.627907, False, 12.020815, "short", None)


def test_seasonality(spark):
    rows = [(f"{y}-W{w:02d}", "k") for y, w in ((2020, 10), (2021, 11), (2022, 10), (2022, 40), (2023, 1))]
    r = signals.seasonality(spark.createDataFrame(rows, "week string, keyword string")).first()
    assert (r.seas_yrs, r.years_observed, r.best_wk, r.distinct_weeks, r.n_spikes) == (3, 4, 10, 4, 5)


CLUSTER = "week string, cluster_id int, weight int, keywords array<string>, label string, centroid array<double>"


def test_threads(spark):
    rows = [("2024-W01", 0, 5, ["p", "q", "r"], "a", [1.0, 0.0]), ("2024-W02", 0, 4, ["q", "r", "s"], "b", [1.0, 1.0]), ("2024-W02", 1, 3, ["z"], "c", [0.0, 1.0]), ("2024-W04", 0, 2, ["z", "y", "x", "w"], "d", [0.0, 1.0]), ("2024-W06", 0, 2, ["z", "u"], "", [0.0, 1.0])]
    clusters = spark.createDataFrame(rows, CLUSTER)
    got = {(r.week, r.cluster_id): r for r in threads.link(clusters).collect()}
    near = got["2024-W02", 0]
    assert near.thread_id == 0 and near.link_type == "near" and round(near.link_score, 6) == 0.531066
    assert got["2024-W04", 0].link_type == "seed"  # overlap .25 passes the gate, score .3625 doesn't
    assert got["2024-W06", 0].link_type == "gap" and got["2024-W06", 0].thread_id == got["2024-W02", 1].thread_id
    told = {r.thread_id: r for r in threads.describe(threads.link(clusters).join(clusters, ["week", "cluster_id"])).collect()}
    assert (told[0].n_weeks, told[0].span_weeks, told[0].kind, told[0].label, told[0].label_path, told[0].top_keywords) == (2, 2, "evolving", "a", "a → b", "p, q, r, s")
    assert told[1].label_path == "c → ?" and told[1].kind == "repeated"


def test_weeks(spark):
    row = lambda **c: spark.range(1).select(*(v.alias(k) for k, v in c.items())).first()
    r = row(a=dates.iso_week(F.lit("2016-01-01").cast("date")), b=dates.monday(F.lit("2015-W53")), c=dates.gap_weeks(F.lit("2015-W53"), F.lit("2016-W02")), d=dates.coerce_date(F.lit("20160102.0")), e=dates.coerce_date(F.lit("2016-01-02")), f=dates.coerce_date(F.lit("nothing")), g=dates.date_digits(F.lit("2016-01-02T03")))
    assert tuple(r) == ("2015-W53", datetime.date(2015, 12, 28), 2, datetime.date(2016, 1, 2), datetime.date(2016, 1, 2), None, "20160102")


def test_text(spark):
    row = lambda **c: spark.range(1).select(*(v.alias(k) for k, v in c.items())).first()
    one = F.lit
    r = row(
        a=text.sentences(one("One. Two! 셋？ Four")), b=text.slot_id(one("Ab-C 가")), c=text.slot_id(one("--")), d=text.pipe_list(one("a||b")), e=text.pipe_list(one(None).cast("string")), f=text.strip_tags(one("<b>x</b> &amp; &quot;y&quot;")), g=text.weighted_cell(one("a(0.51), b(0.3)")),
        h=text.name_and_reason(one("2. lamp - it sells")), i=text.fill("{{x}} of {x}", {"x": one("y")}), j=text.json_part(one('so:\n```json\n{"a": 1}\n``` yes')), k=text.json_part(one("none")), m=text.page_url(one("http://h/a?page=2&z=1"), one(3)), n=text.page_url(one("http://h/page/2"), one(3)), o=text.page_url(one("http://h/a"), one(3)), p=text.jaccard(F.array(one("a"), one("b")), F.array(one("b"))),
    )
    assert r.a == ["One.", "Two!", "셋？", "Four"] and (r.b, r.c) == ("slot_abc가", "slot_unknown") and r.d == ["a", "b"] and r.e == [] and r.f == 'x & "y"' and r.g == ["a", "b"]
    assert tuple(r.h) == ("lamp", "it sells") and r.i == "y of y" and r.j == '{"a": 1}' and r.k is None and r.m == "http://h/a?page=3&z=1" and r.n == "http://h/page/3" and r.o == "http://h/a?page=3" and r.p == 0.5


def plain_senses(x, threshold):
    """Average linkage by definition, over all rows of a group."""
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    far, clusters = 1 - unit @ unit.T, [[k] for k in range(len(x))]
    while len(clusters) > 1:
        d, i, j = min((far[np.ix_(a, b)].mean(), i, j) for i, a in enumerate(clusters) for j, b in enumerate(clusters) if i < j)
        if d >= threshold:
            break
        clusters[i] += clusters.pop(j)
    return {k: n for n, c in enumerate(sorted(clusters, key=lambda c: (-len(c), min(c)))) for k in c}


@pytest.mark.parametrize(("block", "small"), [(7, 1000), (1024, 1000), (16, 1), (1024, 1)])
def test_senses_of_all_rows_against_average_linkage(spark, block, small):

    r = np.random.default_rng(4)
    x = np.repeat(r.normal(size=(9, 6)), 9, axis=0) + 0.6 * r.normal(size=(81, 6))
    x[20:45] = x[20]
    rows = [(k, "ab"[k % 2], [float(v) for v in x[k]]) for k in range(81)]
    found = linkage.split_senses(spark.createDataFrame(rows, "id long, word string, e array<double>"), ["word"], "id", "e", 0.3, block=block, small=small)
    got = {r.id: r.sense_id for r in found.collect()}
    want = {}
    for word in range(2):
        want |= {2 * k + word: s for k, s in plain_senses(x[word::2], 0.3).items()}
    assert found.columns == ["word", "id", "sense_id"] and got == want and len(set(want.values())) > 4


def test_senses_query_covers_every_embedding(spark):
    import __spark_entry__

    folder = "/root/testdata/sf0.001"
    ids = {r.vec_id for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    rows = __spark_entry__.queries()["vec12_senses"](spark, folder).collect()
    assert len(rows) == len(ids) and {r.id for r in rows} == ids


def _overlap(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a and b else 0.0


def _cosine(a: np.ndarray, b: np.ndarray) -> float:
    size = float(np.linalg.norm(a) * np.linalg.norm(b))
    return float(a @ b) / size if size else 0.0


def plain_links(group: pd.DataFrame) -> list:
    """Greedy links of one component: weeks in order, heavier clusters first, each to the best thread that is still free."""
    open_: list[dict] = []
    out = []
    for (day, week), rows in group.sort_values(["monday", "weight", "cluster_id"], ascending=[True, False, True]).groupby(["monday", "week"], sort=True):
        free = set(range(len(open_)))
        for r in rows.itertuples():
            words, centroid = set(r.keywords), np.asarray(r.centroid, float)
            best, best_score = None, 0.0
            for k in sorted(free):
                t = open_[k]
                gap = (day - t["day"]).days // 7
                overlap = _overlap(words, t["words"])
                if not 1 <= gap <= threads.GAP or overlap < (threads.NEAR_OVERLAP if gap == 1 else threads.FAR_OVERLAP):
                    continue
                score = threads.ALPHA * _cosine(centroid, t["centroid"]) + threads.BETA * overlap
                if score >= (threads.NEAR if gap == 1 else threads.FAR) and (best is None or score > best_score):
                    best, best_score, kind = k, score, "near" if gap == 1 else "gap"
            if best is None:
                open_.append({"seed": (week, r.cluster_id), "n": 1, "day": day, "words": words, "centroid": centroid})
                out.append((week, r.cluster_id, week, r.cluster_id, 0, 0.0, "seed"))
            else:
                t = open_[best]
                out.append((week, r.cluster_id, *t["seed"], t["n"], best_score, kind))
                t.update(n=t["n"] + 1, day=day, words=t["words"] | words, centroid=centroid)
                free.discard(best)
    return out


@pytest.mark.parametrize("small", [0, threads.SMALL])
def test_threads_against_one_by_one(spark, small):
    r = np.random.default_rng(3)
    rows = []
    for w in (1, 2, 3, 5, 6, 40):
        for c in range(14):
            rows.append((f"2024-W{w:02d}", c, int(r.integers(1, 6)), sorted({f"k{int(x)}" for x in r.integers(0, 12, 4)}), [float(x) for x in r.normal(size=4)]))
    clusters = spark.createDataFrame(rows, "week string, cluster_id int, weight int, keywords array<string>, centroid array<double>")
    frame = pd.DataFrame(rows, columns=["week", "cluster_id", "weight", "keywords", "centroid"])
    frame["monday"] = pd.to_datetime(frame["week"] + "-1", format="%G-W%V-%u")
    want = {(w, c): (sw, sc, seq, round(score, 9), kind) for w, c, sw, sc, seq, score, kind in plain_links(frame)}
    linked = threads.link(clusters, small=small).collect()
    seed = {x.thread_id: (x.week, x.cluster_id) for x in linked if x.seq == 0}
    assert {(x.week, x.cluster_id): (*seed[x.thread_id], x.seq, round(x.link_score, 9), x.link_type) for x in linked} == want
    assert len({v[4] for v in want.values()}) == 3 and not threads.link(clusters.limit(0), small=small).collect()


def test_grid_search_scores_what_each_setting_links(spark):
    r = np.random.default_rng(6)
    rows = [(f"2024-W{w:02d}", c, int(r.integers(1, 6)), sorted({f"k{int(x)}" for x in r.integers(0, 9, 4)}), [float(x) for x in r.normal(size=3)], f"l{c % 3} x") for w in (1, 2, 3, 5) for c in range(8)]
    clusters = spark.createDataFrame(rows, "week string, cluster_id int, weight int, keywords array<string>, centroid array<double>, label string")
    found = threads.grid_search(clusters, ["k1", "k2"]).collect()
    assert len(threads.GRID) == 36 and sorted(x.nr for x in found) == list(range(36)) and [x.overall for x in found] == sorted((x.overall for x in found), reverse=True)
    for x in found[::12]:
        members = threads.link(clusters, threads.GRID[x.nr]).join(clusters, ["week", "cluster_id"]).select("thread_id", "seq", "weight", "keywords")
        one = threads.quality(members, clusters.select("label"), ["k1", "k2"]).first().asDict()
        assert one == {k: v for k, v in x.asDict().items() if k in one}


def test_smoothing_over_more_weeks_than_a_double_spans(spark):
    r = np.random.default_rng(1)
    x = r.gamma(1.0, 2.0, 3000)
    x[1000:2600] = 0.0
    df = spark.createDataFrame([("k", i, float(v)) for i, v in enumerate(x)], "keyword string, week_idx int, x double")
    for span in (1, 2, 4, 50):
        want, y = [], None
        for v in x:
            y = v if y is None else y + 2 / (span + 1) * (v - y)
            want.append(y)
        got = [r.ewm for r in weekly.smoothed(df, "x", span=span).orderBy("week_idx").collect()]
        assert np.allclose(got, want, rtol=1e-9, atol=1e-100)


def test_token_bucket_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        r = np.random.default_rng(2)
        rows = [(k, int(r.integers(0, 3)), datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=int(r.integers(0, 5000)))) for k in range(200)]
        got = {x.event_id: x.allowed for x in enrich.token_bucket(spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp"), "user_id", "ts", 3, 1 / 60).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for user in range(3):
        left, last = 3.0, None
        for k, _, at in sorted((x for x in rows if x[1] == user), key=lambda x: (x[2], x[0])):
            left = min(3.0, left + (at - last).total_seconds() / 60) if last else left
            last = at
            assert got[k] == (left >= 1)
            left -= left >= 1


def test_links_between_blocks(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(90, 3))
    rows = spark.createDataFrame([(f"n{k:02d}", [float(v) for v in row]) for k, row in enumerate(x)], "node string, v array<double>")
    found = {(c.node): c.component for c in graph.components(rows.select("node"), similar.links_above(rows, "node", "v", 0.97, block=16)).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.97
    for _ in range(90):
        near = (near.astype(int) @ near.astype(int)) > 0
    assert all((found[f"n{i:02d}"] == found[f"n{j:02d}"]) == near[i, j] for i in range(90) for j in range(90))


def test_names_captions_and_words_before_titles(spark):
    words = spark.createDataFrame([(w,) for w in ("홍길동", "김치전골", "도핑", "박대", "red")], "w string")
    assert [x.w for x in words.where(predicates.name_like(F.col("w"))).collect()] == ["홍길동"]
    lines = spark.createDataFrame([(1, "어제 홍길동 회장은 말했다"), (2, "홍길동 회장, 홍길동 대표"), (3, "홍길동회장")], "k int, line string")
    assert [tuple(x) for x in predicates.before_titles(lines, "k", "line", words, "w").collect()] == [("홍길동", 1)]


def test_sentences_keep_their_digits(spark):
    """A sentence that begins or ends with digits of its own place keeps them; blanks around it go."""
    body = "  0 is first. 1 is 11 or 1. 2 twos, 22. 148.9.179.13 ends in 3! 4  "
    got = spark.createDataFrame([(body,)], "t string").select(text.sentences(F.col("t")).alias("s")).first().s
    assert got == ["0 is first.", "1 is 11 or 1.", "2 twos, 22.", "148.9.179.13 ends in 3!", "4"]


def test_dropped_signs_are_those_outside_the_kept_class(spark):
    every = spark.createDataFrame(pd.DataFrame({"c": [chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000]}))
    for kept, dropped in ((text.KEPT, text.DROPPED), ("[^0-9a-z가-힣 ]+", text.DROPPED_IN_LINE)):
        assert every.where(F.regexp_replace("c", kept, "") != F.regexp_replace("c", dropped, "")).count() == 0
