"""Contexts and neighbours of words against a plain count over all occurrences."""

import random
import re
from collections import Counter

from weekloom.operators import contexts


def plain(articles, keep, side):
    """What stands around each valid word: as whole contexts, or word by word of one side."""
    seen = {}
    for week, body in articles:
        words = [w for w in re.split(r"[ \t\n\f\r\x0b]+", body or "") if w]
        for k, word in enumerate(words):
            key = re.sub("[^0-9a-z가-힣]+", "", word.lower())
            if len(key) >= 2 and re.search("[가-힣]|[a-z].*[a-z]", key):
                before, after = words[max(0, k - 2) : k], words[k + 1 : k + 3]
                what = [(" ".join(before), " ".join(after))] if side is None else [(w,) for w in (before if side == "before" else after)]
                seen.setdefault((week, key), Counter()).update(what)
    return sorted((*key, *at, n, nr + 1) for key, c in seen.items() for nr, (at, n) in enumerate(sorted(c.items(), key=lambda x: (-x[1], [t.encode() for t in x[0]]))[:keep]))


def test_blocks_equal_a_plain_count(spark, monkeypatch):
    rng = random.Random(3)
    draw = lambda: rng.choice(["aa", "Aa,", "b b", "cc", "dd\n", "가", "é", "x1", "İİ", "Ky", "zz zz zz", "-", "ßab", "ab\x0bcd"])
    articles = [(f"w{k % 3}", " ".join(draw() for _ in range(rng.choice([0, 1, 2, 9, 60])))) for k in range(80)] + [("w1", None), ("w9", ""), ("w9", "one word")]
    monkeypatch.setattr(contexts, "IN_BLOCK", 40)
    df = spark.createDataFrame([(w, k, "p", b) for k, (w, b) in enumerate(articles)], "week string, news_id long, press string, body string")
    for buckets in (1, 7):
        got = sorted(map(tuple, contexts.contexts(df, 3, buckets=buckets).collect()))
        assert got == plain(articles, 3, None)
        got = sorted(map(tuple, contexts.neighbours(df, 2, buckets=buckets).collect()))
        assert got == sorted((w, k, side, t, n, r) for side in ("before", "after") for w, k, t, n, r in plain(articles, 2, side))
    nothing = contexts.contexts(df.where("week IS NULL"))
    assert nothing.count() == 0 and not nothing.where("rank > 3").count()


def test_surroundings_are_shuffled_once_in_blocks(spark):
    """No row for each occurrence goes through an exchange: what is dealt is blocks, by their bucket alone."""
    df = spark.createDataFrame([("w", 1, "p", "aa bb cc")], "week string, news_id long, press string, body string")
    for made in (contexts.contexts(df, buckets=4), contexts.neighbours(df, buckets=4)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(bucket") == 1 and plan.count("Exchange") == 1 and "Window" not in plan


def test_blocks_name_each_text_once(spark):
    """What is shuffled holds numbers for the words around a word, whatever their lengths: their texts come once a block."""
    rng = random.Random(7)
    known = [f"w{rng.getrandbits(160):x}" for _ in range(300)]
    bodies = [(" ".join(rng.choices(known, k=500)),) for _ in range(40)]
    df = spark.createDataFrame(bodies, "body string").selectExpr("'w' AS week", "body").coalesce(1)
    sent = df.transform(lambda d: contexts.packed(d, 1)).selectExpr("sum(length(block)) AS n").first()["n"]
    assert sent < 12 * 40 * 500  # a word has 40 characters


def test_single_senses_go_once_through_the_shuffle(spark, tmp_path):
    from weekloom.plans import catalog

    rows = [(0, "one two", "p"), (1, "one six", "p"), (7, "one", "p")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    made = catalog.queries()["join07_single_sense"](spark, str(tmp_path))
    assert sorted(map(tuple, made.collect()), key=str) == sorted(
        [("2024-W01", "two", 1, None, "…one [two] …"), ("2024-W01", "six", 1, None, "…one [six] …"), ("2024-W02", "one", 1, None, "… [one] …")], key=str
    )
    plan = made._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and plan.count("Scan parquet") == 1


def test_neighbours_send_each_pair_of_a_block_once(spark):
    """Surroundings of four words hardly ever repeat, words beside a word do: a word beside it is sent once, with its count."""
    rng = random.Random(5)
    known = [f"w{k}x" for k in range(60)]
    bodies = [(" ".join(rng.choices(known, k=500)),) for _ in range(100)]
    df = spark.createDataFrame(bodies, "body string").selectExpr("'w' AS week", "body").coalesce(1)
    sent = lambda what: contexts.packed(df, 1, what=what).selectExpr("sum(length(block)) AS n").first()["n"]
    assert 10 * sent(contexts._pairs) < sent(contexts._surroundings)  # 50,000 words, of 60 beside each of 60
    assert sent(contexts._pairs) < 50_000


def test_checksums_are_of_the_text_alone():
    """Buckets of a keyword must be the same in every block: neither slices nor other texts nor nulls change a checksum."""
    import pyarrow as pa

    texts = ["", "ab", "ba", "abc", "가나", "x" * 5000, None, "ab\0"]
    whole = contexts._checksums(pa.array(texts)).tolist()
    assert whole[6] == whole[0] and len({*whole}) == len(texts) - 1
    assert contexts._checksums(pa.array(["z", *texts, "y"]).slice(1, len(texts))).tolist() == whole
    assert [contexts._checksums(pa.array([t], pa.string()))[0] for t in texts] == whole
    assert len(contexts._checksums(pa.array([], pa.string()))) == 0


def test_partitions_of_blocks_follow_from_buckets(spark):
    """A task holds the blocks of its buckets: few partitions of the session would make it hold, and spill, more of them."""
    df = spark.createDataFrame([("w", 1, "p", "aa bb cc")], "week string, news_id long, press string, body string")
    for made in (contexts.contexts(df, buckets=9), contexts.neighbours(df, buckets=9)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"Exchange hashpartitioning\(bucket#\d+, 9\)", plan)


def test_blocks_take_few_bytes_for_an_occurrence(spark):
    """Frequent words are numbers in a block, without their texts, and their bytes are compressed by place."""
    rng = random.Random(11)
    known = [f"{'abcdefgh'[k % 8]}{k:x}zz" for k in range(4000)]
    share = [1 / (k + 3) for k in range(4000)]
    bodies = [(" ".join(rng.choices(known, share, k=500)),) for _ in range(100)]
    df = spark.createDataFrame(bodies, "body string").selectExpr("'w' AS week", "body").coalesce(1)
    sent = contexts.packed(df, 8).selectExpr("sum(length(block)) AS n").first()["n"]
    assert sent < 7.5 * 50_000


def test_known_words_change_no_result(spark, monkeypatch):
    """Words that blocks name by number alone are a table of codes: any size of it gives the same contexts and neighbours."""
    rng = random.Random(13)
    bodies = [(k % 2, " ".join(rng.choice(["aa", "bb", "c,c", "Dd", "ee ff", f"g{rng.randrange(40)}h"]) for _ in range(30))) for k in range(60)]
    df = spark.createDataFrame([(str(w), b) for w, b in bodies], "week string, body string")
    found = []
    for known in (0, 3, 65_536):
        monkeypatch.setattr(contexts, "KNOWN", known)
        found.append([sorted(map(tuple, made(df, 3, buckets=5).collect())) for made in (contexts.contexts, contexts.neighbours)])
    assert found[0] == found[1] == found[2] and found[0][0] == plain([(str(w), b) for w, b in bodies], 3, None)


def test_counts_contexts_and_neighbours_come_from_one_shuffle(spark, tmp_path):
    """They have one key: join05 deals blocks once, joins nothing, and says what the three tables say."""
    from weekloom.plans import catalog

    rng = random.Random(17)
    rows = [(rng.randrange(70), " ".join(rng.choice(["aa", "Bb,", "cc dd", "가나", "-", "x1"]) for _ in range(rng.choice([1, 2, 40]))), rng.choice(["p", "q\nr", "", None])) for _ in range(60)]
    spark.createDataFrame([*rows, (None, "aa bb", "p"), (3, "solo", "p"), (4, None, "p")], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    made = catalog.queries()["join05_with_context"](spark, str(tmp_path))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange") <= 2  # one may spread the only file
    words, ctx, nbr = (catalog.queries()[name](spark, str(tmp_path)).collect() for name in ("msc11_article_keywords", "agg23_contexts", "top04_neighbours"))
    lines, sides = {}, {}
    for r in sorted(ctx, key=lambda r: r["rank"]):
        lines.setdefault((r.week, r.keyword), []).append(f"…{r.before} [{r.keyword}] {r.after}… (×{r.occ_count})")
    for r in sorted(nbr, key=lambda r: r["rank"]):
        sides.setdefault((r.week, r.keyword), {}).setdefault(r.position, []).append(r.term)
    around = {k: " / ".join(", ".join(v.get(p, [])) or "-" for p in ("before", "after")) for k, v in sides.items()}
    want = [(r.week, r.keyword, r.source, r["count"], "\n".join(lines[r.week, r.keyword]), around.get((r.week, r.keyword))) for r in words if r.week]
    assert any(w[5] is None for w in want) and {w[2] for w in want} == {"p", "q\nr", "unknown"}
    assert sorted(map(tuple, made.collect()), key=str) == sorted(want, key=str)


def test_senses_of_a_keyword_are_not_dealt_again(spark, tmp_path):
    """Contexts of a week and keyword lie in one row of their table: what is said of a keyword's senses needs no shuffle."""
    from weekloom.plans import catalog

    rows = [(0, "one two one six one two", "p"), (1, "one six", "p"), (7, "one", "p")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    made = {name: catalog.queries()[name](spark, str(tmp_path)) for name in ("agg06_multi_sense", "join07_single_sense")}
    for df in made.values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan and "Aggregate" not in plan
    assert dict(made["agg06_multi_sense"].dtypes) == {"week": "string", "keyword": "string", "senses": "bigint", "shown": "string", "total": "bigint"}
    assert sorted(map(tuple, made["agg06_multi_sense"].collect()), key=str) == sorted(
        [("2024-W01", "one", 3, "▸six 1   ▸two 1   ▸two 1", 3), ("2024-W01", "six", 2, "▸(?) 1   ▸one 1", 2), ("2024-W01", "two", 2, "▸one 1   ▸(?) 1", 2)], key=str
    )
    assert sorted(map(tuple, made["join07_single_sense"].collect()), key=str) == [("2024-W02", "one", 1, None, "… [one] …")]
