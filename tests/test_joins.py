"""Joins by containment and by overlap against plain versions over all pairs."""

import random

import pytest

from weekloom.operators import contained, setjoin


@pytest.mark.parametrize("q", [2, 4])
def test_contained_equals_all_pairs(spark, q):
    rng = random.Random(q)
    write = lambda n: "".join(rng.choice("abc 한é") for _ in range(n))
    texts = [(k, write(rng.choice([0, 3, 40, 200]))) for k in range(60)] + [(900, None), (901, "x" * 5000 + "abcé")]
    words = [*{write(rng.randint(1, 6)) for _ in range(120)}, "nowhere", "", None, "x" * 30, texts[2][1] or "abc"]
    got = contained.contained(spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame([(w,) for w in words] * 2, "word string"), q, sample=10)
    want = sorted((k, w) for k, t in texts if t for w in set(words) if w and w in t)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 200
    assert contained.contained(spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame([], "word string")).count() == 0


def test_similar_sets_equal_all_pairs(spark):
    rng = random.Random(5)
    items = "a b c d e f g h i j".split()
    draw = lambda: rng.sample(items, rng.randint(0, 6)) + ["common"] * rng.randint(0, 2)
    left, right = [(f"w{k % 2}", k, draw()) for k in range(60)], [(f"w{k % 2}", k, draw()) for k in range(80)]
    frame = lambda rows: spark.createDataFrame(rows, "week string, id long, items array<string>")
    share = lambda x, y: len(set(x) & set(y)) / len(set(x) | set(y)) if x or y else 0.0
    for least in (0.2, 0.5, 1.0):
        got = sorted((r.a, r.b, round(r.jaccard, 9)) for r in setjoin.similar_sets(frame(left), frame(right), least, ["week"]).collect())
        assert got == sorted((i, j, round(share(x, y), 9)) for w, i, x in left for v, j, y in right if v == w and share(x, y) >= least - 1e-12)
    got = {r.a: (r.b, round(r.jaccard, 9)) for r in setjoin.best_match(frame(left).drop("week"), frame(right).drop("week")).collect()}
    want = {}
    for _, i, x in left:
        best = min(((-round(share(x, y), 9), j) for _, j, y in right), default=None)
        if best and best[0] < 0:
            want[i] = (best[1], -best[0])
    assert got == want
