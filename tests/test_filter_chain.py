"""Hits under the strictest filter against all pairs, with vectors that no block can hold."""

import random

from pyspark.sql import functions as F

from weekloom.functions import vectors
from weekloom.operators import blocked
from weekloom.plans import catalog


def test_chain_equals_all_pairs(spark, tmp_path):
    rng = random.Random(4)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(3)], rng.choice([0, 1, 2, -1, None])) for k in range(300)]
    odd = [(320, None, 1), (328, [0.0, 0.0, 0.0], 1), (336, [1.0, None, 0.5], 0), (340, [1.0, 2.0], 2), (344, [float("nan"), 1.0, 1.0], 1), (360, [], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    v = df.select(F.col("vec_id").alias("id"), (F.col("vec_id") % 8).alias("w"), "embedding", "label")
    q = v.where("id % 20 = 0").select("w", F.col("id").alias("query_id"), F.col("embedding").alias("q"), F.col("label").alias("ql"))
    near = vectors.cosine(F.col("embedding"), F.col("q")) >= 0.35
    pairs = v.join(q, "w").where("id <> query_id").select("query_id", "id", F.when(near & (F.col("label") == F.col("ql")), 0).when(near, 1).otherwise(2).alias("tier")).collect()
    want = []
    for x in {p.query_id for p in pairs}:
        best = min(p.tier for p in pairs if p.query_id == x)
        ids = [p.id for p in pairs if p.query_id == x and p.tier == best]
        want.append((x, best, len(ids), min(ids)))
    made = catalog.queries()["vec06_filter_chain"](spark, str(tmp_path)).select("query_id", "tier", "n", "first_id")
    assert sorted(map(tuple, made.collect())) == sorted(want)


def test_pairs_never_become_rows(spark):
    """Many rows of a few blocks give a row for each query, tier and pair of blocks, not one for each pair of vectors."""
    df = spark.range(400).select("id", F.array(F.sin("id"), F.cos("id")).alias("v"), (F.col("id") % 3).alias("tag"), F.lit("w").alias("w"))
    made = blocked.tiers(df, df.where("id % 20 = 0"), ["w"], "v", "tag", 0.35, block=200)
    assert made.agg(F.sum("n")).first()[0] == 20 * 399 and made.count() <= 20 * 3 * 3
