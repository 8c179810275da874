"""The corpus pipeline on a small table: what goes, what stays, and that all that stays is packed."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_and_run(spark, tmp_path):
    good = [f"The house number {'abcdefghij'[k % 10] * 3} stands by the {'xyzuvw'[k % 6] * 4} river and the {k * 'q'} people there are happy today." for k in range(30)]
    rows = [(k, t, "en") for k, t in enumerate(good)] + [(100, good[3], "en"), (101, "123 456", "en"), (102, None, "en"), (103, "Le chien écrit à x@y.fr tous les jours avec été", "fr"), (104, "", None)]
    rows = [(*r, "src0", len(r[1] or "")) for r in rows]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_dup", "personal", "mixing", "packing"]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        ids = [r.doc_id for r in docs.collect()]
        assert not {101, 102, 104} & set(ids) and 103 in ids
        if name != "language":
            assert 100 not in ids and 3 in ids
    assert "[EMAIL]" in {r.doc_id: r.text for r in docs.collect()}[103]
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(ids) and all(r.offset + r.length <= 4096 for r in packed)


def written(spark, rows, path, more=()):
    docs = spark.createDataFrame([(*r, "src0", len(r[1] or "")) for r in rows], SCHEMA)
    docs.select("*", *more).repartition(2).write.parquet(f"{path}/documents.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


@pytest.mark.parametrize("rows", [[], [(1, None, None), (2, "", "en"), (None, None, None), (3, "12 34", "en")]])
def test_nothing_to_keep(spark, tmp_path, rows):
    docs = written(spark, rows, tmp_path)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == SCHEMA.replace(",", "").split()[::2] and docs.count() == 0
    assert corpus_pipeline.pack(spark, docs, str(tmp_path)).count() == 0


def test_no_labels_null_ids_repeated_rows_and_clashing_names(spark, tmp_path):
    """Repeated rows leave one, rows without id all stay, and a document's own columns come through as they were."""
    names = "score lang_pred fp fingerprint component_id root _nth nth tokens domain posterior rate copies _copy _rate c0 spans bucket _0".split()
    more = [F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in names]
    texts = [f"Each {'bcdfg'[k % 5] * 3} morning the {'klmnp'[k // 5] * 4} boat number {'abcdefghij'[k % 10] * 5} leaves this harbour with {'rstuv'[k % 5] * 6} for the islands" for k in range(20)]
    rows = [(k, t, None) for k, t in enumerate(texts)] + [(4, texts[4], None)] * 5 + [(None, "a line that has no number at all " * 3, None)] * 2 + [(50, texts[7].upper(), None)]
    docs = written(spark, rows, tmp_path, more)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
    kept = docs.collect()
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept) == [-1, -1, *range(20)]
    assert all(r[n] == f"{n} {'none' if r.doc_id is None else r.doc_id}" for r in kept for n in names)
    packed = corpus_pipeline.pack(spark, docs, str(tmp_path)).collect()
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in packed) == [-1, -1, *range(20)]
    assert sum(r.length for r in packed) == sum(r.doc_tokens for r in packed)
