"""A training corpus from raw documents: five stages, each a job over all that the one before it kept.

language     drops documents without letters or without a likely language (operator 4)
near_dup     keeps the document with the smallest id of each group of near duplicates (operator 8)
personal     replaces personal data by its kind in brackets (operator 1)
mixing       repeats documents of languages that are short of their target share; takes none away (operator 10)
packing      packs the token ids of all rows into sequences (operator 3)

All stages but the last return the columns of `documents`. Nulls, empty texts, repeated rows and empty tables are
handled as the operators' modules say; a row without text is dropped by the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weekloom.llm import common, langid, mixing, packing, pii, simhash

#: Target shares of tokens: each language's own share to this power, scaled so that none has to shrink.
FLATNESS = 0.7


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.filter_languages(docs)


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, least=1.0, flat=FLATNESS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_dup", near_dup),
    ("personal", personal),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL can't train or apply the models, so the stages are tested against plain versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
