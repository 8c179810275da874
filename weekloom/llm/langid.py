"""Operator 4: language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters (lower case; runs of other signs count as a blank) are hashed into BUCKETS features.
Document frequencies are counted over all texts that aren't held out.
Weights are trained by follow-the-regularised-leader with elastic-net penalties on a bounded, documented sample of
labelled rows (TRAIN_ROWS), of which one fold sets the temperature of the probabilities. Scoring covers every character
of every text, in Arrow batches. Only text is an input of a prediction.

A null text, an empty text and a text without letters get `und` and score 0. A null doc_id is in no fold: never held
out, never learnt from. Of languages that are equally likely the first in the alphabet is taken. Repeated rows are
scored like any other. Other columns are not read. Without labelled rows all predictions are `und`; an empty table gives
no rows. A text of any length is counted in one piece: 30 bytes a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import characters, common

BUCKET_BITS = 13
BUCKETS = 1 << BUCKET_BITS
ORDERS = (1, 2, 3)
#: Labelled rows that the model is fitted on, at most, about; each language has so many of them if there are.
TRAIN_ROWS, ROWS_EACH = 4000, 100
CALIBRATION_FOLD = 1
#: Follow-the-regularised-leader: learning rate, its offset, L1 and L2 penalties, passes.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.02, 0.01, 3
#: Texts and code points that are counted at a time.
TEXTS, POINTS = 64, 1 << 17
#: Rejected by filter_languages(): a language less likely than this.
LEAST_SCORE = 0.3

_MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def ngram_counts(points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts (texts x BUCKETS) of hashed n-grams, and whether each text has a letter."""
    letter, lower = characters.tables()
    n = len(at) - 1
    is_letter = letter[points]
    stream = np.where(is_letter, lower[points], np.uint32(32))
    letters = np.concatenate([[0], np.cumsum(is_letter)])
    counts = np.zeros((n, BUCKETS), np.int64)
    mixed = np.zeros(len(stream), np.uint32)
    for order in ORDERS:
        # mixed[i] is the hash of the order - 1 characters from i on.
        size = len(stream) - order + 1
        if size <= 0:
            break
        mixed = (mixed[:size] ^ stream[order - 1 :]) * _MULTIPLIERS[order - 1]
        mixed ^= mixed >> np.uint32(15)
        bucket = (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.intp)
        for k in range(n):
            if at[k + 1] - at[k] >= order:
                counts[k] += np.bincount(bucket[at[k] : at[k + 1] - order + 1], minlength=BUCKETS)
    return counts, letters[at[1:]] > letters[at[:-1]]


#: log(1 + count) of the counts that are usual.
_LOGS = np.log1p(np.arange(4096))


def tf_idf(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Values of the features that aren't zero, of unit length. count, idf: of those features."""
    x = (_LOGS[count] if not len(count) or count.max() < len(_LOGS) else np.log1p(count)) * idf
    return x / max(np.sqrt(x @ x), 1e-9)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


class Model:
    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float):
        self.languages, self.idf, self.weights, self.temperature = languages, idf, weights, temperature

    def predict(self, raw: np.ndarray, at: np.ndarray) -> tuple[list[str], np.ndarray]:
        points, at = characters.code_points(raw, at)
        names, scores = [], []
        for a, b in characters.runs(at, TEXTS, POINTS):
            counts, has = ngram_counts(points[at[a] : at[b]], at[a : b + 1] - at[a])
            logits = np.zeros((b - a, len(self.languages)))
            for k, row in enumerate(counts):
                index = np.flatnonzero(row)
                logits[k] = tf_idf(row[index], self.idf[index]) @ self.weights[index]
            p = softmax(logits / self.temperature)
            best = p.argmax(axis=1)
            names += [self.languages[k] if h else "und" for k, h in zip(best, has, strict=True)]
            scores.append(np.where(has, p[np.arange(len(best)), best], 0.0))
        return names, np.concatenate(scores) if scores else np.zeros(0)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int) -> np.ndarray:
    """Weights (BUCKETS x classes) after PASSES passes; rows: indices and values of the features that aren't zero."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) > L1, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    order = np.random.default_rng(4)
    for _ in range(PASSES):
        for k in order.permutation(len(rows)):
            at, x = rows[k]
            w = weights(z[at], n[at])
            p = softmax((x @ w)[None, :])[0]
            p[y[k]] -= 1
            g = x[:, None] * p
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / ALPHA * w
            n[at] = more
    return weights(z, n)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least negative log likelihood on rows that the weights have not seen."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.02), np.log(20), 120))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """How many texts there are that aren't null, and how many of them have each of the BUCKETS n-grams."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            points, at = characters.code_points(*common.bytes_of(batch.column("text")))
            for a, b in characters.runs(at, TEXTS, POINTS):
                df += np.count_nonzero(ngram_counts(points[at[a] : at[b]], at[a : b + 1] - at[a])[0], axis=0)
        some = np.flatnonzero(df)
        # The row with bucket -1 has the number of texts.
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1).astype(np.int32)), pa.array(np.append(df[some], n))], names=["bucket", "n"])

    texts = docs.where(F.col("text").isNotNull()).select(F.col("text").cast("string").alias("text"))
    got = texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS + 1, np.int64)
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return int(out[-1]), out[:-1]


def train(docs: DataFrame, most: int = TRAIN_ROWS, each: int = ROWS_EACH) -> Model | None:
    """Fits the model on about `most` rows with a lang that aren't held out; None without such rows.

    The sample has all languages in proportion, but about `each` rows of one at least (or all it has), so a rare
    language is learnt from a table of any size. Its bound is `most` and `each` for every language.
    """
    common.small_batches(docs.sparkSession)
    rows = docs.where((common.fold("doc_id") != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), common.fold("doc_id").alias("fold"), F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string"), F.lit(7)).alias("pick"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not counts:
        return None
    share = min(1.0, most / sum(counts.values()))
    shares = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, int(min(1.0, max(share, each / n)) * (1 << 31)))))
    sample = rows.where(F.pmod("pick", F.lit(1 << 31)) < F.element_at(shares, F.col("lang")))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, at = characters.code_points(*common.bytes_of(batch.column("text")))
            index, count = [], []
            for a, b in characters.runs(at, TEXTS, POINTS):
                for row in ngram_counts(points[at[a] : at[b]], at[a : b + 1] - at[a])[0]:
                    index.append(np.flatnonzero(row))
                    count.append(row[index[-1]])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("lang", "fold", "pick")), pa.array(index, pa.list_(pa.int32())), pa.array(count, pa.list_(pa.int32()))], names=["lang", "fold", "pick", "index", "count"])

    found = sample.mapInArrow(features, "lang string, fold int, pick long, index array<int>, count array<int>")
    got: pd.DataFrame = common.bounded(found, most + each * len(counts)).toPandas()
    if not len(got):
        return None
    got = got.sort_values(["pick", "lang"]).reset_index(drop=True)
    languages = sorted(got["lang"].unique())
    y = got["lang"].map({x: k for k, x in enumerate(languages)}).to_numpy()
    tested = (got["fold"] == CALIBRATION_FOLD).to_numpy()
    if tested.all():
        tested[:] = False
    texts, df = document_frequencies(docs.where(common.fold("doc_id") != 0))
    idf = np.log((1 + texts) / (1 + df)) + 1
    rows = []
    for at, count in zip(got["index"], got["count"], strict=True):
        at = np.asarray(at, np.int64)
        rows.append((at, tf_idf(np.asarray(count, np.int64), idf[at])))
    seen = np.flatnonzero(~tested)
    weights = fit_ftrl([rows[k] for k in seen], y[seen], len(languages))
    logits = np.array([x @ weights[at] for (at, x), t in zip(rows, tested, strict=True) if t]).reshape(-1, len(languages))
    return Model(languages, idf, weights, fit_temperature(logits, y[tested]))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs with the columns lang_pred and score before its own; none of docs' columns but text is an input.

    Columns of docs that have one of these two names are left out.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    own = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    rows = docs.select(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), *(F.col(f"`{c}`") for c in own))
    if model is None:
        return rows
    shared = spark.sparkContext.broadcast(model)  # BUCKETS x languages weights
    place = own.index("text") + 2

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.predict(*common.bytes_of(batch.column(place)))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64()), *batch.columns[2:]], names=batch.schema.names)

    return rows.mapInArrow(predict, rows.schema)


def filter_languages(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """docs without those that have no letters or no likely language.

    Without any labelled rows no language is known, and all documents with a letter stay.
    """
    model = train(docs)
    if model is None:
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    named = docs.select(*(F.col(f"`{c}`").alias(f"_{k}") if c != "text" else F.col("text") for k, c in enumerate(docs.columns)))
    kept = identify(named, model).where((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return kept.select(*(F.col(f"_{k}").alias(c) if c != "text" else F.col("text") for k, c in enumerate(docs.columns)))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), train(docs))
    held = F.coalesce(common.held_out("doc_id"), F.lit(False)).alias("held_out")
    return found.select("doc_id", held, "lang_pred", "score")
