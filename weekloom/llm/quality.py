"""Operator 5: quality scores by a generalised additive model with pairwise interactions.

Each text gives FEATURES numbers (shares of letters, signs, capitals and digits, word and line shapes, repetition). A
feature is cut into bins at quantiles of the training rows. Cyclic boosting visits feature after feature and adds a
shallow regression tree of the logistic gradient to that feature's lookup table; then the pairs of features that
explain most of what is left get two-dimensional tables in the same way. A score is the sum of table entries, found by
bin numbers for whole batches at once.

The tables are fitted on a bounded, documented sample of labelled rows (TRAIN_ROWS); every text is scored from all its
characters. A null text is an empty text and gets the score of one. A null doc_id is never held out and never learnt
from. Repeated rows are scored like any other; other columns are not read. Without labelled rows every score is 0.5.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import characters, common, labelled

TRAIN_ROWS = 12000
BINS, ROUNDS, PAIR_ROUNDS, PAIRS, RATE, SHRINK, LEAST_ROWS = 32, 120, 60, 6, 0.15, 4.0, 20
THRESHOLD = 0.3
FEATURES = ("points", "letters", "capitals", "digits", "signs", "bars", "blanks", "points_per_word", "distinct_words", "repeated_words", "stops", "odd_ends", "no_letters", "lines", "line_points", "repeated_lines", "bangs", "capital_words", "all_capital_words", "longest_word")

_A = np.uint64(0x9E3779B97F4A7C15)


def _per_text(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text, values, n)


def _repeats(keys: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: how many different keys it has, and how many keys equal the one before them."""
    order = np.lexsort((keys, text))
    k, t = keys[order], text[order]
    fresh = np.ones(len(k), bool)
    fresh[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1])
    again = np.zeros(len(k), bool)
    again[1:] = (keys[1:] == keys[:-1]) & (text[1:] == text[:-1])
    return _per_text(fresh, t, n), _per_text(again, text, n)


def measure(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    """FEATURES of texts, as rows of a matrix."""
    letter, lower = characters.tables()
    n = len(at) - 1
    size = np.diff(at)
    text = np.repeat(np.arange(n), size)
    is_letter = letter[points]
    capital = is_letter & (lower[points] != points)
    digit = (points >= 48) & (points <= 57)
    line_end = points == 10
    blank = (points == 32) | line_end | ((points >= 9) & (points <= 13))
    stop = np.isin(points, np.array([33, 44, 46, 58, 59, 63], np.uint32))
    sign = ~(is_letter | digit | blank | stop)

    def share(mask: np.ndarray, of: np.ndarray) -> np.ndarray:
        return _per_text(mask, text, n) / np.maximum(of, 1)

    letters = _per_text(is_letter, text, n)
    # Hash of all points up to here; the difference of two is the hash of what lies between.
    power = np.cumprod(np.full(len(points) + 1, _A, np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * power[:-1])])
    back = np.cumprod(np.full(len(points) + 1, np.uint64(pow(int(_A), -1, 1 << 64)), np.uint64))

    def pieces(gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends, texts and hashes of the runs between gaps."""
        opens, closes = ~gap, ~gap
        opens[1:] &= gap[:-1] | (text[1:] != text[:-1])
        closes[:-1] &= gap[1:] | (text[1:] != text[:-1])
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        return starts, ends, text[starts], (sums[ends] - sums[starts]) * back[starts]

    starts, ends, own, keys = pieces(blank)
    words = np.bincount(own, minlength=n)
    distinct, again = _repeats(keys, own, n)
    seen = np.concatenate([[0], np.cumsum(is_letter)])
    seen_capitals = np.concatenate([[0], np.cumsum(capital)])
    word_letters, word_capitals = seen[ends] - seen[starts], seen_capitals[ends] - seen_capitals[starts]
    longest = np.zeros(n)
    np.maximum.at(longest, own, ends - starts)
    line_starts, line_ends, line_own, line_keys = pieces(line_end)
    lines = np.bincount(line_own, minlength=n)
    distinct_lines, _ = _repeats(line_keys, line_own, n)
    many = np.maximum(words, 1)
    return np.column_stack([
        np.log1p(size), letters / np.maximum(size, 1), share(capital, letters), share(digit, size), share(sign, size), share(points == 124, size), share(blank, size),
        size / many, distinct / many, again / many, share(stop, words), _per_text(sign[ends - 1], own, n) / many, _per_text(word_letters == 0, own, n) / many,
        np.log1p(lines), size / np.maximum(lines, 1), 1 - distinct_lines / np.maximum(lines, 1), share(points == 33, words),
        _per_text(capital[starts], own, n) / many, _per_text((word_capitals == word_letters) & (word_letters > 1), own, n) / many, np.log1p(longest),
    ])


def measured(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    points, at = characters.code_points(raw, at)
    parts = [measure(points[at[a] : at[b]], at[a : b + 1] - at[a]) for a, b in characters.runs(at, 64, 1 << 17)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


class AdditiveModel:
    """Lookup tables for single features and pairs, over bins cut at `edges`."""

    def __init__(self, edges: list[np.ndarray], base: float, tables: list[np.ndarray], pairs: list[tuple[int, int]], pair_tables: list[np.ndarray]):
        self.edges, self.base, self.tables, self.pairs, self.pair_tables = edges, base, tables, pairs, pair_tables

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]) if len(x) else np.zeros(x.shape, int)

    def logits(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        out = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            out += t[b[:, j]]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            out += t[b[:, i], b[:, j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + SHRINK)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SHRINK)


def _tree(g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values per bin of a regression tree of so many levels over gradient and hessian sums of bins."""
    out = np.full(len(g), float(_leaf(g.sum(), h.sum())))
    if depth == 0 or len(g) < 2:
        return out
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(rows)[:-1]
    gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl)
    gain[(nl < LEAST_ROWS) | (rows.sum() - nl < LEAST_ROWS)] = -1
    cut = int(np.argmax(gain)) + 1
    if gain[cut - 1] <= _gain(g.sum(), h.sum()):
        return out
    out[:cut], out[cut:] = _tree(g[:cut], h[:cut], rows[:cut], depth - 1), _tree(g[cut:], h[cut:], rows[cut:], depth - 1)
    return out


def _corners(table: np.ndarray) -> np.ndarray:
    """Sums of the four corners at every cut of both axes: shape (4, cuts, cuts)."""
    c = table.cumsum(0).cumsum(1)
    a = c[:-1, :-1]
    b, d = c[:-1, -1:] - a, c[-1:, :-1] - a
    return np.stack([a, b, d, c[-1, -1] - a - b - d])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of the best tree that cuts each of two features once, and its gain."""
    cg, ch = _corners(g), _corners(h)
    gain = _gain(cg, ch).sum(0)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    v = _leaf(cg[:, i, j], ch[:, i, j])
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v
    return out, float(gain[i, j] - _gain(g.sum(), h.sum()))


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = AdditiveModel(edges, float(np.log(share / (1 - share))), [np.zeros(len(e) + 1) for e in edges], [], [])
    b = model.bins(x)
    z = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, t in enumerate(model.tables):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b[:, j], g, len(t)), np.bincount(b[:, j], h, len(t)), np.bincount(b[:, j], minlength=len(t)))
            t += step
            z += step[b[:, j]]

    def grid(v: np.ndarray, i: int, j: int) -> np.ndarray:
        shape = len(model.tables[i]), len(model.tables[j])
        return np.bincount(b[:, i] * shape[1] + b[:, j], v, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    wide = [j for j, t in enumerate(model.tables) if len(t) > 1]
    gains = [(_pair_tree(grid(g, i, j), grid(h, i, j))[1], i, j) for k, i in enumerate(wide) for j in wide[k + 1 :]]
    model.pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    model.pair_tables = [np.zeros((len(model.tables[i]), len(model.tables[j]))) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), t in zip(model.pairs, model.pair_tables, strict=True):
            g, h = slopes()
            step = RATE * _pair_tree(grid(g, i, j), grid(h, i, j))[0]
            t += step
            z += step[b[:, i], b[:, j]]
    return model


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> AdditiveModel | None:
    common.small_batches(docs.sparkSession)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = measured(*common.bytes_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(list(x), pa.list_(pa.float64()))], names=["y", "x"])

    got = common.bounded(labelled.sample(docs, labels, "quality", most).select("text", "y").mapInArrow(features, "y int, x array<double>"), most).toPandas()
    return fit(np.stack(got["x"].to_numpy()), got["y"].to_numpy(float)) if len(got) else None


def score(docs: DataFrame, model: AdditiveModel | None) -> DataFrame:
    """doc_id and the score of every row of docs."""
    spark = docs.sparkSession
    common.small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.5).alias("score"))
    shared = spark.sparkContext.broadcast(model)  # tables of BINS entries, and PAIRS of BINS * BINS

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.score(measured(*common.bytes_of(batch.column("text")))))], names=["doc_id", "score"])

    return rows.mapInArrow(scored, "doc_id long, score double")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = score(docs, train(docs, common.table(spark, sf_dir, "labels")))
    held = F.coalesce(common.held_out("doc_id"), F.lit(False)).alias("held_out")
    return found.select("doc_id", held, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
