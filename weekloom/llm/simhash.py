"""Operator 8: near duplicates by SimHash fingerprints and multi-index hashing.

Fingerprints are made in Arrow batches. Equal ones become one class first, with an aggregation that combines before it
shuffles, so thousands of copies cost one row. Classes are then searched: the 64 bits are cut into segments, and by the
pigeonhole principle two fingerprints within the radius agree in some segment up to a small ball. Each class asks the
table of each segment for all keys of that ball, and the whole distance is verified within the join. Segments get
longer as classes get more, so that a key has few classes at any size; no link is ever left out.

A null text is an empty text; texts without words have fingerprint zero. A null doc_id can't name a component, but its
row is returned, and links others like any row; a component of null ids alone has a null component_id. Repeated rows are copies like any other. Columns other than doc_id and text are not read. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import common
from weekloom.llm.components import components

WORDS, SEED, RADIUS, BITS = 3, 42, 3, 64
#: One class of equal fingerprints is hot if it has one of so many parts of all rows.
HOT = 1000
#: Shingles whose bits are counted at a time.
STEP = 1 << 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def shingle_bytes(raw: np.ndarray, at: np.ndarray, words: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Texts with their words joined by single blanks, and for every shingle where it starts and ends and its text."""
    raw = _LOWER[raw]
    space = _SPACE[raw]
    opens = ~space
    opens[1:] &= space[:-1]
    first = at[:-1][at[1:] > at[:-1]]
    opens[first] = ~space[first]
    closes = ~space
    closes[:-1] &= space[1:]
    last = first_last = at[1:][at[1:] > at[:-1]] - 1
    closes[last] = ~space[first_last]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    owner = np.searchsorted(at, starts, side="right") - 1
    # Every word keeps one blank behind it.
    size = ends - starts + 1
    new_end = np.cumsum(size)
    new_start = new_end - size
    take = np.repeat(starts - new_start, size) + np.arange(new_end[-1] if len(new_end) else 0)
    joined = raw[np.minimum(take, len(raw) - 1)] if len(take) else raw[:0]
    joined[new_end - 1] = 0x20
    per_text = np.bincount(owner, minlength=len(at) - 1)
    begin = np.cumsum(per_text) - per_text
    many = np.where(per_text >= words, per_text - words + 1, np.minimum(per_text, 1))
    text = np.repeat(np.arange(len(per_text)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    a = begin[text] + nth
    b = np.minimum(a + words, begin[text] + per_text[text]) - 1
    return joined.tobytes(), new_start[a], new_end[b] - 1, text


def fingerprint_batch(raw: np.ndarray, at: np.ndarray, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """The fingerprint of every text, as unsigned 64-bit integers."""
    from xxhash import xxh64_intdigest

    data, starts, ends, text = shingle_bytes(raw, at, words)
    n = len(at) - 1
    counts = np.zeros((n, BITS), np.int64)
    for k in range(0, len(starts), STEP):
        hashes = np.array([xxh64_intdigest(data[s:e], seed) for s, e in zip(starts[k : k + STEP].tolist(), ends[k : k + STEP].tolist(), strict=True)], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = text[k : k + STEP]
        heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        counts[own[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int32)
    total = np.bincount(text, minlength=n)
    return np.packbits(2 * counts > total[:, None], axis=1, bitorder="little").view("<u8").ravel()


def mark_of(text: Column) -> Column:
    """A digest that tells the texts of one id apart; a null text isn't an empty one."""
    return F.coalesce(F.md5(text.cast("string")), F.lit(""))


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, mark (a digest of the text), and fp, the fingerprint as a signed long."""
    common.small_batches(docs.sparkSession)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprint_batch(*common.bytes_of(batch.column("text")), words, seed)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(fp.view(np.int64))], names=["doc_id", "mark", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark_of(F.col("text")).alias("mark"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(make, "doc_id long, mark string, fp long")


def segments(classes: int, radius: int = RADIUS) -> list[tuple[int, int, int]]:
    """(first bit, bits, ball) of each segment for so many fingerprints.

    With m segments, radius = m * q + r: two fingerprints within the radius differ in at most q bits in one of the
    first r + 1 segments, or in at most q - 1 bits in one of the others (which are not asked where q is 0).
    """
    m = 3 if classes < 1 << 22 else 2
    q, r = divmod(radius, m)
    cuts = [round(BITS * k / m) for k in range(m + 1)]
    return [(a, b - a, q if k <= r else q - 1) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if k <= r or q]


def _segment(fp: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def links_between(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b), a < b: the `rep` of all pairs of classes whose fingerprints differ in at most `radius` bits.

    classes: fp, and rep, a distinct long for each.
    """
    plan = segments(classes.count(), radius)
    tables, probes = [], []
    for k, (first, bits, ball) in enumerate(plan):
        key = _segment(F.col("fp"), first, bits)
        tables.append(F.struct(F.lit(k).alias("k"), key.alias("key")))
        flips = [0]
        for _ in range(ball):
            flips = sorted({f ^ (1 << b) for f in flips for b in range(bits)} | set(flips))
        probes.append(F.array(*(F.struct(F.lit(k).alias("k"), key.bitwiseXOR(F.lit(f).cast("long")).alias("key")) for f in flips)))
    there = classes.select(F.col("fp").alias("fp_b"), F.col("rep").alias("b"), F.inline(F.array(*tables)))
    asked = classes.select(F.col("fp").alias("fp_a"), F.col("rep").alias("a"), F.inline(F.concat(*probes)))
    near = F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= radius
    joined = asked.join(there, (asked.k == there.k) & (asked.key == there.key) & (F.col("a") < F.col("b")) & near)
    return joined.select("a", "b").distinct()


def rooted(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of all rows, and of each different one: fp, n rows, root (of its component), first.

    first: the smallest doc_id of its rows, and of that id's texts the one with the smallest mark. Both are stored.
    """
    prints = common.stored(fingerprints(docs, words), "fingerprints")
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "mark"))
    classes = common.stored(prints.groupBy("fp").agg(F.min(named).alias("first"), F.count("*").alias("n")), "classes")
    # Classes are linked by their fingerprints, so one without any doc_id still joins those around it.
    roots = components(links_between(classes.select("fp", F.col("fp").alias("rep")), radius)).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    return prints, common.stored(classes.join(roots, "fp", "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root")), "rooted")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """Per row of docs: doc_id, fp, component_id (the smallest doc_id that it reaches by links, itself included)."""
    prints, classes = rooted(docs, words, radius)
    named = classes.groupBy("root").agg(F.min("first.doc_id").alias("component_id"))
    whole = common.stored(classes.join(named, "root").select("fp", "n", "component_id"), "components")
    # A class with a thousandth of all rows or more (there are a thousand at most) is broadcast, so it is in no one task.
    rows = whole.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(whole.where(F.col("n") * HOT >= rows).select("fp", "component_id"))
    rest = prints.join(hot.select("fp"), "fp", "left_anti").join(whole.where(F.col("n") * HOT < rows).select("fp", "component_id"), "fp")
    return prints.join(hot, "fp").select("doc_id", "fp", "component_id").union(rest.select("doc_id", "fp", "component_id"))


def keep_one(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One row of each component: that with the smallest doc_id; rows without doc_id stay.

    Rows are chosen, not ids: where an id has several texts, each is in the component of its own fingerprint, and the
    row of a text without a near copy stays, whatever its id. Of texts of one id in one component, that with the smallest
    digest stays; of rows that agree in id and text, one.
    """
    _, classes = rooted(docs, words, radius)
    kept = classes.groupBy("root").agg(F.min("first").alias("first")).where("first IS NOT NULL").select("first.doc_id", "first.mark")
    mark, key = common.unused(docs.columns, "_mark"), common.unused(docs.columns, "_key")
    # Equal rows are combined where they lie; both steps then need the same partitioning, so texts are shuffled once.
    once = docs.where("doc_id IS NOT NULL").withColumns({mark: mark_of(F.col("text")), key: F.col("doc_id").cast("long")}).dropDuplicates([key, mark])
    chosen = once.join(kept.select(F.col("doc_id").alias(key), F.col("mark").alias(mark)), [key, mark], "left_semi").select(docs.columns)
    return chosen.union(docs.where("doc_id IS NULL"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
