"""Operator 11: ranked lexical search with exact top k, over dual-sorted wavelet trees of shards.

A first pass counts documents and terms, which every impact depends on. A second one makes shards where documents are
read: about SHARD postings each, one row with its dictionary, its postings' impacts and the bits of its wavelet matrix
(see wavelet.py). That table is the index; it holds all terms of all documents and may serve any number of queries. Document
frequencies are summed from the shards' dictionaries for the terms that queries ask. Queries are dealt into blocks, and
every block meets every shard by an equi-join on groups of shards; a task carries the best k of each query from shard to shard,
so later shards open only nodes whose bound is no less than what is already there. The last step ranks what tasks found.

Terms are maximal runs of ASCII letters and digits and of all other characters, with A to Z lower-cased. A null or empty
text has no terms: as a document it counts nowhere, as a query it finds nothing. A document without doc_id counts in all
statistics but can't be named, so it is not returned. Documents that share a doc_id are documents of their own, also where
they are equal; equal scores of one id are ranked in any order. Repeated queries (item_id and text) are one; an item_id
with several texts is several queries. Columns other than the ids and texts are not read, whatever their names. Empty
tables give no rows. A document with more than SHARD terms is a shard of its own; memory grows with the longest text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekloom.llm import common, wavelet

#: Postings of a shard, queries of a block, and queries whose best documents a task holds at a time.
SHARD, BLOCK, HELD = 1 << 20, 512, 65536
#: Fixed values of the score: b and k1, as integers.
B, K1, UNIT = 75, 8, 1000

_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
INDEX = "shard long, terms array<string>, sizes array<int>, ids binary, impacts binary, bits binary"


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD).split() if text else []


def totals(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = whole = 0
        for batch in batches:
            for text in batch.column("text"):
                size = len(terms_of(text.as_py()))
                n, whole = n + (size > 0), whole + size
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([whole], pa.int64())], names=["n", "terms"])

    n, whole = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "n long, terms long").agg(F.sum("n"), F.sum("terms")).first()
    return n or 0, whole or 0


def index(docs: DataFrame, n: int, whole: int, shard: int = SHARD) -> DataFrame:
    """The shards of docs (doc_id, text); n and whole are their totals()."""

    def image(number: int, vocabulary: dict[bytes, int], held: list[tuple]) -> pa.RecordBatch:
        ids = np.array([x[0] for x in held], np.int64)
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        term = np.concatenate([x[2] for x in held])
        tf = np.concatenate([x[3] for x in held])
        each = np.array([len(x[2]) for x in held])
        doc, m = np.repeat(place, each), np.repeat(np.array([x[1] for x in held], np.int64), each)
        impact = 1_000_000_000 * tf // (UNIT * tf + K1 * m)
        names = pa.array(list(vocabulary), pa.binary()).cast(pa.string())
        by_name = pc.array_sort_indices(names).to_numpy()
        rank = np.empty(len(names), np.int64)
        rank[by_name] = np.arange(len(names))
        term = rank[term]
        by = wavelet.ordered(term, impact, doc)
        bits = wavelet.levels_of(doc[by], len(ids))
        sizes = np.bincount(term, minlength=len(names)).astype(np.int32)
        one = lambda values, kind: pa.array([values], kind)
        packed = [ids[order].astype("<i8"), impact[by].astype("<u4"), bits.astype("<u8")]
        columns = [one(number, pa.int64()), pa.ListArray.from_arrays([0, len(names)], names.take(pa.array(by_name))), pa.ListArray.from_arrays([0, len(sizes)], pa.array(sizes))]
        return pa.RecordBatch.from_arrays([*columns, *(one(x.tobytes(), pa.binary()) for x in packed)], names=["shard", "terms", "sizes", "ids", "impacts", "bits"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        made, vocabulary, held, size = 0, {}, [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                if doc_id is None:
                    doc_id = NAMELESS
                counts = Counter(words)
                own = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in counts], np.int64)
                m = 100 - B + B * len(words) * n // whole
                held.append((doc_id, m, own, np.fromiter(counts.values(), np.int64, len(counts))))
                size += len(own)
                if size >= shard:
                    yield image(first + made, vocabulary, held)
                    made, vocabulary, held, size = made + 1, {}, [], 0
        if held:
            yield image(first + made, vocabulary, held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(make, INDEX)


#: Stands for a document without id in a shard; it is never returned.
NAMELESS = -(1 << 63)


def asked(items: DataFrame, shards: DataFrame) -> DataFrame:
    """query, item_id, terms, repeats and dfs of every query that has a term of the index. items: item_id, text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("query").to_pylist(), batch.column("text"), strict=True):
                counts = Counter(terms_of(text.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array([row] * len(counts), pa.int64()), pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int32())], names=["query", "term", "repeats"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    rows = common.stored(rows.withColumn("query", F.monotonically_increasing_id()), "queries")
    terms = common.stored(rows.select("query", "text").mapInArrow(cut, "query long, term string, repeats int"), "terms")
    words = terms.select("term").distinct()
    there = shards.select(F.inline(F.arrays_zip("terms", "sizes"))).select(F.col("terms").alias("term"), "sizes").join(words, "term", "left_semi")
    counted = terms.join(there.groupBy("term").agg(F.sum("sizes").alias("df")), "term")
    whole = counted.groupBy("query").agg(F.collect_list("term").alias("terms"), F.collect_list("repeats").alias("repeats"), F.collect_list("df").alias("dfs"))
    return rows.select("query", "item_id").join(whole, "query")


def weight(df: int, n: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def search(shards: DataFrame, queries: DataFrame, n: int, k: int = 10, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents of each query. shards: from index(); queries: from asked()."""
    blocks, groups = max(1, -(-queries.count() // block)), max(1, shards.count())
    cut = queries.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))
    packed = cut.groupBy("block").agg(F.collect_list(F.struct("query", "terms", "repeats", "dfs")).alias("asked"))
    dealt = packed.select("asked", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    shards = shards.withColumn("group", F.pmod(F.xxhash64("shard"), F.lit(groups)).cast("int"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, wavelet.Found] = {}

        def results() -> pa.RecordBatch:
            sizes = [len(f.scores) for f in held.values()]
            arrays = [np.repeat(np.array(list(held), np.int64), sizes), *(np.concatenate([getattr(f, x) for f in held.values()] or [np.zeros(0, np.int64)]) for x in ("ids", "scores"))]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], names=["query", "doc_id", "score"])

        for batch in batches:
            for row in range(batch.num_rows):
                names, of = batch.column("terms")[row].values, lambda c, kind: np.frombuffer(batch.column(c)[row].as_buffer(), kind)  # noqa: B023, E731
                ids, impacts = of("ids", "<i8"), of("impacts", "<u4").astype(np.int64)
                starts = np.concatenate([[0], np.cumsum(batch.column("sizes")[row].values.to_numpy())]).astype(np.int64)
                tree = wavelet.Shard(starts, impacts, of("bits", "<u8").reshape(-1, len(impacts) // 64 + 1), ids, int((ids == NAMELESS).sum()))
                queries = batch.column("asked")[row].as_py()
                at = pc.index_in(pa.array([t for q in queries for t in q["terms"]], pa.string()), value_set=names).fill_null(-1).to_numpy()
                weights = np.array([r * weight(d, n) for q in queries for r, d in zip(q["repeats"], q["dfs"], strict=True)], np.int64)
                end = 0
                for query in queries:
                    end += len(query["terms"])
                    own, w = at[end - len(query["terms"]) : end], weights[end - len(query["terms"]) : end]
                    have = (own >= 0) & (w > 0)
                    found = held.setdefault(query["query"], wavelet.Found(k, np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    tree.search(own[have].astype(np.int64), w[have], found)
                if len(held) > HELD:
                    yield results()
                    held = {}
        yield results()

    found = shards.join(dealt.hint("shuffle_merge"), "group").select("asked", "terms", "sizes", "ids", "impacts", "bits").mapInArrow(find, "query long, doc_id long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(queries.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = 10, shard: int = SHARD) -> DataFrame:
    """The k documents of the highest scores for each item."""
    common.small_batches(docs.sparkSession)
    n, whole = totals(docs)
    shards = common.stored(index(docs, n, whole, shard), "index")
    return search(shards, common.stored(asked(items, shards), "asked"), n, k)


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


_TERMS = r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"
SQL = f"""
WITH words AS (SELECT row, doc_id, {_TERMS} FROM (SELECT *, row_number() OVER () AS row FROM documents)),
docs AS (SELECT row, count(*) AS n FROM words GROUP BY row),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
postings AS (SELECT row, doc_id, term, count(*) AS tf FROM words GROUP BY row, doc_id, term),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, whole GROUP BY term, n_docs),
lengths AS (SELECT row, 100 - {B} + ({B} * n * n_docs) // n_terms AS m FROM docs, whole),
items AS (SELECT query, item_id, term, count(*) AS repeats FROM (SELECT query, item_id, {_TERMS} FROM (SELECT item_id, text, row_number() OVER () AS query FROM (SELECT DISTINCT item_id, text FROM benchmark))) GROUP BY query, item_id, term),
scored AS (SELECT query, item_id, row, doc_id, sum(repeats * w * ((1000000000 * tf) // ({UNIT} * tf + {K1} * m)))::BIGINT AS score FROM items JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (row) WHERE doc_id IS NOT NULL GROUP BY query, item_id, row, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
