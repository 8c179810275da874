"""Operator 3: packing by shortest-pack-first over the length histogram.

Documents are encoded once; each is cut into pieces of at most `size` ids. The histogram of piece lengths has at most
`size` entries whatever the input, so packing it is driver work of bounded size: lengths are placed longest first, each
on the packs with most room left, and packs of equal content are one pattern with a count. Patterns become ranges of
ranks for each length; a piece finds its sequence by its rank among the pieces of its length. Ranks come from counts
for each (length, bucket), so a length that a third of all pieces have is ranked in many tasks.

Nulls and empty texts are documents with the end id alone. Repeated rows are separate documents: each row's ids are
packed once. Columns other than doc_id and text are not read. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekloom.llm import common, encoding

SIZE = 4096
END_ID = 2
#: Pieces of one length are ranked in so many groups at least, and in so many that a group has about RANKED rows at most.
BUCKETS, RANKED, MOST_BUCKETS = 64, 1 << 18, 1024

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every document's ids and end id, cut into pieces of at most `size` ids."""
    common.small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding.encoder(tokenizer_path)
        for batch in batches:
            ids, at = encode.encode(*common.bytes_of(batch.column("text")))
            n = len(at) - 1
            ends = at[1:] + np.arange(1, n + 1)
            full = np.full(len(ids) + n, end_id, np.uint32)
            inside = np.ones(len(full), bool)
            inside[ends - 1] = False
            full[inside] = ids
            total = np.diff(at) + 1
            many = -(-total // size)
            owner = np.repeat(np.arange(n), many)
            start = (np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)) * size
            length = np.minimum(size, total[owner] - start)
            first = (ends - total)[owner] + start
            crc = [zlib.crc32(full[a:b]) for a, b in zip(first, first + length, strict=True)]
            out = [batch.column("doc_id").take(pa.array(owner)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(total[owner])]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                out.append(pa.array([full[a:b] for a, b in zip(first, first + length, strict=True)], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, PIECES + (", ids array<long>" if with_ids else ""))


def shortest_pack_first(histogram: np.ndarray) -> list[tuple[int, list[int]]]:
    """Patterns (how often, lengths longest first) that hold histogram[l] pieces of every length l below len(histogram)."""
    size = len(histogram) - 1
    by_room: list[list[tuple[int, tuple]]] = [[] for _ in range(size + 1)]
    for length in range(size, 0, -1):
        left = int(histogram[length])
        room = size
        # Packs that get a piece here have less room than all packs before them, and may get another after those.
        while left:
            while room >= length and not by_room[room]:
                room -= 1
            if room < length:
                by_room[size - length].append((left, (None, length)))
                break
            count, pattern = by_room[room].pop()
            placed = min(left, count)
            if count > placed:
                by_room[room].append((count - placed, pattern))
            by_room[room - length].append((placed, (pattern, length)))
            left -= placed
    out = []
    for packs in by_room:
        for count, pattern in packs:
            lengths = []
            while pattern:
                pattern, length = pattern
                lengths.append(length)
            out.append((count, lengths[::-1]))
    return out


class Places:
    """Sequence and offset of the piece of a length with a rank among the pieces of that length."""

    def __init__(self, histogram: np.ndarray):
        starts: dict[int, list[tuple[int, int, int, int]]] = {}
        used = np.zeros(len(histogram), np.int64)
        base = 0
        self.patterns = shortest_pack_first(histogram)
        for count, lengths in self.patterns:
            offset, k = 0, 0
            while k < len(lengths):
                length, same = lengths[k], 1
                while k + same < len(lengths) and lengths[k + same] == length:
                    same += 1
                starts.setdefault(length, []).append((int(used[length]), base, same, offset))
                used[length] += count * same
                offset += length * same
                k += same
            base += count
        self.sequences = base
        self.ranges = {length: np.array(x, np.int64) for length, x in starts.items()}

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
            length, ranges = int(lengths[rows[0]]), self.ranges[int(lengths[rows[0]])]
            hit = ranges[np.searchsorted(ranges[:, 0], ranks[rows], side="right") - 1]
            past = ranks[rows] - hit[:, 0]
            sequence[rows] = hit[:, 1] + past // hit[:, 2]
            offset[rows] = hit[:, 3] + past % hit[:, 2] * length
        return sequence, offset


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """`cut`, a stored table of pieces, with sequence_id and offset in it. Sequences have at most `size` ids."""
    spark = cut.sparkSession
    n = cut.count()
    buckets = int(min(MOST_BUCKETS, max(BUCKETS, n // RANKED)))
    keyed = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = keyed.groupBy("length", "bucket").count().toArrow()  # at most size * buckets rows of 16 bytes
    table = np.zeros((size + 1, buckets), np.int64)
    table[counts.column("length").to_numpy(), counts.column("bucket").to_numpy()] = counts.column("count").to_numpy()
    before = spark.sparkContext.broadcast((np.cumsum(table, axis=1) - table, Places(table.sum(axis=1))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets, places = before.value
        for batch in batches:
            lengths, bucket, nth = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "bucket", "nth"))
            sequence, offset = places.find(lengths, offsets[lengths, bucket] + nth - 1)
            kept = [k for k, name in enumerate(batch.schema.names) if name not in ("bucket", "nth")]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), pa.array(sequence), pa.array(offset)], names=[*(batch.schema.names[k] for k in kept), "sequence_id", "offset"])

    nth = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return keyed.withColumn("nth", nth).mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """All documents as packed pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return pack(common.stored(pieces(docs, tokenizer_path, size, end_id), "pieces"), size)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(common.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
