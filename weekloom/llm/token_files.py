"""Operator 7: token ids in binary files, document boundaries as Elias-Fano codes over one id array for each block.

`write_token_files` range-partitions documents by doc_id, encodes each partition in order as a stream and cuts it into
blocks of about BLOCK_IDS ids. A block is one file image (see `pack_block`) in a row of a Parquet folder, so Spark's
committer makes the output atomic and a lost executor costs one partition. `read_token_files` turns the images back into
documents: their bounds and doc_ids are selected from the codes, a few at a time. A block's memory is bounded by
BLOCK_IDS and its longest document; no partition is ever held whole.

Nulls and empty texts are documents with the end id alone. Repeated rows (same doc_id) stay repeated rows, in the order
in which they are read. A null doc_id sorts first. Columns other than doc_id and text are not read. An empty table gives an empty folder.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekloom.llm import common, encoding

BLOCK_IDS = 1 << 20
END_ID = 0
MAGIC = b"WLEF"
#: A stored select position for every so many values.
SELECT_STEP = 64
#: Images of a row group; documents that a reader opens at a time; how far doc_ids of one block lie apart, at most.
IMAGES_AT_ONCE, DOCS_AT_ONCE, MOST_APART = 8, 1 << 15, 1 << 62


class EliasFano:
    """A non-decreasing row of non-negative integers in about n * (2 + log2(u / n)) bits, with direct access.

    Each value's low `low_bits` bits are stored as they are; the high parts are a bit array in which value i sets bit
    (value >> low_bits) + i. The i-th value is found by selecting the i-th set bit, from the stored mark before it: the
    place of every SELECT_STEP-th set bit. `high` is stored in whole 64-bit words.
    """

    HEADER = "<QBQQQ"

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, marks: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.marks = n, low_bits, low, high, marks

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, "<u8"), np.zeros(0, "<u4"))
        low_bits = max(0, int(int(values[-1]) // n).bit_length() - 1)
        low = ((values[:, None] >> np.arange(low_bits)) & 1).astype(np.uint8).ravel()
        places = (values >> low_bits) + np.arange(n)
        high = np.zeros(-(-(int(places[-1]) + 1) // 64) * 64, np.uint8)
        high[places] = 1
        return cls(n, low_bits, np.packbits(low, bitorder="little"), np.packbits(high, bitorder="little").view("<u8"), places[::SELECT_STEP].astype("<u4"))

    def select(self, i: np.ndarray) -> np.ndarray:
        """Places of the i-th set bits: words behind the mark are skipped while they have too few, then halves of one."""
        i = np.asarray(i, np.int64)
        at, left = self.marks[i // SELECT_STEP].astype(np.int64), i % SELECT_STEP
        word = at >> 6
        bits = self.high[word] & (np.uint64(0xFFFFFFFFFFFFFFFF) << (at & 63).astype(np.uint64))
        open_ = np.arange(len(i))
        while len(open_):
            ones = np.bitwise_count(bits[open_]).astype(np.int64)
            open_, ones = open_[past := ones <= left[open_]], ones[past]
            left[open_] -= ones
            word[open_] += 1
            bits[open_] = self.high[word[open_]]
        place = np.zeros(len(i), np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count(bits & np.uint64((1 << half) - 1)).astype(np.int64)
            up = ones <= left
            left -= np.where(up, ones, 0)
            place += np.where(up, half, 0)
            bits = np.where(up, bits >> np.uint64(half), bits)
        return word * 64 + place

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at places i."""
        i = np.asarray(i, np.int64)
        low = np.zeros(len(i), np.int64)
        for k in range(self.low_bits):
            bit = i * self.low_bits + k
            low |= (self.low[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(np.int64) << k
        return (self.select(i) - i) << self.low_bits | low

    def __getitem__(self, i: int) -> int:
        return int(self.get(np.array([i]))[0])

    def to_bytes(self) -> bytes:
        return struct.pack(self.HEADER, self.n, self.low_bits, len(self.low), len(self.high), len(self.marks)) + self.low.tobytes() + self.high.tobytes() + self.marks.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        n, low_bits, a, b, c = struct.unpack_from(cls.HEADER, data, at)
        at += struct.calcsize(cls.HEADER)
        out = cls(n, low_bits, np.frombuffer(data, np.uint8, a, at), np.frombuffer(data, "<u8", b, at + a), np.frombuffer(data, "<u4", c, at + a + 8 * b))
        return out, at + a + 8 * b + 4 * c


class Ids:
    """The doc_ids of a block in ascending order: how many are null (they come first), the least, and what each is above it."""

    def __init__(self, nulls: int, least: int, above: EliasFano):
        self.nulls, self.least, self.above = nulls, least, above

    @classmethod
    def encode(cls, ids: list[int | None]) -> Ids:
        known = np.array([x for x in ids if x is not None], np.int64)
        least = int(known[0]) if len(known) else 0
        return cls(len(ids) - len(known), least, EliasFano.encode(known - least))

    def get(self, i: np.ndarray) -> pa.Array:
        null = i < self.nulls
        out = np.zeros(len(i), np.int64)
        out[~null] = self.above.get(i[~null] - self.nulls) + self.least
        return pa.array(out, pa.int64(), mask=null)

    def to_bytes(self) -> bytes:
        return struct.pack("<Qq", self.nulls, self.least) + self.above.to_bytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int) -> tuple[Ids, int]:
        nulls, least = struct.unpack_from("<Qq", data, at)
        above, at = EliasFano.from_bytes(data, at + 16)
        return cls(nulls, least, above), at


def pack_block(ids: np.ndarray, bounds: np.ndarray, doc_ids: list[int | None]) -> bytes:
    """A file image: magic, bytes of an id, checksum, Elias-Fano codes of the n + 1 document bounds and of the n
    doc_ids, then the ids, little-endian."""
    body = EliasFano.encode(bounds).to_bytes() + Ids.encode(doc_ids).to_bytes() + ids.astype(ids.dtype.newbyteorder("<")).tobytes()
    return MAGIC + struct.pack("<BI", ids.dtype.itemsize, zlib.crc32(body)) + body


def unpack_block(image: bytes) -> tuple[np.ndarray, EliasFano, Ids]:
    """ids, bounds and doc_ids of a file image; raises ValueError if it is damaged."""
    width, checksum = struct.unpack_from("<BI", image, 4)
    at = 4 + struct.calcsize("<BI")
    if image[:4] != MAGIC or zlib.crc32(memoryview(image)[at:]) != checksum:
        raise ValueError("not a token file, or damaged")
    bounds, at = EliasFano.from_bytes(image, at)
    doc_ids, at = Ids.from_bytes(image, at)
    return np.frombuffer(image, "<u2" if width == 2 else "<u4", -1, at), bounds, doc_ids


FILES = "part int, block int, first_doc long, n_docs long, n_ids long, image binary"
ROWS = "doc_id long, part int, block int, local_start long, n_tokens long, ids_crc32 long"
_FILES_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first_doc", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("image", pa.binary())])


def write_token_files(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Writes the ids of all texts, in ascending doc_id order, to a folder of token files."""
    common.small_batches(docs.sparkSession)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block = TaskContext.get().partitionId(), 0
        encode = encoding.encoder(tokenizer_path)
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        size, least = 0, None

        def flush() -> pa.RecordBatch:
            nonlocal held, size, block, least
            doc_ids = [x for h in held for x in h[0]]
            bounds = np.concatenate([[0], np.cumsum(np.concatenate([h[2] for h in held]))])
            ids = np.concatenate([h[1] for h in held])
            out = pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip((part, block, doc_ids[0], len(doc_ids), len(ids), pack_block(ids, bounds, doc_ids)), _FILES_ARROW, strict=True)], schema=_FILES_ARROW)
            held, size, block, least = [], 0, block + 1, None
            return out

        for batch in batches:
            ids, at = encode.encode(*common.bytes_of(batch.column("text")))
            doc_ids, count = batch.column("doc_id").to_pylist(), np.diff(at)
            ends = np.cumsum(count + 1) - 1
            full = np.full(len(ids) + len(count), end_id, encode.width)
            inside = np.ones(len(full), bool)
            inside[ends] = False
            full[inside] = ids
            starts = ends - count
            k = 0
            while k < len(doc_ids):
                room = max(1, block_ids - size)
                m = max(k + 1, int(np.searchsorted(ends, starts[k] + room, side="right")))
                first = least if least is not None else next((x for x in doc_ids[k:m] if x is not None), 0)
                far = next((j for j in range(m - 1, k - 1, -1) if doc_ids[j] is None or doc_ids[j] - first < MOST_APART), k - 1) + 1
                if far == k:  # what lies too far from the block's first id starts another
                    yield flush()
                    continue
                m = far
                held.append((doc_ids[k:m], full[starts[k] : ends[m - 1] + 1], count[k:m] + 1))
                size += len(held[-1][1])
                least = first if doc_ids[m - 1] is not None else None
                k = m
                if size >= block_ids:
                    yield flush()
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Rows of one doc_id go by the order in which they are read, so that an id with many rows is dealt to many parts.
    placed = rows.withColumn("nth", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange("doc_id", "nth").sortWithinPartitions("doc_id", "nth").select("doc_id", "text")
    # Rows are whole images, so a row group has few of them; the reader takes no more than one group at a time.
    ordered.mapInArrow(blocks, FILES).write.option("compression", "zstd").option("parquet.block.row.count.limit", IMAGES_AT_ONCE).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a folder: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (as 32-bit ids)."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, code, doc_ids = unpack_block(row["image"])
                for k in range(0, code.n - 1, DOCS_AT_ONCE):
                    bounds = code.get(np.arange(k, min(k + DOCS_AT_ONCE, code.n - 1) + 1))
                    wide = ids[bounds[0] : bounds[-1]].astype("<u4")
                    crc = [zlib.crc32(wide[a:b]) for a, b in zip(bounds[:-1] - bounds[0], bounds[1:] - bounds[0], strict=True)]
                    n = len(crc)
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids.get(np.arange(k, k + n)), pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["block"], np.int32)), pa.array(bounds[:-1]), pa.array(np.diff(bounds)), pa.array(crc, pa.int64())],
                        names=["doc_id", "part", "block", "local_start", "n_tokens", "ids_crc32"],
                    )

    files = spark.read.schema(FILES).parquet(path)
    # Prefix sums in two steps, so that no task ever sees the blocks of more than one part.
    blocks = files.select("part", "block", "first_doc", "n_ids")
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"), F.min(F.struct(F.col("first_doc").isNotNull(), "first_doc")).alias("first"))
    before = F.sum("n").over(Window.orderBy("first", "part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.select("part", "block", F.coalesce(inside, F.lit(0)).alias("block_start")).join(parts, "part")
    rows = files.select("part", "block", "image").mapInArrow(documents, ROWS)
    return rows.join(starts, ["part", "block"]).select("doc_id", (F.col("part_start") + F.col("block_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = common.new_path(spark, "token-files")
    write_token_files(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return read_token_files(spark, path)
