"""Operator 2: exact top-k by integer inner product over a bit-sliced index.

A group of rows holds, for each attribute, its least value and one bitmap for each bit of value minus least. A query
scores all rows of a group at once: its coefficients are written in signed digits (no two neighbours set), a negative
digit uses the complement of the bitmaps, and the bitmaps that fall on one power of two are added by carry-save adders,
which are three exclusive-ors and two ands for 64 rows a word. What is left is the score itself, one bitmap for each of
its bits. The top rows are selected from the most significant score bitmap downward; rows that still tie on the
boundary are resolved by their id, and scores are computed again as integer inner products.

Values are held at plus or minus 2^31 over the square root of the dimensions, far beyond any embedding, so that every
score is a 64-bit integer. Vectors that are null or hold null or non-finite components take no part; rows without an id neither. Repeated rows
with one id are separate candidates. Vectors of another length only meet their like. An empty table gives no rows.
"""

from __future__ import annotations

import math
import struct

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import blocks, common

SCALE = 256.0
K = 5
EVERY = 50
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def quantised(x: np.ndarray, scale: float = SCALE) -> np.ndarray:
    """floor(scale * x), held where the score of two such vectors still is a 64-bit integer."""
    most = float(math.isqrt((1 << 62) // max(1, x.shape[-1])))
    return np.clip(np.floor(scale * x), -most, most).astype(np.int64)


def build(ids: np.ndarray, x: np.ndarray) -> bytes:
    """Image of a group: ids, values, and per attribute the bitmaps of value minus least value."""
    values = quantised(x)
    n, dims = values.shape
    words = -(-n // 64)
    least = values.min(axis=0)
    over = values - least
    widths = [int(over[:, j].max()).bit_length() for j in range(dims)]
    slices = np.zeros((sum(widths), words * 8), np.uint8)
    at = 0
    for j, width in enumerate(widths):
        for b in range(width):
            bits = np.packbits((over[:, j] >> b & 1).astype(np.uint8), bitorder="little")
            slices[at, : len(bits)] = bits
            at += 1
    return struct.pack("<QQ", n, dims) + ids.astype("<i8").tobytes() + values.astype("<i8").tobytes() + least.astype("<i8").tobytes() + np.array(widths, "<i8").tobytes() + slices.tobytes()


class Group:
    def __init__(self, image: bytes):
        self.n, self.dims = struct.unpack_from("<QQ", image)
        at = 16

        def take(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(image, dtype, count, at)
            at += out.nbytes
            return out

        n, dims = self.n, self.dims
        self.ids, self.values = take("<i8", n), take("<i8", n * dims).reshape(n, dims)
        self.least, self.widths = take("<i8", dims), take("<i8", dims)
        self.words = -(-n // 64)
        self.slices = take("<u8", int(self.widths.sum()) * self.words).reshape(-1, self.words)
        self.flipped = ~self.slices
        self.first = np.cumsum(self.widths) - self.widths
        self.rows = np.packbits(np.concatenate([np.ones(n, np.uint8), np.zeros(self.words * 64 - n, np.uint8)]), bitorder="little").view("<u8")

    def scores(self, query: np.ndarray) -> list[np.ndarray | None]:
        """Bitmaps, least significant first, of each row's score plus a constant of the query."""
        at_weight: dict[int, list[np.ndarray]] = {}
        for j in range(self.dims):
            coefficient, width, first = int(query[j]), int(self.widths[j]), int(self.first[j])
            t = 0
            while coefficient:
                if coefficient & 1:
                    digit = 2 - (coefficient & 3)
                    coefficient -= digit
                    source = self.slices if digit > 0 else self.flipped
                    for b in range(width):
                        at_weight.setdefault(t + b, []).append(source[first + b])
                coefficient >>= 1
                t += 1
        out: list[np.ndarray | None] = []
        weight = 0
        while at_weight:
            maps = at_weight.pop(weight, [])
            carries = at_weight.get(weight + 1, [])
            while len(maps) > 2:
                a, b, c = maps.pop(), maps.pop(), maps.pop()
                half = a ^ b
                maps.append(half ^ c)
                half &= c
                a = a & b
                a |= half
                carries.append(a)
            if len(maps) == 2:
                a, b = maps
                maps = [a ^ b]
                carries.append(a & b)
            out.append(maps[0] if maps else None)
            if carries:
                at_weight[weight + 1] = carries
            weight += 1
        return out

    def top(self, maps: list[np.ndarray | None], k: int, out: np.ndarray) -> np.ndarray:
        """Rows of the k best scores of the rows in bitmap `out`, ties to the smaller id. ids are in ascending order."""
        sure, open_ = np.zeros(self.words, np.uint64), out.copy()
        have = 0
        for bits in reversed(maps):
            if bits is None:
                continue
            high = open_ & bits
            many = int(np.bitwise_count(high).sum())
            if have + many > k:
                open_ = high
            else:
                sure |= high
                have += many
                open_ &= ~bits
                if have == k:
                    break
        chosen = self._rows(sure)
        if have < k:
            chosen = np.concatenate([chosen, self._rows(open_)[: k - have]])
        return chosen

    @staticmethod
    def _rows(bits: np.ndarray) -> np.ndarray:
        words = np.flatnonzero(bits)
        inside = np.unpackbits(bits[words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") if len(words) else np.zeros((0, 64), np.uint8)
        row, bit = np.nonzero(inside)
        return words[row] * 64 + bit


def probe(group: Group, query_ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at, found, scores = [], [], []
    for i, (own, query) in enumerate(zip(query_ids, quantised(x), strict=True)):
        others = group.rows.copy()
        for row in range(int(np.searchsorted(group.ids, own)), int(np.searchsorted(group.ids, own, side="right"))):
            others[row >> 6] &= ONES ^ (np.uint64(1) << np.uint64(row & 63))
        rows = group.top(group.scores(query), k, others)
        at.append(np.full(len(rows), i))
        found.append(group.ids[rows])
        scores.append(group.values[rows] @ query)
    return np.concatenate(at), np.concatenate(found), np.concatenate(scores)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", **sizes: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k rows with the largest integer inner product for every query."""
    rows, asked = blocks.usable(vectors, id_col, vector_col), blocks.usable(queries, id_col, vector_col)
    return blocks.search(rows, asked, build, Group, probe, k, "long", **sizes)


def op2_bitslice_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


#: The same by sorting all pairs, for DuckDB.
SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id
  WHERE q.vec_id % {EVERY} = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= {K}
"""
