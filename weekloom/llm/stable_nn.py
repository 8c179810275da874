"""Operator 6: approximate nearest neighbours by stable projections in a kd-tree, with a chi-square stopping test.

Directions are unit vectors, so the largest cosine is the least distance. Each group of rows projects its directions on
a few Gaussian axes: (projected distance / distance)^2 follows a chi-square law with that many degrees of freedom. A
kd-tree over the projections hands out neighbours in order of projected distance, and each one's true cosine is
computed. Once the next neighbour lies at projected distance r, a row nearer than the k-th best distance d would
have had to be projected beyond r; the search stops when the chi-square law gives that a probability below 1 - SURE.
Equal directions are one tree entry with all its ids, so any number of copies costs one verification.

Vectors that are null, zero, or hold null or non-finite components take no part; rows without an id neither. Vectors of
another length only meet their like. An empty table gives no rows.
"""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import blocks, common

K = 5
EVERY = 50
#: Projections (even, for the closed form of the law), rows of a leaf, and the least probability at which a search stops.
AXES, LEAF, SURE = 16, 64, 0.96
#: Neighbours that are verified between two tests.
STEP = 512
SEED = 20


def chi_square(x: np.ndarray, degrees: int) -> np.ndarray:
    """Distribution function of the chi-square law with an even number of degrees of freedom."""
    half = x / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-np.minimum(half, 700)) * total


def tree_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """Row order in which every run of `leaf` rows is a kd-tree leaf: halves by the widest axis, again and again."""
    order = np.arange(len(points))
    spans = [(0, len(points))]
    while spans:
        a, b = spans.pop()
        leaves = -(-(b - a) // leaf)
        if leaves < 2:
            continue
        rows = order[a:b]
        axis = int(np.argmax(np.ptp(points[rows], axis=0)))
        cut = leaves // 2 * leaf
        order[a:b] = rows[np.argpartition(points[rows, axis], cut)]
        spans += [(a, a + cut), (a + cut, b)]
    return order


def in_range(x: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that puts its largest component between a half and one: cosines stay the same to
    the last bit, and no square leaves the range of a double."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])


def build(ids: np.ndarray, x: np.ndarray) -> bytes:
    """Image of a group: the distinct vectors in kd-tree order, their projections and the ids of each."""
    x = in_range(x)
    distinct, entry = np.unique(x, axis=0, return_inverse=True)
    entry = entry.ravel()
    dims = distinct.shape[1]
    axes = np.random.default_rng(SEED).standard_normal((dims, AXES))
    units = distinct / np.linalg.norm(distinct, axis=1, keepdims=True)
    order = tree_order(units @ axes, LEAF)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    member = np.lexsort((ids, place[entry]))
    counts = np.bincount(place[entry], minlength=len(order))
    return struct.pack("<QQQ", len(distinct), dims, len(ids)) + distinct[order].astype("<f8").tobytes() + ids[member].astype("<i8").tobytes() + counts.astype("<i8").tobytes()


class Group:
    def __init__(self, image: bytes):
        m, dims, n = struct.unpack_from("<QQQ", image)
        self.x = np.frombuffer(image, "<f8", m * dims, 24).reshape(m, dims)
        self.ids = np.frombuffer(image, "<i8", n, 24 + self.x.nbytes)
        counts = np.frombuffer(image, "<i8", m, 24 + self.x.nbytes + self.ids.nbytes)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.norms = np.linalg.norm(self.x, axis=1)
        self.axes = np.random.default_rng(SEED).standard_normal((dims, AXES))
        self.projected = projected = (self.x / self.norms[:, None]) @ self.axes
        heads = np.arange(0, m, LEAF)
        self.low, self.high = np.minimum.reduceat(projected, heads), np.maximum.reduceat(projected, heads)
        self.entries = m
        self.verified = 0

    def nearest(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        norm = np.sqrt(query @ query)
        at = query / norm @ self.axes
        gap = np.maximum(np.maximum(self.low - at, at - self.high), 0)
        bound = np.einsum("ij,ij->i", gap, gap)
        leaves = np.argsort(bound, kind="stable")
        bound = np.append(bound[leaves], np.inf)
        rows, cosines = np.zeros(0, np.int64), np.zeros(0)
        waiting, away = np.zeros(0, np.int64), np.zeros(0)
        opened, stop = 0, False
        while not stop and (opened < len(leaves) or len(waiting)):
            # Open the next leaves, then verify what is nearer than all that is still closed.
            until = min(len(leaves), opened + max(8, opened))
            fresh = (leaves[opened:until, None] * LEAF + np.arange(LEAF)).ravel()
            fresh = fresh[fresh < self.entries]
            opened = until
            waiting = np.concatenate([waiting, fresh])
            away = np.concatenate([away, np.square(self.projected[fresh] - at).sum(axis=1)])
            order = np.argsort(away, kind="stable")
            waiting, away = waiting[order], away[order]
            ready, done = int(np.searchsorted(away, bound[opened], side="right")), 0
            while done < ready and not stop:
                now = waiting[done : min(done + STEP, ready)]
                done += len(now)
                self.verified += len(now)
                rows = np.concatenate([rows, now])
                cosines = np.concatenate([cosines, self.x[now] @ query / (self.norms[now] * norm)])
                # An entry may be the query's own, so one more than k stay.
                if len(rows) > k + 1:
                    kept = cosines >= np.partition(cosines, -(k + 1))[-(k + 1)]
                    rows, cosines = rows[kept], cosines[kept]
                if len(rows) > k:
                    far = max(2 - 2 * np.partition(cosines, -(k + 1))[-(k + 1)], 1e-12)
                    r = away[done] if done < len(away) else bound[opened]
                    stop = bool(chi_square(np.float64(min(r, bound[opened]) / far), AXES) >= SURE)
            waiting, away = waiting[done:], away[done:]
        # Of an entry, its k + 1 smallest ids can matter.
        cosines = np.einsum("ij,j->i", self.x[rows], query) / (self.norms[rows] * norm)
        many = np.minimum(self.first[rows + 1] - self.first[rows], k + 1)
        take = np.repeat(self.first[rows], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        found, scores = self.ids[take], np.repeat(cosines, many)
        other = found != own
        found, scores = found[other], scores[other]
        best = np.lexsort((found, -scores))[:k]
        return found[best], scores[best]


def probe(group: Group, query_ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    answers = [group.nearest(int(own), query, k) for own, query in zip(query_ids, in_range(x), strict=True)]
    at = np.repeat(np.arange(len(answers)), [len(a[0]) for a in answers])
    return at, np.concatenate([a[0] for a in answers]), np.concatenate([a[1] for a in answers])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", **sizes: int) -> DataFrame:
    """(query_id, rank, vec_id, score): for every query about k nearest rows by cosine, nearest first."""

    def directed(df: DataFrame) -> DataFrame:
        return blocks.usable(df, id_col, vector_col).where(F.exists("x", lambda v: v != 0))

    return blocks.search(directed(vectors), directed(queries), build, Group, probe, k, "double", **sizes)


def op6_stable_nn(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
