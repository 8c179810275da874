"""Dual-sorted postings of one shard: a wavelet matrix over document numbers, with each term's postings ordered by impact.

The sequence holds, for one term after the other, the documents of its postings, highest impact first. A level of the
matrix deals the sequence by one bit of the document's number, the highest bit first, and keeps the order otherwise, so
a node of the tree is a range of documents, a term's postings there are a range of positions, and the first of them has
the highest impact of that term in the node. Ranks come from packed bits and a count for each 64 of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Nodes of a query that are opened at a time, at first and at most: the best ones, by their bounds.
FIRST, MOST = 64, 2048


def ordered(term: np.ndarray, impact: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The order of postings by term, then highest impact, then document."""
    bits = [int(x.max(initial=0)).bit_length() for x in (term, impact, doc)]
    if sum(bits) > 62:
        return np.lexsort((doc, -impact, term))
    down = (1 << bits[1]) - 1 - impact
    return np.argsort((((term << bits[1]) | down) << bits[2]) | doc)


def levels_of(seq: np.ndarray, docs: int) -> np.ndarray:
    """The bits of each level, packed into 64-bit words (a row for each level, one word more than needed)."""
    height = max(1, (docs - 1).bit_length())
    out = np.zeros((height, len(seq) // 64 + 1), np.uint64)
    for k in range(height):
        bit = (seq >> (height - 1 - k) & 1).astype(bool)
        packed = np.packbits(bit, bitorder="little")
        out[k].view(np.uint8)[: len(packed)] = packed
        seq = np.concatenate([seq[~bit], seq[bit]])
    return out


@dataclass
class Found:
    """The best documents of a query so far: scores and ids, best first, ties to the smaller id; at most k."""

    k: int
    scores: np.ndarray
    ids: np.ndarray

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        best = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[best], ids[best]

    def least(self) -> int:
        """A document that scores less can't be among the best; scores are above 0."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1


class Shard:
    """starts: where each term's postings begin, and their number; impacts: of all postings; ids: document ids, ascending.

    The first `hidden` documents are never found.
    """

    def __init__(self, starts: np.ndarray, impacts: np.ndarray, bits: np.ndarray, ids: np.ndarray, hidden: int = 0):
        self.starts, self.ids, self.hidden = starts, ids, hidden
        n, self.height, self.width = len(impacts), len(bits), bits.shape[1]
        ones = np.bitwise_count(bits).astype(np.int64)
        self.before = np.concatenate([np.zeros((self.height, 1), np.int64), np.cumsum(ones, axis=1)[:, :-1]], axis=1).ravel()
        self.flat = bits.ravel()
        self.zeros = n - ones.sum(axis=1)
        # The impacts in the order of each level, so that a node's bound is one look.
        at = [impacts]
        for k in range(self.height):
            bit = np.unpackbits(bits[k].view(np.uint8), bitorder="little", count=n).astype(bool)
            at.append(np.concatenate([at[-1][~bit], at[-1][bit]]))
        self.impacts, self.n = np.concatenate(at), n

    def ones(self, level: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Set bits of the levels before these positions."""
        word = level * self.width + (at >> 6)
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.flat[word] & low)

    def search(self, terms: np.ndarray, weights: np.ndarray, found: Found) -> None:
        """Adds this shard's best documents for the sum of weight * impact over the terms (numbers of lists)."""
        low, high = self.starts[terms], self.starts[terms + 1]
        bound = int((weights * self.impacts[low]).sum()) if len(terms) else 0
        if bound < found.least():
            return
        # Open nodes: bound, level, first document, and their terms as a part of the pool.
        nodes = [np.array([x], np.int64) for x in (bound, 0, 0, 0, len(terms))]
        pool = [weights, low, high]
        many = FIRST
        while len(nodes[0]):
            keep = nodes[0] >= found.least()
            if not keep.all():
                nodes = [x[keep] for x in nodes]
            if not len(nodes[0]):
                return
            order = np.argpartition(-nodes[0], many - 1) if len(nodes[0]) > many else np.arange(len(nodes[0]))
            best, rest = order[:many], order[many:]
            _, level, doc, first, size = (x[best] for x in nodes)
            nodes = [x[rest] for x in nodes]
            parent = np.repeat(np.arange(len(best)), size)
            at = np.arange(len(parent)) + np.repeat(first - np.cumsum(size) + size, size)
            weight, low, high = (x[at] for x in pool)
            deep = level[parent]
            ones_low, ones_high = self.ones(deep, low), self.ones(deep, high)
            zeros = self.zeros[deep]
            leaf_scores, leaf_docs = [], []
            for side, a, b in ((0, low - ones_low, high - ones_high), (1, zeros + ones_low, zeros + ones_high)):
                there = np.flatnonzero(b > a)
                if not len(there):
                    continue
                own, a, b, w = parent[there], a[there], b[there], weight[there]
                heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                bounds = np.add.reduceat(w * self.impacts[(deep[there] + 1) * self.n + a], heads)
                node = own[heads]
                child_doc = doc[node] * 2 + side
                good = bounds >= found.least()
                leaf = level[node] + 1 == self.height
                named = leaf & good & (child_doc >= self.hidden)
                leaf_scores.append(bounds[named])
                leaf_docs.append(child_doc[named])
                good &= ~leaf
                sizes = np.diff(np.append(heads, len(own)))
                nodes = [np.concatenate(x) for x in zip(nodes, (bounds[good], level[node[good]] + 1, child_doc[good], len(pool[0]) + heads[good], sizes[good]), strict=True)]
                pool = [np.concatenate(x) for x in zip(pool, (w, a, b), strict=True)]
            if any(map(len, leaf_scores)):
                found.add(np.concatenate(leaf_scores), self.ids[np.concatenate(leaf_docs)])
            if len(pool[0]) > 4 * nodes[4].sum() + 65536:  # most of the pool is of nodes that are done
                at = np.arange(int(nodes[4].sum())) + np.repeat(nodes[3] - np.cumsum(nodes[4]) + nodes[4], nodes[4])
                pool = [x[at] for x in pool]
                nodes[3] = np.cumsum(nodes[4]) - nodes[4]
            if len(found.scores) == found.k:  # until then only the best go on, so that a bound to prune by is found soon
                many = min(MOST, many * 2)
