"""Token ids of whole texts by a public tokenizer, one encoding for each distinct word of a worker.

A tokenizer of the kinds handled here never joins characters across the white space between two words. A text is
therefore the row of its units (a word with the white space before it), and a unit's ids never depend on its
neighbours. Units are looked up by a 64-bit polynomial hash computed over whole batches with numpy, and the bytes of
each are compared with those of the unit that was found; only units that a worker has not met yet go through the
tokenizers library. Texts with white space other than single blanks and line ends, or with a unit whose hash is that of
another one, are encoded as a whole.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Odd multiplier of the hash.
BASE = 0x9E3779B97F4A7C15
#: Bytes that are hashed at a time, or else one text.
CHUNK = 1 << 20
#: Units that a worker keeps, and their bytes; beyond it the table starts anew, which costs time and changes nothing else.
MOST_UNITS, MOST_BYTES = 1_500_000, 64 << 20


@lru_cache(maxsize=4)
def _powers(bits: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for all i below 2^bits."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.array([1], np.uint64)
        for k in range(bits):
            p = np.concatenate([p, p * np.uint64(pow(b, 1 << k, 1 << 64))])
        out.append(p)
    return out[0], out[1]


def unit_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of every raw[start:end]."""
    up, down = _powers(max(CHUNK.bit_length() - 1, len(raw).bit_length()), BASE)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of every run, back to back."""
    done = np.cumsum(sizes)
    return np.repeat(starts - (done - sizes), sizes) + np.arange(done[-1] if len(done) else 0)


def differ(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which of the runs a[start:start + size] aren't b[start:start + size]."""
    wrong = a[spread(a_starts, sizes)] != b[spread(b_starts, sizes)]
    out = np.zeros(len(sizes), bool)
    if wrong.any():
        out[np.searchsorted(np.cumsum(sizes), np.flatnonzero(wrong), side="right")] = True
    return out


def plain_texts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which texts have no white space but single blanks and line ends between two other characters."""
    n = len(at) - 1
    if not len(raw):
        return np.zeros(n, bool)
    odd = np.zeros(256, bool)
    odd[[*range(0x00, 0x0A), *range(0x0B, 0x20), 0x7F]] = True
    bad = odd[raw]
    space = (raw == 0x20) | (raw == 0x0A)
    bad[1:] |= space[1:] & space[:-1]
    # Lead bytes of white space beyond ASCII: U+0085, U+00A0, U+1680, U+2000-206F, U+3000.
    for lead, seconds in ((0xC2, (0x85, 0xA0)), (0xE1, (0x9A,)), (0xE2, (0x80, 0x81)), (0xE3, (0x80,))):
        where = np.flatnonzero(raw[:-1] == lead)
        bad[where[np.isin(raw[where + 1], seconds)]] = True
    counts = np.concatenate([[0], np.cumsum(bad)])
    ok = (counts[at[1:]] == counts[at[:-1]]) & (at[1:] > at[:-1])
    first, last = np.minimum(at[:-1], len(raw) - 1), np.maximum(at[1:] - 1, 0)
    return ok & ~space[first] & ~space[last]


class WordEncoder:
    """ids of texts by the tokenizer in the file `path`, exactly as its encode(text, add_special_tokens=False).

    Empty texts have no ids. Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        size = max(vocabulary.values()) + 1
        self.width = np.uint16 if size <= 1 << 16 else np.uint32
        # A byte-level vocabulary writes the blank before a word as the letter below; the other kind ends words with a mark.
        self.spaced = "Ġ" in vocabulary and not any(t.endswith("</w>") for t in vocabulary)
        self.opens = np.zeros(size, bool)
        if self.spaced:
            self.opens[[i for t, i in vocabulary.items() if t[0] in "ĠĊ"]] = True
        else:
            self.mark = self.tokenizer.encode("0", add_special_tokens=False).ids
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.pool = np.zeros(0, self.width)
        self.byte_first = np.zeros(0, np.int64)
        self.byte_count = np.zeros(0, np.int64)
        self.bytes = np.zeros(0, np.uint8)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids of all units back to back, not in the units' order, and for each unit where its ids start and how many they are."""
        words = [u.decode() for u in units]
        alone = np.array([(w[0] not in " \n") if self.spaced else ("0" in w) for w in words], bool)
        first, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        ids = np.zeros(0, self.width)
        if len(words) - alone.sum() > 1 and (self.spaced or len(self.mark) == 1):
            joined = np.flatnonzero(~alone)
            if self.spaced:
                ids = np.array(self.whole(["".join(words[k] for k in joined)])[0], self.width)
                begin = np.flatnonzero(self.opens[ids])
                end = np.append(begin[1:], len(ids))
            else:
                ids = np.array(self.whole([" 0 ".join(words[k] for k in joined)])[0], self.width)
                end = np.append(np.flatnonzero(ids == self.mark[0]), len(ids))
                begin = np.append(0, end[:-1] + 1)
            if len(begin) == len(joined):
                first[joined], count[joined] = begin, end - begin
            else:
                alone[:] = True
        else:
            alone[:] = True
        rest = np.flatnonzero(alone)
        parts = self.whole([words[k] for k in rest])
        count[rest] = [len(p) for p in parts]
        first[rest] = len(ids) + np.cumsum(count[rest]) - count[rest]
        return np.concatenate([ids, *(np.array(p, self.width) for p in parts)]), first, count

    def _learn(self, hashes: np.ndarray, units: list[bytes]) -> None:
        ids, first, count = self._encode_units(units)
        sizes = np.array([len(u) for u in units], np.int64)
        where = np.searchsorted(self.keys, hashes)
        self.keys = np.insert(self.keys, where, hashes)
        self.first = np.insert(self.first, where, first + len(self.pool))
        self.count = np.insert(self.count, where, count)
        self.byte_first = np.insert(self.byte_first, where, np.cumsum(sizes) - sizes + len(self.bytes))
        self.byte_count = np.insert(self.byte_count, where, sizes)
        self.pool = np.concatenate([self.pool, ids])
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(units), np.uint8)])

    def encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts back to back, and n + 1 offsets into them. raw, at: as from bytes_of()."""
        if not len(raw):
            return np.zeros(0, self.width), np.zeros(len(at), np.int64)
        if len(raw) <= CHUNK or len(at) == 2:
            return self._encode(raw, at)
        parts, k = [], 0
        while k < len(at) - 1:
            m = max(k + 1, int(np.searchsorted(at, at[k] + CHUNK, side="right")) - 1)
            parts.append(self._encode(raw[at[k] : at[m]], at[k : m + 1] - at[k]))
            k = m
        return np.concatenate([p[0] for p in parts]), np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[1]) for p in parts]))])

    def _encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(at) - 1
        plain = plain_texts(raw, at)
        # Units of all texts; those of texts that aren't plain are thrown away below.
        space = np.flatnonzero((raw == 0x20) | (raw == 0x0A))
        opens = np.zeros(len(raw) + 1, bool)
        opens[space + (not self.spaced)] = True
        opens[at[:-1][at[1:] > at[:-1]]] = True
        starts = np.flatnonzero(opens[:-1])
        ends = np.append(starts[1:], len(raw))
        if not self.spaced:
            ends = ends - ((raw[np.maximum(ends - 1, 0)] == 0x20) | (raw[np.maximum(ends - 1, 0)] == 0x0A))
        owner = np.searchsorted(at, starts, side="right") - 1
        keep = plain[owner] if len(owner) else np.zeros(0, bool)
        starts, ends, owner = starts[keep], ends[keep], owner[keep]
        got = np.zeros(0, self.width)
        per_text = np.zeros(n, np.int64)
        if len(starts):
            h = unit_hashes(raw, starts, ends)
            order = np.argsort(h, kind="stable")
            sorted_h = h[order]
            new = np.concatenate([[True], sorted_h[1:] != sorted_h[:-1]])
            distinct, member = sorted_h[new], order[new]
            inverse = np.empty(len(h), np.int64)
            inverse[order] = np.cumsum(new) - 1
            for _ in range(2):
                where = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
                known = self.keys[where] == distinct if len(self.keys) else np.zeros(len(distinct), bool)
                if known.all():
                    break
                if len(self.keys) + int((~known).sum()) > MOST_UNITS or len(self.bytes) > MOST_BYTES:
                    self.clear()
                    known[:] = False
                fresh = member[~known]
                data = raw.tobytes()
                self._learn(distinct[~known], [data[s:e] for s, e in zip(starts[fresh], ends[fresh], strict=True)])
            found = where[inverse]
            sizes = ends - starts
            other = self.byte_count[found] != sizes
            other |= differ(raw, starts, self.bytes, self.byte_first[found], np.where(other, 0, sizes))
            plain[owner[other]] = False  # the hash of another unit
            count, first = self.count[found], self.first[found]
            got = self.pool[spread(first, count)]
            per_text += np.bincount(owner, count, n).astype(np.int64)
        odd = np.flatnonzero(~plain & (at[1:] > at[:-1]))
        if not len(odd):
            return got, np.concatenate([[0], np.cumsum(per_text)])
        data = raw.tobytes()
        extra = self.whole([data[at[k] : at[k + 1]].decode() for k in odd])
        begin = np.concatenate([[0], np.cumsum(per_text)])
        rows = {int(k): np.array(e, self.width) for k, e in zip(odd, extra, strict=True)}
        parts = [rows[k] if k in rows else got[begin[k] : begin[k + 1]] for k in range(n)]
        per_text[odd] = [len(e) for e in extra]
        return np.concatenate(parts) if parts else got, np.concatenate([[0], np.cumsum(per_text)])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each worker and file."""
    return WordEncoder(path)
