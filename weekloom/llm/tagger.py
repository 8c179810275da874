"""A character-level bidirectional LSTM with CRF transitions, trained and run in numpy."""

from __future__ import annotations

import numpy as np

#: Character classes: ASCII 32-126 one each, then line ends, other letters, all else; 0 pads.
CLASSES = 99
EMBED, HIDDEN, WINDOW, STRIDE = 10, 16, 64, 32


def classes(points: np.ndarray) -> np.ndarray:
    out = np.full(len(points), 98, np.int16)
    out[points > 127] = 97
    ascii_ = (points >= 32) & (points < 127)
    out[ascii_] = points[ascii_] - 31
    out[(points >= 9) & (points <= 13)] = 96
    return out


def _scan(table: np.ndarray, recur: np.ndarray, x: np.ndarray, keep: bool):
    """One direction over x (time, rows): hidden states, and what the backward pass needs."""
    steps, rows = x.shape
    h, c = np.zeros((rows, HIDDEN), np.float32), np.zeros((rows, HIDDEN), np.float32)
    hs = np.empty((steps, rows, HIDDEN), np.float32)
    saved = []
    for t in range(steps):
        z = table[x[t]]
        z += h @ recur
        gates = np.tanh(z, out=z)
        gates[:, : 3 * HIDDEN] += 1  # logistic gates: their weights are halved, so that one tanh serves all four
        gates[:, : 3 * HIDDEN] *= 0.5
        i, f, o, g = (gates[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
        new = f * c + i * g
        tc = np.tanh(new)
        if keep:
            saved.append((gates, c, tc, h))
        h, c = o * tc, new
        hs[t] = h
    return hs, saved


def _unscan(recur: np.ndarray, saved: list, dhs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gate inputs (time, rows, 4 * HIDDEN) and of the recurrent weights."""
    dz_all, d_recur = np.empty((*dhs.shape[:2], 4 * HIDDEN), np.float32), np.zeros_like(recur)
    dh, dc = np.zeros(dhs.shape[1:], np.float32), np.zeros(dhs.shape[1:], np.float32)
    for t in range(len(dhs) - 1, -1, -1):
        gates, c, tc, before = saved[t]
        i, f, o, g = (gates[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
        dh = dh + dhs[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = dz_all[t]
        dz[:, :HIDDEN] = dc * g * 2 * i * (1 - i)
        dz[:, HIDDEN : 2 * HIDDEN] = dc * c * 2 * f * (1 - f)
        dz[:, 2 * HIDDEN : 3 * HIDDEN] = dh * tc * 2 * o * (1 - o)
        dz[:, 3 * HIDDEN :] = dc * i * (1 - g * g)
        d_recur += before.T @ dz
        dh, dc = dz @ recur.T, dc * f
    return dz_all, d_recur


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


class Tagger:
    def __init__(self, tags: int, seed: int = 1):
        r = np.random.default_rng(seed)
        self.tags = tags
        self.p = {
            "embed": r.normal(0, 0.3, (CLASSES, EMBED)),
            "out": r.normal(0, 0.2, (2 * HIDDEN, tags)),
            "base": np.zeros(tags),
            "moves": np.zeros((tags, tags)),
            "start": np.zeros(tags),
        }
        for d in "fb":
            self.p["in_" + d] = r.normal(0, 0.3, (EMBED, 4 * HIDDEN))
            self.p["recur_" + d] = r.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
            self.p["bias_" + d] = np.concatenate([np.zeros(HIDDEN), np.full(HIDDEN, 0.5), np.zeros(2 * HIDDEN)])
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def emissions(self, x: np.ndarray, keep: bool = False):
        """Scores of all tags (time, rows, tags) for classes x (time, rows)."""
        p = self.p
        hf, sf = _scan(p["embed"] @ p["in_f"] + p["bias_f"], p["recur_f"], x, keep)
        hb, sb = _scan(p["embed"] @ p["in_b"] + p["bias_b"], p["recur_b"], x[::-1], keep)
        h = np.concatenate([hf, hb[::-1]], axis=2)
        return h @ p["out"] + p["base"], (h, sf, sb)

    def _loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of tags y, and its gradients."""
        p = self.p
        e, (h, sf, sb) = self.emissions(x, keep=True)
        steps, rows, tags = e.shape
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = p["start"] + e[0]
        for t in range(1, steps):
            alpha[t] = _lse(alpha[t - 1][:, :, None] + p["moves"], 1) + e[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = _lse(p["moves"] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _lse(alpha[-1], 1)
        de = np.exp(alpha + beta - total[:, None])
        pairs = np.exp(alpha[:-1, :, :, None] + p["moves"] + (e[1:] + beta[1:])[:, :, None, :] - total[None, :, None, None]).sum((0, 1))
        at = np.arange(rows)
        gold = p["start"][y[0]] + e[np.arange(steps)[:, None], at, y].sum(0) + p["moves"][y[:-1], y[1:]].sum(0)
        de[np.arange(steps)[:, None], at, y] -= 1
        np.subtract.at(pairs, (y[:-1].ravel(), y[1:].ravel()), 1)
        de /= rows
        g = {"moves": pairs / rows, "start": de[0].sum(0), "base": de.sum((0, 1)), "out": h.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, tags)}
        dh = de @ p["out"].T
        g["embed"] = np.zeros_like(p["embed"])
        for d, saved, part, seq in (("f", sf, dh[:, :, :HIDDEN], x), ("b", sb, dh[::-1, :, HIDDEN:], x[::-1])):
            dz, g["recur_" + d] = _unscan(p["recur_" + d], saved, part)
            flat = seq.ravel()
            order = np.argsort(flat, kind="stable")
            heads = np.flatnonzero(np.diff(flat[order], prepend=-1))
            table = np.zeros((CLASSES, 4 * HIDDEN), np.float32)
            table[flat[order][heads]] = np.add.reduceat(dz.reshape(-1, 4 * HIDDEN)[order], heads)
            g["in_" + d], g["bias_" + d] = p["embed"].T @ table, table.sum(0)
            g["embed"] += table @ p["in_" + d].T
        return float((total - gold).mean()), g

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 500, batch: int = 32, rate: float = 0.02, seed: int = 1) -> list[float]:
        """Adam on random batches of windows: x, y (rows, WINDOW)."""
        r = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        losses = []
        for n in range(1, steps + 1):
            at = r.integers(0, len(x), batch)
            loss, g = self._loss(x[at].T, y[at].T)
            losses.append(loss)
            norm = np.sqrt(sum((v * v).sum() for v in g.values()))
            now = rate * min(1, 2 * (1 - n / (steps + 1)))
            for k, v in g.items():
                v *= min(1, 5 / max(norm, 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.99 * second[k] + 0.01 * v * v
                self.p[k] -= now * first[k] / (1 - 0.9**n) / (np.sqrt(second[k] / (1 - 0.99**n)) + 1e-8)
        return losses

    def viterbi(self, e: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best tags (time, rows) for emissions (time, rows, tags); rows may be shorter than time."""
        steps, rows, _ = e.shape
        best = self.p["start"] + e[0]
        back = np.zeros(e.shape, np.int8)
        back[:] = np.arange(self.tags)
        for t in range(1, steps):
            scores = best[:, :, None] + self.p["moves"]
            came = scores.argmax(1)
            live = (t < lengths)[:, None]
            back[t] = np.where(live, came, np.arange(self.tags))
            best = np.where(live, np.take_along_axis(scores, came[:, None, :], 1)[:, 0] + e[t], best)
        out = np.zeros((steps, rows), np.int8)
        tag = best.argmax(1)
        for t in range(steps - 1, -1, -1):
            out[t] = tag
            tag = back[t][np.arange(rows), tag]
        return out


#: Stretches longer than this are decoded one by one, so many characters at a time.
LONG, PART = 1 << 16, 1 << 14
_WEIGHT = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(float)


def window_starts(n: int) -> range:
    return range(0, max(1, n - WINDOW + STRIDE), STRIDE)


def _scores(tagger: Tagger, cuts: list[tuple[int, np.ndarray]], at_once: int = 1024):
    """(number, emissions) of windows of classes, computed at_once at a time."""
    for k in range(0, len(cuts), at_once):
        some = cuts[k : k + at_once]
        x = np.zeros((WINDOW, len(some)), np.int16)
        for j, (_, part) in enumerate(some):
            x[: len(part), j] = part
        e, _ = tagger.emissions(x)
        for j, (number, part) in enumerate(some):
            yield number, e[: len(part), j]


def _decode_long(tagger: Tagger, s: np.ndarray) -> np.ndarray:
    """Tags of one stretch. Scores of a part are dropped once the search has passed it; a byte for each tag stays."""
    n, starts = len(s), window_starts(len(s))
    back = np.zeros((n, tagger.tags), np.int8)
    best = np.zeros(0)
    for a in range(0, n, PART):
        b = min(n, a + PART)
        sums, weights = np.zeros((b - a, tagger.tags)), np.zeros(b - a)
        cuts = [(w, s[w : w + WINDOW]) for w in starts[max(0, -(-(a - WINDOW + 1) // STRIDE)) : -(-b // STRIDE)]]
        for w, e in _scores(tagger, cuts):
            lo, hi = max(w, a), min(w + len(e), b)
            sums[lo - a : hi - a] += e[lo - w : hi - w] * _WEIGHT[lo - w : hi - w, None]
            weights[lo - a : hi - a] += _WEIGHT[lo - w : hi - w]
        scores = sums / weights[:, None]
        for t in range(a, b):
            if t == 0:
                best = tagger.p["start"] + scores[0]
            else:
                moves = best[:, None] + tagger.p["moves"]
                back[t] = moves.argmax(0)
                best = moves.max(0) + scores[t - a]
    out = np.zeros(n, np.int8)
    tag = int(best.argmax())
    for t in range(n - 1, -1, -1):
        out[t] = tag
        tag = int(back[t, tag])
    return out


def decode(tagger: Tagger, stretches: list[np.ndarray], long: int = LONG) -> list[np.ndarray]:
    """Tags of each stretch of classes. It is cut into overlapping windows; where windows overlap, their scores are
    weighed by the distance from the window's edge, and one Viterbi search reconciles the whole stretch."""
    out: list = [_decode_long(tagger, s) if len(s) > long else None for s in stretches]
    order = sorted((k for k in range(len(stretches)) if out[k] is None), key=lambda k: len(stretches[k]))
    k = 0
    while k < len(order):
        # So many stretches of like length that their scores stay at some MB.
        m = k + 1
        while m < len(order) and m - k < 256 and len(stretches[order[m]]) <= max(256, 2 * len(stretches[order[k]])) and len(stretches[order[m]]) * (m - k + 1) <= 1 << 19:
            m += 1
        rows = order[k:m]
        lengths = np.array([len(stretches[r]) for r in rows])
        e, weights = np.zeros((int(lengths.max(initial=1)), len(rows), tagger.tags)), np.zeros((int(lengths.max(initial=1)), len(rows)))
        cuts = [((j, w), stretches[r][w : w + WINDOW]) for j, r in enumerate(rows) for w in window_starts(len(stretches[r]))]
        for (j, w), scores in _scores(tagger, cuts):
            e[w : w + len(scores), j] += scores * _WEIGHT[: len(scores), None]
            weights[w : w + len(scores), j] += _WEIGHT[: len(scores)]
        tags = tagger.viterbi(e / np.maximum(weights, 1)[:, :, None], lengths)
        for j, r in enumerate(rows):
            out[r] = tags[: lengths[j], j]
        k = m
    return out
