"""Operator 9: toxicity scores of texts that a noisy channel has restored first.

A word may be written with digits and signs for letters, with blanks or dots between letters, or with letters repeated.
Such words span a lattice: each character may stand for some letters (CHANNEL), be dropped, or repeat the one before it,
at a cost; a Viterbi search finds the cheapest reading under a character language model of training words. Words of
letters alone have one reading, themselves, and skip the search, unless a letter comes three times, or twice where the
language model knows the word's part with one of them RARE times better. Full-width letters and signs are read as their
narrow forms. Words that look like a mail address (a letter or digit, @, a host with a dot) or hold `://` are left as they
are, so a word that is disguised as one is not restored. The restored text is scored by the
character n-grams of its words: a logistic model (follow-the-regularised-leader with L1) over the n-grams that training
rows show to be tied to the label.

The language model counts the character n-grams of all words of all documents, hashed into a table of fixed size. The
logistic model is fitted on a bounded, documented sample of labelled rows (TRAIN_ROWS). All characters of all texts are
restored and scored; words of any length are decoded, in time that is linear in it. A null text is an empty text. A null doc_id is never held out and never learnt from. Repeated rows
are scored like any other; other columns are not read. Without labelled rows every score is 0. An empty table gives no
rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import characters, common, labelled

TRAIN_ROWS = 12000
THRESHOLD = 0.5
#: Letters that a sign may stand for.
CHANNEL = {"0": "ou", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "¡": "i", "£": "l"}
#: Signs that may stand between letters and mean nothing.
FILLERS = " .-_*~'`^,:;/\\#\u00ad​‌‍﻿"
#: Signs that may hide a letter within a word, and the letters.
MASKS = {"*": "aeiou", "#": "aeiou"}
#: A doubled letter is looked at where its surroundings with one of them are so many times as frequent.
RARE = 20
#: Costs in nats: a sign read as a letter, a sign dropped, a filler dropped, a letter dropped as a repetition, anything kept as it is.
READ, DROP, FILL, REPEAT, KEEP = 0.7, 3.0, 0.3, 0.4, 0.0
#: Order of the language model, weight of the longer context at each step, and bits of the hash of its n-grams.
ORDER, LONGER, LANGUAGE_BITS = 4, 0.8, 22
#: Readings of words up to this length are kept, as words come again; longer ones are read each time.
KEPT_LENGTH = 80
#: Distinct words that a task cuts into n-grams at a time.
WORDS_PER_TASK = 50_000
#: Word n-grams (a blank marks where a word starts or ends) and the bits of their hash.
GRAMS, HASH_BITS = (4, 5, 6, 8), 20
#: Fewest toxic rows of an n-gram, its least log odds, and how many n-grams the model may use.
FEWEST, LEAST_ODDS, MOST_GRAMS = 5, 2.0, 4096
ALPHA, BETA, L1, L2, PASSES = 0.3, 1.0, 0.3, 0.01, 8
TEXTS, POINTS = 64, 1 << 17

_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D), np.uint32(0x27D4EB2F), np.uint32(0x165667B1), np.uint32(0xB5297A4D), np.uint32(0x68E31DA5), np.uint32(0x1B56C4E9))
_TWIN = 0x9E3B5  # odd: h -> h * _TWIN is a permutation of the hashes


class LanguageModel:
    """Interpolated character model of words, from how often each n-gram and each context of one occurs.

    keys, sums: gram_key() of n-grams, and of contexts with a blank behind them, and their counts. letters: how many
    different letters words have.
    """

    def __init__(self, keys: np.ndarray, sums: np.ndarray, letters: int):
        self.keys, self.sums, self.floor = keys, sums, 1 / (letters + 30)
        self._ready()

    def _ready(self) -> None:
        self._counts = np.zeros(1 << LANGUAGE_BITS, np.float32)
        self._counts[self.keys] = self.sums
        self._costs: dict[tuple[str, str], float] = {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k[0] != "_"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._ready()

    def count(self, gram: str) -> float:
        return float(self._counts[gram_key(gram)])

    def cost(self, context: str, letter: str) -> float:
        got = self._costs.get((context, letter))
        if got is None:
            p = self.floor
            for k in range(len(context) + 1):
                c = context[len(context) - k :]
                total = float(self._counts[gram_key(c + " ")])
                if not total:
                    break
                p = (1 - LONGER) * p + LONGER * min(1.0, float(self._counts[gram_key(c + letter)]) / total)
            if len(self._costs) > 500_000:
                self._costs.clear()
            got = self._costs[context, letter] = -math.log(p)
        return got


def gram_key(gram: str) -> int:
    """The same as Spark's xxhash64(gram) modulo the table's size."""
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(gram.encode("utf-8", "replace"), 42) & ((1 << LANGUAGE_BITS) - 1)


def restore(word: str, model: LanguageModel) -> str:
    """The cheapest reading of a lower-case word (which may hold blanks between its letters).

    A path's state is its last ORDER - 1 letters, on which alone the cost of what follows depends, so the search is exact
    and no path is cut that could be cheapest. Paths share what they have in common: each points back at the one it
    came from.
    """
    paths: dict[str, tuple[float, tuple | None]] = {"^" * (ORDER - 1): (0.0, None)}
    for i, sign in enumerate(word):
        if sign.isalpha():
            readings = [(sign, KEEP)]
        else:
            readings = [(c, READ) for c in CHANNEL.get(sign, "") + (MASKS.get(sign, "") if 0 < i < len(word) - 1 else "")]
        again = i > 0 and word[i - 1] == sign
        drop = (FILL if sign in FILLERS else DROP) if not sign.isalpha() else REPEAT if again else None
        after: dict[str, tuple[float, tuple | None]] = {}
        for context, (cost, back) in paths.items():
            if drop is not None and (context not in after or cost + drop < after[context][0]):
                after[context] = (cost + drop, back)
            for letter, price in readings:
                total = cost + price + model.cost(context, letter)
                key = context[1:] + letter
                if key not in after or total < after[key][0]:
                    after[key] = (total, (back, letter))
        paths = after
    back = min(((cost + model.cost(context, "$"), context, back) for context, (cost, back) in paths.items()), key=lambda x: x[:2])[2]
    letters = []
    while back is not None:
        back, letter = back
        letters.append(letter)
    return "".join(reversed(letters))


def _signs(letters: str) -> np.ndarray:
    return np.array([ord(c) for c in letters], np.uint32)


_READ_AS, _FILL = _signs("".join(CHANNEL)), _signs(FILLERS.replace(" ", "").replace("'", ""))
#: Signs that stand for letters at the end of a word too; the others end a sentence or open a bracket there.
_LAST = _signs("".join(c for c in CHANNEL if c not in "!("))


def disguised(points: np.ndarray, at: np.ndarray, rare=None) -> list[tuple[int, int]]:
    """(start, end) of the words that may hide another.

    These have signs between letters, a sign for a first or last letter, or a letter three times in a row, or twice where
    rare(letter before, letter, letter behind) says that one is far more frequent; or they are three single characters or more, letters and signs for letters, with blanks between them. A word needs a letter, as
    signs alone are a number, and three characters.
    """
    letter, lower = characters.tables()
    if len(points) < 3:
        return []
    is_letter = letter[points]
    blank = (points == 32) | ((points >= 9) & (points <= 13))
    sign = np.isin(points, _READ_AS) | np.isin(points, _FILL)
    edge = np.zeros(len(points) + 1, bool)
    edge[at] = True  # a text starts here
    before_blank = np.concatenate([[True], blank[:-1]]) | edge[:-1]
    mark = np.zeros(len(points), bool)
    # Runs of signs within a text: between letters, or with a sign for a letter and a letter on one side.
    heads = np.flatnonzero(sign & (~np.concatenate([[False], sign[:-1]]) | edge[:-1]))
    tails = np.flatnonzero(sign & (~np.concatenate([sign[1:], [False]]) | edge[1:])) + 1
    after_letter = np.concatenate([[False], is_letter])[heads] & ~edge[heads]
    to_letter = np.concatenate([is_letter, [False]])[tails] & ~edge[tails]
    holds = lambda signs: np.add.reduceat(np.isin(points, signs), heads) if len(heads) else np.zeros(0, int)  # noqa: E731  (between two runs there are no signs)
    mark[heads[(after_letter & to_letter) | (to_letter & (holds(_READ_AS) > 0)) | (after_letter & (holds(_LAST) > 0))]] = True
    small = lower[points]
    triple = is_letter[2:] & (small[2:] == small[1:-1]) & (small[1:-1] == small[:-2])
    mark[2:][triple] = True
    if rare is not None:
        twice = np.flatnonzero(is_letter[1:] & (small[1:] == small[:-1]) & ~edge[1:-1]) + 1
        before = np.where((twice > 1) & ~edge[twice - 1] & is_letter[twice - 2], small[twice - 2], ord("^")).astype(np.int64)
        last = np.minimum(twice + 1, len(points) - 1)
        behind = np.where((twice + 1 < len(points)) & ~edge[twice + 1] & is_letter[last], small[last], ord("$")).astype(np.int64)
        each, of = np.unique(before << 42 | small[twice].astype(np.int64) << 21 | behind, return_inverse=True)
        odd = np.array([rare(chr(k >> 42), chr(k >> 21 & 0x1FFFFF), chr(k & 0x1FFFFF)) for k in each.tolist()], bool)
        mark[twice[odd[of]]] = True
    where = np.flatnonzero(mark)
    breaks = np.flatnonzero(blank | edge[:-1])
    spans = set()
    for i in where:
        k = int(np.searchsorted(breaks, i, side="right")) - 1
        a = 0 if k < 0 else int(breaks[k]) + int(blank[breaks[k]])
        b = int(breaks[k + 1]) if k + 1 < len(breaks) else len(points)
        spans.add((a, b))
    # Words in order; those of one character, a letter or a sign for one, make chains within a text.
    opens = np.flatnonzero(~blank & before_blank)
    single = (np.concatenate([blank[1:], [True]]) | edge[1:])[opens] & (is_letter | np.isin(points, _READ_AS))[opens]
    text = np.searchsorted(at, opens, side="right")
    joins = single[1:] & single[:-1] & (text[1:] == text[:-1])
    starts = np.flatnonzero(joins & ~np.concatenate([[False], joins[:-1]])) if len(joins) else joins
    ends = np.flatnonzero(joins & ~np.concatenate([joins[1:], [False]])) + 1 if len(joins) else joins
    for m, n in zip(starts.tolist(), ends.tolist(), strict=True):
        if n - m >= 2 and is_letter[opens[m : n + 1]].any():
            spans.add((int(opens[m]), int(opens[n]) + 1))
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if (not out or a >= out[-1][1]) and b - a >= 3:
            out.append((a, b))
    return out


_ADDRESS = re.compile(r"[a-z0-9]@[a-z0-9-]+\.[a-z]|://")


def narrow(points: np.ndarray) -> np.ndarray:
    """Full-width forms of ASCII as ASCII."""
    wide = (points >= 0xFF01) & (points <= 0xFF5E)
    return np.where(wide, points - np.uint32(0xFEE0), points) if wide.any() else points


class Restorer:
    def __init__(self, model: LanguageModel):
        self.model = model
        self.known: dict[str, str] = {}
        self.odd: dict[tuple[str, str, str], bool] = {}

    def rare(self, before: str, letter: str, behind: str) -> bool:
        """Whether a doubled letter between these two is far less frequent than a single one."""
        key = before, letter, behind
        got = self.odd.get(key)
        if got is None:
            if len(self.odd) > 500_000:
                self.odd.clear()
            got = self.odd[key] = self.model.count(before + letter * 2 + behind) * RARE < self.model.count(before + letter + behind)
        return got

    def word(self, written: str) -> str:
        got = self.known.get(written)
        if got is None:
            lower = written.lower()
            # What stands for no letter there: a first `!` or `(` may be one, a last one ends a sentence or a bracket.
            core = lower.lstrip("\"')[]{}<>.,;:?*_-~#%&=").rstrip("\"'()[]{}<>.,;:?!*_-~#%&=")
            core = core if any(c.isalpha() for c in core) else lower
            at = lower.find(core)
            if _ADDRESS.search(core) or not any(c.isalpha() for c in core):
                got = written
            else:
                read = restore(core, self.model)
                # A first sign that stood for no letter stays where it was.
                got = written if read == core.lstrip("(!") else lower[:at] + read + lower[at + len(core) :]
            if len(self.known) > 100_000:
                self.known.clear()
            if len(written) <= KEPT_LENGTH:
                self.known[written] = got
        return got

    def texts(self, points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts with their disguised words restored."""
        points = narrow(points)
        spans = disguised(points, at, self.rare)
        if not spans:
            return points, at
        parts, moved, last = [], np.zeros(len(points) + 1, np.int64), 0
        for a, b in spans:
            read = np.frombuffer(self.word(points[a:b].tobytes().decode("utf-32-le", "replace")).encode("utf-32-le", "replace"), np.uint32)
            parts += [points[last:a], read]
            moved[b] += len(read) - (b - a)
            last = b
        parts.append(points[last:])
        return np.concatenate(parts), at + np.cumsum(moved)[at]


def grams(points: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: text number and hash of every n-gram within a word and its two edges, in order of text."""
    letter, lower = characters.tables()
    n = len(at) - 1
    # One blank before each text and one behind the last, so that no n-gram reaches into another text.
    size = np.diff(at) + 1
    stream = np.full(len(points) + n + 1, 32, np.uint32)
    text = np.repeat(np.arange(n), size)
    place = np.arange(len(points)) + np.repeat(np.arange(1, n + 1), size - 1)
    stream[place] = np.where(letter[points], lower[points], np.uint32(32))
    text = np.append(text, max(n - 1, 0))
    word = stream != 32
    inside = np.concatenate([[0], np.cumsum(word)])
    mixed = np.zeros(len(stream), np.uint32)
    for k in range(max(GRAMS)):
        size_k = len(stream) - k
        if size_k <= 0:
            return
        mixed = (mixed[:size_k] ^ stream[k:]) * _MIX[k]
        mixed ^= mixed >> np.uint32(15)
        if k + 1 in GRAMS:
            # All but the first and the last character are letters.
            whole = inside[k : k + size_k] - inside[1 : 1 + size_k] == k - 1
            at_k = np.flatnonzero(whole)
            yield text[at_k], (mixed[at_k] >> np.uint32(32 - HASH_BITS)) ^ np.uint32(k)


def asked(hashes: np.ndarray) -> np.ndarray:
    """A mask of the n-grams that are needed to know which of these features are present."""
    out = np.zeros(1 << HASH_BITS, bool)
    out[hashes] = True
    out[hashes * pow(_TWIN, -1, 1 << HASH_BITS) & ((1 << HASH_BITS) - 1)] = True
    return out


def present(points: np.ndarray, at: np.ndarray, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature), in order of text: each n-gram of a text, and a second feature for those that come again.

    wanted: a mask as from asked(), or None for all.
    """
    texts, hashes = [], []
    for t, h in grams(points, at):
        if wanted is not None:
            kept = wanted[h]
            t, h = t[kept], h[kept]
        texts.append(t)
        hashes.append(h)
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, times = np.unique((np.concatenate(texts).astype(np.int64) << HASH_BITS) | np.concatenate(hashes), return_counts=True)
    mask = (1 << HASH_BITS) - 1
    again = key[times > 1]
    key = np.unique(np.concatenate([key, again & ~mask | (again & mask) * _TWIN & mask]))
    return key >> HASH_BITS, key & mask


class Model:
    def __init__(self, language: LanguageModel, base: float, hashes: np.ndarray, weights: np.ndarray):
        self.language, self.base, self.hashes, self.weights = language, base, hashes, weights

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k[0] != "_"}

    def score(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        if "_wanted" not in self.__dict__:
            self._restorer = Restorer(self.language)
            self._wanted = asked(self.hashes)
            self._weight = np.zeros(1 << HASH_BITS)
            self._weight[self.hashes] = self.weights
        points, at = characters.code_points(raw, at)
        out = np.full(len(at) - 1, self.base)
        for a, b in characters.runs(at, TEXTS, POINTS):
            text, h = present(*self._restorer.texts(points[at[a] : at[b]], at[a : b + 1] - at[a]), self._wanted)
            out[a:b] += np.bincount(text, self._weight[h], b - a)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit_language(docs: DataFrame) -> LanguageModel:
    """The language model of the words of letters of all texts; a word counts once for each text that has it.

    What is gathered at the driver is at most a row for each of the 2^LANGUAGE_BITS keys; all before it is shuffled by
    word and by key, after counts of each task's own.
    """
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text").cast("string")), F.lit(r"(?<![^\s])\p{L}{2,}+(?=[.,;:!?]?(\s|$))"), F.lit(0)))
    words = common.stored(docs.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n")), "words")
    # The table of words is small beside the texts, and cutting words is work: so many tasks as it has words, not bytes.
    words = words.repartition(max(1, -(-words.count() // WORDS_PER_TASK)), "word")
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).distinct().count()
    padded = words.select(F.concat(F.lit("^" * (ORDER - 1)), "word", F.lit("$")).alias("padded"), "n")

    def ending(i):
        grams = [F.col("padded").substr(i - k, F.lit(k + 1)) for k in range(ORDER)]
        contexts = [F.concat(F.col("padded").substr(i - k, F.lit(k)), F.lit(" ")) for k in range(ORDER)]
        return F.array(*grams, *contexts)

    grams = padded.select(F.explode(F.flatten(F.transform(F.sequence(F.lit(ORDER), F.length("padded")), ending))).alias("gram"), "n")
    key = F.pmod(F.xxhash64("gram"), F.lit(1 << LANGUAGE_BITS)).cast("int").alias("key")
    got = grams.groupBy(key).agg(F.sum("n").cast("double").alias("n")).toArrow()
    return LanguageModel(got.column("key").to_numpy(), got.column("n").to_numpy().astype(np.float32), letters)


def fit_weights(rows: list[tuple[np.ndarray, int]], features: int) -> tuple[float, np.ndarray]:
    """Base and weights after PASSES passes; a row has the numbers of its features and its label."""
    z, n = np.zeros(features + 1), np.zeros(features + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) > L1, w, 0.0)

    order = np.random.default_rng(9)
    for _ in range(PASSES):
        for k in order.permutation(len(rows)):
            at = np.append(rows[k][0], features)
            w = weights(at)
            g = 1 / (1 + math.exp(-max(-30.0, min(30.0, w.sum())))) - rows[k][1]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    w = weights(np.arange(features + 1))
    return float(w[-1]), w[:-1]


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model | None:
    spark = docs.sparkSession
    common.small_batches(spark)
    sample = common.stored(labelled.sample(docs, labels, "toxic", most), "toxic-sample")
    rows = {y: n for y, n in sample.groupBy("y").count().collect()}
    if not rows:
        return None
    language = spark.sparkContext.broadcast(fit_language(docs))  # 2^LANGUAGE_BITS counts at most

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << HASH_BITS), np.int32)
        restorer = Restorer(language.value)
        for batch in batches:
            y = batch.column("y").to_numpy()
            points, at = characters.code_points(*common.bytes_of(batch.column("text")))
            for a, b in characters.runs(at, TEXTS, POINTS):
                text, h = present(*restorer.texts(points[at[a] : at[b]], at[a : b + 1] - at[a]), None)
                for label in (0, 1):
                    total[label] += np.bincount(h[y[a:b][text] == label], minlength=1 << HASH_BITS).astype(np.int32)
        some = np.flatnonzero(total[1])  # an n-gram that no toxic row of this part has adds nothing but its clean rows
        rest = np.flatnonzero((total[1] == 0) & (total[0] > 0))
        for at in (some, rest):
            for k in range(0, len(at), 1 << 16):
                part = at[k : k + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)), pa.array(total[1][part].astype(np.int64)), pa.array(total[0][part].astype(np.int64))], names=["h", "n1", "n0"])

    odds = F.log((F.col("n1") + 0.5) / (rows.get(1, 0) + 1)) - F.log((F.col("n0") + 0.5) / (rows.get(0, 0) + 1))
    tied = sample.select("text", "y").mapInArrow(counts, "h long, n1 long, n0 long").groupBy("h").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    tied = tied.where((F.col("n1") >= FEWEST) & (odds >= LEAST_ODDS)).orderBy((F.col("n1") * odds).desc(), "h").limit(MOST_GRAMS)
    hashes = np.sort(np.array([r[0] for r in tied.select("h").collect()], np.int64))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(language.value)
        wanted, own = asked(hashes), np.zeros(1 << HASH_BITS, bool)
        own[hashes] = True
        for batch in batches:
            points, at = characters.code_points(*common.bytes_of(batch.column("text")))
            found = []
            for a, b in characters.runs(at, TEXTS, POINTS):
                text, h = present(*restorer.texts(points[at[a] : at[b]], at[a : b + 1] - at[a]), wanted)
                text, h = text[own[h]], h[own[h]]
                found += np.split(np.searchsorted(hashes, h), np.searchsorted(text, np.arange(1, b - a)))
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.list_(pa.int64()))], names=["y", "at"])

    got = common.bounded(sample.select("text", "y").mapInArrow(rows_of, "y int, at array<long>"), most).toPandas()
    base, weights = fit_weights([(np.asarray(at, np.int64), int(y)) for at, y in zip(got["at"], got["y"], strict=True)], len(hashes))
    some = weights != 0
    return Model(language.value, base, hashes[some], weights[some])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and the score of every row of docs."""
    spark = docs.sparkSession
    common.small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)  # MOST_GRAMS weights and 2^LANGUAGE_BITS counts at most

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.score(*common.bytes_of(batch.column("text"))))], names=["doc_id", "score"])

    return rows.mapInArrow(scored, "doc_id long, score double")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = score(docs, train(docs, common.table(spark, sf_dir, "labels")))
    held = F.coalesce(common.held_out("doc_id"), F.lit(False)).alias("held_out")
    return found.select("doc_id", held, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
