"""Operator 12: the main text of web pages, by a linear-chain conditional random field over their leaf blocks.

A block is described by the elements around it (their names and the parts of their class, id, role and such), by its text
(length, share of links, punctuation, words of short blocks, whether a heading came before); neighbouring blocks by whether they have the
same elements around them. Weights of these features and of transitions are trained on labelled pages: pages of a bounded
sample whose publishers mark the article by an `article` element, as they are, and the same articles set in other layouts
(page_layouts.py), most of which don't mark it. Pages are decoded by Viterbi; blocks of the article are returned in order.

A block ends where a block element begins or ends; br is white space within it. Character references are decoded once per
piece of text, before white space is collapsed. A heading within the article belongs to it. A null or empty page, and one
without text, gives an empty text. Repeated rows are pages like any other, and page_id and url are returned as they are,
also where they are null; other columns aren't read. Where no page of the sample marks its article, layouts are filled with
words made by a rule. An empty table gives no rows. A page is held in memory whole, with its blocks; work is linear in it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import common, page_layouts
from weekloom.llm.blocks_of_html import Block, Paths, leaf_blocks

#: Pages of the sample, the longest page taken into it, layouts made of the sample, steps of training, its rate and pull.
LEARN_PAGES, LEARN_CHARS, LAYOUTS, STEPS, RATE, PULL = 300, 65536, 1500, 120, 0.1, 1e-3
#: Features (words) that fewer training blocks have are left out; words are features of blocks of so many words at most.
LEAST, LEAST_WORD, SHORT = 4, 20, 25
#: Chains of elements that a worker keeps, before it starts anew.
KEPT = 100_000
#: Names around a block that say it isn't of the article, where pages of the sample are labelled.
NOT_ARTICLE = frozenset("<nav> <aside> <footer> <form> <header> <script> comments comment ad ads advert sidebar hidden".split())

_WORD = re.compile(r"[^\W\d_]+")
_END = re.compile(r"[.!?…。！？]")


def text_features(block: Block, heading: bool) -> list[str]:
    """What a block's own text says, and whether a heading came before it, as names."""
    text = block.text
    n, words = len(text), text.count(" ") + 1
    ends = len(_END.findall(text))
    out = [f"size {n.bit_length()}", f"words {words.bit_length()}", f"sentences {min(ends, 5)}", f"linked {-(-4 * block.linked // n)}" if block.linked else "unlinked"]
    out.append("closed" if text[-1] in '.!?…。！？"”»' else "open")
    out.append(("before" if not heading else "after") + " heading")
    out.append("heading" if block.heading else "plain")
    if "©" in text or "·" in text or "|" in text:
        out.append("sign")
    if 4 * sum(map(str.isdigit, text[:200])) > min(n, 200):
        out.append("digits")
    if words <= SHORT:
        out += [f"w {w}" for w in set(_WORD.findall(text.lower()))]
    return out


def described(blocks: list[Block]) -> Iterator[tuple[Block, list[str]]]:
    heading = False
    for block in blocks:
        yield block, text_features(block, heading)
        heading |= block.heading


class Model:
    """weights: of features by name, for the article; moves[same, a, b]: from label a to b, same: equal elements around."""

    def __init__(self, weights: dict[str, float], moves: np.ndarray):
        self.weights, self.moves = weights, moves
        self.paths, self.scores = Paths(), [weights.get("bias", 0.0)]

    def __getstate__(self):
        return self.weights, self.moves

    def __setstate__(self, state):
        self.__init__(*state)

    def unary(self, blocks: list[Block]) -> list[float]:
        for path in range(len(self.scores), len(self.paths.features)):
            self.scores.append(self.weights.get("bias", 0.0) + sum(self.weights.get(f"e {x}", 0.0) for x in self.paths.features[path]))
        get = self.weights.get
        return [self.scores[block.path] + sum(get(x, 0.0) for x in names) for block, names in described(blocks)]

    def labels(self, blocks: list[Block]) -> list[int]:
        """The likeliest labels of a page's blocks, by Viterbi; of two equal ones, that which leaves a block out."""
        if not blocks:
            return []
        scores, moves = self.unary(blocks), self.moves.tolist()
        out, inside, back = 0.0, scores[0], []
        for k in range(1, len(blocks)):
            move = moves[blocks[k].path == blocks[k - 1].path]
            stay_out, from_in = out + move[0][0], inside + move[1][0]
            to_in, stay_in = out + move[0][1], inside + move[1][1]
            back.append((from_in > stay_out, stay_in > to_in))
            out, inside = max(stay_out, from_in), max(to_in, stay_in) + scores[k]
        labels = [int(inside > out)]
        for step in reversed(back):
            labels.append(int(step[labels[-1]]))
        return labels[::-1]

    def extract(self, html: str | None) -> str:
        if len(self.paths.features) > KEPT:
            self.paths, self.scores = Paths(), self.scores[:1]
        blocks = leaf_blocks(html, self.paths) if html else []
        return "\n\n".join(b.text for b, label in zip(blocks, self.labels(blocks), strict=True) if label)


def log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def likelihood(unary: np.ndarray, same: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log Z of each page, the chance that a block is of the article, and of each pair of labels along each edge.

    unary, same: pages x blocks, padded; same[:, k]: block k and the one before it have equal elements around them.
    """
    pages, most = unary.shape
    ahead = np.zeros((pages, most, 2))
    ahead[:, 0, 1] = unary[:, 0]
    for k in range(1, most):
        m = moves[same[:, k]]
        for b in (0, 1):
            ahead[:, k, b] = log_add(ahead[:, k - 1, 0] + m[:, 0, b], ahead[:, k - 1, 1] + m[:, 1, b]) + b * unary[:, k]
    z = log_add(*ahead[np.arange(pages), sizes - 1].T)
    behind = np.zeros((pages, most, 2))
    edges = np.zeros((pages, most, 2, 2))
    for k in range(most - 1, 0, -1):
        m, live = moves[same[:, k]], (k < sizes)[:, None]
        into = m + (behind[:, k] + np.stack([np.zeros(pages), unary[:, k]], 1))[:, None, :]
        edges[:, k] = np.where(live[:, :, None], np.exp(ahead[:, k - 1][:, :, None] + into - z[:, None, None]), 0.0)
        behind[:, k - 1] = np.where(live, log_add(into[:, :, 0], into[:, :, 1]), 0.0)
    chance = np.exp(ahead[:, :, 1] + behind[:, :, 1] - z[:, None])
    return z, chance, edges


def fit(pages: list[tuple[list[Block], list[int]]], paths: Paths) -> Model:
    """Weights and transitions of the largest penalised likelihood of the labels, by Adam over all pages at once."""
    pages = [p for p in pages if p[0]]
    named = [[[*names, "bias", *(f"e {x}" for x in paths.features[block.path])] for block, names in described(blocks)] for blocks, _ in pages]
    counts = Counter(x for page in named for names in page for x in names)
    number = {x: k for k, x in enumerate(sorted(x for x, n in counts.items() if n >= (LEAST_WORD if x.startswith("w ") else LEAST)))}
    sizes = np.array([len(p[0]) for p in pages])
    most, total = sizes.max(initial=1), sizes.sum()
    row = np.repeat(np.arange(len(pages)), sizes)
    col = np.concatenate([np.arange(n) for n in sizes]) if len(pages) else np.zeros(0, int)
    y = np.array([v for _, labels in pages for v in labels], float)
    flat = [[number[x] for x in names if x in number] for page in named for names in page]
    owner = np.repeat(np.arange(total), [len(f) for f in flat])
    index = np.array([x for f in flat for x in f], int)
    same = np.zeros((len(pages), most), int)
    same[row, col] = [int(k > 0 and blocks[k].path == blocks[k - 1].path) for blocks, _ in pages for k in range(len(blocks))]
    truth = np.zeros((len(pages), most), int)
    truth[row, col] = y
    seen = np.zeros((2, 2, 2))
    later = col > 0
    np.add.at(seen, (same[row, col][later], truth[row, col - 1][later], truth[row, col][later]), 1.0)
    at = np.zeros(len(number) + 8)
    mean, square = np.zeros_like(at), np.zeros_like(at)
    for step in range(1, STEPS + 1):
        moves = at[-8:].reshape(2, 2, 2)
        unary = np.zeros((len(pages), most))
        unary[row, col] = np.bincount(owner, at[index], total)
        _, chance, edges = likelihood(unary, same, sizes, moves)
        of_moves = np.stack([(edges * (same == s)[:, :, None, None]).sum((0, 1)) for s in (0, 1)]) - seen
        slope = np.concatenate([np.bincount(index, (chance[row, col] - y)[owner], len(number)), of_moves.ravel()]) / max(1, len(pages)) + PULL * at
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        at = at - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Model({x: float(at[k]) for x, k in number.items()}, at[-8:].reshape(2, 2, 2))


def made_up(rng: Random) -> tuple[str, list[str]]:
    """A title and paragraphs of words made of syllables, where no page lends its own."""
    word = lambda: "".join(rng.choice("ka lo mi ren tu sa vi no del par".split()) for _ in range(rng.randint(1, 3)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(1, 14))).capitalize() + "."
    return sentence(), [" ".join(sentence() for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 8))]


def training_pages(sample: list[str], layouts: int = LAYOUTS, seed: int = 12) -> tuple[list[tuple[list[Block], list[int]]], Paths]:
    """Labelled pages: those of the sample that mark one article, and layouts filled with their texts."""
    rng, paths, out, articles = Random(seed), Paths(), [], []
    for html in sample:
        if len(re.findall(r"<article[\s>]", html, re.IGNORECASE)) == 1:
            blocks = leaf_blocks(html, paths)
            labels = [int("<article>" in paths.features[b.path] and not paths.features[b.path] & NOT_ARTICLE) for b in blocks]
            texts = [b for b, label in zip(blocks, labels, strict=True) if label]
            if texts:
                out.append((blocks, labels))
                title = next((b.text for b in texts if b.heading), texts[0].text)
                articles.append((title, [b.text for b in texts if not b.heading] or [title]))
    prose = [t for _, paragraphs in articles for t in paragraphs]
    for k in range(layouts):
        title, paragraphs = articles[k % len(articles)] if articles else made_up(rng)
        if len(paragraphs) > 12:
            start = rng.randrange(len(paragraphs) - 11)
            paragraphs = paragraphs[start : start + 12]
        pieces = page_layouts.page(rng, title, paragraphs, prose or paragraphs)
        html = "".join(p for p, _ in pieces)
        ends = np.cumsum([len(p) for p, _ in pieces])
        blocks = leaf_blocks(html, paths)
        out.append((blocks, [int(pieces[int(np.searchsorted(ends, b.at, side="right"))][1]) for b in blocks]))
    return out, paths


def learn(pages: DataFrame) -> Model:
    """A model trained on a bounded sample of the pages, drawn by a hash (LEARN_PAGES of LEARN_CHARS characters at most)."""
    html = pages.select(F.col("html").cast("string").alias("html")).where(F.length("html").between(1, LEARN_CHARS))
    drawn = html.where(common.drawn(html.count(), LEARN_PAGES, "html")).distinct()
    sample = sorted(r["html"] for r in common.bounded(drawn, LEARN_PAGES).collect())
    return fit(*training_pages(sample))


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    common.small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.extract(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages")
    return extract(pages, learn(pages))
