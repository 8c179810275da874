"""Lexical search, page extraction and Merkle manifests against plain versions, with the odd cases that each must bear."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weekloom.llm import lexical, main_text, merkle, wavelet
from weekloom.llm.blocks_of_html import Paths, leaf_blocks

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h string, key string, idx long, query long, shard long"


def rows_of(n, seed=1, sources=("a", "b", "", None)):
    rng = random.Random(seed)
    words = ["Ab", "ab", "cd", "ef", "été", "x1", "zz", "q", "rare", "한국"]
    out = []
    for k in range(n):
        text = None if k % 17 == 3 else "" if k % 19 == 4 else " ".join(rng.choice(words[: rng.randint(1, 10)]) for _ in range(rng.randint(1, 60)))
        source = sources[0] if rng.random() < 0.5 else rng.choice(sources)
        out.append((k, text, rng.choice(["en", None]), source, None if k % 7 == 0 else k * 3, "clash", "clash", 1, 2, 3))
    return out


# Merkle


def plain_manifest(rows, fanout=16):
    """doc_id -> (leaf, subroot, root, proof, folded, verified), by lists of whole levels."""
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    h = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
        return levels

    def up(levels, at):
        out = []
        for level in levels[:-1]:
            start = at // fanout * fanout
            out.append((level[start:at], level[at + 1 : start + fanout]))
            at //= fanout
        return out

    leaf = lambda r, text: h(field(r[0]), field(r[3]), field(r[2]), field(r[4]), field(text))
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = {s: tree([leaf(r, r[1]) for r in by[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for at, r in enumerate(by[s]):
            steps = up(trees[s], at) + up(top, k)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None
            now = leaf(r, re.sub("[A-Z]", lambda m: m[0].lower(), r[1]) if hit else r[1])
            for before, after in steps:
                now = h(*before, now, *after)
            out.append((r[0], leaf(r, r[1]), trees[s][-1][0], top[-1][0], h(*(x for a, b in steps for x in a + b)), now, now == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize(("n", "fanout", "sources"), [(1, 16, ("a",)), (40, 2, ("a", "b", "", None)), (700, 3, ("a", "b", "", None)), (300, 2, tuple(f"s{k}" for k in range(40)))])
def test_manifest_equals_whole_trees(spark, n, fanout, sources):
    rows = rows_of(n, sources=sources)
    rows += [rows[0], (None, "Nameless", None, sources[0], 1, "", "", 1, 2, 3), (rows[0][0], "Another", None, rows[0][3], 1, "", "", 1, 2, 3)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    got = merkle.checked(merkle.leaves(docs, hit, F.translate("text", merkle.UPPER, merkle.LOWER)), fanout, 2)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_manifest(rows, fanout)


def test_proofs_lead_to_the_root(spark):
    rows = merkle.leaves(spark.createDataFrame(rows_of(120), DOCS))
    _, _, root = merkle.forest(rows, 3, 2)
    steps = merkle.proofs(rows, fanout=3).collect()
    assert len(steps) == 120 and all(merkle.fold(r["h"], r["before"], r["after"]) == root for r in steps)
    assert merkle.forest(rows.limit(0))[2] is None and merkle.checked(rows.limit(0)).count() == 0


# Lexical search


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain_rank(docs, items, k=10):
    bags = [(d, Counter(plain_terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n, whole = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for d, bag in bags:
            m = 25 + 75 * bag.total() * n // whole
            score = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t, r in Counter(plain_terms(text)).items() if bag[t])
            if score > 0 and d is not None:
                scored.append((-score, d))
        out += [(item, i + 1, d, -s) for i, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("shard", [30, 1 << 20])
def test_search_equals_scoring_every_document(spark, shard):
    rows = [(r[0], r[1]) for r in rows_of(300)]
    rows += [rows[0], rows[1], (None, "rare rare rare zz"), (7, "rare"), (900, "word " * 20_000 + "Rare"), (901, "A.b,c"), (902, ".,-")]
    items = [(1, "rare zz AB"), (2, "été, été x1 q"), (3, "nowhere"), (4, ""), (5, None), (None, "cd-ef"), (1, "rare zz AB"), (1, "한국 cd"), (6, " ".join(t for _, t in rows[:40] if t))]
    docs = spark.createDataFrame([(d, t, "x", "clash") for d, t in rows], "doc_id long, text string, score string, query string").repartition(3)
    got = lexical.rank(docs, spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int"), shard=shard)
    # Equal rows of one id may be ranked in any order, but their columns are equal.
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_rank(rows, items)
    assert lexical.rank(docs.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert lexical.rank(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_wavelet_search_equals_scoring(data):
    docs = data.draw(st.integers(1, 70))
    rng = np.random.default_rng(data.draw(st.integers(0, 9999)))
    lists = [np.flatnonzero(rng.random(docs) < rng.random()) for _ in range(6)]
    lists = [x for x in lists if len(x)] or [np.array([0])]
    term, doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.concatenate(lists)
    impact = rng.integers(1, 6, len(doc))
    by = wavelet.ordered(term, impact, doc)
    starts = np.searchsorted(term[by], np.arange(len(lists) + 1))
    ids, hidden = np.arange(docs) * 3, int(rng.integers(0, 3))
    tree = wavelet.Shard(starts, impact[by], wavelet.levels_of(doc[by], docs), ids, hidden)
    asked, weights = np.arange(len(lists)), rng.integers(1, 4, len(lists))
    found = wavelet.Found(4, np.zeros(0, np.int64), np.zeros(0, np.int64))
    tree.search(asked, weights, found)
    scores = np.bincount(doc, weights[term] * impact, docs).astype(int)
    best = sorted((-s, d * 3) for d, s in enumerate(scores) if s and d >= hidden)[:4]
    assert [(-s, d) for s, d in zip(found.scores.tolist(), found.ids.tolist(), strict=True)] == best


# Pages


@pytest.fixture(scope="module")
def model(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    return main_text.learn(pages.where("page_id % 2 = 0"))


def test_blocks_of_odd_pages():
    cut = lambda html: [b.text for b in leaf_blocks(html, Paths())]
    assert cut("<p>a&nbsp;b<br>c <b>d</b>\n e<p>f") == ["a b c d e", "f"]
    assert cut("<script>var x = '<p>no</p>';</script>x<style>p{}</style><!-- <p>no -->y") == ["xy"]
    assert cut("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == ["a", "b", "c", "d"]
    assert cut("a < b &lt;p&gt; &amp;amp; &#65;") == ["a < b <p> &amp; A"]
    assert cut("a</div><p title='x>y' id=\"q\">b</p></p><img src='") == ["a", "b"]
    assert cut("a<!-- cut off") == ["a"] and cut("<script>cut off") == [] and cut("") == [] and cut("<") == ["<"]
    assert cut("<div>" * 5000 + "deep" + "</b>" * 5000) == ["deep"]
    assert cut("<a<a<a" * 20_000) == [] and cut("<p x='" * 20_000) != ["no end"]


def test_likelihood_equals_a_sum_over_all_labelings():
    rng = np.random.default_rng(3)
    unary, same, moves = rng.normal(size=(1, 5)), rng.integers(0, 2, (1, 5)), rng.normal(size=(2, 2, 2))
    z, chance, edges = main_text.likelihood(unary, same, np.array([5]), moves)
    every = [[k >> i & 1 for i in range(5)] for k in range(32)]
    score = [sum(unary[0, i] * y[i] for i in range(5)) + sum(moves[same[0, i], y[i - 1], y[i]] for i in range(1, 5)) for y in every]
    p = np.exp(score - np.logaddexp.reduce(score))
    assert np.isclose(z[0], np.logaddexp.reduce(score)) and np.allclose(chance[0], p @ np.array(every))
    assert np.allclose(edges[0, 2], [[sum(q for q, y in zip(p, every, strict=True) if (y[1], y[2]) == (a, b)) for b in (0, 1)] for a in (0, 1)])


def test_viterbi_is_the_best_of_all_labelings():
    rng = np.random.default_rng(4)
    for _ in range(30):
        blocks = leaf_blocks("".join(f"<p class=c{rng.integers(2)}>x{k}</p>" for k in range(6)), Paths())
        model = main_text.Model({}, rng.normal(size=(2, 2, 2)))
        scores = rng.normal(size=6).tolist()
        model.unary = lambda _: scores  # noqa: B023
        value = lambda y: sum(s for s, on in zip(scores, y, strict=True) if on) + sum(model.moves[int(blocks[k].path == blocks[k - 1].path), y[k - 1], y[k]] for k in range(1, 6))  # noqa: B023, E731
        assert np.isclose(value(model.labels(blocks)), max(value([k >> i & 1 for i in range(6)]) for k in range(64)))


def test_unseen_layouts_are_read_right(spark, model):
    sample = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").where("page_id % 2 = 1").collect()]
    pages, paths = main_text.training_pages(sample, 300, seed=77)
    model = main_text.Model(model.weights, model.moves)
    model.paths = paths
    right = [g == y for blocks, labels in pages for g, y in zip(model.labels(blocks), labels, strict=True)]
    assert np.mean(right) > 0.985


def test_pages_by_hand(model):
    one, two = "The council met on Tuesday evening to discuss the new budget.", "Officials said that the plan would be reviewed again in March."
    page = f"<body><nav><ul><li><a href=a>Start</a><li><a href=b>Sport</a></ul></nav><div class=wrap><h1>Budget &amp; talks</h1><p>{one}<div class='ad-slot'>Buy shoes now!</div><p>{two}</div><div class=comments-area><p>This is a terrible idea, they should resign.</p></div><footer>Copyright 2020</footer>"
    assert model.extract(page) == f"Budget & talks\n\n{one}\n\n{two}"
    assert [model.extract(x) for x in (None, "", "   ", "<script>var a='<p>no</p>'", "<nav><a href=/>Home</a></nav>")] == [""] * 5
    table = f"<table><tr><td class=menu><a href=x>One</a><br><a href=y>Two</a></td><td><h2>Old page</h2><p>{one}<p>{two}</td></tr></table>"
    assert model.extract(table) == f"Old page\n\n{one}\n\n{two}"


def test_extraction_keeps_every_page(spark, model):
    rows = [(1, "u", "<article><p>The text of a page, in one sentence.</p></article>", "clash"), (1, "u", "<article><p>The text of a page, in one sentence.</p></article>", "clash"), (None, None, None, "x"), (2, "v", "", "x"), (3, "w", "<article>" + "<p>A sentence of a long page, which goes on.</p>" * 20_000 + "</article>", "x")]
    got = sorted((tuple(r) for r in main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), model).collect()), key=str)
    assert len(got) == 5 and got[0][:3] == got[1][:3] == (1, "u", "The text of a page, in one sentence.")
    assert all(r[3] == len(r[2]) for r in got) and ("A sentence of a long page, which goes on.\n\n" * 20_000).strip() == next(r[2] for r in got if r[0] == 3)
    assert main_text.extract(spark.createDataFrame([], "page_id long, url string, html string"), main_text.learn(spark.createDataFrame([], "html string"))).count() == 0
