"""Operator 10: mixing sources to target weights by soft membership.

A table classifier learns how often each of some character n-grams occurs in the rows of each label (its domain), for a
byte of text, and gives every document a posterior over the domains. The n-grams are learnt too: those of a bounded,
documented sample of labelled rows (LEARN_ROWS) that tell most about each domain. How far evidence counts is set on a
fold that the table has not seen. Rates, one for each document and never below `least`, are then fitted by
projected-gradient least squares: the expected tokens of each domain, summed over documents as rate * tokens *
posterior, are to meet the target weights. A step needs a few numbers for each pair of domains, summed by Spark; it is scaled by
their matrix, which is a damped Newton method on one multiplier for each domain, and rates are the projection of it. First
steps run over a table of posteriors rounded to three places and their tokens, aggregated once; the last ones over all
documents with their exact posteriors, until the shares of these are met. The shares that were reached come with the
rates, and a warning names the domains whose targets no rates can meet.

All of it is DataFrame expressions. A null or empty text has no tokens and the prior as posterior. Labels that are null
teach nothing; without labels every rate is 1. Any number of labels may occur; the work grows with it. Of domains that
are equally likely, the first in the alphabet is named. A null doc_id is never learnt from. Repeated rows are separate
documents with equal rates. Columns other than doc_id, text and the label are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekloom.llm import common

#: Rows that n-grams are learnt from, at most, about, and rows of each domain (if there are); n-grams in all and of each domain.
LEARN_ROWS, ROWS_EACH, GRAMS, GRAMS_EACH = 4000, 100, 20, 2
#: The fold that sets how far evidence counts: evidence is divided by T * size^G for one of these T and G.
CALIBRATION_FOLD, SOFTNESS = 1, [(t, g) for g in (0.0, 0.5) for t in (0.25, 0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)]
#: Up to so many domains, a step sums columns; for more it sums the pairs of domains that a document has as rows.
COLUMNS = 24
#: Most steps, the miss relative to a target share that counts as met, the share below which targets count as this
#: share for that, the pull of rates toward a centre (1 at first), and how often the centre moves.
STEPS, NEAR, TINY, PULL, ROUNDS = 100, 1e-3, 1e-6, 1e-8, 6


def _plain(text: Column) -> Column:
    """A text as n-grams are looked for in it: lower case, blanks for line ends and at both ends."""
    return F.concat(F.lit(" "), F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("\n"), F.lit(" ")), F.lit(" "))


def learn_grams(rows: DataFrame, counts: dict[str, int], most: int = LEARN_ROWS, each: int = ROWS_EACH) -> list[str]:
    """N-grams of one to three letters within words and their edges: of each domain those that tell most about it.

    A word is what stands between blanks or line ends, however long; a text without blanks is cut like one word.

    rows: doc_id, text, domain. An n-gram belongs to the domain where it is most frequent for a byte of text; it tells
    the sum over domains of frequency * log(frequency / mean frequency). Words are counted before they are cut, so a
    text's length matters only there.
    """
    share = min(1.0, most / max(1, sum(counts.values())))
    wanted = F.create_map(*(F.lit(x) for d, n in counts.items() for x in (d, int(min(1.0, max(share, each / n)) * (1 << 31)))))
    sample = rows.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(1 << 31)) < F.element_at(wanted, F.col("domain")))
    sizes = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.sum(F.octet_length("text")).cast("double").alias("n")).collect()}
    words = sample.select("domain", F.explode(F.split(F.lower("text"), "[ \n]")).alias("word")).groupBy("domain", "word").agg(F.count("*").alias("n"))
    bare = words.groupBy("domain", F.regexp_replace("word", "[.,;:!?]$", "").alias("word")).agg(F.sum("n").alias("n")).where("word <> ''")
    # Characters as an array: a substring is found by counting from the start, which is slow in a text without blanks.
    padded = bare.select("domain", "n", F.split(F.concat(F.lit(" "), "word", F.lit(" ")), "").alias("signs")).withColumn("signs", F.filter("signs", lambda c: c != ""))
    cut = lambda k: F.transform(F.sequence(F.lit(0), F.size("signs") - k), lambda i: F.concat(*(F.get("signs", i + j) for j in range(k))))
    grams = padded.select("domain", "n", F.explode(F.concat(cut(1), cut(2), cut(3))).alias("gram")).groupBy("domain", "gram").agg(F.sum("n").alias("n"))
    grams = grams.where(F.rlike("gram", F.lit(r"^ ?\p{L}+ ?$")))
    size = F.create_map(*(F.lit(x) for d, n in sizes.items() for x in (d, float(max(n or 0, 1)))))
    rated = grams.withColumn("rate", F.col("n") / F.element_at(size, F.col("domain"))) if sizes else grams.withColumn("rate", F.lit(0.0))
    told = rated.groupBy("gram").agg(F.sum("rate").alias("s"), F.sum(F.col("rate") * F.log("rate")).alias("e"), F.max_by("domain", F.struct("rate", "domain")).alias("domain"))
    told = told.withColumn("told", F.round(F.col("e") - F.col("s") * F.log(F.col("s") / len(counts)), 15))
    nth = F.row_number().over(Window.partitionBy("domain").orderBy(F.desc("told"), "gram"))
    kept = told.withColumn("nth", nth).where(F.col("nth") <= max(GRAMS_EACH, -(-GRAMS // len(counts))))
    return sorted(r["gram"] for r in kept.select("gram").collect())


def with_grams(df: DataFrame, grams: list[str], text: str = "text") -> DataFrame:
    """df and `size`, the bytes of a text, and `grams`, how often each of the n-grams can be cut out of it.

    Each step is a column of its own, so that what several others use is computed once.
    """
    df = df.withColumn("_lower", _plain(F.col(text).cast("string"))).withColumn("_size", F.octet_length("_lower"))
    df = df.select("*", *(((F.col("_size") - F.octet_length(F.replace("_lower", F.lit(g), F.lit("")))) / len(g.encode())).alias(f"_c{k}") for k, g in enumerate(grams)))
    counts = F.array(*(F.col(f"_c{k}") for k in range(len(grams)))) if grams else F.array().cast("array<double>")
    return df.withColumn("grams", counts).withColumn("size", (F.col("_size") - 2).cast("double")).drop("_lower", "_size", *(f"_c{k}" for k in range(len(grams))))


def token_count(text: Column) -> Column:
    """Words of a text: its blanks and line ends, plus one; each of several blanks in a row counts."""
    whole = F.coalesce(text, F.lit(""))
    gaps = F.octet_length(whole) - F.octet_length(F.replace(F.replace(whole, F.lit(" "), F.lit("")), F.lit("\n"), F.lit("")))
    return F.when(F.length(whole) > 0, gaps + 1).otherwise(0).cast("long")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _doubles(values) -> Column:
    return F.expr(f"array({', '.join(f'{float(v)!r}D' for v in values)})")


def _tables(values) -> Column:
    return F.expr("array(" + ", ".join(f"array({', '.join(f'{float(v)!r}D' for v in row)})" for row in values) + ")")


def _soft(scores: Column) -> Column:
    """exp of each score, over their sum."""
    powers = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda s, y: s + y))


class Classifier:
    """How often n-grams occur in each domain for a byte of text, and how far such evidence counts.

    The evidence for a domain is that of Poisson counts: sum count * log(rate) - size * sum rate.
    """

    def __init__(self, grams: list[str], domains: list[str], prior: list[float], rates: list[list[float]], softness: tuple[float, float] = (1.0, 0.0)):
        self.grams, self.domains, self.prior, self.rates, self.softness = grams, domains, prior, rates, softness

    def evidence(self) -> Column:
        logs = _tables([[*(math.log(r) for r in rates), -sum(rates)] for rates in self.rates])
        return F.transform(logs, lambda row: _dot(F.concat(F.col("grams"), F.array("size")), row))

    def scores(self, evidence: Column, softness: tuple[float, float]) -> Column:
        scale = F.lit(softness[0]) * F.pow(F.greatest(F.col("size"), F.lit(1.0)), F.lit(softness[1]))
        return F.zip_with(evidence, _doubles(self.prior), lambda e, p: e / scale + p)

    def with_posterior(self, df: DataFrame) -> DataFrame:
        """df and `posterior`, an array<double> over the domains; df has `grams` and `size`."""
        df = df.withColumn("_scores", self.scores(self.evidence(), self.softness))
        df = df.withColumn("_powers", F.transform("_scores", lambda x: F.exp(x - F.array_max("_scores"))))
        df = df.withColumn("_whole", F.aggregate("_powers", F.lit(0.0), lambda s, x: s + x))
        return df.withColumn("posterior", F.transform("_powers", lambda x: x / F.col("_whole"))).drop("_scores", "_powers", "_whole")


def learn(rows: DataFrame, grams: list[str]) -> Classifier | None:
    """rows: doc_id, grams, size, domain. One aggregation, of a row or two for each domain, and one to set the softness."""
    rows = rows.where(F.col("domain").isNotNull()).withColumn("tested", common.fold("doc_id") == CALIBRATION_FOLD)
    sums = [F.sum(F.element_at("grams", k + 1)).alias(f"s{k}") for k in range(len(grams))]
    found = rows.groupBy("domain", "tested").agg(F.count("*").alias("n"), F.sum("size").alias("size"), *sums).collect()
    domains = sorted({r["domain"] for r in found})
    if not domains:
        return None

    def table(of: list) -> Classifier:
        mine = {d: [r for r in of if r["domain"] == d] for d in domains}
        n = {d: sum(r["n"] for r in mine[d]) + 0.5 for d in domains}
        rate = lambda d, k: (sum(r[f"s{k}"] for r in mine[d]) + 0.5) / (sum(r["size"] for r in mine[d]) + 1000.0)
        return Classifier(grams, domains, [math.log(n[d] / sum(n.values())) for d in domains], [[rate(d, k) for k in range(len(grams))] for d in domains])

    whole, part = table(found), table([r for r in found if not r["tested"]])
    if any(r["tested"] for r in found) and not all(r["tested"] for r in found):
        few = common.drawn(sum(r["n"] for r in found if r["tested"]), LEARN_ROWS, "doc_id")
        tested = rows.where(F.col("tested") & few).withColumn("evidence", part.evidence()).withColumn("y", F.array_position(F.array(*map(F.lit, domains)), F.col("domain")).cast("int"))

        def loss(softness: tuple[float, float]) -> Column:
            chance = F.element_at(_soft(part.scores(F.col("evidence"), softness)), F.col("y"))
            return F.avg(-F.log(F.greatest(chance, F.lit(1e-12))))

        losses = tested.agg(*(loss(s) for s in SOFTNESS)).first()
        whole.softness = SOFTNESS[int(np.argmin(losses))]
    return whole


class Rates:
    """The fitted rate as a function of a posterior, and the target and reached share of each domain."""

    def __init__(self, least: float, weights: list[float] | None = None):
        self.least, self.weights = least, weights or []
        self.targets: list[float] = []
        self.reached: list[float] = []

    def of(self, posterior: Column) -> Column:
        if not self.weights:
            return F.greatest(F.lit(1.0), F.lit(float(self.least)))
        return F.greatest(F.lit(float(self.least)), 1.0 + _dot(posterior, _doubles(self.weights)))

    def missed(self) -> list[int]:
        """Domains whose share is not near its target."""
        return [k for k, (d, t) in enumerate(zip(self.reached, self.targets, strict=True)) if abs(d - t) > NEAR * max(t, TINY)]


def fit(cells: DataFrame, targets: list[float], least: float, start: list[float] | None = None, rounds: int = ROUNDS) -> Rates:
    """Rates for the cells (posterior, tokens), with the shares of the domains that they give.

    Shares and targets are of all tokens at rate 1, so a sum of targets over 1 asks for more tokens than there are.
    The rates of least squares are the projection of 1 + posterior * weights onto rates >= least. The gradient by the
    weights is the miss of each domain (and the pull); a step is the gradient scaled by the Gram matrix of the domains
    over the cells that may still move, so small domains and overlapping ones move as fast as others. Steps end when
    every miss is small relative to its target. The pull is toward the rates at which its gradient was last nil; when
    that has moved `rounds` times and targets are still missed, no rates meet them, and these have the least squares.
    start: weights to begin with.
    """
    k = len(targets)
    rates = Rates(least)
    rates.targets, rates.reached = list(targets), [0.0] * k
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return rates
    wanted, small = np.array(targets), np.maximum(targets, TINY)

    def look(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """The convex function whose gradient is the miss, the shares, and the Gram matrix."""
        free = cells.select("posterior", (F.col("tokens") / F.lit(float(total))).alias("share"), _dot(F.col("posterior"), _doubles(weights)).alias("pull"))
        free = free.withColumn("moves", F.col("pull") + 1 >= least).withColumn("rate", F.greatest(F.lit(float(least)), F.col("pull") + 1))
        area = F.when(F.col("moves"), F.col("pull") + F.col("pull") * F.col("pull") / 2).otherwise(least * F.col("pull") - (least - 1) ** 2 / 2)
        value, shares, gram = 0.0, np.zeros(k), np.zeros((k, k))
        if k <= COLUMNS:
            p = [F.get("posterior", F.lit(i)) for i in range(k)]
            two = [(i, j) for i in range(k) for j in range(i, k)]
            sums = [F.col("share") * area, *(F.col("share") * F.col("rate") * x for x in p), *(F.when(F.col("moves"), F.col("share") * p[i] * p[j]).otherwise(0.0) for i, j in two)]
            got = list(free.agg(*(F.sum(x).alias(f"s{n}") for n, x in enumerate(sums))).first())
            value, shares = got[0], np.array(got[1 : k + 1])
            for (i, j), v in zip(two, got[k + 1 :], strict=True):
                gram[i, j] = gram[j, i] = v
            return value - wanted @ weights, shares, gram
        entry = lambda i, j, v: F.struct(i.alias("i"), j.alias("j"), v.alias("v"))
        none, p = F.lit(-1), F.col("posterior")
        of_one = F.transform(p, lambda x, j: entry(none, j, F.col("share") * F.col("rate") * x))
        of_two = F.flatten(F.transform(p, lambda x, i: F.transform(p, lambda y, j: entry(i, j, F.when(F.col("moves"), F.col("share") * x * y).otherwise(0.0)))))
        entries = F.concat(F.array(entry(none, none, F.col("share") * area)), of_one, F.filter(of_two, lambda e: e["v"] != 0))
        for i, j, v in free.select(F.inline(entries)).groupBy("i", "j").agg(F.sum("v")).collect():  # k * k + k + 1 rows at most
            if j < 0:
                value = v
            elif i < 0:
                shares[j] = v
            else:
                gram[i, j] = v
        return value - wanted @ weights, shares, (gram + gram.T) / 2

    weights = np.zeros(k) if start is None else np.array(start)
    centre = weights
    value, shares, gram = look(weights)
    for _ in range(STEPS):
        slope = shares - wanted + PULL * (weights - centre)
        if (np.abs(shares - wanted) <= NEAR / 2 * small).all():
            break
        if (np.abs(slope) <= NEAR / 10 * small).all():
            if not rounds:
                break
            rounds, centre = rounds - 1, weights
            slope = shares - wanted
        move = -np.linalg.solve(gram + PULL * np.eye(k), slope)
        held = value + PULL / 2 * np.square(weights - centre).sum()
        for half in range(30):
            there = weights + move / 2**half
            at = look(there)
            if at[0] + PULL / 2 * np.square(there - centre).sum() <= held + 1e-4 * slope @ move / 2**half or np.abs(at[1] - wanted + PULL * (there - centre)).max() < 0.9 * np.abs(slope).max():
                break
        weights, (value, shares, gram) = there, at
    rates.weights, rates.reached = weights.tolist(), shares.tolist()
    return rates


def weigh(docs: DataFrame, targets: dict[str, float] | None = None, least: float = 0.0, label: str = "lang", flat: float = 0.0, keep: bool = False) -> tuple[Classifier | None, Rates, DataFrame]:
    """Classifier, rates, and the stored table doc_id, tokens, posterior of docs; with `keep` also docs' columns c0, c1, ...

    targets: token share of each domain; by default each domain's share of the posterior tokens to the power `flat`
    (0: all alike), scaled to sum to 1, or, where `least` is 1, so that no domain has to shrink.
    """
    own = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)] if keep else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("string").alias("domain"), F.col("text").cast("string").alias("text"), *own)
    learnt_from = F.coalesce(common.fold("doc_id") != 0, F.lit(False)) & F.col("domain").isNotNull()
    counts = {r["domain"]: r["n"] for r in rows.where(learnt_from).groupBy("domain").agg(F.count("*").alias("n")).collect()}
    grams = learn_grams(rows.where(learnt_from & F.col("text").isNotNull()).select("doc_id", "text", "domain"), counts) if counts else []
    counted = common.stored(with_grams(rows.withColumn("tokens", token_count(F.col("text"))), grams).drop("text"), "grams")
    classifier = learn(counted.where(learnt_from), grams)
    names = ["doc_id", "tokens", "posterior", *(f"c{k}" for k in range(len(own)))]
    if classifier is None:
        return None, Rates(least), counted.withColumn("posterior", F.array().cast("array<double>")).select(names)
    rows = common.stored(classifier.with_posterior(counted).select(names), "posterior")
    cells = common.stored(rows.groupBy(F.transform("posterior", lambda p: F.round(p, 3)).alias("posterior")).agg(F.sum("tokens").alias("tokens")), "cells")
    k = len(classifier.domains)
    if targets is None:
        sums = np.zeros(k)
        for j, v in rows.select("tokens", F.posexplode("posterior").alias("j", "p")).groupBy("j").agg(F.sum(F.col("tokens") * F.col("p"))).collect():
            sums[j] = v or 0.0
        shares = (sums / (sums.sum() or 1.0)).tolist()
        raised = [s**flat if s else 0.0 for s in shares]
        scale = sum(raised) or 1.0
        wanted = [r / scale for r in raised]
        if least >= 1:
            up = max((s / w for s, w in zip(shares, wanted, strict=True) if w), default=1.0)
            wanted = [w * up * least for w in wanted]
    else:
        wanted = [targets.get(d, 0.0) for d in classifier.domains]
    rates = fit(rows.select("posterior", "tokens"), wanted, least, fit(cells, wanted, least).weights or None, 1)
    if missed := rates.missed():
        says = ", ".join(f"{classifier.domains[j]} {rates.reached[j]:.4g} of {wanted[j]:.4g}" for j in missed)
        warnings.warn(f"mixing: no rates of at least {least} meet these target shares: {says}", stacklevel=2)
    return classifier, rates, rows


def copies(rate: Column, key: Column) -> Column:
    """How often a document is taken: its rate, rounded up or down by a hash of the key so that rates hold on average."""
    chance = F.pmod(F.xxhash64(key, F.lit(10)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + F.when(chance < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, targets: dict[str, float] | None = None, least: float = 0.0, label: str = "lang", flat: float = 0.0) -> DataFrame:
    """docs, each row as often as its rate says."""
    classifier, rates, rows = weigh(docs, targets, least, label, flat, keep=True)
    if classifier is None:
        return docs
    place = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    key = F.coalesce(F.col("doc_id").cast("string"), F.col(place["text"]).cast("string"), F.lit(""))
    rated = rows.withColumn("_rate", rates.of(F.col("posterior")))
    # An outer explode: the filter that an inner one implies would be pushed below and repeat the whole expression.
    taken = rated.withColumn("_copy", F.explode_outer(F.array_repeat(F.lit(1), copies(F.col("_rate"), key)))).where("_copy IS NOT NULL")
    return taken.select(*(F.col(new).alias(old) for old, new in place.items()))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, tokens, domain (the likeliest), posterior (its chance), rate and copies: all domains to equal tokens."""
    classifier, rates, rows = weigh(common.table(spark, sf_dir, "documents"))
    if classifier is None:
        return rows.select("doc_id", "tokens", F.lit(None).cast("string").alias("domain"), F.lit(0.0).alias("posterior"), F.lit(1.0).alias("rate"), F.lit(1).alias("copies"))
    best = F.array_max("posterior")
    domain = F.element_at(F.array(*(F.lit(d) for d in classifier.domains)), F.array_position("posterior", best).cast("int"))
    rated = rows.withColumns({"domain": domain, "best": best, "rate": rates.of(F.col("posterior"))})
    return rated.select("doc_id", "tokens", "domain", F.col("best").alias("posterior"), "rate", copies(F.col("rate"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("copies"))
