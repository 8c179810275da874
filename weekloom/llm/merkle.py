"""Operator 13: a Merkle manifest of a dataset, its proofs, and what they say of tampered rows.

Every row is a leaf, a hash of its fields. Leaves of a source are numbered by doc_id: rows are range-partitioned by
source, doc_id and leaf, numbered where they lie, and the counts of the partitions give each its first number, so no
source, however large, is sorted in one task. Superblock reduction: the numbers of a source's nodes are cut into buckets
of fanout^k, each bucket is collapsed by k levels in applyInPandas, and the roots of the buckets are the nodes of the
next round, until every source has one; then the roots of the sources are reduced likewise to the root of all. Proofs go
down again: the proof of a node is what its bucket knows of the k levels below the bucket's root, followed by the proof
of that root from the round above. Small buckets share a lot, so that many small sources are few groups; a lot has about
LOT nodes.

A null field counts as `-`. Rows with a null doc_id come first in their source. Rows that agree in all five fields are
leaves of their own; they have one hash, so it doesn't matter which of them comes first. Rows of one id with different
fields are ordered by their hashes. The null source comes before all others, also before the empty one. A source of one
row has that leaf as its root, and a table of one source has that source's root. Columns other than the five are not
read, whatever their names. An empty table has no root and gives no rows. Texts are hashed where they are read; only
hashes, ids and sources travel.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekloom.llm import common

FANOUT, LEVELS, LOT = 16, 2, 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NODE = "key string, idx long"


def field(value: Column) -> Column:
    value = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(text: Column, docs: DataFrame) -> Column:
    """The hash of a row with this text."""
    return F.sha2(F.concat(*(field(docs[f"`{c}`"]) for c in FIELDS[:-1]), field(text)), 256)


def leaves(docs: DataFrame, tampered: Column | None = None, tamper: Column | None = None) -> DataFrame:
    """key (of the source, in the order of sources), doc_id, h (the leaf) and t (the leaf of a tampered row, else null).

    tampered: where a row is tampered with; tamper: its text then.
    """
    own = docs["`text`"].cast("string")
    other = F.when(tampered, leaf(tamper, docs)) if tampered is not None else F.lit(None).cast("string")
    source = docs["`source`"].cast("string")
    key = F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source))
    return docs.select(key.alias("key"), docs["`doc_id`"].cast("long").alias("doc_id"), leaf(own, docs).alias("h"), other.alias("t"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with idx, their number within their key by the order; the number of a row among equals is any."""
    tie = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = ["key", *order, "_tie"]
    laid = tie.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    laid = common.stored(laid, "numbered").withColumn("_part", F.shiftright("_at", 33))
    counts = laid.groupBy("key", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("key", "_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return laid.join(starts, ["key", "_part"]).withColumn("idx", F.col("_before") + F.col("_at") - F.col("_first")).drop("_part", "_at", "_first", "_before")


def digest(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def collapsed(hashes: list[str], bucket: int, fanout: int = FANOUT, levels: int = LEVELS) -> list[list[str]]:
    """The levels of a bucket from its nodes to its root.

    A first bucket that isn't full is all that its key has, so it stops at one node. Every other one goes up by `levels`.
    """
    out = [hashes]
    whole = bucket == 0 and len(hashes) < fanout**levels
    while len(out[-1]) > 1 if whole else len(out) <= levels:
        out.append([digest(out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def path(levels: list[list[str]], at: int, fanout: int = FANOUT) -> tuple[list[str], list[str]]:
    """What stands to the left and to the right of a node and its ancestors in their runs, a text for each level."""
    left, right = [], []
    for row in levels[:-1]:
        start = at - at % fanout
        left.append("".join(row[start:at]))
        right.append("".join(row[at + 1 : start + fanout]))
        at //= fanout
    return left, right


def buckets(lot: pd.DataFrame) -> Iterator[tuple[str, int, pd.DataFrame]]:
    """The buckets of a lot, with their nodes in order."""
    if len(lot):
        for (key, bucket), rows in lot.sort_values("idx", kind="stable").groupby(["key", "bucket"], sort=False):
            yield key, int(bucket), rows


class Manifest:
    """The nodes of every round, written to the shared folder; rounds[0] are the rows, the last has one node for each key."""

    def __init__(self, nodes: DataFrame, fanout: int = FANOUT, levels: int = LEVELS):
        """nodes: key, idx, h, and what else a row carries."""
        self.fanout, self.levels = fanout, levels
        self.rounds = [common.stored(nodes, "leaves")]
        while self.rounds[-1].where("idx > 0").limit(1).count():
            self.rounds.append(common.stored(self._roots(self.rounds[-1]), "roots"))

    def lots(self, nodes: DataFrame) -> int:
        return max(1, -(-nodes.count() // LOT))

    def dealt(self, nodes: DataFrame, lots: int, bucket: Column) -> DataFrame:
        return nodes.withColumn("bucket", bucket).withColumn("lot", F.pmod(F.xxhash64("key", "bucket"), F.lit(lots)))

    def _roots(self, nodes: DataFrame) -> DataFrame:
        fanout, levels = self.fanout, self.levels

        def collapse(lot: pd.DataFrame) -> pd.DataFrame:
            rows = [(key, bucket, collapsed(rows["h"].tolist(), bucket, fanout, levels)[-1][0]) for key, bucket, rows in buckets(lot)]
            return pd.DataFrame(rows, columns=["key", "idx", "h"])

        cut = self.dealt(nodes.select("key", "idx", "h"), self.lots(nodes), F.floor(F.col("idx") / fanout**levels))
        return cut.groupBy("lot").applyInPandas(collapse, f"{NODE}, h string")

    def roots(self) -> DataFrame:
        """key and h of the one node that each key ends with."""
        return self.rounds[-1].select("key", "h")

    def _below(self, nodes: DataFrame, above: DataFrame, make, schema: str) -> DataFrame:
        """make(row, left, right, own) for every node: its path to the top, and the row of `above` that its bucket has."""
        fanout, levels, lots = self.fanout, self.levels, self.lots(nodes)

        def descend(lot: pd.DataFrame, tops: pd.DataFrame) -> pd.DataFrame:
            known = {(r.key, r.bucket): r for r in tops.itertuples(index=False)}
            out = []
            for key, bucket, rows in buckets(lot):
                own = known[key, bucket]
                up = list(own.before), list(own.after)
                tree = collapsed(rows["h"].tolist(), bucket, fanout, levels)
                for at, row in enumerate(rows.itertuples(index=False)):
                    left, right = path(tree, at, fanout)
                    out.append(make(row, left + up[0], right + up[1], own))
            return pd.DataFrame(out, columns=[c.strip().split(" ")[0] for c in schema.split(",")])

        down = self.dealt(nodes, lots, F.floor(F.col("idx") / fanout**levels)).groupBy("lot")
        tops = self.dealt(above, lots, F.col("idx")).groupBy("lot")
        return down.cogroup(tops).applyInPandas(descend, schema)

    def paths(self, above: DataFrame, make=None, schema: str = "") -> DataFrame:
        """The paths of all rows to the top: key, idx, h, before, after, top; or what make() says of each row.

        above: key, idx = 0, before, after, top: the paths of the keys' roots, and what they belong to.
        """
        for nodes in reversed(self.rounds[1:-1]):
            above = common.stored(self._below(nodes, above, _step, STEP), "paths")
        return self._below(self.rounds[0], above, make or _step, schema or STEP)


ABOVE = "before array<string>, after array<string>, top string"
STEP = f"{NODE}, h string, {ABOVE}"


def _step(row, left: list[str], right: list[str], own) -> tuple:
    return row.key, row.idx, row.h, left, right, own.top


def fold(h: str, left: list[str], right: list[str]) -> str:
    """The root that a node with this hash and these siblings leads to."""
    for before, after in zip(left, right, strict=True):
        h = digest([before, h, after])
    return h


def forest(rows: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> tuple[Manifest, Manifest, str | None]:
    """The manifest of the sources' rows, that of the sources, and the root (null for an empty table). rows: as from leaves()."""
    # Stored first: dealing by range looks at the rows twice, and texts are to be hashed once.
    trees = Manifest(numbered(common.stored(rows, "hashes"), ["doc_id", "h"]), fanout, levels)
    tops = trees.roots().select(F.lit("").alias("key"), F.col("key").alias("source"), "h")
    whole = Manifest(numbered(tops, ["source"]), fanout, levels)
    root = whole.roots().first()
    return trees, whole, root["h"] if root else None


def proofs(rows: DataFrame, say=None, schema: str = "", fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """A row for each leaf: key, idx, h, the siblings before and after it and its ancestors, and top, its source's root.

    say(root)(row, left, right, own): what to return of each leaf instead, as rows of `schema`.
    """
    trees, whole, root = forest(rows, fanout, levels)
    above = rows.sparkSession.createDataFrame([("", 0, [], [], root)] if root else [], f"{NODE}, {ABOVE}")

    def of_source(row, left: list[str], right: list[str], own) -> tuple:
        return row.source, 0, left, right, row.h

    sources = common.stored(whole.paths(above, of_source, f"{NODE}, {ABOVE}"), "sources")
    return trees.paths(sources, say(root) if say else None, schema)


def checked(rows: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. rows: as from leaves(), with t where tampered.

    The root is folded anew from the tampered leaf, or the leaf, and the siblings as they were; verified: it is the root.
    """

    def say(root: str):
        def check(row, left: list[str], right: list[str], own) -> tuple:
            folded = fold(row.t if isinstance(row.t, str) else row.h, left, right)
            return row.doc_id, row.h, own.top, root, digest([x for both in zip(left, right, strict=True) for x in both]), folded, folded == root

        return check

    return proofs(rows, say, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean", fanout, levels)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's leaf, roots and proof, and what a proof says where texts of a fifth of the ids are lower-cased."""
    docs = common.table(spark, sf_dir, "documents")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return checked(leaves(docs, hit, F.translate(F.col("text").cast("string"), UPPER, LOWER)))


def _sql(rounds: int = 5, source_rounds: int = 3) -> str:
    """The same in SQL for sources of up to 16^rounds rows and up to 16^source_rounds sources."""
    crc_byte = "list_reduce([xor(a, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda c, d: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END)"
    crc = f"xor(list_reduce([4294967295]::UBIGINT[] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT), lambda a, b: {crc_byte}), 4294967295::UBIGINT)"
    part = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"
    head = " || ".join(part(c) for c in FIELDS[:-1])
    steps = [
        f"rows AS (SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS key, sha256({head} || {part('text')}) AS h, CASE WHEN {crc} % 5 = 0 THEN sha256({head} || {part('low')}) END AS t FROM (SELECT *, translate(text, '{UPPER}', '{LOWER}') AS low FROM documents))",
        "d0 AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, h) - 1 AS idx FROM rows)",
    ]

    def climb(name: str, k: int) -> None:
        run = f"PARTITION BY key, idx // {FANOUT} ORDER BY idx ROWS BETWEEN"
        side = lambda a, b: f"CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER ({run} {a} AND {b}), '') ELSE '' END"
        steps.append(f"{name}{k}s AS (SELECT *, {side('UNBOUNDED PRECEDING', '1 PRECEDING')} AS l, {side('1 FOLLOWING', 'UNBOUNDED FOLLOWING')} AS r FROM (SELECT *, count(*) OVER (PARTITION BY key) AS n FROM {name}{k}))")
        steps.append(f"{name}{k + 1} AS (SELECT key, idx // {FANOUT} AS idx, CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY idx)) ELSE max(h) END AS h FROM {name}{k}s GROUP BY key, idx // {FANOUT})")

    for k in range(rounds):
        climb("d", k)
    steps.append(f"s0 AS (SELECT '' AS key, key AS source, h, row_number() OVER (ORDER BY key) - 1 AS idx FROM d{rounds})")
    for k in range(source_rounds):
        climb("s", k)
    now = "SELECT a.doc_id, a.h AS leaf, coalesce(a.t, a.h) AS f0, '' AS p0, a.idx AS i0, a.key AS source, sub.h AS subroot, sub.idx AS j0, top.h AS root FROM d0s a JOIN s0s sub ON sub.source = a.key, s%d top" % source_rounds
    nth = 0
    for name, many, key, at in (("d", rounds, "x.source", "i"), ("s", source_rounds, "''", "j")):
        for k in range(many):
            now = f"SELECT x.*, CASE WHEN y.n > 1 THEN sha256(y.l || x.f{nth} || y.r) ELSE x.f{nth} END AS f{nth + 1}, x.p{nth} || y.l || y.r AS p{nth + 1}, x.{at}{k} // {FANOUT} AS {at}{k + 1} FROM ({now}) x JOIN {name}{k}s y ON y.key = {key} AND y.idx = x.{at}{k}"
            nth += 1
    return f"WITH {', '.join(steps)} SELECT doc_id, leaf, subroot, root, sha256(p{nth}) AS proof_sha256, f{nth} AS folded_root, f{nth} = root AS verified FROM ({now})"


SQL = _sql()
