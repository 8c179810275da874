"""Which of many words each text contains, by an index of the words' rarest parts.

A text that contains a word contains each of its parts of Q characters. Every word is filed under one such part, that which
the fewest texts of a sample hold (shorter words under themselves); texts ask the index for the parts that they have, an
equi-join; and the words that answer are looked for in the text itself. So the work is that of the texts' characters and of
the candidates, not of all pairs, whatever the number of words. The sample only chooses parts; the answer is exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.operators.similar import few
from weekloom.session import stored

#: Characters of a part, and about how many texts are looked at to choose parts.
Q, SAMPLE = 4, 2000


def with_parts(df: DataFrame, text: str, lengths: list[int]) -> DataFrame:
    """df with a row for each part of these lengths of its text, as `part`."""
    rows = df.withColumn("_signs", F.filter(F.split(text, ""), lambda c: c != ""))
    cut = lambda q: F.when(F.size("_signs") >= q, F.transform(F.sequence(F.lit(0), F.size("_signs") - q), lambda i: F.concat(*(F.get("_signs", i + j) for j in range(q))))).otherwise(F.array().cast("array<string>"))
    return rows.withColumn("part", F.explode(F.array_distinct(F.concat(*map(cut, lengths))))).drop("_signs")


def contained(texts: DataFrame, words: DataFrame, q: int = Q, sample: int = SAMPLE) -> DataFrame:
    """(id, word) for every text that contains a word. texts: id, text; words: word. Null texts and empty words give none.

    Ids are distinct; texts are joined by them once, words are broadcast only after a count.
    """
    texts = texts.select("id", "text").where("text <> ''")
    words = stored(words.select("word").where("word <> ''").distinct().withColumn("_q", F.least(F.length("word"), F.lit(q))), "words")
    lengths = sorted(r["_q"] for r in words.select("_q").distinct().collect())  # q of them at most
    if not lengths:
        return texts.select("id", F.col("text").alias("word")).limit(0)
    ours = stored(reduce(DataFrame.unionByName, (with_parts(words.where(F.col("_q") == n), "word", [n]) for n in lengths)).select("word", "part"), "parts")
    n = texts.count()
    drawn = texts.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(min(1.0, sample / max(1, n)) * (1 << 20)) + 1)
    seen = with_parts(drawn, "text", lengths).join(few(ours.select("part").distinct()), "part").groupBy("part").agg(F.count("*").alias("held"))
    rarest = F.min_by("part", F.struct(F.coalesce("held", F.lit(0)), "part")).alias("part")
    index = stored(ours.join(seen, "part", "left").groupBy("word").agg(rarest), "index")
    asked = with_parts(texts, "text", lengths).select("id", "part")
    near = asked.join(few(index), "part").select("id", "word")
    return near.join(texts, "id").where(F.contains("text", F.col("word"))).select("id", "word")
