"""Enrichment steps: prompts as columns, an injected language model, and parsed rows. No step can stop another."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions import text

Llm = Callable[[str], str]


def mock_llm(prompt: str) -> str:
    """A deterministic reply: a list of three items named by the prompt's digest."""
    mark = hashlib.sha256(prompt.encode()).hexdigest()
    return "\n".join(f"{k + 1}. item-{mark[4 * k : 4 * k + 4]} - because {mark[20 + k : 24 + k]}" for k in range(3))


def replies(df: DataFrame, prompt: Column, llm: Llm = mock_llm, name: str = "reply") -> DataFrame:
    """df with the model's reply to each prompt; a call that fails leaves null."""

    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(p: str) -> str | None:
            try:
                return llm(p)
            except Exception:  # noqa: BLE001
                return None

        for batch in batches:
            yield batch.map(one)

    return df.withColumn(name, F.pandas_udf(ask, "string")(prompt))


def ranked_items(df: DataFrame, reply: str, keep: int) -> DataFrame:
    """A row for each of the first items of a reply: rank, name, reason."""
    lines = F.filter(F.split(F.coalesce(F.col(reply), F.lit("")), "\n"), lambda x: F.trim(x) != "")
    items = df.select(*(c for c in df.columns if c != reply), F.posexplode(F.slice(lines, 1, keep)).alias("_nr", "_line"))
    parsed = items.withColumn("_item", text.name_and_reason(F.col("_line")))
    return parsed.select(*(c for c in df.columns if c != reply), (F.col("_nr") + 1).alias("rank"), F.col("_item.name").alias("name"), F.col("_item.reason").alias("reason")).where("name <> ''")


def token_bucket(events: DataFrame, key: str, ts: str, capacity: float, per_second: float) -> DataFrame:
    """Whether each event of a key finds a token: tokens refill with time up to the capacity.

    Events are sorted by key and time and go by as a stream; a task holds one batch and the bucket of one key.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, left, last = None, capacity, None
        for batch in batches:
            allowed = []
            for name, at in zip(batch[key], batch[ts], strict=True):
                if name != own:
                    own, left, last = name, capacity, None
                left = min(capacity, left + ((at - last).total_seconds() * per_second if last is not None else 0))
                last = at
                allowed.append(left >= 1)
                left -= left >= 1
            yield batch[["event_id", key]].assign(allowed=allowed)

    kind = events.schema[key].dataType.simpleString()
    rows = events.select("event_id", key, F.col(ts).cast("timestamp").alias(ts)).where(F.col(key).isNotNull())
    return rows.repartition(key).sortWithinPartitions(key, ts, "event_id").mapInPandas(run, f"event_id long, {key} {kind}, allowed boolean")
