"""Stage 6: which keywords a week follows, and whether they emerge, stay active or fade.

A week selects its top keywords (A) and those carried over from the week before (B). Once the weekly rank is known, a
keyword's states depend on its own past alone, so keywords are processed apart: one small ordered group for each.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Anchors of a week, thresholds of the rules, weeks of fading before a keyword is dropped.
TOP_N, EMERGING_Z, ACTIVE_RATIO, FADING_Z, FADING_RATIO, SUNSET = 5, 2.0, 0.7, 0.8, 0.4, 2
ACTIONS = {"Emerging": "create_slot", "Active": "update_slot", "Fading": "close_slot_archive"}
SCHEMA = "week string, keyword string, week_idx int, anchor string, status string, action string, is_major boolean, z_score double, count int, prev_count int, count_ratio double, delta_z double, delta_count int, fading_streak int, carried boolean"


def classify(z: float, count: int, prev_count: int, prev_status: str | None, seen: bool) -> tuple[str, float]:
    """Status and count ratio of a keyword in a week, by the first rule that holds."""
    ratio = count / prev_count if prev_count > 0 else float(count > 0)
    if z >= EMERGING_Z and not seen:
        return "Emerging", ratio
    if z <= FADING_Z and ratio <= FADING_RATIO:
        return "Fading", ratio
    if ratio >= ACTIVE_RATIO or (prev_status in ("Emerging", "Active") and count > 0):
        return "Active", ratio
    return "Fading", ratio


def ranked(z: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """z with each keyword's place within its week."""
    z = z if excluded is None else z.join(excluded.select("keyword"), "keyword", "left_anti")
    return z.withColumn("place", F.row_number().over(Window.partitionBy("week").orderBy(F.desc("z_score"), "keyword")))


def lifecycle(z: DataFrame, freq: DataFrame, weeks: DataFrame, excluded: DataFrame | None = None, top_n: int = TOP_N, sunset: int = SUNSET) -> DataFrame:
    """A row for each week in which a keyword is followed. weeks: (week, week_idx)."""
    placed = ranked(z, excluded)
    ever = placed.where(F.col("place") <= top_n).select("keyword").distinct()
    rows = placed.join(ever, "keyword", "left_semi").join(freq, ["week", "keyword"], "left").join(F.broadcast(weeks.select("week", "week_idx")), "week")
    rows = rows.select("keyword", "week", "week_idx", "z_score", F.coalesce("count", F.lit(0)).alias("n"), (F.col("place") <= top_n).alias("anchored"))

    def follow(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        seen, carried, status, streak = False, False, None, 0
        last_idx, last_count, last_z = None, 0, 0.0
        for r in group.sort_values("week_idx").itertuples():
            prev_count, prev_z = (last_count, last_z) if last_idx == r.week_idx - 1 else (0, 0.0)
            carried = carried and last_idx == r.week_idx - 1
            if r.anchored or carried:
                anchor = "+".join(n for n, on in (("A", r.anchored), ("B", carried)) if on)
                status, ratio = classify(r.z_score, r.n, prev_count, status, seen)
                streak = streak + 1 if status == "Fading" else 0
                carried = not (sunset > 0 and streak >= sunset)
                seen = True
                out.append((r.week, r.keyword, r.week_idx, anchor, status, ACTIONS[status], status != "Fading", r.z_score, r.n, prev_count, ratio, r.z_score - prev_z, r.n - prev_count, streak, carried))
            last_idx, last_count, last_z = r.week_idx, r.n, r.z_score
        return pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return rows.groupBy("keyword").applyInPandas(follow, SCHEMA)
