"""ISO weeks as text labels (2016-W01), their days and their distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_week(day: Column) -> Column:
    """Label of the ISO week that holds a day; labels sort by time."""
    return F.format_string("%04d-W%02d", F.extract(F.lit("YEAROFWEEK"), day), F.weekofyear(day))


def week_year(label: Column) -> Column:
    return F.regexp_extract(label, r"^(\d{4})-W(\d{2})", 1).try_cast("int")


def week_number(label: Column) -> Column:
    return F.regexp_extract(label, r"^(\d{4})-W(\d{2})", 2).try_cast("int")


def monday(label: Column) -> Column:
    """First day of a week: the Monday of the week of 4 January, and 7 days for each week after."""
    first = F.date_trunc("week", F.make_date(week_year(label), F.lit(1), F.lit(4))).cast("date")
    return F.date_add(first, (week_number(label) - 1) * 7)


def sunday(label: Column) -> Column:
    return F.date_add(monday(label), 6)


def days_of(label: Column) -> Column:
    """The seven days of a week as YYYYMMDD."""
    return F.transform(F.sequence(monday(label), sunday(label)), lambda d: F.date_format(d, "yyyyMMdd"))


def weeks_between(start: Column, end: Column) -> Column:
    """Labels of all weeks from the week of one day to that of another."""
    first = F.date_trunc("week", start).cast("date")
    return F.transform(F.sequence(first, end.cast("date"), F.expr("interval 7 days")), iso_week)


def gap_weeks(a: Column, b: Column) -> Column:
    """Whole weeks between two labels."""
    return F.floor(F.abs(F.datediff(monday(a), monday(b))) / 7).cast("int")


def coerce_date(text: Column) -> Column:
    """A day from a number or text of eight digits, or else from an ISO date; null if neither."""
    plain = F.regexp_replace(text.cast("string"), r"\.0$", "")
    digits = F.when(plain.rlike(r"^\d{8}$"), F.try_to_timestamp(plain, F.lit("yyyyMMdd")))
    return F.coalesce(digits, plain.try_cast("timestamp")).cast("date")


def date_digits(text: Column) -> Column:
    """The first eight digits of a text, or an empty text if there are fewer."""
    digits = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"\D", "")
    return F.when(F.length(digits) >= 8, F.substring(digits, 1, 8)).otherwise("")


def date_chunks(start: Column, end: Column, days: int) -> Column:
    """array<struct<start, end>> of consecutive ranges of at most so many days."""
    heads = F.sequence(start, end, F.expr(f"interval {days} days"))
    return F.transform(heads, lambda d: F.struct(d.cast("date").alias("start"), F.least(F.date_add(d, days - 1), end).alias("end")))


def in_weeks(week: Column, start: str | None, end: str | None) -> Column:
    """Two-sided, one-sided or open range of labels."""
    out = F.lit(True)
    if start:
        out = out & (week >= start)
    if end:
        out = out & (week <= end)
    return out


def recent(day: Column, as_of: Column, least: int = 0, most: int = 28) -> Column:
    """Whether a day lies `least` to `most` days before another."""
    return F.datediff(as_of, day).between(least, most)


def file_range(name: Column) -> Column:
    """struct<low, high> of the days in a file name, YYYYMMDD-YYYYMMDD or one day; nulls where it has none."""
    first = F.nullif(F.regexp_extract(name, r"(\d{8})", 1), F.lit(""))
    last = F.coalesce(F.nullif(F.regexp_extract(name, r"\d{8}-(\d{8})", 1), F.lit("")), first)
    return F.struct(F.least(first, last).alias("low"), F.greatest(first, last).alias("high"))
