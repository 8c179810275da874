"""Text functions of the pipeline as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a keyword keeps, what a token is, and marks of boilerplate.
KEPT = r"[^0-9a-z가-힣]+"
#: The same signs as ranges, and those but for the blank: Java goes through a negated class several times slower.
DROPPED, DROPPED_IN_LINE = (rf"[{low}:-`{{-\x{{abff}}\x{{d7a4}}-\x{{10ffff}}]+" for low in (r"\x00-/", r"\x00-\x1f!-/"))
TOKEN = r"[가-힣A-Za-z0-9]{2,}"
HANGUL = r"[가-힣]{2,}"


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def normalise_keyword(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), DROPPED, "")


def slot_id(keyword: Column) -> Column:
    return F.concat(F.lit("slot_"), F.coalesce(F.nullif(F.substring(normalise_keyword(keyword), 1, 48), F.lit("")), F.lit("unknown")))


def group_id(sequence: Column) -> Column:
    return F.format_string("trendgrp_%06d", sequence)


def tokens(text: Column, pattern: str = TOKEN) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def valid_token(token: Column) -> Column:
    """Two characters at least, with a Hangul syllable or two Latin letters."""
    return (F.length(token) >= 2) & (token.rlike("[가-힣]") | token.rlike("[A-Za-z].*[A-Za-z]"))


def sentences(text: Column) -> Column:
    """Sentences of a text: cut behind . ! ? (and their wide forms) before white space; none is empty."""
    parts = F.split(F.trim(F.coalesce(text, F.lit(""))), r"(?<=[.!?。！？])\s+")
    # Not F.trim itself: transform gives a function of two arguments the index too, which trim takes for signs to strip.
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != "")


def strip_tags(html: Column) -> Column:
    plain = F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]+>", "")
    return F.trim(F.replace(F.replace(plain, F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&")))


def pipe_list(text: Column) -> Column:
    """Parts of a text between bars; null and empty give an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\|"), lambda x: x != "")


def jaccard(a: Column, b: Column) -> Column:
    """Shared share of two arrays of distinct items; 0 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def weighted_cell(cell: Column) -> Column:
    """Names of a cell like `a(0.51), b(0.3)`."""
    names = F.transform(F.split(F.coalesce(cell, F.lit("")), ","), lambda x: F.trim(F.regexp_replace(x, r"\([^)]*\)", "")))
    return F.filter(names, lambda x: x != "")


def list_item(line: Column) -> Column:
    """A line without its list number or bullet."""
    return F.trim(F.regexp_replace(F.coalesce(line, F.lit("")), r"^\s*(?:[-*•]|\d+[.)])\s*", ""))


def name_and_reason(line: Column) -> Column:
    """struct<name, reason> of `name - reason`; no reason without the dash."""
    parts = F.split(list_item(line), r"\s+-\s+", 2)
    return F.struct(F.trim(parts[0]).alias("name"), F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")).alias("reason"))


def fill(template: str, values: dict[str, Column]) -> Column:
    """A template with {{x}} and {x} replaced by columns."""
    out = F.lit(template)
    for name, value in values.items():
        shown = F.coalesce(value.cast("string"), F.lit(""))
        out = F.replace(F.replace(out, F.lit("{{" + name + "}}"), shown), F.lit("{" + name + "}"), shown)
    return out


def json_part(text: Column) -> Column:
    """The JSON inside a reply: a fenced block, or from the first to the last brace or bracket; null if it can't be read."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1)
    body = F.when(fenced != "", fenced).otherwise(text)
    found = F.regexp_extract(body, r"(?s)(\{.*\}|\[.*\])", 1)
    return F.when(F.try_parse_json(found).isNotNull(), found)


def page_url(url: Column, page: Column) -> Column:
    """The url of another page: a page parameter or a /page/N part is rewritten, or else a page parameter is added."""
    number = page.cast("string")
    parameter = r"([?&](?:page|p|pg|pageNo|pageNum)=)\d+"
    by_parameter = F.regexp_replace(url, F.lit(parameter), F.concat(F.lit("$1"), number))
    by_path = F.regexp_replace(url, F.lit(r"/page/\d+"), F.concat(F.lit("/page/"), number))
    added = F.concat(url, F.when(F.contains(url, F.lit("?")), "&page=").otherwise("?page="), number)
    return F.when(url.rlike(parameter), by_parameter).when(url.rlike(r"/page/\d+"), by_path).otherwise(added)


def normalise_noun(text: Column) -> Column:
    """A noun without signs."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[^0-9A-Za-z가-힣]+", "")


def product_line(line: Column) -> Column:
    """struct<name, reason> of a line that names a product and why, or of a bullet `name: reason`; null for other lines."""
    pattern = r"추천\s*상품군\s*\d+\s*:\s*(.+?)\s*/\s*선정\s*이유\s*:\s*(.+)"
    plain = F.trim(F.regexp_replace(line, "^[- ]+|[- ]+$", ""))
    parts = F.split(plain, ":", 2)
    named = F.struct(F.trim(F.regexp_extract(line, pattern, 1)).alias("name"), F.trim(F.regexp_extract(line, pattern, 2)).alias("reason"))
    bullet = F.struct(F.trim(F.element_at(parts, 1)).alias("name"), F.trim(F.try_element_at(parts, F.lit(2))).alias("reason"))
    return F.when(line.rlike(pattern), named).when(F.contains(line, F.lit(":")), bullet)


def label_of(words: Column, is_action: Callable[[Column], Column]) -> Column:
    """An entity and an action, the first of each; or the first two of the kind that there is."""
    entities, actions = F.filter(words, lambda w: ~is_action(w)), F.filter(words, is_action)
    both = (F.size(entities) > 0) & (F.size(actions) > 0)
    one = F.when(F.size(entities) > 0, F.slice(entities, 1, 2)).otherwise(F.slice(actions, 1, 2))
    return F.array_join(F.when(both, F.array(F.try_element_at(entities, F.lit(1)), F.try_element_at(actions, F.lit(1)))).otherwise(one), " ")


def context_sentence(*parts: str) -> Column:
    """Parts that aren't empty, with blanks between them."""
    return F.trim(F.array_join(F.filter(F.array(*parts), lambda p: p != ""), " "))


def word_list(lines: DataFrame) -> DataFrame:
    """(word) of a text table with a word a line; lines that start with # and empty ones are left out."""
    word = F.trim("value")
    return lines.select(word.alias("word")).where("word <> '' AND NOT startswith(word, '#')").distinct()
