"""Repeated records and links of HTML pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Records(HTMLParser):
    """Text and first link of every element that a selector (tag, .class, tag.class or #id) names."""

    def __init__(self, selector: str):
        super().__init__(convert_charrefs=True)
        head, _, self.cls = selector.partition(".")
        self.tag, _, self.id = head.partition("#")
        self.open: list[list] = []
        self.depth = 0
        self.found: list[tuple[str, str]] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        have = dict(attrs)
        if tag not in VOID:
            self.depth += 1
        if (not self.tag or tag == self.tag) and (not self.cls or self.cls in (have.get("class") or "").split()) and (not self.id or have.get("id") == self.id):
            self.open.append([self.depth, [], ""])
        if tag == "a":
            for record in self.open:
                record[2] = record[2] or have.get("href") or ""

    def handle_data(self, data: str) -> None:
        for record in self.open:
            record[1].append(data)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        while self.open and self.open[-1][0] >= self.depth:
            _, parts, href = self.open.pop()
            self.found.append((" ".join("".join(parts).split()), href))
        self.depth = max(0, self.depth - 1)


def records(pages: DataFrame, selector: str, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, nr, title, url) of the records of each page, in the order in which they end; empty ones are left out."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page, html in zip(batch[id_col], batch[html_col], strict=True):
                parser = _Records(selector)
                parser.feed(html or "")
                parser.close()
                rows += [(page, nr, title, url) for nr, (title, url) in enumerate(x for x in parser.found if x[0])]
            yield pd.DataFrame(rows, columns=[id_col, "nr", "title", "url"])

    return pages.select(id_col, html_col).mapInPandas(parse, f"{id_col} long, nr int, title string, url string")


def links(html: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit('href="([^"]+)"'), F.lit(1))


def link_pattern(url: Column) -> Column:
    """A url with digits and long hexadecimal runs as stars."""
    return F.regexp_replace(F.regexp_replace(url, "[0-9a-f]{8,}", "*"), "[0-9]+", "*")


def distinct_items(items: DataFrame, key: str = "url", order: tuple[str, ...] = ()) -> DataFrame:
    """Items with one row for each url, the first by `order` (by all columns if none is given); items without url all stay."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*(order or items.columns)))
    first = items.where(F.col(key).isNotNull()).withColumn("_nth", nth).where("_nth = 1").drop("_nth")
    return first.unionByName(items.where(F.col(key).isNull()))


#: Tags whose text a summary keeps, how deep it looks, and how much of a text it shows.
SHOWN, DEEPEST, LONGEST = frozenset(("h1", "h2", "h3", "p", "a", "li", "td", "th", "button", "label")), 12, 200


class _Summary(HTMLParser):
    """A line for each shown element: its tag and its own text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list[str]]] = []
        self.lines: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in VOID:
            self.open.append((tag, []))

    def handle_data(self, data: str) -> None:
        if self.open:
            self.open[-1][1].append(data)

    def handle_endtag(self, tag: str) -> None:
        while any(t == tag for t, _ in self.open):
            name, parts = self.open.pop()
            text = " ".join("".join(parts).split())
            if name in SHOWN and text and len(self.open) < DEEPEST:
                self.lines.append(f"{name}: {text[:LONGEST]}")
            if name == tag:
                break


def summaries(pages: DataFrame, most: int = 4000) -> DataFrame:
    """(page_id, n_lines, summary): what a page shows, a line an element, in so many characters at most."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page, html in zip(batch["page_id"], batch["html"], strict=True):
                parser = _Summary()
                parser.feed(html or "")
                parser.close()
                rows.append((page, len(parser.lines), "\n".join(parser.lines)[:most]))
            yield pd.DataFrame(rows, columns=["page_id", "n_lines", "summary"])

    return pages.select("page_id", "html").mapInPandas(parse, "page_id long, n_lines long, summary string")


ITEM = "struct<title: string, source_url: string, selector: string, raw_snippet: string>"


def checked_items(body: Column) -> Column:
    """struct<ok, items> of a scraped result: items only if it has a list of them, each with four texts that aren't empty."""
    found = F.from_json(body, f"items array<{ITEM}>")["items"]
    clean = F.transform(found, lambda i: F.struct(*(F.trim(i[c]).alias(c) for c in ("title", "source_url", "selector", "raw_snippet"))))
    whole = F.forall(clean, lambda i: (F.coalesce(i["title"], F.lit("")) != "") & (F.coalesce(i["source_url"], F.lit("")) != "") & (F.coalesce(i["selector"], F.lit("")) != "") & (F.coalesce(i["raw_snippet"], F.lit("")) != ""))
    ok = F.coalesce(F.get_json_object(body, "$.items").rlike(r"^\[") & whole, F.lit(False))
    return F.struct(ok.alias("ok"), F.when(ok, clean).alias("items"))
