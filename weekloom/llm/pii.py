"""Operator 1: personal data, by fixed patterns and by a character-level bidirectional LSTM with CRF transitions.

The patterns give the base spans. The model learns from labelled spans: base spans in a bounded, documented sample of
documents (TRAIN_DOCS), and the same contexts with personal data written in other ways (blanks around the sign of an
address, numbers without the country's sign, other separators), against numbers and codes that are no personal data.
It adds spans that no pattern allows; base spans stay, and an added span never touches one. Each added span holds a
digit, an `@` or an `(at)`, so stretches of text without one within reach need no decoding. Stretches end with the words
that they touch; they are cut into overlapping windows, decoded and reconciled over the whole stretch. A text of any
length is decoded whole, with ten bytes for each character of its longest stretch.

A null text is an empty text and has no spans. Rows are independent: repeated rows give repeated results, a null doc_id
is returned as it is. Columns other than doc_id and text are not read. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import common, tagger

KINDS = ("email", "ip", "card", "phone")
#: Documents whose spans the model learns from, at most, about; pieces drawn from each; windows and steps of its training.
TRAIN_DOCS, PIECES, TRAIN_WINDOWS, STEPS = 6000, 3, 6000, 500
#: Characters around a digit or `@` that are decoded with it, and those of a piece on each side.
REACH, AROUND = 48, 160

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NEAR = re.compile(r"[0-9@]|[(\[] ?at ?[)\]]")
_DIGITS = frozenset("0123456789")
Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, leftmost and without overlap within a kind; matches that fail a test are dropped."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c in _DIGITS for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text within REACH of a digit, `@` or `(at)`, to the ends of the words there; no added span can lie
    elsewhere."""
    out: list[list[int]] = []
    for m in _NEAR.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
            continue
        while a > (out[-1][1] if out else 0) and not text[a - 1].isspace():
            a -= 1
        out.append([a, b])
    for k, (_, b) in enumerate(out):
        end = out[k + 1][0] if k + 1 < len(out) else len(text)
        while b < end and not text[b].isspace():
            b += 1
        out[k][1] = b
    return [(a, b) for a, b in out]


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def fits(kind: int, found: str) -> bool:
    """Whether an added span could be what it is taken for. Digits are those of ASCII."""
    digits = "".join(c for c in found if c in _DIGITS)
    if kind == 0:
        return bool(re.fullmatch(r"[\w.%+-]+ ?(?:@|[(\[] ?at ?[)\]]) ?[\w-]+(?: ?(?:\.|[(\[] ?dot ?[)\]]) ?[\w-]+)+", found))
    if kind == 1:
        return bool(re.fullmatch(r"[0-9]{1,3}(?: ?[.,:] ?[0-9]{1,3}){3}", found)) and all(int(x) <= 255 for x in re.findall("[0-9]+", found))
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15 and len(digits) < len(found)


def added_spans(model: tagger.Tagger, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
    """Spans that the model finds beside the base spans of each text."""
    where = [(k, a, b) for k, text in enumerate(texts) for a, b in stretches(text)]
    tags = tagger.decode(model, [tagger.classes(points_of(texts[k][a:b])) for k, a, b in where])
    out: list[list[Span]] = [[] for _ in texts]
    for (k, a, _), t in zip(where, tags, strict=True):
        i = 0
        while i < len(t):
            if t[i] and t[i] % 2:
                kind, j = int(t[i] - 1) // 2, i + 1
                while j < len(t) and t[j] == 2 * kind + 2:
                    j += 1
                found = texts[k][a + i : a + j]
                start, end = a + i + len(found) - len(found.lstrip()), a + j - len(found) + len(found.rstrip())
                if fits(kind, texts[k][start:end]) and all(end <= s or start >= e for s, _, e in base[k]):
                    out[k].append((start, kind, end))
                i = j
            else:
                i += 1
    return out


def _variant(kind: int, r: np.random.Generator) -> tuple[str, bool]:
    """Text of a made-up item, and whether it is personal data."""
    d = lambda n: "".join(str(x) for x in r.integers(0, 10, n))
    name = "".join(chr(97 + x) for x in r.integers(0, 26, r.integers(3, 9)))
    host = "".join(chr(97 + x) for x in r.integers(0, 26, r.integers(3, 8)))
    if kind == 0:
        return [f"{name}{d(2)}@{host}.com", f"{name} @ {host}.com", f"{name}@{host} . org", f"{name}.{host}@mail.{host}.net", f"{name} (at) {host}.com", f"{name}[at]{host}.org", f"{name} (at) {host} (dot) com", f"{name}.{host} @ mail.{host}.net"][r.integers(8)], True
    if kind == 1:
        return ".,"[int(r.random() < 0.2)].join(str(x) for x in r.integers(0, 256, 4)), True
    if kind == 2:
        n = d(15)
        n += next(c for c in "0123456789" if luhn(n + c))
        return ["", " ", "-", ".", "/"][k := int(r.integers(5))].join([n] if k == 0 else [n[i : i + 4] for i in range(0, 16, 4)]), True
    if kind == 3:
        a, b, c = d(3), d(3), d(4)
        return [f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{d(2)} {a} {b} {c}", f"{a} {b} {c}"][r.integers(6)], True
    return [d(int(r.integers(1, 8))), f"{d(4)}-{d(2)}-{d(2)}", f"{d(1)}.{d(1)}", f'token = "{d(4)}{name}{d(6)}"', f"{d(2)}.{d(2)}.{d(4)}", f"{d(1)},{d(3)}", f"{d(2)}:{d(2)}", f"@{name}", d(int(r.integers(20, 30)))][r.integers(9)], False


def windows(texts: list[str], most: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Classes and tags (rows, WINDOW): base spans as they stand, and made-up items in the same contexts."""
    r = np.random.default_rng(seed)
    contexts = [t for t in texts if len(t) > 20] or ["and so it was said that", "der die das und nicht mit"]
    x, y = [], []

    def add(text: str, spans: list[Span], a: int) -> None:
        part = text[a : a + tagger.WINDOW]
        cls, tag = np.zeros(tagger.WINDOW, np.int16), np.zeros(tagger.WINDOW, np.int8)
        cls[: len(part)] = tagger.classes(points_of(part))
        for s, kind, e in spans:
            if s < a + len(part) and e > a:
                tag[max(s - a, 0) : e - a] = 2 * kind + 2
                if s >= a:
                    tag[s - a] = 2 * kind + 1
        x.append(cls)
        y.append(tag)

    real = [(text, a, b) for text in texts for a, b in stretches(text)]
    for k in r.permutation(len(real))[: most // 2]:
        text, a, b = real[k]
        add(text, base_spans(text), max(0, int(r.integers(a - 30, max(a - 29, b - 24)))))
    while len(x) < most:
        context = contexts[r.integers(len(contexts))]
        at = int(r.integers(0, max(1, len(context) - 10)))
        before, after = context[max(0, at - 60) : at], context[at : at + 60]
        kind = int(r.integers(0, 6))
        item, personal = _variant(kind, r)
        text = f"{before.rstrip('0123456789@.+-')} {item}{' ' if r.random() < 0.8 else '. '}{after.lstrip('0123456789@.+-')}"
        start = len(text[: text.index(item, max(0, len(before.rstrip('0123456789@.+-'))))])
        spans = [(start, kind, start + len(item))] if personal else []
        spans += [s for s in base_spans(text) if all(s[2] <= a or s[0] >= b for a, _, b in spans)]
        add(text, spans, max(0, start - int(r.integers(5, 40))))
    return np.stack(x), np.stack(y)


def drawn_pieces(text: str, many: int = PIECES) -> list[str]:
    """Parts of a text around some of its digits and `@`, drawn from all of it; or any part where it has none."""
    r = np.random.default_rng(zlib.crc32(text.encode("utf-8", "replace")))
    found = [m.start() for m in _NEAR.finditer(text)]
    at = sorted(r.choice(found, min(many, len(found)), replace=False)) if found else [int(r.integers(0, len(text) + 1))]
    return [text[max(0, int(k) - AROUND) : int(k) + AROUND] for k in at]


def train(docs: DataFrame, most: int = TRAIN_DOCS) -> tagger.Tagger:
    """The model, fitted on the spans in PIECES parts of each of about `most` documents, drawn from whole texts."""
    common.small_batches(docs.sparkSession)

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [p for text in common.text_of(batch.column("text")) for p in drawn_pieces(text)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string())], names=["part"])

    n = docs.agg(F.count("*")).first()[0]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = rows.where(common.drawn(n, most, "doc_id", "text")).select("text").mapInArrow(around, "part string")
    got = common.bounded(parts, PIECES * most).toPandas()
    model = tagger.Tagger(1 + 2 * len(KINDS))
    model.fit(*windows(sorted(got["part"]), TRAIN_WINDOWS), steps=STEPS)
    return model


def text_spans(model: tagger.Tagger, texts: list[str]) -> tuple[list[list[Span]], list[list[Span]]]:
    base = [base_spans(t) for t in texts]
    more = added_spans(model, texts, base)
    return base, [sorted(b + m) for b, m in zip(base, more, strict=True)]


def find(docs: DataFrame, model: tagger.Tagger) -> DataFrame:
    """doc_id, base and spans: arrays of (start, kind, end) in code points."""
    spark = docs.sparkSession
    common.small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # a few thousand weights
    kind = pa.list_(pa.list_(pa.int64()))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, texts = candidates(batch)
            base, every = [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
            for k, b, e in zip(near, *text_spans(shared.value, texts), strict=True):
                base[k], every[k] = b, e
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, kind), pa.array(every, kind)], names=["doc_id", "base", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(spans, "doc_id long, base array<array<long>>, spans array<array<long>>")


def candidates(batch: pa.RecordBatch) -> tuple[list[int], list[str]]:
    """Rows of a batch whose text has a digit, `@` or a bracket, and those texts. No other text can have a span."""
    raw, at = common.bytes_of(batch.column("text"))
    hits = np.concatenate([[0], np.cumsum((raw == 64) | ((raw >= 48) & (raw <= 57)) | (raw == 40) | (raw == 91))])
    near = np.flatnonzero(hits[at[1:]] > hits[at[:-1]]).tolist()
    data = raw.tobytes()
    return near, [data[at[k] : at[k + 1]].decode() for k in near]


def redact(docs: DataFrame, model: tagger.Tagger | None = None) -> DataFrame:
    """docs with every span of its texts replaced by its kind in brackets, and n_chars (if there) set to the new length."""
    spark = docs.sparkSession
    common.small_batches(spark)
    shared = spark.sparkContext.broadcast(model or train(docs))
    place = docs.columns.index("text")

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, texts = candidates(batch)
            column = batch.column(place).to_pylist()
            for k, text, spans in zip(near, texts, text_spans(shared.value, texts)[1], strict=True):
                parts, last = [], 0
                for start, kind, end in spans:
                    if start >= last:
                        parts += [text[last:start], f"[{KINDS[kind].upper()}]"]
                    last = max(last, end)
                column[k] = "".join([*parts, text[last:]])
            columns = list(batch.columns)
            columns[place] = pa.array(column, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    out = docs.withColumn("text", F.col("text").cast("string")).mapInArrow(cleaned, docs.withColumn("text", F.col("text").cast("string")).schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = find(docs, train(docs))
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), (s[1] + 1).cast("int")), s[0].cast("string"), s[2].cast("string"))), ",")
    counts = [_count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(named(F.col("base")), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))


def _count(kind: int):
    return F.size(F.filter("base", lambda s: s[1] == kind)).cast("long")
