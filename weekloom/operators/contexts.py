"""Stage 1: words of articles, what stands around them, and weighted sentences."""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions import text
from weekloom.session import stored
from weekloom.sources.tables import spread

#: Words on each side, contexts and neighbours kept, sentence weights.
SIDE, TOP_CONTEXTS, TOP_NEIGHBOURS, TITLE_WEIGHT, DECAY, FLOOR = 2, 3, 5, 3.0, 0.8, 0.2
#: Occurrences that a task counts at a time, those in a bucket of keywords and weeks, about, and the fewest buckets.
IN_BLOCK, IN_BUCKET, LEAST_BUCKETS = 4_000_000, 5_000_000, 32
#: Words that blocks name by number alone, and the articles, and signs of each, that these are taken from.
KNOWN, KNOWN_ARTICLES, KNOWN_SIGNS = 65_536, 4_000, 16_384
_ZSTD = pa.Codec("zstd")


def _words(articles: DataFrame) -> DataFrame:
    return articles.select("week", "news_id", "press", F.filter(F.split("body", r"\s+"), lambda w: w != "").alias("words"))


def _valid(rows: DataFrame, stopwords: list[str]) -> DataFrame:
    rows = rows.where(text.valid_token(F.col("keyword")))
    return rows.where(~F.col("keyword").isin(list(stopwords))) if stopwords else rows


def _keys(words: Column) -> Column:
    """The normalised form of each word of an array, by one pass over them all: a filter on it can't repeat that work."""
    whole = F.regexp_replace(F.lower(F.array_join(words, " ")), text.DROPPED_IN_LINE, "")
    return F.split(whole, " ")


def tokens(articles: DataFrame, stopwords: list[str] = ()) -> DataFrame:
    """(week, news_id, press, keyword): each valid word."""
    return _valid(_words(articles).select("week", "news_id", "press", F.explode(_keys(F.col("words"))).alias("keyword")), stopwords)


def weekly_keywords(rows: DataFrame) -> DataFrame:
    return rows.groupBy("week", "keyword", F.coalesce(F.nullif("press", F.lit("")), F.lit("unknown")).alias("source")).agg(F.count("*").cast("int").alias("count"))


def buckets_of(articles: DataFrame) -> int:
    """How many buckets of about IN_BUCKET words the words of articles make."""
    size = articles.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    return max(LEAST_BUCKETS, math.ceil(size / 6 / IN_BUCKET))


def _keyed(columns: list[np.ndarray], size: int) -> list[np.ndarray]:
    """Columns of numbers below `size` as fewer columns in the same order, each of as many of them as 62 bits hold."""
    keys, room = [], 0
    for column in columns:
        if room >= size:
            keys[-1], room = keys[-1] * size + column, room // size
        else:
            keys, room = [*keys, column.astype(np.int64)], 2**62 // size
    return keys


def _counted(keys: list[np.ndarray], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of distinct rows, in the order of their keys, and the sum of n over the rows that equal each."""
    order = np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= np.diff(key[order]) != 0
    starts = np.flatnonzero(new)
    return order[starts], np.add.reduceat(n[order], starts, dtype=np.int64) if len(starts) else n[:0]


def _runs(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return np.flatnonzero(new)


def _checksums(texts: pa.Array) -> np.ndarray:
    """A 64-bit number of each text (null as the empty one), the same in every task: its bytes in powers of an odd number."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]] if len(texts) else np.zeros(0, np.uint8)
    size = np.diff(ends)
    powers = np.multiply.accumulate(np.full(size.max(initial=0) + 1, 0x9E3779B97F4A7C15, np.uint64))
    place = np.arange(len(data)) - np.repeat(ends[:-1] - ends[0], size)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * powers[place])])
    mixed = sums[ends[1:] - ends[0]] - sums[ends[:-1] - ends[0]]
    return mixed ^ mixed >> np.uint64(32)


def _buckets(weeks: pa.Array, names: pa.Array, buckets: int) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """What gives the checksum, of 32 bits, of a week's and a keyword's number, and the bucket that comes from it."""
    week_marks, name_marks = _checksums(weeks), _checksums(names)

    def find(week: np.ndarray, keyword: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mark = (week_marks[week] * np.uint64(0x9E3779B97F4A7C15) + name_marks[keyword] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)
        return mark.astype(np.int64), mark.astype(np.int64) % buckets

    return find


def _occurrences(batch: pa.RecordBatch, stopwords: list[str]) -> tuple[list[np.ndarray], pa.Array, pa.Array, pa.Array]:
    """Valid words of some articles (week, body): week, keyword, two words before and two after, and the article; and the
    texts that these numbers stand for: weeks, keywords and words.

    The last word is the empty text, which stands where a text begins or ends. Words are numbered, so each distinct one is
    normalised once.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(batch.column("body"), ""))
    parts, article = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    some = pc.not_equal(parts, "")
    flat, article = parts.filter(some).dictionary_encode(), article[some.to_numpy(zero_copy_only=False)]
    words, code = flat.dictionary, flat.indices.to_numpy()
    keys = pc.replace_substring_regex(pc.utf8_lower(words), "[^0-9a-z가-힣]+", "")
    valid = pc.and_(pc.greater_equal(pc.utf8_length(keys), 2), pc.match_substring_regex(keys, "[가-힣]|[A-Za-z].*[A-Za-z]"))
    valid = pc.and_not(valid, pc.is_in(keys, pa.array(list(stopwords), keys.type)))
    keys = keys.dictionary_encode()
    names, weeks = keys.dictionary, batch.column("week").dictionary_encode(null_encoding="encode")

    def beside(k: int) -> np.ndarray:
        out, low, high = np.full(len(code), len(words), np.int32), slice(0, max(0, len(code) - abs(k))), slice(abs(k), None)
        here, there = (high, low) if k < 0 else (low, high)
        out[here] = np.where(article[here] == article[there], code[there], len(words))
        return out

    kept = valid.to_numpy(zero_copy_only=False)[code]
    columns = [c[kept] for c in (weeks.indices.to_numpy()[article], keys.indices.to_numpy()[code], *map(beside, (-2, -1, 1, 2)), article)]
    return columns, weeks.dictionary, names, pa.concat_arrays([words, pa.array([""], words.type)])


def _numbered(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, which are below `size`, and the place of each value among them; sorted only where they are few."""
    if 8 * values.size < size:
        named, number = np.unique(values, return_inverse=True)
        return named, number.reshape(values.shape)
    there = np.zeros(size, bool)
    there[values] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[values]


def known_words(articles: DataFrame) -> pa.Array:
    """The empty text and frequent words of some articles: blocks name them by number, without their texts.

    This is a table of codes alone: a word that it lacks is sent as text, and no result depends on it.
    """
    some = articles.select(F.substring("body", 1, KNOWN_SIGNS).alias("body")).where("body <> ''").take(KNOWN_ARTICLES)
    counts = pc.value_counts(pc.list_flatten(pc.ascii_split_whitespace(pa.array([r.body for r in some], pa.string()))))
    order = np.argsort(-counts.field("counts").to_numpy(), kind="stable")[:KNOWN]
    words = counts.field("values").take(pa.array(order))
    return pa.concat_arrays([pa.array([""]), words.filter(pc.not_equal(words, ""))])


def _referred(known: pa.Array, *texts: pa.Array) -> tuple[list[np.ndarray], pa.Array]:
    """Numbers of some texts, and those that aren't known, in order: a text's number is its place in `known`, or behind these among the others."""
    places = [pc.fill_null(pc.index_in(t, known.cast(t.type)), -1).to_numpy() for t in texts]
    others = pc.unique(pa.concat_arrays([t.filter(pa.array(p < 0)) for t, p in zip(texts, places, strict=True)]))
    others = others.take(pc.sort_indices(others))
    return [np.where(p < 0, len(known) + pc.fill_null(pc.index_in(t, others), 0).to_numpy(), p) for t, p in zip(texts, places, strict=True)], others


def _grouped(columns: list[np.ndarray], weeks: pa.Array, keywords: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Weeks and keywords of occurrences, distinct and ordered by bucket; their buckets; and the place of each occurrence's among them."""
    names = len(keywords)
    groups, own = _numbered(columns[0] * np.int64(names) + columns[1], len(weeks) * names)
    bucket = _buckets(weeks, keywords, buckets)(groups // names, groups % names)[1]
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return groups[order] // names, groups[order] % names, bucket[order], place[own]


def _steps(values: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Ascending numbers as what each has beyond the one before, in runs of these lengths."""
    steps, starts = np.diff(values, prepend=0), (np.cumsum(runs) - runs)[runs > 0]
    steps[starts] = values[starts]
    return steps


def _climbed(steps: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """The numbers that _steps was given."""
    sums, runs = np.cumsum(steps, dtype=np.int64), runs[runs > 0]
    starts = np.cumsum(runs) - runs
    return sums - np.repeat(sums[starts] - steps[starts], runs)


def _squeezed(numbers: np.ndarray) -> tuple[int, list[bytes]]:
    """Numbers of 32 bits, compressed: their lowest bytes, the next ones, and so on, each by themselves, as they differ in kind."""
    whole = numbers.astype("<u4").view(np.uint8).reshape(-1, 4)
    return len(whole), [_ZSTD.compress(np.ascontiguousarray(place), asbytes=True) if place.any() else b"" for place in whole.T]


def _unsqueezed(n: int, places: list[bytes]) -> np.ndarray:
    whole = np.zeros((n, 4), np.uint8)
    for k, place in enumerate(places):
        if place:
            whole[:, k] = np.frombuffer(_ZSTD.decompress(place, n, asbytes=True), np.uint8)
    return whole.view("<i4").reshape(-1)


def _image(known: int, others: pa.Array, few: dict[str, tuple[pa.Array, np.ndarray]], named: dict[str, np.ndarray], runs: np.ndarray, **numbers: np.ndarray) -> bytes:
    """A compressed block of columns: few have texts of their own, named ones hold numbers of _referred, others are numbers.

    Of the texts that aren't known, those that are named are sent, each once and in order. The column "beside" ascends
    within runs of these lengths.
    """
    flat = np.concatenate(list(named.values()))
    rare = np.flatnonzero(flat >= known)
    some, number = _numbered(flat[rare] - known, len(others))
    flat[rare] = number + known
    named = dict(zip(named, np.split(flat, np.cumsum([len(c) for c in named.values()])[:-1]), strict=True))
    named["beside"] = _steps(named["beside"], runs)
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), others.take(pa.array(some))), "\n")[0].as_py().encode()
    lists = {}
    for k, (whose, number) in few.items():
        own, numbers[k] = np.unique(number, return_inverse=True)
        lists[k] = whose.take(pa.array(own)).to_pylist()
    columns = {k: _squeezed(c) for k, c in ({"runs": runs} | named | numbers).items()}
    return pickle.dumps((len(some), len(texts), _ZSTD.compress(texts, asbytes=True), lists, list(named), columns))


def _opened(images: pa.ChunkedArray, known: pa.Array) -> tuple[list[dict[str, np.ndarray]], pa.Array]:
    """Columns of some blocks, and the texts that they name, distinct and in order (null last)."""
    blocks, owns = [pickle.loads(b.as_buffer()) for b in images], []
    for some, size, texts, lists, *_ in blocks:
        texts = pc.split_pattern(pa.array([_ZSTD.decompress(texts, size, asbytes=True).decode()]), "\n").flatten() if some else pa.array([], pa.string())
        owns.append(pa.concat_arrays([texts, *(pa.array(own, pa.string()) for own in lists.values())]).cast(pa.large_string()))
    coded = pa.concat_arrays([known.cast(pa.large_string()), *owns]).dictionary_encode(null_encoding="encode")
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    number, low, opened = place[coded.indices.to_numpy()], len(known), []
    for some, _, _, lists, named, columns in blocks:
        columns = {k: _unsqueezed(*c) for k, c in columns.items()}
        columns["beside"] = _climbed(columns["beside"], columns["runs"])
        own = np.concatenate([number[: len(known)], number[low : low + some]])
        columns |= {k: own[columns[k]] for k in named}
        low += some
        for k, whose in lists.items():
            columns[k] = number[low:][columns[k]]
            low += len(whose)
        opened.append(columns)
    return opened, coded.dictionary.take(pa.array(order))


def _cut(bucket: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where the groups of each bucket begin and end."""
    starts = _runs(bucket)
    return zip(starts, np.append(starts, len(bucket))[1:], strict=True)


def _surroundings(batch: pa.RecordBatch, stopwords: list[str], buckets: int, known: pa.Array) -> Iterator[tuple[int, bytes]]:
    """Buckets and blocks of the surroundings of some articles' valid words, each once.

    A block has the week, the keyword and the number of surroundings of each group, then these: two words before and two
    after, and how often they occur. Where articles have a press, it has how often each press has the words of a group, too.
    """
    columns, weeks, names, words = _occurrences(batch, stopwords)
    (name, word), others = _referred(known, names, words)
    week, keyword, bucket, own = _grouped(columns, weeks, names, buckets)
    around = [word[c] for c in columns[2:6]]
    # Rows are ordered by one number: the group, the word before, and a hash of the other three. Should two differ and have
    # the same one, equal rows may lie apart and stay two, which are counted together where blocks are read.
    bits = (len(known) + len(others)).bit_length()
    left = 63 - bits - len(week).bit_length()
    mixed = sum(around[k].astype(np.uint64) * np.uint64(m) for k, m in ((0, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (3, 0x165667B19E3779F9)))
    order = np.argsort((own << bits | around[1]) << left | (mixed >> np.uint64(64 - left)).astype(np.int64))
    rows = [c[order] for c in (own, *around)]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in rows]) if len(order) else False
    first = np.flatnonzero(new)
    n, (group, *around) = np.diff(first, append=len(order)), [c[first] for c in rows]
    ends = np.searchsorted(group, np.arange(len(week) + 1))
    if pressed := "press" in batch.schema.names:
        press = batch.column("press").dictionary_encode()
        size = len(press.dictionary)
        of, count = np.unique(own * size + press.indices.to_numpy()[columns[6]], return_counts=True)
        press_ends = np.searchsorted(of, np.arange(len(week) + 1) * size)
    for start, end in _cut(bucket):
        some = slice(ends[start], ends[end])
        few, more = {"week": (weeks, week[start:end])}, {}
        if pressed:
            own = slice(press_ends[start], press_ends[end])
            few["press"] = (press.dictionary, of[own] % size)
            more = {"presses": np.diff(press_ends[start : end + 1]), "press_n": count[own]}
        named = {"keyword": name[keyword[start:end]]} | {k: c[some] for k, c in zip(("b2", "beside", "a1", "a2"), around, strict=True)}
        yield bucket[start], _image(len(known), others, few, named, np.diff(ends[start : end + 1]), n=n[some], **more)


def _pairs(batch: pa.RecordBatch, stopwords: list[str], buckets: int, known: pa.Array) -> Iterator[tuple[int, bytes]]:
    """Buckets and blocks of the words beside some articles' valid words: each with its side and its count, by keyword and week.

    An occurrence beside a word is one number, of the keyword and week, the side and the word, and these are sorted as they
    are. A block has, for each keyword and week, how many words stand before and how many after, then all of these words.
    """
    columns, weeks, names, words = _occurrences(batch, stopwords)
    (name, word), others = _referred(known, names, words)
    week, keyword, bucket, own = _grouped(columns, weeks, names, buckets)
    bits, none = (len(known) + len(others)).bit_length(), len(words) - 1
    own = own << bits + 1
    pairs = np.concatenate([((own | (c > 3) << bits) | word[columns[c]])[columns[c] != none] for c in (2, 3, 4, 5)])
    pairs.sort()
    first = _runs(pairs)
    n, pairs = np.diff(first, append=len(pairs)), pairs[first]
    beside, term = np.bincount(pairs >> bits, minlength=2 * len(week)), pairs & (1 << bits) - 1
    ends = np.concatenate([[0], np.cumsum(beside)])[::2]
    for start, end in _cut(bucket):
        some = slice(ends[start], ends[end])
        named = {"keyword": name[keyword[start:end]], "beside": term[some]}
        yield bucket[start], _image(len(known), others, {"week": (weeks, week[start:end])}, named, beside[2 * start : 2 * end], n=n[some])


def packed(articles: DataFrame, buckets: int, stopwords: list[str] = (), what: Callable[..., Iterator[tuple[int, bytes]]] = _surroundings, known: pa.Array | None = None) -> DataFrame:
    """(bucket, block): the surroundings of valid words by bucket of keywords and weeks, those of about IN_BLOCK words at a time.

    A surrounding is what stands up to two words before and after a valid word. An occurrence differs from nearly all
    others, so a hash map over them holds almost each and a row for each is most of the work. Blocks are numbers and the
    texts that these stand for, so no text is written for an occurrence. what: _surroundings or _pairs. Articles of few
    files are spread over the cores here, so that what else is asked of them needs no shuffle of their texts.
    """
    stopwords, known = list(stopwords), known_words(articles) if known is None else known

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nr = np.cumsum(pc.fill_null(pc.binary_length(batch.column("body")), 0).to_numpy().astype(np.int64)) // (6 * IN_BLOCK)
            cuts = [0, *(np.flatnonzero(np.diff(nr)) + 1), batch.num_rows]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if high > low:
                    blocks = list(what(batch.slice(low, high - low), stopwords, buckets, known))
                    yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in blocks], pa.int32()), pa.array([i for _, i in blocks], pa.binary())], names=["bucket", "block"])

    rows = articles.select("week", "body", *(c for c in articles.columns if c == "press")).where("body <> ''")
    return spread(rows).mapInArrow(pack, "bucket int, block binary")


def _gathered(articles: DataFrame, buckets: int | None, stopwords: list[str], what: Callable[..., Iterator[tuple[int, bytes]]], find: Callable[[list[dict[str, np.ndarray]], pa.Array], pa.Table], schema: str) -> DataFrame:
    """find() of the blocks of each bucket, equal rows of several ones not yet as one, and the texts. Their numbers are their places in order.

    The blocks are what is shuffled, once. Nothing is sorted row by row, and there are as many partitions as buckets,
    whatever number the session has: a task holds the blocks of few buckets, and has nothing to spill.
    """
    buckets, known = buckets or buckets_of(articles), known_words(articles)
    blocks = packed(articles, buckets, stopwords, what, known).repartition(buckets, "bucket")
    return blocks.groupBy("bucket").applyInArrow(lambda group: find(*_opened(group.column("block"), known)), schema)


def _added(numbers: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order, and the sum of n over the equal ones. Numbers alone are sorted; n beyond one is added then."""
    found = np.sort(numbers)
    first = _runs(found)
    sums, found, more = np.diff(first, append=len(found)), found[first], n > 1
    np.add.at(sums, np.searchsorted(found, numbers[more]), n[more] - 1)
    return found, sums


def _best(group: np.ndarray, n: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first rows of each group by descending n, equal ones as they come, and their rank. Groups ascend."""
    # Most occur once. Only the first of these can be among the best of their group, as they come last there.
    new, ones = np.diff(group, prepend=-1) != 0, np.cumsum(n == 1)
    nr = np.cumsum(new)
    before = (ones - (n == 1))[new]
    some = np.flatnonzero((n > 1) | (ones - before[nr - 1] <= keep))
    rows = some[np.argsort(nr[some] * (n.max(initial=0) + 1) - n[some], kind="stable")]
    at = np.arange(len(rows))
    new = np.diff(group[rows], prepend=-1) != 0
    rank = at - np.maximum.accumulate(np.where(new, at, 0)) + 1
    return rows[rank <= keep], rank[rank <= keep]


def _lists(values: pa.Array | dict[str, pa.Array], counts: np.ndarray) -> pa.Array:
    """An array of values or structs for each group, which has so many of them."""
    ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(list(values.values()), names=list(values)) if isinstance(values, dict) else values)


def _rows(blocks: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """The surroundings of some blocks: week, keyword, two words before and two after, and how often they occur."""
    rows = {c: np.concatenate([np.repeat(b[c], b["runs"]) for b in blocks]) for c in ("week", "keyword")}
    return rows | {c: np.concatenate([b[c] for b in blocks]) for c in ("b2", "beside", "a1", "a2", "n")}


def _taken(texts: pa.Array, numbers: np.ndarray) -> pa.Array:
    return texts.take(pa.array(numbers)).cast(pa.string())


def _top_contexts(rows: dict[str, np.ndarray], texts: pa.Array, keep: int) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the groups, which are a week's and a keyword's, in order; and the most frequent surroundings of each."""
    # Two words with a blank between come in the order of the first one and its blank, then of the second. No word
    # holds a blank, so a word alone, without it, has its place among these.
    ends = pa.concat_arrays([texts, pc.binary_join_element_wise(texts, pa.scalar(" ", texts.type), pa.scalar("", texts.type))])
    place = np.empty(len(ends), np.int64)
    place[pc.sort_indices(ends).to_numpy()] = np.arange(len(ends))
    week, keyword, b2, b1, a1, a2, n = rows.values()
    none = pc.index(texts, pa.scalar("", texts.type)).as_py()
    two = b2 != none
    before = [np.where(two, place[b2 + len(texts)], place[b1]), np.where(two, b1, none)]
    after = [np.where(a2 != none, place[a1 + len(texts)], place[a1]), a2]
    at, n = _counted(_keyed([week, keyword, *before, *after], len(ends)), n)
    own = week[at].astype(np.int64) * len(texts) + keyword[at]
    best, _ = _best(own, n, keep)
    at, n, own = at[best], n[best], own[best]
    join = lambda x, y: pc.binary_join_element_wise(_taken(texts, x[at]), pc.if_else(pa.array((x[at] != none) & (y[at] != none)), " ", ""), _taken(texts, y[at]), "")
    starts = _runs(own)
    found = {"before": join(b2, b1), "after": join(a1, a2), "occ_count": pa.array(n.astype(np.int32))}
    return own[starts], _lists(found, np.diff(starts, append=len(own)))


_CONTEXTS = "contexts array<struct<before: string, after: string, occ_count: int>>"


def context_lists(articles: DataFrame, keep: int = TOP_CONTEXTS, stopwords: list[str] = (), buckets: int | None = None) -> DataFrame:
    """(week, keyword, contexts): the most frequent surroundings of each word and week, equal ones in the order of their texts."""

    def find(blocks: list[dict[str, np.ndarray]], texts: pa.Array) -> pa.Table:
        groups, found = _top_contexts(_rows(blocks), texts, keep)
        return pa.table([_taken(texts, groups // len(texts)), _taken(texts, groups % len(texts)), found], names=["week", "keyword", "contexts"])

    return _gathered(articles.select("week", "body"), buckets, stopwords, _surroundings, find, f"week string, keyword string, {_CONTEXTS}")


def in_rows(lists: DataFrame) -> DataFrame:
    """Contexts of context_lists, a row each."""
    rows = lists.select("week", "keyword", F.posexplode("contexts").alias("rank", "c"))
    return rows.select("week", "keyword", "c.before", "c.after", "c.occ_count", (F.col("rank") + 1).alias("rank"))


def contexts(articles: DataFrame, keep: int = TOP_CONTEXTS, stopwords: list[str] = (), buckets: int | None = None) -> DataFrame:
    """context_lists, a row for each context."""
    return in_rows(context_lists(articles, keep, stopwords, buckets))


def _top_beside(sides: np.ndarray, terms: np.ndarray, n: np.ndarray, bits: int, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent words of each side of a keyword and week: side, word, count and rank. Words are below 2^bits."""
    found, n = _added(sides << bits | terms, n)
    best, rank = _best(found >> bits, n, keep)
    found = found[best]
    return found >> bits, found & (1 << bits) - 1, n[best], rank


def neighbours(articles: DataFrame, keep: int = TOP_NEIGHBOURS, stopwords: list[str] = (), buckets: int | None = None) -> DataFrame:
    """The most frequent words before and after each word, equal ones in their order, from their counts in blocks of articles."""
    names = ["week", "keyword", "position", "term", "count", "rank"]
    kinds = pa.schema([*((n, pa.string()) for n in names[:4]), ("count", pa.int32()), ("rank", pa.int32())])

    def find(blocks: list[dict[str, np.ndarray]], texts: pa.Array) -> pa.Table:
        size = len(texts)
        groups = np.concatenate([b["week"].astype(np.int64) * size + b["keyword"] for b in blocks])
        groups, own = np.unique(groups, return_inverse=True)
        sides = np.repeat((2 * own[:, None] + np.arange(2)).reshape(-1), np.concatenate([b["runs"] for b in blocks]))
        side, term, n, rank = _top_beside(sides, np.concatenate([b["beside"] for b in blocks]), np.concatenate([b["n"] for b in blocks]), size.bit_length(), keep)
        position = pa.array(["before", "after"]).take(pa.array(side & 1))
        return pa.table([_taken(texts, groups[side >> 1] // size), _taken(texts, groups[side >> 1] % size), position, _taken(texts, term), n, rank], names=names).cast(kinds)

    schema = "week string, keyword string, position string, term string, count int, rank int"
    return _gathered(articles.select("week", "body"), buckets, stopwords, _pairs, find, schema)


def described(articles: DataFrame, keep: int = TOP_CONTEXTS, beside: int = TOP_NEIGHBOURS, stopwords: list[str] = (), buckets: int | None = None) -> DataFrame:
    """All of a word in a week: how often each press has it (presses), its contexts, and its neighbours (before, after).

    These have one key, so they come from the same blocks: counts, contexts and neighbours neither meet in joins nor are
    dealt each for themselves.
    """

    def find(blocks: list[dict[str, np.ndarray]], texts: pa.Array) -> pa.Table:
        size, rows, none = len(texts), _rows(blocks), pc.index(texts, pa.scalar("", texts.type)).as_py()
        groups, found = _top_contexts(rows, texts, keep)
        own = [np.searchsorted(groups, b["week"].astype(np.int64) * size + b["keyword"]) for b in blocks]
        press = np.concatenate([np.repeat(o, b["presses"]) * size + b["press"] for o, b in zip(own, blocks, strict=True)])
        at, n = _counted([press], np.concatenate([b["press_n"] for b in blocks]))
        pressed = _lists({"press": _taken(texts, press[at] % size), "count": pa.array(n.astype(np.int32))}, np.bincount(press[at] // size, minlength=len(groups)))
        own = np.concatenate([np.repeat(o, b["runs"]) for o, b in zip(own, blocks, strict=True)])

        def side(*columns: str) -> pa.Array:
            there = [rows[c] != none for c in columns]
            sides, terms, n = (np.concatenate([x[t] for x, t in zip(xs, there, strict=True)]) for xs in ([own, own], [rows[c] for c in columns], [rows["n"]] * 2))
            group, term, *_ = _top_beside(sides, terms, n, size.bit_length(), beside)
            return _lists(_taken(texts, term), np.bincount(group, minlength=len(groups)))

        return pa.table([_taken(texts, groups // size), _taken(texts, groups % size), pressed, found, side("b2", "beside"), side("a1", "a2")], names=["week", "keyword", "presses", "contexts", "before", "after"])

    rows = articles.select("week", "body", F.coalesce(F.nullif("press", F.lit("")), F.lit("unknown")).alias("press"))
    return _gathered(rows, buckets, stopwords, _surroundings, find, f"week string, keyword string, presses array<struct<press: string, count: int>>, {_CONTEXTS}, before array<string>, after array<string>")


def weighted_sentences(articles: DataFrame) -> DataFrame:
    """(week, sentence, weight): a title weighs 3, a body's i-th sentence decay^i, but no less than the floor."""
    title = articles.select("week", text.collapse(F.col("title")).alias("sentence"), F.lit(TITLE_WEIGHT).alias("weight"))
    body = articles.select("week", F.posexplode(text.sentences(F.col("body"))).alias("i", "sentence"))
    body = body.select("week", text.collapse(F.col("sentence")).alias("sentence"), F.greatest(F.pow(F.lit(DECAY), F.col("i")), F.lit(FLOOR)).alias("weight"))
    return title.union(body).where("sentence <> ''").groupBy("week", "sentence").agg(F.sum("weight").alias("weight"))


def distinctive_terms(words: DataFrame, group: str, keep: int) -> DataFrame:
    """Top terms of each group by tf * (ln((1 + groups) / (1 + groups with the term)) + 1). words: group, term.

    The words are counted once; what else is needed comes from that count, which is written.
    """
    tf = stored(words.groupBy(group, "term").agg(F.count("*").alias("tf")), "tf")
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    n = tf.agg(F.count_distinct(group).alias("n"))
    scored = tf.join(df, "term").crossJoin(F.broadcast(n)).withColumn("score", F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(F.round("score", 9)), "term"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= keep).select(group, "term", "tf", "score", "rank")
