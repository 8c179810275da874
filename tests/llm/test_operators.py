"""The training-data operators against plain versions on small tables, with the odd cases that each must bear."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weekloom.llm import bitslice, common, encoding, langid, mixing, packing, pii, quality, simhash, stable_nn, tagger, token_files, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string"
LONG = "word " * 30_000 + "end."
TEXTS = [
    "The cat sat on the mat. It was warm.", "", None, "   ", "x", LONG, "Line one\nline two\nline two", "tab\there  two blanks ", "a b 　c", "été où naïve ß ñ",
    "The cat sat on the mat. It was warm.", "mail a.b@c-d.example.org or +1 (361) 555-8283, 10.0.0.1", "card 4539 1488 0343 6467 no 4539 1488 0343 6468", "<|endoftext|> 0 10 0.5", "한국어 문장 입니다",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, ["en", "fr", None][k % 3], f"s{k % 2}", len(t or ""), 1.0, "clash") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[0]], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def tokenizer(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return t


def ids_of(t, text, end):
    return [*t.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4"))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_word_encoder_equals_the_tokenizer(name):
    t, e = tokenizer(name), encoding.WordEncoder(public_tokenizers.path(name))
    for _ in range(2):
        ids, at = e.encode(*common.bytes_of(pa.array(TEXTS)))
        for k, text in enumerate(TEXTS):
            assert ids[at[k] : at[k + 1]].tolist() == ids_of(t, text, 0)[:-1]


_ENCODERS = {n: (tokenizer(n), encoding.WordEncoder(public_tokenizers.path(n))) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab0é 'sS\n\t.!# ÅÅ한"), max_size=30), max_size=4))
def test_word_encoder_on_odd_texts(texts):
    for t, e in _ENCODERS.values():
        ids, at = e.encode(*common.bytes_of(pa.array(texts, pa.string())))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def thue_morse(length):
    word = "a"
    while len(word) < length:
        word += word.translate({97: 98, 98: 97})
    return word, word.translate({97: 98, 98: 97})


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("length", [1024, 2048, 4096])
def test_words_with_equal_hashes_keep_their_own_ids(name, length):
    t, e = tokenizer(name), encoding.WordEncoder(public_tokenizers.path(name))
    one, two = thue_morse(length)
    raw = np.frombuffer(f"{one}{two}".encode(), np.uint8)
    h = encoding.unit_hashes(raw, np.array([0, length]), np.array([length, 2 * length]))
    assert h[0] == h[1]
    for texts in ([f"xx {one}", f"xx {two}"], [f"xx {two} yy {one}", f"{one} {two}", two], [f"xx {one} zz"]):
        ids, at = e.encode(*common.bytes_of(pa.array(texts)))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_packing(docs, empty):
    path, t = public_tokenizers.path("word_bpe_49k.json"), tokenizer("word_bpe_49k.json")
    rows = packing.pack_documents(docs, path, size=64).collect()
    assert not packing.pack_documents(empty, path).collect()
    by_sequence = {}
    for r in rows:
        ids = ids_of(t, TEXTS[r.doc_id], 2)
        assert r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[r.start : r.start + r.length])
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(r.length for r in rows) == sum(len(ids_of(t, TEXTS[r.doc_id], 2)) for r in docs.collect())


def test_shortest_pack_first_places_every_piece():
    histogram = np.random.default_rng(0).integers(0, 50, 101)
    histogram[0] = 0
    seen = np.zeros(101, int)
    for count, lengths in packing.shortest_pack_first(histogram):
        assert sum(lengths) <= 100 and lengths == sorted(lengths, reverse=True)
        for length in lengths:
            seen[length] += count
    assert (seen == histogram).all()


def test_elias_fano():
    for values in ([], [0], [0, 0, 0], [5], list(range(300)), sorted(np.random.default_rng(1).integers(0, 10**9, 500).tolist())):
        code, _ = token_files.EliasFano.from_bytes(token_files.EliasFano.encode(np.array(values, np.int64)).to_bytes())
        assert code.get(np.arange(len(values))).tolist() == values == [code[i] for i in range(len(values))]
    far = np.array([0] * 100 + [1 << 20, (1 << 40) + 7] + [1 << 41] * 70, np.int64)  # marks far apart, and runs of equal values
    code = token_files.EliasFano.encode(far)
    at = np.random.default_rng(2).permutation(len(far))
    assert (code.get(at) == far[at]).all() and len(code.to_bytes()) < 40 + len(far) * (2 + 34) / 8 + 16


def test_doc_ids_of_a_block():
    for ids in ([], [None, None], [None, -(1 << 62), 5, 5, 9], [(1 << 62) + k for k in range(200)]):
        code, _ = token_files.Ids.from_bytes(b"xx" + token_files.Ids.encode(ids).to_bytes(), 2)
        assert code.get(np.arange(len(ids))).to_pylist() == ids


def test_token_files(spark, docs, empty, tmp_path):
    path, t = public_tokenizers.path("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.json")
    for k, (table, block) in enumerate(((docs, 50), (docs, 1 << 20), (empty, 50))):
        token_files.write_token_files(table, path, f"{tmp_path}/{k}", block_ids=block)
        rows = sorted(token_files.read_token_files(spark, f"{tmp_path}/{k}").collect(), key=lambda r: r.start)
        assert [r.doc_id for r in rows] == sorted(r.doc_id for r in table.collect())
        start = 0
        for r in rows:
            ids = ids_of(t, TEXTS[r.doc_id], 0)
            assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc(ids))
            start += len(ids)


def test_damaged_token_file():
    image = bytearray(token_files.pack_block(np.arange(9, dtype=np.uint16), np.array([0, 4, 9]), [3, None][:1] + [8]))
    image[-1] ^= 1
    with pytest.raises(ValueError):
        token_files.unpack_block(bytes(image))


def plain_fingerprint(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
    shingles = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    found = simhash.fingerprint_batch(*common.bytes_of(pa.array(TEXTS)))
    assert [int(x) for x in found] == [plain_fingerprint(t) for t in TEXTS]


@pytest.mark.parametrize("classes", [10, 1 << 23])
def test_links_within_the_radius(spark, classes, monkeypatch):
    r = np.random.default_rng(3)
    base = [int(x) for x in r.integers(0, 1 << 63, 20)]
    prints = sorted({b ^ sum(1 << int(i) for i in r.choice(64, k, replace=False)) for b in base for k in (0, 1, 2, 3, 4, 5) for _ in range(4)} | {0, 1, (1 << 64) - 1})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    plan = simhash.segments(classes)
    monkeypatch.setattr(simhash, "segments", lambda *_: plan)
    rows = simhash.links_between(spark.createDataFrame(list(zip(signed, range(len(prints)), strict=True)), "fp long, rep long")).collect()
    assert sorted((x.a, x.b) for x in rows) == [(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints)) if (prints[i] ^ prints[j]).bit_count() <= 3]


def test_near_duplicates(docs, empty):
    rows = simhash.near_duplicates(docs).collect()
    component = {r.doc_id: r.component_id for r in rows}
    prints = [plain_fingerprint(t) for t in TEXTS]
    assert len(rows) == len(TEXTS) + 1 and component[10] == 0 and component[2] == component[3] == 1
    assert all((component[i] == component[j]) for i in component for j in component if (prints[i] ^ prints[j]).bit_count() <= 3)
    kept = simhash.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(component.values())) and kept.columns == docs.columns
    assert not simhash.near_duplicates(empty).collect()


def test_a_row_without_id_links_others(spark, monkeypatch):
    prints = spark.createDataFrame([(1, "", 0), (None, "", 7), (2, "", 63), (None, "", 31 << 40), (5, "", 0)], "doc_id long, mark string, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: prints)
    rows = simhash.near_duplicates(prints).collect()
    assert sorted((r.fp, r.doc_id or 0, r.component_id) for r in rows) == [(0, 1, 1), (0, 5, 1), (7, 0, 1), (63, 2, 1), (31 << 40, 0, None)]


def test_hot_and_rare_classes_together(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 4)  # one class in four rows is hot
    texts = ["one and the same text of some words"] * 30 + [f"text number {k * 7919} with other words {k}" for k in range(20)]
    rows = simhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    prints = [plain_fingerprint(t) for t in texts]
    least = {r.doc_id: r.component_id for r in rows}
    assert len(rows) == 50 and all(least[k] == 0 for k in range(30))
    assert all((least[i] == least[j]) for i in least for j in least if (prints[i] ^ prints[j]).bit_count() <= 3)


def test_keep_one_with_clashing_names(spark):
    rows = [(1, "a b c d", 7), (1, "a b c d", 8), (2, "a b c d", 9), (None, "a b c d", 1), (3, None, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _NTH int")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3]


def test_keep_one_chooses_rows(spark):
    """An id that two texts share: the one with a near copy goes, the other one stays; no text is lost with its id."""
    one, two = "The first of two quite different texts that share an id", "Something else that nobody has copied at all, ever"
    kept = lambda rows: sorted(tuple(r) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert kept([(3, one), (5, one), (5, two)]) == [(3, one), (5, two)]
    assert kept([(3, one), (3, two), (3, one), (4, two)]) == sorted([(3, one), (3, two)])
    assert kept([(7, None), (7, ""), (8, one)]) in ([(7, None), (8, one)], [(7, ""), (8, one)])


@pytest.fixture(scope="module")
def vectors(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(400, 12))
    x[100:150] = x[100]
    rows = [(k, [float(v) for v in v_]) for k, v_ in enumerate(x.astype(np.float32))]
    rows += [(400, None), (401, [float("nan")] * 12), (402, [0.0] * 12), (403, []), (450, [None] * 12), (7, rows[7][1])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def plain_top(vectors, score, k=5, zero=True):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in vectors.collect() if r.embedding and all(v is not None and np.isfinite(v) for v in r.embedding)]
    rows = [x for x in rows if zero or x[1].any()]
    out = []
    for q, a in rows:
        if q % 50 == 0:
            best = sorted((-score(a, b), i) for i, b in rows if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def test_bit_sliced_top_k(spark, vectors):
    rows = bitslice.top_k(vectors, vectors.where("vec_id % 50 = 0"), rows_per_group=64, queries_per_block=3).collect()
    assert sorted(map(tuple, rows)) == plain_top(vectors, lambda a, b: int(np.floor(256 * a) @ np.floor(256 * b)))
    assert not bitslice.top_k(vectors.limit(0), vectors.limit(0)).collect()
    few = vectors.where("vec_id < 3")
    assert len(bitslice.top_k(few, few.where("vec_id = 0")).collect()) == 2


def test_stable_nearest(vectors):
    rows = stable_nn.nearest(vectors, vectors.where("vec_id % 50 = 0"), rows_per_group=128, queries_per_block=3).collect()
    want = plain_top(vectors, lambda a, b: float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), zero=False)
    found, true = {(r.query_id, r.vec_id) for r in rows}, {(q, i) for q, _, i, _ in want}
    assert len(rows) == len(want) and len(found & true) >= 0.9 * len(true)
    assert [r.vec_id for r in sorted(rows, key=lambda r: r.rank) if r.query_id == 100] == [101, 102, 103, 104, 105]
    assert not stable_nn.nearest(vectors.limit(0), vectors.limit(0)).collect()


def test_odd_vectors(spark):
    """Null ids take no part, other lengths only meet their like, extremes stay finite, and extra columns say nothing."""
    r = np.random.default_rng(6)
    rows = [(k, [float(v) for v in r.normal(size=4)], 1) for k in range(60)] + [(None, [9.0] * 4, 2), (100, [1.0, 2.0], 3), (101, [2.0, 4.0], 3), (150, [3e38] * 4, 4), (151, [3e38, -3e38, 1e-40, 1.0], 4), (152, [1e-42] * 4, 4)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    asked = table.where("vec_id % 50 = 0")
    for search in (bitslice.top_k, stable_nn.nearest):
        found = search(table, asked).collect()
        by = {q: [x.vec_id for x in sorted(found, key=lambda x: x.rank) if x.query_id == q] for q in (0, 50, 100, 150)}
        assert [len(v) for v in by.values()] == [5, 5, 1, 5] and by[100] == [101] and all(x.vec_id is not None and np.isfinite(x.score) for x in found)
    near = [x for x in stable_nn.nearest(table, asked).collect() if x.query_id == 150 and x.rank == 1][0]
    assert near.vec_id == 152 and abs(near.score - 1) < 1e-12


def test_stopping_test_law():
    samples = np.random.default_rng(0).chisquare(16, 20000)
    for x in (8.0, 16.0, 30.0):
        assert abs(stable_nn.chi_square(np.float64(x), 16) - (samples <= x).mean()) < 0.02


WORDS = {"en": "the and of with that from this there been house river stone", "fr": "le la les des dans pour avec été être maison rivière pierre", "de": "der die das und nicht mit auf haus fluss stein schön größe"}


@pytest.fixture(scope="module")
def written(spark):
    r = np.random.default_rng(8)
    rows = []
    for k in range(400):
        lang = sorted(WORDS)[k % 3]
        words = list(r.choice(WORDS[lang].split(), 40))
        toxic, good = int(k % 7 == 0), int(k % 5 != 0)
        if toxic:
            words[5::9] = ["gruzzle" if k % 2 else "gr0zz1e"] * len(words[5::9])
        text = " ".join(words).capitalize() + "." if good else "!! ".join(w.upper() for w in words) + " | | | ###"
        rows.append((k, text, lang if k % 11 else None, good, toxic))
    docs = spark.createDataFrame([r[:3] for r in rows] + [(400, None, "en"), (401, "", None), (402, "123 ...", "fr"), (None, "the and of", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3], r[4]) for r in rows] + [(None, 1, 0), (5, None, 1)], "doc_id long, quality int, toxic int")
    return docs, labels, rows


def test_language(written, empty):
    docs, _, rows = written
    found = {r.doc_id: r for r in langid.identify(docs, langid.train(docs)).collect()}
    assert all(found[k].lang_pred == sorted(WORDS)[k % 3] and 0 <= found[k].score <= 1 for k in range(400))
    assert [found[k].lang_pred for k in (400, 401, 402)] == ["und"] * 3
    assert langid.filter_languages(docs).columns == docs.columns and langid.filter_languages(docs).count() == 401
    assert not langid.identify(empty, langid.train(empty)).collect()


def test_language_scores_by_hand(written):
    docs, _, rows = written
    model = langid.train(docs)
    for _, text, *_ in rows[:6]:
        stream = [ord(c.lower()) if c.isalpha() else 32 for c in text]
        counts = {}
        for order in langid.ORDERS:
            for i in range(len(stream) - order + 1):
                mixed = 0
                for k, c in enumerate(stream[i : i + order]):
                    mixed = ((mixed ^ c) * int(langid._MULTIPLIERS[k])) & 0xFFFFFFFF
                    mixed ^= mixed >> 15
                bucket = mixed >> (32 - langid.BUCKET_BITS)
                counts[bucket] = counts.get(bucket, 0) + 1
        x = {b: np.log1p(n) * model.idf[b] for b, n in counts.items()}
        size = np.sqrt(sum(v * v for v in x.values()))
        z = np.array([sum(v / size * model.weights[b][j] for b, v in x.items()) for j in range(len(model.languages))]) / model.temperature
        p = np.exp(z - z.max())
        names, scores = model.predict(*common.bytes_of(pa.array([text])))
        assert names == [model.languages[int(p.argmax())]] and abs(scores[0] - p.max() / p.sum()) < 1e-9


def test_rare_language_and_no_labels(spark):
    rows = [(k, " ".join(f"the and of with {w}" for w in "house river stone".split()), "en") for k in range(300)] + [(1000 + k, "не было дома у реки", "ru") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.train(docs, most=50).languages == ["en", "ru"]
    bare = spark.createDataFrame([(1, "some text", None), (2, "12 34", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r.doc_id for r in langid.filter_languages(bare).collect()] == [1]
    named = bare.selectExpr("*", "1 AS lang_pred", "2 AS Score")
    assert langid.identify(named, None).columns == langid.identify(named, langid.train(docs)).columns == ["lang_pred", "score", "doc_id", "text", "lang"]
    assert langid.filter_languages(named).columns == named.columns


def test_quality_scores_by_hand(written):
    docs, labels, rows = written
    model = quality.train(docs, labels)
    x = quality.measured(*common.bytes_of(pa.array([r[1] for r in rows[:20]])))
    for values, got in zip(x, model.score(x), strict=True):
        bins = [sum(v >= e for e in edges) for v, edges in zip(values, model.edges, strict=True)]
        z = model.base + sum(t[b] for t, b in zip(model.tables, bins, strict=True)) + sum(t[bins[i], bins[j]] for (i, j), t in zip(model.pairs, model.pair_tables, strict=True))
        assert abs(got - 1 / (1 + np.exp(-z))) < 1e-9


def test_quality(written, empty):
    docs, labels, rows = written
    found = {r.doc_id: r.score for r in quality.score(docs, quality.train(docs, labels)).collect()}
    assert len(found) == 404 and np.mean([(found[r[0]] >= 0.5) == r[3] for r in rows]) > 0.98
    assert {r.score for r in quality.score(docs, quality.train(docs, labels.limit(0))).collect()} == {0.5}
    assert not quality.score(empty, None).collect()


def test_toxicity(written, empty):
    docs, labels, rows = written
    found = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert len(found) == 404 and np.mean([(found[r[0]] >= 0.5) == r[4] for r in rows]) > 0.98
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, labels.limit(0))).collect()} == {0.0}
    assert not toxicity.score(empty, None).collect()


def test_restoration(spark):
    words = ["idiot", "stupid", "loser", "stone", "see", "boss"]
    docs = spark.createDataFrame([(k, " ".join(words[: 6 - k % 2]) + ", x1y idiot") for k in range(50)] + [(90, None), (91, "")], "doc_id long, text string")
    model = toxicity.fit_language(docs)
    want = {}
    for word in words:
        n, padded = 25 if word == "boss" else 50, f"^^^{word}$"
        for i in range(3, len(padded)):
            for k in range(4):
                for gram in (padded[i - k : i + 1], padded[i - k : i] + " "):
                    want[toxicity.gram_key(gram)] = want.get(toxicity.gram_key(gram), 0) + n
    assert dict(zip(model.keys.tolist(), model.sums.tolist(), strict=True)) == want and model.floor == 1 / (len(set("".join(words))) + 30)
    read = toxicity.Restorer(model).word
    assert [read(w) for w in ("1d10t", "i d i o t", "stuuupid", "l.o.s.e.r", "$tone", "boss")] == ["idiot", "idiot", "stupid", "loser", "stone", "boss"]
    assert read("st" + "u" * 200 + "pid") == "stupid" and read("a1@mail.example.com") == "a1@mail.example.com"
    assert toxicity.fit_language(docs.limit(0)).cost("^^^", "a") == pytest.approx(np.log(30))


def test_restoration_of_every_disguise(spark):
    words = ["idiot", "stupid", "asshole", "ass", "scum", "moron", "stone", "see"]
    docs = spark.createDataFrame([(k, " ".join(words)) for k in range(50)], "doc_id long, text string")
    restorer = toxicity.Restorer(toxicity.fit_language(docs))
    written = {"asshol3": "asshole", "you idio7.": "you idiot.", "a55": "ass", "a$$": "ass", "s....c....u....m": "scum", "s t u p 1 d": "stupid", "m 0 r 0 n": "moron", "see s  t  u p i d": "see stupid", '"$tone': '"stone', "5 c u m": "scum", "!diot": "idiot", "see stuupid": "see stupid", "sc#m": "scum", "mor*n": "moron", "stu\u00adpid": "stupid", "ｉｄｉｏｔ": "idiot", "id!0t!": "idiot!"}
    plain = ["stone", "see stone!", "1 0 5", "455", "see. stone", "a b", "stone (see)"]
    texts = [*written, *plain, "s", ".tone", ""]
    raw = ["".join(texts), np.cumsum([0, *map(len, texts)])]
    points, at = restorer.texts(np.array([ord(c) for c in raw[0]], np.uint32), raw[1])
    got = ["".join(map(chr, points[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)]
    assert got == [*written.values(), *plain, "s", ".tone", ""]


def test_restoration_finds_the_cheapest_reading():
    import itertools

    r = np.random.default_rng(2)
    model = toxicity.LanguageModel(np.array([], np.int64), np.array([], np.float32), 20)
    table = {}
    model.cost = lambda context, letter: table.setdefault((context, letter), float(r.gamma(1.0, 3.0)))
    def choices(word, i):
        c = word[i]
        if c.isalpha():
            return [(c, 0.0)] + ([("", toxicity.REPEAT)] if word[i - 1 : i] == c else [])
        drop = toxicity.FILL if c in toxicity.FILLERS else toxicity.DROP
        return [*((x, toxicity.READ) for x in toxicity.CHANNEL.get(c, "") + (toxicity.MASKS.get(c, "") if 0 < i < len(word) - 1 else "")), ("", drop)]

    for word in ("a0183!", "b7@$10", "aabb-b", "s..t0p", "ffu*k#", "o-o.oo"):
        every = []
        for parts in itertools.product(*(choices(word, i) for i in range(len(word)))):
            context, cost = "^^^", sum(p for _, p in parts)
            for letter, _ in parts:
                if letter:
                    cost, context = cost + model.cost(context, letter), context[1:] + letter
            every.append((cost + model.cost(context, "$"), "".join(x for x, _ in parts)))
        assert toxicity.restore(word, model) == min(every)[1]


def test_document_frequencies(spark):
    docs = spark.createDataFrame([(1, "ab a"), (2, "A"), (3, None), (4, "")], "doc_id long, text string")
    n, df = langid.document_frequencies(docs)
    assert n == 3 and df.max() == 2 and df.sum() == 9  # a in two texts; b, blank, ab, "b ", " a", "ab ", "b a" in one


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        total = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits)))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab@.-+%_ 0123456789()é"), max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_personal_data(spark, docs, empty):
    model = pii.train(docs)
    rows = pii.find(docs, model).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        base = plain_spans(TEXTS[r.doc_id] or "")
        assert [tuple(s) for s in r.base] == base and set(base) <= {tuple(s) for s in r.spans}
    clean = pii.redact(docs, model)
    assert clean.columns == docs.columns
    kept = {r.doc_id: r for r in clean.collect()}
    assert "[EMAIL]" in kept[11].text and "[PHONE]" in kept[11].text and "[IP]" in kept[11].text and kept[11].n_chars == len(kept[11].text)
    assert kept[2].text is None and kept[5].text == LONG
    assert not pii.find(empty, model).collect()


def test_personal_data_written_in_other_ways(spark):
    """Spans that no pattern allows, in texts that the model has not seen, and none in texts without personal data."""
    r = np.random.default_rng(12)
    words = "the house by river had many windows and people came there every day with their boats old stone bridge was near".split()
    prose = lambda n: " ".join(r.choice(words, n))
    docs = spark.createDataFrame([(k, f"{prose(30)} call +1 (361) 555-{1000 + k} or write mail{k}@host.com {prose(30)}") for k in range(200)], "doc_id long, text string")
    model = pii.train(docs)
    items = [x for x in (pii._variant(k % 4, np.random.default_rng(1000 + k)) for k in range(400)) if not pii.base_spans(x[0])]
    held = [f"{prose(25)} {item} {prose(25)}" for item, _ in items]
    base, found = pii.text_spans(model, held)
    caught = [any(s[0] < t.index(item) + len(item) and s[2] > t.index(item) for s in spans) for t, (item, _), spans in zip(held, items, found, strict=True)]
    assert len(items) > 100 and not any(base) and np.mean(caught) > 0.6
    clean = [f"{prose(20)} in the year {1900 + k} there were {k} of {prose(20)}" for k in range(100)]
    assert sum(map(len, pii.text_spans(model, clean)[1])) <= 2


def test_odd_digits_and_long_stretches():
    model = tagger.Tagger(9)
    texts = ["1234 5678 9012 345²", "+٣٤٥ 123 456 7890", "a (at) b", "1" * 200_000, "x@" + "y" * 3000]
    base, every = pii.text_spans(model, texts)
    assert base == [plain_spans(t) for t in texts] and all(set(b) <= set(e) for b, e in zip(base, every, strict=True))
    assert not pii.fits(2, "1234 5678 9012 345²") and pii.fits(0, "ab (at) cd.com") and not pii.fits(1, "300.1.1.1")
    r = np.random.default_rng(3)
    parts = [r.integers(1, 99, n).astype(np.int16) for n in (1, 63, 64, 97, 500, 40_000)]
    for short, long in zip(tagger.decode(model, parts), tagger.decode(model, parts, long=0), strict=True):
        assert (short == long).all()


def test_stretches_end_with_words():
    text = "a" * 300 + " " + "b" * 100 + "1" + "c" * 100 + " " + "d" * 90 + " e"
    (a, b), = pii.stretches(text)
    assert text[a:b].startswith("b") and text[b:] .startswith(" ")
    assert pii.stretches("no such sign") == [] and pii.stretches("7") == [(0, 1)]


def test_tagger_gradients_and_windows():
    model = tagger.Tagger(5, seed=2)
    model.p = {k: v.astype(np.float32) for k, v in model.p.items()}
    r = np.random.default_rng(0)
    x, y = r.integers(1, 99, (12, 3)).astype(np.int16), r.integers(0, 5, (12, 3))
    _, g = model._loss(x, y)
    for name in ("embed", "recur_f", "in_b", "moves", "out", "start"):
        at = np.unravel_index(int(np.abs(g[name]).argmax()), g[name].shape)
        was, step = model.p[name][at], np.float32(1e-2)
        model.p[name][at] = was + step
        up = model._loss(x, y)[0]
        model.p[name][at] = was - step
        down = model._loss(x, y)[0]
        model.p[name][at] = was
        assert abs((up - down) / (2 * step) - g[name][at]) < 0.02 + 0.05 * abs(g[name][at])
    parts = [r.integers(1, 99, n).astype(np.int16) for n in (1, 5, 64, 65, 300)]
    assert [len(t) for t in tagger.decode(model, parts)] == [1, 5, 64, 65, 300]


def test_mixing(spark, written, empty):
    docs, _, _ = written
    classifier, rates, rows = mixing.weigh(docs, targets={"de": 0.6, "en": 0.2, "fr": 0.2})
    rated = rows.withColumn("rate", rates.of(rows.posterior)).collect()
    total = sum(r.tokens for r in rated)
    shares = [sum(r.tokens * r.rate * r.posterior[k] for r in rated) / total for k in range(3)]
    assert classifier.domains == ["de", "en", "fr"] and np.allclose(shares, [0.6, 0.2, 0.2], atol=0.01) and min(r.rate for r in rated) >= 0
    up = mixing.mix(docs, least=1.0, flat=0.5)
    assert up.columns == docs.columns and {r.doc_id for r in up.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert not mixing.mix(empty).collect()


def test_rates_equal_a_plain_projected_gradient(spark):
    r = np.random.default_rng(4)
    p = r.dirichlet([0.4] * 3, 60)
    tokens = r.integers(1, 500, 60)
    table = spark.createDataFrame([(x.tolist(), int(t)) for x, t in zip(p, tokens, strict=True)], "posterior array<double>, tokens long")
    share = tokens / tokens.sum()
    for targets, least in (([0.5, 0.3, 0.2], 0.0), ([0.05, 0.15, 0.8], 0.0), ([0.5, 0.5, 0.4], 1.0)):
        rate = np.ones(60)
        for _ in range(20_000):  # least squares of the misses over rates >= least, from all rates at 1
            rate = np.maximum(least, rate - 0.5 * (p @ (share @ (rate[:, None] * p) - targets)))
        got = mixing.fit(table, targets, least)
        assert np.allclose(got.reached, share @ (rate[:, None] * p), rtol=3e-3)


def test_evidence_and_posterior_by_hand(spark, written):
    docs, _, rows = written
    classifier, _, found = mixing.weigh(docs)
    got = {r.doc_id: r.posterior for r in found.collect()}
    for k, text, *_ in rows[:30]:
        lower = f" {text.lower()} ".replace("\n", " ")
        counts = [lower.count(g) for g in classifier.grams]
        size = len(text.encode())
        scale = classifier.softness[0] * max(size, 1) ** classifier.softness[1]
        z = np.array([prior + (sum(c * np.log(x) for c, x in zip(counts, rate, strict=True)) - size * sum(rate)) / scale for prior, rate in zip(classifier.prior, classifier.rates, strict=True)])
        want = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert np.allclose(got[k], want, atol=1e-9) and abs(sum(got[k]) - 1) < 1e-12
    assert np.allclose(got[400], np.exp(classifier.prior))


def test_mixing_of_many_domains_and_odd_rows(spark):
    rows = [(k, f"w{chr(97 + k % 34)}{chr(97 + k % 26)}x word " * 5 + "text", f"d{k % 34:02d}") for k in range(340)] + [(None, None, None), (None, "abc", "d01"), (3, "", "d02"), (3, "", "d02")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS posterior", "2 AS c0", "'x' AS tokens")
    classifier, rates, found = mixing.weigh(docs, flat=0.9)
    assert len(classifier.domains) == 34 and found.count() == len(rows)
    few = docs.where("lang IN ('d01', 'd02') OR lang IS NULL")
    out = mixing.mix(few, least=1.0, flat=0.5)
    assert out.columns == docs.columns and out.count() >= few.count()
    bare = docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert mixing.mix(bare).count() == len(rows)


@pytest.mark.parametrize("shares", [(0.97, 0.01, 0.01, 0.01), (0.9, 0.05, 0.04, 0.01), (0.998, 0.0018, 0.0001, 0.0001)])
@pytest.mark.parametrize("soft", [0.0, 0.1])
def test_mixing_meets_small_domains(spark, shares, soft):
    cells = [([1 - 3 * soft if j == k else soft for j in range(4)], int(s * 1_000_000)) for k, s in enumerate(shares)]
    cells += [([0.5, 0.5, 0.0, 0.0], 500), ([1.0, 0.0, 0.0, 0.0], 700), ([0.0, 0.0, 1.0, 0.0], 70), ([0.0, 1.0, 0.0, 0.0], 70), ([0.0, 0.0, 0.0, 1.0], 70)]
    table = spark.createDataFrame(cells, "posterior array<double>, tokens long").repartition(1).cache()
    for targets, least in (([0.25] * 4, 0.0), ([1.2 * sum(t * p[k] for p, t in cells) / sum(t for _, t in cells) for k in range(4)], 1.0), ([0.6, 0.398, 0.001, 0.001], 0.0)):
        rates = mixing.fit(table, targets, least)
        rows = table.withColumn("rate", rates.of(table.posterior)).collect()
        got = [sum(r.tokens * r.rate * r.posterior[k] for r in rows) / sum(r.tokens for r in rows) for k in range(4)]
        assert np.allclose(got, rates.reached, rtol=1e-6, atol=1e-9) and min(r.rate for r in rows) >= least
        assert np.allclose(got, targets, rtol=2e-3, atol=0) and not rates.missed()


def test_mixing_says_which_targets_are_missed(spark, written):
    cells = spark.createDataFrame([([1.0, 0.0], 90), ([0.5, 0.5], 10)], "posterior array<double>, tokens long")
    rates = mixing.fit(cells, [0.25, 0.75], 0.0)
    assert rates.missed() == [0, 1] and np.allclose(rates.reached, [0.5, 0.5], atol=1e-4)  # least squares on rate >= 0
    with pytest.warns(UserWarning, match="de .* of 0.01"):
        mixing.weigh(written[0], targets={"de": 0.01, "en": 0.5, "fr": 0.5}, least=1.0)


def test_sql_equals_queries(spark):
    """The SQL of the registered queries, on the smallest tables (skipped where those are not there)."""
    import os

    import duckdb

    from weekloom.llm import queries

    folder = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    duck = duckdb.connect()
    for name in ("documents", "embeddings", "labels"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    assert set(queries.oracle_sql()) <= set(queries.queries()) and queries.oracle_sql()
    for name, sql in queries.oracle_sql().items():
        theirs = duck.sql(sql)
        ours = queries.queries()[name](spark, folder).select(*theirs.columns)
        assert sorted(map(tuple, ours.collect())) == sorted(theirs.fetchall()), name


def test_operators_bear_null_ids_and_repeated_rows(spark):
    from weekloom.llm import packing as pk

    rows = [(None, "the cat sat on the mat", "en"), (None, None, None), (4, "the cat sat on the mat", "en"), (4, "the cat sat on the mat", "en"), (4, "another text", "en"), (5, "", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    path = public_tokenizers.path("word_bpe_49k.json")
    packed = pk.pack_documents(docs, path, size=8).collect()
    assert sum(r.length for r in packed) == sum(len(ids_of(tokenizer("word_bpe_49k.json"), r[1], 2)) for r in rows)
    assert sorted((r.doc_id or 0) for r in pii.find(docs, pii.train(docs)).collect()) == [0, 0, 4, 4, 4, 5]
    assert len(langid.identify(docs, langid.train(docs)).collect()) == 6 and len(simhash.near_duplicates(docs).collect()) == 6
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert len(quality.score(docs, quality.train(docs, labels)).collect()) == 6 and len(toxicity.score(docs, toxicity.train(docs, labels)).collect()) == 6


def test_token_files_bear_null_and_repeated_ids(spark, tmp_path):
    rows = [(None, "x y"), (None, None), (-5, "a"), (4, "b c"), (4, "b c"), ((1 << 63) - 1, "z"), (-(1 << 63), "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    token_files.write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), f"{tmp_path}/f")
    got = sorted(token_files.read_token_files(spark, f"{tmp_path}/f").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, -(1 << 63), -5, 4, 4, (1 << 63) - 1]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()


def test_digest(spark, tmp_path):
    text = "write to a@b.cd now"
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    row = pii.op1_pii(spark, str(tmp_path)).first()
    assert (row.n_email, row.n_phone, row.spans) == (1, 0, "email:9:15") and row.base_sha256 == hashlib.sha256(b"email:9:15").hexdigest()


def test_mixing_learns_from_texts_without_blanks(spark):
    """Two scripts whose words are not set apart, with no letter in common."""
    r = np.random.default_rng(8)
    write = lambda first: "".join(chr(first + int(k)) for k in r.integers(0, 40, 300))
    rows = [(k, write(0x4E00 if k % 2 else 0x3042), "zh" if k % 2 else "ja") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    classifier, _, weighed = mixing.weigh(docs)
    assert classifier.domains == ["ja", "zh"] and any(len(g.strip()) and g.strip() in write(0x4E00) * 50 or ord(g.strip()[0]) > 0x3000 for g in classifier.grams)
    likely = {x.doc_id: x.posterior[1] for x in weighed.collect()}
    assert all((likely[k] > 0.99) == (k % 2 == 1) and (likely[k] < 0.01) == (k % 2 == 0) for k in range(200))


def test_sums_of_columns_equal_sums_of_rows(spark, monkeypatch):
    r = np.random.default_rng(9)
    rows = [([float(x) for x in r.dirichlet([0.2] * 5)], int(n)) for n in r.integers(1, 90, 200)]
    cells = spark.createDataFrame(rows, "posterior array<double>, tokens long")
    wide = mixing.fit(cells, [0.2] * 5, 0.0)
    monkeypatch.setattr(mixing, "COLUMNS", 2)
    long = mixing.fit(cells, [0.2] * 5, 0.0)
    assert np.allclose(wide.weights, long.weights, atol=1e-6) and np.allclose(wide.reached, [0.2] * 5, rtol=2e-3)
