"""Distinct-word encoding, periodic runs and ranked search against the libraries and brute force."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohorta.llm import periodic_runs, ranked_search, word_shuffle, words
from cohorta.llm.queries import queries
from tests.llm import cases

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=60), max_size=12))
@settings(max_examples=60, deadline=None)
def test_words_are_cut_inside_their_texts(texts):
    cut = words.cut_words(pa.array([t.encode() for t in texts], pa.binary()).slice(0), periodic_runs._WORD)
    expected = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    codes, entries = cut.coded()
    assert cut.counts.tolist() == [len(e) for e in expected]
    assert [entries[c].as_py().decode() for c in codes] == sum(expected, [])


def test_blocks_cover_all_rows():
    texts = pa.array([b"x" * n for n in (5, 0, 20, 3, 3, 0)], pa.binary())
    assert list(words.blocks(texts, 8)) == [(0, 2), (2, 3), (3, 6)]
    assert list(words.blocks(texts.slice(1, 3), 8)) == [(0, 2), (2, 3)]
    assert list(words.blocks(texts.slice(0, 0), 8)) == []


def test_ranked_merges_equal_the_library(library):
    rng = random.Random(3)
    pieces = [c * n for c in "a -=_.0\n" for n in (1, 2, 3, 7, 50, 300, 1000)]
    for _ in range(3000):
        letters = [chr(rng.randrange(32, rng.choice([127, 0x3000]))) for _ in range(rng.choice([2, 5, 30]))]
        pieces.append("".join(rng.choices(letters, k=rng.randint(1, rng.choice([6, 40, 400])))))
    data = [p.encode() for p in pieces]
    with open(RANKS, "rb") as file:
        bpe = word_shuffle.RankBpe(file.read())
    ids, counts = bpe.encode(np.frombuffer(b"".join(data), np.uint8), np.array([len(d) for d in data]))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [library._core_bpe.encode_single_piece(d) for d in data]


def coded_rows(df):
    return sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], tuple(r["ids"]), bytes(r["decoded"]))
                  for r in df.collect())


def library_rows(rows, library):
    out = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        data = library.decode_bytes(ids)
        out.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(data).hexdigest(), tuple(ids), data))
    return sorted(out)


def test_shuffled_words_equal_the_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(
        cases.documents(spark).select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    rows = [tuple(r) for r in docs.collect()]
    for owner_bytes in (word_shuffle.OWNER_BYTES, 20_000):
        got = word_shuffle.encode_decode(docs.repartition(3), RANKS, owner_bytes=owner_bytes, with_codes=True)
        assert coded_rows(got) == library_rows(rows, library)


def test_shuffled_words_of_awkward_and_no_rows(spark, library):
    docs = cases.documents(spark)
    got = word_shuffle.encode_decode(docs, RANKS, with_codes=True)
    assert coded_rows(got) == library_rows([(r[0], r[1]) for r in cases.rows()], library)
    assert word_shuffle.encode_decode(cases.nothing(spark), RANKS).count() == 0
    nameless = spark.createDataFrame([(None, "one two"), (None, None)], "doc_id string, text string")
    assert sorted(r["n_tokens"] for r in word_shuffle.encode_decode(nameless, RANKS).collect()) == [0, 2]


def test_decoding_joins_the_token_table(spark, library):
    texts = {i: t for i, t in enumerate(["", "plain words", "naïve 🙂 \n\n x", "a" * 500])}
    with open(RANKS, "rb") as file:
        known = word_shuffle.token_table(spark, file.read())
    coded = spark.createDataFrame([(i, library.encode_ordinary(t)) for i, t in texts.items()] + [(9, None)],
                                  "doc_id long, ids array<int>")
    got = {r["doc_id"]: bytes(r["decoded"]).decode() for r in word_shuffle.decode(coded, known).collect()}
    assert got == texts | {9: ""}
    with pytest.raises(PySparkException):
        word_shuffle.decode(spark.createDataFrame([(1, [60000])], "doc_id long, ids array<int>"), known).collect()


def brute_runs(w, least=12):
    out = []
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            a, b = i, j + p
            if b - a >= max(least, 2 * p) and not any(w[a:b - q] == w[a + q:b] for q in range(1, p)):
                out.append((a, b - a, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def found_runs(texts, least=12):
    flat = np.array(sum(texts, []), np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    start, end, period = periodic_runs.runs_of(flat, owner, least)
    return list(zip(start.tolist(), (end - start).tolist(), period.tolist()))


@given(st.lists(st.tuples(st.integers(1, 6), st.integers(0, 60), st.randoms(use_true_random=False)), max_size=5))
@settings(max_examples=150, deadline=None)
def test_runs_equal_brute_force(kinds):
    texts = []
    for letters, n, rng in kinds:
        text = [rng.randrange(letters) for _ in range(n)]
        if n and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max((n - a) // 2, 1))
            text = [text[i] if i < a else text[a + (i - a) % p] for i in range(n)]
        texts.append(text)
    expected, at = [], 0
    for text in texts:
        expected += [(a + at, n, p) for a, n, p in brute_runs(text)]
        at += len(text)
    assert found_runs(texts) == expected


def test_runs_of_known_words_and_of_long_texts():
    fibonacci, other = [0, 1], [0]
    while len(fibonacci) < 500:
        fibonacci, other = fibonacci + other, fibonacci
    thue = [bin(i).count("1") & 1 for i in range(1024)]
    for text in (fibonacci, thue):
        assert found_runs([text]) == brute_runs(text)
    assert found_runs([[7] * 50_000]) == [(0, 50_000, 1)]
    assert found_runs([list(range(9)) * 5_000, [1] * 11]) == [(0, 45_000, 9)]
    assert found_runs([]) == found_runs([[], [1]]) == []


def test_rules_are_used_where_they_stand():
    rng = np.random.default_rng(1)
    text = np.concatenate([rng.integers(0, 4, 300), np.tile([1, 2, 3], 40), rng.integers(0, 4, 300)])
    grammar = periodic_runs.re_pair(text, np.zeros(len(text), np.int64))
    for rule, place in zip(grammar.rules, grammar.places):
        a, n = grammar.at[rule], grammar.size[rule]
        assert (text[a:a + n] == text[place:place + n]).all()
    assert len(grammar.rules) > len(grammar.at)  # some rule is used more than once
    assert (grammar.size == len(text)).sum() == 1


def test_wrong_hashes_do_not_matter(monkeypatch):
    monkeypatch.setattr(periodic_runs.Extensions, "_same", lambda self, i, j, n: np.ones(len(i), bool))
    rng = random.Random(4)
    for _ in range(20):
        text = [rng.randrange(2) for _ in range(40)] + [0, 1, 2] * 7 + [rng.randrange(3) for _ in range(20)]
        assert found_runs([text]) == brute_runs(text)


def planted(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    return w


def run_digest(doc_id, text):
    w = planted(doc_id, text)
    runs = brute_runs(w)
    gone = {i for a, n, p in runs for i in range(a + p, a + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, None if not runs else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{a},{n},{p}\n" for a, n, p in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def test_run_query_equals_brute_force(spark, sf_dir, tmp_path):
    docs = cases.documents(spark).filter("doc_id <> 15").unionByName(
        spark.read.parquet(f"{sf_dir}/documents.parquet").filter("n_chars < 3000")
        .select((F.col("doc_id") + 1000).alias("doc_id"), "text"), allowMissingColumns=True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries()["op12_periodic_runs"](spark, str(tmp_path)).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got), key=repr) == sorted((run_digest(*r) for r in rows), key=repr)


def test_runs_of_awkward_and_no_rows(spark):
    got = periodic_runs.word_runs(cases.documents(spark)).collect()
    assert sorted((r["doc_id"], r["n_words"]) for r in got) == sorted(
        (r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in cases.rows())
    assert [r["runs"] for r in got if r["doc_id"] == 14] == [[(0, 700, 1)]]
    assert [r["collapsed"] for r in got if r["doc_id"] == 14] == ["ab"]
    assert periodic_runs.word_runs(cases.nothing(spark)).count() == 0
    nameless = spark.createDataFrame([(None, "a b " * 9), (None, None)], "doc_id long, text string")
    assert sorted(r["collapsed"] for r in periodic_runs.word_runs(nameless).collect()) == ["", "a b"]


def brute_ranking(docs, items, k=10):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    counts = [(d, Counter(terms(t))) for d, t in docs]
    held = Counter(t for _, c in counts for t in c)
    n_docs, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    asks = {}
    for item, text in items:
        if item is not None:
            asks.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, ask in asks.items():
        scores = []
        for doc_id, c in counts:
            if c:
                m = 100 - 75 + (75 * sum(c.values()) * n_docs) // total
                s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t, q in ask.items() if t in c)
                if s > 0:
                    scores.append((-s, doc_id is None, doc_id))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("owners, slice_documents, bundle_items", [(4, 16_384, 256), (1, 50, 7), (3, 3, 256)])
def test_search_equals_brute_force(spark, sf_dir, monkeypatch, owners, slice_documents, bundle_items):
    monkeypatch.setattr(ranked_search, "SLICE_DOCUMENTS", slice_documents)
    monkeypatch.setattr(ranked_search, "BUNDLE_ITEMS", bundle_items)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(
        cases.documents(spark).select((F.col("doc_id") + 1000).alias("doc_id"), "text")).repartition(3)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").unionByName(spark.createDataFrame(
        [(900, None), (901, "!!"), (902, "Alpha5 alpha5 ALPHA5 délta7"), (902, "ß1"), (None, "the of")], "item_id long, text string"))
    got = ranked_search.search(docs, items, owners=owners).collect()
    expected = brute_ranking([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert sorted(map(tuple, got), key=repr) == expected


def test_search_in_awkward_and_no_rows(spark):
    docs = cases.documents(spark).unionByName(spark.createDataFrame([(None, "alpha1 beta2 one two")], "doc_id long, text string"),
                                              allowMissingColumns=True)
    items = spark.createDataFrame([(1, "one two three", 5), (2, "emoji 🙂🙂 İstanbul", None), (1, "one", 5)],
                                  "item_id long, text string, doc_id int")
    got = sorted(map(tuple, ranked_search.search(docs, items).collect()), key=repr)
    assert got == brute_ranking([(r["doc_id"], r["text"]) for r in docs.collect()], [tuple(r)[:2] for r in items.collect()])
    assert ranked_search.search(cases.nothing(spark), items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).count() == 0


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1), st.sampled_from([191, 192, 16063, 16064])), max_size=50))
@settings(max_examples=100, deadline=None)
def test_packed_numbers_come_back(numbers):
    assert word_shuffle._numbers(word_shuffle._packed(np.array(numbers, np.int64)), len(numbers)).tolist() == numbers
