"""Packing, prefix counts and the transducer against the tokenizers library."""

import hashlib
import random
import time
import tracemalloc
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cohorta.llm import packing, token_counts, transducer
from cohorta.llm.bpe import Bpe
from cohorta.llm.pieces import BYTES, WORDS, ids_of, special_pattern
from tests.llm import cases

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
LETTERS = "aábÀc'srevdmtl<|endoftext|> \n\t\x1c  İΣςß١²½一́̈eﬁ🙂!?.1a23'\u200bİǅK\x00"


@pytest.fixture(scope="module")
def libraries():
    return {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}


def read(path):
    with open(path, "rb") as file:
        return file.read()


def random_texts(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        text = "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 14)))
        if rng.random() < 0.3:
            text += rng.choice(["<|endoftext|>", "<|startoftext|>", "'re", "'ll"]) + rng.choice(["x", "", " ", "\n\n b", "'s"])
        out.append(text)
    return out


@pytest.mark.parametrize("path, cutter", [(WORD, WORDS), (BYTE, BYTES)])
def test_ids_equal_the_library(libraries, path, cutter):
    texts = random_texts(4000, 3) + ["ab" * 3000 + "a" * 900] + list(cases.texts().values())
    bpe = Bpe(read(path))
    for pieces in cutter.batch(pa.array(texts), special_pattern(bpe)):
        rows = ids_of(pieces.entries, bpe, bpe.encode)
        upto = np.concatenate(([0], np.cumsum(rows.lengths[pieces.numbers])))
        ids, ends = rows.take(pieces.numbers), np.cumsum(pieces.counts)
        for i, a, b in zip(pieces.rows, ends - pieces.counts, ends):
            want = libraries[path].encode(texts[i], add_special_tokens=False).ids
            assert ids[upto[a]:upto[b]].tolist() == want, texts[i]


def test_every_prefix_count_equals_the_library(libraries):
    counter = token_counts.PrefixCounter(Bpe(read(WORD)))
    for text in random_texts(300, 4) + [t[:80] for t in cases.texts().values()]:
        want = [len(libraries[WORD].encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert token_counts.text_prefixes(counter, text).tolist() == want, text


def long_words():
    rng = random.Random(6)
    names = ",".join(f"name{i}" for i in range(3000))
    return ["it's," + names, names + ",l'été,<|endoftext|>x'll" + names, "don't" + "一、二" * 4000,
            "".join(rng.choice("a'<é,İrl1") for _ in range(4000)), "'" * 5000 + "re" * 3000]


def test_long_words_are_cut_once(libraries):
    counter = token_counts.PrefixCounter(Bpe(read(WORD)))
    rng = random.Random(7)
    for text in long_words():
        tracemalloc.start()
        got = token_counts.text_prefixes(counter, text)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 100_000_000, text[:20]
        for i in [*rng.sample(range(len(text)), 40), len(text)]:
            assert got[i] == len(libraries[WORD].encode(text[:i], add_special_tokens=False).ids), (text[:20], i)
        for budget in (50, 1000):
            some = token_counts.text_prefixes(counter, text, budget)
            assert token_counts.longest_within(some, budget) == token_counts.longest_within(got, budget)


def test_counts_and_budgets(spark, libraries):
    budget, texts = 50, cases.texts()
    got = token_counts.count_tokens(cases.documents(spark), WORD, budget, with_prefixes=True).collect()
    assert len(got) == len(cases.rows())
    for r in got:
        text = texts[r["doc_id"]]
        table = np.frombuffer(r["prefixes"], "<u4")
        assert len(table) == len(text) + 1 and table[-1] == r["n_tokens"]
        assert r["n_tokens"] == len(libraries[WORD].encode(text, add_special_tokens=False).ids)
        assert r["n_bytes"] == len(text.encode()) and r["n_fit"] == np.flatnonzero(table <= budget)[-1]
    assert token_counts.count_tokens(cases.nothing(spark), WORD).count() == 0


@pytest.mark.parametrize("longest", [4096, 8, 1])
def test_packing_is_lossless(spark, libraries, longest):
    texts = cases.texts()
    got = packing.pack(cases.documents(spark), WORD, 2, longest).collect()
    want = {i: libraries[WORD].encode(t, add_special_tokens=False).ids + [2] for i, t in texts.items()}
    tokens = {i: 0 for i in texts}
    for r in got:
        ids = want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids"] == ids and r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert r["length"] <= longest and r["length"] & (r["length"] - 1) == 0 and r["offset"] == 0
        assert r["doc_tokens"] == len(want[r["doc_id"]])
        tokens[r["doc_id"]] += r["length"]
    repeats = {r[0]: sum(x[0] == r[0] for x in cases.rows()) for r in cases.rows()}
    assert tokens == {i: len(w) * repeats[i] for i, w in want.items()}
    assert len({r["sequence_id"] for r in got}) == len(got)
    assert packing.pack(cases.nothing(spark), WORD, 2).count() == 0


def test_packing_wants_a_power_of_two_and_writes_buckets(spark, tmp_path):
    with pytest.raises(ValueError):
        packing.pack(cases.documents(spark), WORD, 2, 1000)
    packing.write_buckets(packing.pack(cases.documents(spark), WORD, 2, 64), str(tmp_path / "b"))
    assert {p.name for p in (tmp_path / "b").glob("length=*")} == {f"length={1 << k}" for k in range(7)}
    assert packing.binary_lengths(4096 * 2 + 5, 4096) == [4096, 4096, 4, 1] and packing.binary_lengths(0, 8) == []


def test_transducer_round_trip(spark, libraries):
    texts = cases.texts()
    for most in (10, 100_000):  # few and all words in the lexicon
        got = transducer.encode_decode(cases.documents(spark), BYTE, most_words=most, with_codes=True).collect()
        assert len(got) == len(cases.rows())
        for r in got:
            ids = libraries[BYTE].encode(texts[r["doc_id"]], add_special_tokens=False).ids
            decoded = libraries[BYTE].decode(ids, skip_special_tokens=False)
            assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == decoded
            assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert transducer.encode_decode(cases.nothing(spark), BYTE).count() == 0


def test_automaton_is_minimal_and_numbers_its_words(tmp_path):
    words = sorted({f"{a}{b}{c}".encode() for a in ("re", "un", "") for b in ("do", "play", "work") for c in ("", "s", "ing", "ed")})
    states, accepts = transducer.minimal_automaton(words)
    # Suffixes are shared: three prefixes and three stems end in one set of endings.
    assert len(states) == len({(a, tuple(sorted(s.items()))) for s, a in zip(states, accepts)}) < 25
    bpe = Bpe(read(BYTE))
    path = tmp_path / "lexicon"
    path.write_bytes(transducer.Lexicon.to_bytes(transducer.Lexicon.build(words, bpe)))
    lexicon = transducer.Lexicon.open(str(path))
    asked = [*words, b"re", b"plays!", b"x", b"undoo"]
    flat, lengths = np.frombuffer(b"".join(asked), np.uint8), np.array([len(w) for w in asked])
    assert lexicon.numbers(flat, lengths).tolist() == [*range(len(words)), -1, -1, -1, -1]
    ids, counts = lexicon.encode(bpe, flat, lengths)
    plain, plain_counts = bpe.encode(flat, lengths)
    assert ids.tolist() == plain.tolist() and counts.tolist() == plain_counts.tolist()


def test_prefixes_of_a_long_run_that_composes(libraries):
    """40,000 decomposed kana in one run: linear in time, and far below 200 MB."""
    counter, library = token_counts.PrefixCounter(Bpe(read(WORD))), libraries[WORD]
    rng = random.Random(6)
    kana = [chr(c) for c in range(0x304B, 0x3069)]
    text = "".join(unicodedata.normalize("NFD", rng.choice(kana)) for _ in range(30_000))[:40_000]
    assert len(text) == 40_000 and not unicodedata.is_normalized("NFC", text)
    start = time.process_time()
    got = token_counts.text_prefixes(counter, text)
    assert time.process_time() - start < 15  # a few seconds where nothing else runs
    for i in [*rng.sample(range(40_000), 12), 40_000]:
        assert got[i] == len(library.encode(text[:i], add_special_tokens=False).ids)
    tracemalloc.start()
    token_counts.text_prefixes(counter, text[:4000])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6  # a tenth of the text
    for tail in ("'s", "!é'", "̣́x", "9"):
        short = text[:300] + tail + text[:90]
        assert [len(library.encode(short[:i], add_special_tokens=False).ids) for i in range(len(short) + 1)] == \
            token_counts.text_prefixes(counter, short).tolist()
