"""Neighbours, similar documents and repeated strings against brute force."""

import random
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohorta.llm import cross_polytope, jaccard_join, suffix_levels
from cohorta.llm.components import components
from tests.llm import cases


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(3, 3), (None, 4)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 40)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(n=1500, dim=24, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) * rng.uniform(0.5, 2, (n, 1))
    x[200:260] = x[200]  # copies
    return x


def test_neighbours_reach_the_recall_and_exact_scores(spark):
    x = vectors()
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    rows += [(5000, None, "x"), (5020, [0.0] * 24, "x"), (5040, [float("nan")] * 24, "x"), (None, x[0].tolist(), "x"),
             (5060, [None] + [1.0] * 23, "x"), (5080, [float("inf")] * 24, "x"), (5100, [1.0, 2.0], "x"), (5101, [2.0, 1.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, entry string")
    got = cross_polytope.nearest(df, F.col("vec_id") % 20 == 0, k=20).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert [v for v, _ in by.pop(5100)] == [5101]
    assert set(by) == set(range(0, 1500, 20))
    hits = total = 0
    for q, found in by.items():
        scores = (x * x[q]).sum(axis=1)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -scores))[:20]
        assert len(found) == 20 and q not in [v for v, _ in found]
        assert np.allclose([s for _, s in found], [scores[v] for v, _ in found], atol=1e-12, rtol=0)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        hits += len(set(best.tolist()) & {v for v, _ in found})
        total += 20
    assert hits / total >= 0.9
    copies = [v for v, _ in by[220] if 200 <= v < 260]
    assert copies == [v for v in range(200, 260) if v != 220][:len(copies)] and len(copies) >= 20


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in cross_polytope.nearest(df, F.col("vec_id") == 0).collect())
    assert got == [(0, 1, 2, 1.0), (0, 2, 1, 0.0)]
    assert cross_polytope.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_large_buckets_are_searched_in_parts(spark, monkeypatch):
    x = vectors(300, 8, 2)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = sorted(tuple(r) for r in cross_polytope.nearest(df, F.col("vec_id") % 20 == 0).collect())
    monkeypatch.setattr(cross_polytope, "BUCKET_ROWS", 3)
    assert sorted(tuple(r) for r in cross_polytope.nearest(df, F.col("vec_id") % 20 == 0).collect()) == want
    monkeypatch.setattr(cross_polytope, "STEP_VALUES", 50)
    assert sorted(tuple(r) for r in cross_polytope.nearest(df, F.col("vec_id") % 20 == 0).collect()) == want


@pytest.mark.parametrize("dim, functions", [(24, 1), (8, 2), (4, 3)])
def test_blocks_of_buckets_hold_the_probed_ones(dim, functions):
    x = np.random.default_rng(6).normal(size=(6000 if functions > 1 else 500, dim))
    hashing = cross_polytope.Hashing(dim, len(x))
    assert hashing.functions == functions
    q, plain = cross_polytope._directions(x[:40], cross_polytope.Hashing(dim, 1)), np.arange(hashing.buckets)
    sides = hashing.sides(q, 2)
    sums = sides[0]
    for values in sides[1:]:
        sums = (sums[:, :, None] + values[:, None, :]).reshape(len(q), -1)
    best = [set(np.flatnonzero(s >= -np.sort(-s)[hashing.probes - 1]).tolist()) for s in sums]  # all that tie with the last
    least = hashing.least_probed(sides)
    for blocks in (1, 3, hashing.axes):
        edges, found = hashing.edges(blocks), [set() for _ in q]
        for b in range(blocks):
            at, number = hashing.reached(sides, least, edges[b], edges[b + 1])
            assert (hashing.block_of(number, blocks) == b).all()
            for i, bucket in zip(at.tolist(), number.tolist()):
                found[i].add(bucket)
        assert found == best and hashing.block_of(plain, blocks).max() == blocks - 1


def test_memory_of_many_probes():
    # With two hashes to a bucket each query probes hundreds of buckets: its vector is sent to few blocks only.
    hashing = cross_polytope.Hashing(64, 80_000)
    assert hashing.functions == 2 and hashing.probes > 2000
    x = cross_polytope._directions(np.random.default_rng(1).normal(size=(60, 64)), cross_polytope.Hashing(64, 1))
    sides = hashing.sides(x, 0)
    tracemalloc.start()
    least = hashing.least_probed(sides)
    found = hashing.reached(sides, least, 0, 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found[0]) > 1000 and peak < 40e6


def spread_norms(case, n=3000, dim=64):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if case == "long":
        x[7] *= 100
    elif case == "lognormal":
        x *= rng.lognormal(0, 1, (n, 1))
    elif case == "opposite":  # on two opposite rays, where no probe of a query reaches the other one
        x = np.outer(np.where(np.arange(n) < 5, 1, -1) * rng.uniform(1, 1.1, n), x[0])
    elif case == "extreme":
        x[:50] *= 1e150
        x[50:100] *= 1e-150
    return x


@pytest.mark.parametrize("case", ["long", "lognormal", "opposite", "extreme"])
def test_neighbours_when_norms_differ(spark, case):
    x = spread_norms(case)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    asks = list(range(0, len(x), 60))
    by = {}
    for r in cross_polytope.nearest(df, F.col("vec_id") % 60 == 0, k=20).collect():
        by.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in asks:
        scores = (x * x[q]).sum(axis=1)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -scores))[:20]
        assert len(by[q]) == 20
        hits += len(by[q] & set(best.tolist()))
    assert hits / (20 * len(asks)) >= 0.9


def brute_classes(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if rows[i][0] == rows[j][0] or both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    best = {}
    for i, (doc_id, _) in enumerate(rows):
        best[find(i)] = min(best.get(find(i), doc_id), doc_id)
    return {(doc_id, len(sets[i]), best[find(i)]) for i, (doc_id, _) in enumerate(rows)}


@pytest.mark.parametrize("most", [4096, 3])
def test_similar_classes_equal_brute_force(spark, sf_dir, most):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(
        cases.documents(spark).select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    got = jaccard_join.similar_classes(docs, most=most).collect()
    rows = [tuple(r) for r in docs.collect()]
    assert len(got) == len(rows) and {tuple(r) for r in got} == brute_classes(rows)


@pytest.mark.parametrize("least", [2, 5])
def test_lists_of_frequent_shingles_are_dealt_out(spark, sf_dir, monkeypatch, least):
    monkeypatch.setattr(jaccard_join, "LEAST_FREQUENT", least)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert {tuple(r) for r in jaccard_join.similar_classes(docs).collect()} == brute_classes([tuple(r) for r in docs.collect()])


def test_chains_of_near_copies_in_small_blocks(spark):
    rng = random.Random(2)
    rows, words = [], [f"w{i}" for i in range(120)]
    for i in range(120):  # each differs from the one before in a word; the ends share little
        rows.append((i, " ".join(words)))
        words[(i * 7) % 120] = f"n{i}"
    rows += [(1000 + i, " ".join(rng.choices([f"w{k}" for k in range(120)], k=100))) for i in range(30)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for most in (5, 64, 4096):
        assert {tuple(r) for r in jaccard_join.similar_classes(docs, most=most).collect()} == brute_classes(rows)


def test_documents_that_share_a_little_with_many_are_no_group(spark):
    # Every two of twelve share a passage of their own, so all n-grams of each are shared, but few with any other.
    def text(i, extra=""):
        return " ".join(f"p{min(i, j)}x{max(i, j)}w{k}" for j in range(12) if j != i for k in range(60)) + extra

    rows = [(i, text(i)) for i in range(12)] + [(40, text(3, " and two words")), (41, text(3, " or three other words"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    frequent = np.zeros(0, np.uint64)
    blobs = jaccard_join._prefix_blobs(docs, "doc_id", "text", 5, 80, frequent, 16)
    groups = jaccard_join._members(blobs, 80, frequent, 16).collect()
    assert {(r["doc_id"], r["part"]) for r in groups} == {(3, 3), (40, 3), (41, 3)}
    assert {tuple(r) for r in jaccard_join.similar_classes(docs).collect()} == brute_classes(rows)


@pytest.mark.parametrize("short", [1, 3, 4, 1000])
def test_short_and_long_lists_tie_the_same(spark, monkeypatch, short):
    monkeypatch.setattr(jaccard_join, "SHORT", short)
    rng = random.Random(8)
    passages = [" ".join(f"s{i}w{k}" for k in range(25)) for i in range(8)]
    rows = []
    for size in range(1, 9):  # clusters of near copies, and passages that go through them
        words = [f"c{size}w{k}" for k in range(rng.choice([6, 30, 150]))]
        for _ in range(size):
            if rng.random() < 0.7:
                words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words) + (" " + rng.choice(passages) if len(words) > 100 else "")))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {tuple(r) for r in jaccard_join.similar_classes(docs).collect()} == brute_classes(rows)


def test_only_texts_of_members_are_sent(spark):
    texts = spark.range(0, 2000, numPartitions=3).selectExpr("id as doc_id", "cast(concat('text ', id) as binary) as text")
    few = spark.createDataFrame([(i,) for i in (3, 7, 1999)], "doc_id long")
    got = {r["doc_id"]: bytes(r["text"]) for r in jaccard_join._texts_of(few, texts).collect()}
    assert {3, 7, 1999} <= set(got) and len(got) < 10 and got[7] == b"text 7"


def test_texts_without_some_ids(spark, monkeypatch):
    rows = [(i % 90, f"text {i}") for i in range(300)] + [(None, "nameless")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    gone = spark.createDataFrame([(i,) for i in range(0, 90, 7)] + [(1000,)], "doc_id long")
    for bits in (26, 6):  # many ids share a mark
        monkeypatch.setattr(jaccard_join, "MARK_BITS", bits)
        got = sorted(r["text"] for r in jaccard_join.without(docs, gone).collect())
        assert got == sorted(t for i, t in rows if i is None or i % 7)


def test_similar_classes_of_awkward_and_no_rows(spark):
    docs = cases.documents(spark)
    got = jaccard_join.similar_classes(docs).collect()
    assert len(got) == len(cases.rows())
    assert {tuple(r) for r in got} == brute_classes([(r[0], r[1]) for r in cases.rows()])
    nameless = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in jaccard_join.similar_classes(nameless).collect()) == [(0, 1), (1, 1)]
    assert jaccard_join.similar_classes(cases.nothing(spark)).count() == 0


def test_overlaps_derived_from_a_similar_set():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**60, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[rng.random(300) > 0.05], rng.integers(0, 2**60, 9).astype(np.uint64)))) for _ in range(20)]
    members = jaccard_join.Members(np.arange(20), sets, 80)
    for i in range(20):
        for j in range(0, 20, 7):
            (low, got), (start, expected) = members.derived(i, j, members.overlaps(j)), members.overlaps(i)
            assert low == start and (got == expected).all()


def test_lists_are_read_in_the_window_of_sizes_only():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**60, 2000).astype(np.uint64)
    sets = [np.unique(base[:n]) for n in range(20, 2000, 20)]  # sizes far apart, all share n-grams
    members = jaccard_join.Members(np.arange(len(sets)), sets, 80)
    label = members.classes()
    whole = jaccard_join.Members(np.arange(len(sets)), sets, 80)
    for i in range(len(sets)):
        whole.count(whole.lists_of(i), 0, len(sets))
    assert members.read * 2 < whole.read
    expected = list(range(len(sets)))
    for i in range(1, len(sets)):
        if 100 * len(sets[i - 1]) >= 80 * len(sets[i]):
            expected[i] = expected[i - 1]
    assert label.tolist() == expected
    for i, j in ((60, 55), (60, 90), (98, 0), (10, 11)):  # also beyond the other's window
        (low, got), (start, direct) = members.derived(i, j, members.overlaps(j)), members.overlaps(i)
        assert low == start and (got == direct).all()


def test_an_id_with_several_texts_is_one_document(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(3, a), (5, a), (5, b), (7, b), (9, "other words than those of all the rest")]
    for parts in (1, 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = sorted((r["doc_id"], r["component_id"]) for r in jaccard_join.similar_classes(docs).collect())
        assert got == [(3, 3), (5, 3), (5, 3), (7, 3), (9, 9)]


def test_blocks_measured_by_shingles(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        words[rng.randrange(400)] = f"n{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for grams in (1000, 5000):
        assert {tuple(r) for r in jaccard_join.similar_classes(docs, grams=grams).collect()} == brute_classes(rows)


def test_memory_of_near_copies_of_long_texts():
    """200 sets of 20,000 n-grams: 32 MB of n-grams, at most 8 times that while they are compared."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**60, 20_000).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[rng.random(20_000) > 0.01], rng.integers(0, 2**60, 200).astype(np.uint64))))
            for _ in range(200)]
    tracemalloc.start()
    label = jaccard_join.Members(np.arange(200), sets, 80).classes()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (label == 0).all() and peak < 256e6


def brute_repeats(rows):
    first, out = {}, []
    for doc_id, text in sorted(((d, (t or "").encode()) for d, t in rows), key=lambda r: r[0]):
        gone = [False] * len(text)
        for s in range(len(text) - 99):
            w = text[s:s + 100]
            if first.setdefault(w, (doc_id, s)) != (doc_id, s):
                gone[s:s + 100] = [True] * 100
        kept = bytes(b for b, g in zip(text, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(text), sum(gone), runs, kept))
    return sorted(out)


def found_repeats(df):
    return sorted((r["doc_id"], r["n_bytes"], sum(b - a for a, b in zip(r["starts"], r["ends"])), len(r["starts"]),
                   bytes(r["kept"])) for r in df.collect())


def repeat_rows():
    rng = random.Random(9)
    words = [f"{a}{b}" for a in ("ab", "cé", "x", "zz") for b in ("1", "", "ü", "q")]
    passages = [" ".join(rng.choices(words, k=rng.randint(20, 90))) for _ in range(5)]
    rows = []
    for i in range(60):
        text = "".join(rng.choice([rng.choice(passages), " ".join(rng.choices(words, k=rng.randint(1, 50))), "ab" * rng.randint(0, 150),
                                   "z" * rng.randint(0, 250)]) for _ in range(rng.randint(0, 5)))
        rows.append((i * 3 % 60 + i // 20, rows[rng.randrange(len(rows))][1] if rows and rng.random() < 0.2 else text))
    return rows


def test_repeats_equal_brute_force(spark):
    rows = repeat_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for batches in (1, 4, 8):
        assert found_repeats(suffix_levels.remove_repeats(docs, batches=batches)) == brute_repeats(rows)


def test_repeats_on_given_documents_and_awkward_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("n_chars < 4000").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert found_repeats(suffix_levels.remove_repeats(docs)) == brute_repeats(rows)
    got = found_repeats(suffix_levels.remove_repeats(cases.documents(spark)))
    assert got == brute_repeats([(r[0], r[1]) for r in cases.rows()])
    assert suffix_levels.remove_repeats(cases.nothing(spark)).count() == 0


def test_new_batches_against_a_stored_index(spark, tmp_path):
    rows = sorted(repeat_rows())
    old, new = [r for r in rows if r[0] < 30], [r for r in rows if r[0] >= 30]
    frames = [spark.createDataFrame(r, "doc_id long, text string") for r in (old, new)]
    path = str(tmp_path / "index")
    suffix_levels.remove_repeats(frames[0], index_out=path).count()
    got = suffix_levels.remove_repeats(frames[1], earlier=frames[0], index=path)
    assert found_repeats(got) == [r for r in brute_repeats(rows) if r[0] >= 30]


def test_levels_grow_geometrically():
    levels = suffix_levels.Levels()
    for k in range(64):
        batch = np.zeros(100, suffix_levels._ENTRY)
        batch["key"], batch["doc"] = np.arange(100) + k * 100, k
        assert len(levels.add(batch)) == 0
        sizes = [len(x) for x in levels.levels]
        assert all(b * 2 <= a for a, b in zip(sizes, sizes[1:])) and sum(sizes) == (k + 1) * 100
