"""The stages hand documents on, their decisions take effect, clean documents stay."""

import random

import corpus_pipeline
import __spark_entry__ as entry
from cohorta.llm import queries as llm
from tests.llm import cases

COLUMNS = corpus_pipeline.COLUMNS


def prose(rng, n):
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "ne", "ru", "ta"]) for _ in range(rng.randint(1, 4)))
                    + rng.choice(["", "", "", ",", "."]) for _ in range(n))


NAMELESS = prose(random.Random(77), 120)


def corpus(spark, folder):
    rng = random.Random(5)
    clean = {i: prose(rng, 120) for i in range(60)}
    passage = prose(rng, 60)
    docs = dict(clean)
    docs |= {100 + i: clean[i] + " one more end." for i in range(5)}  # near copies of clean ones
    docs |= {200: prose(rng, 80) + "\n" + passage, 201: prose(rng, 80) + "\n" + passage}
    docs |= {300: prose(rng, 100) + " password = abcdefgh12345678 " + prose(rng, 20)}
    junk = {400 + i: " ".join(f"{rng.choice(['BUY', 'WIN'])}{i}{k}!!" for k in range(60)) for i in range(40)}
    docs |= junk | {500: None, 501: ""}
    rows = [(i, t, None if i % 7 == 0 else "en", f"s{i % 3}", None if t is None else len(t)) for i, t in docs.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows + [(None, NAMELESS, None, None, 3)], schema).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i in list(clean)[:50]] + [(i, 0, 0) for i in junk]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs, clean, junk


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    docs, clean, junk = corpus(spark, folder)
    out, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, out, folder)
        if i < 4:
            assert out.columns == COLUMNS
            out.write.parquet(f"{folder}/{i}")
            out = spark.read.parquet(f"{folder}/{i}")
            seen.append({r["doc_id"]: r["text"] for r in out.collect()})
    good, different, unrepeated, safe = seen
    assert set(clean) <= set(good) and not set(junk) & set(good) and good[None] == NAMELESS
    assert set(clean) <= set(different) and not {100, 101, 102, 103, 104} & set(different)
    assert {i: unrepeated[i] for i in clean} == clean
    assert different[None] == unrepeated[None] == safe[None] == NAMELESS
    assert len(unrepeated[201]) < len(docs[201]) - 100 and unrepeated[200] == docs[200]
    assert "[SECRET]" in safe[300] and "abcdefgh12345678" not in safe[300]
    pieces = out.collect()
    for doc_id in safe:
        own = sorted((p["start"], p["length"]) for p in pieces if p["doc_id"] == doc_id)
        assert sum(n for _, n in own) == next(p["doc_tokens"] for p in pieces if p["doc_id"] == doc_id)
    again = corpus_pipeline.run(spark, folder).drop("sequence_id")
    assert again.exceptAll(out.drop("sequence_id")).count() == 0 and again.count() == len(pieces)


def test_registered():
    names = set(entry.queries())
    assert set(llm.queries()) | {"pipeline"} <= names and len(llm.queries()) == 13
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(llm.oracle_sql()) <= set(llm.queries())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages_of_no_rows_and_awkward_rows(spark, tmp_path):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (cases.nothing(spark), cases.documents(spark)):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, str(tmp_path))
            if i < 4:
                assert docs.columns == COLUMNS
                path = f"{tmp_path}/{random.random()}"
                docs.write.parquet(path)
                docs = spark.read.parquet(path)
        assert len({r["doc_id"] for r in docs.collect()}) <= len(cases.rows())
