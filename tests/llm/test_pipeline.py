"""The pipeline: each stage keeps what it should, takes effect, and returns the documents' columns."""

import random

import corpus_pipeline
import __spark_entry__ as entry
import pytest

SF = "/root/testdata/sf0.001"


def test_registered():
    names = list(entry.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names


def test_whole_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(rows.columns)
    assert rows.selectExpr("sum(length)").first()[0] > 0
    assert rows.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0


@pytest.fixture
def corpus(spark):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    shared, body = prose(200), prose(300)
    rows = [(i, prose(120), "en", "s", 1) for i in range(20)]
    rows += [(30, body, "en", "s", 2), (31, body, "en", "s", 3), (30, body, None, None, None), (None, body, "en", "s", 4)]
    rows += [(40, prose(50) + shared, "en", "s", 5), (41, prose(50) + shared, "en", "s", 6)]
    rows += [(50, None, "en", "s", None), (51, "", "en", "s", 0), (52, 'password = "abcdef99"', "en", "s", 21)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.selectExpr("*", "1 AS id", "2 AS row", "3 AS score").repartition(3)


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES[:-1]], ids=lambda s: s[0])
def test_columns_and_empty_tables(spark, corpus, stage):
    name, run = stage
    got = run(spark, corpus, SF)
    assert got.columns == corpus_pipeline.COLUMNS
    got.collect()
    assert run(spark, corpus.where("false"), SF).collect() == []


def test_near_copies_keep_one(spark, corpus):
    got = corpus_pipeline.near_copies(spark, corpus, SF).collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted([*range(20), 30, 40, 41, 50, 52])  # 50 stands for 51
    assert len(got) == 25


def test_passages_are_cut(spark, corpus):
    got = {r.doc_id: r for r in corpus_pipeline.repeated_passages(spark, corpus, SF).collect()}
    before = {r.doc_id: r for r in corpus.collect()}
    assert got[0].text == before[0].text and got[0].n_chars == 1 and got[50].text is None and got[51].text == ""
    assert got[31].text == "" and got[31].n_chars == 0
    assert before[40].text.startswith(got[40].text) and len(before[40].text) - len(got[40].text) >= 400


def test_short_passages(spark):
    """55 words in under 400 bytes are a passage; 40 words in over 240 bytes are not."""
    rnd = random.Random(3)
    prose = lambda n, size: " ".join("".join(rnd.choice("abcdefgh") for _ in range(size)) for _ in range(n))
    passage, line = prose(55, 5), prose(40, 7)
    assert len(passage) < 400 and len(line) > 240
    own = [prose(60, 5) for _ in range(6)]
    texts = [f"{own[0]} {passage} {own[1]}", f"{own[2]}\n{passage}", f"{own[3]} {line}", f"{line} {own[4]}", own[5]]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, docs, SF).collect()}
    assert all(w not in got[i] for i in (0, 1) for w in passage.split()) and got[1].strip() == own[2]
    assert [got[i] for i in (2, 3, 4)] == texts[2:]


def test_packing_of_odd_rows(spark, corpus):
    run = dict(corpus_pipeline.STAGES)["packing"]
    got = run(spark, corpus, SF).groupBy("doc_id").agg({"piece": "count"}).collect()
    counts = {r.doc_id: r["count(piece)"] for r in got}
    assert set(counts) == {r.doc_id for r in corpus.collect()} and counts[30] == 2 and counts[50] == 1
    assert run(spark, corpus.where("false"), SF).collect() == []


def test_secrets_are_marked(spark, corpus):
    got = {r.doc_id: r for r in corpus_pipeline.no_secrets(spark, corpus, SF).collect()}
    assert got[52].text == '[SECRET]"' and got[52].n_chars == 9 and got[0].n_chars == 1


def test_batches_stay_small_in_every_stage(spark, corpus):
    """Also in frames that the caller of a stage writes."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    for _, run in corpus_pipeline.STAGES:
        spark.conf.unset(key)
        run(spark, corpus.where("false"), SF)
        assert spark.conf.get(key) == str(8 << 20)
    spark.conf.set(key, "1000000")
    corpus_pipeline.no_secrets(spark, corpus, SF)
    assert spark.conf.get(key) == "1000000"
    spark.conf.unset(key)
