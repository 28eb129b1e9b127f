"""The quality classifier: held-out accuracy, gradients, odd texts."""

import random
from zlib import crc32

import duckdb
import numpy as np
import pytest

from tallyweek.llm import quality, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op5_quality_classifier(spark, SF).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall()
    assert len(got) == 1000
    assert all(r.held_out == (crc32(str(i).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for i, r in got.items())
    held = [(got[i].predicted, q) for i, q in labels if got[i].held_out]
    assert len(held) > 50 and sum(p == q for p, q in held) / len(held) > 0.95


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, quality.FEATURES)) for n in (1, 3, 2)]
    labels = np.array([1.0, 0.0, 0.5])
    shape = [(quality.FEATURES, 5), (5,), (5, 4), (5, 4), (4,), (5,), (1,)]
    model = quality.Model(np.zeros(quality.FEATURES), np.ones(quality.FEATURES), [rng.normal(0, 0.3, s) for s in shape])
    x, counts = np.concatenate(bags), np.array([1, 3, 2])

    def loss():
        p = model.scores(x, counts)
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    for weight, gradient in zip(model.weights, model.gradients(x, counts, labels)):
        place = tuple(0 for _ in weight.shape)
        weight[place] += 1e-6
        up = loss()
        weight[place] -= 2e-6
        down = loss()
        weight[place] += 1e-6
        assert gradient[place] == pytest.approx((up - down) / 2e-6, rel=1e-3, abs=1e-7)


def test_passages_cover_texts_and_portions_agree(monkeypatch):
    rnd = random.Random(1)
    texts = [b"", b"x", b"\n" * 2000, ("é " * 3000).encode(), b"word " * 500, b"y" * 3000] + [bytes(rnd.choices(b"ab c.\n", k=700)) for _ in range(20)]
    together = list(quality.encode_passages(texts))
    assert sum(len(c) for _, c in together) == len(texts)
    monkeypatch.setattr(quality, "PORTION", 0)
    alone = list(quality.encode_passages(texts))
    assert np.allclose(np.concatenate([x for x, _ in together]), np.concatenate([x for x, _ in alone]))
    for text, (_, count) in zip(texts, alone):
        starts = quality.passage_starts(np.frombuffer(text, np.uint8))
        assert starts[0] == 0 and (np.diff(starts) > 0).all() and len(starts) == count[0]


def test_odd_rows(spark, texts):
    rows = [(1, "some words"), (2, None), (3, ""), (None, "no id"), (4, "again"), (4, "again"), (5, "long " * 30_000)]
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 0), (None, 1), (9, 1), (5, None)], "doc_id bigint, quality int")
    for known in (labels, labels.where("false"), labels.where("quality = 1")):
        got = quality.score(texts(rows), quality.fit(texts(rows), known), keep=["row", "label"]).collect()
        assert sorted(str(r[0]) for r in got) == sorted(str(i) for i, _ in rows)
        assert all(0 <= r[1] <= 1 for r in got)
    assert quality.score(texts([]), quality.fit(texts([]), labels)).collect() == []
