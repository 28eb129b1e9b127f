"""Near vectors against all pairs; the rotation; counting across buckets and blocks."""

import numpy as np
import pytest

from tallyweek.llm import crosspolytope


def _usable(v, label):
    return label is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def _brute_force(rows, cosine=0.98):
    unit = [np.array(v, np.float32).astype(float) if _usable(v, label) else None for _, v, label in rows]
    unit = [v / np.linalg.norm(v) if v is not None else None for v in unit]
    n = len(rows)
    near = [[b for b in range(n) if b != a and unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine] for a in range(n)]
    out, seen = [None] * n, set()
    for a in range(n):
        if a in seen:
            continue
        group, stack = {a}, [a]
        while stack:
            for b in near[stack.pop()]:
                if b not in group:
                    group.add(b)
                    stack.append(b)
        seen |= group
        ids = [rows[b][0] for b in group if rows[b][0] is not None]
        for b in group:
            out[b] = (rows[b][0], len(near[b]), min(ids, default=None))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1024, 16])
def test_against_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(crosspolytope, "BLOCK", block)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=20).tolist(), int(i % 3)) for i in range(150)]
    centre = rng.normal(size=20)
    rows += [(1000 + i, (centre + 0.1 * rng.normal(size=20)).tolist(), 1) for i in range(60)]
    rows += [(2000, rows[0][1], 0), (2000, rows[0][1], 0), (2001, None, 1), (2002, [0.0] * 20, 1), (2003, [float("nan")] * 20, 1)]
    rows += [(2004, [None] + [1.0] * 19, 1), (2005, rows[0][1], None), (2006, [1.0, 2.0], 1), (2007, [2.0, 4.0], 1), (None, rows[1][1], 1)]
    rows += [(2008, [], 1), (2009, [-0.0, 1.0], 1), (2010, [0.0, 1.0], 1), (2011, [float("inf")] * 20, 1), (2012, [5.0], 2), (2013, [3.0], 2), (2014, [1e-30] * 20, 2)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").selectExpr("*", "7 AS id", "8 AS v", "9 AS row", "1 AS rep")
    got = sorted(((r.id, r.n_links, r.component) for r in crosspolytope.near_vectors(table.repartition(3)).collect()), key=str)
    assert got == _brute_force(rows)


def test_empty_table(spark):
    assert crosspolytope.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).collect() == []


def test_rotation_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 64))
    y = crosspolytope.hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) and np.allclose(crosspolytope.hadamard(y), x)


@pytest.mark.parametrize("hashes", [2, 3, 4])
def test_recall_at_the_limit(hashes):
    rng = np.random.default_rng(3)
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * side  # exactly at the cosine
    _, tables, probes = crosspolytope.search_width(1, 64, hashes, None, None)
    x, y = (crosspolytope.buckets_of(v, tables, hashes, probes) for v in (a, b))
    met = np.zeros(len(a), bool)
    for k in range(x.shape[1]):
        met |= (x == np.roll(y, k, axis=1)).any(axis=1)
    assert met.mean() >= 0.95
