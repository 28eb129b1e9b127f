"""SimHash: fingerprints and components against brute force; the plan of groups and thresholds."""

import random
from itertools import product

import numpy as np
import pytest
import xxhash

from tallyweek.llm import simhash
from tallyweek.llm.components import star_components


def _fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(prints, distance=2):
    root = dict(zip(prints, prints))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in product(prints, prints):
        if a < b and bin(a ^ b).count("1") <= distance:
            root[find(a)] = find(b)
    return {p: find(p) for p in prints}


@pytest.mark.parametrize("bucket", [128, 2])
def test_against_brute_force(spark, texts, bucket, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rnd = random.Random(3)
    vocabulary = [f"W{i}é" for i in range(30)]
    long = [rnd.choice(vocabulary) for _ in range(400)]
    rows = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 12)))) for i in range(60)]
    for i in range(40):  # near copies
        copy = list(long)
        copy[rnd.randrange(400)] = "changed"
        rows.append((100 + i, "\x0b".join(copy)))
    rows += [(200, None), (201, ""), (202, " \n"), (5, rows[6][1]), (5, "one two"), (None, rows[6][1]), (203, "ONE two ONE")]
    got = simhash.near_duplicates(texts(rows)).collect()
    prints = {(i, t): _fingerprint(t) for i, t in rows}
    roots = _components(sorted(set(prints.values())))
    smallest = {}
    for (i, _), p in prints.items():
        if i is not None:
            smallest[roots[p]] = min(i, smallest.get(roots[p], i))
    expected = sorted(((i, p, smallest.get(roots[p])) for (i, t), p in prints.items() for _ in range(rows.count((i, t)))), key=str)
    assert sorted(((r.id, r.fp & (2**64 - 1), r.component) for r in got), key=str) == expected


def test_long_text_in_portions(monkeypatch):
    text = " ".join(str(i % 97) for i in range(5000)).encode()
    whole = simhash.simhash_batch([text, b"", b"x"], 3)
    monkeypatch.setattr(simhash, "PORTION", 100)
    assert (simhash.simhash_batch([text, b"", b"x"], 3) == whole).all()
    assert whole[0] == _fingerprint(text.decode()) and whole[1] == 0


def test_empty_table(texts):
    assert simhash.near_duplicates(texts([])).collect() == []


def test_thresholds_cover_the_distance():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (500, 64))
    bits[:, 1] = bits[:, 0]  # correlated bits meet in one group
    plan = simhash.plan_groups(bits.T @ bits, 500, 2)
    assert len({b for part, _ in plan for b in part}) == sum(len(part) for part, _ in plan)
    groups = simhash.correlated_groups(bits.T @ bits, 500, 4)
    assert any({0, 1} <= set(g) for g in groups) and sorted(sum(groups, [])) == list(range(64))


def test_allocation_is_the_cheapest():
    rng = np.random.default_rng(1)
    costs = [[0.0, *np.sort(rng.random(3) * 9)] for _ in range(4)]
    least = min(sum(c[t + 1] for c, t in zip(costs, ts)) for ts in product(range(-1, 3), repeat=4) if sum(ts) == -1)
    value, chosen = simhash.allocate(costs, -1)
    assert sum(chosen) == -1 and abs(value - least) < 1e-12


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(1000, i) for i in range(900, 960)] + [(5, 5), (7, 8), (8, 7)]
    got = {r.node: r.root for r in star_components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 900 for i in [*range(901, 960), 1000]}}
    assert star_components(spark.createDataFrame([], "x long, y long"), "x", "y").collect() == []
