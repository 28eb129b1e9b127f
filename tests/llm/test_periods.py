"""Periodic runs against every period tried at every place."""

import random
import re
import time
import zlib
from hashlib import sha256

import numpy as np
import pytest

from tallyweek.llm import periods, queries


def _runs(words):
    """All runs, by plain comparison."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smaller = (all(words[k] == words[k + r] for k in range(i, i + length - r)) for r in range(1, q))
            if length >= max(24, 3 * q) and not any(smaller):
                out.append((i, i + length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def _words(rnd, most):
    words = []
    while len(words) < most:
        letters = rnd.choice(["ab", "abc", "abcdefghij"])
        unit = [rnd.choice(letters) for _ in range(rnd.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 40]))]
        size = rnd.randint(1, 6 * len(unit) + 20) if rnd.random() < 0.6 else rnd.randint(1, len(unit))
        words += (unit * size)[:size]
    return words[:most]


def test_transforms_give_correlations():
    rng = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        blocks, windows = rng.integers(0, periods.PRIME, (5, size)), rng.integers(0, periods.PRIME, (5, 2 * size))
        windows[2, size // 2 : size // 2 + size] = blocks[2]
        sums = [[sum(int(x - y) ** 2 for x, y in zip(b, w[s : s + size], strict=True)) % periods.PRIME == 0 for s in range(size)] for b, w in zip(blocks, windows, strict=True)]
        row, shift = periods.zero_shifts(blocks, windows)
        assert list(zip(row.tolist(), shift.tolist(), strict=True)) == [tuple(x) for x in np.argwhere(sums).tolist()]
        assert (2, size // 2) in zip(row, shift, strict=True)


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_all_periods(seed):
    rnd = random.Random(seed)
    found = 0
    for _ in range(60):
        words = _words(rnd, rnd.randint(0, 400))
        runs = periods.find_runs([w.encode() for w in words])
        assert runs == _runs(words), words
        found += len(runs)
    assert found > 20


def test_blocks_longer_than_the_transform(monkeypatch):
    monkeypatch.setattr(periods, "LONGEST", 16)
    rnd = random.Random(9)
    for _ in range(60):
        words = _words(rnd, rnd.randint(200, 900))
        assert periods.find_runs([w.encode() for w in words]) == _runs(words)


def test_number_clashes_are_compared_word_by_word():
    """Numbers that are equal modulo the prime are different words."""
    words = np.tile(np.arange(8), 10)
    words[40] += periods.PRIME
    assert periods.runs_of_stretch(words) == [(0, 40, 8), (41, 80, 8)]


@pytest.mark.parametrize("kind", ["one", "few", "period", "fibonacci", "stretches"])
def test_time_is_nearly_linear(kind):
    rnd = random.Random(2)
    took = []
    for size in (20_000, 160_000):
        if kind == "fibonacci":
            before, words = ["a"], ["a", "b"]
            while len(words) < size:
                before, words = words, words + before
        elif kind == "stretches":
            words = [w for _ in range(size // 50) for w in ["a"] * rnd.randint(5, 90) + [str(rnd.randrange(300))]]
        else:
            words = {"one": ["a"], "few": [str(rnd.randrange(300)) for _ in range(size)], "period": [str(rnd.randrange(300)) for _ in range(size // 5)]}[kind]
            words = (words * size)[:size] if kind == "one" else words * 6 if kind == "period" else words
        start = time.perf_counter()
        periods.find_runs([w.encode() for w in words[:size]])
        took.append(time.perf_counter() - start)
    assert took[1] < 30 * took[0] + 1  # 8 times the words; their square would be 64


def test_best_run_and_collapsed_words():
    assert periods.best_run([]) is None
    assert periods.best_run([(0, 30, 10), (5, 35, 10), (6, 46, 2), (50, 90, 2), (50, 130, 4)]) == (6, 46, 2)
    words = [str(i).encode() for i in range(60)]
    runs = [(0, 24, 3), (10, 40, 4), (50, 60, 2)]
    assert periods.collapsed(words, runs) == b" ".join([*words[:3], *words[40:52]])
    assert periods.collapsed([], []) == b""


def _expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _runs(words)
    best = min(runs, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2])) if runs else None
    dropped = {i for s, e, q in runs for i in range(s + q, e)}
    sha = lambda t: sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *((best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4),
        sha("".join(f"{s},{e - s},{q}\n" for s, e, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_rows_against_the_contract(spark, texts, tmp_path):
    rnd = random.Random(6)
    spaces = [" ", "\n", "\t\r", "\x0b", "\x0c "]
    more = ["\x1c", "é", "\x85", "漢\x1fx"]
    rows = [(i, "".join(w + rnd.choice(spaces) for w in [*_words(rnd, rnd.randint(0, 150)), rnd.choice(more)])) for i in range(400)]
    rows += [(400, None), (401, ""), (402, " \n"), (None, "a " * 30), (7, "x y z " * 9), (7, "x y z " * 9)]
    texts(rows).write.parquet(f"{tmp_path}/documents.parquet")
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).select(names).collect()]
    assert sorted(map(str, got)) == sorted(str(_expected(i, t)) for i, t in rows)
    assert periods.periodic_runs(texts([])).collect() == []
    long = periods.periodic_runs(texts([(1, "a b c " * 100_000)])).first()
    assert [tuple(r) for r in long.runs] == [(0, 300_000, 3)] and long.collapsed == "a b c"
