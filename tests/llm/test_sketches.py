"""Paragraph sketches: likeness against sets of paragraphs, edited texts, retries."""

import random
import re
from base64 import b64decode
from hashlib import sha256

import pytest

from tallyweek.llm import sketches


def _paragraphs(text):
    lines = [line for line in text.split("\n") if line]
    return {p for line in lines for p in re.split(r"(?<=[.!?]) ", line)}


def _likeness(a, b):
    a, b = _paragraphs(a), _paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize(("load", "steps"), [(2, 12), (12, 5)])  # the second overfills its cells and retries
def test_against_sets(texts, load, steps, monkeypatch):
    monkeypatch.setattr(sketches, "LOAD", load)
    monkeypatch.setattr(sketches, "STEPS", steps)
    rnd = random.Random(6)
    lines = [f"paragraph {i} é" for i in range(60)]
    rows = [(i * 3, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 25)))) for i in range(40)]
    rows += [(500, None), (501, ""), (502, "One sentence. " * 90 + "Last one"), (503, "y" * 3000), (504, "\n\n"), (505, rows[4][1])]
    got = {r.id: r for r in sketches.fingerprints(texts(rows)).collect()}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), sha256(edited.encode()).hexdigest())
        assert got[i].near_edited == pytest.approx(_likeness(text, edited))
        assert got[i].near_next == pytest.approx(_likeness(text, after))
    assert got[505].fingerprint == got[12].fingerprint != got[502].fingerprint


def test_repeated_null_and_single_rows(texts):
    got = sketches.fingerprints(texts([(None, "a"), (None, "a"), (3, "b"), (3, "b")])).collect()
    assert sorted(str(r.id) for r in got) == ["3", "3", "None", "None"]
    alone = sketches.fingerprints(texts([(1, "x\ny")])).collect()
    assert [(r.near_next, r.n_chars) for r in alone] == [(1.0, 3)]
    assert sketches.fingerprints(texts([])).collect() == []


def _chained(*values):
    """Spark's xxhash64 of several values."""
    import xxhash

    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else (v % 2 ** (32 if abs(v) < 1000 and v in range(3) else 64)).to_bytes(4 if v in range(3) else 8, "little")
        seed = xxhash.xxh64(data, seed=seed).intdigest()
    return seed


def _signed(n):
    return n - 2**64 if n >= 2**63 else n


def _read(fingerprint):
    """(digests, cells per table, {cell: [count, key, check]}) of a printed sketch."""
    n, size, cells = fingerprint.split("-", 2)
    out = {}
    for cell, count, sums in (x.split(".") for x in cells.split(",") if x):
        data = b64decode(sums + "==")
        out[int(cell)] = [int(count), int.from_bytes(data[:8]), int.from_bytes(data[8:16])]
    return int(n), int(size), out


def _folded(cells, size):
    out = {}
    for cell, (count, key, check) in cells.items():
        to = out.setdefault(cell // 3 % size * 3 + cell % 3, [0, 0, 0])
        to[:] = to[0] + count, to[1] ^ key, to[2] ^ check
    return out


def _peel(cells, size):
    """{digest: count} of a sketch's cells, and whether nothing is left."""
    cells, out = {c: list(v) for c, v in cells.items()}, {}
    while pure := next((v[:] for v in cells.values() if abs(v[0]) == 1 and _chained(_signed(v[1]), "check") == v[2]), None):
        count, key, check = pure
        out[key] = count
        for j in range(3):
            cell = cells[_signed(_chained(_signed(key), j)) % size * 3 + j]
            cell[:] = cell[0] - count, cell[1] ^ key, cell[2] ^ check
    return out, all(v == [0, 0, 0] for v in cells.values())


def test_fingerprints_hold_the_differences(texts):
    """Where the two returned fingerprints peel, the likeness follows from them alone."""
    rnd = random.Random(7)
    rows = [(i, " ".join(f"Sentence {rnd.randint(0, 400)} of them." for _ in range(n))) for i, n in enumerate([3, 40, 300, 300, 150, 90, 60])]
    peeled = 0
    for r in sketches.fingerprints(texts(rows)).collect():
        (n, size, one), (m, other, two) = _read(r.fingerprint), _read(r.edited_fingerprint)
        assert n == len(_paragraphs(dict(rows)[r.id])) and 2 * size >= n and sum(v[0] for v in one.values()) == 3 * n
        small = min(size, other)
        one, two = _folded(one, small), _folded(two, small)
        apart = {c: [one.get(c, [0] * 3)[0] - two.get(c, [0] * 3)[0], *(x ^ y for x, y in zip(one.get(c, [0] * 3)[1:], two.get(c, [0] * 3)[1:]))] for c in one.keys() | two.keys()}
        found, whole = _peel(apart, small)
        peeled += whole
        if whole:
            assert r.near_edited == pytest.approx((n + m - len(found)) / (n + m + len(found)))
    assert peeled >= 3


def test_fingerprints_are_smaller_than_prose(texts):
    rnd = random.Random(9)
    rows = [(i, " ".join("The %s of number %d went to the market again today." % (rnd.choice(["cat", "house"]), rnd.randint(0, 9**6)) for _ in range(400))) for i in range(4)]
    assert all(len(r.fingerprint) < r.n_chars for r in sketches.fingerprints(texts(rows)).collect())


def test_very_long_and_equal_texts(texts):
    rnd = random.Random(10)
    long = "\n".join(f"line {rnd.randint(0, 10**9)}" for _ in range(30_000))
    got = {r.id: r for r in sketches.fingerprints(texts([(1, long), (2, long), (3, "short")])).collect()}
    assert got[1].fingerprint == got[2].fingerprint and got[2].near_next == 1.0 and got[3].near_next == 0.0
    assert got[2].near_edited == pytest.approx(_likeness(long, long[: len(long) - len(long) // 2] + long[: len(long) // 2]))


def test_edits_in_long_lines_leave_the_rest(texts):
    rnd = random.Random(8)
    words = [" ".join(f"w{rnd.randint(0, 999)}" for _ in range(n)) for n in (150, 190, 3000)]
    unspaced = "".join(chr(rnd.randint(0x4E00, 0x9000)) for _ in range(4000))
    sentences = " ".join(f"Here is number {i} of a line." for i in range(30))
    got = {r.id: r for r in sketches.fingerprints(texts([*enumerate(words), (3, unspaced), (4, sentences)])).collect()}
    assert len(sentences) < 1000 and all(got[i].near_edited > 0.1 for i in got), got
