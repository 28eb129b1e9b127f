"""Repeated byte strings against a count of all windows."""

import random
from collections import Counter

import pytest

from tallyweek.llm import repeats


def _brute_force(texts, length):
    data = [(t or "").encode() for t in texts]
    windows = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if windows[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        out.append((len(t), sum(gone), bytes(b for b, g in zip(t, gone) if not g)))
    return out


def _corpus(rnd):
    passages = ["".join(rnd.choice("abc") for _ in range(rnd.randint(10, 60))) for _ in range(8)]
    texts = []
    for _ in range(90):
        parts = [rnd.choice([rnd.choice(passages), "".join(rnd.choice("abcdefgü") for _ in range(rnd.randint(1, 20)))]) for _ in range(rnd.randint(0, 8))]
        texts.append("".join(parts))
    return [*texts, "xy" * 20, "a" * 100, "a" * 100, "", None, "zz", texts[3]]


@pytest.mark.parametrize(("bucket", "slice_size"), [(8192, 1 << 19), (3, 1 << 19), (8192, 37)])
def test_against_brute_force(texts, bucket, slice_size, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET", bucket)
    monkeypatch.setattr(repeats, "SLICE", slice_size)
    corpus = _corpus(random.Random(bucket))
    got = repeats.remove_repeats(texts(enumerate(corpus)), length=24, gram=8).collect()
    found = {r.id: (r.n_bytes, sum(s.e - s.s for s in r.spans), bytes(r.kept)) for r in got}
    assert [found[i] for i in range(len(corpus))] == _brute_force(corpus, 24)
    for r in got:
        assert all(a.e < b.s for a, b in zip(r.spans, r.spans[1:]))


def test_repeated_and_null_ids(texts):
    passage = "0123456789" * 3
    got = repeats.remove_repeats(texts([(1, passage + "a"), (1, "b" + passage), (None, "c"), (None, "c")]), length=24, gram=8, keep=["row"]).collect()
    assert sorted((str(r.id), bytes(r.kept), r.row) for r in got) == [("1", b"a", 7), ("1", b"b", 7), ("None", b"c", 7), ("None", b"c", 7)]


def test_empty_table(texts):
    assert repeats.remove_repeats(texts([])).collect() == []


def test_prefix_intervals():
    # The suffixes of "banana" have the common prefixes 1 3 0 0 2.
    found = sorted(repeats.prefix_intervals([0, 1, 3, 0, 0, 2]))
    assert found == [(1, 0, 2), (2, 4, 5), (3, 1, 2)]


def test_repeat_groups_need_left_extension():
    rights = [b"shared-tail-1", b"shared-tail-2", b"shared-tail-1"]
    lefts = [b"cba", b"cbx", b"zzz"]
    groups = [(depth, sorted(members.tolist()), best.tolist()) for depth, members, best in repeats.repeat_groups(rights, lefts, 14)]
    assert (12, [0, 1], [2, 2]) in groups
    assert not any(2 in members for depth, members, _ in groups if depth == 12)
