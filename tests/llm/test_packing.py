"""Packing: tokens as the library gives them, whole and dense sequences, the sweep and the ranks."""

import random
import re
import tracemalloc
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyweek.llm import packing, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def _best_fit_decreasing(sizes, capacity):
    rooms = []
    for size in sorted(sizes, reverse=True):
        k = bisect_left(rooms, size)
        room = rooms.pop(k) - size if k < len(rooms) else capacity - size
        insort(rooms, room)
    return len(rooms)


@pytest.mark.parametrize(("remembered", "at_once"), [(500_000, 256), (40, 3)])
def test_words_encode_as_whole_texts(remembered, at_once, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", remembered)
    monkeypatch.setattr(tokens, "TEXTS", at_once)
    rnd, alphabet = random.Random(2), "abcXYZ'sSTdD .,!?;:#$%&*<|>é́ßİıΣς—“日0123²½\n\t\x1c\xa0ǅʰªLl"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(800)]
    texts += ["", "x<|endoftext|>y <|ENDOFTEXT|> <|startoftext|>.", "don't I'LL it's'd, he's.", "ΑΣ ΣΑΣ. İstanbul é, ≠. x≮"]
    library = Tokenizer.from_file(PATH)
    got = tokens.WordEncoder(PATH).encode([t.encode() for t in texts])
    assert got == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


@pytest.mark.parametrize("task_rows", [10_000, 60])
@pytest.mark.parametrize("name", ["tiny", "same", "spread", "one"])
def test_items_fill_sequences(spark, task_rows, name, monkeypatch):
    monkeypatch.setattr(packing, "TASK_ROWS", task_rows)
    monkeypatch.setattr(packing, "LAST_ROWS", min(task_rows, packing.LAST_ROWS))
    rounds, one_round = [], packing._round
    monkeypatch.setattr(packing, "_round", lambda *given: rounds.append(1) or one_round(*given))
    rnd = random.Random(1)
    sizes = {
        "tiny": [rnd.randint(1, 3) for _ in range(400)],
        "same": [30] * 99,
        "spread": [min(100, 1 + int(rnd.expovariate(1 / 20))) for _ in range(300)],
        "one": [100],
    }[name]
    got = packing.best_fit(spark.createDataFrame(list(enumerate(sizes)), "item long, size int"), 100).collect()
    assert sorted((r.item, r["size"]) for r in got) == list(enumerate(sizes))
    filled = Counter()
    for r in got:
        filled[r.seq] += r["size"]
    assert max(filled.values()) <= 100
    assert len(filled) <= 1.06 * _best_fit_decreasing(sizes, 100) + 1
    assert bool(rounds) == (len(sizes) > packing.LAST_ROWS)


def test_documents_are_whole(spark, texts):
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["alpha", "beta,", "Gamma!", "δ"]) for _ in range(rnd.randint(0, 60)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "word " * 300), (None, "no id"), (3, "again"), (3, "again")]
    got = packing.pack(texts(rows), PATH, capacity=64).collect()
    library, found = Tokenizer.from_file(PATH), defaultdict(list)
    for r in got:
        found[r.id].append(r)
    expected = Counter()
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[at : at + 64], "<u4")
            expected[i, k, at, len(part), crc32(part.tobytes())] += 1
    assert Counter((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for place in places.values():
        at = 0
        for offset, length in sorted(place):
            assert offset == at
            at += length
        assert at <= 64


def test_empty_table(texts):
    assert packing.pack(texts([]), PATH).collect() == []


def test_leftovers_match_by_rank():
    # Partition 0 has pieces up to 10, partition 1 has pieces of 40 and gaps from 25, 2 has gaps of 90.
    parts = [(0, 5, 10, 0, None), (1, 2, 40, 1, 25), (2, 0, None, 3, 90)]
    matches = packing.match_leftovers(parts)
    assert matches == [(1, 0, 1, 0, 3, 2), (2, 0, 1, 1, 0, 2), (2, 1, 1, 0, 0, 9)]


def test_words_are_cut_at_spaces_and_marks():
    texts = [b"", b" a.b  c,.\x0b1.5,2", "é.é, ü!".encode(), b".x", b" ", b"x\t\n"]
    words, counts = tokens.cut_words(texts)
    expected = [re.sub(rb"(?<=[A-Za-z0-9])([.,!?;:#$%&*])", rb" \1", t).split() for t in texts]
    assert words.to_pylist() == [w for ws in expected for w in ws] and counts.tolist() == [len(ws) for ws in expected]


def test_mostly_short_pieces_open_by_their_tokens():
    """A few long pieces don't keep the many short ones waiting round after round."""
    def measured(sizes, gaps=()):
        tokens_at = {f"tokens_{k}": sum(s for s in sizes if s >= 2**k) for k in range(packing.CLASSES)}
        return {"largest_piece": max(sizes), "largest_gap": max(gaps, default=None), "room": sum(gaps), "tokens": sum(sizes), **tokens_at}

    assert packing.opening(measured([4000, *[100] * 900, *[20] * 400])) == (0, 64)
    assert packing.opening(measured([4000, *[100] * 900, *[20] * 400], gaps=[3000])) == (0, 64)
    assert packing.opening(measured([*[4000] * 50, *[100] * 900])) == (0, 2001)
    assert packing.opening(measured([100] * 900, gaps=[3000])) == (3000, 51)


def test_encoder_works_in_blocks(monkeypatch):
    """Blocks and calls of any size give the same ids, and numbers of every byte are held for one block only."""
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(1, 9))) + rnd.choice(["", ",", ".", "é", "7"]) for _ in range(3000)]
    texts = [" ".join(rnd.choices(words, k=rnd.choice([0, 1, 300]))).encode() for _ in range(200)] + [b"", b" \n ", b"x"]
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = tokens.WordEncoder(path).encode(texts)
    monkeypatch.setattr(tokens, "BLOCK", 50)
    monkeypatch.setattr(tokens, "CALL", 400)
    assert tokens.WordEncoder(path).encode(texts) == whole
    monkeypatch.undo()
    encoder, long = tokens.WordEncoder(path), [" ".join(rnd.choices(words, k=2000)).encode() for _ in range(600)]
    encoder.encode(long)
    tracemalloc.start()
    encoder.encode(long)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 7 * sum(map(len, long))
