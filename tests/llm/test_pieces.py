"""The SentencePiece transducer against the library, and exact round trips."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tallyweek.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("remembered", [300_000, 20])
def test_as_the_library(remembered, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", remembered)
    rnd, alphabet = random.Random(3), "aeithns  lorde\né▁ß日本0123456789.,_-#"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(700)]
    texts += ["", "   ", " a", "a ", "  a  b", "\n", "日本語 😀 ﬁ", "<s> </s> <unk> <0x41>", "a" * 29, "=" * 50, " " * 40 + "x"]
    library, own = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.Transducer(MODEL)
    for text in texts:
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text), text
        if pieces.MARK not in text:  # the mark itself reads back as a space
            assert own.decode(ids) == text


def test_least_weight_path_of_a_unigram_model():
    own = pieces.Transducer(MODEL)
    own.kind, own.weights = pieces.UNIGRAM, {"a": 3.0, "b": 3.0, "ab": 4.0, "abc": 9.0, "c": 2.0}
    assert own.shortest_path("abc") == ["ab", "c"]
    assert own.shortest_path("aqb") == ["a", "q", "b"]


def test_rows(texts):
    rows = [(1, "some text"), (2, None), (3, ""), (None, "a\nb  c"), (1, "some text"), (4, "x yz " * 40_000)]
    coded = pieces.encode(texts(rows), MODEL)
    back = sorted((str(r.id), r.text) for r in pieces.decode(coded, MODEL).collect())
    assert back == sorted((str(i), t or "") for i, t in rows)
    assert all(r.restored for r in pieces.round_trip(texts(rows), MODEL).collect())
    assert pieces.encode(texts([]), MODEL).collect() == [] and pieces.round_trip(texts([]), MODEL).collect() == []
