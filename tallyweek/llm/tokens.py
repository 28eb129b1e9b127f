"""Token ids of whole texts by a public tokenizer file, with a bounded memory of words."""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa

from tallyweek.llm.shared import portions

#: Bytes of words remembered since the memory last started anew, with what an entry takes besides its
#: word and ids. The words before that are kept too, until it starts anew again.
REMEMBERED, ENTRY = 50_000_000, 180
#: Most texts, and bytes of them, whose words are looked up together, new words encoded as one text, and in one call.
TEXTS, PORTION, WORDS, CALL = 4096, 8 << 20, 200, 4000
#: Bytes of texts that are cut into words and put together from ids at once: numbers of every byte are held.
BLOCK = 1 << 19
#: Marks cut off the end of a word; they never share a token with the letter before them.
MARKS = b".,!?;:#$%&*"


def _bytes_in(some: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(some)] = True
    return table


_SPACE, _MARK = _bytes_in(b" \t\n\r\x0b\x0c"), _bytes_in(MARKS)
_PLAIN = _bytes_in(bytes([*range(48, 58), *range(65, 91), *range(97, 123)]))


def cut_words(texts: Sequence[bytes]) -> tuple[pa.BinaryArray, np.ndarray]:
    """The words between ASCII spaces of texts of less than 2 GB together, and how many each text has. A word
    also begins at a mark after an ASCII letter or digit, where a space changes no token."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(sizes) - sizes
    solid = ~_SPACE[data]
    first = np.empty(len(data), bool)
    first[:1] = True
    first[1:] = ~solid[:-1] | (_MARK[data[1:]] & _PLAIN[data[:-1]])
    first[begins[sizes > 0]] = True
    at = np.flatnonzero(first & solid)
    places = np.concatenate([np.cumsum(solid, dtype=np.int32)[at] - 1, [np.count_nonzero(solid)]]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(places), pa.py_buffer(data[solid])])
    return words, np.searchsorted(at, begins + sizes) - np.searchsorted(at, begins)


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> tuple:
    """The tokenizer, and which ids end a word."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core, and threads hold memory
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    vocabulary = tokenizer.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    return tokenizer, ends


def _letters(text: str) -> bool:
    """Only letters that stay letters in lower case and composed form."""
    return text.isalpha() and (text.isascii() or (max(text) < "ɐ" and "İ" not in text))


class WordEncoder:
    """Encodes texts with a tokenizer that splits at white space, drops it and lowers case.

    The ids of a text are then those of its words between ASCII spaces, one after another. A word
    is looked up as it stands, else as its plain form (small ASCII letters) and the marks after
    it; only unknown plain forms are encoded, many in a call. Memory is bounded by the words of a
    portion and twice REMEMBERED bytes.
    """

    def __init__(self, path: str):
        self._tokenizer, self._ends = _tokenizer(path)
        self._known: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}
        self._size = 0

    @staticmethod
    def _parts(word: bytes) -> tuple[bytes, bytes]:
        base = word.rstrip(MARKS)
        if base.isascii():
            if len(base) < len(word) and not base[-1:].isalpha():
                base = word
            marks = word[len(base) :]
            return (base if b"<|" in base else base.lower()), marks
        if len(base) < len(word):
            # A letter below U+0250 has two bytes at most; the end of any other isn't one.
            last = base[-2:] if base[-1] > 127 else base[-1:]
            if not _letters(last.decode("utf-8", "replace")):
                base = word
        return base, word[len(base) :]

    def _encode_plain(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8", "replace") for w in words]
        simple = [k for k, t in enumerate(texts) if _letters(t)]
        groups = [simple[a : a + WORDS] for a in range(0, len(simple), WORDS)]
        done: set[int] = set()
        for at in range(0, len(groups), CALL // WORDS):
            some = groups[at : at + CALL // WORDS]
            coded = self._tokenizer.encode_batch_fast([" ".join(texts[k] for k in g) for g in some], add_special_tokens=False)
            for group, code in zip(some, coded):
                ids = np.array(code.ids, "<u4")
                cuts = np.flatnonzero(self._ends[ids]) + 1
                if len(cuts) == len(group):
                    data, begin = ids.tobytes(), 0
                    for k, end in zip(group, (4 * cuts).tolist()):
                        self._known[words[k]] = data[begin:end]
                        begin = end
                    done.update(group)
        rest = [k for k in range(len(words)) if k not in done]
        for at in range(0, len(rest), CALL):
            some = rest[at : at + CALL]
            for k, code in zip(some, self._tokenizer.encode_batch([texts[k] for k in some], add_special_tokens=False)):
                self._known[words[k]] = np.array(code.ids, "<u4").tobytes()

    def _learn(self, words: set[bytes]) -> None:
        known, older, parts = self._known, self._older, self._parts
        before = len(known)
        if older:
            again = words.intersection(older)
            known.update(zip(again, map(older.__getitem__, again)))
            words = words - again
        plain = {w for w in words if w.isalpha() and w.islower()}  # of bytes: small ASCII letters
        other = [(w, *parts(w)) for w in words - plain]
        plain.update(base for _, base, _ in other)
        plain.update(marks for _, _, marks in other if marks)
        new = [w for w in plain if w not in known]
        if older:
            known.update((w, older[w]) for w in new if w in older)
            new = [w for w in new if w not in known]
        if new:
            self._encode_plain(new)
        for word, base, marks in other:
            if marks:
                known[word] = known[base] + known[marks]
            elif word is not base:
                known[word] = known[base]
        added = len(known) - before
        for part in (known.keys(), known.values()):
            self._size += sum(map(len, islice(reversed(part), added)))
        self._size += ENTRY * added

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of some different words."""
        if self._size > REMEMBERED:
            self._older, self._known, self._size = self._known, {}, 0
        strange = {w for w in words if w not in self._known}
        if strange:
            self._learn(strange)
        return list(map(self._known.__getitem__, words))

    def encode(self, texts: Sequence[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text as little-endian unsigned 32-bit numbers."""
        out: list[bytes] = []
        for some in portions(texts, PORTION, TEXTS):
            blocks = [cut_words(block) for block in portions(some, BLOCK)]
            coded = pa.concat_arrays([words for words, _ in blocks]).dictionary_encode()
            ids = self._ids(coded.dictionary.to_pylist())
            lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            begins = np.cumsum(lengths) - lengths
            joined, at = np.frombuffer(b"".join(ids), "<u4"), 0
            for words, counts in blocks:
                which = coded.indices.slice(at, len(words)).to_numpy()
                at += len(words)
                before = np.concatenate([[0], np.cumsum(lengths[which])])
                # Each word's ids are taken from where they begin, as many as it has.
                place = np.repeat(begins[which] - before[:-1], lengths[which])
                place += np.arange(before[-1])
                found = joined[place]
                bounds = before[np.concatenate([[0], np.cumsum(counts)])].tolist()
                out += [found[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
        return out


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """The encoder of a worker process, whose tasks run one after another and share its memory."""
    return WordEncoder(path)
