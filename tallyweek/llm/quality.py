"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded: counts of character and word kinds,
repetition, and hashed letter triples go through a small dense layer. Gated attention (a tanh
branch times a sigmoid branch) weighs the passages, and a logistic unit scores the weighted sum.
Only documents have labels; which passages matter is learned from them.

Training uses a bounded sample of labelled documents; scoring reads every passage of every text.

Defined results: a null or empty text is one passage without characters and gets a score like any
other; a document's repeated labels count by their mean; labels that are null, or whose document
is missing, are ignored; without any label of both kinds every score is the share of label 1, or
0.5; repeated and null ids keep their rows; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.llm.shared import portions, text_bytes, tidy

#: Bytes of a passage; it ends at the next white space.
PASSAGE = 512
#: The documented bounds of the training sample: labelled documents, and passages taken evenly from each.
TRAINING_DOCS, TRAINING_PASSAGES = 6000, 32
TRIPLES, HIDDEN, GATE = 48, 24, 12
ROUNDS, RATE, DECAY, SMALL_BATCH = 12, 0.01, 1e-4, 128
THRESHOLD = 0.7
#: Bytes of text whose passages are counted at once.
PORTION = 1 << 18

_MARKS = b"\n.,;:!?|#$%&*\"'()/<>=_-+@"
_KINDS = len(_MARKS) + 6


def _kind_table() -> np.ndarray:
    """Byte -> kind: each mark, lower case, capitals, digits, white space, beyond ASCII, the rest."""
    table = np.full(256, _KINDS - 1)
    for base, some in enumerate((range(97, 123), range(65, 91), range(48, 58), (32, 9, 13, 11, 12), range(128, 256))):
        table[list(some)] = len(_MARKS) + base
    for k, mark in enumerate(_MARKS):
        table[mark] = k
    return table


_TABLE = _kind_table()
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
FEATURES = _KINDS + 6 + TRIPLES


def passage_starts(data: np.ndarray) -> np.ndarray:
    """The first byte of each passage of one text."""
    if len(data) <= PASSAGE:
        return np.zeros(1, np.int64)
    spaces = np.flatnonzero((data == 32) | (data == 10)) + 1
    after = np.searchsorted(spaces, np.arange(PASSAGE, len(data), PASSAGE))
    cuts = spaces[after[after < len(spaces)]]
    return np.unique(np.concatenate([[0], cuts[cuts < len(data)]]))


def _features(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row per passage; the passages follow each other in the data, and may be empty."""
    n = len(starts)
    sizes = np.diff(np.append(starts, len(data)))
    of = np.repeat(np.arange(n), sizes)
    share = np.maximum(sizes, 1)[:, None]
    out = np.zeros((n, FEATURES))
    out[:, :_KINDS] = np.bincount(of * _KINDS + _TABLE[data], minlength=n * _KINDS).reshape(n, _KINDS) / share
    if not len(data):
        return out
    folded = _FOLD[data]
    space = (data == 32) | ((data >= 9) & (data <= 13))
    first = ~space & np.concatenate([[True], space[:-1]])
    first |= ~space & np.concatenate([[True], of[1:] != of[:-1]])
    at = np.flatnonzero(first)
    words = np.bincount(of[at], minlength=n)
    many = np.maximum(words, 1)
    # A word's hash: the sum of its bytes' random numbers by place.
    place = np.arange(len(data)) - at[np.maximum(np.cumsum(first) - 1, 0)] if len(at) else np.zeros(len(data), np.int64)
    mixed = ((folded + np.uint32(1)) * np.uint32(2654435761) ^ (place.astype(np.uint32) * np.uint32(40503))) * np.uint32(2246822519)
    mixed[space] = 0
    sums = np.add.reduceat(mixed.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    word_of = of[at]
    k = _KINDS
    out[:, k] = (sizes - np.bincount(of[space], minlength=n)) / many / 10
    if len(at):
        order = np.lexsort((sums, word_of))
        new = np.concatenate([[True], (np.diff(sums[order]) != 0) | (np.diff(word_of[order]) != 0)])
        out[:, k + 1] = np.bincount(word_of[order][new], minlength=n) / many
        again = np.concatenate([[False], (np.diff(sums) == 0) & (np.diff(word_of) == 0)])
        out[:, k + 2] = np.bincount(word_of[again], minlength=n) / many
        pairs = sums[:-1] * 31 + sums[1:]
        inside = np.diff(word_of) == 0
        pair_of, pairs = word_of[:-1][inside], pairs[inside]
        order = np.lexsort((pairs, pair_of))
        new = np.concatenate([[True], (np.diff(pairs[order]) != 0) | (np.diff(pair_of[order]) != 0)])[: len(pairs)]
        out[:, k + 3] = np.bincount(pair_of[order][new], minlength=n) / many
        capital = (data[at] >= 65) & (data[at] <= 90)
        out[:, k + 4] = np.bincount(word_of[capital], minlength=n) / many
    out[:, k + 5] = np.log1p(sizes) / 7
    triple = (folded[:-2] * np.uint32(31) + folded[1:-1]) * np.uint32(31) + folded[2:] if len(data) > 2 else np.zeros(0, np.uint32)
    slot = ((triple * np.uint32(2654435761)) >> np.uint32(16)) % np.uint32(TRIPLES)
    whole = of[: len(slot)] == of[2:]
    counts = np.bincount(of[: len(slot)][whole] * TRIPLES + slot[whole], minlength=n * TRIPLES).reshape(n, TRIPLES)
    out[:, k + 6 :] = np.sqrt(counts / share)
    return out


def encode_passages(texts: pa.Array | Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, number of passages of each text), for portions of the texts in order."""
    for some in portions(texts, PORTION):
        starts, counts, base = [], [], 0
        for text in some:
            own = passage_starts(np.frombuffer(text, np.uint8))
            starts.append(own + base)
            counts.append(len(own))
            base += len(text)
        yield _features(np.frombuffer(b"".join(some), np.uint8), np.concatenate(starts)), np.array(counts)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


@dataclass
class Model:
    """The weights: encoder, attention branches, attention, output."""

    mean: np.ndarray
    spread: np.ndarray
    weights: list[np.ndarray]

    def forward(self, x: np.ndarray, counts: np.ndarray) -> tuple:
        w1, b1, v, u, w, c, b = self.weights
        x = np.clip((x - self.mean) / self.spread, -8, 8)
        h = np.tanh(x @ w1 + b1)
        left, right = np.tanh(h @ v), _sigmoid(h @ u)
        e = (left * right) @ w
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        bag = np.repeat(np.arange(len(counts)), counts)
        a = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a /= np.add.reduceat(a, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return x, h, left, right, a, bag, starts, z, _sigmoid(z @ c + b[0])

    def scores(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.forward(x, counts)[-1]

    def gradients(self, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        w1, b1, v, u, w, c, b = self.weights
        x, h, left, right, a, bag, starts, z, p = self.forward(x, counts)
        d = (p - y) / len(y)
        dz = d[:, None] * c
        da = (dz[bag] * h).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, starts)[bag])
        gated = de[:, None] * w
        dl, dr = gated * right * (1 - left**2), gated * left * right * (1 - right)
        dh = a[:, None] * dz[bag] + dl @ v.T + dr @ u.T
        dx = dh * (1 - h**2)
        return [x.T @ dx, dx.sum(axis=0), h.T @ dl, h.T @ dr, (left * right).T @ de, z.T @ d, np.array([d.sum()])]


def train(bags: Sequence[np.ndarray], labels: np.ndarray) -> Model:
    """Adam over small batches of documents, always in the same order."""
    rng = np.random.default_rng(11)
    rows = np.concatenate(bags)
    shape = [(FEATURES, HIDDEN), (HIDDEN,), (HIDDEN, GATE), (HIDDEN, GATE), (GATE,), (HIDDEN,), (1,)]
    weights = [rng.normal(0, 1 / np.sqrt(s[0]), s) if i != 1 else np.zeros(s) for i, s in enumerate(shape)]
    weights[-1][:] = 0
    model = Model(rows.mean(axis=0), rows.std(axis=0) + 1e-3, weights)
    first, second, step = [np.zeros(s) for s in shape], [np.zeros(s) for s in shape], 0
    for turn in range(ROUNDS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), SMALL_BATCH):
            chosen = order[at : at + SMALL_BATCH]
            found = model.gradients(np.concatenate([bags[i] for i in chosen]), np.array([len(bags[i]) for i in chosen]), labels[chosen])
            step += 1
            rate = RATE * 0.5 * (1 + np.cos(np.pi * turn / ROUNDS))
            for k, g in enumerate(found):
                g = g + DECAY * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                weights[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", docs_limit: int = TRAINING_DOCS) -> Callable:
    """A function (features, counts) -> scores, learned from at most ``docs_limit`` labelled
    documents, those with the smallest hashes of their ids."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    known = known.agg(F.avg(F.col(label_col).cast("double")).alias("label"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(docs_limit)
    # The sample's size is bounded by the parameter.
    rows = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text")).join(F.broadcast(sample), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, counts in encode_passages(batch.column(1)):
                for bag in np.split(x, np.cumsum(counts)[:-1]):
                    few = np.unique(np.linspace(0, len(bag) - 1, TRAINING_PASSAGES).astype(int))
                    kept.append(bag[few].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(kept, pa.binary())], names=["id", "label", "bag"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = rows.select("id", "text", "label").mapInArrow(tidy(run), f"id {kind}, label double, bag binary")
    # A repeated id could outgrow the bound; one of its texts is taken.
    taken = found.groupBy("id").agg(F.min("label").alias("label"), F.min("bag").alias("bag")).orderBy(F.xxhash64("id"), "id").limit(docs_limit).collect()
    y = np.array([r["label"] for r in taken])
    if not len(y) or (y > 0.5).all() or (y <= 0.5).all():
        share = float(y.mean()) if len(y) else 0.5
        return lambda x, counts: np.full(len(counts), share)
    return train([np.frombuffer(r["bag"], "<f4").reshape(-1, FEATURES).astype(float) for r in taken], y).scores


def score(docs: DataFrame, scorer: Callable, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Rows (id, score, *keep): the score of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [scorer(x, counts) for x, counts in encode_passages(batch.column(1))]
            scores = pa.array(np.concatenate(parts) if parts else np.zeros(0))
            yield pa.RecordBatch.from_arrays([batch.column(0), scores, *batch.columns[2:]], schema=pa.schema([batch.schema.field(0), ("score", pa.float64()), *list(batch.schema)[2:]]))

    rows = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("__text"), *keep)
    kind = docs.schema[id_col].dataType.simpleString()
    more = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(tidy(run), f"id {kind}, score double{more}")
