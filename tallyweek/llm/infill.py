"""Fill-in-middle: whole texts cut at two unit boundaries and put in another order.

A text becomes a wavelet matrix over the classes of its characters: whether one is white space, a
line break, and the last of its run. The number of units that end before a place is a sum of class
ranks, and a bisection on these ranks finds the place where a wanted number of units has ended.
The draws come from a digest of seed and id alone, so a rerun task cuts at the same places.

Defined results: null texts count as empty; empty texts, and those that contain a marker, stay
plain; a null id draws as an empty one; repeated rows are each returned; other columns are ignored,
whatever their names; an empty table gives an empty result. Places are code points.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweek.llm.shared import values

#: The markers before prefix, suffix and middle, and the white space of the units.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

#: The bits of a class.
LAST, BREAK, SPACE = 1, 2, 4
#: The classes at whose characters a unit ends; what follows the last of them is a unit as well.
UNITS = {"words": [LAST], "lines": [SPACE | BREAK, SPACE | BREAK | LAST], "characters": list(range(8))}

_CLASS = np.zeros(256, np.uint8)
_CLASS[list(SPACES)] = SPACE
_CLASS[ord("\n")] = SPACE | BREAK
_BLOCK = 512


def character_classes(text: str) -> np.ndarray:
    """The class of every code point."""
    data = np.frombuffer(text.encode(), np.uint8)
    classes = _CLASS[data[(data & 0xC0) != 0x80]]
    ends = np.ones(len(classes), bool)
    ends[:-1] = (classes[1:] ^ classes[:-1]) & SPACE != 0
    return classes | ends * np.uint8(LAST)


class Bits:
    """Packed bits with the number of ones before every block of 512."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits)
        self.packed = np.concatenate([packed, np.zeros(-len(packed) % (_BLOCK // 8) + 1, np.uint8)])
        ones = np.bitwise_count(self.packed[:-1]).reshape(-1, _BLOCK // 8).sum(axis=1, dtype=np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)]).tolist()

    def rank(self, i: int) -> int:
        """Ones before place i."""
        block, at = i // _BLOCK, i // 8
        count = self.before[block] + (int.from_bytes(self.packed[block * _BLOCK // 8 : at].tobytes()).bit_count())
        return count + (int(self.packed[at]) >> (8 - i % 8)).bit_count()


class WaveletMatrix:
    """Ranks of small symbols: one row of bits a level, zeros before ones at the next."""

    def __init__(self, symbols: np.ndarray, levels: int) -> None:
        self.rows: list[tuple[int, Bits, int]] = []
        for level in reversed(range(levels)):
            ones = (symbols >> level & 1).astype(bool)
            zeros = symbols[~ones]
            self.rows.append((level, Bits(ones), len(zeros)))
            symbols = np.concatenate([zeros, symbols[ones]])
        self.first = [self._down(s, 0) for s in range(1 << levels)]

    def _down(self, symbol: int, i: int) -> int:
        for level, bits, zeros in self.rows:
            i = zeros + bits.rank(i) if symbol >> level & 1 else i - bits.rank(i)
        return i

    def rank(self, symbol: int, i: int) -> int:
        """How often the symbol occurs before place i."""
        return self._down(symbol, i) - self.first[symbol]


class Boundaries:
    """The unit boundaries of a text."""

    def __init__(self, text: str, unit: str = "words") -> None:
        classes = character_classes(text)
        self.size, self.ends = len(classes), UNITS[unit]
        self.matrix = WaveletMatrix(classes, 3)
        self.rest = self.size > 0 and int(classes[-1]) not in self.ends
        self.units = self.before(self.size)

    def before(self, place: int) -> int:
        """Units that end at or before a place."""
        ended = sum(self.matrix.rank(c, place) for c in self.ends)
        return ended + (self.rest and place == self.size)

    def place(self, units: int) -> int:
        """The first place at which so many units have ended."""
        return bisect_left(range(self.size), units, key=self.before)


def arranged(form: str, prefix: str, middle: str, suffix: str) -> str:
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def restored(output: Column, form: Column) -> Column:
    """The text that was put in order, from the order alone: no marker occurs in a text that was cut."""
    psm = F.regexp_replace(output, f"(?s)^{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)$", "$1$3$2")
    spm = F.regexp_replace(output, f"(?s)^{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)$", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def _draw(digest: Column, k: int) -> Column:
    """The k-th group of eight hex digits as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint")


def fill_in_middle(
    docs: DataFrame, seed: int = 42, cut_percent: int = 50, spm_percent: int = 80, unit: str = "words",
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Rows (id, n, form, prefix_chars, middle_chars, output) for every document.

    ``n`` counts units; ``form`` is plain, psm or spm. Prefix and middle end after the smaller and
    the larger of two draws from 0 to n; their sizes are null where the form is plain."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (text == "") | marked | (_draw(digest, 2) % 100 >= cut_percent)
    form = F.when(plain, "plain").when(_draw(digest, 3) % 100 < spm_percent, "spm").otherwise("psm")
    rows = docs.select(
        F.col(id_col).alias("id"), text.alias("text"), form.alias("form"),
        _draw(digest, 0).alias("one"), _draw(digest, 1).alias("two"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, form, one, two in values(batch.select(["text", "form", "one", "two"])):
                bounds = Boundaries(text, unit)
                n = bounds.units
                if form == "plain":
                    out.append((n, None, None, text))
                    continue
                first, second = (bounds.place(units) for units in sorted((one % (n + 1), two % (n + 1))))
                out.append((n, first, second - first, arranged(form, text[:first], text[first:second], text[second:])))
            n, prefix, middle, output = zip(*out, strict=True) if out else ((),) * 4
            columns = [pa.array(n, pa.int64()), batch.column("form"), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns, pa.array(output, pa.string())], names=names)

    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
