"""Fill-in-middle against plain regular expressions, and the exact way back."""

import random
import re
from hashlib import sha256

import pytest

from tallyweek.llm import infill, queries

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ALPHABET = [" ", "\n", "\t", "\r", "\x0b", "\x0c", "a", "b", "é", "漢", "😀", "\x1c", "\x85", " ", "<", "<P", "<M", "S>"]


def _plain(doc_id, text):
    """The contract, word by word."""
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_ranks_of_a_wavelet_matrix():
    rnd = random.Random(1)
    for size in (0, 1, 7, 8, 511, 512, 513, 3000):
        symbols = [rnd.randrange(8) for _ in range(size)]
        matrix = infill.WaveletMatrix(infill.np.array(symbols, infill.np.uint8), 3)
        for i in {0, size, *(rnd.randint(0, size) for _ in range(40))}:
            assert [matrix.rank(c, i) for c in range(8)] == [symbols[:i].count(c) for c in range(8)]


@pytest.mark.parametrize(("unit", "pattern"), [("words", TOKEN.pattern), ("lines", r"(?s)[^\n]*\n|[^\n]+"), ("characters", r"(?s).")])
def test_places_of_all_boundaries(unit, pattern):
    rnd = random.Random(2)
    for _ in range(300):
        text = "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 40)))
        ends = [0, *(m.end() for m in re.finditer(pattern, text))]
        bounds = infill.Boundaries(text, unit)
        assert bounds.units == len(ends) - 1 and [bounds.place(k) for k in range(len(ends))] == ends, text


def test_rows_against_the_contract(spark, texts, tmp_path):
    rnd = random.Random(3)
    rows = [(i, "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 60)))) for i in range(300)]
    rows += [(300, None), (301, ""), (None, "a b c"), (7, "twice"), (7, "twice"), (302, "word " * 200_000), (303, "x" * 300_000)]
    docs = texts(rows)
    got = [(r.id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in infill.fill_in_middle(docs).collect()]
    order = lambda row: (row[0] is None, row[0] or 0)
    assert sorted(got, key=order) == sorted([(i, *_plain(i, t)) for i, t in rows], key=order)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    digests = {(r.doc_id, r.output_sha256, r.restored_sha256) for r in queries.op13_fill_in_middle(spark, str(tmp_path)).collect()}
    sha = lambda text: sha256(text.encode()).hexdigest()
    assert digests == {(i, sha(_plain(i, t)[-1]), sha(t or "")) for i, t in rows}


def test_other_shares_and_an_empty_table(texts):
    docs = texts([(i, f"one two {i} three\nfour") for i in range(60)])
    forms = [r.form for r in infill.fill_in_middle(docs, cut_percent=100, spm_percent=0, unit="lines").collect()]
    assert forms == ["psm"] * 60
    assert infill.fill_in_middle(texts([])).collect() == []
