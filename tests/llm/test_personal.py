"""Personal data: the base patterns against a plain reading, checks, and the words around."""

import random
import re
import time
from hashlib import sha256

import pytest

from tallyweek.llm import personal, queries


def _luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _count(text):
    return len(re.sub("[^0-9]", "", text))


PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= _count(m) <= 19 and _luhn(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= _count(m) <= 15),
}


def _base(text):
    return [(kind, *m.span()) for kind, (pattern, ok) in PLAIN.items() for m in re.finditer(pattern, text) if ok(m[0])]


def _card(rnd, size):
    digits = "".join(rnd.choice("0123456789") for _ in range(size - 1))
    return next(digits + c for c in "0123456789" if _luhn(digits + c))


def test_base_spans_against_plain_patterns():
    rnd = random.Random(4)
    parts = ["@", ".", "a.b", "x", "-", "%", "mail@host", ".com", " ", "+", "1", "22", "255", "256", "0001", "(", ")", "é", "٣", "\n", "4111 1111 1111 1111", "+1 (017) 555-7713", "10.0.0."]
    for k in range(6000):
        chosen = parts + [_card(rnd, rnd.randint(15, 20))]
        text = "".join(rnd.choice(chosen) for _ in range(rnd.randint(0, 14)))
        got = [s[:3] for s in personal.spans_of(text) if s[0] in personal.BASE]
        assert got == _base(text), text


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("pay to DE89 3704 0044 0532 0130 00 AND then", "iban", "DE89 3704 0044 0532 0130 00"),
        ("GB82WEST12345698765432.", "iban", "GB82WEST12345698765432"),
        ("GB82WEST12345698765433", "iban", None),
        ("my card 3782 822463 10005 is", "short_card", "3782 822463 10005"),
        ("number 3782 822463 10005 is", "short_card", None),
        ("my card 3782 822463 10006 is", "short_card", None),
        ("SSN: 536-22-1234", "ssn", "536-22-1234"),
        ("SSN: 666-22-1234", "ssn", None),
        ("part 536-22-1234", "ssn", None),
        ("NHS number 943 476 5919", "health", "943 476 5919"),
        ("NHS number 943 476 5918", "health", None),
        ("Steuernummer 86 095 742 719", "tax", "86 095 742 719"),
        ("routing 021000021", "routing", "021000021"),
        ("routing 021000022", "routing", None),
        ("IMEI 49-015420-323751-8", "device", "49-015420-323751-8"),
        ("call (415) 555-2671 now", "local_phone", "(415) 555-2671"),
        ("call 115-555-2671 now", "local_phone", None),
        ("invoice 415-555-2671", "local_phone", None),
        ("test: call 415-555-2671", "local_phone", None),
        ("born 12/05/1980 in", "birth", "12/05/1980"),
        ("geboren 1980-05-12", "birth", "1980-05-12"),
        ("released 12/05/1980 in", "birth", None),
        ("born 32/13/1980 in", "birth", None),
    ],
)
def test_checks_and_words_around(text, kind, found):
    assert [text[a:b] for k, a, b, _ in personal.spans_of(text) if k == kind] == ([found] if found else [])


def test_added_spans_meet_no_base_span():
    text = "tel +1 (415) 555-2671, tel (415) 555-2671"
    assert [(k, text[a:b]) for k, a, b, _ in personal.spans_of(text)] == [("phone", "+1 (415) 555-2671"), ("local_phone", "(415) 555-2671")]
    kept = personal.without_overlaps([("ssn", 5, 9, 0.7), ("tax", 5, 8, 0.9), ("iban", 8, 12, 0.8), ("birth", 20, 25, 0.5)], [(0, 3), (1, 2), (24, 30)])
    assert kept == [("tax", 5, 8, 0.9), ("iban", 8, 12, 0.8)]


@pytest.mark.parametrize("part", ["a", "a.", "1", "1.", "1 ", "1-", "+1 ", "+1(", "a@", "a@b", "é", "A1", "DE89 ", "12/", "4111 1111 1111 1111, "])
def test_long_texts_take_linear_time(part):
    took = []
    for size in (100_000, 800_000):
        start = time.perf_counter()
        personal.spans_of((part * size)[:size])
        took.append(time.perf_counter() - start)
    assert took[1] < 24 * took[0] + 0.5  # 8 times the text; its square would be 64


def test_rows(spark, texts, tmp_path):
    rows = [(1, "é a.b@c.de 10.0.0.1"), (2, None), (3, ""), (None, "+1 (017) 555-7713"), (1, "clean"), (1, "clean"), (4, "x " * 100_000 + "4111111111111111")]
    got = sorted((str(r.id), [tuple(s)[:3] for s in r.spans]) for r in personal.find_personal(texts(rows)).collect())
    assert got == sorted((str(i), _base(t or "")) for i, t in rows)
    texts(rows).write.parquet(f"{tmp_path}/documents.parquet")
    by_id = {r.doc_id: r for r in queries.op11_personal_data(spark, str(tmp_path)).collect() if r.doc_id in (2, 4)}
    assert (by_id[2].base_sha256, by_id[2].spans, by_id[2].n_card) == (sha256(b"").hexdigest(), "", 0)
    assert (by_id[4].base_sha256, by_id[4].n_card) == (sha256(b"card:200000:200016").hexdigest(), 1)
    assert personal.find_personal(texts([])).collect() == []
