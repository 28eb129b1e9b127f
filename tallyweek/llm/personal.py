"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

The base spans (mail and network addresses, payment cards, international phone numbers) follow
fixed patterns and are always listed. Further kinds (bank accounts, shorter cards, social security,
health and tax numbers, routing numbers, device numbers, phones without a country code, dates of
birth) are proposed by their shape, dropped where their check fails, and listed where shape, check
and the words around them together reach ``LEAST_SCORE``.

Defined results: null texts count as empty and have no spans; repeated and null ids keep their
rows; other columns are ignored, whatever their names; an empty table gives an empty result.
Places are code points, ends are exclusive. Every step is linear in the size of a text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweek.llm.shared import values

#: The base kinds in their order, and the kinds that the method adds.
BASE = ["email", "ip", "card", "phone"]
MORE = ["iban", "short_card", "ssn", "health", "tax", "routing", "device", "local_phone", "birth"]
KINDS = BASE + MORE

#: The base patterns, in forms that never read a run of characters twice. The part
#: of a mail address before its sign is found from the sign.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int, float]


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


# Checks: each takes the proposed text.


def luhn(text: str) -> bool:
    """Every second digit from the right counts double, a double of two digits by their sum."""
    digits = [int(c) for c in reversed(digits_of(text))]
    doubled = sum(sum(divmod(2 * d, 10)) for d in digits[1::2])
    return (sum(digits[::2]) + doubled) % 10 == 0


def mod_97(text: str) -> bool:
    """Letters count 10 to 35, country and check digits go last; the whole leaves 1."""
    plain = text.replace(" ", "")
    return len(plain) == IBAN_SIZES.get(plain[:2]) and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def area_group_serial(text: str) -> bool:
    area, group, serial = re.split("[ -]", text)
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def mod_11(text: str) -> bool:
    """Weights 10 to 2 over nine digits; the tenth is what is missing to a multiple of 11."""
    digits = [int(c) for c in digits_of(text)]
    return -sum(w * d for w, d in zip(range(10, 1, -1), digits, strict=False)) % 11 == digits[9]


def eleven_digits(text: str) -> bool:
    """Iterated products modulo 11 and 10; no leading zero."""
    product = 10
    *digits, check = (int(c) for c in digits_of(text))
    for d in digits:
        total = (product + d) % 10 or 10
        product = 2 * total % 11
    return digits[0] != 0 and (11 - product) % 10 == check


def weights_371(text: str) -> bool:
    return sum(w * int(c) for w, c in zip((3, 7, 1) * 3, text, strict=True)) % 10 == 0 and text != "0" * 9


def north_american(text: str) -> bool:
    digits = digits_of(text)
    return digits[0] in "23456789" and digits[3] in "23456789"


def calendar_date(text: str) -> bool:
    parts = [int(p) for p in re.split("[./-]", text)]
    first, second, year = parts if parts[2] > 31 else (parts[2], parts[1], parts[0])
    return 1900 <= year <= 2100 and 1 <= min(first, second) and min(first, second) <= 12 and max(first, second) <= 31


#: The sizes of bank account numbers by country.
IBAN_SIZES = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
    "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27,
    "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24,
    "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}

IBAN = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9]{4})")
ALPHANUMERIC = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")

_NO_DIGIT = r"(?<![\w.-])"
_END = r"(?![\w-]|\.\w)"
#: Kind: pattern, check, score of its shape with the check passed, words that raise it.
PROPOSALS: dict[str, tuple[re.Pattern, Callable[[str], bool], float, str]] = {
    "short_card": (re.compile(rf"{_NO_DIGIT}(?:3[47][0-9]{{2}}(?:[\x20-]?)[0-9]{{6}}[\x20-]?[0-9]{{5}}|3(?:0[0-5]|[68][0-9])[0-9][\x20-]?[0-9]{{6}}[\x20-]?[0-9]{{4}}){_END}"), luhn, 0.4, "card|visa|amex|diners|credit|karte|carte|tarjeta"),
    "ssn": (re.compile(rf"{_NO_DIGIT}[0-9]{{3}}([\x20-])[0-9]{{2}}\1[0-9]{{4}}{_END}"), area_group_serial, 0.3, "ssn|social|security"),
    "health": (re.compile(rf"{_NO_DIGIT}[0-9]{{3}}([\x20-]?)[0-9]{{3}}\1[0-9]{{4}}{_END}"), mod_11, 0.2, "nhs|patient|health"),
    "tax": (re.compile(rf"{_NO_DIGIT}[0-9]{{2}}\x20?[0-9]{{3}}\x20?[0-9]{{3}}\x20?[0-9]{{3}}{_END}"), eleven_digits, 0.2, "tax|tin|steuer|steuernummer|idnr|impuestos"),
    "routing": (re.compile(rf"{_NO_DIGIT}[0-9]{{9}}{_END}"), weights_371, 0.1, "routing|aba|rtn"),
    "device": (re.compile(rf"{_NO_DIGIT}[0-9]{{2}}([\x20-]?)[0-9]{{6}}\1[0-9]{{6}}\1[0-9]{_END}"), luhn, 0.2, "imei|device|handset"),
    "local_phone": (re.compile(rf"{_NO_DIGIT}(?:\([0-9]{{3}}\)\x20?|[0-9]{{3}}[\x20.-])[0-9]{{3}}[\x20.-][0-9]{{4}}{_END}"), north_american, 0.3, "phone|tel|telephone|call|fax|mobile|cell|telefon|téléphone|teléfono"),
    "birth": (re.compile(rf"{_NO_DIGIT}(?:[0-9]{{1,2}}([./-])[0-9]{{1,2}}\1[0-9]{{4}}|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}){_END}"), calendar_date, 0.1, "born|birth|birthday|birthdate|dob|geboren|geburtsdatum|née?|nacid[oa]|nacimiento|naissance"),
}
#: What all of these shapes hold and most texts don't: eight digits near each other.
HINT = re.compile(r"[0-9](?:[\x20./()-]{0,2}[0-9]){7}")
#: Words that speak against personal data, whatever the kind.
AGAINST = "example|sample|dummy|test|version|isbn|issn|sku|invoice|order|part|serial|reference|ticket"
SHAPE_SCORES = {"iban": 0.8} | {kind: score for kind, (_, _, score, _) in PROPOSALS.items()}
_WORDS = {"iban": "iban|account|konto|compte|cuenta|bank"} | {kind: words for kind, (_, _, _, words) in PROPOSALS.items()}
_RAISES = {kind: re.compile(rf"(?<!\w)(?:{words})(?!\w)", re.IGNORECASE) for kind, words in _WORDS.items()}
_LOWERS = re.compile(rf"(?<!\w)(?:{AGAINST})(?!\w)", re.IGNORECASE)
BEFORE, AFTER = 48, 24
RAISE, LOWER, LEAST_SCORE = 0.4, 0.3, 0.5


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The pattern ``LOCAL+@DOMAIN``, leftmost first: what is before a sign starts with its run of
    local characters, which holds no other sign."""
    free, sign = 0, text.find("@")
    while sign >= 0:
        start = free + len(text[free:sign].rstrip(LOCAL))
        found = DOMAIN.match(text, sign + 1) if start < sign else None
        if found:
            yield start, found.end()
        free = found.end() if found else sign + 1
        sign = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """The fixed kinds; matches that fail their check are dropped and not tried otherwise."""
    out = [("email", a, b, 1.0) for a, b in emails(text)]
    out += [("ip", *m.span(), 1.0) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 37 and 16 <= len(digits := digits_of(m[0])) <= 19 and luhn(digits):
            out.append(("card", *m.span(), 1.0))
    return out + [("phone", *m.span(), 1.0) for m in PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]


def context_score(kind: str, text: str, start: int, end: int) -> float:
    """What the words before and behind a span add to its score."""
    around = f"{text[max(0, start - BEFORE) : start]}\n{text[end : end + AFTER]}"
    return RAISE * bool(_RAISES[kind].search(around)) - LOWER * bool(_LOWERS.search(around))


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers of the size of their country, written together or in groups."""
    for m in IBAN.finditer(text):
        size, end = IBAN_SIZES.get(m[0][:2], 0), m.start()
        for c in text[m.start() : m.start() + 2 * size]:
            size -= c in ALPHANUMERIC
            if not (c in ALPHANUMERIC or c == " ") or size < 0:
                break
            end += 1
        end = m.start() + len(text[m.start() : end].rstrip(" "))
        if mod_97(text[m.start() : end]) and not text[end : end + 1].isalnum():
            yield m.start(), end


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans whose check passes; those of one kind don't overlap."""
    for start, end in ibans(text):
        yield "iban", start, end
    if HINT.search(text):
        for kind, (pattern, check, _, _) in PROPOSALS.items():
            yield from ((kind, *m.span()) for m in pattern.finditer(text) if check(m[0]))


def more_spans(text: str) -> Iterator[Span]:
    for kind, start, end in proposals(text):
        score = SHAPE_SCORES[kind] + context_score(kind, text, start, end)
        if score >= LEAST_SCORE - 1e-9:
            yield kind, start, end, min(1.0, round(score, 3))


def without_overlaps(spans: list[Span], taken: list[tuple[int, int]]) -> list[Span]:
    """The spans that meet none of the places taken, which are sorted by start, and of spans that
    meet the first, or of those that start together the most certain."""
    out, free, k, reach = [], 0, 0, 0
    for span in sorted(spans, key=lambda s: (s[1], -s[3], KINDS.index(s[0]))):
        start, end = span[1:3]
        while k < len(taken) and taken[k][0] < end:
            reach = max(reach, taken[k][1])
            k += 1
        if start >= max(free, reach):
            out.append(span)
            free = end
    return out


def spans_of(text: str) -> list[Span]:
    """All spans by kind and start; an added span that meets a base span isn't listed."""
    base = base_spans(text)
    added = without_overlaps(list(more_spans(text)), sorted(s[1:3] for s in base))
    return sorted([*base, *added], key=lambda s: (KINDS.index(s[0]), s[1]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
_SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, spans) for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end", "score"), s)) for s in spans_of(text or "")] for (text,) in values(batch.select(["text"]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(_SPAN))], names=["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, spans {_SPANS}")


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
