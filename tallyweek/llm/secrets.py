"""Secret scans: fixed patterns, and literals assigned to names that stand for something secret.

The lexer reads source and configuration syntax (assignments, keyword arguments, mappings, YAML with
its blocks, environment lines, elements with a key and a value) into pairs of a name and an expression
of literals, names, ``+``, defaults, brackets and calls. Constants are propagated, also to names that
stand before them: where a sensitive name gets another name, the literals of that one are meant. A
literal is scored by the sensitivity of its target and by how random it looks. Work and memory are
linear in the text.

Defined results: a null text counts as empty and has no spans; repeated and null ids keep their
rows; other columns are ignored; an empty table gives an empty result. Places are code points.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweek.llm.shared import tidy, values

#: The base patterns, in their order, and the least length of what they find.
KINDS = ["assign", "access", "hex", "named"]
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

#: How surely a name part stands for a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "auth": 0.6, "bearer": 0.8, "private": 0.5, "access": 0.4, "key": 0.5,
    "signing": 0.4, "encryption": 0.4, "client": 0.1, "api": 0.4, "pass": 0.7, "salt": 0.6, "dsn": 0.6,
}
#: What names of secrets are written together with, and words that such a name may end in without a break.
OWNERS = {"db", "sql", "mysql", "pg", "root", "admin", "user", "my", "ftp", "smtp", "mail", "app", "aws", "ssh", "jwt"}
SURE = tuple(word for word, score in SENSITIVE.items() if score >= 0.9)
#: Literals that stand for a value instead of being one.
PLACEHOLDERS = re.compile(r"(?i)^(?:x+|\*+|\.+|<.*>|\$\w+|\$\{.*\}|\{\{.*\}\}|%.*%|none|null|true|false|changeme|change_me|todo|example|placeholder|your[_-].*|password|secret|token)$")
LEAST_SCORE = 1.0

_NAME = r"[^\W\d][\w-]*(?:\.[\w-]+)*"
#: A name followed by an assignment or annotation, or by a value of its own. It is tried where a word
#: begins, so that long words cost no more than their length.
HINT = re.compile(r"""(?<![\w.-])([\w.-]++)(?:["'`\]}]*+[ \t]*+[?!]?[ \t]*+[:=]|["']?[\s,]*+["']?(?i:value|content)\b)""")
HINT_WORD = re.compile(rf"(?i){'|'.join(SENSITIVE)}")
TOKEN = re.compile(
    rf"""(?P<text>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)|(?P<note>(?:\#|//)[^\n]*)|(?P<sigil>[$@](?=[^\W\d]))|(?P<name>{_NAME})|(?P<op>:=|=>|==|[=:+])|(?P<bare>[^\s"'`=:+,;(){{}}\[\]<>]+)|(?P<end>[\n,;(){{}}])|(?P<other>\S)"""
)
#: The head of a YAML block, and one line with its indentation.
BLOCK, LINE = re.compile(r"[ \t]*[|>][+-]?\d?[ \t]*\r?\n"), re.compile(r"([ \t]*)([^\r\n]*)(?:\r?\n|\r|$)")
#: What joins the parts of an expression, and calls whose first argument is the name of a setting.
JOINS = {"+", "or", "||", "??", "new", "await"}
LOOKUPS = {"getenv", "get", "env", "fetch", "getproperty", "getordefault", "get_or_default", "setdefault", "config"}
#: Names that give the name of the value beside them.
LABELS, LABELLED = {"key", "name", "id"}, {"value", "content"}
BARE = re.compile(r"[ \t]*([^\s\"'#,;(){}\[\]][^\s\"',;(){}\[\]]*)[ \t]*(?=\r?\n|$)")

Span = tuple[str, int, int, float]
Part = tuple[str, object]


def base_spans(text: str) -> list[Span]:
    low, out = text.lower(), []
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", *m.span(), 1.0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [("access", *m.span(), 1.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return out + [("hex", *m.span(), 1.0) for m in HEX.finditer(text)]


def assigned(tokens: list[re.Match], i: int) -> int | None:
    """The place of the operator that gives the name at place i a value, past the bracket of a
    subscript and a type annotation."""
    kind = lambda j: tokens[j].lastgroup if j < len(tokens) else "end"
    said = lambda j: tokens[j].group() if j < len(tokens) else ""
    at = i + 1
    if i and said(i - 1) + said(at) in ("[]", "{}"):
        at += 1
    if said(at) in ("?", "!"):
        at += 1
    if kind(at) != "op" or said(at) not in ("=", ":=", ":", "=>"):
        return None
    if said(at) == ":":
        depth, last = 0, ""
        for j in range(at + 1, len(tokens)):
            word = said(j)
            if kind(j) == "op":
                return j if word == "=" and last and not depth else at
            depth += (word in "[<") - (word in "]>")
            # One type outside of brackets: a second name is prose or another key.
            is_name = kind(j) == "name" or kind(j) == "bare" and any(c.isalnum() for c in word)
            if kind(j) == "text" or kind(j) == "note" or kind(j) == "end" and not (word == "," and depth) or is_name and last == "name" and not depth:
                return at
            last = "name" if is_name else word
    return at


def expression(tokens: list[re.Match], i: int, names: bool) -> tuple[list[Part], int]:
    """The parts of the value that begins at place i, and the place after it.

    Of a lookup the first argument is no part of the value; of another call an only argument is. A
    bracket that doesn't end before the next assignment gives nothing."""
    parts: list[Part] = []
    opened: list[tuple[str, int, int]] = []  # kind, argument outside, number of parts outside
    how, argument, last = "", 0, "op"
    while i < len(tokens):
        kind, word = tokens[i].lastgroup, tokens[i].group()
        following = tokens[i + 1] if i + 1 < len(tokens) else None
        counts = how != "lookup" or argument
        if word in JOINS:
            kind = "op"
        elif kind == "text":
            if counts:
                parts.append(("literal", (tokens[i].start() + 1, tokens[i].end() - 1)))
        elif kind == "name":
            if last in ("name", "text"):  # two words are prose
                parts = [part for part in parts if part[0] == "literal"]
                break
            if following and following.group() == "(":
                opened.append((how, argument, len(parts)))
                how = "lookup" if word.lower().rsplit(".", 1)[-1] in LOOKUPS else "call"
                argument, kind, i = 0, "op", i + 1
            elif following and following.lastgroup == "text" and following.start() == tokens[i].end():
                kind = "op"  # the prefix of a literal
            elif names and counts:
                parts.append(("name", word))
        elif word in ("(", "["):
            opened.append((how, argument, len(parts)))
            how, argument, kind = "list", 0, "op"
        elif word in (")", "]") and opened:
            several = how == "call" and argument
            how, argument, n = opened.pop()
            if several or how == "lookup" and not argument:
                del parts[n:]
        elif opened and (kind == "note" or word in (",", "\n")):
            argument, kind = argument + (word == ","), "op"
        else:
            break
        i, last = i + 1, kind
    if opened:
        del parts[opened[0][2] :]
    return parts, i


def block_lines(text: str, key: int, start: int) -> Iterator[tuple[int, int]]:
    """The lines from a place on that are indented more than the line of their key."""
    indent = len(LINE.match(text, text.rfind("\n", 0, key) + 1)[1])
    while start < len(text) and (line := LINE.match(text, start)):
        if line[2] and len(line[1]) <= indent:
            return
        if line[2]:
            yield line.start(2), line.start(2) + len(line[2].rstrip())
        start = line.end()


def name_literal_pairs(text: str) -> Iterator[tuple[str, list[Part]]]:
    """(name, parts) of every assignment: a part is ("literal", (start, end)), ("name", other), or
    ("word", (start, end)) for a bare value that may be a name."""
    tokens = [token for token in TOKEN.finditer(text) if token.lastgroup != "sigil"]
    label: tuple[str, list[Part], int] | None = None  # a name and what it labels, and the place after it
    for i, token in enumerate(tokens[:-1]):
        if token.lastgroup not in ("name", "text") or (op := assigned(tokens, i)) is None:
            continue
        name = token.group().strip("\"'`")
        # An unquoted value up to the end of its line: KEY=value, key: value.
        bare = BARE.match(text, tokens[op].end())
        is_name = bare and re.fullmatch(_NAME, bare[1].lstrip("$@"))
        if tokens[op].group() == ":" and (head := BLOCK.match(text, tokens[op].end())):
            parts, after = [("literal", line) for line in block_lines(text, token.start(), head.end())], op + 1
        else:
            parts, after = expression(tokens, op + 1, not bare or bool(is_name))
        # A bare word is rather a name that isn't known here than a value.
        is_value = bare and not (is_name and not re.search(r"\d", bare[1]))
        if is_value and not any(kind == "literal" for kind, _ in parts):
            parts.append(("word" if is_name else "literal", bare.span(1)))
        if label:
            said, labels, place = label
            beside = i - place <= 3 and all(t.group() in (",", "\n") for t in tokens[place:i])
            if beside and name.lower() in LABELLED:
                what = labels[0][1]
                name = what if isinstance(what, str) else text[what[0] : what[1]]
            else:
                yield said, labels
            label = None
        if parts and name.lower() in LABELS and {kind for kind, _ in parts[1:]} <= {"word"}:
            label = name, parts, after
        elif parts:
            yield name, parts
    if label:
        yield label[:2]


def word_score(word: str) -> float:
    if word in SENSITIVE:
        return SENSITIVE[word]
    tails = [s for w, s in SENSITIVE.items() if word.endswith(w) and (w in SURE or word[: -len(w)] in OWNERS)]
    pairs = [SENSITIVE[word[:-len(w)]] + s for w, s in SENSITIVE.items() if word.endswith(w) and word[: -len(w)] in SENSITIVE]
    return max([*tails, *pairs], default=0.0)


def name_score(name: str) -> float:
    words = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", name).lower()
    return min(1.0, sum(word_score(w) for w in re.split(r"[\W_]+", words)))


def literal_score(value: str) -> float:
    """0 for placeholders, prose and short values, up to 1 for random ones."""
    if len(value) < 6 or PLACEHOLDERS.match(value) or re.search(r"\s", value):
        return 0.0
    entropy = -sum(n / len(value) * log2(n / len(value)) for n in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^\w]"))
    return min(1.0, entropy / 6 + (kinds - 1) / 6)


def named_spans(text: str) -> list[Span]:
    """Literals that reach a sensitive name, directly or through constants."""
    if ":" not in text and "=" not in text or not any(HINT_WORD.search(m[1]) for m in HINT.finditer(text)):
        return []
    # A constant holds its literals and, shared, the constants it is put together from. A name that
    # isn't known yet is an empty list, which its first definition is put into.
    constants: dict[str, list] = {}
    late: dict[str, list] = {}
    targets: list[tuple[float, list]] = []
    words: set[tuple[int, int]] = set()
    for name, parts in name_literal_pairs(text):
        own = [constants[v] if v in constants else late.setdefault(v, []) if kind == "name" else v for kind, v in parts]
        words.update(v for kind, v in parts if kind == "word")
        if (target := name_score(name)) >= 0.5:
            targets.append((target, own))
        if name not in constants and name in late:
            late[name].append(own)
        constants[name] = own
    found: dict[tuple[int, int], float] = {}
    reached: set[int] = set()
    for target, own in sorted(targets, key=lambda t: -t[0]):
        waiting = [own]
        while waiting:
            held = waiting.pop()
            if id(held) in reached:
                continue  # all its literals have such a score already
            reached.add(id(held))
            for value in held:
                if isinstance(value, list):
                    waiting.append(value)
                elif not (value in words and text[value[0] : value[1]].lstrip("$@") in constants):
                    random = literal_score(text[value[0] : value[1]])
                    if random > 0.4 and target + random >= LEAST_SCORE:
                        found[value] = max(target + random, found.get(value, 0.0))
    return [("named", a, b, s) for (a, b), s in found.items()]


def spans_of(text: str) -> list[Span]:
    """All spans by start and kind; a named literal that a base span meets isn't listed again."""
    base = sorted(base_spans(text), key=lambda s: s[1])
    starts, reach = [s[1] for s in base], list(accumulate((s[2] for s in base), max, initial=0))
    # Of the base spans that begin before a literal ends, none reaches beyond its start.
    more = [s for s in named_spans(text) if reach[bisect_left(starts, s[2])] <= s[1]]
    return sorted([*base, *more], key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
_SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, spans) for every document; spans of whole matches, of named literals their value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end", "score"), s)) for s in spans_of(text or "")] for (text,) in values(batch.select(["text"]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(_SPAN))], names=["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, spans {_SPANS}")


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redact(docs: DataFrame, mark: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """The documents with every stretch of secrets replaced by the mark; all columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            out = []
            for text in batch.column(place).to_pylist():
                parts, at, reach = [], 0, 0
                for _, start, end, _ in spans_of(text) if text else ():
                    if start >= reach:
                        parts += [text[at:start], mark]
                    at = reach = max(reach, end)
                out.append("".join([*parts, text[at:]]) if parts else text)
            columns = list(batch.columns)
            columns[place] = pa.array(out, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(tidy(run), docs.schema)
