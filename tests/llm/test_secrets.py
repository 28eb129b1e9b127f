"""Secrets: the base patterns against a plain reading, and what the lexer adds."""

import random
import re
from hashlib import sha256

import pytest

from tallyweek.llm import queries, secrets

PLAIN = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    ("access", r"AKIA[A-Z0-9]+", 20, 0),
    ("hex", r"[0-9a-f]+", 24, 0),
]


def _base(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, least, group) in enumerate(PLAIN) for m in re.finditer(p, text) if len(m[group]) >= least]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def test_base_spans_against_plain_patterns():
    rnd = random.Random(5)
    parts = ["password", "Token", "api_key", "APIKEY", "ſecret", "toKen", '"', "'", " ", "=", ":", "abc123", "AKIA", "ABCD1234EFGH5678", "0f" * 13, "deadbeef", "é", "\n", "x"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert [s[:3] for s in secrets.spans_of(text) if s[0] != "named"] == _base(text), text


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ('db_pass = "hunter2Xy9Q!"\n', ["hunter2Xy9Q!"]),
        ('PREFIX = "sk_live_"\nK = PREFIX + "9aF3kLm2QpZ7"\nauth_key = K\n', ["sk_live_", "9aF3kLm2QpZ7"]),
        ('credentials:\n  pwd: "aB3$xyzQ9"\n', ["aB3$xyzQ9"]),
        ('connect(user="bob", passphrase="Zx8#kLm9Qp")', ["Zx8#kLm9Qp"]),
        ('{"privateKey": "Zx8#kLm9Qp", "note": "Zx8#kLm9Qq"}', ["Zx8#kLm9Qp"]),
        ("export AUTH_KEY=Tr0ub4dor&3x\n", ["Tr0ub4dor&3x"]),
        ('api_auth = "your-token-here"', []),
        ("private_key = KEYDATA\n", []),
        ("The key: is under the mat.", []),
        ('auth_key = "plain words in a sentence"', []),
        ('AUTH_KEY="${SECRET_NAME}"', []),
    ],
)
def test_named_literals(text, found):
    assert [text[a:b] for kind, a, b, _ in secrets.spans_of(text) if kind == "named"] == found


def test_rows_and_redaction(spark, texts, tmp_path):
    rows = [(1, 'é token = "abcdef123"!'), (2, None), (3, ""), (None, "AKIA" + "Z" * 16), (1, "clean"), (4, "x " * 100_000 + "0" * 24)]
    got = {(r.id, len(r.spans)) for r in secrets.find_secrets(texts(rows)).collect()}
    assert got == {(1, 1), (2, 0), (3, 0), (None, 1), (1, 0), (4, 1)}
    cut = sorted((str(r.doc_id), r.text and r.text[-12:]) for r in secrets.redact(texts(rows)).collect())
    assert cut == [("1", "clean"), ("1", 'é [SECRET]"!'), ("2", None), ("3", ""), ("4", "x x [SECRET]"), ("None", "[SECRET]")]
    texts(rows).write.parquet(f"{tmp_path}/documents.parquet")
    by_id = {r.doc_id: r for r in queries.op8_secret_scan(spark, str(tmp_path)).collect() if r.doc_id in (2, 4)}
    assert by_id[2].base_sha256 == sha256(b"").hexdigest() and by_id[2].spans == ""
    assert by_id[4].base_sha256 == sha256(b"hex:200000:200024").hexdigest() and by_id[4].n_hex == 1
    assert secrets.find_secrets(texts([])).collect() == [] and secrets.redact(texts([])).collect() == []


def test_overlapping_spans_are_cut_once(texts):
    text = 'secret="' + "0a" * 15 + '" and ' + "0b" * 12
    assert secrets.redact(texts([(1, text)])).first().text == '[SECRET]" and [SECRET]'


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ('os.environ["DB_PASSWORD"] = "Zx8#kLm9Qp"\n', ["Zx8#kLm9Qp"]),
        ('settings["db"][AUTH_KEY] = "Zx8#kLm9Qp"\n', ["Zx8#kLm9Qp"]),
        ('password: str = "Zx8#kLm9Qp"\n', ["Zx8#kLm9Qp"]),
        ('const authKey: string = "Zx8#kLm9Qp";', ["Zx8#kLm9Qp"]),
        ('def f(user: str, auth_key: dict[str, int] | None = "Zx8#kLm9Qp"): pass', ["Zx8#kLm9Qp"]),
        ('authKey?: string = "Zx8#kLm9Qp"', ["Zx8#kLm9Qp"]),
        ('private = "Zx8#kLm9Qp"', ["Zx8#kLm9Qp"]),
        ("auth_key: str\nname = \"Zx8#kLm9Qp\"", []),
        ("{auth_key: value, name = \"Zx8#kLm9Qp\"}", []),
    ],
)
def test_subscripts_and_annotations(text, found):
    assert [text[a:b] for kind, a, b, _ in secrets.spans_of(text) if kind == "named"] == found


def test_all_literals_of_a_constant():
    lines = [f"Zx8#kLm9Q{i}pT" for i in range(40)]
    text = "\n".join(f'L{i} = "{line}"' for i, line in enumerate(lines)) + "\nPEM = " + " + ".join(f"L{i}" for i in range(40)) + "\nauth_key = PEM\n"
    assert {text[a:b] for _, a, b, _ in secrets.spans_of(text)} == set(lines)
    chain = 'a0 = "Zx8#kLm9Qp"\n' + "".join(f"a{i + 1} = a{i} + a{i}\n" for i in range(300)) + "auth_key = a300\n"
    assert [chain[a:b] for _, a, b, _ in secrets.spans_of(chain)] == ["Zx8#kLm9Qp"]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("my $auth_key = 'Zx8#kLm9Qp';", ["Zx8#kLm9Qp"]),
        ("@auth_key = 'Zx8#kLm9Qp'", ["Zx8#kLm9Qp"]),
        ("$conf{auth_key} = 'Zx8#kLm9Qp';", ["Zx8#kLm9Qp"]),
        ('auth_key = ("Zx8#kLm9Qp")', ["Zx8#kLm9Qp"]),
        ('{"auth_key": ["Zx8#kLm9Qp", "Yw7#kLm9Qp"], "user": ["Bob#12345x"]}', ["Zx8#kLm9Qp", "Yw7#kLm9Qp"]),
        ('auth_keys = [\n  "Zx8#kLm9Qp",  # old\n  "Yw7#kLm9Qp",\n]\n', ["Zx8#kLm9Qp", "Yw7#kLm9Qp"]),
        ('auth_key = os.getenv("AUTH_KEY_2x", "Zx8#kLm9Qp")', ["Zx8#kLm9Qp"]),
        ('auth_key = os.environ.get("AUTH_KEY_2x") or "Zx8#kLm9Qp"', ["Zx8#kLm9Qp"]),
        ('const authKey = process.env.AUTH_KEY || "Zx8#kLm9Qp";', ["Zx8#kLm9Qp"]),
        ('auth_key = SecretStr("Zx8#kLm9Qp")', ["Zx8#kLm9Qp"]),
        ('auth_key = b"Zx8#kLm9Qp"', ["Zx8#kLm9Qp"]),
        ('auth_key = pick("Zx8#kLm9Qp", "Yw7#kLm9Qp")', []),
        ("authKey := `Zx8#kLm9Qp`", ["Zx8#kLm9Qp"]),
        ("private_key: |\n  MIIEvQ8xZk3Lm9Qp\n\n  Yw7TkLm9QpZx8aB2\nuser: Bob12345Xyz9\n", ["MIIEvQ8xZk3Lm9Qp", "Yw7TkLm9QpZx8aB2"]),
        ('DBPWD="Zx8#kLm9Qp"', ["Zx8#kLm9Qp"]),
        ("dbpass = 'Zx8#kLm9Qp'", ["Zx8#kLm9Qp"]),
        ("monkey = 'Zx8#kLm9Qp'", []),
        ('auth_key = KEY2\nKEY2 = "Zx8#kLm9Qp"\n', ["Zx8#kLm9Qp"]),
        ('auth_key = A\nA = B\nB = A + "Zx8#kLm9Qp"\n', ["Zx8#kLm9Qp"]),
        ('<add key="DbPass" value="Zx8#kLm9Qp"/>', ["Zx8#kLm9Qp"]),
        ('<add key="Theme" value="Zx8#kLm9Qp"/>', []),
        ('{"name": "AUTH_KEY", "value": "Zx8#kLm9Qp"}', ["Zx8#kLm9Qp"]),
        ("env:\n  - name: AUTH_KEY\n    value: Zx8#kLm9Qp\n", ["Zx8#kLm9Qp"]),
        ("auth_key = $OTHER_KEY_9x\n", []),
        ('auth_key = connect(user="Zx8#kLm9Qp")', []),
    ],
)
def test_forms_of_assignments(text, found):
    assert [text[a:b] for kind, a, b, _ in secrets.spans_of(text) if kind == "named"] == found


def test_many_spans_take_linear_work():
    lines = [f'auth_key_{i} = "Zx8#kLm9Q{i}"\ntoken = "abc{i:05d}"\n' for i in range(20_000)]
    spans = secrets.spans_of("".join(lines))
    assert [kind for kind, *_ in spans] == ["named", "assign"] * 20_000
    assert [s[0] for s in secrets.spans_of("key" * 200_000 + ' = "Zx8#kLm9Qp"')] == []
    nested = "auth = " + '("Zx8#kLm9Qp", ' * 50_000 + ")" * 50_000
    assert len(secrets.spans_of(nested)) == 50_000
    assert secrets.spans_of("auth = (" * 50_000) == [] and secrets.spans_of('auth = "x" ["' * 20_000) == []
