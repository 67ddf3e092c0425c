"""Personal data and secrets: base spans against the plain patterns, added spans by cases."""

import hashlib
import random
import re

import pytest

from verdigris.llm import pii, secrets


def luhn_ok(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n // 10 + n % 10
    return total % 10 == 0


def plain_pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn_ok(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def plain_secrets(t):
    name = r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    out = [("assign", *m.span()) for m in re.finditer(name + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 12]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out, key=lambda x: (x[1], secrets.BASE_KINDS.index(x[0])))


PII_PARTS = [*"0123456789" * 2, *"..@@+ --()a%", "4111 1111 1111 1111", "a.b@c.de", "+1 (988) 555-2485", "42.144.35.254", "256.1.1.1", "\n", "é"]
SECRET_PARTS = ["password", "Token", "secret", "api_key", "APIKEY", "passwd", '"', "'", " ", "  ", ":", "=", "abcdef", "ABC123", "AKIA", "0123456789ab", "_", ".", "\n", "z", "AKIA" + "X" * 14, "é"]


@pytest.mark.parametrize(("parts", "plain", "module"), [(PII_PARTS, plain_pii, pii), (SECRET_PARTS, plain_secrets, secrets)])
def test_base_spans_are_the_patterns(parts, plain, module):
    rng = random.Random(1)
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert [x[:3] for x in module.spans_of(t) if x[0] in module.BASE_KINDS] == plain(t), t


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 300_000, "a@" * 150_000, "+1" + " " * 300_000, "password" * 40_000, "=" * 300_000, "f" * 300_000])
def test_linear(text):
    pii.spans_of(text)
    secrets.spans_of(text)


def test_added_pii():
    kinds = lambda t: [x[0] for x in pii.spans_of(t)]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00 please") == ["iban"]
    assert kinds("IBAN DE88 3704 0044 0532 0130 00 please") == []  # fails mod 97
    assert kinds("my SSN: 078-05-1120") == ["ssn"] and kinds("code 078-05-1120") == []
    assert kinds("born 12.03.1980") == ["birthdate"] and kinds("on 12.03.1980") == []
    near, far = pii.spans_of("call +1 988 555 2485")[0][3], pii.spans_of("serial +1 988 555 2485")[0][3]
    assert near > far


def test_linked_secrets():
    kinds = lambda t: [x[0] for x in secrets.spans_of(t)]
    token = "aB3dE5fG7hI9jK1lM3nO5pQ7"
    assert kinds(token) == [] and kinds(f"see https://db.example.com now") == []
    assert kinds(f"AKIA{'X' * 16} {token}") == ["access", "weak_token"]
    assert kinds(f"AKIA{'X' * 16}\n\n{token}") == ["access"]  # another scope
    assert kinds(f"AKIA{'X' * 16} {'. ' * 9000} {token}") == ["access", "weak_token"]  # one scope, however far
    assert kinds("user=bob password=abc123 https://db.example.com/x") == ["weak_account", "weak_assign", "endpoint"]
    assert secrets.spans_of(f"AKIA{'X' * 16} {token}")[1][3] == "access"


def test_tables(spark, table, awkward):
    for find in (pii.find_pii, secrets.find_secrets):
        got = find(table(awkward))
        assert got.columns == ["doc_id", "spans"] and got.count() == len(awkward)
        assert find(table([])).count() == 0
    df = table([(1, "to a.b@c.de or 42.144.35.254"), (2, None)])
    assert [r["text"] for r in pii.redact(df).orderBy("doc_id").collect()] == ["to <EMAIL> or <IP>", ""]


def test_queries(spark, tmp_path, table):
    texts = ["mail a.b@c.de", None, "password = 'abcdef123456' AKIA" + "Z" * 16, "é +1 (988) 555-2485"]
    table(list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    for query, plain, kinds in ((pii.op5_pii, plain_pii, pii.BASE_KINDS), (secrets.op10_secrets, plain_secrets, secrets.BASE_KINDS)):
        for r in query(spark, str(tmp_path)).collect():
            want = plain(texts[r["doc_id"]] or "")
            joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
            assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest() and r["spans"] == joined
            assert [r[f"n_{k}"] for k in kinds] == [sum(x[0] == k for x in want) for k in kinds]


def test_nested_secret_reaches_its_account():
    """The assigned value ends before the account, the hex inside it does not."""
    text = "password=deadbeefdeadbeef-" + "z" * 250 + "\nuser: bob"
    found = secrets.spans_of(text)
    assert [(k, p) for k, _, _, p in found if k == "weak_account"] == [("weak_account", "assign")], found


@pytest.mark.parametrize("url", ["https://docs.example.com/d/aB3dE5fG7hI9jK1lM3nO5pQ7/edit", "https://x.com/?user=bob123", "http://x.org/login=abcdef?client_id=zzz9", "ftp://h/aB3dE5fG7hI9jK1lM3nO5pQ7=="])
def test_a_lone_endpoint_is_no_credential(url):
    assert secrets.spans_of(f"see {url} today") == []
    assert secrets.spans_of(f"see {url} or {url} today") == []


def brute_partners(t):
    """Every pair of parts of different roles that are disjoint and in one scope."""
    found = secrets.spans_of(t)
    scope = lambda at: len([1 for m in re.finditer(r"\n[\x20\t\r]*\n", t) if m.start() <= at])
    for k, a, b, partner in found:
        near = [(x - b if x >= b else a - y, secrets._RANK[o], o) for o, x, y, _ in found if secrets._ROLE[o] != secrets._ROLE[k] and (x >= b or y <= a) and scope(x) == scope(a)]
        yield k, partner, min(near)[2] if near else None


def test_partners_against_brute_force():
    import random

    rng = random.Random(5)
    pieces = ["password=abc123", "secret: 'abcdefABCDEF12'", "AKIA" + "Q" * 16, "deadbeef" * 3, "aB3dE5fG7hI9jK1lM3nO5pQ7", "user=bob", "https://h.example.com/x?user=bob123", "word", "\n", "\n\n", " ", "token=deadbeefdeadbeef-"]
    seen = 0
    for _ in range(3000):
        t = "".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randint(1, 12)))
        for kind, partner, want in brute_partners(t):
            assert partner == want, t
            assert partner or kind in secrets.BASE_KINDS, t
            seen += partner is not None
    assert seen > 1000
