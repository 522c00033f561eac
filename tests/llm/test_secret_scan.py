from __future__ import annotations

import hashlib
import re

import pytest

from catalogmart.llm import secret_scan as s
from tests.llm.conftest import by_id


def plain_base(text):
    text, found = text or "", []
    ic = "".join
    words = "|".join(ic(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    for m in re.finditer(rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, "assign", m.end()))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, a, b) for a, _, k, b in sorted(found)]


@pytest.mark.parametrize("source", ["given", "messy"])
def test_base_spans(given, messy, source):
    docs = given("documents") if source == "given" else messy
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i, r in by_id(s.scan_secrets(docs)).items():
        want = plain_base(texts[i])
        assert r["base_sha256"] == hashlib.sha256(s.written(want).encode()).hexdigest()
        assert set(s.written(want).split(",")) <= set(r["spans"].split(","))
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for k, _, _ in want) for x in ("assign", "access", "hex")]


def literals(text):
    return [text[a:b] for a, b in s.named_spans(text)]


def test_sensitive_names_by_syntax():
    for text in (
        'db_pwd = "h7Gk2!pQ9x"',
        "credentials: 'h7Gk2!pQ9x'",
        "\"authToken\" => 'h7Gk2!pQ9x'",
        "export CLIENT_SECRET=h7Gk2!pQ9x",
        '#define PRIVATE_KEY "h7Gk2!pQ9x"',
        'passphrase := "h7Gk2!pQ9x"',
    ):
        assert literals(text) == ["h7Gk2!pQ9x"], text


def test_constants_propagate_and_concatenate():
    text = 'a = "h7Gk2"\nb = a + "!pQ9xLm"\nuser_pwd = b\n'
    assert literals(text) == ["h7Gk2", "!pQ9xLm"]
    assert literals('x = "h7Gk2!pQ9x"\ncolour = x') == []


def test_harmless_pairs():
    for text in ('password = "changeme"', "token_count = 4096123", 'password_file = "/etc/app/pw.txt"', "secret: ${VAULT_SECRET}", "name = 'h7Gk2!pQ9x'", 'if password == "abc": pass'):
        assert literals(text) == [], text


def test_very_long_tokens_take_linear_time():
    import time

    begin = time.process_time()
    for text in ("a" * 400_000 + " = 1", "x-." * 200_000 + "= y", "=" * 400_000, 'k = "' + "\\" * 400_000, "a+" * 200_000 + "=b", 'k = """' * 60_000, "k = ''' " * 60_000, 'k = "' * 100_000, "password " * 50_000 + ":"):
        s.scan(text)
    assert time.process_time() - begin < 10


def test_constants_that_add_themselves_take_linear_time():
    """Doubling, long chains and many names of one chain; the spans are those of the pieces."""
    import time

    begin = time.process_time()
    for k in (22, 40, 400, 20_000):
        text = 'a = "abcDEF12"\n' + "a = a + a\n" * k + "password = a\n"
        assert literals(text) == ["abcDEF12"]
    chain = 'x0 = "h7Gk2!pQ9x"\n' + "".join(f'x{k + 1} = x{k} + "{k}z"\n' for k in range(20_000))
    assert len(literals(chain + "password = x20000\n")) == 20_001
    assert len(literals(chain + "".join(f"password{k} = x{k * 10}\n" for k in range(1, 2_000)))) == 19_991
    cycle = "a = b\nb = a\n" * 40_000 + 'a = "h7Gk2!pQ9x"\nb = a + b\nsecret = b\n'
    assert literals(cycle) == ["h7Gk2!pQ9x"]
    assert time.process_time() - begin < 20


def test_long_literals_score_as_short_ones():
    body = "h7Gk2!pQ9x" * 60
    joined = s.Literal.joined([s.Literal(body[:300], []), s.Literal(body[300:], [])])
    assert joined.length == 600 and joined.shown == s.Literal(body, []).shown
    assert abs(joined.score() - s.Literal(body, []).score()) < 1e-9 and abs(joined.score() - s.Literal(body[:500], []).score()) < 1e-9
    assert s.Literal("a b" * 300, []).score() == s.Literal("x" * 600, []).score() == s.Literal("<" + "q7" * 400 + ">", []).score() == 0


def test_prefixed_and_triple_quoted_literals():
    for text in ('db_pwd = b"h7Gk2!pQ9x"', "credentials: rb'h7Gk2!pQ9x'", 'passphrase = f"h7Gk2!pQ9x"', 'user_pwd = """h7Gk2!pQ9x"""', "user_pwd = '''h7Gk2!pQ9x'''"):
        assert literals(text) == ["h7Gk2!pQ9x"], text
    assert literals('db_pwd "h7Gk2!pQ9x"') == ["h7Gk2!pQ9x"]
    assert literals('note = """\npassword = "in a text of many words"\n"""\n') == []


def test_empty_table(nothing):
    assert s.scan_secrets(nothing).collect() == []
