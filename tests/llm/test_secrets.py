import base64
import gzip
import hashlib
import random
import re
import urllib.parse
import zlib

import pytest

from auditlake.llm import secrets

from .helpers import EDGE_TEXTS, docs, texts

PLAIN = "token=abcdef123456"


def b64(data):
    return base64.b64encode(data if isinstance(data, bytes) else data.encode()).decode()


def percent(text):
    return "".join(f"%{b:02x}" for b in text.encode())


def escaped(text):
    return "".join(f"\\u{ord(c):04x}" for c in text)


def slow_base(text):
    """The base rules as written, without shortcuts."""
    names = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in n)
                     for n in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY]"
    found = [("assign", *m.span()) for m in re.finditer(
        rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_base_against_the_rules_as_written():
    rng = random.Random(1)
    parts = ["token", "TOKEN", "apikey", "Api_Key", "toKen", "ſecret", "=", ":", " ", "'", '"', "AKIA", "A1B2C3D4E5F6G7H8",
             "deadbeef0123", "0123456789abcdef", "x", "short", "longervalue", "é🙂", "\n"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 14)))
        assert secrets.find(text)[0] == slow_base(text), text


@pytest.mark.parametrize("wrapped", [
    b64(PLAIN), percent(PLAIN), urllib.parse.quote(PLAIN, safe=""), escaped(PLAIN), b64(gzip.compress(PLAIN.encode())),
    b64(zlib.compress(PLAIN.encode())), b64(b64(PLAIN)), percent(percent(PLAIN)), percent(b64(PLAIN)),
    b64(escaped(percent(PLAIN))), b64(gzip.compress(gzip.compress(b64(PLAIN).encode()))),
    base64.urlsafe_b64encode(PLAIN.encode()).decode().rstrip("="), "path/" + b64(PLAIN), "\\x74oken=abcdef",
    "".join(f"%{b:02X}" for b in gzip.compress(PLAIN.encode())), "\\u{74}oken=abcdefgh",
])
def test_wrapped_secrets_are_found_where_they_are(wrapped):
    text = f"é🙂 before {wrapped} after"
    base, every, unopened = secrets.find(text)
    new = [s for s in every if s not in base]
    assert [s[0] for s in new] == ["assign"] and unopened == 0
    kind, a, b = new[0]
    assert 9 < a < b <= len(text) - 6
    assert set(base) <= set(every)


def test_span_covers_only_the_secret():
    inner = "nothing here at all; " + PLAIN + " ; nothing more"
    text = "x " + b64(inner) + " y"
    (_, a, b), = secrets.find(text)[1]
    assert inner.index("token") * 4 // 3 <= a - 2 + 1 and b - a <= len(PLAIN) * 4 // 3 + 4
    text = "a%20" + percent("pass") + "word: " + percent("abcdef") + " z"
    (_, a, b), = secrets.find(text)[1]
    assert text[a:b] == percent("pass") + "word: " + percent("abcdef")


def test_cycles_end_and_nothing_is_opened_twice():
    text = "%25" * 2000 + "41 " + "\\u005c" * 50 + "u0041"
    assert len(list(secrets.layers(text))) < 5000
    assert secrets.find("%2525252525token%3dabcdefg")[1][0][0] == "assign"


def test_contents_beyond_the_limit_are_counted():
    bomb = b64(zlib.compress(b"token=abcdef " * 100000))
    base, every, unopened = secrets.find(f"x {bomb} {b64(PLAIN)}", limit=1000)
    assert unopened >= 1 and "assign" in {s[0] for s in every}
    assert secrets.find(f"x {bomb}")[2] == 0


def test_surrogates_and_long_texts():
    assert [x[0].text for x in secrets.layers("\\ud83d\\ude42 a")][-1] == "🙂 a"
    long = "word " * 200000 + PLAIN + " " + "x" * 500000 + "%" + "y" * 300000
    assert secrets.find(long)[0] == slow_base(long)


def test_documents(spark):
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS + [PLAIN, "x " + b64(PLAIN)])] + [(None, PLAIN), (None, PLAIN)]
    got = secrets.scan_documents(docs(spark, rows, ", spans int, s int")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[0].base_sha256 == hashlib.sha256(b"").hexdigest() and by[0].spans == ""
    assert (by[8].n_assign, by[8].spans) == (1, f"assign:0:{len(PLAIN)}")
    assert by[8].base_sha256 == hashlib.sha256(by[8].spans.encode()).hexdigest()
    assert by[9].n_assign == 0 and by[9].spans.startswith("assign:")
    assert secrets.scan_documents(texts(spark, [])).count() == 0


def test_redact():
    spans = [("assign", 2, 8), ("hex", 4, 8), ("access", 10, 12)]
    assert secrets.redact("a bcdefgh,jkl", spans) == "a [assign]h,[access]l"
    assert secrets.redact("a bcdefgh,jkl", [("assign", 2, 8), ("hex", 4, 8)]) == "a [assign]h,jkl"
    assert secrets.redact("abc", []) == "abc"


def in_lines(data, width=76, end="\n"):
    whole = b64(data)
    return end.join(whole[i:i + width] for i in range(0, len(whole), width))


NOISE = bytes(random.Random(5).choices(range(256), k=200))


@pytest.mark.parametrize("wrapped", [
    b64(f"é {PLAIN}".encode("latin-1")), b64(PLAIN.encode("utf-16")), b64(PLAIN.encode("utf-16-be")),
    b64(b"\xff" + PLAIN.encode("utf-16-le")), b64(NOISE + f" {PLAIN} ".encode() + NOISE),
    b64(gzip.compress(NOISE + f" {PLAIN} ".encode() + NOISE)),
    b64(gzip.compress(b"nothing here") + gzip.compress(PLAIN.encode())),
    b64(gzip.compress(b"nothing here") + b"\0\0" + gzip.compress(PLAIN.encode())),
    b64(gzip.compress(b"nothing here") + PLAIN.encode()),
    in_lines("x" * 50 + " " + PLAIN), in_lines("x" * 50 + " " + PLAIN, end="\r\n  "),
    in_lines(gzip.compress(NOISE + f" {PLAIN} ".encode())), "A_LINE_OF_ITS_OWN\n" + in_lines(gzip.compress(NOISE + f" {PLAIN} ".encode())),
])
def test_bytes_that_are_not_utf8_and_runs_over_lines(wrapped):
    text = f"é🙂 before {wrapped} after"
    base, every, unopened = secrets.find(text)
    new = [s for s in every if s not in base]
    assert {s[0] for s in new} == {"assign"} and unopened == 0
    assert all(9 < a < b <= len(text) - 6 for _, a, b in new)
