"""Secrets behind ordinary encodings, by round trips in many forms."""

import base64
import gzip
import random

from vigilframe.llm import secrets

SECRET = b'token = "0123456789abcdef0123"'


def wrapped(data, width, end):
    return end.join(data[i:i + width] for i in range(0, len(data), width))


def test_base64_wrapped_prefixed_and_url_safe():
    """Lines of any width, other characters of the alphabet in front, both alphabets, with padding and without, text behind."""
    rng = random.Random(1)
    for k in range(600):
        body = b"some words here " + bytes(rng.randrange(32, 127) for _ in range(rng.randrange(60))) + b" " + SECRET + b" tail" * rng.randrange(20)
        if rng.random() < 0.5:
            body = gzip.compress(rng.randbytes(rng.randrange(300)) + body)
        code = base64.b64encode(body) if rng.random() < 0.7 else base64.urlsafe_b64encode(body)
        code = code.rstrip(b"=") if rng.random() < 0.5 else code
        if rng.random() < 0.6:
            code = wrapped(code, rng.choice([64, 76, 60, 77]), rng.choice([b"\n", b"\r\n", b"\n  "]))
        text = b"see " + rng.choice([b"", b"id_", b"v/", b"a-", b"key="]) + code + rng.choice([b"\n", b'"', b" end", b"\nThen the house"])
        base, found, _ = secrets.scan_text(text)
        spans = [(s, e) for s, e, kind in found if kind == "assign"]
        assert spans and all(0 <= s < e <= len(text) for s, e in spans), (k, text)
        assert set(base) <= set(found)


def test_escapes():
    for form in (lambda c: "\\u{%x}" % c, lambda c: "\\%03o" % c, lambda c: "\\u%04x" % c, lambda c: "&#%d;" % c, lambda c: "%%%02X" % c):
        text = "x " + "".join(map(form, SECRET)) + " y"
        assert any(s == 2 and kind == "assign" for s, _, kind in secrets.scan_text(text.encode())[1]), text
    quoted = "".join("\\%03o" % b for b in "é ".encode()) + SECRET.decode()
    assert any(kind == "assign" for _, _, kind in secrets.scan_text(quoted.encode())[1])


def test_streams_that_end_short_are_marked():
    code = base64.b64encode(gzip.compress(SECRET + random.Random(3).randbytes(5000)))
    whole, short = secrets.scan_text(code), secrets.scan_text(code[:3000])
    assert not whole[2] and short[2] and any(kind == "assign" for _, _, kind in short[1])
    assert secrets.scan_text(b"") == ([], [], False)
