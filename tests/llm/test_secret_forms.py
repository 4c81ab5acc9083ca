"""Keys and tokens in the forms in which they are met in texts."""

import base64
import json
import os
import random

import pytest

from tablescope.llm import secrets
from tests.llm.test_text import der

NUMBER = der(2, bytes([1]) + os.urandom(127))
RSA = der(0x30, der(2, b"\0") + NUMBER * 8)
ED = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2b\x65\x70")) + der(4, der(4, os.urandom(32))))
SPKI = der(0x30, der(0x30, der(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01") + der(5, b"")) + der(3, b"\0" + der(0x30, NUMBER + der(2, b"\1\0\1"))))
LOCKED = der(0x30, der(0x30, der(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x05\x0d") + der(0x30, der(4, os.urandom(8)))) + der(4, os.urandom(160)))


def field(b):
    return len(b).to_bytes(4, "big") + b


SSH = field(b"ssh-rsa") + field(b"\1\0\1") + field(os.urandom(128))
SSH_ED = field(b"ssh-ed25519") + field(os.urandom(32))
PRIVATE = b"openssh-key-v1\0" + field(b"none") * 2 + field(b"") + (1).to_bytes(4, "big") + field(SSH_ED) + field(os.urandom(99))


def b64(b):
    return base64.b64encode(b).decode()


def url64(b):
    return base64.urlsafe_b64encode(b).decode().rstrip("=")


def lines(t, end="\n", n=64):
    return end.join(t[i : i + n] for i in range(0, len(t), n))


def pem(name, body, end="\n", head=""):
    return f"-----BEGIN {name}-----{end}{head}{lines(b64(body), end)}{end}-----END {name}-----"


def token(head, claims='{"sub":"me"}'):
    return f"{url64(head.encode())}.{url64(claims.encode())}.c2lnbmF0dXJl"


AES = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF\n\n"
#: (before, secret, after, kind): the span covers the secret and nothing else.
FORMS = {
    "after key-": ("key-", b64(RSA), " end", "der"), "after k_": ("k_", b64(ED), ".", "der"), "after path/": ("path/", b64(RSA), "", "der"),
    "url alphabet after a prefix": ("key_", url64(RSA), " end", "der"), "hex after a prefix": ("ab", RSA.hex(), "xyz", "der"),
    "wrapped": ("é see\n", lines(b64(RSA)), "\nthe end", "der"), "wrapped, windows": ("", lines(b64(ED), "\r\n", 48), "\r\n\r\nx", "der"),
    "wrapped, written out": ('"', lines(b64(RSA), "\\n"), '"', "der"), "wrapped and indented": ("k:\n  ", lines(b64(RSA), "\n  "), "\n", "der"),
    "wrapped ssh key": ("", lines(b64(PRIVATE)), "\nwords follow here", "ssh"),
    "pem in json": ('{"k": "', pem("PRIVATE KEY", ED, "\\n"), '"}', "pem"), "encrypted pkcs8": ("", pem("ENCRYPTED PRIVATE KEY", LOCKED), "", "pem"),
    "encrypted der": ("", b64(LOCKED), "", "der"), "encrypted pem": ("", pem("RSA PRIVATE KEY", os.urandom(160), head=AES), "\n", "pem"),
    "blank after the brace": ("bearer ", token('{ "alg": "HS256"}'), " ok", "jwt"), "break after the brace": ("", token('{\n"alg": "HS256"}', '{\n "a": 1}'), "", "jwt"),
    "after bearer-": ("bearer-", token('{"alg":"HS256"}'), "", "jwt"), "after a sentence": ("See.", token('{"alg":"HS256"}'), " ok", "jwt"),
    "public pem": ("", pem("PUBLIC KEY", SPKI), "", "public"), "public der": ("", b64(SPKI), "", "public"), "public ssh": ("ssh-rsa ", b64(SSH), " me@x", "public"),
    "public ed25519": ("ssh-ed25519 ", b64(SSH_ED), " me@x", "public"),
}
NONE = {
    "cut": b64(RSA[:-20]), "broken inside": b64(RSA[:9] + b"\xff" + RSA[10:]), "locked pem without its header": pem("RSA PRIVATE KEY", os.urandom(160)),
    "locked pem, no whole blocks": pem("RSA PRIVATE KEY", os.urandom(162), head=AES), "no algorithm": token('{"typ":"JWT"}'), "claims are no object": token('{"alg":"HS256"}', '["a"]'),
    "two parts": ".".join(token('{"alg":"HS256"}').split(".")[:2]), "random": b64(random.Random(3).randbytes(30_000)), "zeros": "A" * 5000 + "B" + "M" * 5000,
    "names only": b64(field(b"ssh-rsa") * 200), "base64 of a text": b64(b"plain words that mean nothing " * 30),
}


@pytest.fixture(scope="module")
def got(spark, docs_of):
    texts = {**{k: a + s + b for k, (a, s, b, _) in FORMS.items()}, **NONE}
    rows = secrets.scan(docs_of(list(enumerate(texts.values()))), mark="[X]").collect()
    return dict(zip(texts, sorted(rows, key=lambda r: r.doc_id)))


@pytest.mark.parametrize("name", FORMS)
def test_found_with_its_span(got, name):
    before, secret, after, kind = FORMS[name]
    spans = [s for s in got[name].spans.split(",") if s and s.split(":")[0] not in ("assign", "access", "hex")]
    assert spans == [f"{kind}:{len(before)}:{len(before) + len(secret)}"]
    assert got[name].n_confirmed == 1
    if kind != "public" and got[name].n_hex == 0:
        assert got[name].redacted == f"{before}[X]{after}"
    if kind == "public":
        assert got[name].redacted == before + secret + after


@pytest.mark.parametrize("name", NONE)
def test_not_reported(got, name):
    assert got[name].n_confirmed == 0


def test_two_keys_on_two_lines():
    ed = b64(ED).rstrip("=").encode()
    run = b"key-" + ed + b"\n" + ed + b"\nand more"
    spans = secrets.text_spans(run, [], [(0, 4 + len(ed)), (5 + len(ed), 5 + 2 * len(ed))])
    assert spans == [(4, 4, 4 + len(ed)), (5 + len(ed), 4, 5 + 2 * len(ed))]
