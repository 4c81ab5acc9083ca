"""Secret scans with structural confirmation.

Patterns find candidates; a candidate that claims to be a key or a signed token
is decoded, and reported only if its inner structure holds: nested lengths of a
DER key fill their parents to the byte, an SSH key is a chain of counted
fields, the first part of a signed token is a JSON header that names an
algorithm and its second a JSON object. Such a structure may begin anywhere in
a run of encoded characters (after ``key-`` or ``path/``) and may be wrapped over
lines: its own length says at which line end it stops. Public keys are reported under a kind
of their own and are not redacted.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import map_arrow, slices, table

# The base patterns and their kinds in order, then those of the method.
KINDS = ["assign", "access", "hex", "pem", "der", "ssh", "jwt", "public"]
PUBLIC = KINDS.index("public")
ASSIGN = re.compile(rb"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
PEM = re.compile(rb"-----BEGIN ((?:[A-Z0-9]+ )*(?:PRIVATE|PUBLIC) KEY)-----((?:[^-]|-(?!----))+)-----END \1-----")
BREAK = re.compile(rb"\\r\\n|\\n|\\r|\r?\n")
LINE_BREAK = rb"(?:\\r\\n|\\n|\r?\n)[ \t]*"
#: A run with the lines that follow it without a gap, in both alphabets.
WRAPPED = [re.compile(rb"[A-Za-z0-9+/]{40,}(?:" + LINE_BREAK + rb"[A-Za-z0-9+/]+)*"), re.compile(rb"[A-Za-z0-9_-]{40,}(?:" + LINE_BREAK + rb"[A-Za-z0-9_-]+)*")]
#: How the first bytes of a DER sequence (0x30) and of SSH keys look when encoded.
STARTS = re.compile(rb"M[A-P]|AAAA[BCE]|b3BlbnNzaC1rZXktdjEA")
HEX_STARTS = re.compile(rb"(?=30(?:8[1-4]|[2-7]))")
DOTTED = re.compile(rb"[A-Za-z0-9_-]+")
BRACE = re.compile(rb"(?:(?<=[-_])|^)e[yw]")
SSH_NAMES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")
#: Fields after the name, where they are not two.
SSH_FIELDS = {b"ssh-dss": 4, b"ssh-ed25519": 1}
SSH_PRIVATE = b"openssh-key-v1\0"
LEAST_ENCODED = 40

HEX_CLASS, B64_CLASS = np.zeros(256, bool), np.zeros(256, bool)
HEX_CLASS[list(b"0123456789abcdef")] = True
B64_CLASS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_")] = True


def decoded(run: bytes) -> Iterator[bytes]:
    """What a run may stand for: hex, and base64 in either alphabet."""
    if len(run) % 2 == 0 and re.fullmatch(rb"[0-9a-fA-F]+", run):
        yield binascii.unhexlify(run)
    core = run.rstrip(b"=").replace(b"-", b"+").replace(b"_", b"/")
    if len(core) % 4 != 1:
        yield base64.b64decode(core + b"=" * (-len(core) % 4))


def der_items(b: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of the items that fill ``b`` exactly, else None."""
    out, at = [], 0
    while at < len(b):
        if at + 2 > len(b):
            return None
        tag, n = b[at], b[at + 1]
        at += 2
        if n >= 128:
            k = n & 127
            if not 1 <= k <= 4 or at + k > len(b) or not b[at]:
                return None
            n, at = int.from_bytes(b[at : at + k], "big"), at + k
            if n < 128:
                return None
        if at + n > len(b):
            return None
        out.append((tag, b[at : at + n]))
        at += n
    return out


def der_kind(b: bytes) -> str | None:
    """``der`` for PKCS#1, PKCS#8 (also encrypted) and SEC 1, ``public`` for a
    public key, by nested lengths."""
    whole = der_items(b) if b[:1] == b"\x30" else None
    if not whole or len(whole) != 1:
        return None
    items = der_items(whole[0][1])
    if not items or len(items) < 2:
        return None
    tags = [t for t, _ in items]
    if set(tags) == {2}:
        if len(tags) == 2:
            return "public" if len(items[0][1]) >= 64 else None
        return "der" if len(tags) >= 9 and items[0][1] in (b"\0", b"\1") else None
    names = [i for i, t in enumerate(tags) if t == 0x30]
    inner = der_items(items[names[0]][1]) if names else None
    named = bool(inner) and inner[0][0] == 6 and len(inner[0][1]) >= 3
    if tags[:3] == [2, 0x30, 4]:
        return "der" if items[0][1] in (b"\0", b"\1") and named else None
    if tags == [0x30, 3]:
        return "public" if named and len(items[1][1]) > 1 and items[1][1][0] == 0 else None
    if tags == [0x30, 4]:  # encrypted: the algorithm with its parameters, then whole blocks
        return "der" if named and len(inner) == 2 and inner[1][0] == 0x30 and len(items[1][1]) >= 16 and len(items[1][1]) % 8 == 0 else None
    sec1 = tags[:2] == [2, 4] and items[0][1] == b"\1" and len(items[1][1]) >= 16 and all(t in (0xA0, 0xA1) and der_items(c) for t, c in items[2:])
    return "der" if sec1 else None


def ssh_fields(b: bytes) -> list[bytes] | None:
    out, at = [], 0
    while at < len(b):
        n = int.from_bytes(b[at : at + 4], "big")
        if at + 4 + n > len(b):
            return None
        out.append(b[at + 4 : at + 4 + n])
        at += 4 + n
    return out


def ssh_kind(b: bytes) -> str | None:
    """``ssh`` for a private key that fills ``b``, ``public`` for a public one."""
    if b.startswith(SSH_PRIVATE):
        at, fields = len(SSH_PRIVATE), []
        for _ in range(3):  # cipher, key derivation, its options
            n = int.from_bytes(b[at : at + 4], "big")
            fields.append(b[at + 4 : at + 4 + n])
            at += 4 + n
        keys = int.from_bytes(b[at : at + 4], "big")
        rest = ssh_fields(b[at + 4 :]) if at + 4 <= len(b) else None
        return "ssh" if rest and len(rest) == keys + 1 and fields[0] != b"" else None
    fields = ssh_fields(b)
    if not fields or fields[0] not in SSH_NAMES or not all(fields) or len(fields[-1]) < 32:
        return None
    return "public" if len(fields) == 1 + SSH_FIELDS.get(fields[0], 2) else None


def der_size(head: bytes) -> int:
    """Bytes of the item that begins with ``head`` (6 bytes), 0 if it has no size."""
    if len(head) < 2 or head[0] != 0x30:
        return 0
    if head[1] < 128:
        return head[1] + 2
    k = head[1] & 127
    return int.from_bytes(head[2 : 2 + k], "big") + 2 + k if 1 <= k <= 4 and len(head) >= 2 + k else 0


def bytes_at(run: bytes, a: int, at: int, n: int) -> bytes:
    """Bytes at .. at + n of what begins at character ``a`` of a base64 run."""
    first = at // 3
    return plain_base64(run[a + 4 * first : a + 4 * (-(-(at + n) // 3))])[at - 3 * first : at - 3 * first + n]


def ssh_size(run: bytes, a: int) -> int:
    """Bytes of the SSH key that begins at character ``a``, 0 if it ends beyond
    the run. A public key's name says how many fields follow."""
    number = lambda at: int.from_bytes(bytes_at(run, a, at, 4), "big")
    most = (len(run) - a) * 3 // 4
    if bytes_at(run, a, 0, len(SSH_PRIVATE)) == SSH_PRIVATE:
        at = len(SSH_PRIVATE)
        for _ in range(3):
            at += 4 + number(at)
        keys = number(at) if at < most else 0
        at, fields = at + 4, keys + 1 if keys else 0
    else:
        n = number(0)
        name = bytes_at(run, a, 4, n) if n < 20 else b""
        at, fields = 4 + n, SSH_FIELDS.get(name, 2) if name in SSH_NAMES else 0
    for _ in range(fields):
        at += 4 + number(at)
        if at > most:
            return 0
    return at if fields else 0


def is_token(header: bytes, body: bytes, signature: bytes) -> bool:
    def load(part: bytes):
        try:
            return json.loads(next(decoded(part)))
        except (ValueError, StopIteration, RecursionError):
            return None

    head, claims = load(header), load(body)
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(claims, dict) and (bool(signature) or head["alg"].lower() == "none")


def key_kind(run: bytes) -> str | None:
    for b in decoded(run):
        if kind := der_kind(b) or ssh_kind(b):
            return kind
    return None


def plain_base64(chars: bytes) -> bytes:
    chars = chars.replace(b"-", b"+").replace(b"_", b"/")
    chars = chars[: len(chars) - (len(chars) % 4 == 1)]
    return base64.b64decode(chars + b"=" * (-len(chars) % 4))


def inner_keys(run: bytes, stops: set[int]) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the keys within a base64 run without breaks. The
    first bytes of a structure tell its size, so only that much is decoded; it
    has to end where a line ends (``stops``)."""
    out, at = [], 0
    while m := STARTS.search(run, at):
        a, at = m.start(), m.start() + 1
        if m[0][:1] == b"M":
            size = der_size(plain_base64(run[a : a + 8]))
        else:
            size = ssh_size(run, a)
        end = a + -(-size * 4 // 3)
        if not size or end not in stops:
            continue
        whole = plain_base64(run[a:end])
        kind = der_kind(whole) or ssh_kind(whole) if len(whole) == size else None
        if kind:
            out.append((a, end, kind))
            at = end
    return out


def hex_keys(run: bytes) -> list[tuple[int, int, str]]:
    out, at = [], 0
    for m in HEX_STARTS.finditer(run):
        a = m.start()
        head = run[a : a + 12]
        size = der_size(binascii.unhexlify(head[: len(head) // 2 * 2]))
        if a < at or not size or a + 2 * size != len(run):
            continue
        if kind := der_kind(binascii.unhexlify(run[a : a + 2 * size])):
            at = a + 2 * size
            out.append((a, at, kind))
    return out


def encoded_keys(t: bytes, runs: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Spans of keys in the runs, each run with the lines that go on from it.
    What lies inside the PEM spans ``taken`` is reported already."""
    found: dict[tuple[int, int], int] = {}
    done = [0, 0]
    for a, b in runs:
        if any(x <= a < y for x, y in taken):
            continue
        pad = len(re.match(rb"={0,2}", t[b : b + 2])[0])
        if kind := key_kind(t[a : b + pad]):
            found[a, b + pad] = KINDS.index(kind)
            continue
        for h in re.finditer(rb"[0-9a-fA-F]{40,}", t[a:b]):
            for x, y, kind in hex_keys(h[0]):
                found[a + h.start() + x, a + h.start() + y] = KINDS.index(kind)
        for i, wrapped in enumerate(WRAPPED):
            for m in wrapped.finditer(t, max(a, done[i]), b) if b > done[i] else ():
                whole = wrapped.match(t, m.start())  # goes on over the end of the run
                done[i] = whole.end()
                pieces = [(p.start(), p[0]) for p in re.finditer(rb"[A-Za-z0-9+/_-]+", re.sub(rb"\\[rn]", b"  ", whole[0]))]
                ends = np.cumsum([len(p) for _, p in pieces])
                for x, y, kind in inner_keys(b"".join(p for _, p in pieces), set(ends.tolist())):
                    first, last = np.searchsorted(ends, x, "right"), np.searchsorted(ends, y - 1, "right")
                    place = lambda k, off: whole.start() + pieces[k][0] + off - int(ends[k]) + len(pieces[k][1])
                    end = place(last, y - 1) + 1
                    end += len(re.match(rb"={0,2}", t[end : end + 2])[0])
                    found.setdefault((place(first, x), end), KINDS.index(kind))
    return [(a, k, b) for (a, b), k in found.items()]


def pem_spans(t: bytes) -> list[tuple[int, int, int]]:
    """PEM blocks whose body decodes to a key: line ends may be written out,
    header lines of an encrypted key may come first."""
    out = []
    for m in PEM.finditer(t):
        lines = [x.strip() for x in BREAK.split(m[2])]
        heads = [x for x in lines if b":" in x]
        body = b"".join(b"".join(x.split()) for x in lines if b":" not in x)
        if len(body) % 4 or not re.fullmatch(rb"[A-Za-z0-9+/]+={0,2}", body):
            continue
        locked = any(re.fullmatch(rb"Proc-Type:\s*4,\s*ENCRYPTED", x) for x in heads) and any(re.fullmatch(rb"DEK-Info:\s*[A-Z0-9-]+,[0-9A-Fa-f]{16,}", x) for x in heads)
        if locked and len(base64.b64decode(body)) % 8 == 0 or key_kind(body):
            out.append((m.start(), PUBLIC if m[1].endswith(b"PUBLIC KEY") else 3, m.end()))
    return out


def token_spans(t: bytes) -> list[tuple[int, int, int]]:
    """Three dotted runs of which the first two decode to JSON objects."""
    out, at = [], 0
    runs = [(m.start(), m.end()) for m in DOTTED.finditer(t)]
    for i, ((a, b), (c, d)) in enumerate(zip(runs, runs[1:])):
        if a < at or c != b + 1 or t[b : c] != b"." or t[d : d + 1] != b"." or t[c : c + 2] not in (b"ey", b"ew"):
            continue
        e, f = runs[i + 2] if i + 2 < len(runs) and runs[i + 2][0] == d + 1 else (d + 1, d + 1)
        for s in BRACE.finditer(t[a:b]):
            if is_token(t[a + s.start() : b], t[c:d], t[e:f]):
                out.append((a + s.start(), 6, f))
                at = f
                break
    return out


def long_runs(buf: np.ndarray, kind: np.ndarray, least: int) -> np.ndarray:
    """(start, end) of maximal runs of a byte class, of ``least`` bytes or more."""
    inside = np.r_[False, kind[buf], False]
    edge = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)
    return edge[edge[:, 1] - edge[:, 0] >= least]


def text_spans(t: bytes, hex_runs: list[tuple[int, int]], b64_runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in bytes, in order."""
    found = [(a, 2, b) for a, b in hex_runs if b - a >= LEAST["hex"]]
    low = t.lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= LEAST["assign"]]
    if b"AKIA" in t:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(t) if len(m[0]) >= LEAST["access"]]
    blocks = pem_spans(t) if b"-----BEGIN " in t else []
    found += blocks
    if b64_runs:
        found += encoded_keys(t, b64_runs, [(a, b) for a, _, b in blocks])
    if b".ey" in t or b".ew" in t:
        found += token_spans(t)
    return sorted(found)


def code_points(t: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not spans or t.isascii():
        return spans
    before = np.r_[0, np.cumsum((np.frombuffer(t, np.uint8) & 0xC0) != 0x80)]
    return [(int(before[a]), k, int(before[b])) for a, k, b in spans]


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, at = [], 0
    for a, k, b in spans:
        if b > at and k != PUBLIC:
            if a >= at:
                out += [text[at:a], mark]
            at = b
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, text: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = (), mark: str | None = None) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_assign``, ``n_access``,
    ``n_hex``, ``n_confirmed`` (spans of the method), ``base_sha256`` and
    ``spans``; with ``mark`` also ``redacted``, the text with every span
    replaced by the mark (null stays null; public keys stay), and the columns of ``keep``.

    Offsets are code points, ends exclusive. A null text is empty. Repeated
    rows give equal rows; null ids stay null; an empty table gives none. Whole
    texts are read; a task holds one slice at a time, and a longer text alone.
    """
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def listed(spans) -> str:
        return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, text):
            joined = np.frombuffer(b"\n".join(texts), np.uint8)
            lens = np.fromiter(map(len, texts), np.int64, len(texts))
            first = np.cumsum(lens + 1) - lens - 1
            runs: list[dict[int, list]] = []
            for kind, least in ((HEX_CLASS, LEAST["hex"]), (B64_CLASS, LEAST_ENCODED)):
                own: dict[int, list] = {}
                r = long_runs(joined, kind, least)
                for d, (a, b) in zip((np.searchsorted(first, r[:, 0], "right") - 1).tolist(), r.tolist()):
                    own.setdefault(d, []).append((a - int(first[d]), b - int(first[d])))
                runs.append(own)
            rows = [code_points(t, text_spans(t, runs[0].get(i, []), runs[1].get(i, []))) for i, t in enumerate(texts)]
            counts = [pa.array([sum(k == kind for _, k, _ in s) for s in rows], pa.int64()) for kind in range(3)]
            base = pa.array([hashlib.sha256(listed([x for x in s if x[1] < 3]).encode()).hexdigest() for s in rows], pa.string())
            out = [part.column(c) for c in (id_col, *keep)] + [*counts, pa.array([sum(k > 2 for _, k, _ in s) for s in rows], pa.int64()), base, pa.array([listed(s) for s in rows], pa.string())]
            names = [id_col, *keep, "n_assign", "n_access", "n_hex", "n_confirmed", "base_sha256", "spans"]
            if mark is not None:
                whole = part.column(text).to_pylist()
                out, names = [*out, pa.array([t and redacted(t, s, mark) for t, s in zip(whole, rows)], pa.string())], [*names, "redacted"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema = ", ".join(f"`{c}` {types[c]}" for c in (id_col, *keep)) + ", n_assign bigint, n_access bigint, n_hex bigint, n_confirmed bigint, base_sha256 string, spans string" + ", redacted string" * (mark is not None)
    return map_arrow(docs.select(*dict.fromkeys((id_col, text, *keep))), run, schema)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
