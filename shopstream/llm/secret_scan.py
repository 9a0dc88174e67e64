"""Secret scans with structural confirmation.

Base patterns name what looks like a secret. Beside them, runs of base64 or
hex digits are decoded and reported only if the bytes parse: as a private key in
DER (PKCS #1, PKCS #8 plain or enciphered, SEC 1, DSA) whose nested lengths fit
to the last byte, as an OpenSSH private key read field by field to its end, or
as a signed token with a JSON header that names its algorithm. Public keys,
certificates and signatures parse too, but hold no secret. A body may be wrapped over lines of one width, bare or between BEGIN
and END, there also with header lines or written line ends (\\n), and it may
be the base64 of such a block.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed values of the base patterns
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a shorter run fails whole, so only full runs need a match
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "der", "ssh", "signed")

ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----((?:(?!-----BEGIN )[\s\S])+?)-----END [A-Z0-9 ]+-----")
LINE_END = re.compile(r"(?:\\+r)?\\+n|\r?\n")  # as it is or written out
HEADER = re.compile(r"([A-Za-z][A-Za-z0-9-]*): ?(.*)")
BODY = re.compile(r"[A-Za-z0-9+/=\s]+")
BREAK = r"(?:[\x20\t]*\r?\n[\x20\t]*|(?:\\+r)?\\+n)"
WRAPPED = re.compile(rf"(?:(?<![A-Za-z0-9+/_\\-])|(?<=\\n))[A-Za-z0-9+/_-]{{16,}}(?:{BREAK}[A-Za-z0-9+/_-]+)+={{0,2}}")
RUN64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
RUN16 = re.compile(r"(?:[0-9a-fA-F]{2}){24,}")
SIGNED = re.compile(r"(?<![A-Za-z0-9_.-])ey[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
SSH_KINDS = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-", b"sk-")
SSH_MAGIC = b"openssh-key-v1\0"
SEQUENCE, INTEGER, OCTETS, OBJECT = 0x30, 0x02, 0x04, 0x06


def decode64(text: str) -> bytes:
    """Bytes of either base64 alphabet, padded or not; empty if it is neither."""
    plain = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def _elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """The row of DER elements (tag, content) that fills ``data``; None if lengths don't fit."""
    found, at = [], 0
    while at < len(data):
        if len(data) - at < 2:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            size = int.from_bytes(data[at:at + n], "big")
            if not 1 <= n <= 4 or at + n > len(data) or size < 0x80:
                return None
            at += n
        if at + size > len(data):
            return None
        found.append((tag, data[at:at + size]))
        at += size
    return found


def _fits(data: bytes, depth: int = 0) -> bool:
    """Whether the lengths of all nested elements fit."""
    row = _elements(data) if depth <= 8 else None
    return row is not None and all(_fits(body, depth + 1) for tag, body in row if tag & 0x20)


def _algorithm(tag: int, body: bytes) -> bool:
    """A sequence that begins with an object identifier."""
    row = _elements(body) if tag == SEQUENCE else None
    return bool(row) and row[0][0] == OBJECT


def is_private_key(data: bytes) -> bool:
    """A DER sequence that ends with the data, in the order of tags of one of the private key encodings."""
    if len(data) < 24 or data[0] != SEQUENCE or not _fits(data):
        return False
    outer = _elements(data)
    row = _elements(outer[0][1]) if len(outer) == 1 else []
    if len(row) < 2:
        return False
    tags, (first, version) = [t for t, _ in row], row[0]
    if first == SEQUENCE:  # enciphered PKCS #8: an algorithm with parameters, then whole octets
        return tags == [SEQUENCE, OCTETS] and _algorithm(*row[0]) and len(_elements(version)) == 2 and len(row[1][1]) >= 16
    if first != INTEGER or version not in (b"\0", b"\1"):
        return False
    if len(row) >= 3 and _algorithm(*row[1]) and tags[2] == OCTETS:  # PKCS #8, perhaps with attributes and the public key
        return all(t in (0xA0, 0x81, 0xA1) for t in tags[3:]) and len(row[2][1]) >= 16
    if tags[1] == OCTETS:  # SEC 1, perhaps with curve and public key
        return version == b"\1" and 16 <= len(row[1][1]) <= 80 and all(t in (0xA0, 0xA1) for t in tags[2:])
    numbers = [int.from_bytes(x, "big") for t, x in row[1:] if t == INTEGER]
    if len(numbers) == 8 and len(row) in (9, 10):  # PKCS #1: n = p q; a tenth element holds further primes
        n, p, q = numbers[0], numbers[3], numbers[4]
        return (len(row) == 10 and tags[9] == SEQUENCE and version == b"\1") or len(row) == 9 and n == p * q > 0
    return len(numbers) == 5 and len(row) == 6 and version == b"\0" and 0 < numbers[1] < numbers[0]  # DSA: q below p


def _fields(data: bytes, n: int) -> tuple[list[bytes], int]:
    """The first ``n`` fields of 4-byte lengths and where they end; fewer if one doesn't fit."""
    fields, at = [], 0
    while len(fields) < n and at + 4 <= len(data):
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + size > len(data):
            break
        fields.append(data[at + 4:at + 4 + size])
        at += 4 + size
    return fields, at


def is_ssh_key(data: bytes) -> bool:
    """An OpenSSH private key: magic, cipher, key derivation, each public key, then the private part, to the end of the data."""
    if not data.startswith(SSH_MAGIC):
        return False
    data = data[len(SSH_MAGIC):]
    names, at = _fields(data, 3)
    if len(names) < 3 or at + 4 > len(data):
        return False
    count = int.from_bytes(data[at:at + 4], "big")
    data = data[at + 4:]
    if not 1 <= count <= len(data) // 4:
        return False
    parts, at = _fields(data, count + 1)
    if len(parts) < count + 1 or not all(_fields(x, 1)[0] and _fields(x, 1)[0][0].startswith(SSH_KINDS) for x in parts[:-1]):
        return False
    secret, rest = parts[-1], len(data) - at
    if names[0] != b"none":  # enciphered: whole blocks, perhaps with a tag after them
        return len(secret) >= 16 and len(secret) % 8 == 0 and rest in (0, 16)
    return rest == 0 and len(secret) >= 16 and secret[:4] == secret[4:8] and _fields(secret[8:], 1)[0][:1] == _fields(parts[0], 1)[0]


def is_signed_token(text: str) -> bool:
    """Three parts: a JSON header that names an algorithm, a JSON object, and a signature."""
    head, body, sign = text.split(".")
    try:
        header, claims = json.loads(decode64(head)), json.loads(decode64(body))
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(claims, dict) and len(decode64(sign)) >= 16


def _structure(data: bytes) -> str:
    return "der" if is_private_key(data) else "ssh" if is_ssh_key(data) else ""


def _armoured(label: str, body: str) -> str:
    """Kind of the key between BEGIN and END; an enciphered one is told by its headers and whole blocks."""
    lines = [x.strip() for x in LINE_END.split(body)]
    headers: dict[str, str] = {}
    while lines and (not lines[0] or HEADER.fullmatch(lines[0])):
        if m := HEADER.fullmatch(lines.pop(0)):
            headers[m[1]] = m[2]
    plain = "\n".join(lines)
    if not BODY.fullmatch(plain):
        return ""
    data = decode64(plain)
    cipher, _, start = headers.get("DEK-Info", "").partition(",")
    if label.endswith("PRIVATE KEY") and headers.get("Proc-Type", "").endswith("ENCRYPTED") and cipher:
        block = len(start.strip()) // 2
        return "der" if re.fullmatch(r"(?:[0-9A-Fa-f]{16}){1,2}", start.strip()) and len(data) >= 24 and len(data) % block == 0 else ""
    return _structure(data)


def _armour_spans(text: str) -> list[tuple[int, int, str]]:
    if "-----BEGIN " not in text:
        return []
    return [(m.start(), m.end(), k) for m in ARMOUR.finditer(text) if (k := _armoured(m[1], m[2]))]


def _decoded(data: bytes) -> str:
    """Kind of what a run decodes to: a key, or a text that holds an armoured one."""
    if data.lstrip().startswith(b"-----BEGIN "):
        return next((k for _, _, k in _armour_spans(data.decode("latin-1"))), "")
    return _structure(data)


def _run(text: str) -> str:
    """Kind of a run of base64 or hex digits without breaks."""
    if len(text) % 2 == 0 and re.fullmatch("[0-9a-fA-F]+", text) and (kind := _decoded(bytes.fromhex(text))):
        return kind
    return _decoded(decode64(text))


def _wrapped_spans(text: str) -> list[tuple[int, int, str]]:
    """Runs cut into lines of one width and a last line no longer."""
    found = []
    for m in WRAPPED.finditer(text):
        lines, at = [], m.start()
        for gap in re.finditer(BREAK, m[0]):
            lines.append((at, m.start() + gap.start()))
            at = m.start() + gap.end()
        lines.append((at, m.end()))
        i = 0
        while i < len(lines):
            width, k = lines[i][1] - lines[i][0], i + 1
            while k < len(lines) and lines[k][1] - lines[k][0] == width:
                k += 1
            ends = [k, k + 1] if k < len(lines) and lines[k][1] - lines[k][0] < width else [k]
            for end in ends if width >= 16 else []:
                kind = _run("".join(text[a:b] for a, b in lines[i:end])) if end - i > 1 else ""
                if kind:
                    found.append((lines[i][0], lines[end - 1][1], kind))
                    k = end
                    break
            i = k
    return found


def scan(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every span in code points, by start, then kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    more = set(_armour_spans(text))
    for a, b, kind in _wrapped_spans(text):
        if not any(x <= a and b <= y for x, y, _ in more):
            more.add((a, b, kind))
    held = [(a, b) for a, b, _ in more]
    for pattern, decode in ((RUN64, decode64), (RUN16, bytes.fromhex)):
        for m in pattern.finditer(text):
            if any(a <= m.start() and m.end() <= b for a, b in held):
                continue
            if kind := _decoded(decode(m[0])):
                more.add((m.start(), m.end(), kind))
    if "ey" in text:
        more.update((m.start(), m.end(), "signed") for m in SIGNED.finditer(text) if is_signed_token(m[0]))
    return sorted([*found, *more], key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, spans (array of start, end, kind), n_assign, n_access, n_hex, base_sha256, one row per row of ``docs``.

    Null and empty texts have no spans. Offsets are code points of the whole
    text, end exclusive. Texts of any length are scanned whole, repeated rows
    alike; an empty table gives none. Other columns are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for b in batches:
            spans = [scan(t or "") for t in b["text"].to_pylist()]
            base = [[s for s in x if s[2] in BASE] for x in spans]
            counts = [pa.array([sum(s[2] == k for s in x) for x in base], pa.int64()) for k in BASE]
            digests = pa.array([hashlib.sha256(listed(x).encode()).hexdigest() for x in base])
            rows = pa.array([[{"start": s, "end": e, "kind": k} for s, e, k in x] for x in spans], kind)
            yield pa.RecordBatch.from_arrays([b["doc_id"], rows, *counts, digests],
                                             ["doc_id", "spans", *(f"n_{k}" for k in BASE), "base_sha256"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        run, "doc_id long, spans array<struct<start: long, end: long, kind: string>>, n_assign long, n_access long,"
             " n_hex long, base_sha256 string")
