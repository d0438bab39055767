"""Secret scan: patterns propose spans, decoding confirms their structure."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from seasonlens.llm.arrow import with_columns

# fixed patterns: kind by kind, leftmost and non-overlapping within a kind
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
ASSIGN_LENGTH = 6
#: a run that is too short cannot hold a long enough match further on, so the lengths stand in the patterns
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: in JSON and other quoted text, line ends are escaped, once or more often, and slashes may be
PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*)PRIVATE KEY-----((?:[A-Za-z0-9+/=\s]|\\+[nr/])++)-----END \1PRIVATE KEY-----")
ESCAPED = re.compile(r"\\+([nr/])")
#: a header is base64url of a JSON object, which begins with a brace or white space, and names an algorithm
JWT = re.compile(r"(?<![A-Za-z0-9_-])(?:e[w-z0-9_-]|[ICD])[A-Za-z0-9_-]{12,}+(?=(\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]*+))")
JWT_LENGTH = 20
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
ANY_HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{40,}")
OPENSSH = b"openssh-key-v1\x00"

KINDS = ("assign", "access", "hex", "pem", "jwt", "key64", "keyhex")
RANK = {kind: i for i, kind in enumerate(KINDS)}

MADE = T.StructType([
    T.StructField("n_assign", T.LongType()),
    T.StructField("n_access", T.LongType()),
    T.StructField("n_hex", T.LongType()),
    T.StructField("n_structured", T.LongType()),
    T.StructField("base", T.StringType()),
    T.StructField("spans", T.StringType()),
    T.StructField("structures", T.StringType()),
    T.StructField("base_sha256", T.StringType()),
])


def decode64(text: str) -> bytes | None:
    """Bytes of standard or URL-safe base64; None if it is not."""
    text = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except binascii.Error:
        return None


def der(data: bytes, at: int = 0) -> tuple[int, int, int] | None:
    """Tag, start and end of the contents of the DER element at ``at``; None if its length does not fit."""
    if at + 2 > len(data):
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        width = size & 0x7F
        if not 1 <= width <= 4 or at + width > len(data):
            return None
        size, at = int.from_bytes(data[at:at + width], "big"), at + width
        if size < 0x80:
            return None
    return (tag, at, at + size) if at + size <= len(data) else None


def children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``start`` to ``end`` exactly."""
    found = []
    while start < end:
        element = der(data, start)
        if element is None or element[2] > end:
            return None
        found.append(element)
        start = element[2]
    return found


def der_key(data: bytes) -> str | None:
    """Which private-key encoding the bytes are: the nested lengths must fit and the fields be in order."""
    whole = der(data)
    if whole is None or whole[0] != 0x30 or whole[2] != len(data):
        return None
    inner = children(data, whole[1], whole[2])
    if not inner or inner[0][0] != 0x02 or inner[0][2] - inner[0][1] != 1:
        return None
    version, tags = data[inner[0][1]], [tag for tag, _, _ in inner]
    if version in (0, 1) and len(tags) >= 9 and tags[1:9] == [0x02] * 8:
        return "rsa"
    if version == 0 and len(tags) == 6 and tags[1:] == [0x02] * 5:
        return "dsa"
    if version == 1 and tags[1:2] == [0x04]:
        return "ec"
    if version in (0, 1) and tags[1:3] == [0x30, 0x04]:
        algorithm = children(data, inner[1][1], inner[1][2])
        if algorithm and algorithm[0][0] == 0x06:
            return "pkcs8"
    if version == 0 and tags[1:2] == [0x30]:
        return "sequence"
    return None


def encrypted_key(data: bytes) -> bool:
    """PKCS#8 with encryption: an algorithm with an object identifier, then the bytes."""
    whole = der(data)
    if whole is None or whole[0] != 0x30 or whole[2] != len(data):
        return False
    inner = children(data, whole[1], whole[2])
    if not inner or [tag for tag, _, _ in inner] != [0x30, 0x04]:
        return False
    algorithm = children(data, inner[0][1], inner[0][2])
    return bool(algorithm) and algorithm[0][0] == 0x06


def openssh_key(data: bytes) -> bool:
    """Cipher, derivation, options, count, that many public keys and the private part, each with its length."""
    if not data.startswith(OPENSSH):
        return False
    at, strings = len(OPENSSH), 0

    def skip(at: int) -> int | None:
        end = at + 4 + int.from_bytes(data[at:at + 4], "big")
        return end if at + 4 <= len(data) and end <= len(data) else None

    for _ in range(3):
        at = skip(at)
        if at is None:
            return False
    strings = int.from_bytes(data[at:at + 4], "big")
    at += 4
    if not 1 <= strings <= 64:
        return False
    for _ in range(strings + 1):
        at = skip(at)
        if at is None:
            return False
    return at == len(data)


def key_bytes(data: bytes | None) -> str | None:
    if not data:
        return None
    if openssh_key(data):
        return "openssh"
    kind = der_key(data)
    if kind and kind != "sequence":
        return kind
    return "encrypted" if encrypted_key(data) else None


def pem_key(body: str) -> str | None:
    """Which key the text between the lines of a PEM is."""
    data = decode64(ESCAPED.sub(lambda m: "/" if m[1] == "/" else " ", body))
    return key_bytes(data) or (der_key(data) if data else None)


def encoded_key(data: bytes | None) -> str | None:
    """Which key the decoded bytes are: the key itself or a PEM that holds it."""
    kind = key_bytes(data)
    if kind or not data or b"PRIVATE KEY-----" not in data:
        return kind
    return next(filter(None, (pem_key(m[2]) for m in PEM.finditer(data.decode("latin-1")))), None)


def signed_token(text: str) -> str | None:
    """The algorithm of a signed token whose header and payload are JSON objects."""
    header, payload, _ = text.split(".", 2)
    try:
        head, body = (json.loads(decode64(part) or b"") for part in (header, payload))
    except (ValueError, RecursionError):
        return None
    if isinstance(head, dict) and isinstance(body, dict) and isinstance(head.get("alg"), str):
        return re.sub(r"[^A-Za-z0-9]", "", head["alg"]) or None
    return None


def base_spans(text: str, longest: int) -> list[tuple[int, int, str]]:
    found, lower = [], None
    if ":" in text or "=" in text:
        lower = text.lower()
        if any(word in lower for word in KEYWORDS):
            found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if longest >= 20 and "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    if longest >= 24:
        found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def confirmed(text: str, longest: int) -> list[tuple[int, int, str, str]]:
    """Spans that decode to a key or a signed token, with what they are."""
    found = []
    if "PRIVATE KEY-----" in text:
        for m in PEM.finditer(text):
            kind = pem_key(m[2])
            if kind:
                found.append((m.start(), m.end(), "pem", kind))
    if longest >= JWT_LENGTH and "." in text:
        end = 0
        for m in JWT.finditer(text):
            kind = signed_token(m[0] + m[1]) if m.start() >= end else None
            if kind:
                end = m.end(1)
                found.append((m.start(), end, "jwt", kind))
    if longest >= 40:
        for pattern, name, decode in ((BASE64, "key64", decode64), (ANY_HEX, "keyhex", from_hex)):
            for m in pattern.finditer(text):
                kind = encoded_key(decode(m[0]))
                if kind and not any(a <= m.start() and m.end() <= b and k == "pem" for a, b, k, _ in found):
                    found.append((m.start(), m.end(), name, kind))
    return found


def from_hex(text: str) -> bytes | None:
    return bytes.fromhex(text) if len(text) % 2 == 0 else None


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{s[2]}:{s[0]}:{s[1]}" for s in sorted(spans, key=lambda s: (s[0], RANK[s[2]])))


def scan(text: str) -> tuple:
    """The values of ``MADE`` for one text."""
    longest = max(map(len, text.split()), default=0)
    base, extra = base_spans(text, longest), confirmed(text, longest)
    counts = [sum(span[2] == kind for span in base) for kind in KINDS[:3]]
    told = ",".join(f"{k}:{a}:{b}:{what}" for a, b, k, what in sorted(extra))
    base_text = joined(base)
    return (*counts, len(extra), base_text, joined(base + extra), told, hashlib.sha256(base_text.encode()).hexdigest())


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets in every whole text: one row per row of ``docs``.

    id, n_assign, n_access, n_hex (spans of the three patterns), n_structured (spans confirmed by decoding), base
    and spans (``kind:start:end`` by start and then kind, code points, end exclusive; base has the three patterns
    only), structures (confirmed spans with what they are) and base_sha256. Confirmed are private keys in PEM
    (line ends may be escaped), base64 or hex, or PEM in base64 or hex, whose nested lengths fit, and signed tokens whose
    header and payload are JSON objects. A null
    text is empty and has no spans; repeated rows are scanned each; other columns are ignored.
    """
    return with_columns(docs, text_col, MADE, lambda: scan, [id_col])
