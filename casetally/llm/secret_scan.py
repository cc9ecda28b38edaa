"""Secret scan with structural confirmation of encoded candidates."""

from __future__ import annotations

import base64
import binascii
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds in the order that breaks ties of equal starts.
BASE_KINDS = ("assign", "access", "hex")
CONFIRMED_KINDS = ("jwt", "der", "openssh")
KINDS = (*BASE_KINDS, *CONFIRMED_KINDS)

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of hex digits is one match, so short runs can be passed over by the pattern itself.
HEX = re.compile(r"[0-9a-f]{24,}")
# It may follow an equals sign, or a line end written as a backslash and a letter.
ENCODED = re.compile(
    r"(?:(?<=\\[nr])|(?<![A-Za-z0-9+/_-])(?!(?<=\\)[nr]))[A-Za-z0-9+/_-]{24,}+={0,2}"
)
LINE_END = re.compile(r"[\r\n]|(?<!\\)\\++[nr]")
TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]*+(?![A-Za-z0-9_-])")
HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{46,}+")
FENCE = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")

# Bytes of a signature by the algorithm that a token's header names.
SIGNATURE_BYTES = {
    "HS256": (32,), "HS384": (48,), "HS512": (64,), "ES256": (64,), "ES384": (96,), "ES512": (132,),
    "EdDSA": (64, 114), "RS256": (128, 256, 384, 512), "RS384": (128, 256, 384, 512),
    "RS512": (128, 256, 384, 512), "PS256": (128, 256, 384, 512), "PS384": (128, 256, 384, 512),
    "PS512": (128, 256, 384, 512), "none": (0,),
}
OPENSSH_MAGIC = b"openssh-key-v1\0"


def decode_base64(text: str) -> bytes | None:
    """Bytes of plain or URL-safe base64, padding optional; None if it is neither."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the DER element at ``at``, inside ``end``."""
    if at + 2 > end:
        return None
    tag, length, at = data[at], data[at + 1], at + 2
    if length >= 0x80:
        n = length & 0x7F
        if not 1 <= n <= 4 or at + n > end:
            return None
        length = int.from_bytes(data[at : at + n], "big")
        if length < 0x80 or data[at] == 0:
            return None  # not the shortest form
        at += n
    return (tag, at, at + length) if at + length <= end else None


def der_children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """All elements between ``at`` and ``end``; None unless they fill it exactly."""
    found = []
    while at < end:
        element = der_element(data, at, end)
        if element is None:
            return None
        found.append(element)
        at = element[2]
    return found


def is_private_der(data: bytes) -> bool:
    """A PKCS#1, PKCS#8, SEC1 or DSA private key whose nested lengths all fit.

    The outer sequence has to span the data exactly and to begin with a small version
    number; then nine integers (RSA), six integers (DSA), an algorithm sequence and an
    octet string (PKCS#8), or an octet string (elliptic curve) follow.
    """
    outer = der_element(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    inner = der_children(data, outer[1], outer[2])
    if not inner or inner[0][0] != 0x02 or inner[0][2] - inner[0][1] != 1 or data[inner[0][1]] > 2:
        return False
    tags = [t for t, _, _ in inner]
    if all(t == 0x02 for t in tags):
        return len(tags) in (6, 9)
    if tags[1:3] == [0x30, 0x04]:
        algorithm = der_children(data, inner[1][1], inner[1][2])
        return bool(algorithm) and algorithm[0][0] == 0x06
    if tags[1] == 0x04 and inner[1][2] - inner[1][1] >= 16:
        return all(t in (0xA0, 0xA1) and der_children(data, a, b) for t, a, b in inner[2:])
    return False


def is_openssh_key(data: bytes) -> bool:
    """The OpenSSH container: magic, three strings, a count and that many key strings."""
    if not data.startswith(OPENSSH_MAGIC):
        return False
    at = len(OPENSSH_MAGIC)

    def string(at: int) -> int | None:
        if at + 4 > len(data):
            return None
        end = at + 4 + int.from_bytes(data[at : at + 4], "big")
        return end if end <= len(data) else None

    for _ in range(3):  # cipher, derivation, its options
        at = string(at)
        if at is None:
            return False
    if at + 4 > len(data):
        return False
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return False
    for _ in range(keys + 1):  # public keys, then the private block
        at = string(at)
        if at is None:
            return False
    return at == len(data)


def is_signed_token(text: str) -> bool:
    """Three parts: a JSON header with a known ``alg``, a JSON object, a fitting signature."""
    head, body, signature = text.split(".")
    try:
        header, claims = (json.loads(decode_base64(x) or b"") for x in (head, body))
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(claims, dict):
        return False
    sizes = SIGNATURE_BYTES.get(header["alg"]) if isinstance(header.get("alg"), str) else None
    if sizes is None:
        return False
    raw = decode_base64(signature)
    return raw is not None and len(raw) in sizes


def key_kind(data: bytes | None) -> str | None:
    if data is None:
        return None
    return "der" if is_private_der(data) else "openssh" if is_openssh_key(data) else None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """Encoded keys and signed tokens that decode to the structure they claim."""
    found = []
    if "eyJ" in text:
        found += [(m.start(), m.end(), "jwt") for m in TOKEN.finditer(text) if is_signed_token(m[0])]
    opened = None
    fenced = []
    if "-----BEGIN" in text:
        for m in FENCE.finditer(text):  # a fence closes only the one right before it
            if m[1] == "BEGIN":
                opened = m
            elif opened is not None and opened[2] == m[2]:
                lines = LINE_END.split(text[opened.end() : m.start()])
                body = "".join(x.strip() for x in lines if ":" not in x)
                if kind := key_kind(decode_base64(body)):
                    found.append((opened.start(), m.end(), kind))
                    fenced.append((opened.start(), m.end()))
                opened = None
    for m in ENCODED.finditer(text):
        # What a key encoding begins with, in base64: a DER sequence or the magic.
        if m[0][0] == "M" or m[0].startswith("b3BlbnNzaC1rZXktdjE"):
            if kind := key_kind(decode_base64(m[0])):
                found.append((m.start(), m.end(), kind))
    if "30" in text:
        for m in HEX_KEY.finditer(text):
            if len(m[0]) % 2 == 0 and (kind := key_kind(bytes.fromhex(m[0]))):
                found.append((m.start(), m.end(), kind))
    inside = [
        x for x in found
        if x[:2] in fenced or not any(a <= x[0] and x[1] <= b for a, b in fenced)
    ] if fenced else found
    return inside


def secret_spans(text: str = "text") -> Column:
    """Spans of a text, ordered by start, then kind: ``array<struct<kind,start,end>>``.

    Base spans are those of the three patterns, left to right without overlap per kind.
    Confirmed spans are added where base64 or hex decodes to a private key whose nested
    lengths fit, or where a token's header, claims and signature do. Positions are code
    points, ends exclusive. NULL and empty texts have no spans. Texts are scanned whole
    in time linear in their length.
    """

    def scan(texts: pd.Series) -> pd.Series:
        rank = {k: i for i, k in enumerate(KINDS)}
        out = []
        for t in texts:
            if not t:
                out.append([])
                continue
            spans = base_spans(t) + confirmed_spans(t)
            spans.sort(key=lambda s: (s[0], rank[s[2]], s[1]))
            out.append([{"kind": k, "start": a, "end": b} for a, b, k in spans])
        return pd.Series(out)

    udf = F.pandas_udf(scan, "array<struct<kind:string,start:long,end:long>>")
    return udf(F.col(text))


def span_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the counts, the digest of the base spans and all spans as text."""
    found = docs.select(F.col(doc_id).cast("long").alias("doc_id"), secret_spans(text).alias("_spans"))

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ), ",")

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("_spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id", *[of_kind(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("_spans")).alias("spans"),
    )
