"""Secrets in texts: patterns, and candidates confirmed by the structure of what they encode.

Base patterns find assignments, access keys and long hex strings. Beside them, text that looks
encoded is decoded, and reported only if its structure holds down to the last byte:

* ``pem``: an armoured private key, whose body decodes to one;
* ``key``: base64 (plain, url-safe or wrapped over lines of one width) or hex that decodes to a
  private key, or to the text of an armoured one, outside armour;
* ``jwt``: a signed token, whose header and claims are JSON objects and whose signature has the
  length of the header's algorithm.

A private key is a DER structure (RSA, DSA, elliptic curve, PKCS #8, encrypted PKCS #8) in which every
nested length ends where its container does, or an OpenSSH key whose length-prefixed strings
fill it exactly.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom.llm.common import with_struct

#: Kinds in the order in which spans with one start are listed; the first three are the base patterns.
KINDS = ("assign", "access", "hex", "pem", "key", "jwt")
BASE_KINDS = KINDS[:3]

# The base patterns. Bytes patterns fold the case of ASCII letters alone. Lengths that
# cannot change what later matches find stand in the pattern; the assigned value's is tested after.
ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
LEAST_VALUE = 8
ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
HEX = re.compile(rb"[0-9a-f]{32,}")

ARMOUR = re.compile(rb"-----BEGIN ((?:[A-Z0-9]{1,20} ){0,3}PRIVATE KEY)-----")
_DASHES = b"-----"
# Starts of what can be a key: a DER sequence, an OpenSSH key, an armoured key's text.
ENCODED = re.compile(rb"(?<![A-Za-z0-9+/_-])(?:M[A-P]|b3BlbnNzaC1rZXktdj|LS0tLS1CRUdJTi)[A-Za-z0-9+/_-]{38,}")
WRAPPED = re.compile(rb"\r?\n[\x20\t]*([A-Za-z0-9+/_-]+)")
HEX_KEY = re.compile(rb"(?<![0-9A-Za-z])30[0-9A-Fa-f]{78,}(?![0-9A-Za-z])")
DOTTED = re.compile(rb"(?<![A-Za-z0-9_.-])[A-Za-z0-9_.-]{20,}")
_URL_SAFE = bytes.maketrans(b"-_", b"+/")
_CONTINUED = bytes(range(0x80, 0xC0))

# Signature bytes by algorithm, and DER object identifiers.
SIGNATURE_BYTES = {
    "HS256": (32,), "HS384": (48,), "HS512": (64,),
    "ES256": (64,), "ES256K": (64,), "ES384": (96,), "ES512": (132,),
    "EdDSA": (64, 114), "Ed25519": (64,), "Ed448": (114,),
    **dict.fromkeys(("RS256", "RS384", "RS512", "PS256", "PS384", "PS512"), (128, 256, 384, 512, 1024)),
}
RSA = bytes.fromhex("2a864886f70d010101")
DSA = bytes.fromhex("2a8648ce380401")
ELLIPTIC = bytes.fromhex("2a8648ce3d0201")
#: X25519, X448, Ed25519, Ed448 and the bytes of their private keys.
MODERN = {bytes.fromhex("2b656e"): 32, bytes.fromhex("2b656f"): 56, bytes.fromhex("2b6570"): 32, bytes.fromhex("2b6571"): 57}
#: Password-based encryption (PKCS #5 and PKCS #12).
ENCRYPTION = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
OPENSSH = b"openssh-key-v1\0"

# --- decoding --------------------------------------------------------------------------------


def decoded(text: bytes) -> bytes | None:
    """Base64 of either alphabet without padding, all bits accounted for; None if it isn't."""
    if (b"-" in text or b"_" in text) and (b"+" in text or b"/" in text):
        return None
    plain = text.translate(_URL_SAFE)
    try:
        out = base64.b64decode(plain + b"=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None
    # Bits after the last whole byte must be zero, as an encoder leaves them.
    return out if base64.b64encode(out).rstrip(b"=") == plain else None


# --- DER -------------------------------------------------------------------------------------

INTEGER, BITS, OCTETS, NULL, OID, SEQUENCE = 0x02, 0x03, 0x04, 0x05, 0x06, 0x30


def der_header(data: bytes, at: int = 0) -> tuple[int, int, int] | None:
    """Tag, first content byte and past-the-end of the element at ``at``, in the shortest form only."""
    if at + 2 > len(data):
        return None
    tag, first = data[at], data[at + 1]
    if first < 0x80:
        return tag, at + 2, at + 2 + first
    width = first & 0x7F
    size = data[at + 2 : at + 2 + width]
    if not 1 <= width <= 4 or len(size) < width or size[0] == 0:
        return None
    length = int.from_bytes(size)
    return (tag, at + 2 + width, at + 2 + width + length) if length >= 0x80 else None


def der_children(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tag and content of the elements that follow one another in ``data`` and fill it."""
    out, at = [], 0
    while at < len(data):
        header = der_header(data, at)
        if header is None or header[2] > len(data):
            return None
        out.append((header[0], data[header[1] : header[2]]))
        at = header[2]
    return out


def der_sequence(data: bytes) -> list[tuple[int, bytes]] | None:
    """The elements of the one sequence that ``data`` is."""
    header = der_header(data)
    if header is None or header[0] != SEQUENCE or header[2] != len(data):
        return None
    return der_children(data[header[1] :])


def _positive(content: bytes) -> bool:
    return len(content) > 0 and content[0] < 0x80 and any(content) and (len(content) == 1 or content[0] > 0 or content[1] >= 0x80)


def _integers(parts: list[tuple[int, bytes]], version: tuple[bytes, ...], n: int) -> bool:
    """A version and ``n`` positive integers."""
    return (
        len(parts) == n + 1
        and all(tag == INTEGER for tag, _ in parts)
        and parts[0][1] in version
        and all(_positive(content) for _, content in parts[1:])
    )


def rsa_key(parts: list[tuple[int, bytes]]) -> bool:
    """Version, modulus, exponents, primes and CRT values, with primes that make up the modulus."""
    if not _integers(parts, (b"\0",), 8):
        return False
    modulus, prime, other = (int.from_bytes(parts[k][1]) for k in (1, 4, 5))
    return modulus.bit_length() >= 512 and 0 <= prime.bit_length() + other.bit_length() - modulus.bit_length() <= 1


def dsa_key(parts: list[tuple[int, bytes]]) -> bool:
    return _integers(parts, (b"\0",), 5) and len(parts[1][1]) >= 64 > len(parts[2][1]) >= 20


def elliptic_key(parts: list[tuple[int, bytes]]) -> bool:
    """Version 1 and the private value; then perhaps the curve and the public point."""
    if len(parts) < 2 or parts[0] != (INTEGER, b"\1") or parts[1][0] != OCTETS or not 20 <= len(parts[1][1]) <= 66:
        return False
    inner = {0xA0: (OID, SEQUENCE, NULL), 0xA1: (BITS,)}
    tags = [tag for tag, _ in parts[2:]]
    if tags != sorted(set(tags)) or any(tag not in inner for tag in tags):
        return False
    held = [(tag, der_children(content)) for tag, content in parts[2:]]
    return all(found is not None and len(found) == 1 and found[0][0] in inner[tag] for tag, found in held)


def _algorithm(parts: list[tuple[int, bytes]], place: int) -> bytes | None:
    """The object identifier of the algorithm at ``place``."""
    if place >= len(parts) or parts[place][0] != SEQUENCE:
        return None
    inner = der_children(parts[place][1])
    return inner[0][1] if inner and len(inner) <= 2 and inner[0][0] == OID else None


def wrapped_key(parts: list[tuple[int, bytes]]) -> bool:
    """PKCS #8: version, algorithm and an octet string that holds that algorithm's key."""
    name = _algorithm(parts, 1)
    if name is None or not 3 <= len(parts) <= 5 or parts[2][0] != OCTETS:
        return False
    if parts[0] not in ((INTEGER, b"\0"), (INTEGER, b"\1")) or any(tag not in (0xA0, 0xA1, 0x81) for tag, _ in parts[3:]):
        return False
    key = parts[2][1]
    if name in MODERN:
        return der_children(key) == [(OCTETS, key[2:])] and len(key) == MODERN[name] + 2
    if name == DSA:
        held = der_children(key)
        return bool(held) and len(held) == 1 and held[0][0] == INTEGER and _positive(held[0][1])
    nested = der_sequence(key)
    return nested is not None and ((name == RSA and rsa_key(nested)) or (name == ELLIPTIC and elliptic_key(nested)))


def encrypted_key(parts: list[tuple[int, bytes]]) -> bool:
    """Encrypted PKCS #8: an encryption algorithm with its settings and whole cipher blocks."""
    name = _algorithm(parts, 0)
    if name is None or not name.startswith(ENCRYPTION):
        return False
    settings = der_children(parts[0][1])[1:]
    return (
        len(settings) == 1
        and settings[0][0] == SEQUENCE
        and bool(der_children(settings[0][1]))
        and len(parts) == 2
        and parts[1][0] == OCTETS
        and len(parts[1][1]) >= 32
        and len(parts[1][1]) % 8 == 0
    )


def der_key(data: bytes) -> bool:
    parts = der_sequence(data)
    if not parts:
        return False
    return any(check(parts) for check in (rsa_key, elliptic_key, wrapped_key, dsa_key, encrypted_key))


def openssh_key(data: bytes) -> bool:
    """Cipher, derivation, options, public keys and the private part, which fill ``data``."""
    if not data.startswith(OPENSSH):
        return False
    strings, at = [], len(OPENSSH)
    keys = 0
    while len(strings) < 3 or len(strings) < 4 + keys:
        if len(strings) == 3 and not keys:
            keys = int.from_bytes(data[at : at + 4])
            at += 4
            if not 1 <= keys <= len(data) // 4:
                return False
            continue
        size = int.from_bytes(data[at : at + 4])
        if at + 4 > len(data) or at + 4 + size > len(data):
            return False
        strings.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    private = strings[-1]
    # Without a cipher the private part begins with one number twice.
    return at == len(data) and len(private) >= 8 and (strings[0] != b"none" or private[:4] == private[4:8])


def private_key(data: bytes | None) -> bool:
    return data is not None and (der_key(data) or openssh_key(data))


# --- spans -----------------------------------------------------------------------------------


def armoured(text: bytes, begin: re.Match) -> int | None:
    """Where the armoured key that starts with ``begin`` ends; None if it isn't one.

    The body reaches to the next dashes. Line ends may be escaped as in JSON. Headers (an old
    encrypted key has some) end with an empty line; what they encrypt has no structure to test, so it
    must fill whole cipher blocks.
    """
    at = text.find(_DASHES, begin.end())
    tail = b"-----END " + begin[1] + _DASHES
    if at < 0 or not text.startswith(tail, at):
        return None
    body = text[begin.end() : at].replace(b"\\r", b"\n").replace(b"\\n", b"\n").replace(b"\r", b"")
    head, gap, rest = body.partition(b"\n\n")
    encrypted = gap and b"ENCRYPTED" in head and b":" in head
    data = decoded(b"".join((rest if encrypted else body).split()).rstrip(b"="))
    good = data is not None and len(data) >= 32 and len(data) % 8 == 0 if encrypted else private_key(data)
    return at + len(tail) if good else None


def armoured_spans(text: bytes) -> list[tuple[int, int]]:
    out, end = [], 0
    if _DASHES not in text:
        return out
    for begin in ARMOUR.finditer(text):
        stop = armoured(text, begin) if begin.start() >= end else None
        if stop is not None:
            out.append((begin.start(), stop))
            end = stop
    return out


def _encoded_end(text: bytes, found: re.Match) -> int | None:
    """Where the base64 that starts with ``found`` ends if it encodes a private key.

    A DER key tells its length, so it may go on over lines as wide as the first; only as much of
    the text is read as it tells, 64 KB at most.
    """
    run, end = found[0], found.end()
    if not run.startswith(b"M"):
        data = decoded(run)
        if data is None or not (openssh_key(data) or armoured_spans(data)):
            return None
        return end
    lead = decoded(run[:40])
    header = der_header(lead) if lead else None
    if header is None or header[1] > 4 or lead[header[1]] not in (INTEGER, SEQUENCE):
        return None
    need, width, lines = -(-header[2] * 4 // 3), len(run), [run]
    have = width
    while have < need and len(lines[-1]) == width:
        line = WRAPPED.match(text, end)
        if line is None:
            return None
        lines.append(line[1])
        have, end = have + len(line[1]), line.end()
    return end if have == need and der_key(decoded(b"".join(lines)) or b"") else None


def encoded_spans(text: bytes) -> list[tuple[int, int]]:
    """Base64 and hex private keys without armour, padding left out."""
    out, end = [], 0
    for found in ENCODED.finditer(text):
        stop = _encoded_end(text, found) if found.start() >= end else None
        if stop is not None:
            out.append((found.start(), stop))
            end = stop
    for found in HEX_KEY.finditer(text):
        if len(found[0]) % 2 == 0 and der_key(bytes.fromhex(found[0].decode())):
            out.append(found.span())
    return sorted(out)


def _object(part: bytes) -> dict | None:
    data = decoded(part)
    if data is None or not data.startswith(b"{"):
        return None
    try:
        found = json.loads(data)
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def signed_token(header: bytes, claims: bytes, signature: bytes) -> bool:
    head = _object(header)
    if head is None or _object(claims) is None:
        return False
    lengths, data = SIGNATURE_BYTES.get(head.get("alg")) if isinstance(head.get("alg"), str) else None, decoded(signature)
    return lengths is not None and data is not None and len(data) in lengths


def token_spans(text: bytes) -> list[tuple[int, int]]:
    out = []
    for found in DOTTED.finditer(text):
        parts = found[0].split(b".")
        at, k = found.start(), 0
        while k + 2 < len(parts):
            # An object's brace makes the first letter an e.
            if parts[k].startswith(b"e") and signed_token(*parts[k : k + 3]):
                length = sum(map(len, parts[k : k + 3])) + 2
                out.append((at, at + length))
                at, k = at + length + 1, k + 3
            else:
                at, k = at + len(parts[k]) + 1, k + 1
    return out


def secret_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, place of the kind in ``KINDS``, end) in bytes, in order; each kind leftmost and not overlapping."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    armour = armoured_spans(text)
    inside = [edge for span in armour for edge in span]
    # An armoured key's body is the same secret again: between its edges, an odd number lies before.
    bare = [span for span in encoded_spans(text) if bisect_right(inside, span[0]) % 2 == 0]
    for kind, spans in ((3, armour), (4, bare), (5, token_spans(text))):
        out += [(start, kind, end) for start, end in spans]
    return sorted(out)


def in_code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The same spans counted in code points."""
    if not spans or text.isascii():
        return spans
    edges = sorted({edge for start, _, end in spans for edge in (start, end)})
    places, last, count = {}, 0, 0
    for edge in edges:
        count += len(text[last:edge].translate(None, _CONTINUED))
        places[edge], last = count, edge
    return [(places[start], kind, places[end]) for start, kind, end in spans]


SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
)


def find_secrets(docs: DataFrame, name: str = "secrets", keep: list[str] | None = None) -> DataFrame:
    """Add the struct ``name`` with the array ``spans`` (kind, start, end) of each whole ``text``.

    Positions count code points from 0, the end excluded; spans are ordered by start, then kind as
    in ``KINDS``. Spans of one kind do not overlap, those of different kinds may. A null or empty text
    has no spans. Repeated rows are each scanned; other columns pass through (``keep`` chooses them).
    A text is scanned in time that grows with its length, whatever it holds, apart from the at most
    64 KB that each line that looks like the start of a DER key may claim.
    """

    def compute(texts: list[bytes | None]) -> list:
        found = []
        for text in texts:
            spans = in_code_points(text, secret_spans(text)) if text else []
            found.append([{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in spans])
        return [found]

    return with_struct(docs, "text", [T.StructField("spans", T.ArrayType(SPAN))], compute, name, keep)


def redact(text: str, spans: list[tuple[int, int]], mask: str = "[secret]") -> str:
    """``text`` with the spans, which may overlap, replaced."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]
