"""Secret scans (4): pattern spans plus structural confirmation.

Base spans are three patterns (``assign``, ``access``, ``hex``). The method
adds spans whose decoded bytes have the structure of a credential: base64 or
hex that decodes to a private key in DER (nested lengths must fit exactly) or
in the OpenSSH container (on one line or wrapped over several), armoured private
keys (also with header lines, or enciphered as these say), and signed tokens whose header
and payload decode to JSON with an algorithm.

Whole texts, no shuffle, time linear in the text: keys over several lines are
confirmed from the headers of their structure. A confirmed key is one span, what
starts inside it is no further one. Defined results: a null or empty text has no
spans (``base_sha256`` of the empty string, ``spans`` empty); a very long text is
scanned whole; repeated rows each get their row; an empty table gives an empty
result; positions are code points, the end exclusive.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import annotate, fresh, quoted, read_documents, sha256

#: kinds in the order in which equal starts are listed
KINDS = ("assign", "access", "hex", "key", "armour", "signed")

_KEYWORDS = ("password", "passwd", "secret", "token", "api")
_ASSIGN = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                     r"([A-Za-z0-9+/_.=-]+)", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: no span but ``assign`` is without such a run; it spares most texts the other patterns
_LONG = re.compile(r"[A-Za-z0-9+/_=.-]{20}")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
_ANY_HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}(?![0-9A-Fa-f])")
#: first line of a wrapped key: DER (a sequence) or the OpenSSH magic, in base64 and in hex
_START64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:M[A-P]|b3BlbnNzaC1r)[A-Za-z0-9+/_-]{18,}")
_START16 = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[Ff]70656[Ee])[0-9A-Fa-f]{18,}")
_EOL = r"[\x20\t]*(?:\r?\n|(?:\\r)?\\n)[\x20\t]*"
_NEXT64 = re.compile(_EOL + r"([A-Za-z0-9+/_-]+)")
_NEXT16 = re.compile(_EOL + r"([0-9A-Fa-f]+)")
_PADDING = re.compile(r"={0,2}")
#: header lines (RFC 1421) may stand before the body
_ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----"
                     r"((?:(?:\\[rn]|\s)*[A-Za-z][A-Za-z0-9-]*:(?:(?!-----)[^\r\n\\])*(?=[\r\n\\]))*)"
                     r"([A-Za-z0-9+/=\s\\]+?)-----END \1-----")
_ENCRYPTED = re.compile(r"Proc-Type:\s*4,\s*ENCRYPTED")
_DEK = re.compile(r"DEK-Info:\s*[A-Za-z0-9-]+,\s*[0-9A-Fa-f]{16,}")
_SIGNED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]*")

_INTEGER, _OCTETS, _OID, _SEQUENCE = 0x02, 0x04, 0x06, 0x30


#: bytes ``i`` to ``j`` of a candidate, decoded only where the structure is looked at
Reader = Callable[[int, int], bytes]


def der_items(get: Reader, i: int, end: int, most: int) -> list[tuple[int, int, int]] | None:
    """The (tag, value start, value end) items that fill ``i`` to ``end`` exactly; None if
    lengths don't fit or there are more than ``most`` (no key structure has as many)."""
    items = []
    while i < end:
        head = get(i, min(i + 6, end))
        if len(items) == most or len(head) < 2:
            return None
        n, k = head[1], 0
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or len(head) < 2 + k:
                return None
            n = int.from_bytes(head[2:2 + k], "big")
        i += 2 + k
        if i + n > end:
            return None
        items.append((head[0], i, i + n))
        i += n
    return items


def der_key_size(get: Reader, size: int) -> int | None:
    """Bytes of the private key that starts here: PKCS#1 or DSA (a row of integers),
    PKCS#8 (plain or encrypted) or SEC 1. A few headers are read, however long it is."""
    head = get(0, 6)
    if len(head) < 2 or head[0] != _SEQUENCE:
        return None
    k = head[1] & 0x7F if head[1] & 0x80 else 0
    if head[1] & 0x80 and not 1 <= k <= 4:
        return None
    begin = 2 + k
    end = begin + (int.from_bytes(head[2:2 + k], "big") if k else head[1])
    if end > size or get(begin, begin + 1) not in (b"\x02", b"\x30"):
        return None
    inner = der_items(get, begin, end, 10)
    if not inner:
        return None
    tags = [t for t, _, _ in inner]
    long = [e - b >= 16 for _, b, e in inner]
    if tags == [_SEQUENCE, _OCTETS]:
        # EncryptedPrivateKeyInfo; a DigestInfo has no sequence of parameters
        algorithm = der_items(get, *inner[0][1:], 2)
        return end if algorithm and [t for t, _, _ in algorithm] == [_OID, _SEQUENCE] and der_items(
            get, *algorithm[1][1:], 4) and long[1] else None
    if tags[0] != _INTEGER or get(*inner[0][1:]) not in (b"\0", b"\1"):
        return None
    if tags in ([_INTEGER] * 9, [_INTEGER] * 6):
        return end if all(e > b for _, b, e in inner) else None
    if tags[1:3] == [_SEQUENCE, _OCTETS]:
        algorithm = der_items(get, *inner[1][1:], 2)
        return end if algorithm and algorithm[0][0] == _OID and long[2] else None
    return end if tags[1:2] == [_OCTETS] and long[1] and all(
        t in (0xA0, 0xA1) and der_items(get, b, e, 2) for t, b, e in inner[2:]) else None


def openssh_key_size(get: Reader, size: int) -> int | None:
    """Bytes of the OpenSSH container that starts here: magic, then length-prefixed strings."""
    magic = b"openssh-key-v1\0"
    if get(0, len(magic)) != magic:
        return None
    i, left = len(magic), 3
    lengths = []
    while left:
        n = int.from_bytes(get(i, i + 4), "big")
        if i + 4 + n > size:
            return None
        lengths.append(n)
        i, left = i + 4 + n, left - 1
        if len(lengths) == 3:
            keys = int.from_bytes(get(i, i + 4), "big")
            if not 1 <= keys <= 16 or i + 4 > size:
                return None
            # the public keys and the private part
            i, left = i + 4, keys + 1
    return i if all(lengths[3:]) else None


def key_size(get: Reader, size: int) -> int | None:
    return der_key_size(get, size) or openssh_key_size(get, size)


def _is_key(data: bytes | None) -> bool:
    return bool(data) and key_size(lambda i, j: data[i:j], len(data)) == len(data)


def _unbase64(s: str) -> bytes | None:
    s = s.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _is_signed(s: str) -> bool:
    head, body, signature = s.split(".")
    out = []
    for part in (head, body):
        try:
            out.append(json.loads((_unbase64(part) or b"").decode("utf-8")))
        except (ValueError, RecursionError):
            return False
    return (all(isinstance(x, dict) for x in out) and isinstance(out[0].get("alg"), str)
            and (len(_unbase64(signature) or b"") >= 16 or out[0]["alg"].lower() == "none" and not signature))


def _get64(chars: str, at: int) -> Reader:
    return lambda i, j: (_unbase64(chars[at + i // 3 * 4:at - (-j // 3) * 4]) or b"")[i % 3:i % 3 + j - i]


def _get16(chars: str, at: int) -> Reader:
    return lambda i, j: _unhex(chars[at + 2 * i:at + 2 * j]) or b""


def _unhex(s: str) -> bytes | None:
    return bytes.fromhex(s) if len(s) % 2 == 0 else None


class _Lines:
    """The lines that follow one another from ``begin``, joined once, however many
    candidates start in them."""

    def __init__(self, text: str, begin: int, end: int, more: re.Pattern):
        runs = [(begin, end)]
        while n := more.match(text, runs[-1][1]):
            runs.append(n.span(1))
        self.starts = [a for a, _ in runs]
        self.ends = [b for _, b in runs]
        self.chars = "".join([text[a:b] for a, b in runs])
        self.upto = list(accumulate(b - a for a, b in runs))


def _wrapped(text: str, start: re.Pattern, more: re.Pattern, reader, chars: int, size: int) -> list[tuple[int, int]]:
    """Spans of keys over several lines; ``chars`` of text hold ``size`` bytes.

    Linear in the text: lines are joined once, and a candidate costs the headers of its
    structure, which say where it must end.
    """
    out, at, lines = [], 0, None
    while m := start.search(text, at):
        at = m.end()
        k = bisect_left(lines.ends, at) if lines else 0
        if not lines or k == len(lines.ends) or lines.ends[k] != at or lines.starts[k] > m.start():
            lines, k = _Lines(text, m.start(), at, more), 0
        # place of the candidate in the joined lines
        place = lines.upto[k] - (at - m.start())
        n = key_size(reader(lines.chars, place), (len(lines.chars) - place) * size // chars)
        if n is None:
            continue
        want = place - (-n * chars // size)
        last = bisect_left(lines.upto, want)
        if last > k and lines.upto[last] == want:
            at = lines.ends[last]
            out.append((m.start(), _PADDING.match(text, at).end() if chars == 4 else at))
    return out


def _is_armoured(headers: str, body: str) -> bool:
    data = _unbase64(re.sub(r"\\[nr]|[\s\\]", "", body))
    if _ENCRYPTED.search(headers) and _DEK.search(headers):
        # the body is enciphered, in whole blocks
        return bool(data) and len(data) >= 16 and len(data) % 8 == 0
    return _is_key(data)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if _LONG.search(text):
        out += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
        out += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return out


def structural_spans(text: str) -> list[tuple[int, int, str]]:
    if not _LONG.search(text):
        return []
    out = [(*m.span(), "key") for m in _BASE64.finditer(text) if _is_key(_unbase64(m[0]))]
    out += [(*m.span(), "key") for m in _ANY_HEX.finditer(text)
            if len(m[0]) % 2 == 0 and _is_key(bytes.fromhex(m[0]))]
    out += [(*x, "key") for x in _wrapped(text, _START64, _NEXT64, _get64, 4, 3)]
    out += [(*x, "key") for x in _wrapped(text, _START16, _NEXT16, _get16, 2, 1)]
    if "PRIVATE KEY-----" in text:
        out += [(*m.span(), "armour") for m in _ARMOUR.finditer(text) if _is_armoured(m[2], m[3])]
    out += [(*m.span(), "signed") for m in _SIGNED.finditer(text) if _is_signed(m[0])]
    return out


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def scan(texts: list) -> dict:
    out: dict[str, list] = {k: [] for k in FIELDS}
    for t in texts:
        base = base_spans(t) if t else []
        kinds = [k for _, _, k in base]
        for k in ("assign", "access", "hex"):
            out[f"n_{k}"].append(kinds.count(k))
        out["base_sha256"].append(sha256(listed(base)))
        out["spans"].append(listed(base + structural_spans(t)) if t else "")
    return out


FIELDS = {"n_assign": "long", "n_access": "long", "n_hex": "long", "base_sha256": "string", "spans": "string"}


def scan_documents(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` plus counts and spans of every text."""
    return annotate(docs, text_col, FIELDS, scan, keep)


def masked(text: str | None, mark: str) -> str | None:
    """The text with every span (overlapping ones merged) replaced by ``mark``."""
    if not text:
        return text
    out, at = [], 0
    for s, e, _ in sorted(base_spans(text) + structural_spans(text)):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame, mark: str = "[secret]", text_col: str = "text") -> DataFrame:
    """All documents, all columns; spans replaced. A column ``n_chars`` follows the text."""
    name = fresh("masked", docs)
    out = annotate(docs, text_col, {name: "string"}, lambda texts: {name: [masked(t, mark) for t in texts]},
                   [c for c in docs.columns if c != text_col])
    cols = []
    for c, kind in docs.dtypes:
        if c == text_col:
            cols.append(F.col(name).alias(c))
        elif c == "n_chars":
            cols.append(F.coalesce(F.length(name), F.col(c)).cast(kind).alias(c))
        else:
            cols.append(F.col(quoted(c)))
    return out.select(*cols)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(read_documents(spark, sf_dir), ["doc_id"])
