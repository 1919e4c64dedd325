"""Secret scans: pattern matches, and candidates whose decoded structure proves a key or token."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from cohorta.llm.common import text_of, travels

travels(__name__)

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ["assign", "access", "hex"]

# What structure confirms. Order of kinds at equal starts: the base ones, then these.
CONFIRMED = ["der_key", "ssh_key", "signed_token"]
ORDER = {kind: i for i, kind in enumerate(KINDS + CONFIRMED)}

LONG_WORD = 32  # a key or token of fewer characters cannot be encoded
_RUN = re.compile(r"[A-Za-z0-9+/_=.-]{%d,}" % LONG_WORD)
_ARMOUR = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----\s*([A-Za-z0-9+/=\s]+?)\s*-----END [A-Z0-9 ]*PRIVATE KEY-----")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
_HEX_ANY = re.compile(r"(?:[0-9a-f]{2}){16,}|(?:[0-9A-F]{2}){16,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]+)")
_SSH_MAGIC = b"openssh-key-v1\0"


def _decode64(text: str) -> bytes | None:
    raw = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(raw) % 4 == 1:
        return None
    try:
        return base64.b64decode(raw + "=" * (-len(raw) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the DER element at ``at``; None if it does not fit."""
    if at + 2 > end:
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size >= 0x80:
        width = size & 0x7F
        if not 1 <= width <= 4 or start + width > end:
            return None
        size, start = int.from_bytes(data[start:start + width], "big"), start + width
        if size < 0x80:
            return None
    return (tag, start, start + size) if start + size <= end else None


def is_der_key(data: bytes) -> bool:
    """A SEQUENCE that fills the data, whose nested elements fill it in turn, laid out as a key.

    Private keys (version first: PKCS#1, PKCS#8, SEC 1) and public ones (algorithm, then bits).
    """
    outer = _element(data, 0, len(data))
    if not outer or outer[0] != 0x30 or outer[2] != len(data):
        return False
    tags, at, contents = [], outer[1], []
    while at < outer[2]:
        part = _element(data, at, outer[2])
        if not part:
            return False
        tags.append(part[0])
        contents.append((part[1], part[2]))
        at = part[2]
    if tags[:1] == [0x02]:
        if contents[0][1] - contents[0][0] != 1 or data[contents[0][0]] > 1:
            return False
        if len(tags) >= 9 and set(tags[:9]) == {0x02}:
            return True  # PKCS#1
        if tags[1:3] == [0x30, 0x04]:
            inner = _element(data, contents[1][0], contents[1][1])
            return bool(inner) and inner[0] == 0x06  # PKCS#8
        return tags[1:2] == [0x04] and all(t in (0xA0, 0xA1) for t in tags[2:])  # SEC 1
    if tags == [0x30, 0x03]:
        inner = _element(data, contents[0][0], contents[0][1])
        return bool(inner) and inner[0] == 0x06  # a public key's bits
    return False


def is_ssh_key(data: bytes) -> bool:
    """The magic text of the format, then three strings with lengths that fit, then a key count."""
    if not data.startswith(_SSH_MAGIC):
        return False
    at = len(_SSH_MAGIC)
    for _ in range(3):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at:at + 4], "big")
    return at + 4 <= len(data) and 1 <= int.from_bytes(data[at:at + 4], "big") <= 16


def is_token_header(text: str) -> bool:
    """base64url of a JSON object that names its algorithm."""
    raw = _decode64(text)
    if raw is None or raw[:1] != b"{":
        return False
    try:
        header = json.loads(raw)
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def _kind_of(data: bytes | None) -> str | None:
    if not data:
        return None
    return "der_key" if data[0] == 0x30 and is_der_key(data) else "ssh_key" if is_ssh_key(data) else None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api")):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if any(len(w) >= 16 for w in text.split()):
        found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], ORDER[s[2]]))


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans whose decoded bytes are a key or a signed token. Overlaps of a kind keep the longest first."""
    found = []
    if "-----BEGIN" in text:
        for m in _ARMOUR.finditer(text):
            kind = _kind_of(_decode64("".join(m[1].split())))
            if kind:
                found.append((m.start(), m.end(), kind))
    if any(len(w) >= LONG_WORD for w in text.split()):
        for run in _RUN.finditer(text):
            part, at = run[0], run.start()
            if "." in part:
                for m in _TOKEN.finditer(part):
                    if is_token_header(m[1]):
                        found.append((at + m.start(), at + m.end(), "signed_token"))
            for m in _BASE64.finditer(part):
                kind = _kind_of(_decode64(m[0]))
                if kind:
                    found.append((at + m.start(), at + m.end(), kind))
            for m in _HEX_ANY.finditer(part):
                kind = _kind_of(bytes.fromhex(m[0]))
                if kind:
                    found.append((at + m.start(), at + m.end(), kind))
    kept: list[tuple[int, int, str]] = []
    for s in sorted(set(found), key=lambda s: (s[0] - s[1], s[0], ORDER[s[2]])):
        if not any(k[2] == s[2] and s[0] < k[1] and k[0] < s[1] for k in kept):
            kept.append(s)
    return kept


def spans_text(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(spans, key=lambda s: (s[0], ORDER[s[2]])))


def redact(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones as one, replaced by the mark."""
    out, at = [], 0
    for a, b, _ in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


SCAN_SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
               "redacted string")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per input row: counts per base kind, all spans, and the redacted text if asked for.

    Spans are ``kind:start:end`` in code points, joined by commas. Null texts count as empty and
    have no span; repeated rows are scanned each; an empty table gives no rows. Each text is
    scanned whole in its own task; nothing is shuffled. ``redacted`` is null without ``with_text``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                base = base_spans(text)
                spans = base + confirmed_spans(text)
                kinds = [s[2] for s in base]
                rows.append((doc_id, *[kinds.count(k) for k in KINDS],
                             hashlib.sha256(spans_text(base).encode()).hexdigest(), spans_text(spans),
                             (redact(text, spans) if spans else text) if with_text else None))
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.schema.field(0).type), *[pa.array(c, pa.int64()) for c in columns[1:4]],
                 *[pa.array(c, pa.string()) for c in columns[4:]]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "redacted"])

    id_type = dict(docs.dtypes)[id_col]
    picked = docs.select(docs[id_col].alias("doc_id"), text_of(text_col).alias("text"))
    return picked.mapInArrow(run, SCAN_SCHEMA.replace("doc_id long", f"doc_id {id_type}", 1))


def redact_documents(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs``, all columns, with every found span replaced by a mark.

    ``length_col``, if there is one, becomes the new length in code points. Null texts stay null.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = []
            for text in batch.column(at).to_pylist():
                spans = base_spans(text) + confirmed_spans(text) if text else []
                texts.append(redact(text, spans) if spans else text)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if length_col in batch.schema.names:
                n = batch.schema.get_field_index(length_col)
                columns[n] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
