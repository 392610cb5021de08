"""Secret scans: patterns, then structural confirmation of encoded candidates.

Base kinds (kept as found): ``assign`` (a credential name, a sign, a value),
``access`` (access key ids), ``hex`` (long hex runs).

Confirmed kinds: base64, base64url and hex candidates are decoded and reported
only if what they hold parses to the end:

* ``der``: a DER tree of nested lengths that has the shape of a key (RSA, EC,
  PKCS#8 private keys, also encrypted, or a SubjectPublicKeyInfo),
* ``openssh``: the OpenSSH private-key container with its length-prefixed parts,
* ``sshpub``: a public key blob whose inner name is an SSH key type,
* ``pem``: an armoured block whose body decodes to one of these, or to whole cipher
  blocks if its headers name a cipher; its line breaks may be escaped (``\\n``),
* ``jwt``: three parts, the header a JSON object with a string ``alg``, the
  claims a JSON object; a full stop may follow, a fourth part may not.

A run that is no key as a whole is searched for keys inside it: wherever the decoded bytes
begin like a key and its lengths say where it ends, that part is reported, however the
key is glued to what stands around it.  Base64 may be wrapped over lines without armour, hex
may start at an odd place or be parted by colons.  What lies inside a ``pem`` span is not
reported a second time by this search.

Offsets are code points, end exclusive.  Defined cases: a null text is empty and
has no spans; equal rows give equal results; only the key columns and the text
are read.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.llm.common import sliced

#: In the order in which kinds sort at one start.
KINDS = ("assign", "access", "hex", "pem", "der", "openssh", "sshpub", "jwt")
BASE = KINDS[:3]

_ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----((?:[^-]+|-(?!----))*+)-----END \1-----")
#: Line breaks, tabs and slashes as JSON, .env files and source code write them, escaped once or more.
_ESCAPED = re.compile(r"(?<!\\)\\++(?:(?P<n>n|u000[aA])|(?P<r>r|u000[dD])|(?P<t>t|u0009)|(?P<slash>/)|(?=\s))")
_HEADER = re.compile(r"\s*(?:(?:Proc-Type|DEK-Info):[ \t]*\S+|[A-Za-z][A-Za-z0-9-]*:[^\n]*)(?=\s)")
_KNOWN = re.compile(r"\b(?P<known>Proc-Type|DEK-Info):[ \t]*(?P<value>\S+)")
_DEK = re.compile(r"([A-Z0-9-]+),((?:[0-9A-Fa-f]{2})+)")
#: A lookahead, so that a rejected candidate hides none that begins at its second part.
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(?=(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])(?!\.[A-Za-z0-9_-]))")
_B64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
_HEXES = re.compile(r"(?:[0-9a-fA-F]{2}){20,}")
#: Lines of base64, the first one not short; runs of hex; colon-separated hex, also over lines.
_LINES = re.compile(r"[A-Za-z0-9+/_-]{16,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)*+")
_HEX_RUN = re.compile(r"[0-9a-fA-F]{40,}+")
_COLONS = re.compile(r"(?<![0-9a-fA-F:])[0-9a-fA-F]{2}(?::\s*+[0-9a-fA-F]{2}(?![0-9a-fA-F])){19,}+")
#: First bytes of a key: a sequence that opens with a version number or a sequence, an SSH key type, the OpenSSH magic.
_BEGINS = re.compile(
    rb"(?=\x30(?:[\x00-\x7f]|\x81.|\x82..|\x83...|\x84....)(?:\x02\x01[\x00\x01]|\x30)|\x00\x00\x00[\x07\x0b\x13](?:ssh-|ecdsa-)|openssh-key-v1\x00)",
    re.DOTALL,
)
#: What a text must have for the patterns to be worth running; runs are counted in these bytes.
_NAMES = ("passw", "secret", "token", "apikey", "api_key")
_RUNS = bytes(b if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-" else 0x20 for b in range(256))
_SSH_TYPES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")
_OPENSSH = b"openssh-key-v1\0"
#: How many strings a public key blob of a type holds, its name included.
_SSH_PARTS = {b"ssh-rsa": 3, b"ssh-dss": 5, b"ssh-ed25519": 2}


def _decode64(s: str) -> bytes | None:
    body = s.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_tree(data: bytes | memoryview, depth: int = 0) -> list | None:
    """DER elements as (tag, content or elements); None unless they fill ``data`` to the end."""
    out, at = [], 0
    while at < len(data):
        if depth > 16 or at + 2 > len(data):
            return None
        tag, n = data[at], data[at + 1]
        at += 2
        if n == 0x80:
            return None
        if n > 0x80:
            k = n - 0x80
            if k > 4 or at + k > len(data) or data[at] == 0:
                return None
            n = int.from_bytes(data[at : at + k], "big")
            if n < 0x80:
                return None
            at += k
        if at + n > len(data):
            return None
        content = data[at : at + n]
        at += n
        if tag & 0x20:
            inner = der_tree(content, depth + 1)
            if inner is None:
                return None
            out.append((tag, inner))
        else:
            out.append((tag, content))
    return out


def is_der_key(data: bytes | memoryview) -> bool:
    """PKCS#1, SEC1 and PKCS#8 private keys, encrypted PKCS#8, and SubjectPublicKeyInfo."""
    if len(data) < 20 or data[0] != 0x30:
        return False
    tree = der_tree(data)
    if not tree or len(tree) != 1 or not tree[0][1]:
        return False
    parts = tree[0][1]
    tags = [t for t, _ in parts]
    if tags[0] == 0x02 and len(parts[0][1]) == 1 and parts[0][1][0] in (0, 1):
        if len(tags) >= 9 and all(t == 0x02 for t in tags[:9]):
            return True
        if tags[1:2] == [0x04] and len(parts[1][1]) >= 16:
            return True
        return tags[1:3] == [0x30, 0x04] and bool(parts[1][1]) and parts[1][1][0][0] == 0x06
    if tags == [0x30, 0x04]:  # a cipher with parameters (a DigestInfo has none), then what it made
        return [t for t, _ in parts[0][1]] == [0x06, 0x30] and bool(parts[0][1][1][1]) and len(parts[1][1]) >= 16
    return tags == [0x30, 0x03] and bool(parts[0][1]) and parts[0][1][0][0] == 0x06 and parts[1][1][:1] == b"\0"


def _ssh_strings(data: bytes) -> list[bytes] | None:
    out, at = [], 0
    while at < len(data):
        if at + 4 > len(data):
            return None
        n = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if at + n > len(data):
            return None
        out.append(data[at : at + n])
        at += n
    return out


def is_ssh_public(data: bytes) -> bool:
    parts = _ssh_strings(data) if len(data) > 20 else None
    return bool(parts) and len(parts) >= 2 and parts[0] in _SSH_TYPES


def is_openssh_private(data: bytes) -> bool:
    if not data.startswith(_OPENSSH):
        return False
    rest, names = data[len(_OPENSSH) :], []
    for _ in range(3):  # cipher, key derivation, its options
        n = int.from_bytes(rest[:4], "big")
        if len(rest) < 4 + n:
            return False
        names.append(rest[4 : 4 + n])
        rest = rest[4 + n :]
    keys = int.from_bytes(rest[:4], "big")
    parts = _ssh_strings(rest[4:])
    return len(rest) > 4 and parts is not None and 1 <= keys == len(parts) - 1 and all(is_ssh_public(p) for p in parts[:keys])


def key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    if is_openssh_private(data):
        return "openssh"
    if is_der_key(data):
        return "der"
    return "sshpub" if is_ssh_public(data) else None


def _after_strings(data: memoryview, at: int, n: int) -> int | None:
    """Where ``n`` length-prefixed strings that begin at ``at`` end."""
    for _ in range(n):
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at if at <= len(data) else None


def key_length(data: memoryview) -> int | None:
    """How many bytes the key at the beginning of ``data`` would have by its own lengths."""
    if data[:1] == b"\x30":
        if len(data) < 2:
            return None
        more = data[1] - 0x80 if data[1] > 0x80 else 0
        n = 2 + more + (int.from_bytes(data[2 : 2 + more], "big") if more else data[1])
        return n if n <= len(data) else None
    if data[: len(_OPENSSH)] == _OPENSSH:
        at = _after_strings(data, len(_OPENSSH), 3)
        keys = int.from_bytes(data[at : at + 4], "big") if at is not None else 0
        return _after_strings(data, at + 4, keys + 1) if 0 < keys <= len(data) // 20 else None  # no public key is shorter
    end = _after_strings(data, 0, 1)
    return end and _after_strings(data, 0, _SSH_PARTS.get(bytes(data[4:end]), 3))


def keys_within(data: bytes, step: int) -> list[tuple[int, int, str]]:
    """(first byte, byte behind, kind) of the keys in ``data`` that begin at a multiple of ``step`` bytes, none inside another."""
    out, at, whole = [], 0, memoryview(data)
    for m in _BEGINS.finditer(data):
        if m.start() < at or m.start() % step:
            continue
        n = key_length(whole[m.start() :])
        part = whole[m.start() : m.start() + n] if n else None
        if not part:
            continue
        # a view is not copied: many sequences may begin in one long run
        kind = key_kind(bytes(part)) if part[0] != 0x30 else "der" if is_der_key(part) else None
        if kind:
            at = m.start() + n
            out.append((m.start(), at, kind))
    return out


def _wrapped_keys(text: str, at: int, end: int) -> list[tuple[int, int, str]]:
    """Keys in base64 at any place between ``at`` and ``end``, line breaks left out."""
    places = [i for i in range(at, end) if text[i] not in " \t\r\n"]
    chars = "".join(text[at:end].split()).replace("-", "+").replace("_", "/")
    out = []
    for shift in range(min(4, len(chars))):
        n = len(chars) - shift
        n -= n % 4 == 1
        data = base64.b64decode(chars[shift : shift + n] + "=" * (-n % 4))
        for a, b, kind in keys_within(data, 3):
            stop = places[shift + (b * 8 + 5) // 6 - 1] + 1
            pad = -(b - a) % 3
            while pad and text[stop : stop + 1] == "=":
                stop, pad = stop + 1, pad - 1
            out.append((places[shift + a // 3 * 4], stop, kind))
    return out


def _hex_keys(text: str, places: list[int] | range) -> list[tuple[int, int, str]]:
    """Keys in the hex digits at ``places``, from an even or an odd one on."""
    out = []
    digits = "".join(text[i] for i in places)
    for shift in (0, 1):
        n = (len(digits) - shift) // 2 * 2
        for a, b, kind in keys_within(bytes.fromhex(digits[shift : shift + n]), 1):
            out.append((places[shift + 2 * a], places[shift + 2 * b - 1] + 1, kind))
    return out


def inner_spans(text: str, run: int, known: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Keys inside longer runs, wrapped lines and colon-separated hex, but for those inside spans that are ``known``."""
    out = []
    if run >= 16:
        for m in _LINES.finditer(text):
            if len(m[0]) >= 40:
                out += _wrapped_keys(text, *m.span())
    if run >= 40:
        for m in _HEX_RUN.finditer(text):
            out += _hex_keys(text, range(*m.span()))
    if text.count(":") >= 19:
        for m in _COLONS.finditer(text):
            out += _hex_keys(text, [i for i in range(*m.span()) if text[i] not in ": \t\r\n\v\f"])
    if not out:
        return out
    begins, ends, last = [], [], 0
    for a, b, _ in sorted(known):
        last = max(last, b)
        begins.append(a)
        ends.append(last)
    return [s for s in out if not (i := bisect_right(begins, s[0])) or ends[i - 1] < s[1]]


def is_pem_key(label: str, body: str) -> bool:
    """Does the body of an armoured block, after its headers, hold a key?"""
    text = _ESCAPED.sub(lambda m: {"n": "\n", "r": "\r", "t": "\t", "slash": "/"}.get(m.lastgroup, ""), body)
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    known = {m["known"]: m["value"] for m in _KNOWN.finditer(text)}
    rest = text
    while m := _HEADER.match(rest):
        rest = rest[m.end() :]
    bodies = [rest]
    if rest != text and (blank := re.search(r"\S[^\n]*\n[ \t]*\n", text)):
        bodies.append(text[blank.end() :])  # headers may go on over several lines, up to an empty one
    for rest in bodies:
        rest = re.sub(r"\s", "", rest)
        data = _decode64(rest) if re.fullmatch(r"[A-Za-z0-9+/]+=*", rest) else None
        if known.get("Proc-Type") == "4,ENCRYPTED" and label.endswith("PRIVATE KEY"):
            cipher = _DEK.fullmatch(known.get("DEK-Info", ""))
            blocks = len(cipher[2]) // 2 if cipher and cipher[1].endswith("CBC") else 1
            if cipher and data and len(data) >= 16 and len(data) % blocks == 0:
                return True
        elif key_kind(data):
            return True
    return False


def is_token(header: str, claims: str) -> bool:
    for part, needs_alg in ((header, True), (claims, False)):
        raw = _decode64(part)
        try:
            value = json.loads(raw) if raw else None
        except (ValueError, RecursionError):
            return False
        if not isinstance(value, dict) or needs_alg and not isinstance(value.get("alg"), str):
            return False
    return True


def longest_run(text: str) -> int:
    """Length of the longest run of encoding characters."""
    return max(map(len, text.encode().translate(_RUNS).split()), default=0)


def base_spans(text: str, run: int) -> list[tuple[int, int, str]]:
    out = []
    folded = text.lower()
    if any(name in folded for name in _NAMES):
        out += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if run >= 24:
        out += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return out


def confirmed_spans(text: str, run: int) -> list[tuple[int, int, str]]:
    out: list[tuple[int, int, str]] = []
    if "-----BEGIN " in text:
        out += [(*m.span(), "pem") for m in _PEM.finditer(text) if is_pem_key(m[1], m[2])]
    if "eyJ" in text:
        out += [(m.start(), m.end(3), "jwt") for m in _JWT.finditer(text) if is_token(m[1], m[2])]
    if run >= 40:
        for m in _B64.finditer(text):
            if kind := key_kind(_decode64(m[0])):
                out.append((*m.span(), kind))
        for m in _HEXES.finditer(text):
            if kind := key_kind(bytes.fromhex(m[0])):
                out.append((*m.span(), kind))
    return out + inner_spans(text, run, out)


def find_secrets(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind), sorted by start, then kind as listed."""
    if not text:
        return []
    run = longest_run(text)
    return sorted({*base_spans(text, run), *confirmed_spans(text, run)}, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType())]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def scan(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``spans array<struct<start, end, kind>>``, one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "__text"):
            found = [[{"start": a, "end": b, "kind": k} for a, b, k in find_secrets(t)] for t in part.column(part.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, _ARROW_SPANS)], [*part.schema.names[:-1], "spans"])

    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField("spans", _SPANS)]))


def redacted(text: str, spans: list[tuple[int, int, str]], mask: str = "[secret]") -> str:
    """The text with every run of overlapping spans replaced by ``mask``."""
    out, at, end = [], 0, 0
    for a, b, _ in spans:
        if a >= end:
            out += [text[max(at, end) : a], mask]
        end = max(end, b)
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with the secrets in the text masked; null texts stay null, other columns stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "__text"):
            at = part.schema.get_field_index("__text")
            texts = [t and redacted(t, find_secrets(t), mask) for t in part.column(at).to_pylist()]
            columns = part.columns
            columns[at] = pa.array(texts, part.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    names = ["__text" if c == text_col else f"__c{k}" for k, c in enumerate(docs.columns)]
    renamed = docs.toDF(*names)
    return renamed.mapInArrow(run, renamed.schema).toDF(*docs.columns)
