"""Secret scans with structural confirmation.

Three plain patterns find assignments, access ids and long hex numbers. Besides, candidates in
base64 or hex are decoded and reported only if what they hold parses: a private key in DER, whose
nested lengths fill it exactly, an OpenSSH key file, whose length-prefixed fields do, or a signed
token with a header that names its algorithm. A key may start anywhere in a run, on any line of a
block, and be wrapped in any way; in hex its bytes may be separated.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches

#: Kinds in the order of a list of spans; the first three are the plain patterns.
KINDS = ("assign", "access", "hex", "pem", "key", "ssh", "jwt")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
#: One of these is in every assignment.
HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
FRAME = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
BODY = re.compile(r"[A-Za-z0-9+/=\s:,.-]+")
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}")
#: Lines of a wrapped run; a short last one may be a word that follows.
LINES = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}+(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]++)++={0,2}"
)
LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
#: Looked at from every start of a run, so a dotted word before a token hides nothing.
JWT = re.compile(r"(?<![A-Za-z0-9_-])(?=([A-Za-z0-9_-]{15,}+)\.([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]*+))")

#: Line ends, also written out as in JSON texts and settings files.
BREAK = re.compile(r"[\x20\t]*(?:\r?\n|(?:\\r)?\\n)[\x20\t]*")
WRITTEN_BREAK = re.compile(r"(?:\\r)?\\n")
LETTERS = re.compile(r"[A-Za-z0-9+/_-]+")
PADDING = re.compile("={0,2}")
#: How base64 of a DER sequence, an OpenSSH key file and a PEM frame starts, wherever it stands (a first
#: line of twelve letters is enough).
STARTS = re.compile(r"(?=(M[C-I][A-Za-z0-9+/_-]{8}|b3BlbnNzaC1r|LS0tLS1CRUdJ))")
_GAP = r"(?:[:\s]|\\n)*"
#: How a private key in DER starts in hex: a sequence, its length, a version or another sequence.
HEX_STARTS = re.compile(
    rf"(?=30{_GAP}(?:82{_GAP}[0-9a-f]{{2}}{_GAP}[0-9a-f]{{2}}|81{_GAP}[0-9a-f]{{2}}|[2-7][0-9a-f])"
    rf"{_GAP}(?:02{_GAP}01{_GAP}0[01]|30))",
    re.IGNORECASE,
)
HEX_DIGIT = re.compile("[0-9A-Fa-f]")
HEX_PAIR = re.compile(rf"{_GAP}([0-9A-Fa-f]{{2}})")

SPANS = "array<struct<kind:string,start:long,end:long>>"


def unbase64(text: str) -> bytes | None:
    text = re.sub(r"\s", "", text).rstrip("=").translate(str.maketrans("-_", "+/"))
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except binascii.Error:
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents that fill the data exactly; None if they don't."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data) or data[at] == 0:
                return None
            size = int.from_bytes(data[at : at + n], "big")
            at += n
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        items.append((tag, data[at : at + size]))
        at += size
    return items


INT, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def is_private_der(data: bytes | None) -> bool:
    """PKCS#1, DSA, SEC1, PKCS#8 and encrypted PKCS#8 private keys."""
    outer = der_items(data) if data and data[0] == SEQUENCE else None
    if not outer or len(outer) != 1:
        return False
    inner = der_items(outer[0][1])
    if not inner:
        return False
    tags = [t for t, _ in inner]
    if tags[:2] == [SEQUENCE, OCTETS] and len(tags) == 2:
        return _algorithm(inner[0][1]) and len(inner[1][1]) >= 16
    if tags[0] != INT or inner[0][1] not in (b"\0", b"\1"):
        return False
    if tags[:3] == [INT, SEQUENCE, OCTETS]:
        return _algorithm(inner[1][1]) and len(inner[2][1]) >= 16
    if tags[:2] == [INT, OCTETS]:
        return 16 <= len(inner[1][1]) <= 66 and all(t in (0xA0, 0xA1) for t in tags[2:])
    return set(tags) == {INT} and len(tags) in (6, 9) and len(inner[1][1]) >= 32


def _algorithm(data: bytes) -> bool:
    items = der_items(data)
    return bool(items) and items[0][0] == OID and len(items[0][1]) >= 3


def is_openssh(data: bytes | None) -> bool:
    """The key file's fields: cipher, kdf, options, number of keys, public keys, private part."""
    magic = b"openssh-key-v1\0"
    if not data or not data.startswith(magic):
        return False
    at, keys, field = len(magic), 0, 0
    while field < 4 + keys:
        if at + 4 > len(data):
            return False
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if field == 3:
            keys = size
            if not 1 <= keys <= 16:
                return False
            field += 1
            continue
        if at + size > len(data):
            return False
        at += size
        field += 1
    if at + 4 > len(data):
        return False
    return int.from_bytes(data[at : at + 4], "big") == len(data) - at - 4


def is_token(header: str, payload: str) -> bool:
    """A header that names its algorithm; the payload may be any bytes. Encrypted tokens (five
    parts) aren't signed ones."""
    try:
        head = json.loads(unbase64(header) or b"")
    except (ValueError, RecursionError):
        return False
    signed = isinstance(head, dict) and isinstance(head.get("alg"), str) and "enc" not in head
    return signed and unbase64(payload) is not None


def pem_spans(text: str) -> list[tuple[int, int]]:
    """Each END with the last BEGIN before it that has its label and no END yet."""
    found, begun = [], {}
    for m in FRAME.finditer(text):
        if m[1] == "BEGIN":
            begun[m[2]] = m
        elif begin := begun.pop(m[2], None):
            body = WRITTEN_BREAK.sub("\n", text[begin.end() : m.start()])
            if BODY.fullmatch(body):
                body = "\n".join(x for x in body.split("\n") if ":" not in x)  # without old headers
                data = unbase64(body)
                if is_private_der(data) or is_openssh(data) or "ENCRYPTED" in m[2] and data:
                    found.append((begin.start(), m.end()))
    return found


def pem_end(data: bytes | None) -> int:
    """Where the last PEM frame in decoded text ends; 0 without one."""
    frames = pem_spans(data.decode("latin-1")) if data and b"-----BEGIN " in data else []
    return max((end for _, end in frames), default=0)


def claimed(data: bytes) -> int:
    """Bytes that a DER item or an OpenSSH key file at the start of data says it has; 0 if neither."""
    if len(data) > 6 and data[0] == SEQUENCE:
        n = data[1] & 0x7F if data[1] >= 0x80 else 0
        return 2 + n + (int.from_bytes(data[2 : 2 + n], "big") if n else data[1]) if n <= 4 else 0
    magic = b"openssh-key-v1\0"
    at = len(magic)
    if not data.startswith(magic):
        return 0
    for _ in range(3):
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    for _ in range(min(keys, 16) + 1):
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at


def wrapped_spans(text: str) -> list[tuple[int, int, str]]:
    """Keys in base64 over several lines: they end with the line that holds their last byte."""
    found = []
    for m in LINES.finditer(text):
        lines = list(LINE.finditer(text, m.start(), m.end()))
        whole = "".join(x[0].rstrip("=") for x in lines)
        data = unbase64(whole[: len(whole) - (len(whole) % 4 == 1)])
        if not data:
            continue
        framed = pem_end(data)
        need = -(-(framed or claimed(data)) * 4 // 3)
        if not need:
            continue
        seen = 0
        for x in lines:
            seen += len(x[0].rstrip("="))
            if seen >= need:
                key = unbase64(whole[:seen])
                if framed:
                    found.append((m.start(), x.end(), "pem"))
                elif is_private_der(key):
                    found.append((m.start(), x.end(), "key"))
                elif is_openssh(key):
                    found.append((m.start(), x.end(), "ssh"))
                break
    return found


def letters_from(text: str, at: int, most: int) -> tuple[str, list[tuple[int, int]]]:
    """Base64 letters from a place on, over line ends, `most` at most; and where each piece of them
    starts in the letters and in the text."""
    pieces, places, n = [], [], 0
    while n < most and (m := LETTERS.match(text, at)):
        pieces.append(m[0])
        places.append((n, at))
        n += len(m[0])
        at = m.end()
        if n < most and (gap := BREAK.match(text, at)):
            at = gap.end()
        else:
            break
    return "".join(pieces)[:most], places


def place_after(places: list[tuple[int, int]], n: int) -> int:
    """Where in the text the first n letters end."""
    first, at = max(p for p in places if p[0] < n)
    return at + n - first


def started_spans(text: str, found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Keys in base64 that start in the middle of a run: behind a path or a name, on any line of a
    block, wrapped after few letters, with line ends written out. A key
    ends with its last byte: with more letters right behind it is something else. `found`: spans
    known already."""
    out = []
    covered = sorted((a, b) for a, b, kind in found if kind in ("pem", "key", "ssh"))
    until, i = 0, 0
    for m in STARTS.finditer(text):
        at = m.start()
        while i < len(covered) and covered[i][0] <= at:
            until = max(until, covered[i][1])
            i += 1
        if at < until:
            continue
        if m[1][0] == "M":
            head = unbase64(m[1][:8])
            size = claimed(head + b"\0") if head else 0
            need, kind = -(-size * 4 // 3), "key"
            n = 2 + (head[1] & 0x7F if head and head[1] >= 0x80 else 0)
            inside = head[n : n + 1] if head else b""
            if size < 24 or need > len(text) - at or inside not in (b"\x02", b"\x30"):
                continue
            letters, places = letters_from(text, at, need)
            if len(letters) < need or not is_private_der(unbase64(letters)):
                continue
        else:
            letters, places = letters_from(text, at, len(text))
            data = unbase64(letters[: len(letters) - (len(letters) % 4 == 1)])
            kind = "ssh" if m[1][0] == "b" else "pem"
            size = (claimed(data) if kind == "ssh" else pem_end(data)) if data else 0
            need = -(-size * 4 // 3)
            if not size or need > len(letters) or kind == "ssh" and not is_openssh(data[:size]):
                continue
        end = place_after(places, need)
        more = LETTERS.match(text, end)
        if more and kind != "pem":
            continue
        end = more.end() if more else end
        end = PADDING.match(text, end).end()
        out.append((at, end, kind))
        until = max(until, end)
    return out


def hex_keys(text: str, found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Keys in hex with colons, white space or line ends between their bytes, at any place of a run."""
    out, until = [], 0
    known = {a: b for a, b, kind in found if kind == "key"}
    for m in HEX_STARTS.finditer(text):
        at = m.start()
        until = max(until, known.get(at, 0))
        if at < until:
            continue
        pairs, end, need = [], at, 6
        while len(pairs) < need and (pair := HEX_PAIR.match(text, end)):
            pairs.append(pair[1])
            end = pair.end()
            if len(pairs) == 6:
                need = claimed(bytes.fromhex("".join(pairs)) + b"\0")
                if 2 * need > len(text) - at:
                    break
        if HEX_DIGIT.match(text, end):
            continue
        if need >= 24 and len(pairs) == need and is_private_der(bytes.fromhex("".join(pairs))):
            out.append((at, end, "key"))
            until = end
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def structural_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    if "-----BEGIN " in text:
        found += [(start, end, "pem") for start, end in pem_spans(text)]
    found += [(m.start(1), m.end(3), "jwt") for m in JWT.finditer(text) if is_token(m[1], m[2])]
    for m in RUN.finditer(text):
        data = unbase64(m[0])
        if is_private_der(data):
            found.append((m.start(), m.end(), "key"))
        elif is_openssh(data):
            found.append((m.start(), m.end(), "ssh"))
        elif pem_end(data):
            found.append((m.start(), m.end(), "pem"))
    if "\n" in text:
        framed = [x[:2] for x in found if x[2] == "pem"]
        found += [x for x in wrapped_spans(text) if not any(a <= x[0] and x[1] <= b for a, b in framed)]
    for m in HEX_RUN.finditer(text):
        if m[0].startswith("30") and len(m[0]) % 2 == 0 and is_private_der(bytes.fromhex(m[0])):
            found.append((m.start(), m.end(), "key"))
    found += started_spans(text, found)
    return found + hex_keys(text, found)


def in_order(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """start, end (code points, exclusive) and kind of all spans, by start, then by kind."""
    return in_order(base_spans(text) + structural_spans(text)) if text else []


def redact(text: str, found: list[tuple[int, int, str]]) -> str:
    """Every stretch that spans cover becomes one [SECRET]."""
    out, at = [], 0
    for start, end, _ in sorted(found):
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and spans (kind, start, end in code points), by start, then by kind as in
    KINDS. Null and empty texts have none. Rows are scanned one by one, so repeated and null ids
    stay; an empty table gives no rows; other columns are not read."""

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                texts = batch.column(1).slice(at, 512).to_pylist()
                found = [[{"kind": k, "start": s, "end": e} for s, e, k in spans(t)] for t in texts]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 512).cast(pa.int64()), pa.array(found, kind)],
                    ["doc_id", "spans"],
                )

    docs = in_small_batches(docs)
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        work, f"doc_id long, spans {SPANS}"
    )


def without_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with every secret in the text replaced by [SECRET]; null texts stay null."""

    @F.pandas_udf("string")
    def clean(texts):
        return texts.map(lambda t: redact(t, spans(t)) if t else t)

    return in_small_batches(docs).withColumn(text_col, clean(F.col(text_col)))

