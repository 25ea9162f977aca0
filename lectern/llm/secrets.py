"""Secret scan: Aho-Corasick keyword prefilter, anchored regular expressions near hits, checksum validation."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from lectern.llm.common import map_rows, table

#: keyword (lower case) -> the kind whose anchored expression is tried where the keyword starts.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm", "eyj": "jwt",
}
ANCHORED = {
    "assign": re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "github": re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "npm": re.compile(rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "jwt": re.compile(rb"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
}
#: Where a token's first part ends: one that starts later in the same part fails for the same reason.
JWT_PART = re.compile(rb"[A-Za-z0-9_-]*")
#: A hexadecimal key has no keyword: its shape is its only anchor.
HEX = re.compile(rb"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "github", "npm", "jwt")
BASE = KINDS[:3]
DIGITS62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62_crc(body: bytes) -> bytes:
    """CRC-32 of ``body`` as six base-62 digits, the checksum in prefixed access tokens."""
    n, out = zlib.crc32(body), b""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = DIGITS62[r : r + 1] + out
    return out


def is_jwt(token: bytes) -> bool:
    """Whether the first part is a JSON object with an algorithm; one nested too deeply to be read is none."""
    head = token.split(b".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + b"=" * (-len(head) % 4)))
    except (binascii.Error, ValueError, TypeError, RecursionError):
        return False


def valid(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[2]) >= 6
    if kind == "access":
        return len(m[0]) >= 20
    if kind in ("github", "npm"):
        return base62_crc(m[0][4:-6]) == m[0][-6:]
    return is_jwt(m[0])


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


def find_secrets(text: str | None, words) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points, by start, then kind. ``words`` is :func:`automaton`'s result.

    Per kind, matches are leftmost and do not overlap; one that fails its length or checksum test is dropped and its text
    isn't tried again. Null and empty texts have none.
    """
    if not text:
        return []
    raw = text.encode()
    found, after = [], dict.fromkeys(KINDS, 0)
    hits = sorted((end + 1 - n, kind) for end, (n, kind) in words.iter(raw.lower().decode("latin-1")))
    for at, kind in hits:
        if at < after[kind]:
            continue
        if m := ANCHORED[kind].match(raw, at):
            after[kind] = m.end()
            if valid(kind, m):
                found.append((at, kind, m.end()))
        elif kind == "jwt" and raw.startswith(b"eyJ", at):
            after[kind] = JWT_PART.match(raw, at).end()
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(raw)]
    if not found:
        return []
    if len(raw) != len(text):  # bytes to code points, one pass over the sorted offsets
        at, seen, points = 0, 0, {}
        for x in sorted({p for s, _, e in found for p in (s, e)}):
            seen += len(raw[at:x].decode())
            at, points[x] = x, seen
        found = [(points[s], k, points[e]) for s, k, e in found]
    return [(k, s, e) for s, k, e in sorted(found, key=lambda x: (x[0], KINDS.index(x[1]), x[2]))]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>) for every row of ``docs`` (doc_id, text); other columns are not read.

    Null and empty texts have no spans; long ones are scanned whole, in time that grows with their length. Rows with a null id and
    repeated rows each give their own; an empty table gives no rows.
    """

    def make():
        words = automaton()

        def rows(cols: list[list]) -> Iterator[tuple]:
            for i, text in zip(*cols, strict=True):
                yield i, [{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(text, words)]

        return rows

    return map_rows(docs.select("doc_id", "text"), "doc_id long, spans array<struct<kind:string,start:int,end:int>>", make)


def redact(text: str | None, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str | None:
    """``text`` with every maximal run of overlapping spans replaced by ``mark``."""
    if not spans:
        return text
    out, at, upto = [], 0, -1
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if s >= upto:
            out += [text[at:s], mark] if s >= at else []
        upto = max(upto, e)
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets in ``text`` replaced and ``n_chars``, if there, recounted where the text changed.

    All rows and columns stay, null and empty texts, null ids and repeated rows as they are; an empty table stays empty.
    """
    names = docs.columns
    schema, text, chars = docs.schema, names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def make():
        words = automaton()

        def rows(cols: list[list]) -> Iterator[tuple]:
            for row in zip(*cols, strict=True):
                if spans := find_secrets(row[text], words):
                    row = list(row)
                    row[text] = redact(row[text], spans)
                    if chars is not None:
                        row[chars] = len(row[text])
                yield tuple(row)

        return rows

    return map_rows(docs, schema, make)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of :func:`scan`: counts and hash of the base kinds, and all spans as text."""

    def make():
        words = automaton()

        def rows(cols: list[list]) -> Iterator[tuple]:
            for i, text in zip(*cols, strict=True):
                spans = find_secrets(text, words)
                base = [x for x in spans if x[0] in BASE]
                yield (i, *(sum(x[0] == k for x in base) for k in BASE), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))

        return rows

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return map_rows(docs, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string", make)
