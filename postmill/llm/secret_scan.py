"""Secrets: a keyword automaton finds places, anchored expressions confirm them, checksums decide.

Kinds ``assign``, ``access`` and ``hex`` are the base; ``github``, ``npm`` and ``xprv`` are keys
that carry a checksum inside and count only when it holds. One pass of the automaton over the
lower-cased text gives all places; expressions are tried there and nowhere else. ``hex`` has no
keyword, its expression looks for the run itself. Time is linear in the text.

Null text counts as empty and has no spans. Null ``doc_id`` and repeated rows are kept. Other
columns are ignored. Ties (several kinds at one place) are all reported, in the order of KINDS.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import ahocorasick
from pyspark.sql import DataFrame

from postmill.llm import spans
from postmill.llm.common import map_texts, texts_of

BASE = ["assign", "access", "hex"]
KINDS = [*BASE, "github", "npm", "xprv"]

# Keywords in lower case with the kind they point to, and the formats.
KEYWORDS = {
    "password": "assign",
    "passwd": "assign",
    "secret": "assign",
    "token": "assign",
    "apikey": "assign",
    "api_key": "assign",
    "akia": "access",
    "ghp_": "github",
    "gho_": "github",
    "ghu_": "github",
    "ghs_": "github",
    "ghr_": "github",
    "npm_": "npm",
    "xprv": "xprv",
}
FORMS = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "xprv": re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])"),
}
HEX = re.compile(r"[0-9a-f]{24,}")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"

_automaton = ahocorasick.Automaton()
for _word, _kind in KEYWORDS.items():
    _automaton.add_word(_word, (_kind, len(_word)))
_automaton.make_automaton()


def crc_in_base62(body: str) -> bool:
    """The last six characters are the CRC-32 of the thirty before them."""
    number, digits = zlib.crc32(body[:30].encode()), ""
    for _ in range(6):
        number, digit = divmod(number, 62)
        digits = BASE62[digit] + digits
    return digits == body[30:]


def base58_check(key: str) -> bool:
    """The last four bytes are the head of the double SHA-256 of those before them."""
    number = 0
    for c in key:
        number = number * 58 + BASE58.index(c)
    data = number.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(data[:-4]).digest()).digest()[:4] == data[-4:]


CHECKS = {
    "assign": lambda m: len(m[2]) >= 6,
    "access": lambda m: len(m[0]) >= 20,
    "github": lambda m: crc_in_base62(m[1]),
    "npm": lambda m: crc_in_base62(m[1]),
    "xprv": lambda m: base58_check(m[0]),
}


def scan(text: str) -> list[spans.Span]:
    """All spans of a text."""
    # lower() keeps the length of every character but this one
    lowered = text.lower() if "İ" not in text else text.replace("İ", "i").lower()
    places: dict[str, list[int]] = {}
    for last, (kind, size) in _automaton.iter(lowered):
        places.setdefault(kind, []).append(last - size + 1)
    found = [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    for kind, starts in places.items():
        form, check, free = FORMS[kind], CHECKS[kind], 0
        for start in sorted(starts):
            if start >= free and (m := form.match(text, start)):
                free = m.end()  # a match that fails its check uses up its text as well
                if check(m):
                    found.append((kind, start, free))
    return found


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""

    def work(batch, texts):
        return {"doc_id": batch.column("doc_id").to_pylist()} | spans.columns([scan(t) for t in texts], BASE, KINDS)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_texts(texts_of(docs), work, schema)
