"""Personal data: expressions propose spans, validators confirm them, words nearby move the score.

Kinds ``email``, ``ip``, ``card`` (Luhn) and ``phone`` are the base and stay whatever their score.
``iban`` (mod 97) and ``ssn`` count when their score reaches THRESHOLD: a social security number
has no checksum and needs a word beside it. Expressions start only where a match can start (an
at sign, the first digit of a run), so the time is linear in the text even for endless runs.

Null text counts as empty and has no spans. Null ``doc_id`` and repeated rows are kept. Other
columns are ignored. Ties (several kinds at one place) are all reported, in the order of KINDS.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from postmill.llm import spans
from postmill.llm.common import map_texts, texts_of

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "iban", "ssn"]

# Formats, scores before context, and the words that raise them.
EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.7, "ssn": 0.3}
CONTEXT = {
    "email": {"mail", "email", "e-mail", "contact", "write"},
    "ip": {"ip", "address", "host", "server", "client"},
    "card": {"card", "credit", "debit", "visa", "mastercard", "payment", "pay"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "fax"},
    "iban": {"iban", "bank", "account", "transfer", "konto", "cuenta", "compte"},
    "ssn": {"ssn", "social", "security"},
}
THRESHOLD = 0.5
RAISE = 0.3
NEAR = 48  # characters on either side that are searched for context words
WORD = re.compile(r"[a-z][a-z-]*")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str) -> list[spans.Span]:
    """Leftmost matches without overlap: a match is decided by its at sign, its name is the whole
    run of name characters before it that no earlier match has used."""
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        host = EMAIL_HOST.match(text, at) if at > free else None
        if host:
            start = at
            while start > free and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
                start -= 1
            if start < at:
                free = host.end()
                found.append(("email", start, free))
        at = text.find("@", max(at + 1, free))
    return found


def ibans(text: str) -> list[spans.Span]:
    """Of each run, the longest head that passes the check."""
    found = []
    for m in IBAN.finditer(text):
        run = m[0]
        for end in range(len(run), 14, -1):
            code = run[:end].replace(" ", "")
            if run[end - 1] != " " and 15 <= len(code) <= 34 and mod97(code):
                found.append(("iban", m.start(), m.start() + end))
                break
    return found


def scan(text: str) -> list[tuple[str, int, int, float]]:
    """All spans of a text that count, with their scores."""
    found = emails(text) if "@" in text else []
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-3:]) <= 255 for part in m.groups()):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", m.start(), m.end()))
    found += ibans(text)
    found += [("ssn", m.start(), m.end()) for m in SSN.finditer(text)]
    out = []
    for kind, start, end in found:
        around = text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]
        near = not CONTEXT[kind].isdisjoint(WORD.findall(around.lower()))
        score = min(1.0, SCORES[kind] + RAISE * near)
        if kind in BASE or score >= THRESHOLD:
            out.append((kind, start, end, score))
    return out


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores (in the order of spans)."""

    def work(batch, texts):
        found = [scan(t) for t in texts]
        out = spans.columns([[s[:3] for s in f] for f in found], BASE, KINDS)
        place = {k: i for i, k in enumerate(KINDS)}
        ordered = [sorted(f, key=lambda s: (s[1], place[s[0]], s[2])) for f in found]
        out["scores"] = [",".join(f"{s[3]:.2f}" for s in f) for f in ordered]
        return out | {"doc_id": batch.column("doc_id").to_pylist()}

    schema = (
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, scores string"
    )
    return map_texts(texts_of(docs), work, schema)
