"""Secrets and personal data against plain searches with the whole expressions."""

import hashlib
import random
import re
import time
import zlib

import pytest

from postmill.llm import personal_data, secret_scan
from postmill.llm.personal_data import find_personal_data
from postmill.llm.queries import QUERIES
from postmill.llm.secret_scan import BASE58, BASE62, find_secrets
from tests.llm.conftest import SF

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain_secrets(text):
    found = [("assign", *m.span()) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(found + [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24])


def luhn(digits):
    doubled = [int(c) * 2 if i % 2 else int(c) for i, c in enumerate(digits[::-1])]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_data(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found)


SECRET_PARTS = [
    *["password", "TOKEN", " = ", ":", "'", '"', "abcdef12345", "AKIA", "ABCDEFGHIJKLMNOP1234", "deadbeef" * 4, "é", "İ"],
    *["api_key", "apikey", "api-key", "K", "ſecret=abcdefg", " ", "=", "secret", "x", "0123456789abcdef01234567"],
]
DATA_PARTS = [
    *["a", "b.c", "@", "@x.y", "mail.com", ".", "-", "1", "22", "255", "256", "0001", "4111111111111111", " ", "+1", "("],
    *["555", ") ", "555-1234", "+", "é", "_", "%", "٣", "²", "4242 4242 4242 4242", "378282246310005", "@a.b.c@d.e"],
]


@pytest.mark.parametrize(
    ("module", "plain", "parts"), [(secret_scan, plain_secrets, SECRET_PARTS), (personal_data, plain_data, DATA_PARTS)]
)
def test_base_spans_are_those_of_a_plain_search(module, plain, parts):
    r = random.Random(3)
    for _ in range(8000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert sorted(s[:3] for s in module.scan(text) if s[0] in module.BASE) == plain(text), repr(text)


def test_time_is_linear_in_endless_runs():
    start = time.time()
    for text in ("a" * 300_000, "1" * 300_000, "+1" + "(" * 300_000, "1." * 200_000, "a@" * 100_000, "AB12" + "C" * 300_000):
        personal_data.scan(text)
        secret_scan.scan(text + "token" * 50_000)
    assert time.time() - start < 10


def key_with_sum(prefix, body):
    number, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        number, d = divmod(number, 62)
        digits = BASE62[d] + digits
    return prefix + body + digits


def extended_key():
    data = b"\x04\x88\xad\xe4" + bytes(range(74))
    data += hashlib.sha256(hashlib.sha256(data).digest()).digest()[:4]
    number, out = int.from_bytes(data, "big"), ""
    while number:
        number, d = divmod(number, 58)
        out = BASE58[d] + out
    return out


def test_embedded_checksums_decide():
    good = key_with_sum("ghp_", "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5")
    npm = key_with_sum("npm_", "z" * 30)
    bad = good[:-1] + ("a" if good[-1] != "a" else "b")
    kinds = [s[0] for s in secret_scan.scan(f"x {good} y {bad} {npm} {extended_key()} {extended_key()[:-1]}1")]
    assert sorted(kinds) == ["github", "npm", "xprv"]


def test_checksums_and_context_decide():
    found = personal_data.scan("DE89 3704 0044 0532 0130 00, DE89 3704 0044 0532 0130 01; 219-09-9999")
    assert [s[:3] for s in found] == [("iban", 0, 27)]
    near = personal_data.scan("social security 219-09-9999 and card 4111111111111111")
    assert [(s[0], s[3]) for s in near] == [("card", 1.0), ("ssn", 0.6)]


ROWS = [(1, None), (2, ""), (None, "token=abcdef12"), (3, "token=abcdef12"), (3, "token=abcdef12"), (4, "a@b.c " * 20_000)]


@pytest.mark.parametrize("run", [find_secrets, find_personal_data])
def test_odd_rows(docs_of, run):
    got = run(docs_of(ROWS)).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 3, 4]
    assert got[1].spans == "" and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[3] == got[4]
    if run is find_secrets:
        assert got[0].spans == "assign:0:14" and got[0].n_assign == 1
    else:
        assert got[5].n_email == 20_000
    assert run(docs_of([])).count() == 0


@pytest.mark.parametrize(
    ("name", "plain", "kinds"),
    [("op3_secret_scan", plain_secrets, ["assign", "access", "hex"]), ("op4_personal_data", plain_data, ["email", "ip", "card", "phone"])],
)
def test_queries_agree_with_a_plain_search(spark, name, plain, kinds):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES[name](spark, SF).collect()
    assert len(rows) == len(texts)
    for row in rows:
        found = sorted(plain(texts[row.doc_id]), key=lambda s: (s[1], kinds.index(s[0])))
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        assert row.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in found) for k in kinds]
