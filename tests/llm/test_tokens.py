"""Token counts and token files against the library, text by text."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postmill.llm import bpe, simple8b
from postmill.llm.bpe import Encoder, PrefixTable
from postmill.llm.queries import QUERIES
from postmill.llm.token_counts import count_tokens, counts_at, fitting, token_table
from postmill.llm.token_files import encode_corpus, read_tokens, write_tokens
from tests.llm.conftest import SF

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    *["a", "the", "'ll", "'re", "'s", "'", " ", "  ", "\n", " \n", "\t", "é", "ü", "日本", "😀", "12", "345", "$$$", "--------"],
    *["<|endoftext|>", "<|endof", "\xa0", "　", "\x1c", "\x85", "II", "don't", "x" * 20, ".", "re", "l", "́", "²"],
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text, add_special_tokens=False).ids


def hard_texts(n):
    r = random.Random(11)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_encoder_gives_the_library_ids(library):
    texts = hard_texts(1500)
    for text, got in zip(texts, Encoder(PATH).encode(texts), strict=True):
        assert got.tolist() == ids(library, text), repr(text)


class Counting:
    """The library, with a count of what its model is asked for."""

    def __init__(self, library):
        self.library, self.asked = library, Counter()

    def __getattr__(self, name):
        return getattr(self.library, name)

    @property
    def model(self):
        return self

    def tokenize(self, shown):
        self.asked[shown] += 1
        return self.library.model.tokenize(shown)


def test_each_distinct_word_is_encoded_once(library):
    encoder = Encoder(PATH)
    encoder.library = Counting(library)
    long, texts = "ab" * 40, []  # longer than what is remembered from one stretch to the next
    for i in range(30):
        texts.append(f"Start {long} and {long}, {long}.\n{long} {'again ' * i}end")
    for text, got in zip(texts, encoder.encode(texts), strict=True):
        assert got.tolist() == ids(library, text)
    assert encoder.library.asked["Ġ" + long] == encoder.library.asked["Ġagain"] == 1


ODD = [
    *["\u1680", "\u2009", "\u2028", "\u202f", "\u205f", "\u180e", "\u200b", "\x00", "\r\n", "’", "—", "…", "×", "Â", "ª", "_"],
    *["'s,", "s'.", "it's", "'", "a.b", "(a)", "1,000.5", "a\n'll", "x.\n\ny", "é.", "日本。", "\x7f", "<|endoftext|>", "ǅ", "ɏ", "ɐ", "word"],
]


def test_cuts_of_odd_texts_in_small_stretches(library, monkeypatch):
    monkeypatch.setattr(bpe, "BYTES_TOGETHER", 500)
    monkeypatch.setattr(bpe, "BYTES_AT_ONCE", 60)
    monkeypatch.setattr(bpe, "KEPT", 40)
    r = random.Random(5)
    texts = ["".join(r.choice(ODD + PARTS + [" "] * 9 + ["\n"] * 4) for _ in range(r.randint(0, 14))) for _ in range(4000)]
    encoder = Encoder(PATH)
    expected_ids = [ids(library, text) for text in texts]
    assert [got.tolist() for got in encoder.encode(texts)] == expected_ids
    column = pa.array(["cut off", *texts]).slice(1)  # as Spark hands them over: Arrow, not from its first row
    assert [got.tolist() for got in encoder.encode(column)] == expected_ids
    assert list(encoder.encode([])) == [] and [got.tolist() for got in encoder.encode(["", ""])] == [[], []]
    assert max(len(encoder.seen), len(encoder.past)) < 400


def test_prefix_table_counts_every_prefix(library):
    texts = hard_texts(500)
    for text, steps in zip(texts, PrefixTable(PATH).steps(texts), strict=True):
        counts = np.concatenate([[0], np.cumsum(steps.astype(int))]).tolist()
        assert counts == [len(ids(library, text[:i])) for i in range(len(text) + 1)], repr(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 60), max_size=400))
def test_simple8b_round_trip(values):
    array = np.array(values, "<u4")
    words, escapes = simple8b.pack(array)
    assert simple8b.unpack(words, escapes, len(array)).tolist() == values
    block = simple8b.write_block([1, None], [array[: len(array) // 2], array[len(array) // 2 :]])
    docs, ends, found = simple8b.read_block(block)
    assert docs == [1, None] and ends.tolist() == [len(array) // 2, len(array)] and found.tolist() == values
    middle = len(values) // 3
    assert simple8b.read_from(block, middle, 50).tolist() == values[middle : middle + 50]


def test_long_blocks_are_read_from_the_middle():
    values = (np.random.default_rng(1).zipf(1.2, 70_000) % 50_257).astype("<u4")
    block = simple8b.write_block([7], [values])
    for at in (0, 1, 40_000, 69_990):
        assert (simple8b.read_from(block, at, 300) == values[at : at + 300]).all()


ROWS = [(5, "b c"), (1, None), (None, "x"), (3, ""), (5, "b c"), (2, "hi <|endoftext|> there"), (5, "a"), (9, "word " * 40_000)]


def test_counts_of_odd_rows(docs_of, library):
    got = {(r.doc_id, r.n_bytes): r for r in count_tokens(docs_of(ROWS), PATH, limit=512).collect()}
    for doc_id, text in ROWS:
        row = got[doc_id, len((text or "").encode())]
        n = len(ids(library, text or ""))
        assert (row.n_tokens, row.over_limit) == (n, n > 512)
        assert len(ids(library, (text or "")[: row.fit_chars])) <= 512
    assert count_tokens(docs_of(ROWS), PATH).count() == len(ROWS)
    assert count_tokens(docs_of([]), PATH).count() == 0


def test_budget_questions(docs_of, library):
    text = "Some words, and more of them: 12345 done."
    table = token_table(docs_of([(1, text)]), PATH)
    for n in (0, 1, 7, 20, 500):
        row = table.select(counts_at("steps", F.lit(n)).alias("at"), fitting("steps", F.lit(n)).alias("fit")).first()
        assert row.at == len(ids(library, text[:n]))
        best = max(i for i in range(len(text) + 1) if len(ids(library, text[:i])) <= n)
        assert row.fit == best


def expected(library, rows):
    """start, n_tokens, crc of each row in file order."""
    out, start = [], 0
    for doc_id, text in sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        data = np.array([*ids(library, text), 0], "<u4")
        out.append((doc_id, start, len(data), zlib.crc32(data.tobytes())))
        start += len(data)
    return out


def test_files_hold_all_ids_in_order(spark, docs_of, library):
    got = [tuple(r) for r in encode_corpus(docs_of(ROWS), PATH).orderBy("start").collect()]
    assert got == expected(library, ROWS)
    assert encode_corpus(docs_of([]), PATH).count() == 0


def test_files_can_be_read_by_others(spark, docs_of, tmp_path):
    path = str(tmp_path / "files")
    write_tokens(docs_of([(1, "one"), (2, "two")]), PATH, path)
    assert read_tokens(spark, path).count() == 2


def test_queries_agree_with_the_library(spark, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op2_token_files"](spark, SF).collect()), key=lambda r: r[1])
    assert got == expected(library, rows)
    counts = {r.doc_id: r.n_tokens for r in QUERIES["op10_token_counts"](spark, SF).collect()}
    assert counts == {d: n - 1 for d, _, n, _ in got}
