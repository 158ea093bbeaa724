"""Byte-pair encoding word by word: a cache over the tokenizers library, and a prefix table.

A text is cut before every single space or line feed that stands between two characters that are
not white space. The byte-level pre-tokenizer always has a border there and looks no further ahead,
so the parts can be encoded one by one and parts seen before come from a cache. Texts that hold one
of the vocabulary's special strings, and vocabularies of another kind, are encoded whole.

The encoder also cuts behind such a line feed, and between an ASCII letter or digit and the ASCII
sign behind it: a sign never joins what stands before it, unless it is the apostrophe of a word end.
It finds the cuts of many texts at once in their bytes and encodes each distinct part once.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain
from operator import attrgetter
from typing import ClassVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core

from tokenizers import Tokenizer  # noqa: E402

CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
LONGEST_CACHED = 48  # characters of a part
CACHED = 400_000  # parts a worker remembers, some 80 MB
KEPT = CACHED // 4  # parts after which the encoder's newest become its past ones
HOT = 60_000  # of these, the ones kept in a table small enough for a processor's cache
# The usual byte-level pattern, and the characters for which every Unicode version agrees on its
# classes (fixed values).
PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
SETTLED = "\u024f"
# One pre-token by every version of Unicode: letters, with or without a space before them.
WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-\u024f]+")
AT_ONCE = 2_000  # pre-tokens whose tokens are held together
BYTES_TOGETHER = 4 << 20  # of texts whose distinct parts are encoded together
BYTES_AT_ONCE = 1 << 18  # of texts whose borders and ids are worked out together
# What a byte of UTF-8 stands for, as far as the encoder's cuts ask.
OTHER, WHITE, ALNUM, SIGN, LEAD = range(5)
WIDE_SPACES = [c.encode() for c in map(chr, range(128, 0x3001)) if c.isspace()]
WIDE_STARTS = np.zeros(1 << 16, bool)  # by their first two bytes
WIDE_STARTS[[mark[0] << 8 | mark[1] for mark in WIDE_SPACES]] = True
KINDS = np.zeros(256, np.uint8)
KINDS[[b for b in range(128) if chr(b).isspace()]] = WHITE
KINDS[[b for b in range(128) if chr(b).isalnum()]] = ALNUM
KINDS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = SIGN
KINDS[[mark[0] for mark in WIDE_SPACES]] = LEAD


class Cache(dict):
    """Works out what it does not know and remembers the newest: the older half goes when it is full.

    Workers outlive tasks. Only the caches of the operator at work are kept: they say whose they
    are, and the first use by another operator empties all others.
    """

    every: ClassVar[list[Cache]] = []
    at_work: ClassVar[list[str]] = [""]

    def __init__(self, make: Callable, owner: str):
        self.make, self.owner = make, owner
        Cache.every.append(self)

    def __missing__(self, key):
        got = self.make(key)
        if len(key) <= LONGEST_CACHED:
            self[key] = got
        return got

    @staticmethod
    def only(owner: str) -> None:
        """Empty what other operators have left in this worker."""
        if Cache.at_work != [owner]:
            Cache.at_work[:] = [owner]
            for cache in Cache.every:
                if cache.owner != owner:
                    cache.clear()

    def room(self, limit: int = CACHED) -> None:
        Cache.only(self.owner)
        if len(self) > limit:
            for key in list(self)[: limit // 2]:
                del self[key]


def parts_of(text: str) -> list[str]:
    """The parts of a text. The space that all but the first begin with, unless that is a line feed,
    is left out."""
    if " ".join(text.split()) == text.replace("\n", " "):  # single spaces and line feeds only
        return text.replace("\n", " \n").split(" ")
    first, *rest = CUT.split(text)
    return [first, *[p.removeprefix(" ") for p in rest]]


def whole(part: str) -> str:
    """A part that is not the first, as it stands in the text."""
    return part if part[0] == "\n" else " " + part


def letters(text: str) -> bool:
    """One pre-token, with or without a space before it, by every version of Unicode."""
    return text.isalpha() and max(text) <= SETTLED


def pre_tokens(library: Tokenizer, text: str) -> list[str]:
    if not text or max(text) <= SETTLED:
        return PATTERN.findall(text)
    return [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


class Encoder:
    """Token ids exactly as the library gives them, without added special tokens."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cuts = byte_level(spec)
        by_byte = {b: c for c, b in byte_letters().items()}
        self.letters = "".join(by_byte[b] for b in range(256))
        self.seen = Cache(self._text, "ids")  # part as it stands in its text -> bytes of its ids
        self.past = Cache(self._text, "ids")  # what was seen before these
        self.tokens = Cache(self._model, "ids")  # pre-token -> bytes of its ids

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _shown(self, text: str) -> str:
        return codecs.charmap_decode(text.encode(), "strict", self.letters)[0]

    def _model(self, pre_token: str) -> bytes:
        return np.array([t.id for t in self.library.model.tokenize(self._shown(pre_token))], "<u4").tobytes()

    def _words(self, words: list[str]) -> Iterable[bytes]:
        """The same for many pre-tokens without a line feed."""
        tokenize = self.library.model.tokenize
        for at in range(0, len(words), AT_ONCE):
            shown = self._shown("\n".join(words[at : at + AT_ONCE])).split(self.letters[10])
            found = list(map(tokenize, shown))
            ids = np.fromiter(map(attrgetter("id"), chain.from_iterable(found)), "<u4").tobytes()
            end = 0
            for n in map(len, found):
                start, end = end, end + 4 * n
                yield ids[start:end]

    def _text(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._whole([text])[0]
        return b"".join([self.tokens[t] for t in pre_tokens(self.library, text)])

    def _parts(self, parts: list[str], times: list[int]) -> list[bytes]:
        """Ids of distinct parts; those known or met more than once are remembered as the newest."""
        seen, past = self.seen, self.past
        found = [seen.get(p) or past.get(p) for p in parts]
        words = [p for p, ids in zip(parts, found, strict=True) if ids is None and WORD.fullmatch(p)]
        made = iter(self._words(words))
        for i, (part, ids, n) in enumerate(zip(parts, found, times, strict=True)):
            if ids is None:
                found[i] = ids = next(made) if WORD.fullmatch(part) else self._text(part)
                if n == 1:
                    continue
            if len(part) <= LONGEST_CACHED:
                seen[part] = ids
        return found

    def _borders(self, texts: pa.Array, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where parts begin in the bytes of some texts, which end at ``ends[1:]``."""
        starts, ends = ends[:-1] - ends[0], ends[1:] - ends[0]
        n = len(data)
        padded = np.zeros(n + 2, np.uint8)  # so that every byte has neighbours
        padded[1:-1] = data
        kinds = KINDS[padded]
        lead = np.flatnonzero(kinds == LEAD)
        lead = lead[WIDE_STARTS[padded[lead].astype(np.intp) << 8 | padded[lead + 1]]]
        for mark in WIDE_SPACES:
            at = lead
            for i, byte in enumerate(mark):
                at = at[padded[np.minimum(at + i, n + 1)] == byte]
            for i in range(len(mark)):
                kinds[at + i] = WHITE
        before, here, behind = kinds[:-2], kinds[1:-1], kinds[2:]
        feeds = data == 10
        border = (feeds | (data == 32)) & (before != WHITE) & (behind != WHITE)
        filled = ends > starts
        border[starts[filled]] = border[ends[filled] - 1] = False
        feeds = np.flatnonzero(border & feeds) + 1
        border |= (before == ALNUM) & (here == SIGN)
        border[feeds] = True
        for special in self.special:
            for row in np.flatnonzero(pc.match_substring(texts, special).to_numpy(zero_copy_only=False)):
                border[starts[row] : ends[row]] = False
        border[starts[filled]] = True
        return np.flatnonzero(border)

    def encode(self, texts: Sequence[str] | pa.Array) -> Iterator[np.ndarray]:
        """One array of ids per text."""
        column = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        if not self.cuts:
            for text in column:
                yield np.frombuffer(self._whole([text.as_py() or ""])[0], "<u4")
            return
        self.tokens.room(CACHED // 10)
        ends = np.frombuffer(column.buffers()[1] or bytes(8), np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        for a, b in stretches(ends, BYTES_TOGETHER):
            yield from self._encode(column.slice(a, b - a), data[ends[a] : ends[b]], ends[a : b + 1] - ends[a])

    def _encode(self, texts: pa.Array, data: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
        if len(self.seen) > KEPT:
            self.past.clear()
            self.seen, self.past = self.past, self.seen
        few = stretches(ends, BYTES_AT_ONCE)
        firsts = [self._borders(texts.slice(a, b - a), data[ends[a] : ends[b]], ends[a : b + 1]) + ends[a] for a, b in few]
        counted = [len(first) for first in firsts]
        places = np.concatenate([*firsts, ends[-1:]])
        del firsts
        buffers = [None, pa.py_buffer(places), pa.py_buffer(data)]
        coded = pa.Array.from_buffers(pa.large_string(), len(places) - 1, buffers).dictionary_encode()
        which = coded.indices.to_numpy()
        found = self._parts(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), np.bincount(which).tolist())
        pool = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins = np.cumsum(sizes) - sizes
        done = 0
        for (a, b), n in zip(few, counted, strict=True):
            first, own = places[done : done + n], which[done : done + n]
            done += n
            counts = sizes[own]
            stops = np.concatenate([[0], np.cumsum(counts)])
            at = np.repeat(begins[own] - stops[:-1], counts)
            at += np.arange(len(at))
            yield from np.split(pool[at], stops[np.searchsorted(first, ends[a + 1 : b])])


def stretches(ends: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Rows in stretches of at most ``size`` bytes (one row at least), by where the rows end."""
    rows = [0]
    while rows[-1] < len(ends) - 1:
        rows.append(max(rows[-1] + 1, int(np.searchsorted(ends, ends[rows[-1]] + size, "right")) - 1))
    return list(zip(rows, rows[1:]))  # noqa: B905


def byte_level(spec: dict) -> bool:
    """Whether the rules of cutting hold: byte-level words by the usual pattern and nothing else."""
    pre, post = spec["pre_tokenizer"] or {}, spec["post_processor"] or {"type": "ByteLevel"}
    plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"])
    return bool(
        plain
        and spec["model"]["type"] == "BPE"
        and spec["normalizer"] is None
        and not spec["truncation"]
        and not spec["padding"]
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex")
        and not pre.get("add_prefix_space")
        and post["type"] == "ByteLevel"
        and not any(spec["model"].get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        and not spec["model"].get("ignore_merges")
    )


def byte_letters() -> dict[str, int]:
    """Letter of the byte-level alphabet -> byte: printable bytes stand for themselves, the
    others for the letters from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixTable:
    """Exact token counts of every prefix, by dynamic programming over the last token.

    An encoding is valid when all neighbours in it are, so the last token of a prefix is the one
    vocabulary entry that ends it and may stand after the last token of what lies before; the
    count is one more than there. Each new word is worked out once per worker.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        if not byte_level(spec):
            raise ValueError("prefix tables need a byte-level BPE vocabulary without other rules")
        self.special = [t["content"] for t in spec["added_tokens"]]
        letter = byte_letters()
        raw = {t: bytes(letter[c] for c in t) for t in spec["model"]["vocab"]}
        vocab = spec["model"]["vocab"]
        self.ids = {raw[t]: i for t, i in vocab.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int]] = {}  # token -> the two it is merged from
        self.time: dict[int, int] = {}  # token -> rank of that merge
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocab[a], vocab[b]] = rank
            token = vocab[a + b]
            if token not in self.made:
                self.made[token], self.time[token] = (vocab[a], vocab[b]), rank
        self.right: dict[int, list[int]] = {}
        self.left: dict[int, list[int]] = {}
        self.pairs: dict[int, bool] = {}  # first token << 32 | second
        self.seen = Cache(self._part, "counts")  # part after the first -> its steps
        self.hot = Cache(self.seen.__getitem__, "counts")
        self.tokens = Cache(lambda token: signed(self._chars(token)), "counts")
        self.before = (b"", [-1], [0])  # the pre-token worked out last, its last tokens and counts
        # the vocabulary read from the last byte on: byte -> token that begins there or -1, and what may precede
        self.tree: dict[int, tuple[int, dict]] = {}
        for data in sorted(self.ids, key=len):
            node = self.tree
            for byte in data[:0:-1]:
                node = node.setdefault(byte, (-1, {}))[1]
            node[data[0]] = (self.ids[data], node.get(data[0], (-1, {}))[1])

    def _spine(self, token: int, side: int, known: dict[int, list[int]]) -> list[int]:
        """What has stood at one edge of a token, from its outermost byte to the token."""
        if token not in known:
            known[token] = [*self._spine(self.made[token][side], side, known), token] if token in self.made else [token]
        return known[token]

    def _neighbours(self, a: int, b: int) -> bool:
        """No merge across the border between two tokens comes before those that built them."""
        lefts, rights = self._spine(a, 1, self.right), self._spine(b, 0, self.left)
        i = j = 0
        never = len(self.rank)
        while True:
            grow_left = self.time[lefts[i + 1]] if i + 1 < len(lefts) else never
            grow_right = self.time[rights[j + 1]] if j + 1 < len(rights) else never
            across = self.rank.get((lefts[i], rights[j]), never)
            if across < never and across < grow_left and across <= grow_right:
                return False
            if grow_left == never and grow_right == never:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def _bytes(self, data: bytes) -> list[int]:
        """Counts of all prefixes of one pre-token, by bytes.

        What it shares with the pre-token before it is taken over, so sorted words cost less.
        """
        pairs, tree = self.pairs, self.tree
        past, last, count = self.before
        same = 0
        for a, b in zip(past, data):  # noqa: B905
            if a != b:
                break
            same += 1
        last, count = last[: same + 1], count[: same + 1]
        for end in range(same, len(data)):
            found = []
            node, start = tree, end
            while start >= 0:
                got = node.get(data[start])
                if got is None:
                    break
                token, node = got
                if token >= 0:
                    found.append((start, token))
                start -= 1
            for start, token in reversed(found):
                if start:
                    key = last[start] << 32 | token
                    good = pairs.get(key)
                    if good is None:
                        good = pairs[key] = self._neighbours(last[start], token)
                    if not good:
                        continue
                last.append(token)
                count.append(count[start] + 1)
                break
        self.before = data, last, count
        return count

    def _chars(self, text: str) -> list[int]:
        """Counts of all prefixes of one pre-token, by characters; entry 0 is the empty prefix."""
        data = text.encode()
        count = self._bytes(data)
        if len(data) == len(text):
            return count
        ends = [i for i in range(1, len(data)) if data[i] & 0xC0 != 0x80]
        return [count[i] for i in (0, *ends, len(data))]

    def counts(self, text: str) -> list[int]:
        """Token counts of all prefixes of a text without special strings."""
        out = [0]
        before = 0  # tokens of the finished pre-tokens
        run, run_count = 0, 0  # where the last white space began and the tokens before it
        in_space = False
        at = 0
        for token in pre_tokens(self.library, text):
            a, b = at, at + len(token)
            at = b
            own = self._chars(token)
            if token.strip(SPACE) == "":
                if not in_space:
                    run, run_count, in_space = a, before, True
                # a prefix that ends in white space has all of it in one pre-token
                out += [run_count + c for c in self._chars(text[run:b])[a - run + 1 :]]
            else:
                found = [before + c for c in own[1:]]
                if in_space and token[0] == " ":
                    found[0] = run_count + self._chars(text[run : a + 1])[-1]
                if token in TWO_PARTS:  # "'r" is an apostrophe and a letter, "'re" is one
                    found[1] = before + 2
                out += found
                in_space = False
            before += own[-1]
        out[-1] = before  # nothing follows: the whole text as it stands
        return out

    def _part(self, part: str) -> bytes:
        """Steps of a part that is not the first."""
        if letters(part):
            return signed(self._chars(" " + part))
        text = whole(part)
        if "'" in part or text[-1].isspace() or len(part.split()) > 1:
            return signed(self.counts(text))
        # no white space inside and none of its word ends: the steps of pre-tokens stand side by side
        tokens = pre_tokens(self.library, text)
        return b"".join([self.seen[t[1:]] if t[0] == " " and letters(t[1:]) else self.tokens[t] for t in tokens])

    def steps(self, texts: list[str]) -> list[np.ndarray]:
        """By how much each character of a text changes the token count of the prefix it ends."""
        self.seen.room()
        self.hot.room(HOT)
        self.tokens.room(CACHED // 10)
        if len(self.pairs) > 2_000_000:
            self.pairs.clear()
        known = self.hot.__getitem__
        cut = [None if any(s in text for s in self.special) else parts_of(text) for text in texts]
        heads = [parts.pop(0) if parts else "" for parts in cut]
        for part in sorted(set().union(*filter(None, cut)).difference(self.hot)):  # neighbours share their heads
            known(part)
        return [
            self._special(text)
            if parts is None
            else np.frombuffer(signed(self.counts(head)) + b"".join(map(known, parts)), np.int8)
            for text, head, parts in zip(texts, heads, cut, strict=True)
        ]

    def _special(self, text: str) -> np.ndarray:
        """The same where special strings are in the text: each is one token once complete."""
        counts, before = [0], 0
        rest = text
        while rest:
            at, special = min(
                ((rest.find(s), s) for s in self.special if s in rest), default=(len(rest), ""), key=lambda x: x[0]
            )
            own = self.counts(rest[: at + len(special)])
            done = self.counts(rest[:at])[-1]
            if special:
                counts += [before + c for c in own[1:-1]] + [before + done + 1]
                before += done + 1
            else:
                counts += [before + c for c in own[1:]]
            rest = rest[at + len(special) :]
        return np.diff(counts).astype(np.int16)


def signed(counts: list[int]) -> bytes:
    """Differences as signed bytes: a token has fewer than 128 bytes, so they fit."""
    return bytes([(b - a) & 255 for a, b in zip(counts, counts[1:])])  # noqa: B905


# White space of the pre-tokenizer's pattern, and the word ends it takes as one of three letters
# (fixed values).
SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"
TWO_PARTS = {"'re", "'ve", "'ll"}


_encoders: dict[str, Encoder] = {}
_tables: dict[str, PrefixTable] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def prefix_table(path: str) -> PrefixTable:
    if path not in _tables:
        _tables[path] = PrefixTable(path)
    return _tables[path]
