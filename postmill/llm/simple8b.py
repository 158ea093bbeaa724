"""Word-aligned coding of token ids: 64-bit words of a 4-bit selector and 60 bits of ids.

A block holds whole documents. Its bytes, all little-endian:

    header      8s magic, u32 ids, u32 words, u32 escapes, u32 documents, u32 marks, u32 zero
    marks       u32 per MARK_EVERY words: ids before that word
    ends        u32 per document: ids up to and with its last
    doc ids     i64 per document
    null flags  u8 per document, 1 where the doc id is null
    words       u64: selector in the low four bits, then the ids, the first one lowest
    escapes     u32: ids that need more than ESCAPE_BITS bits, in order

An id of ESCAPE_BITS bits all ones means "the next escape", so that a rare large id does not
widen the ids packed with it. The last word is filled up with zeros.
"""

from __future__ import annotations

import struct

import numpy as np

# Ids per word and bits per id, by selector (fixed values; selectors 0 and 1 are runs of zeros).
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE_BITS = 15
ESCAPE = (1 << ESCAPE_BITS) - 1
MARK_EVERY = 64
_widths = np.frexp(np.arange(ESCAPE + 1.0))[1].astype(np.uint8)  # bits of a number
MAGIC = b"S8BLOCK1"
HEADER = struct.Struct("<8s6I")


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escapes of an array of ids."""
    values = np.minimum(ids, ESCAPE).astype(np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, "<u8"), np.empty(0, "<u4")
    # bits that the widest of the next c ids needs, for every c in use; zeros beyond the end
    widths = np.zeros(n + 512, np.uint8)
    widths[:n] = _widths[values.astype(np.intp)]
    choice = np.full(n, 15, np.uint8)
    widest, span = widths, 1
    spans = {1: widths}
    while span < 240:
        widest = np.maximum(widest[: len(widest) - span], widest[span:])
        span *= 2
        spans[span] = widest
        if widest[:n].min() > BITS[COUNTS > span].max(initial=0):  # no longer run fits anywhere
            break
    for selector in range(14, -1, -1):
        count, bits = int(COUNTS[selector]), int(BITS[selector])
        half = 1 << (count.bit_length() - 1)
        if half not in spans:
            break
        wide = spans[half][:n]
        if count > half:
            wide = np.maximum(wide, spans[half][count - half : count - half + n])
        np.putmask(choice, wide <= bits, selector)
    # one step per word
    step = COUNTS[choice].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    first = np.array(starts)
    selectors = choice[first]
    padded = np.zeros(n + 240, np.uint64)
    padded[:n] = values
    words = selectors.astype(np.uint64)
    for selector in np.unique(selectors):
        count, bits = int(COUNTS[selector]), int(BITS[selector])
        rows = np.flatnonzero(selectors == selector)
        for k in range(count if bits else 0):
            words[rows] |= padded[first[rows] + k] << np.uint64(4 + bits * k)
    return words.astype("<u8"), ids[ids >= ESCAPE].astype("<u4")


def unpack(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of words and escapes."""
    selectors = (words & np.uint64(15)).astype(np.intp)
    ends = np.cumsum(COUNTS[selectors])
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    starts = ends - COUNTS[selectors]
    for selector in np.unique(selectors):
        count, bits = int(COUNTS[selector]), int(BITS[selector])
        if bits:
            rows = np.flatnonzero(selectors == selector)
            mask = np.uint64((1 << bits) - 1)
            for k in range(count):
                out[starts[rows] + k] = (words[rows] >> np.uint64(4 + bits * k)) & mask
    ids = out[:n].astype("<u4")
    ids[ids == ESCAPE] = escapes
    return ids


def write_block(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    joined = np.concatenate(ids) if ids else np.empty(0, "<u4")
    words, escapes = pack(joined)
    before = np.concatenate([[0], np.cumsum(COUNTS[(words & np.uint64(15)).astype(np.intp)])])
    marks = before[:-1][::MARK_EVERY].astype("<u4")
    return b"".join(
        [
            HEADER.pack(MAGIC, len(joined), len(words), len(escapes), len(ids), len(marks), 0),
            marks.tobytes(),
            np.cumsum([len(x) for x in ids], dtype="<u4").tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], "u1").tobytes(),
            words.tobytes(),
            escapes.tobytes(),
        ]
    )


def read_block(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Doc ids, ends of the documents, and all ids of a block."""
    magic, n_ids, n_words, n_escapes, n_docs, n_marks, _ = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    at = HEADER.size + 4 * n_marks
    ends = np.frombuffer(data, "<u4", n_docs, at)
    docs = np.frombuffer(data, "<i8", n_docs, at + 4 * n_docs)
    nulls = np.frombuffer(data, "u1", n_docs, at + 12 * n_docs)
    at += 13 * n_docs
    words = np.frombuffer(data, "<u8", n_words, at)
    escapes = np.frombuffer(data, "<u4", n_escapes, at + 8 * n_words)
    ids = unpack(words, escapes, n_ids)
    return [None if gone else int(d) for d, gone in zip(docs, nulls, strict=True)], ends, ids


def read_from(data: bytes, position: int, count: int) -> np.ndarray:
    """Some ids from the middle of a block: decoding begins at the mark before them."""
    _, n_ids, n_words, n_escapes, n_docs, n_marks, _ = HEADER.unpack_from(data)
    count = max(0, min(count, n_ids - position))
    marks = np.frombuffer(data, "<u4", n_marks, HEADER.size)
    if not count:
        return np.empty(0, "<u4")
    mark = int(np.searchsorted(marks, position, "right")) - 1
    last = int(np.searchsorted(marks, position + count, "left"))
    at = HEADER.size + 4 * n_marks + 13 * n_docs
    words = np.frombuffer(data, "<u8", n_words, at)
    escapes = np.frombuffer(data, "<u4", n_escapes, at + 8 * n_words)
    begin = int(marks[mark])
    stop = int(marks[last]) if last < n_marks else n_ids
    some = words[mark * MARK_EVERY : last * MARK_EVERY]
    # escapes before the mark are counted in the words before it
    used = _escapes(words[: mark * MARK_EVERY])
    return unpack(some, escapes[used : used + _escapes(some)], stop - begin)[position - begin : position - begin + count]


def _escapes(words: np.ndarray) -> int:
    total = 0
    for selector in np.flatnonzero(BITS >= ESCAPE_BITS):
        own = words[(words & np.uint64(15)) == selector]
        mask = np.uint64((1 << int(BITS[selector])) - 1)
        for k in range(int(COUNTS[selector])):
            total += int((((own >> np.uint64(4 + int(BITS[selector]) * k)) & mask) == ESCAPE).sum())
    return total
