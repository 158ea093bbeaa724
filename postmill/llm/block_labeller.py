"""Main text of pages: a bidirectional LSTM labels every block of a page as content or not.

A block's input is the sum of learned vectors of its hashed tag path (tags and the words of class,
id and role), the mean of learned vectors of its hashed words, and a few plain measures. The network
reads the whole page in both directions, so a block is judged by what stands around it. It is
numpy throughout and is trained here, on pages drawn from a grammar of layouts whose blocks are
labelled by construction (``training_pages`` of them, a documented bound; the same seed gives the
same network). Pages of about the same number of blocks are labelled together, so memory depends
on the batch, not on the table; a page of very many blocks is a batch of its own, read in stretches of
STEP_BLOCKS of which only the scores and the last states are kept. Vectors of paths are summed along the
tree of elements, so that deep nests cost no more than flat pages.

Null html counts as empty and gives an empty text; so do pages without content. Null ``page_id`` or
``url`` are kept. Repeated rows are labelled one by one. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.bpe import Cache
from postmill.llm.common import pa_schema, slices
from postmill.llm.html_blocks import Block, Element, blocks
from postmill.llm.page_grammar import MARK, labelled_page

PATHS, WORDS = 8192, 16384  # rows of the two tables of vectors
PATH_SIZE, WORD_SIZE, PLAIN, HIDDEN = 24, 12, 6, 24
TRAINING_PAGES, EPOCHS, TOGETHER, RATE, SEED = 2400, 6, 32, 0.01, 7
WORD_DECAY = 0.01
CACHED_WORDS = 200_000
STEP_BLOCKS = 4096  # padded blocks that are labelled together
SCHEMA = "page_id long, url string, text string, n_chars long, n_blocks long"

_word_rows = Cache(lambda word: zlib.crc32(word.encode()) % WORDS, "pages")
_path_rows = Cache(lambda path: [_part_rows[t] for t in _steps(path)], "pages")
_part_rows = Cache(lambda part: zlib.crc32(part.encode()) % PATHS, "pages")


def _steps(path: tuple[str, ...]) -> set[str]:
    """Parts of a path that have vectors: every tag and name, every two neighbours, and the last."""
    return {*path, *map(">".join, zip(path, path[1:])), "last=" + (path[-1] if path else ""), "depth=" + str(min(len(path), 9))}  # noqa: B905


def _places(n: int) -> np.ndarray:
    """Where in the page each of its blocks stands, from 0 to 1."""
    return np.linspace(0, 1, n) if n > 1 else np.zeros(n)


def path_vectors(flat: list[Block], table: np.ndarray) -> np.ndarray:
    """Summed vectors of every block's ``_steps``, each element worked out once: what it adds to its
    parent are the steps that the path above it does not have."""
    out = np.zeros((len(flat), PATH_SIZE), np.float32)
    held: Counter[str] = Counter()  # steps on the path that is open
    path: list[tuple[Element, list[str], np.ndarray]] = []
    top = np.zeros(PATH_SIZE)
    for i, b in enumerate(flat):
        at, fresh = b.element, []
        while at is not None and not (at.level <= len(path) and path[at.level - 1][0] is at):
            fresh.append(at)
            at = at.parent
        while len(path) > (at.level if at else 0):
            held.subtract(path.pop()[1])
        for element in reversed(fresh):
            parts = [element.tag, *element.names]
            before = [path[-1][0].last, *parts] if path else parts
            steps = parts + list(map(">".join, zip(before, before[1:])))  # noqa: B905
            vector = path[-1][2] if path else top
            for step in steps:
                if not held[step]:
                    vector = vector + table[_part_rows[step]]
                held[step] += 1
            path.append((element, steps, vector))
        depth = b.element.depth if b.element else 0
        last = b.element.last if b.element else ""
        out[i] = (path[-1][2] if path else top) + table[_part_rows["last=" + last]] + table[_part_rows[f"depth={min(depth, 9)}"]]
    return out


class Inputs:
    """Blocks of several pages, one after the other, as index and number arrays.

    For labelling, the vectors of their paths and their places in the page are given."""

    def __init__(self, pages: list[list[Block]], paths: list[np.ndarray] | None = None, places: list[np.ndarray] | None = None):
        flat = [b for page in pages for b in page]
        self.lengths = np.array([len(p) for p in pages], np.intp)
        self.paths = None if paths is None else np.concatenate(paths)
        if paths is None:
            rows = [_path_rows[b.path] for b in flat]
            self.path_rows = np.fromiter((r for own in rows for r in own), np.intp)
            self.path_owner = np.repeat(np.arange(len(flat)), [len(r) for r in rows])
        words = [b.text.lower().split() for b in flat]
        self.word_rows = np.fromiter(map(_word_rows.__getitem__, (w for own in words for w in own)), np.intp)
        n_words = np.array([len(w) for w in words], np.intp)
        self.word_owner = np.repeat(np.arange(len(flat)), n_words)
        self.word_share = 1 / np.maximum(1, n_words)
        chars = np.array([len(b.text) for b in flat], float)
        linked = np.array([b.link_chars for b in flat], float)
        ends = np.array([b.text[-1] in ".!?…:" for b in flat], float)
        place = np.concatenate([*(map(_places, self.lengths) if places is None else places), np.empty(0)])
        self.plain = np.stack(
            [np.log1p(chars) / 6, linked / np.maximum(1, chars), np.log1p(n_words) / 4, ends, place, np.ones(len(flat))], axis=1
        ).reshape(len(flat), PLAIN)

    def vectors(self, net: dict[str, np.ndarray]) -> np.ndarray:
        n = len(self.plain)
        path, word = self.paths, np.zeros((n, WORD_SIZE))
        if path is None:
            path = np.zeros((n, PATH_SIZE))
            _add(path, self.path_owner, net["path"][self.path_rows])
        _add(word, self.word_owner, net["word"][self.word_rows])
        return np.concatenate([path, word * self.word_share[:, None], self.plain], axis=1)

    def padded(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(steps, pages, size) and the mask of real steps."""
        longest = int(self.lengths.max(initial=0))
        mask = np.arange(longest)[:, None] < self.lengths[None, :]
        out = np.zeros((len(self.lengths), longest, x.shape[1]))
        out[mask.T] = x
        return out.transpose(1, 0, 2), mask


def _add(out: np.ndarray, owner: np.ndarray, rows: np.ndarray) -> None:
    """Sums of consecutive rows of one owner."""
    if len(owner):
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        out[owner[starts]] = np.add.reduceat(rows, starts, axis=0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _read(x: np.ndarray, mask: np.ndarray, net: dict, way: str, state: tuple | None = None, tape: list | None = None) -> tuple:
    """Hidden states of one direction, from a state on, and the last state; padding leaves the state
    as it is. Learning needs the tape, on which every step is written."""
    steps, pages, _ = x.shape
    w, u = net[f"w_{way}"], net[f"u_{way}"]
    ahead = x @ w + net[f"c_{way}"]
    h, c = state or (np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN)))
    out = np.zeros((steps, pages, HIDDEN))
    for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
        z = ahead[t] + h @ u
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        m = mask[t][:, None]
        c_new = np.where(m, f * c + i * g, c)
        tanh_c = np.tanh(c_new)
        h_new = np.where(m, o * tanh_c, h)
        if tape is not None:
            tape.append((t, h, c, i, f, o, g, tanh_c, m))
        h, c = h_new, c_new
        out[t] = h
    return out, (h, c)


def _learn_back(d_out: np.ndarray, x: np.ndarray, tape: list, net: dict, way: str, grads: dict) -> np.ndarray:
    """Gradients of one direction, from those of its hidden states."""
    w, u = net[f"w_{way}"], net[f"u_{way}"]
    d_h = np.zeros(d_out.shape[1:])
    d_c = np.zeros(d_out.shape[1:])
    d_ahead = np.zeros((*x.shape[:2], 4 * HIDDEN))
    for t, h, c, i, f, o, g, tanh_c, m in reversed(tape):
        d_h = d_h + d_out[t]
        own_h = np.where(m, d_h, 0)
        own_c = np.where(m, d_c, 0) + own_h * o * (1 - tanh_c**2)
        d_z = np.concatenate(
            [own_c * g * i * (1 - i), own_c * c * f * (1 - f), own_h * tanh_c * o * (1 - o), own_c * i * (1 - g**2)], axis=1
        )
        d_ahead[t] = d_z
        grads[f"u_{way}"] += h.T @ d_z
        d_h = np.where(m, 0, d_h) + d_z @ u.T
        d_c = np.where(m, own_c * f, d_c)
    grads[f"w_{way}"] += x.reshape(-1, x.shape[2]).T @ d_ahead.reshape(-1, 4 * HIDDEN)
    grads[f"c_{way}"] += d_ahead.sum(axis=(0, 1))
    return d_ahead @ w.T


def _scores(inputs: Inputs, net: dict) -> tuple:
    x, mask = inputs.padded(inputs.vectors(net))
    tape_f: list = []
    tape_b: list = []
    ahead, _ = _read(x, mask, net, "f", tape=tape_f)
    back, _ = _read(x, mask, net, "b", tape=tape_b)
    both = np.concatenate([ahead, back], axis=2)
    return both @ net["out"] + net["bias"], both, x, mask, tape_f, tape_b


def labelled(random: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """Blocks of a drawn page and which of them are content."""
    found = blocks(labelled_page(random))
    marks = [MARK in b.text for b in found]
    for b in found:
        b.text = b.text.replace(MARK, "").strip() or "-"
    return found, marks


@lru_cache(maxsize=2)
def trained(training_pages: int = TRAINING_PAGES, seed: int = SEED) -> dict[str, np.ndarray]:
    """The network; trained once per driver, in a few seconds."""
    random = np.random.default_rng(seed)
    size = PATH_SIZE + WORD_SIZE + PLAIN
    # zeros: a name or word that no training page had says nothing
    net = {"path": np.zeros((PATHS, PATH_SIZE)), "word": np.zeros((WORDS, WORD_SIZE))}
    for way in "fb":
        net[f"w_{way}"] = random.normal(0, size**-0.5, (size, 4 * HIDDEN))
        net[f"u_{way}"] = random.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
        net[f"c_{way}"] = np.zeros(4 * HIDDEN)
        net[f"c_{way}"][HIDDEN : 2 * HIDDEN] = 1  # remember at first
    net["out"], net["bias"] = random.normal(0, 0.2, 2 * HIDDEN), np.zeros(1)
    read = [labelled(random) for _ in range(training_pages)]
    read = sorted((p for p in read if p[0]), key=lambda p: len(p[0]))
    batches = []
    for i in range(0, len(read), TOGETHER):
        some = read[i : i + TOGETHER]
        batches.append((Inputs([p for p, _ in some]), np.array([v for _, marks in some for v in marks], float)))
    first, second = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        for number in random.permutation(len(batches)):
            inputs, wanted = batches[number]
            score, both, x, mask, tape_f, tape_b = _scores(inputs, net)
            d = np.zeros_like(score)
            d.T[mask.T] = _sigmoid(score.T[mask.T]) - wanted
            d /= len(wanted)
            grads = {k: np.zeros_like(v) for k, v in net.items()}
            grads["out"], grads["bias"] = np.einsum("tph,tp->h", both, d), np.array([d.sum()])
            d_both = d[:, :, None] * net["out"]
            d_x = _learn_back(d_both[:, :, :HIDDEN], x, tape_f, net, "f", grads)
            d_x = d_x + _learn_back(d_both[:, :, HIDDEN:], x, tape_b, net, "b", grads)
            d_x = d_x.transpose(1, 0, 2)[mask.T]
            np.add.at(grads["path"], inputs.path_rows, d_x[inputs.path_owner, :PATH_SIZE])
            d_word = d_x[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] * inputs.word_share[:, None]
            np.add.at(grads["word"], inputs.word_rows, d_word[inputs.word_owner])
            step += 1
            rate = RATE * (1 - 0.9 * epoch / EPOCHS)
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g**2
                if k == "word":  # invented words stand in all kinds of blocks: only what returns is kept
                    net[k] *= 1 - WORD_DECAY
                net[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return net


def _labelling_scores(pages: list[list[Block]], net: dict[str, np.ndarray]) -> np.ndarray:
    """(steps, pages); of a stretch only the scores and the state at its end are kept."""
    longest = max(map(len, pages))
    paths = [path_vectors(p, net["path"]) for p in pages]
    places = [_places(len(p)) for p in pages]

    @lru_cache(maxsize=1)
    def stretch(start: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(start, start + STEP_BLOCKS)
        inputs = Inputs([p[part] for p in pages], [v[part] for v in paths], [v[part] for v in places])
        return inputs.padded(inputs.vectors(net))

    starts = range(0, longest, STEP_BLOCKS)
    score = np.zeros((longest, len(pages))) + net["bias"]
    for way, weights in zip("fb", np.split(net["out"], 2), strict=True):
        state = None
        for start in starts if way == "f" else reversed(starts):
            out, state = _read(*stretch(start), net, way, state)
            score[start : start + len(out)] += out @ weights
    return score


def label(pages: list[list[Block]], net: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Which blocks of each page are content."""
    out: list[np.ndarray] = [np.empty(0, bool)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    some: list[int] = []
    for place, i in enumerate(order):
        some.append(i)
        following = len(pages[order[place + 1]]) if place + 1 < len(order) else STEP_BLOCKS + 1
        if following * (len(some) + 1) > STEP_BLOCKS:
            score = _labelling_scores([pages[k] for k in some], net)
            for column, k in enumerate(some):
                out[k] = score[: len(pages[k]), column] > 0
            some = []
    return out


def main_text(pages: list[str], net: dict[str, np.ndarray]) -> list[tuple[str, int]]:
    """Joined content blocks and the number of all blocks."""
    _word_rows.room(CACHED_WORDS)
    _path_rows.room(CACHED_WORDS)
    found = [blocks(p) for p in pages]
    kept = label(found, net)
    return [(" ".join(b.text for b, k in zip(f, keep, strict=True) if k), len(f)) for f, keep in zip(found, kept, strict=True)]


def extract(pages: DataFrame, training_pages: int = TRAINING_PAGES) -> DataFrame:
    """page_id, url, text, n_chars (code points), n_blocks."""
    spark = pages.sparkSession
    net = spark.sparkContext.broadcast(trained(training_pages))  # a fixed size, under 1 MB
    types = pa_schema(spark, SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "html"):
                found = main_text(texts, net.value)
                arrays = [
                    part.column("page_id"),
                    part.column("url"),
                    pa.array([t for t, _ in found], pa.string()),
                    pa.array([len(t) for t, _ in found], pa.int64()),
                    pa.array([n for _, n in found], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=types)

    wanted = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return wanted.mapInArrow(run, SCHEMA)
