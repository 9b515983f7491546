"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Token boundaries are found without a regular expression. Every code point gets a class from an array.
Each class stands for a transition function on four states; a function fits in one byte, and composing
two is one look-up in a 256 x 256 table. Composition is associative, so the states after every code
point of a batch come from a blocked prefix scan. The slices between boundaries go to a pair merger with a
bounded cache. Offsets (the end of each token in its text's bytes) are kept, and decoding joins the
tokens' bytes.

Defined results: a null text is an empty one (no tokens); repeated rows give repeated results; extra
columns are not read.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, quoted, small_batches, text_slices

#: Classes of code points.
LETTER, NUMBER, OTHER, SPACE, BLANK, APOSTROPHE, END, TAIL = range(8)
#: States: closed (a letter, a number or a white-space character other than U+0020 came last, or nothing), in
#: a run of other characters, in a contraction, after U+0020.
CLOSED, RUN, SHORT, AFTER_BLANK = range(4)
#: White_Space of the Unicode character database: fixed values.
WHITE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SENTINEL = 0x110000
#: Words kept by a worker's cache before it starts anew.
CACHE_WORDS = 400_000
#: Slices up to so many bytes are merged side by side and cached, so many at once.
SHORT_WORD, MANY = 48, 4096
PAD, NONE = (1 << 20) - 1, 1 << 30


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of each code point; the sentinel between texts is END."""
    kind = np.full(SENTINEL + 1, OTHER, np.uint8)
    for c in range(SENTINEL):
        k = unicodedata.category(chr(c))[0]
        if k == "L":
            kind[c] = LETTER
        elif k == "N":
            kind[c] = NUMBER
    kind[WHITE] = SPACE
    kind[0x20] = BLANK
    kind[SENTINEL] = END
    return kind


def function(*to: int) -> int:
    """A transition function as a byte: two bits for what each state becomes."""
    return to[0] | to[1] << 2 | to[2] << 4 | to[3] << 6


#: By class. TAIL: a letter that may end a contraction. APOSTROPHE: one that a contraction's letters follow.
TRANSITIONS = np.array([
    function(CLOSED, CLOSED, CLOSED, CLOSED),
    function(CLOSED, CLOSED, CLOSED, CLOSED),
    function(RUN, RUN, RUN, RUN),
    function(CLOSED, CLOSED, CLOSED, CLOSED),
    function(AFTER_BLANK, AFTER_BLANK, AFTER_BLANK, AFTER_BLANK),
    function(SHORT, RUN, SHORT, RUN),
    function(CLOSED, CLOSED, CLOSED, CLOSED),
    function(CLOSED, CLOSED, SHORT, CLOSED),
], np.uint8)


@lru_cache(1)
def composed() -> np.ndarray:
    """composed()[f * 256 + g]: first f, then g."""
    f, g = np.arange(256)[:, None], np.arange(256)[None, :]
    out = np.zeros((256, 256), np.int64)
    for s in range(4):
        out |= ((g >> 2 * ((f >> 2 * s) & 3)) & 3) << 2 * s
    return out.astype(np.uint8).ravel()


def scan(steps: np.ndarray, width: int = 256) -> np.ndarray:
    """States after each step, from CLOSED: an inclusive scan by composition, blocks side by side."""
    n, table = len(steps), composed()
    identity = function(0, 1, 2, 3)
    rows = -(-n // width)
    padded = np.full(rows * width, identity, np.uint8)
    padded[:n] = steps
    block = np.ascontiguousarray(padded.reshape(rows, width).T)
    for j in range(1, width):
        block[j] = table[block[j - 1].astype(np.uint16) << 8 | block[j]]
    state, starts = CLOSED, np.empty(rows, np.uint8)
    for i, whole in enumerate(block[-1].tolist()):
        starts[i] = state
        state = whole >> 2 * state & 3
    return ((block >> (2 * starts)) & 3).T.ravel()[:n]


def boundaries(points: np.ndarray) -> np.ndarray:
    """True where a token starts. ``points``: code points of texts, each followed by the sentinel."""
    kind = classes()[points]
    n = len(points)
    after = np.concatenate([points[1:], [SENTINEL, SENTINEL]])
    one, two = after[:n], after[1 : n + 1]
    where = np.flatnonzero(points == 0x27)
    a, b = one[where], two[where]
    single = (a == ord("s")) | (a == ord("t")) | (a == ord("m")) | (a == ord("d"))
    double = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
    steps = kind.copy()
    steps[where[single | double]] = APOSTROPHE
    tails = np.concatenate([where[single] + 1, where[double] + 1, where[double] + 2])
    steps[tails] = TAIL
    state = scan(TRANSITIONS[steps])
    was = np.empty_like(state)
    was[0], was[1:] = CLOSED, state[:-1]
    before = np.empty_like(kind)
    before[0], before[1:] = END, kind[:-1]
    space, space_before = (kind == SPACE) | (kind == BLANK), (before == SPACE) | (before == BLANK)
    follows = np.empty_like(kind)
    follows[-1], follows[:-1] = END, kind[1:]
    last = space & (follows != SPACE) & (follows != BLANK) & (follows != END)
    # A token starts where the class changes; a blank before a word, number or run belongs to it; the
    # last white space before anything stands apart from the white space before it.
    start = np.where(space, ~space_before | last, (kind != before) & (before != BLANK))
    # Inside a contraction nothing starts; after one, and at one, something does.
    short, short_before = state == SHORT, was == SHORT
    begins = short & (steps == APOSTROPHE)
    start |= begins | (short_before & ~short)
    start &= ~(short & ~begins)
    start |= before == END
    start |= kind == END
    return start


class Merger:
    """Token ids of a slice of bytes: the pair of lowest rank merges first, the leftmost of equals."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.known = ranks, {}
        self.single_array = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        self.codes, self.merged = self.pairs()

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted codes of all pairs of tokens that merge (left id * 2**20 + right id), and the ids they merge to."""
        codes, merged = [], []
        for token, i in self.ranks.items():
            for k in range(1, len(token)):
                if (a := self.ranks.get(token[:k])) is not None and (b := self.ranks.get(token[k:])) is not None:
                    codes.append(a << 20 | b)
                    merged.append(i)
        codes, merged = np.array(codes, np.int64), np.array(merged, np.int32)
        order = np.argsort(codes)
        return codes[order], merged[order]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.merged[at], NONE)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Merge many short slices side by side, one merge of each slice a round. Returns packed ids."""
        n, sizes = len(words), np.array([len(w) for w in words])
        most = int(sizes.max())
        parts = np.full((n, most + 1), PAD, np.int32)
        flat = self.single_array[np.frombuffer(b"".join(words), np.uint8)]
        inside = np.arange(most + 1)[None, :] < sizes[:, None]
        parts[inside] = flat
        ranks = np.full((n, most + 1), NONE, np.int32)
        ranks[:, :-1] = self.rank(parts[:, :-1], parts[:, 1:])
        out: list[bytes] = [b""] * n
        row, columns = np.arange(n), np.arange(most + 1)
        while len(row):
            i = ranks.argmin(1)
            every = np.arange(len(row))
            least = ranks[every, i]
            if (done := least == NONE).any():
                packed, wide = parts[done].astype("<u4").tobytes(), 4 * (most + 1)
                for k, (r, size) in enumerate(zip(row[done].tolist(), sizes[done].tolist(), strict=True)):
                    out[r] = packed[k * wide : k * wide + 4 * size]
                go = ~done
                row, parts, ranks, sizes, i, least = row[go], parts[go], ranks[go], sizes[go], i[go], least[go]
                every = every[: len(row)]
                if not len(row):
                    break
            source = np.minimum(columns + (columns > i[:, None]), most)
            parts, ranks = np.take_along_axis(parts, source, 1), np.take_along_axis(ranks, source, 1)
            parts[every, i] = least
            sizes = sizes - 1
            parts[every, sizes] = PAD
            ranks[every, sizes - 1] = NONE
            ranks[every, i] = self.rank(parts[every, i], parts[every, np.minimum(i + 1, most)])
            inner = np.flatnonzero(i > 0)
            ranks[inner, i[inner] - 1] = self.rank(parts[inner, i[inner] - 1], parts[inner, i[inner]])
        return out

    def merge_long(self, word: bytes) -> bytes:
        """The same with a heap and a linked list: n log n for long slices."""
        ranks, n = self.ranks, len(word)
        end, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
        heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heappop(heap)
            if not alive[i] or (j := right[i]) >= n or end[j] != stop:
                continue
            end[i], alive[j], right[i] = stop, False, right[j]
            if right[i] < n:
                left[right[i]] = i
                k = right[i]
                if (r := ranks.get(word[i : end[k]])) is not None:
                    heappush(heap, (r, i, end[k]))
            if (k := left[i]) >= 0 and (r := ranks.get(word[k:stop])) is not None:
                heappush(heap, (r, k, stop))
        return np.array([ranks[word[i : end[i]]] for i in range(n) if alive[i]], "<u4").tobytes()

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each slice. The cache is bounded and only saves time."""
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        out = list(map(known.get, words))
        if None in out:
            missing = [i for i, ids in enumerate(out) if ids is None]
            new = list({words[i] for i in missing})
            short = sorted((w for w in new if len(w) <= SHORT_WORD), key=len)
            for a in range(0, len(short), MANY):
                known.update(zip(short[a : a + MANY], self.merge_many(short[a : a + MANY]), strict=True))
            long = {w: self.merge_long(w) for w in new if len(w) > SHORT_WORD}
            for i in missing:
                out[i] = known[w] if len(w := words[i]) <= SHORT_WORD else long[w]
        return out


@lru_cache(4)
def merger(path: str) -> Merger:
    with open(path, "rb") as f:
        return Merger({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


def split(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Slices of all texts in order, and how many each text has."""
    sizes = np.array([len(t) for t in texts])
    points = np.frombuffer(b"".join(t.decode().encode("utf-32-le") + SENTINEL.to_bytes(4, "little") for t in texts), np.uint32)
    start = boundaries(points)
    ends = points == SENTINEL
    width = np.where(ends, 0, 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000))
    offset = np.cumsum(width) - width
    at = np.flatnonzero(start)
    number = np.cumsum(ends) - ends  # of the text
    counts = np.bincount(number[at], minlength=len(texts)) - 1  # the sentinel is no token
    cut = offset[at]
    real = ~ends[at]
    whole = b"".join(texts)
    nexts = np.append(cut[1:], sizes.sum())
    return [whole[a:b] for a, b in zip(cut[real].tolist(), nexts[real].tolist(), strict=True)], counts


def encoded(texts: list[bytes], path: str) -> Iterator[bytes]:
    """The packed ids (little-endian unsigned 32-bit) of each text."""
    words, counts = split(texts)
    per_word = merger(path).encode(words)
    at = 0
    for n in counts.tolist():
        yield b"".join(per_word[at : at + n])
        at += n


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", outputs: tuple[str, ...] = ("ids", "offsets")) -> DataFrame:
    """Encode every whole text by the ranks in the file ``path`` (it must exist on all executors).

    Returns the id column and, as asked for in ``outputs``, binary columns: ``ids`` (little-endian unsigned 32-bit),
    ``offsets`` (alike: the end of each token in the text's UTF-8 bytes), ``decoded`` (the ids decoded).
    Map-only: no shuffle, and a task holds one batch.
    """
    key = fresh("key", outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = merger(path).tokens
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
                made: dict[str, list[bytes]] = {x: [] for x in outputs}
                for ids in encoded(texts, path):
                    if "ids" in made:
                        made["ids"].append(ids)
                    if "offsets" in made or "decoded" in made:
                        pieces = [tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]
                        if "offsets" in made:
                            made["offsets"].append(np.cumsum([len(t) for t in pieces], dtype="<u4").tobytes())
                        if "decoded" in made:
                            made["decoded"].append(b"".join(pieces))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(made[x], pa.binary()) for x in outputs)], [key, *outputs])

    small_batches(docs.sparkSession)
    source = docs.select(quoted(id_column).alias(key), quoted(text_column).cast("string").alias("text"))
    kind = source.schema[key].dataType.simpleString()
    out = source.mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{x} binary" for x in outputs))
    return out.withColumnRenamed(key, id_column)


def decode(tokens: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """The bytes of each row's ids, as column ``decoded``. Null ids decode to null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merger(path).tokens
        for batch in batches:
            out = [None if x is None else b"".join([table[i] for i in np.frombuffer(x, "<u4").tolist()]) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["key", "decoded"])

    source = tokens.select(quoted(id_column).alias("key"), quoted(ids_column).alias("ids"))
    return source.mapInArrow(run, f"key {source.schema['key'].dataType.simpleString()}, decoded binary").withColumnRenamed("key", id_column)


def digest(data: Column) -> Column:
    return F.sha2(data, 256)
