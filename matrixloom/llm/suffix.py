"""Removal of repeated byte windows by passes over wide digits, down to the threshold's depth.

Windows are parted by digits until all their ``length`` bytes are used up; groups that are still together then are
exactly the repeated windows. The digits are not read from each suffix's start, as a plain radix sort of suffixes would:

1. The first digit is a window's least ``GRAM``-byte string (by a fixed scramble). Equal windows have it at
   the same place, so windows next to each other share one occurrence of it, an *anchor*, and are sorted as one run.
2. A run in doubt is sorted again by a digit nearly as wide as the threshold: runs are cut into blocks of up to
   ``BLOCK`` windows at fixed distances from the anchor, and the digit is what all windows of such a block have in common.
3. A block in doubt is sorted by its windows' full ``length`` bytes.

On each level a digit that occurs once ends there: none of its windows repeats. Of equal digits whose windows' whole stretch
of text is equal too, all but the first repeat it, window by window. The first of each stretch is in doubt only if its digit
also lies in another stretch.

Digits are compared by 64-bit hashes (the last by 128 bits). All groups are counted and cut by aggregation and equi-joins; none is
gathered, so a passage in a third of all documents is no special case.

Defined results: a null text is empty; rows without doc_id are neither compared nor cut; repeated rows (same doc_id, same
text) are one document and are cut alike; different texts of one doc_id are documents of their own, in the order of their hashes; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, quoted, row_slices, small_batches, stored, text_slices

GRAM = 28
#: Windows of a block on the second level.
BLOCK = 16
#: Window starts handled at once; positions fit in the packed order's 24 low bits.
CHUNK = 1 << 19
MASK = np.uint64((1 << 24) - 1)
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@lru_cache(2)
def tables(base: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte, the powers of ``base`` and of its inverse modulo 2**64."""
    rng = np.random.Generator(np.random.PCG64(base))
    power = np.full(size, base, np.uint64)
    inverse = np.full(size, pow(base, -1, 1 << 64), np.uint64)
    power[0] = inverse[0] = 1
    return rng.integers(0, 1 << 64, 256, np.uint64), np.multiply.accumulate(power), np.multiply.accumulate(inverse)


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


class Hashes:
    """Hashes of any stretches of a buffer from prefix sums."""

    def __init__(self, data: np.ndarray, base: int):
        size = CHUNK * 2
        while size <= len(data) + 1:
            size *= 2
        number, power, self.inverse = tables(base, size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(number[data] * power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return scramble((self.sums[end] - self.sums[start]) * self.inverse[start])

    def all(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return scramble((self.sums[width:] - self.sums[:n]) * self.inverse[:n])


def anchors(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each run of windows with one anchor: text number, digit, stretch and run."""
    whole = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)
    wide = length - GRAM + 1
    for a in range(0, len(whole) - length + 1, CHUNK):
        data = whole[a : a + CHUNK + length - 1]
        h = Hashes(data, BASES[0])
        grams = h.all(GRAM)
        least = grams & ~MASK | np.arange(len(grams), dtype=np.uint64)
        size = 1
        while 2 * size <= wide:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if rest := wide - size:
            least = np.minimum(least[:-rest], least[rest:])
        start = np.arange(len(least))
        start = start[start + a + length <= ends[owner[a : a + len(least)]]]
        if not len(start):
            continue
        place = (least[start] & MASK).astype(np.int64)
        heads = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)]))
        count = np.diff(np.append(heads, len(start)))
        first, place = start[heads], place[heads]
        text = owner[first + a]
        gram, runs = grams[place], packed(first + a - (ends - sizes)[text], place - first, count)
        yield text, gram, stretch_of(h, first, place, count, length), runs


def stretch_of(h: Hashes, first: np.ndarray, place: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    """Hash of the text that a run's windows cover, and of where the anchor lies in it."""
    return scramble(h.of(first, first + count - 1 + length) ^ ((place - first) * 256 + count).astype(np.uint64))


def packed(first: np.ndarray, anchor: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Start of the first window, the anchor's distance from it (below 128) and the number of windows (at most 128) in one long."""
    return first << 14 | anchor << 7 | count - 1


def unpacked(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return runs >> 14, runs >> 7 & 127, (runs & 127) + 1


def spread(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the run, and place in the run, of each of ``count`` parts."""
    return np.repeat(np.arange(len(count)), count), np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


COLUMNS = ["gram", "stretch", "doc_id", "run"]


def anchor_rows(docs: DataFrame, length: int, whole: bool) -> DataFrame:
    """(gram) or, if ``whole``, (gram, stretch, doc_id, run) of every anchor. ``docs``: doc_id, text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", CHUNK):
                ids = part.column(0).to_numpy(zero_copy_only=False)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                for text, gram, stretch, runs in anchors(texts, length):
                    columns = [gram.view(np.int64), stretch.view(np.int64), ids[text], runs] if whole else [gram.view(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], COLUMNS[: len(columns)])

    return docs.mapInArrow(rows, "gram long, stretch long, doc_id long, run long" if whole else "gram long")


def blocks(data: np.ndarray, runs: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Second level: digit, stretch and run of each block of the runs of one text."""
    first, anchor, count = unpacked(runs)
    low = (anchor - count + 1) // BLOCK
    run, number = spread(anchor // BLOCK - low + 1)
    block = low[run] + number
    # The windows of a block lie between these distances left of the anchor.
    far = np.minimum(block * BLOCK + BLOCK - 1, anchor[run])
    near = np.maximum(block * BLOCK, (anchor - count + 1)[run])
    place = (first + anchor)[run]
    h = Hashes(data, BASES[0])
    core = h.of(place - block * BLOCK, place - np.minimum(block * BLOCK + BLOCK - 1, length - GRAM) + length)
    start, n = place - far, far - near + 1
    return scramble(core ^ (block + 1).astype(np.uint64)), stretch_of(h, start, place, n, length), packed(start, far, n)


def windows(data: np.ndarray, runs: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Third level: two hashes and a run of one for each window of the runs of one text."""
    first, anchor, count = unpacked(runs)
    run, number = spread(count)
    start = first[run] + number
    high, low = (Hashes(data, b).of(start, start + length) for b in BASES)
    return high, low, packed(start, anchor[run] - number, np.ones(len(start), np.int64))


def sorted_again(docs: DataFrame, doubt: DataFrame, level: Callable[..., tuple[np.ndarray, ...]], length: int) -> DataFrame:
    """(gram, stretch, doc_id, run) of the next level for the runs in ``doubt`` (doc_id, run)."""
    lists = stored(doubt.groupBy("doc_id").agg(F.collect_list("run").alias("runs")), "doubt")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", CHUNK):
                for key, text, listed in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), part.column(2), strict=True):
                    runs = np.sort(listed.values.to_numpy(zero_copy_only=False))
                    runs = runs[(runs >> 14) + (runs & 127) + length <= len(text)]
                    for a in range(0, len(runs), 1 << 12):
                        some = runs[a : a + (1 << 12)]
                        low = int(some[0] >> 14)
                        high = int(((some >> 14) + (some & 127)).max()) + length
                        gram, stretch, out = level(np.frombuffer(text, np.uint8)[low:high], some - (low << 14), length)
                        yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(stretch.view(np.int64)), pa.array(np.full(len(out), key, np.int64)), pa.array(out + (low << 14))], COLUMNS)

    return stored(docs.join(lists, "doc_id").select("doc_id", "text", "runs").mapInArrow(rows, "gram long, stretch long, doc_id long, run long"), "level")


def divided(held: DataFrame, last: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """(doc_id, run) of the runs that repeat an earlier one, and of the runs in doubt. ``held``: in the shared folder."""
    firsts = held.groupBy("gram", "stretch").agg(F.min(F.struct("doc_id", "run")).alias("first"), F.count("*").alias("n"))
    firsts = stored(firsts.filter("n > 1").drop("n") if last else firsts, "stretches")
    repeated = firsts if last else firsts.filter("n > 1")
    later = held.join(repeated, ["gram", "stretch"]).filter(F.struct("doc_id", "run") > F.col("first")).select("doc_id", "run")
    if last:
        return later, None
    mixed = stored(firsts.groupBy("gram").count().filter("count > 1").select("gram"), "mixed")
    return later, firsts.join(mixed, "gram", "left_semi").select("first.doc_id", "first.run")


def repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 100) -> DataFrame:
    """(doc_id, of, runs: array of longs) of every document with windows that also start earlier, in the shared folder.

    ``of``: the hash of its text if its doc_id has other texts too, else null.
    """
    if not GRAM <= length <= GRAM + 127:
        raise ValueError(f"length must be from {GRAM} to {GRAM + 127}")
    small_batches(docs.sparkSession)
    texts = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).cast("string").alias("text")).filter("doc_id is not null and text is not null")
    clash = texts.select("doc_id", F.xxhash64("text").alias("of")).groupBy("doc_id").agg(F.min("of").alias("a"), F.max("of").alias("b")).filter("a <> b")
    names = None
    if clash.limit(1).count():
        # Documents get numbers instead, in the order of doc_id.
        hashed = texts.withColumn("of", F.xxhash64("text"))
        dealt = hashed.select("doc_id", "of").distinct().repartitionByRange("doc_id", "of").sortWithinPartitions("doc_id", "of")
        names = stored(dealt.withColumn("number", F.monotonically_increasing_id()), "numbers")
        texts = stored(hashed.join(names, ["doc_id", "of"]).select(F.col("number").alias("doc_id"), "text"), "texts")
    twice = stored(anchor_rows(texts, length, False).groupBy("gram").count().filter("count > 1").select("gram"), "grams")
    later, doubt = divided(stored(anchor_rows(texts, length, True).join(twice, "gram", "left_semi"), "anchors"))
    later2, doubt2 = divided(sorted_again(texts, doubt, blocks, length))
    later3, _ = divided(sorted_again(texts, doubt2, windows, length), last=True)
    every = later.unionByName(later2).unionByName(later3)
    found = every.groupBy("doc_id").agg(F.collect_set("run").alias("runs"))
    if names is None:
        return stored(found.select("doc_id", F.lit(None).cast("long").alias("of"), "runs"), "repeats")
    return stored(found.withColumnRenamed("doc_id", "number").join(names, "number").select("doc_id", "of", "runs"), "repeats")


def spans_of(runs: np.ndarray, length: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered stretches: starts and ends."""
    start, _, count = unpacked(runs)
    end = np.minimum(start + count - 1 + length, size)
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    heads = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    return start[heads], end[np.append(heads[1:] - 1, len(end) - 1)]


def cut(docs: DataFrame, repeated: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 100) -> DataFrame:
    """``docs`` with ``kept`` (binary, the bytes that stay), ``kept_text`` (the whole characters among them; null for a null text) and
    ``removed`` (array of start, end in bytes)."""
    names = docs.columns
    key, of, runs = (fresh(x, [*names, "kept", "kept_text", "removed"]) for x in ("key", "of", "runs"))
    marks = repeated.select(F.col("doc_id").alias(key), F.col("of").alias(of), F.col("runs").alias(runs))
    own = F.col(of).isNull() | (F.col(of) == F.xxhash64(quoted(text_column).cast("string")))
    joined = docs.join(marks, (quoted(id_column).cast("long") == F.col(key)) & own, "left")
    source = joined.select(F.struct(*(quoted(c) for c in names)).alias("row"), F.col(runs).alias("runs"))
    small_batches(docs.sparkSession)
    row_type = source.schema["row"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in row_slices(batch, text_column):
                stay, whole, gone = [], [], []
                for text, packed in zip(texts, part.column(1), strict=True):
                    null, text = text is None, text or b""
                    spans: list[list[int]] = []
                    if packed.is_valid and len(packed) and text:
                        a, b = spans_of(packed.values.to_numpy(zero_copy_only=False), length, len(text))
                        spans = [[x, y] for x, y in zip(a.tolist(), b.tolist(), strict=True) if x < y]
                    at, left = 0, []
                    for x, y in spans:
                        left.append(text[at:x])
                        at = y
                    stay.append(b"".join([*left, text[at:]]))
                    # Only a cut breaks characters: what is no part of one goes.
                    whole.append(None if null else stay[-1].decode("utf-8", "ignore") if spans else text.decode())
                    gone.append(spans)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(stay, pa.binary()), pa.array(whole, pa.string()), pa.array(gone, pa.list_(pa.list_(pa.int64())))], ["row", "kept", "kept_text", "removed"])

    out = source.mapInArrow(rows, f"row {row_type}, kept binary, kept_text string, removed array<array<long>>")
    return out.select("row.*", "kept", "kept_text", "removed")
