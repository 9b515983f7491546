"""SimHash near-duplicate groups by bit-sliced comparison.

A fingerprint has 64 bits. Fingerprints that differ in at most ``radius`` bits agree in all of at least
``blocks - radius`` of ``blocks`` parts, so each distinct fingerprint is filed under every choice of two parts of
``radius + 2``. Within a file, the 64 bit planes stand vertically, 64 fingerprints a machine word; one
fingerprint is compared with 64 at once by adding the planes' differences into carry-save bitwise counters, and a
word is abandoned as soon as all its lanes exceed the radius. Each file gives only the edges of a spanning forest,
which loses no link; the components of the edges are the groups.

Files above ``tile`` fingerprints are cut into tiles that meet pairwise in tasks of their own, so no task
holds more than about two tiles and none is skipped.

``similar_groups`` links documents by an exact similarity of shingle sets instead, for which fingerprints of more bits only
find candidates: two texts at similarity J differ in a share of acos(2 J / (1 + J)) / pi of the bits, so files are made of bits chosen
at random, as many to a file as keep its size, and as many files as keep the chance that a pair at the least similarity, with that share,
meets in none below ``miss``; within files the comparison is the same, with a radius of ``DEVIATIONS`` above that share.

A text meets more others the more texts there are, so the fingerprint must have bits enough that meetings of unrelated texts stay without
a candidate: where every text has one such candidate on average, most of the corpus is one group, all of whose pairs would be verified.
The files are made ``FILES`` at a time, so what is on disk at once does not grow with their number.

Defined results: a null or empty text has fingerprint 0 and links like any other; equal texts and repeated
rows share a fingerprint; a row without doc_id gets the group of its fingerprint, and null if no row of the group has a
doc_id; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from .common import quoted, small_batches, stored, text_slices

#: Of the bits in which texts at the least similarity differ, for the radius.
DEVIATIONS = 4.5
#: Files that are on disk at once.
FILES = 8

FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
ONE = np.uint64(1)


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in spans], np.uint64)
    counts = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[a : a + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int((2 * counts > len(hashes)) @ (ONE << np.arange(64, dtype=np.uint64)))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 4) -> DataFrame:
    """doc_id and the fingerprint (its 64 bits as a long) of every whole text. Map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                out = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out)], ["doc_id", "bits"])

    small_batches(docs.sparkSession)
    source = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, bits long")


def files(radius: int) -> list[int]:
    """Bit masks: every choice of two of radius + 2 parts."""
    parts = radius + 2
    edge = [round(64 * i / parts) for i in range(parts + 1)]
    part = [((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in range(parts)]
    return [a | b for a, b in combinations(part, 2)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


class Counters:
    """Vertical counters of 64 lanes a word, kept in carry-save form: up to two planes of each weight wait for a third."""

    def __init__(self, radius: int, words: int):
        self.radius, self.width = radius, radius.bit_length()
        self.waiting: list[list[np.ndarray]] = [[] for _ in range(self.width)]
        self.over = np.zeros(words, np.uint64)

    def add(self, plane: np.ndarray, weight: int = 0) -> None:
        while weight < self.width:
            waiting = self.waiting[weight]
            if len(waiting) < 2:
                waiting.append(plane)
                return
            b, a = waiting.pop(), waiting.pop()
            some = a ^ b
            waiting.append(some ^ plane)
            plane = a & b | some & plane
            weight += 1
        self.over |= plane  # at least twice the highest bit of the radius

    def above(self) -> np.ndarray:
        """Lanes whose count is above the radius."""
        for weight in range(self.width):
            while len(waiting := self.waiting[weight]) > 1:
                b, a = waiting.pop(), waiting.pop()
                waiting.append(a ^ b)
                self.add(a & b, weight + 1)
        more, equal = self.over.copy(), np.full(len(self.over), FULL)
        for weight in reversed(range(self.width)):
            plane = self.waiting[weight][0] if self.waiting[weight] else np.zeros_like(self.over)
            if self.radius >> weight & 1:
                equal &= plane
            else:
                more |= equal & plane
                equal &= ~plane
        return more

    def keep(self, chosen: np.ndarray) -> None:
        self.waiting = [[p[chosen] for p in w] for w in self.waiting]
        self.over = self.over[chosen]


def near(prints: np.ndarray, first: np.ndarray, size: np.ndarray, radius: int, chunk: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), j < i, of fingerprints of one run at a distance of at most ``radius``.

    ``prints``: a row of 64-bit words for each. Runs lie one after another: ``first`` and ``size`` of each fingerprint's run are
    given per fingerprint.
    """
    prints = prints.reshape(len(prints), -1)
    n, width = len(prints), 64 * prints.shape[1]
    place = np.arange(n) - first
    # A run's planes fill whole words, so no word holds two runs.
    heads = np.flatnonzero(place == 0)
    words = -(-size[heads] // 64)
    word_start = np.zeros(n, np.int64)
    word_start[heads] = np.cumsum(words) - words
    word_start = word_start[first]
    lane, word = place & 63, word_start + (place >> 6)
    planes = np.zeros((width, int(words.sum())), np.uint64)
    # Members of a word are consecutive: sum their lane bits plane by plane.
    cuts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    lanes = ONE << lane.astype(np.uint64)
    for b in range(width):
        planes[b] = np.bitwise_or.reduceat(np.where(prints[:, b >> 6] >> np.uint64(b & 63) & ONE, lanes, np.uint64(0)), cuts)
    # Each fingerprint meets the words of its run up to its own.
    many = (place >> 6) + 1
    step = max(1, chunk)
    at = 0
    total = np.cumsum(many)
    while at < n:
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + step, "right")))
        who = np.repeat(np.arange(at, to), many[at:to])
        offset = np.arange(len(who)) - np.repeat(total[at:to] - many[at:to] - (total[at - 1] if at else 0), many[at:to])
        which = word_start[who] + offset
        # Lanes of earlier members of the run only.
        limit = place[who] - 64 * offset
        open_ = np.where(limit >= 64, FULL, (ONE << np.minimum(limit, 63).astype(np.uint64)) - ONE)
        counters = Counters(radius, len(who))
        for b in range(width):
            counters.add(planes[b][which] ^ (np.uint64(0) - (prints[who, b >> 6] >> np.uint64(b & 63) & ONE)))
            if b % 8 == 7 and b > 2 * radius:
                open_ &= ~counters.above()
                keep = open_ != 0
                if not keep.any():
                    who = who[:0]
                    break
                if keep.mean() < 0.75:
                    who, which, offset, open_ = (x[keep] for x in (who, which, offset, open_))
                    counters.keep(keep)
        if len(who):
            hit = open_ & ~counters.above()
            some = np.flatnonzero(hit)
            row, bit = np.nonzero(np.unpackbits(hit[some].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            i = who[some[row]]
            yield i, first[i] + 64 * offset[some[row]] + bit
        at = to


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of a and b in ``labels`` (each points to a smaller or equal index)."""
    while True:
        la, lb = labels[a], labels[b]
        if (same := la == lb).all():
            return
        a, b, la, lb = a[~same], b[~same], la[~same], lb[~same]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while (down := labels[labels]).tolist() != labels.tolist() if len(labels) < 64 else not np.array_equal(down := labels[labels], labels):
            labels[:] = down


def forest(runs: np.ndarray, prints: np.ndarray, reps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (rep, rep) of a spanning forest of each run. ``runs``: True where a run starts."""
    heads = np.flatnonzero(runs)
    size = np.diff(np.append(heads, len(prints)))
    keep = np.repeat(size > 1, size)
    if not keep.any():
        return reps[:0], reps[:0]
    prints, reps, size = prints[keep], reps[keep], size[size > 1]
    first = np.repeat(np.cumsum(size) - size, size)
    labels = np.arange(len(prints))
    for i, j in near(prints, first, np.repeat(size, size), radius):
        merge(labels, i, j)
    child = np.flatnonzero(labels != np.arange(len(labels)))
    return reps[child], reps[labels[child]]


def links(prints: DataFrame, radius: int, tile: int) -> DataFrame:
    """Edges (u, v) that join all of ``prints`` (rep, bits: distinct) within ``radius`` bits."""
    masks = [signed(m) for m in files(radius)]
    filed = prints.select("rep", "bits", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col("bits").bitwiseAND(F.lit(m)).alias("v")) for k, m in enumerate(masks)))).alias("f")).select("rep", "bits", "f.k", "f.v")
    large = stored(filed.groupBy("k", "v").agg(F.count("*").alias("n")).filter(F.col("n") > tile), "large-files")
    tiles = F.coalesce(F.ceil(F.col("n") / tile), F.lit(1)).cast("int")
    cut = filed.join(large, ["k", "v"], "left").withColumn("tiles", tiles)
    cut = cut.withColumn("own", F.pmod(F.xxhash64("bits"), "tiles").cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    cut = cut.select("k", "v", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "bits", "rep")
    cut = cut.repartition("k", "v", "lo", "hi").sortWithinPartitions("k", "v", "lo", "hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
            if not len(columns[0]):
                continue
            starts = np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:4]])])
            last = int(np.flatnonzero(starts)[-1])
            held = [c[last:] for c in columns]
            yield edges(starts[:last], columns[4][:last], columns[5][:last])
        if held is not None:
            starts = np.zeros(len(held[0]), bool)
            starts[:1] = True
            yield edges(starts, held[4], held[5])

    def edges(starts: np.ndarray, bits: np.ndarray, reps: np.ndarray) -> pa.RecordBatch:
        u, v = forest(starts, bits.view(np.uint64), reps, radius)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return cut.mapInArrow(run, "u long, v long").distinct()


def groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 4, radius: int = 4, tile: int = 4096) -> DataFrame:
    """One row per document: doc_id, bits (the fingerprint) and component_id (the least doc_id reachable by links)."""
    if not 0 <= radius <= 12:
        raise ValueError("radius must be from 0 to 12: the files of a wider one hold too much, see similar_groups")
    prints = stored(fingerprints(docs, id_column, text_column, shingle), "prints")
    reps = stored(prints.groupBy("bits").agg(F.min("doc_id").alias("rep")), "reps")
    roots = components(links(reps.filter("rep is not null"), radius, tile))
    named = reps.join(roots, reps.rep == roots.node, "left").select("bits", F.coalesce("root", "rep").alias("component_id"))
    return prints.join(stored(named, "named"), "bits", "left").select("doc_id", "bits", "component_id")


def hexadecimal(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def one_of_each(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """``docs`` without those that are not the first of their group; columns stay. Rows without doc_id stay."""
    gone = grouped.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*(quoted(c) for c in docs.columns))


# --- Groups by exact similarity


def grams(text: bytes, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)] if words else [], np.uint64))


def wide_print(hashes: np.ndarray, words: int) -> np.ndarray:
    """A fingerprint of ``words`` 64-bit words of a set of hashes."""
    counts = np.zeros((words, 64), np.int64)
    for a in range(0, len(hashes), 4096):
        for k in range(words):
            # Independent bits for each word: the hash is mixed anew.
            h = (hashes[a : a + 4096] ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64))) * np.uint64(0xD6E8FEB86659FD93)
            h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
            counts[k] += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return (2 * counts > len(hashes)) @ (ONE << np.arange(64, dtype=np.uint64))


def lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) for p in parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)))


def shingled(docs: DataFrame, shingle: int, words: int, id_column: str, text_column: str) -> DataFrame:
    """doc_id, node (a hash of the set of shingles), its size and ``of``: the set's fingerprint, or the set itself if ``words`` is 0. Map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                sets = [grams(t or b"", shingle) for t in part.column(1).cast(pa.binary()).to_pylist()]
                keys = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in sets], np.uint64).view(np.int64)
                size = pa.array([len(x) for x in sets], pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys), size, lists([wide_print(x, words) for x in sets] if words else sets)], ["doc_id", "node", "size", "of"])

    small_batches(docs.sparkSession)
    source = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).cast("string").alias("text"))
    return source.filter("doc_id is not null").mapInArrow(run, "doc_id long, node long, size int, of array<long>")


def chosen_bits(count: int, words: int, flip: float, fill: int, miss: float) -> np.ndarray:
    """The bits of each file, for ``count`` fingerprints whose linked pairs differ in a share ``flip`` of their bits."""
    bits = min(62, max(6, math.ceil(math.log2(max(count, 1) / fill)) if count > fill else 6))
    files = math.ceil(math.log(miss) / math.log(1 - (1 - flip) ** bits))
    rng = np.random.default_rng(7)
    return np.stack([np.sort(rng.choice(64 * words, bits, replace=False)) for _ in range(files)])


def filed_by(nodes: DataFrame, bits: np.ndarray, words: int) -> DataFrame:
    """(file, node, p0, p1, ...): each fingerprint in every file. ``nodes``: node, of."""
    names = ["file", "node", *(f"p{k}" for k in range(words))]
    power = np.int64(1) << np.arange(bits.shape[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                prints = part.column(1).flatten().to_numpy().view(np.uint64).reshape(part.num_rows, words)
                flat = np.unpackbits(prints.astype("<u8").view(np.uint8), axis=1, bitorder="little")
                columns = [pa.array(prints[:, k].view(np.int64)) for k in range(words)]
                for k, chosen in enumerate(bits):
                    key = flat[:, chosen] @ power * len(bits) + k
                    yield pa.RecordBatch.from_arrays([pa.array(key), part.column(0), *columns], names)

    return nodes.select("node", "of").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def meetings(rows: DataFrame, tiles: Column, group: str) -> DataFrame:
    """``rows`` of each ``group`` cut into ``tiles``, with the ``meeting`` of two tiles, or of one with itself, that a row takes part in.

    A meeting is a hash: should two be equal, their rows are compared too, which adds nothing wrong.
    """
    cut = rows.withColumn("tiles_", tiles).withColumn("own_", F.pmod(F.xxhash64("node"), "tiles_").cast("int"))
    cut = cut.withColumn("other_", F.explode(F.sequence(F.lit(0), F.col("tiles_") - 1)))
    return cut.withColumn("meeting", F.xxhash64(group, F.least("own_", "other_"), F.greatest("own_", "other_"))).drop("tiles_", "own_", "other_")


def candidate_links(filed: DataFrame, words: int, radius: int, tile: int) -> DataFrame:
    """Edges (u, v) of a spanning forest of each file within ``radius`` bits; files above ``tile`` rows are cut, none is skipped."""
    large = stored(filed.groupBy("file").agg(F.count("*").alias("n")).filter(F.col("n") > tile), "large-files")
    cut = meetings(filed.join(large, "file", "left"), F.coalesce(F.ceil(F.col("n") / tile), F.lit(1)).cast("int"), "file")
    rows = cut.select("meeting", "node", *(f"p{k}" for k in range(words))).repartition("meeting").sortWithinPartitions("meeting")

    def edges(starts: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
        u, v = forest(starts, np.stack(columns[2:], 1).view(np.uint64), columns[1], radius)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
            if not len(columns[0]):
                continue
            starts = np.concatenate([[True], columns[0][1:] != columns[0][:-1]])
            last = int(np.flatnonzero(starts)[-1])
            held = [c[last:] for c in columns]
            yield edges(starts[:last], [c[:last] for c in columns])
        if held is not None:
            yield edges(np.arange(len(held[0])) == 0, held)

    return rows.mapInArrow(run, "u long, v long").distinct()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    same = len(np.intersect1d(a, b, assume_unique=True))
    return same / max(1, len(a) + len(b) - same)


def verified_links(rows: DataFrame, words: int, radius: int, least: float) -> DataFrame:
    """Links (u, v) that join what is similar within each meeting of ``rows`` (meeting, node, bits, of: the set)."""

    def meet(group: pa.Table) -> pa.Table:
        node = group.column("node").to_numpy()
        label = np.arange(len(node))
        prints = np.stack([x.values.to_numpy() for x in group.column("bits")]).view(np.uint64)
        sets = [x.values.to_numpy() for x in group.column("of")]
        size = np.array([len(x) for x in sets])
        u, v = [], []
        for some, other in near(prints, np.zeros(len(node), np.int64), np.full(len(node), len(node)), radius):
            close = np.minimum(size[some], size[other]) >= least * np.maximum(size[some], size[other]) - 1e-6
            some, other = some[close], other[close]
            while len(some):
                # Pairs of one group are joined already; of the others a batch is looked at before labels are read again.
                apart = label[some] != label[other]
                some, other = some[apart], other[apart]
                for i, j in zip(some[:256].tolist(), other[:256].tolist(), strict=True):
                    if label[i] != label[j] and similarity(sets[i], sets[j]) >= least:
                        u.append(node[i])
                        v.append(node[j])
                        label[label == label[j]] = label[i]
                some, other = some[256:], other[256:]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return rows.groupBy("meeting").applyInArrow(meet, "u long, v long")


def similar_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 5, least: float = 0.8, words: int = 3, fill: int = 256, miss: float = 1e-4, tile: int = 2048) -> DataFrame:
    """One row per document with an id: doc_id and component_id (the least doc_id reachable by links).

    Documents are linked if the Jaccard similarity of their sets of shingles (64-bit hashes of ``shingle`` words) is at least ``least``; every
    link that counts has been verified on the sets. Equal sets are one node; texts without words are equal; a text below ``shingle`` words is one
    shingle. The files give the groups of candidates; within each, all pairs within the radius that are not joined yet are verified, by
    tiles of about ``tile`` nodes or 512 of their shingles each.
    """
    flip = math.acos(2 * least / (1 + least)) / math.pi
    radius = math.ceil(64 * words * flip + DEVIATIONS * math.sqrt(64 * words * flip * (1 - flip)))
    sketches = stored(shingled(docs, shingle, words, id_column, text_column), "sketches")
    nodes = stored(sketches.groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("size").alias("size"), F.first("of").alias("of")), "nodes")
    # Sets of which no two that differ can be similar (at most size / (size + 1)) are not filed.
    able = nodes.filter(F.col("size") / (F.col("size") + 1) >= least - 1e-6)
    bits = chosen_bits(able.count(), words, flip, fill, miss)
    made = [stored(candidate_links(filed_by(able, bits[a : a + FILES], words), words, radius, tile), "candidates") for a in range(0, len(bits), FILES)]
    first = reduce(DataFrame.unionByName, made)

    # Groups of candidates: their sets are written, and read once for each meeting of tiles.
    ends = components(first)
    comp = stored(ends.select("node", F.col("root").alias("comp")).unionByName(ends.select(F.col("root").alias("node"), F.col("root").alias("comp")).distinct()), "groups")
    chosen = nodes.join(comp, "node").select("node", "comp", "rep", F.col("of").alias("bits"))
    found = docs.join(chosen.select(F.col("rep").alias("rep_")), quoted(id_column).cast("long") == F.col("rep_"), "left_semi")
    sets = shingled(found, shingle, 0, id_column, text_column).join(comp.select("node"), "node", "left_semi").dropDuplicates(["node"])
    sets = stored(chosen.drop("rep").join(sets.select("node", "of"), "node"), "sets")
    large = sets.groupBy("comp").agg(F.greatest(F.count("*") / tile, F.sum(F.size("of")) / (512 * tile)).alias("large"))
    links = verified_links(meetings(sets.join(large, "comp"), F.ceil("large").cast("int"), "comp"), words, radius, least)

    last = components(links)
    named = stored(nodes.join(last, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root")), "rooted")
    least_of = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = stored(named.join(least_of, "root").select("node", "component_id"), "named")
    return sketches.select("doc_id", "node").join(named, "node").select("doc_id", "component_id")
