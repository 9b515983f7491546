"""Packing of documents into sequences.

``matrices`` packs each task's documents by best-fit-decreasing with a segment tree over capacities and gives whole
sequences: id matrix rows, cumulative segment lengths and positions that restart with each piece.

``pack`` packs all pieces into as few sequences as it can: random parts of bounded size are packed by
best-fit-decreasing, dual feasible functions certify how many sequences a part needs at least, and parts with a gap exchange
documents - they give their least filled sequences to common pools - and are packed again. Of every part the open
sequences at the end go along, so that not each part leaves one unfilled. A pool's new packing counts only if it has no
more sequences than the old one. Rounds end when the pools' sequences are as few as the bound on all that is in the
pools, or a round has saved none. ``certificate`` gives the number of sequences of a packing and the bound on all its pieces.

Documents of more than ``length`` tokens, and only they, are cut into pieces of ``length`` tokens, the last shorter.

Defined results: a null text is empty; every document ends with the end id, so an empty one has one token; repeated rows are
packed as often as they occur; a null doc_id stays null; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bins import best_fit_decreasing, bound_of, lower_bound
from .common import fresh, gathered, quoted, small_batches, stored
from .wordpieces import encoder

#: Pieces of a part or pool: bounds what a task holds.
PART = 1 << 14


def cut_up(ids: bytes, length: int) -> list[bytes]:
    return [ids[a : a + 4 * length] for a in range(0, len(ids), 4 * length)]


def source(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).cast("string").alias("text"))


def pieces(docs: DataFrame, tokenizer: str, length: int = 2048, end: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids: binary, little-endian unsigned 32-bit) of every whole text. Map-only."""
    stop = end.to_bytes(4, "little")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for part in gathered(batches, "text"):
            texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
            cut = [cut_up(ids, length) for ids in encode(texts, stop)]
            counts = np.array([len(c) for c in cut])
            row = np.repeat(np.arange(len(texts)), counts)
            number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            flat = [x for c in cut for x in c]
            sizes = np.array([len(x) // 4 for x in flat], np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(number.astype(np.int32)), pa.array(number * length), pa.array(sizes), pa.array(flat, pa.binary())], ["doc_id", "piece", "start", "length", "ids"])

    return source(docs, id_column, text_column).mapInArrow(rows, "doc_id long, piece int, start long, length long, ids binary")


def matrices(docs: DataFrame, tokenizer: str, length: int = 2048, end: int = 0, pad: int = 0, held: int = 1 << 22, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Packed sequences, one a row: ids (binary, ``length`` little-endian unsigned 32-bit ids, padded), cu_seqlens (array of
    the segments' cumulative lengths from 0), positions (binary like ids, from 0 in each segment and in the padding),
    doc_ids, pieces (arrays, one entry a segment), n_tokens.

    A task packs about ``held`` tokens at a time; nothing is shuffled.
    """
    stop, ramp = end.to_bytes(4, "little"), np.arange(length, dtype="<u4").tobytes()
    filler = pad.to_bytes(4, "little")
    names = ["ids", "cu_seqlens", "positions", "doc_ids", "pieces", "n_tokens"]

    def packed(keys: list[int | None], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        segments = [(key, n, ids) for key, whole in zip(keys, texts, strict=True) for n, ids in enumerate(cut_up(whole, length))]
        if not segments:
            return
        bins, offsets, used = best_fit_decreasing(np.array([len(s[2]) // 4 for s in segments]), length)
        order = np.lexsort((offsets, bins))
        edges = np.searchsorted(bins[order], np.arange(used + 1)).tolist()
        order = order.tolist()
        for at in range(0, used, 512):
            ids, lengths, positions, owners, numbers, tokens = [], [], [], [], [], []
            for b in range(at, min(used, at + 512)):
                inside = [segments[i] for i in order[edges[b] : edges[b + 1]]]
                sizes = [len(s[2]) for s in inside]
                rest = 4 * length - sum(sizes)
                ids.append(b"".join([*(s[2] for s in inside), filler * (rest // 4)]))
                positions.append(b"".join([*(ramp[:n] for n in sizes), ramp[:rest]]))
                lengths.append([0, *np.cumsum(sizes).tolist()])
                owners.append([s[0] for s in inside])
                numbers.append([s[1] for s in inside])
                tokens.append(sum(sizes) // 4)
            lengths = [[x // 4 for x in r] for r in lengths]
            kinds = [pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((ids, lengths, positions, owners, numbers, tokens), kinds, strict=True)], names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        keys, texts, total = [], [], 0
        for part in gathered(batches, "text"):
            made = encode([t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()], stop)
            keys += part.column(0).to_pylist()
            texts += made
            total += sum(map(len, made)) // 4
            if total >= held:
                yield from packed(keys, texts)
                keys, texts, total = [], [], 0
        yield from packed(keys, texts)

    return source(docs, id_column, text_column).mapInArrow(rows, "ids binary, cu_seqlens array<int>, positions binary, doc_ids array<bigint>, pieces array<int>, n_tokens int")


def write_matrices(packed: DataFrame, path: str, rows: int = 1024) -> None:
    """Write packed sequences as Parquet files of at most ``rows`` sequences: each file is an id matrix with its segment table."""
    packed.write.option("maxRecordsPerFile", rows).mode("overwrite").parquet(path)


def sequence_numbers(n: int, where: int, bins: np.ndarray) -> np.ndarray:
    """Numbers of the sequences of round n's part ``where``: no two rounds or parts share one, and none is negative."""
    if n >= 1 << 15 or where >= 1 << 24 or (len(bins) and int(bins.max()) >= 1 << 24):
        raise ValueError(f"no sequence number has room for round {n}, part {where}")
    return (np.int64(n) << 48) + (np.int64(where) << 24) + bins


def pack(items: DataFrame, length: int = 2048, part: int = PART, share: float = 0.25, open_below: float = 0.9) -> DataFrame:
    """``items`` (with a column ``length``) with sequence_id and offset.

    ``share``: how much of its sequences, least filled first, a part with a gap gives to the pools; ``open_below``: sequences
    filled less than this go along from any part.
    """
    names = items.columns
    row, group, old, offset, last = (fresh(x, names) for x in ("row_of_items", "part_of_items", "old_bin", "old_offset", "give"))
    items = stored(items, "pieces")
    key = F.xxhash64(F.monotonically_increasing_id())
    now = items.select(F.struct(*(quoted(c) for c in names)).alias(row), quoted("length").cast("long").alias("size_"), key.alias(old), F.lit(0).cast("long").alias(offset))
    row_type = now.schema[row].dataType.simpleString()
    schema = f"`{row}` {row_type}, size_ long, `{old}` long, `{offset}` long, `{last}` boolean"

    def repack(n: int) -> Callable[[pa.Table], pa.Table]:
        def packed_part(table: pa.Table) -> pa.Table:
            sizes = table.column("size_").to_numpy()
            before = table.column(old).to_numpy()
            # The order of rows in a group is not fixed: equal sizes go by their former place.
            stable = np.lexsort((table.column(offset).to_numpy(), before, -sizes))
            table, sizes, before = table.take(pa.array(stable)), sizes[stable], before[stable]
            where = table.column(group)[0].as_py()
            bins, offsets, used = best_fit_decreasing(sizes, length)
            if n and used > len(np.unique(before)):
                bins, offsets = np.unique(before, return_inverse=True)[1], table.column(offset).to_numpy()
                used = int(bins.max()) + 1
            fill = np.bincount(bins, sizes, used)
            give = fill < open_below * length
            if used > lower_bound(sizes, length):
                worst = np.argsort(fill, kind="stable")[: math.ceil(share * used)]
                give[worst[fill[worst] < length]] = True
            number = sequence_numbers(n, where, bins)
            return pa.table({row: table.column(row), "size_": sizes, old: number, offset: offsets, last: give[bins]})

        return packed_part

    finished: DataFrame | None = None
    before: int | None = None
    n = 0
    while True:
        counts = by_length(now, "size_", length)
        parts = max(1, math.ceil(int(counts.sum()) / part))
        dealt = now.withColumn(group, F.pmod(F.xxhash64(old), F.lit(parts)))
        out = stored(dealt.groupBy(group).applyInArrow(repack(n), schema), "packed")
        used = out.filter(F.col(offset) == 0).count()  # a sequence's first piece
        final = used == bound_of(counts, length) or (n > 0 and (used == before or parts == 1))
        more = out.limit(0) if final else out.filter(F.col(last))
        kept = out if final else out.filter(~F.col(last))
        finished = kept if finished is None else finished.unionByName(kept)
        before = more.filter(F.col(offset) == 0).count()
        if not before:
            break
        now = more.drop(last)
        n += 1
    return finished.select(f"`{row}`.*", F.col(old).alias("sequence_id"), F.col(offset).alias("offset"))


def by_length(items: DataFrame, column: str, length: int) -> np.ndarray:
    """How many items there are of each length from 0 to ``length``."""
    counts = np.zeros(length + 1, np.int64)
    for r in items.groupBy(F.col(column).alias("size")).count().collect():  # ``length`` rows at most
        counts[r["size"]] = r["count"]
    return counts


def certificate(packed: DataFrame, length: int = 2048) -> tuple[int, int]:
    """The number of sequences of a packing, and how many any packing of its pieces has at least."""
    return packed.select("sequence_id").distinct().count(), bound_of(by_length(packed, "length", length), length)
