"""Base matrices, consensus and information content behind sequence logos.

Letters are counted as arrays: ``letter_arrays`` makes one of each text, and ``letter_sums`` adds them up in tasks, so no letter is ever a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..tables import texts_in_small_batches
from .matrix import trimmed

#: In the order in which ties are decided.
BASES = ["A", "C", "G", "T"]


class Alphabet:
    """Bases of characters by their lower-case letter, and of all others; positions are places modulo ``period``."""

    def __init__(self, letters: dict[str, str], other: str, period: int):
        self.letters, self.other, self.period = letters, other, period
        self.bases = sorted({*letters.values(), other})

    def table(self) -> np.ndarray:
        """The number of each character's base. Characters beyond the first plane have no letter of it in lower case."""
        place = {b: i for i, b in enumerate(self.bases)}
        return np.array([place[self.letters.get(chr(c).lower(), self.other)] for c in range(1 << 16)] + [place[self.other]], np.int64)


def letter_arrays(df: DataFrame, text: str, alphabet: Alphabet, name: str = "letters") -> DataFrame:
    """``df`` without ``text`` and with its counts by position and base, as one array a row; a null text has none of any. Map-only."""
    texts_in_small_batches(df.sparkSession)
    kept = [c for c in df.columns if c != text]
    size = alphabet.period * len(alphabet.bases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = alphabet.table()
        for batch in batches:
            counts = np.zeros((batch.num_rows, size), np.int32)
            for i, t in enumerate(batch.column(text)):
                codes = np.frombuffer((t.as_py() or "").encode("utf-32-le"), np.uint32)
                bases = table[np.minimum(codes, 1 << 16)]
                counts[i] = np.bincount(np.arange(len(codes)) % alphabet.period * len(alphabet.bases) + bases, minlength=size)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * size)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.ListArray.from_arrays(offsets, pa.array(counts.ravel()))], [*kept, name])

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept) + (", " if kept else "") + f"`{name}` array<int>"
    return df.select(*kept, text).mapInArrow(run, schema)


def letter_sums(counted: DataFrame, keys: list[str], alphabet: Alphabet, weight: str | None = None, letters: str = "letters", most: int = 4096) -> DataFrame:
    """(keys, position, base, n) over all rows, each times its ``weight`` if there is one; what does not occur has no row.

    A task adds arrays up and holds those of ``most`` keys at once.
    """
    fields = counted.select(*keys).schema
    size = alphabet.period * len(alphabet.bases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            rows = batch.column(letters).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            if weight:
                rows = rows * np.nan_to_num(batch.column(weight).to_numpy(zero_copy_only=False).astype(float))[:, None]
            by_key: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*(batch.column(k).to_pylist() for k in keys), strict=True) if keys else [()] * batch.num_rows):
                by_key.setdefault(key, []).append(i)
            for key, at in by_key.items():
                total = rows[at].sum(0)
                held[key] = held[key] + total if key in held else total
            if len(held) > most:
                yield listed(held)
                held = {}
        if held:
            yield listed(held)

    def listed(held: dict[tuple, np.ndarray]) -> pa.RecordBatch:
        counts = np.array(list(held.values()))
        row, cell = np.nonzero(counts)
        names = list(held)
        columns = [pa.array([names[r][i] for r in row.tolist()], kinds[i]) for i in range(len(keys))]
        place = pa.array((cell // len(alphabet.bases)).astype(np.int32))
        base = pa.array(alphabet.bases).take(pa.array(cell % len(alphabet.bases)))
        return pa.RecordBatch.from_arrays([*columns, place, base, pa.array(counts[row, cell].astype(float if weight else np.int64))], [*keys, "position", "base", "n"])

    kinds = [f.type for f in to_arrow_schema(fields)] if keys else []
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields) + f"position int, base string, n {'double' if weight else 'long'}"
    sums = counted.select(*keys, letters, *([weight] if weight else [])).mapInArrow(run, schema)
    return sums.groupBy(*keys, "position", "base").agg(F.sum("n").alias("n"))


def frequency_matrix(counts: DataFrame, keys: list[str], alphabet: list[str] = BASES, pseudocount: float = 20) -> DataFrame:
    """(keys, base, n) of counts (keys, base, n): the mean of each base's indicator over all bases counted, plus the pseudocount."""
    total = F.sum("n").over(W.partitionBy(*keys))
    shares = counts.withColumn("share", F.col("n") / total).drop("n").dropna(subset=keys)
    return dense(shares, keys, alphabet).select(*keys, "base", (F.coalesce("share", F.lit(0.0)) + pseudocount).alias("n"))


def base_matrix(x: DataFrame, group: str, position: str, coverage: str, value: str, types: dict[str, str], pseudocount: float = 20) -> DataFrame:
    """(group, position, base, n): mean of each base's coverage type over the group's rows, plus the pseudocount.

    ``types`` maps coverage types to bases.
    """
    rows = x.filter(F.col(coverage).isin(*types)).filter(F.col(group).isNotNull())
    name = F.create_map(*(F.lit(y) for pair in types.items() for y in pair))
    return rows.groupBy(group, position, name[F.col(coverage)].alias("base")).agg((F.avg(value) + pseudocount).alias("n"))


def logo_entries(x: DataFrame, size: str = "full", drop_cca: bool = True, drop_pseudogenes: bool = False, features: list[str] | None = None) -> DataFrame:
    """Entries (feature, position, gap, location, ...) that a logo shows, always without position -1.

    ``size``: full, noloop (without the extension loop) or sprinzl (without gap positions). ``features``: only these.
    """
    if size not in ("full", "noloop", "sprinzl"):
        raise ValueError(f"no such size: {size}")
    out = trimmed(x, drop_cca)
    if size == "noloop":
        out = out.filter(F.coalesce(F.col("location") != "extensionloop", F.lit(True)))
    elif size == "sprinzl":
        out = out.filter(~F.col("gap"))
    if drop_pseudogenes:
        out = out.filter(F.split("feature", "-")[0] != "tRX")
    return out if features is None else out.filter(F.col("feature").isin(*features))


def dense(cells: DataFrame, keys: list[str], alphabet: list[str]) -> DataFrame:
    """A row for each base of each key, missing ones null."""
    every = cells.select(*keys).distinct().withColumn("base", F.explode(F.array(*map(F.lit, alphabet))))
    return every.join(cells, [*keys, "base"], "left")


def weighted_matrix(bases: DataFrame, weights: DataFrame, feature: str, keys: list[str], alphabet: list[str] = BASES, pseudocount: float = 20) -> DataFrame:
    """(keys, base, n): each feature adds its weight to its base at each position; bases outside the alphabet add nothing.

    A feature's equal bases of a key are counted before they meet their weight.
    """
    known = bases.filter(F.col("base").isin(*alphabet)).groupBy(feature, *keys, "base").agg(F.count("*").alias("times")).join(weights, feature)
    return with_pseudocount(known.groupBy(*keys, "base").agg(F.sum(F.col("weight") * F.col("times")).alias("n")), keys, alphabet, pseudocount)


def with_pseudocount(sums: DataFrame, keys: list[str], alphabet: list[str] = BASES, pseudocount: float = 20) -> DataFrame:
    """A row for each base of the alphabet and each of the keys that have one, with the pseudocount."""
    return dense(sums.filter(F.col("base").isin(*alphabet)), keys, alphabet).withColumn("n", F.coalesce("n", F.lit(0.0)) + pseudocount)


def information(matrix: DataFrame, keys: list[str], extra_pseudocount: float = 0, letters: int = 4) -> DataFrame:
    """(keys, base, p, bits, height): share of each base, the position's information and the base's part of it."""
    w = W.partitionBy(*keys)
    c = F.col("n") + extra_pseudocount
    p = F.try_divide(c, F.sum(c).over(w))
    out = matrix.withColumn("p", p)
    term = F.when(F.col("p") > 0, F.col("p") * F.log2(F.col("p") * letters)).otherwise(0.0)
    out = out.withColumn("bits", F.sum(term).over(w))
    return out.withColumn("height", F.col("p") * F.col("bits"))


def reference_consensus(bases: DataFrame, keys: list[str], least: float = 0.35, number: str | None = None) -> DataFrame:
    """(keys, consensus, share): the most frequent base, the least of equals; blank below ``least``. ``number``: how often a row counts."""
    counts = bases.groupBy(*keys, "base").agg((F.sum(number) if number else F.count("*")).alias("n"))
    w = W.partitionBy(*keys)
    ranked = counts.withColumn("share", F.col("n") / F.sum("n").over(w)).withColumn("place", F.row_number().over(w.orderBy(F.desc("n"), "base")))
    top = ranked.filter("place = 1")
    return top.select(*keys, F.when(F.col("share") < least, "").otherwise(F.col("base")).alias("consensus"), "share")


def read_consensus(matrix: DataFrame, reference: DataFrame, keys: list[str], least: float = 0.35) -> DataFrame:
    """(keys, consensus, share) of a base matrix; blank below ``least``, else a gap where the reference has one."""
    w = W.partitionBy(*keys)
    share = F.try_divide(F.col("n"), F.sum("n").over(w))
    top = matrix.withColumn("share", share).withColumn("place", F.row_number().over(w.orderBy(F.desc("n"), "base"))).filter("place = 1")
    out = top.join(reference.select(*keys, F.col("consensus").alias("ref")), keys, "left")
    letter = F.when(F.col("share") < least, "").when(F.col("ref") == "-", "-").otherwise(F.col("base"))
    return out.select(*keys, letter.alias("consensus"), "share")


def identical(bases: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, is_identical): whether all features have the same base."""
    return bases.groupBy(*keys).agg((F.count_distinct("base") == 1).alias("is_identical"))


def scaled_to_largest(value: str, *keys: str) -> Column:
    """A value over the largest of its group."""
    return F.try_divide(F.col(value), F.max(value).over(W.partitionBy(*keys)))
