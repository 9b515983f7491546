"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..tables import shared_dir, stored  # noqa: F401


def fresh(base: str, taken: Sequence[str]) -> str:
    """A column name that starts with ``base`` and is not in ``taken`` (case-insensitive)."""
    low = {c.lower() for c in taken}
    name = base
    while name.lower() in low:
        name += "_"
    return name


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def runs(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cut rows of the given sizes into ranges of at most ``limit`` in all, one row at least."""
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let no more than ``rows`` rows of whole texts be on their way between Spark and Python at once."""
    if not 0 < int(spark.conf.get(BATCH)) <= rows:
        spark.conf.set(BATCH, str(rows))


def row_slices(batch: pa.RecordBatch, name: str, limit: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Like ``text_slices`` for batches whose first column is a whole row; also gives the texts in its field ``name``."""
    if batch.num_rows == 0:
        return
    rows = batch.column(0)
    texts = rows.field(rows.type.get_field_index(name)).cast(pa.string()).cast(pa.binary())
    sizes = np.nan_to_num(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False).astype(float))
    for a, b in runs(sizes, limit):
        yield batch.slice(a, b - a), texts.slice(a, b - a).to_pylist()


def text_slices(batch: pa.RecordBatch, name: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a record batch that hold about ``limit`` bytes of text each (a longer text alone)."""
    if batch.num_rows == 0:
        return
    column = batch.column(batch.schema.get_field_index(name))
    sizes = np.nan_to_num(pa.compute.binary_length(column).to_numpy(zero_copy_only=False).astype(float))
    for a, b in runs(sizes, limit):
        yield batch.slice(a, b - a)


def gathered(batches: Iterator[pa.RecordBatch], name: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of record batches in batches of about ``limit`` bytes of text (a longer text alone)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in text_slices(batch, name, limit):
            n = pa.compute.sum(pa.compute.binary_length(part.column(name))).as_py() or 0
            if held and size + n > limit:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(part)
            size += n
    if held:
        yield pa.concat_batches(held)


def binaries(parts: list[bytes | None]) -> pa.Array:
    return pa.array(parts, type=pa.binary())
