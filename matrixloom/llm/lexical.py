"""Ranked lexical search for a whole set of items, sharing what they have in common.

An item's score of a document is a sum over the item's terms, so items that share terms share partial sums. ``mined`` finds term sets
that items share, always the largest intersection of two, replaces each by a node in all items (and in all earlier sets) that hold it,
and so builds a graph of sums: terms at the bottom, shared sets above, items on top. Over blocks of documents every node's sums are made
once, level by level, and are then added into each set and item that uses them.

Items are dealt into blocks of about ``items``; for each block one pass over the texts keeps what the documents have of the block's
terms (term number and count, written as a table), from which document frequencies, scores and each task's best rows are made. What travels
to tasks is one block's graph and weights, whatever the number of items or documents; tasks keep ``top`` rows an item.

Terms are runs of ASCII letters and digits and of characters beyond ASCII, with A-Z lower-cased. All arithmetic but a term's weight is in
64-bit whole numbers.

Defined results: null texts and texts without terms are no documents; rows without doc_id come last among equal scores; each row is a
document of its own; the rows of one item_id are one item with the terms of all; rows without item_id ask nothing; extra columns
are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import quoted, small_batches, stored, text_slices

#: ASCII letters in lower case, digits, and all bytes beyond ASCII stay.
TERM_BYTES = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())
#: Bytes of a block of sums.
HELD = 32 << 20


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TERM_BYTES).split()


class Graph:
    """Sums by level. ``steps``: (nodes, children, starts) in an order in which children come first; ``tops`` likewise for items."""

    def __init__(self, terms: int, sets: dict[int, list[int]], items: list[list[int]]):
        self.nodes = terms + len(sets)
        level = np.zeros(self.nodes, int)

        def depth(node: int) -> int:
            todo = [node]
            while todo:
                x = todo[-1]
                if x < terms or level[x]:
                    todo.pop()
                elif deeper := [c for c in sets[x] if c >= terms and not level[c]]:
                    todo += deeper
                else:
                    level[x] = 1 + max(level[c] for c in sets[x])
            return int(level[node])

        by_level: dict[int, list[int]] = {}
        for node in sets:
            by_level.setdefault(depth(node), []).append(node)
        self.steps = [(np.array(n), *self.flat([sets[x] for x in n])) for _, n in sorted(by_level.items())]
        self.tops = self.flat(items)
        #: Additions a document takes with sets, and those it would take without.
        self.additions = sum(len(s) - 1 for s in sets.values()) + sum(len(i) - 1 for i in items)

    @staticmethod
    def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([np.array(x, np.int64) for x in lists]), np.cumsum([0, *(len(x) for x in lists)])[:-1]

    def sums(self, base: np.ndarray) -> np.ndarray:
        """Items x documents, from ``base`` (nodes x documents), whose rows of terms are filled."""
        for nodes, children, starts in self.steps:
            base[nodes] = np.add.reduceat(base[children], starts, axis=0)
        return np.add.reduceat(base[self.tops[0]], self.tops[1], axis=0)


def mined(terms: int, items: list[list[int]]) -> Graph:
    """The graph of items given as lists of distinct term numbers, none empty."""
    rows, columns = len(items), terms
    has = np.zeros((2 * rows + 16, terms + rows + 16), bool)
    for i, x in enumerate(items):
        has[i, x] = True
    common = np.zeros((len(has), len(has)), np.int32)
    whole = has[:rows].astype(np.float32)
    common[:rows, :rows] = np.rint(whole @ whole.T)
    np.fill_diagonal(common, 0)
    best = common.max(1)
    made: dict[int, int] = {}  # node of a set -> its row
    while rows > 1:
        i = int(best[:rows].argmax())
        if best[i] < 2:
            break
        j = int(common[i, :rows].argmax())
        shared = np.flatnonzero(has[i] & has[j])
        if rows + 1 > len(has) or columns + 1 > has.shape[1]:
            has = np.pad(has, ((0, rows), (0, rows)))
            common = np.pad(common, ((0, len(has) - len(common)), (0, len(has) - len(common))))
            best = np.pad(best, (0, len(has) - len(best)))
        overlap = has[:rows, shared].sum(1).astype(np.int32)
        inside = np.flatnonzero(overlap == len(shared))
        # Rows that hold all of it have the new node instead; two of these now have the node in common.
        common[np.ix_(inside, np.arange(rows))] -= overlap
        outside = np.setdiff1d(np.arange(rows), inside)
        common[np.ix_(outside, inside)] = common[np.ix_(inside, outside)].T
        common[np.ix_(inside, inside)] += 1
        common[inside, inside] = 0
        has[np.ix_(inside, shared)] = False
        has[inside, columns] = True
        has[rows, shared] = True
        overlap[inside] = 0
        common[rows, :rows] = common[:rows, rows] = overlap
        made[columns] = rows
        rows, columns = rows + 1, columns + 1
        changed = np.append(inside, rows - 1)
        best[changed] = common[changed, :rows].max(1)
        stale = np.flatnonzero(best[:rows] > 0)
        best[stale] = common[stale, :rows].max(1)
    return Graph(terms, {node: np.flatnonzero(has[row]).tolist() for node, row in made.items()}, [np.flatnonzero(has[i]).tolist() for i in range(len(items))])


def asked(items: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(item_id, term): the distinct terms of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                for item, text in zip(part.column(0), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    found = sorted(set(terms(text)))
                    yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(found), pa.int64()), pa.array(found, pa.binary()).cast(pa.string())], ["item_id", "term"])

    small_batches(items.sparkSession)
    source = items.filter(quoted(id_column).isNotNull()).select(quoted(id_column).cast("long").alias("item_id"), quoted(text_column).cast("string").alias("text"))
    return source.mapInArrow(run, "item_id long, term string").distinct()


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_column: str, text_column: str) -> DataFrame:
    """doc_id, n (terms with repeats), and of the vocabulary the term numbers with their counts. Map-only."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        for batch in batches:
            for part in text_slices(batch, "text"):
                n, ends, which, counts = [], [0], [], []
                for text in part.column(1).cast(pa.binary()).to_pylist():
                    found = terms(text)
                    have = Counter(map(number, found))
                    have.pop(None, None)
                    n.append(len(found))
                    which += have.keys()
                    counts += have.values()
                    ends.append(len(which))
                offsets = pa.array(ends, pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (which, counts)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "term", "tf"])

    small_batches(docs.sparkSession)
    source = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, n long, term array<int>, tf array<int>").filter("n > 0")


class Best:
    """The best rows of each item so far, as (item, no doc_id, doc_id, score)."""

    def __init__(self, items: int, top: int, most: int = 1 << 18):
        self.top, self.most = top, most
        self.bar = np.ones(items, np.int64)  # rows below it cannot be among the best
        self.rows = [np.zeros((4, 0), np.int64)]
        self.held = 0

    def add(self, scores: np.ndarray, nameless: np.ndarray, docs: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.bar[:, None])
        self.rows.append(np.array([item, nameless[doc], docs[doc], scores[item, doc]]))
        self.held += len(item)
        if self.held > self.most:
            self.cut()

    def cut(self) -> np.ndarray:
        item, nameless, doc, score = rows = np.concatenate(self.rows, axis=1)
        rows = rows[:, np.lexsort((doc, nameless, -score, item))]
        start = np.searchsorted(rows[0], np.arange(len(self.bar)))
        place = np.arange(rows.shape[1]) - start[rows[0]]
        last = rows[:, place == self.top - 1]
        self.bar[last[0]] = last[3]
        rows = rows[:, place < self.top]
        self.rows, self.held = [rows], rows.shape[1]
        self.most = max(self.most, 2 * self.held)
        return rows


def scored(indexed: DataFrame, graph: Graph, item_ids: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item_id, doc_id, score): the best ``top`` rows of each task for each item."""
    sent = indexed.sparkSession.sparkContext.broadcast((graph, item_ids, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, item_ids, weights = sent.value
        best = Best(len(item_ids), top)
        step = max(16, HELD // (8 * graph.nodes))
        base = np.zeros((graph.nodes, step), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                m = 50 + 50 * batch.column("n").to_numpy() * n_docs // n_terms
                which, tf = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("term", "tf"))
                doc = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("term").offsets.to_numpy()))
                base[:] = 0
                base[which, doc] = weights[which] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
                ids = batch.column("doc_id")
                best.add(graph.sums(base)[:, : batch.num_rows], ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy())
        item, nameless, doc, score = best.cut()
        yield pa.RecordBatch.from_arrays([pa.array(item_ids[item]), pa.array(doc, mask=nameless.astype(bool)), pa.array(score)], ["item_id", "doc_id", "score"])

    return indexed.mapInArrow(run, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = 50, block: int = 256, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the best ``top`` documents with a score above 0 for each item, ties to smaller doc_id."""
    pairs = stored(asked(items, item_id, item_text), "item-terms")
    blocks = max(1, math.ceil(pairs.select("item_id").distinct().count() / block))
    parts = []
    for b in range(blocks):
        own = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)  # about `block` items
        lists = sorted((r.item_id, sorted(r.terms)) for r in own.groupBy("item_id").agg(F.collect_list("term").alias("terms")).toLocalIterator())
        vocabulary = {t.encode(): i for i, t in enumerate(sorted({t for _, x in lists for t in x}))}
        indexed = stored(postings(docs, vocabulary, doc_id, doc_text), "postings")
        n_docs, n_terms = indexed.agg(F.count("*"), F.sum("n")).first()
        if not lists or not n_docs:
            continue
        held = np.zeros(len(vocabulary), np.int64)
        for r in indexed.select(F.explode("term").alias("term")).groupBy("term").count().toLocalIterator():
            held[r["term"]] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in held.tolist()], np.int64)
        graph = mined(len(vocabulary), [[vocabulary[t.encode()] for t in x] for _, x in lists])
        parts.append(scored(indexed, graph, np.array([i for i, _ in lists]), weights, n_docs, n_terms, top))
    found = reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    order = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


#: The query's DuckDB twin.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), n AS (SELECT r, doc_id, CAST(len(t) AS BIGINT) AS n FROM d WHERE len(t) > 0
), s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS l FROM n
), p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term
), f AS (SELECT term, count(*) AS df FROM p GROUP BY term
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL
), c AS (
  SELECT item_id, r, doc_id, CAST(sum(CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // l)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN f USING (term) JOIN n USING (r), s GROUP BY item_id, r, doc_id
), o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM c WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 50
"""
