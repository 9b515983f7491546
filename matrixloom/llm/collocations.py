"""Collocations: each language's best phrases of two and three words, by best-first growth with bounds.

A phrase's score is the least, over its cuts, of 1,000,000 a a / (l r) rounded down, where a, l and r count the phrase and the two parts. A
phrase of three words xyz occurs no more often than its parts, so its score is at most 1,000,000 f(xy) / f(x), which is known from the counts
of the prefix alone, and at most 1,000,000 f(yz) / f(z), from the suffix. Growth goes in waves: with a threshold a language, only the phrases
both of whose bounds reach it are counted, besides those that hold a pair that reaches it, since they decide whether that pair
survives. So all surviving scores from the threshold up are known exactly: a language with at least ``top`` of them is settled, ties included;
for the others the threshold falls, at last to 0, where everything has been grown.

Each pass counts whole-number codes of words in a task and sends its distinct phrases once. Which words are frequent, and which pairs may grow,
travels as an array of one byte for each of a fixed number of hash slots. Two that share a slot only lead to more being counted, never
to less: what was counted is joined with the exact tables.

Defined results: null texts are empty; a null lang is ``und``; a text's order of rows does not matter, repeated rows count again; extra columns
are not read. Scores are ranked by a, then by the phrase in byte order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import gathered, quoted, small_batches, stored

#: A-Z in lower case, tabs as spaces, and what ends a piece as a byte that UTF-8 has not got.
END = 255
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BYTES = bytes(END if c in PIECE_ENDS else 32 if c == 9 else c for c in bytes(range(256)).lower())
#: Bits of a word's code; words after which a task sends what it has and forgets them; distinct phrases that it holds.
BITS, WORDS, PHRASES = 21, 1 << 18, 1 << 19
FREQUENT, PREFIX, SUFFIX, CONTENDER = 1, 2, 4, 8


class Codes(dict):
    """Words by code, in order of appearance; the end of a piece is 0."""

    def __init__(self) -> None:
        super().__init__({bytes([END]): 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Language:
    """What a task holds of one language."""

    def __init__(self, lang: str, marks: np.ndarray | None):
        self.lang, self.seed, self.marks = lang, xxhash.xxh64_intdigest(lang.encode(), 42), marks
        self.codes = Codes()
        self.hashes = np.zeros(1, np.uint64)
        self.found: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def coded(self, texts: list[bytes]) -> np.ndarray:
        words = bytes([END]).join(texts).translate(BYTES).replace(bytes([END]), b" \xff ").split()
        return np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))

    def known(self) -> np.ndarray:
        """The hash of each word so far."""
        if (have := len(self.hashes)) < len(self.codes):
            digest, seed = xxhash.xxh64_intdigest, self.seed
            new = [digest(w, seed) for w in list(self.codes)[have:]]
            self.hashes = np.concatenate([self.hashes, np.array(new, np.uint64)])
        return self.hashes

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        if counts is None:
            keys, counts = np.unique(keys, return_counts=True)
        self.found.append((keys, counts))
        self.size += len(keys)
        if self.size > PHRASES and len(self.found) > 1:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys, inverse = np.unique(np.concatenate([k for k, _ in self.found] or [np.zeros(0, np.int64)]), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, inverse, np.concatenate([c for _, c in self.found] or [counts]))
        self.found, self.size = [(keys, counts)], len(keys)
        return keys, counts


def slot(hashes: np.ndarray, size: int) -> np.ndarray:
    return (hashes & np.uint64(size - 1)).astype(np.int64)


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left ^ (right << np.uint64(21) | right >> np.uint64(43))


def hash_column(lang: str, word: str) -> Column:
    """The same hash of a word as in tasks."""
    return F.xxhash64(lang, word)


def pair_column(lang: str, left: str, right: str) -> Column:
    r = hash_column(lang, right)
    return hash_column(lang, left).bitwiseXOR(F.shiftleft(r, 21).bitwiseOR(F.shiftrightunsigned(r, 43)))


def phrases_in(state: Language, texts: list[bytes], words: int) -> None:
    """Count the phrases of so many words whose parts are marked."""
    codes = state.coded(texts)
    if words == 1:
        state.add(codes[codes > 0])
        return
    hashes = state.known()
    marks = state.marks
    if words == 2:
        ok = (marks[slot(hashes, len(marks))] & FREQUENT > 0)[codes] & (codes > 0)
        at = np.flatnonzero(ok[:-1] & ok[1:])
        state.add(codes[at] << BITS | codes[at + 1])
        return
    at = np.flatnonzero((codes[:-2] > 0) & (codes[1:-1] > 0) & (codes[2:] > 0)) if len(codes) > 2 else np.zeros(0, np.int64)
    left, mid, right = (hashes[codes[at + i]] for i in range(3))
    p, s = marks[slot(pair_hash(left, mid), len(marks))], marks[slot(pair_hash(mid, right), len(marks))]
    grow = (p & s & FREQUENT > 0) & ((p & PREFIX > 0) & (s & SUFFIX > 0) | ((p | s) & CONTENDER > 0))
    at = at[grow]
    state.add((codes[at] << BITS | codes[at + 1]) << BITS | codes[at + 2])


def listed(state: Language, words: int) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, f) of what was counted, which is then forgotten."""
    keys, counts = state.merge()
    names = pa.array(list(state.codes), pa.binary())
    for a in range(0, len(keys), 1 << 16):
        part = keys[a : a + (1 << 16)]
        columns = [names.take(pa.array(part >> BITS * i & (1 << BITS) - 1)) for i in reversed(range(words))]
        joined = pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary())) if words > 1 else columns[0]
        yield pa.RecordBatch.from_arrays([pa.array([state.lang] * len(part)), joined.cast(pa.string()), pa.array(counts[a : a + (1 << 16)])], ["lang", "phrase", "f"])
    state.found, state.size = [], 0


def counted(docs: DataFrame, words: int, marks: np.ndarray | None = None, least: int = 1) -> DataFrame:
    """(lang, phrase, f) of phrases of so many words in docs (lang, text), as far as their parts are marked, that occur ``least`` times."""
    sent = docs.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Language] = {}
        for batch in gathered(batches, "text"):
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                if lang not in held:
                    held[lang] = Language(lang, sent.value)
                phrases_in(held[lang], texts, words)
            if sum(len(x.codes) for x in held.values()) > WORDS or sum(x.size for x in held.values()) > PHRASES:
                for state in held.values():
                    yield from listed(state, words)
                held = {}
        for state in held.values():
            yield from listed(state, words)

    small_batches(docs.sparkSession)
    found = docs.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return found.filter(F.col("f") >= least)


def marked(table: DataFrame, hashed: Column, flags: Column, most: int = 1 << 28) -> np.ndarray:
    """An array of flags by hash slot, made in Spark in parts of 64 kB; at most ``most`` bytes, 64 kB at least."""
    size = 1 << 16
    while size < min(most, 16 * table.count()):
        size <<= 1
    slots = table.select(hashed.bitwiseAND(F.lit(size - 1)).alias("slot"), flags.cast("int").alias("flags")).groupBy("slot").agg(F.bit_or("flags").alias("flags"))

    def fill(part: pa.Table) -> pa.Table:
        out = np.zeros(1 << 16, np.uint8)
        at = part.column("slot").to_numpy()
        out[at & 0xFFFF] = part.column("flags").to_numpy()
        return pa.table({"chunk": [int(at[0]) >> 16], "bytes": pa.array([out.tobytes()], pa.binary())})

    out = np.zeros(size, np.uint8)
    for r in slots.withColumn("chunk", F.shiftright("slot", 16)).groupBy("chunk").applyInArrow(fill, "chunk long, bytes binary").toLocalIterator():
        out[r["chunk"] << 16 : r["chunk"] + 1 << 16] = np.frombuffer(r["bytes"], np.uint8)
    return out


def score(a: str, left: str, right: str) -> Column:
    """1,000,000 a a / (left right), rounded down, in whole numbers of 38 digits."""
    return F.expr(f"(cast(1000000 as decimal(7, 0)) * cast({a} as decimal(15, 0)) * cast({a} as decimal(15, 0))) div (cast({left} as decimal(19, 0)) * cast({right} as decimal(19, 0)))")


def bound(a: str, other: str) -> Column:
    return F.expr(f"(cast(1000000 as decimal(7, 0)) * cast({a} as decimal(19, 0))) div cast({other} as decimal(19, 0))")


def word(i: int) -> Column:
    return F.split_part("phrase", F.lit(" "), F.lit(i))


def thresholds(pairs: DataFrame, aim: int) -> DataFrame:
    """(lang, bar): the score that ``aim`` pairs of the language reach, 0 if there are fewer. Works on counts by score."""
    by_score = pairs.groupBy("lang", "score").agg(F.count("*").alias("n"))
    so_far = by_score.withColumn("n", F.sum("n").over(W.partitionBy("lang").orderBy(F.desc("score"))))
    return so_far.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("n") >= aim, F.col("score"))), F.lit(0)).alias("bar"))


def grown(docs: DataFrame, pairs: DataFrame, least: int, inside: int) -> DataFrame:
    """Survivors (lang, phrase, a, l, r, score) with a score from ``bar`` up, of pairs with that column and the phrases grown from them."""
    flags = F.lit(FREQUENT) + PREFIX * (F.col("prefix") >= F.col("bar")).cast("int") + SUFFIX * (F.col("suffix") >= F.col("bar")).cast("int") + CONTENDER * (F.col("score") >= F.col("bar")).cast("int")
    marks = marked(pairs, pair_column("lang", "x", "y"), flags)
    found = counted(docs, 3, marks, least).select("lang", "phrase", F.col("f").alias("a"), word(1).alias("x"), word(2).alias("y"), word(3).alias("z"))
    first = pairs.select("lang", "x", "y", F.col("a").alias("fxy"), "fx")
    second = pairs.select("lang", F.col("x").alias("y"), F.col("y").alias("z"), F.col("a").alias("fyz"), F.col("fy").alias("fz"), "bar")
    triples = stored(found.join(first, ["lang", "x", "y"]).join(second, ["lang", "y", "z"]), "triples")
    holding = triples.select("lang", "x", "y", F.col("a").alias("b")).unionByName(triples.select("lang", F.col("y").alias("x"), F.col("z").alias("y"), F.col("a").alias("b")))
    longest = holding.groupBy("lang", "x", "y").agg(F.max("b").alias("b"))
    alive = pairs.filter("score >= bar").join(longest, ["lang", "x", "y"], "left").filter(F.coalesce(100 * F.col("b") < inside * F.col("a"), F.lit(True)))
    two = alive.select("lang", "phrase", "a", F.col("fx").alias("l"), F.col("fy").alias("r"), "score")
    cuts = triples.withColumn("one", score("a", "fx", "fyz")).withColumn("two", score("a", "fxy", "fz")).withColumn("score", F.least("one", "two")).filter("score >= bar")
    early = F.col("one") <= F.col("two")
    three = cuts.select("lang", "phrase", "a", F.when(early, F.col("fx")).otherwise(F.col("fxy")).alias("l"), F.when(early, F.col("fyz")).otherwise(F.col("fz")).alias("r"), "score")
    return stored(two.unionByName(three), "survivors")


def mined(docs: DataFrame, top: int = 2000, least: int = 10, inside: int = 50, wave: int = 4, lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` surviving phrases.

    A phrase occurs ``least`` times or more and is dropped if a longer one that holds it has ``inside`` percent of its occurrences. The first wave's
    threshold is the score that ``wave`` x ``top`` pairs reach; each further wave aims at eight times as many.
    """
    texts = docs.select(F.coalesce(quoted(lang_column).cast("string"), F.lit("und")).alias("lang"), F.coalesce(quoted(text_column).cast("string"), F.lit("")).alias("text"))
    words = stored(counted(texts, 1), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.filter(F.col("f") >= least)
    two = counted(texts, 2, marked(frequent, hash_column("lang", "phrase"), F.lit(FREQUENT)), least)
    two = two.select("lang", "phrase", F.col("f").alias("a"), word(1).alias("x"), word(2).alias("y"))
    pairs = two.join(frequent.select("lang", F.col("phrase").alias("x"), F.col("f").alias("fx")), ["lang", "x"]).join(frequent.select("lang", F.col("phrase").alias("y"), F.col("f").alias("fy")), ["lang", "y"])
    pairs = stored(pairs.withColumn("score", score("a", "fx", "fy")).withColumn("prefix", bound("a", "fx")).withColumn("suffix", bound("a", "fy")), "pairs")
    open_ = stored(pairs.select("lang").distinct(), "open")
    settled = None
    aim = wave * top
    while open_.count():
        held = stored(pairs.join(thresholds(pairs.join(open_, "lang", "left_semi"), aim), "lang"), "wave")
        found = grown(texts.join(open_, "lang", "left_semi"), held, least, inside)
        enough = found.groupBy("lang").agg(F.count("*").alias("many")).filter(F.col("many") >= top).select("lang")
        done = stored(enough.unionByName(held.filter("bar = 0").select("lang")).distinct(), "settled")
        part = found.join(done, "lang", "left_semi")
        settled = part if settled is None else settled.unionByName(part)
        open_ = stored(open_.join(done, "lang", "left_anti"), "open")
        aim *= 8
    if settled is None:
        settled = grown(texts.limit(0), pairs.withColumn("bar", F.lit(0)), least, inside)
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = settled.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The query's DuckDB twin: counts all phrases.
ORACLE = r"""
WITH w AS (
  SELECT lang, row_number() OVER () AS p, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM documents WHERE text IS NOT NULL)
), t AS (SELECT lang, p, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w
), s AS (SELECT lang, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM t WINDOW o AS (PARTITION BY p ORDER BY i)
), f1 AS (SELECT lang, x, count(*) AS f FROM s GROUP BY lang, x
), f2 AS (SELECT lang, x, y, count(*) AS f FROM s WHERE y IS NOT NULL GROUP BY lang, x, y
), f3 AS (SELECT lang, x, y, z, count(*) AS f FROM s WHERE z IS NOT NULL GROUP BY lang, x, y, z HAVING count(*) >= 10
), n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang
), h AS (SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z, f FROM f3) GROUP BY lang, x, y
), two AS (
  SELECT b.lang, b.x || ' ' || b.y AS phrase, b.f AS a, l.f AS l, r.f AS r, CAST(1000000 AS HUGEINT) * b.f * b.f // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM f2 b JOIN f1 l ON l.lang = b.lang AND l.x = b.x JOIN f1 r ON r.lang = b.lang AND r.x = b.y LEFT JOIN h ON h.lang = b.lang AND h.x = b.x AND h.y = b.y
  WHERE b.f >= 10 AND (h.f IS NULL OR 100 * h.f < 50 * b.f)
), c AS (
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z AS phrase, t.f AS a, x.f AS lx, yz.f AS ryz, xy.f AS lxy, z.f AS rz,
    CAST(1000000 AS HUGEINT) * t.f * t.f // (CAST(x.f AS HUGEINT) * yz.f) AS s1, CAST(1000000 AS HUGEINT) * t.f * t.f // (CAST(xy.f AS HUGEINT) * z.f) AS s2
  FROM f3 t JOIN f1 x ON x.lang = t.lang AND x.x = t.x JOIN f1 z ON z.lang = t.lang AND z.x = t.z
  JOIN f2 xy ON xy.lang = t.lang AND xy.x = t.x AND xy.y = t.y JOIN f2 yz ON yz.lang = t.lang AND yz.x = t.y AND yz.y = t.z
), every AS (
  SELECT * FROM two UNION ALL SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN lx ELSE lxy END, CASE WHEN s1 <= s2 THEN ryz ELSE rz END, least(s1, s2) FROM c
), o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM every)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""
