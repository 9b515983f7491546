"""Language identification by word-first backoff.

A word that the model knows is scored by its log frequency in each language. A word that it does not know is scored by
its character n-grams, the longest first: where an n-gram of the longest length is unknown, the shorter ones that begin there
are tried. A text's language is the one with the largest mean score of its words; its score is that language's share
after a softmax of the mean scores.

The model is fitted on a sample of labelled rows of documented size, about ``sample`` rows in all, as many of each language as
there are, so it has a bounded size too and may be broadcast. Every language of the learned rows can be predicted, and every
word and n-gram that the sample has at least ``least`` times is in the model; rarer words are left to the n-grams.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every text if nothing could be
learned; rows without lang or text teach nothing; rows without doc_id count as held out; ties go to the more
frequent language, then to the smaller name; repeated rows are scored alike; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, row_slices, small_batches, stored, text_slices

WORD = re.compile(r"[^\W\d_]+")
#: Words kept by a worker's cache of backoff scores before it starts anew, and the longest word it keeps.
CACHE_WORDS, LONGEST = 400_000, 64
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    words: list[str]
    word_scores: np.ndarray  # a row for each word, a column for each language
    grams: list[str]
    gram_scores: np.ndarray
    longest: int


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's text leaves no remainder modulo 5, and where there is no id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def padded(word: str) -> str:
    return f"<{word}>"


def counted(texts: DataFrame, longest: int, grams: bool) -> DataFrame:
    """(lang, term, n): how often each word, or each n-gram of a word, occurs by language. ``texts``: lang, text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                found: Counter[tuple[str, str]] = Counter()
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    for word, n in Counter(WORD.findall((text or "").lower())).items():
                        if not grams:
                            found[lang, word] += n
                            continue
                        p = padded(word)
                        for size in range(1, longest + 1):
                            for i in range(len(p) - size + 1):
                                found[lang, p[i : i + size]] += n
                keys = list(found)
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(found.values()), pa.int64())], ["lang", "term", "n"])

    return texts.mapInArrow(rows, "lang string, term string, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))


def table(counts: DataFrame, languages: list[str], least: int) -> tuple[list[str], np.ndarray]:
    """The terms that occur at least ``least`` times, and their centred log frequencies by language."""
    total = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    place = F.create_map(*(x for i, lang in enumerate(languages) for x in (F.lit(lang), F.lit(i))))
    by_term = counts.groupBy("term").agg(F.sum("n").alias("all"), F.collect_list(F.struct(place[F.col("lang")].alias("lang"), "n")).alias("by"))
    rows = by_term.filter(F.col("all") >= least).select("term", "by.lang", "by.n").toArrow().sort_by("term").combine_chunks()  # of the sample's size
    names = rows["term"].to_pylist()
    number = np.zeros((len(names), len(languages)))
    if names:
        lists = rows["lang"].combine_chunks()
        row = np.repeat(np.arange(len(names)), pc.list_value_length(lists).to_numpy())
        number[row, lists.flatten().to_numpy()] = rows["n"].combine_chunks().flatten().to_numpy()
    whole = np.array([total.get(x, 0) for x in languages], float)
    scores = np.log((number + 0.5) / (whole + 0.5 * max(1, len(names))))
    return names, scores - scores.mean(1, keepdims=True)


def fit(docs: DataFrame, sample: int = 8000, least: int = 2, longest: int = 4, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Model:
    """Learn from rows that are not held out. ``sample``: how many rows are read, about, whatever the input's size."""
    small_batches(docs.sparkSession)
    rows = docs.select(quoted(id_column).alias("doc_id"), quoted(text_column).cast("string").alias("text"), quoted(lang_column).cast("string").alias("lang"))
    rows = rows.filter("text is not null and lang is not null").filter(~held_out(F.col("doc_id")))
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()  # a row a language
    names = [r["lang"] for r in sizes]
    if not names:
        return Model([], [], np.zeros((0, 0)), [], np.zeros((0, 0)), longest)
    rate = F.create_map(*(x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, sample / len(sizes) / r["count"])))))
    chance = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
    taken = rows.filter(chance < rate[F.col("lang")]).select("lang", "text")
    word_names, word_scores = table(stored(counted(taken, longest, False), "words"), names, least)
    gram_names, gram_scores = table(stored(counted(taken, longest, True), "grams"), names, least)
    return Model(names, word_names, word_scores, gram_names, gram_scores, longest)


class Scorer:
    """Scores of texts by a model; the cache of unknown words is bounded and only saves time."""

    def __init__(self, model: Model):
        self.model = model
        self.grams = {g: i for i, g in enumerate(model.grams)}
        self.base = len(model.words)
        # Rows of the cache take memory only once they are written.
        self.scores = np.zeros((self.base + CACHE_WORDS, len(model.languages)))
        self.scores[: self.base] = model.word_scores
        self.forget()

    def forget(self) -> None:
        self.known = {w: i for i, w in enumerate(self.model.words)}
        self.used = self.base

    def backoff(self, word: str) -> np.ndarray:
        """The mean over places of the longest known n-gram that begins there."""
        grams, longest = self.grams, self.model.longest
        p = padded(word)
        rows: list[int] = []
        for i in range(len(p)):
            for size in range(longest, 0, -1):
                if (row := grams.get(p[i : i + size])) is not None:
                    rows.append(row)
                    break
        return self.model.gram_scores[rows].sum(0) / len(rows) if rows else np.zeros(len(self.model.languages))

    def places(self, words: list[str]) -> list[int]:
        """Rows of ``scores``; there are at most CACHE_WORDS words."""
        at = list(map(self.known.get, words))
        if None in at:
            new = dict.fromkeys(w for w, i in zip(words, at, strict=True) if i is None)
            if self.used + len(new) > self.base + CACHE_WORDS:
                self.forget()
                new = dict.fromkeys(w for w in words if w not in self.known)
            for w in new:
                self.scores[self.used] = self.backoff(w)
                self.known[w] = self.used
                self.used += 1
            at = list(map(self.known.__getitem__, words))
        return at

    def score(self, text: str | None) -> tuple[str, float]:
        words = WORD.findall(text.lower()) if text else []
        if not self.model.languages or not any(any(map(str.isalpha, w)) for w in words):
            return UNKNOWN, 0.0
        total = np.zeros(len(self.model.languages))
        for w in words:
            if len(w) > LONGEST:
                total += self.scores[self.known[w]] if w in self.known else self.backoff(w)
        short = [w for w in words if len(w) <= LONGEST]
        for a in range(0, len(short), CACHE_WORDS):
            total += self.scores[self.places(short[a : a + CACHE_WORDS])].sum(0)
        mean = total / len(words)
        share = np.exp(mean - mean.max())
        best = int(share.argmax())
        return self.model.languages[best], float(share[best] / share.sum())


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", keep: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text; with ``keep`` instead all columns of docs in ``row``. Map-only."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # of a documented size
    small_batches(spark)
    names = docs.columns if keep else list(dict.fromkeys([id_column, text_column]))
    source = docs.select(F.struct(*(quoted(c) for c in names)).alias("row"))
    given = source.schema["row"].dataType
    kind = (given if keep else given[id_column].dataType).simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            for part, texts in row_slices(batch, text_column):
                made = [scorer.score(None if t is None else t.decode()) for t in texts]
                whole = part.column(0)
                first = whole if keep else whole.field(whole.type.get_field_index(id_column))
                yield pa.RecordBatch.from_arrays([first, pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())], ["row", "lang_pred", "score"])

    out = source.mapInArrow(rows, f"row {kind}, lang_pred string, score double")
    return out if keep else out.withColumnRenamed("row", id_column)
