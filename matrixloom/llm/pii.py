"""Personal data: fixed patterns, and information-theoretic sanitisation of the terms that give entities away.

In DataFrame operations only. Base kinds are found by patterns. Each distinct value found is a protected entity. Over the
distinct texts of the corpus (copies count once) it is counted in how many an entity stands (e), a term, which is a word of three
letters or more outside e-mail addresses (t), and both (k), of n texts in all. How strongly a term reveals an entity is

    share = log2(k * n / (e * t)) / log2(n / e)

1 means that the term never occurs without the entity. A pair counts only if it is no chance finding: with m = e * t / n joint texts
to be expected, k * (ln(k / m) - 1), which bounds the logarithm of the chance from below, must reach ln(pairs / chance), where ``pairs``
is the number of pairs that were looked at. So two joint texts suffice for rare terms in a large corpus, and one never
does. Terms tell too much from a share of ``generalise`` up, wherever they stand in a text with that entity.

Such a term gives way to a broader one: the class of all terms that begin with its first three, two or one letters (``PREFIXES``), of which the longest is
taken whose own share, from the texts that hold any term of the class, is below ``generalise`` for each entity of the text that the term
reveals. Terms with a share of ``remove`` or more, and those that have no such class, are removed.

All steps are linear in a text's length and matches: matches begin only where the run of their first characters begins, or where
the last match ended, and arrays are walked in slices.

Texts are told apart by 128 bits of their contents.

Defined results: a null text is empty; repeated rows get the same spans and count as one text; extra columns are not
read; rows without doc_id are treated like others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, quoted, stored

#: The kinds in their order, and their patterns.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a value must contain for its pattern to be tried at all.
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
TERM = r"\p{L}{3,}"
SPAN = "struct<s:int,k:int,e:int,kept:string>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True where a string of digits passes the Luhn check."""
    places = F.transform(F.split(F.reverse(number), ""), lambda d, i: F.when(d == "", 0).otherwise(
        F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(d.cast("int") * 2 > 9, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2))))
    return F.aggregate(places, F.lit(0), lambda a, x: a + x) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    """Whether a match holds up."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    size = F.length(digits(value))
    if kind == "card":
        return F.when((size >= 12) & (size <= 19), luhn(digits(value))).otherwise(False)
    if kind == "phone":
        return (size >= 9) & (size <= 15)
    return F.lit(True)


def found(text: Column, pattern: str) -> tuple[Column, Column]:
    """All matches of a pattern, and the text's pieces between them."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


#: Elements that an array is walked by at once: building an array element by element copies it each time.
SLICE = 256
SPANS_TYPE = "array<struct<s:int,k:int,e:int,v:string>>"


def sliced(array: Column) -> Column:
    """An array in slices. It should be a plain column; it is referred to twice, so that it is not made anew for each slice."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(array) - 1, F.lit(0)).cast("int"), F.lit(SLICE)), lambda i: F.slice(array, i + 1, F.lit(SLICE)))


def before_each(totals: Column, start: Column, add: Callable[[Column, Column], Column]) -> Column:
    """What ``add`` has made of the elements before each one of a short array."""
    zero = F.struct(start.alias("at"), F.expr("cast(array() as array<int>)").alias("all"))
    return F.aggregate(totals, zero, lambda a, x: F.struct(add(a["at"], x).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")))["all"]


def placed(docs: DataFrame, matches: str, pieces: str, kind: int, out: str) -> DataFrame:
    """``docs`` with spans (start, kind, end, value) of the matches, in code points."""
    cut, starts = fresh("cut", docs.columns), fresh("starts", docs.columns)
    pairs = F.zip_with(matches, F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda m, p: F.struct(m.alias("m"), p.alias("p"), (F.length(m) + F.length(p)).alias("n")))
    docs = docs.withColumn(out, pairs).withColumn(cut, sliced(F.col(out)))
    totals = F.transform(cut, lambda x: F.aggregate(x, F.lit(0), lambda a, y: a + y["n"]))
    docs = docs.withColumn(starts, before_each(totals, F.length(F.get(pieces, F.lit(0))), lambda a, x: a + x))

    def walk(x: Column, start: Column) -> Column:
        def step(a: Column, y: Column) -> Column:
            one = F.struct(a["at"].alias("s"), F.lit(kind).alias("k"), (a["at"] + F.length(y["m"])).alias("e"), y["m"].alias("v"))
            return F.struct((a["at"] + y["n"]).alias("at"), F.concat(a["spans"], F.array(one)).alias("spans"))

        return F.aggregate(x, F.struct(start.alias("at"), F.expr(f"cast(array() as {SPANS_TYPE})").alias("spans")), step)["spans"]

    return docs.withColumn(out, F.flatten(F.zip_with(cut, starts, walk))).drop(cut, starts)


def check(kind: str) -> Callable[[Column], Column]:
    return lambda x: passes(kind, x["v"])


def with_base(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with the base spans of column ``text`` (not null) as array ``out``, by start and kind."""
    temporary: list[str] = []
    whole: list[Column] = []
    for k, kind in enumerate(KINDS):
        matches, pieces, spans = (fresh(f"{x}_{kind}", docs.columns) for x in ("matches", "pieces", "spans"))
        hit = F.col(text).rlike(HINTS[kind])
        every, between = found(F.col(text), PATTERNS[kind])
        docs = docs.withColumn(matches, F.when(hit, every)).withColumn(pieces, F.when(hit & (F.size(matches) > 0), between))
        docs = placed(docs, matches, pieces, k, spans)
        docs = docs.withColumn(spans, F.when(F.size(pieces) > 1, F.filter(spans, check(kind))))
        temporary += [matches, pieces, spans]
        whole.append(F.coalesce(F.col(spans), F.expr(f"cast(array() as {SPANS_TYPE})")))
    return docs.withColumn(out, F.sort_array(F.concat(*whole))).drop(*temporary)


def entity(kind: Column, value: Column) -> Column:
    """A value in one spelling."""
    return F.concat_ws(":", kind.cast("string"), F.when(kind.isin(0, 1), F.lower(value)).otherwise(digits(value)))


def terms_of(body: Column) -> Column:
    """The distinct terms of a text."""
    bare = F.when(body.contains("@"), F.regexp_replace(body, PATTERNS["email"], " ")).otherwise(body)
    return F.array_distinct(F.transform(F.filter(F.split(bare, r"[^\p{L}]+"), lambda x: F.length(x) >= 3), F.lower))


#: Letters of the classes that a term may be generalised to.
PREFIXES = [3, 2, 1]


def text_key(body: Column) -> Column:
    """What a text is told apart by."""
    return F.struct(F.xxhash64(body).alias("a"), F.xxhash64(F.lit(1), body).alias("b"))  # two seeds


def classes_of(term: Column) -> Column:
    """The classes of a term, which has three letters at least."""
    return F.array(*(F.substring(term, 1, n) for n in PREFIXES))


def share_of(k: Column, e: Column, t: Column, whole: Column) -> Column:
    """How strongly what stands in t texts, k of them with an entity that stands in e, reveals it."""
    return F.try_divide(F.log2(k * whole / (e * t)), F.log2(whole / e))


def safe_classes(telling: DataFrame, weighted: DataFrame, held: DataFrame, words: DataFrame, generalise: float) -> DataFrame:
    """(entity, term, n): the classes, by their number of letters, that may stand for a term that reveals an entity."""
    wanted = stored(telling.select("entity", "term", F.explode(F.array(*map(F.lit, PREFIXES))).alias("n")).withColumn("class", F.expr("substring(term, 1, n)")), "wanted")
    classes = wanted.select("class").distinct()
    wide = weighted.select("weight", F.explode(F.array_distinct(F.flatten(F.transform(terms_of(F.col("body")), classes_of)))).alias("class")).join(classes, "class", "left_semi")
    wide = stored(wide.groupBy("class").agg(F.round(F.sum("weight")).cast("long").alias("t")), "classes")
    entities = held.join(telling.select("entity").distinct(), "entity", "left_semi")
    inside = words.join(entities.select("text_hash").distinct(), "text_hash", "left_semi").select("text_hash", F.explode(classes_of(F.col("term"))).alias("class"))
    inside = stored(inside.join(classes, "class", "left_semi").distinct(), "text-classes")
    # An entity's texts meet only the classes that are wanted for it.
    asked = entities.join(wanted.select("entity", "class").distinct(), "entity").join(inside, ["text_hash", "class"])
    joint = asked.groupBy("entity", "class").agg(F.count("*").alias("k"), F.first("e").alias("e"), F.first("whole").alias("whole")).join(wide, "class")
    safe = joint.filter(share_of(F.col("k"), F.col("e"), F.col("t"), F.col("whole")) < generalise)
    return wanted.join(safe.select("entity", "class"), ["entity", "class"]).select("entity", "term", "n")


def disclosures(texts: DataFrame, based: DataFrame, generalise: float, remove: float, chance: float) -> DataFrame:
    """(text_hash, term, letters): the terms that reveal an entity of a text, and how many of their letters may stay (0: removed).

    ``texts``: text_hash, body of every row; ``based``: text_hash and base spans of every row, in the shared folder.
    """
    # Each of n copies of a text counts 1 / n, so that texts need not be gathered to be counted once.
    copies = stored(based.groupBy("text_hash").agg(F.count("*").alias("n")).filter("n > 1"), "copies")
    weighted = texts.join(copies, "text_hash", "left").withColumn("weight", 1.0 / F.coalesce("n", F.lit(1)))
    in_texts = F.round(F.sum("weight")).cast("long")
    whole = based.select("text_hash").distinct().agg(F.count("*").alias("whole"))
    words = weighted.select("weight", F.explode(terms_of(F.col("body"))).alias("term"))
    terms = stored(words.groupBy("term").agg(in_texts.alias("t")).filter("t > 1"), "terms")

    values = based.filter(F.size("base") > 0).select("text_hash", F.explode(F.array_distinct(F.transform("base", lambda x: entity(x["k"], x["v"])))).alias("entity"))
    values = stored(values.distinct(), "entities")
    twice = values.groupBy("entity").agg(F.count("*").alias("e")).filter("e > 1").crossJoin(F.broadcast(whole))  # one row
    # A term that more texts have cannot reach the least share.
    held = stored(values.join(twice, "entity").withColumn("most", F.col("e") * F.pow(F.col("whole") / F.col("e"), F.lit(1 - generalise)) + 1e-6), "held")
    there = texts.join(held.select("text_hash").distinct(), "text_hash", "left_semi").dropDuplicates(["text_hash"])
    there = stored(there.select("text_hash", F.explode(terms_of(F.col("body"))).alias("term")), "terms-near")
    near = stored(there.join(terms, "term"), "near")
    met = held.join(near, "text_hash").filter("t <= most")
    pairs = stored(met.groupBy("entity", "term").agg(F.count("*").alias("k"), F.first("e").alias("e"), F.first("t").alias("t"), F.first("whole").alias("whole")), "pairs")
    number = pairs.agg(F.count("*").alias("pairs"))
    expected = F.col("e") * F.col("t") / F.col("whole")
    sure = F.col("k") * (F.log(F.col("k") / expected) - 1) >= F.log(F.col("pairs") / F.lit(chance))
    share = share_of(F.col("k"), F.col("e"), F.col("t"), F.col("whole"))
    telling = pairs.filter("k > 1").crossJoin(F.broadcast(number)).filter(sure).withColumn("share", share).filter(F.col("share") >= generalise)  # one row
    telling = stored(telling.select("entity", "term", "share"), "telling")
    safe = safe_classes(telling.filter(F.col("share") < remove), weighted, held, there, generalise)
    safe = stored(telling.join(safe, ["entity", "term"], "left").groupBy("entity", "term").agg(F.collect_set("n").alias("safe")), "safe")
    found_in = near.join(held.select("text_hash", "entity"), "text_hash").join(safe, ["entity", "term"])
    # A class has to be safe for all entities of a text that the term reveals.
    agreed = [F.when(F.every(F.array_contains("safe", n)), F.lit(n)) for n in PREFIXES]
    return stored(found_in.groupBy("text_hash", "term").agg(F.coalesce(*agreed, F.lit(0)).alias("letters")), "disclosures")


def spans(docs: DataFrame, generalise: float = 0.8, remove: float = 0.95, chance: float = 0.01, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """Base spans and added spans, both in the shared folder.

    The first has doc_id, text_hash and base (array of start, kind, end, value) of every row; the second, by text_hash, added
    (array of s, k: 4 generalised or 5 removed, e, kept: the class that a generalised term gives way to), one row for each text that has any.
    """
    rows = docs.select(quoted(id_column).alias("doc_id"), F.coalesce(quoted(text_column).cast("string"), F.lit("")).alias("body")).withColumn("text_hash", text_key(F.col("body")))
    based = stored(with_base(rows, "body", "base").select("doc_id", "text_hash", "base"), "based")
    texts = rows.select("text_hash", "body")
    shares = disclosures(texts, based, generalise, remove, chance)
    hit = texts.join(shares.select("text_hash").distinct(), "text_hash", "left_semi").dropDuplicates(["text_hash"])
    # An address is read as one word, so that what it holds is no term.
    every, between = found(F.col("body"), f"{PATTERNS['email']}|{TERM}")
    hit = placed(hit.withColumn("matches", every).withColumn("pieces", between).drop("body"), "matches", "pieces", 0, "words")
    hit = hit.select("text_hash", F.explode("words").alias("x")).select("text_hash", F.lower("x.v").alias("term"), "x.s", "x.e")
    kind = F.when(F.col("letters") > 0, 4).otherwise(5)
    kept = F.expr("substring(term, 1, letters)")
    added = hit.join(shares, ["text_hash", "term"]).groupBy("text_hash").agg(F.sort_array(F.collect_list(F.struct("s", kind.alias("k"), "e", kept.alias("kept")))).alias("added"))
    return based, stored(added, "added")


NAMES = [*KINDS, "generalise", "remove"]


def listed(array: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(array, lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, NAMES)), x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def together(based: DataFrame, added: DataFrame, keep: list[str]) -> DataFrame:
    """``based`` (columns ``keep``, text_hash, base) with ``every``: base and added spans in order."""
    h = fresh("added_hash", based.columns)
    whole = based.join(added.select(F.col("text_hash").alias(h), "added"), F.col("text_hash") == F.col(h), "left")
    plain = F.transform("base", lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), F.lit("").alias("kept")))
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    return whole.select(*keep, F.sort_array(F.concat(plain, F.coalesce("added", none))).alias("every"))


def detected(docs: DataFrame, **options) -> DataFrame:
    """doc_id, base (array of s, k, e, v), every (array of s, k, e, kept): all spans of every whole text."""
    return together(*spans(docs, **options), ["doc_id", "base"])


def of_kind(base: Column, kind: int) -> Column:
    return F.size(F.filter(base, lambda x: x["k"] == kind)).cast("long")


#: Code points of the blocks that a text is cut into, so that no part of it has to be counted out from its beginning.
BLOCK = 64


def sanitised(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` with personal data replaced by [EMAIL], [IP], [CARD], [PHONE], generalised terms by their class, such as [wil*], and removed terms by nothing.

    Where spans overlap, the one that begins first is replaced and the rest of the other with it. A null text stays null.
    """
    _, added = spans(docs, id_column=id_column, text_column=text_column, **options)
    rows = docs.select(F.struct(*(quoted(c) for c in docs.columns)).alias("row"), F.coalesce(quoted(text_column).cast("string"), F.lit("")).alias("body"))
    rows = with_base(rows, "body", "base").withColumn("text_hash", text_key(F.col("body")))
    rows = together(rows, added, ["row", "body"])
    # The end of all spans before each span: where the text goes on.
    rows = rows.withColumn("cut", sliced(F.col("every")))
    rows = rows.withColumn("starts", before_each(F.transform("cut", lambda x: F.coalesce(F.array_max(F.transform(x, lambda y: y["e"])), F.lit(0))), F.lit(0), F.greatest))

    def walk(x: Column, start: Column) -> Column:
        def step(a: Column, y: Column) -> Column:
            one = F.struct(a["at"].alias("at"), y["s"].alias("s"), y["k"].alias("k"), y["kept"].alias("kept"))
            return F.struct(F.greatest(a["at"], y["e"]).alias("at"), F.concat(a["all"], F.array(one)).alias("all"))

        return F.aggregate(x, F.struct(start.alias("at"), F.expr("cast(array() as array<struct<at:int,s:int,k:int,kept:string>>)").alias("all")), step)["all"]

    rows = rows.withColumn("walked", F.when(F.size("every") > 0, F.flatten(F.zip_with("cut", "starts", walk))))
    rows = rows.withColumn("blocks", F.when(F.size("every") > 0, F.regexp_extract_all("body", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))
    mask = F.array(*(F.lit(x) for x in ["[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "", ""]))

    def part(a: Column, b: Column) -> Column:
        first = F.floor(a / BLOCK).cast("int")
        whole = F.array_join(F.slice("blocks", first + 1, F.floor((b - 1) / BLOCK).cast("int") - first + 1), "")
        return F.when(b > a, F.substring(whole, a % BLOCK + 1, b - a)).otherwise("")

    parts = F.transform("walked", lambda x: F.when(x["s"] < x["at"], "").otherwise(F.concat(part(x["at"], x["s"]), F.when(x["k"] == 4, F.concat(F.lit("["), x["kept"], F.lit("*]"))).otherwise(F.element_at(mask, x["k"] + 1)))))
    last = F.array_max(F.transform("every", lambda x: x["e"]))
    text = F.when(F.size("blocks") > 0, F.concat(F.array_join(parts, ""), part(last, F.length("body")))).otherwise(F.col("row")[text_column])
    return rows.select(*(text.alias(c) if c == text_column else F.col("row")[c].alias(c) for c in docs.columns))
