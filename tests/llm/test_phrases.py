import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from matrixloom.llm import collocations, lexical
from matrixloom.llm.queries import oracle_sql, queries
from tests.oracle import assert_same

TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_search(docs, items, top):
    terms = [(d, Counter(re.findall(TERM, lowered(t)))) for d, t in docs]
    terms = [(d, c) for d, c in terms if c]
    n_docs, n_terms = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    asks = defaultdict(set)
    for i, t in items:
        if i is not None:
            asks[i] |= set(re.findall(TERM, lowered(t)))
    out = []
    for item, wanted in asks.items():
        found = []
        for d, c in terms:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted & c.keys())
            if s > 0:
                found.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if no else d, -s) for r, (s, no, d) in enumerate(sorted(found)[:top])]
    return sorted(map(repr, out))


def own_search(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("term", F.lit(1)).withColumn("rank", F.lit("x"))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(1)).withColumn("doc_id", F.lit(5))
    return sorted(repr(tuple(r)) for r in lexical.search(d, i, **more).select("item_id", "rank", "doc_id", "score").collect())


def test_mined_graph_gives_the_same_sums_with_fewer_additions():
    rng = np.random.default_rng(4)
    for n in (1, 2, 40):
        core = rng.choice(200, 30, replace=False)
        items = [sorted({*rng.choice(200, 12).tolist(), *core[rng.random(30) < 0.7].tolist()}) for _ in range(n)] + [[3], [3, 5]]
        graph = lexical.mined(200, items)
        base = np.zeros((graph.nodes, 7), np.int64)
        base[:200] = rng.integers(0, 1000, (200, 7))
        want = np.array([base[x].sum(0) for x in items])
        assert (graph.sums(base) == want).all()
        plain = sum(len(x) - 1 for x in items)
        assert graph.additions <= plain and (n < 40 or graph.additions < plain / 2)


@pytest.mark.parametrize(("block", "top"), [(256, 5), (3, 50)])
def test_search_matches_brute_force(spark, block, top):
    rng = random.Random(5)
    words = [f"Wört{i}" if i % 3 else f"a{i}" for i in range(60)]
    text = lambda: " ".join(rng.choices(words, k=rng.randint(0, 60)))
    docs = [(i // 2, text()) for i in range(120)] + [(500 + i, "same Same-text") for i in range(8)] + [(None, text()), (None, None), (7, None), (8, " ,;")]
    items = [(i, text()) for i in range(12)] + [(3, "same text"), (20, "text"), (20, "text"), (21, None), (22, "nowhere"), (None, "a0 a3")]
    assert own_search(spark, docs, items, block=block, top=top) == brute_search(docs, items, top)


def test_search_of_nothing(spark):
    assert own_search(spark, [], [(1, "a")]) == []
    assert own_search(spark, [(1, "a")], []) == []
    assert own_search(spark, [(1, None)], [(1, "a"), (2, None)]) == []


def test_best_keeps_ties_to_smaller_ids():
    rng = np.random.default_rng(6)
    scores, docs = rng.integers(0, 9, (3, 400)), rng.permutation(400)
    best = lexical.Best(3, 7, most=50)
    for a in range(0, 400, 13):
        best.add(scores[:, a : a + 13], np.zeros(len(docs[a : a + 13]), bool), docs[a : a + 13])
    want = [(i, d, s) for i in range(3) for s, d in sorted(zip((-scores[i]).tolist(), docs.tolist()))[:7] for s in [-s]]
    assert [(int(i), int(d), int(s)) for i, _, d, s in best.cut().T] == want


def brute_phrases(docs, top, least, inside=50):
    f = defaultdict(Counter)
    for lang, text in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            w = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n, kept = sum(v for p, v in c.items() if len(p) == 1), []
        held = Counter()
        for p, a in c.items():
            if len(p) == 3 and a >= least:
                for part in (p[:2], p[1:]):
                    held[part] = max(held[part], a)
        for p, a in c.items():
            if len(p) > 1 and a >= least and not (p in held and 100 * held[p] >= inside * a):
                s, _, left, right = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                kept.append((-s, -a, " ".join(p).encode(), left, right))
        out += [(lang, r + 1, p.decode(), -a, left, right, n, -s) for r, (s, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(map(repr, out))


def own_phrases(spark, docs, **more):
    df = spark.createDataFrame(docs, "lang string, text string").withColumn("phrase", F.lit("x")).withColumn("f", F.lit(1))
    return sorted(repr(tuple(r)) for r in collocations.mined(df, **more).collect())


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"W{i}é" if i % 4 == 0 else f"w{i}" for i in range(40)]
    weight = [1 / (i + 1) for i in range(40)]
    fixed = [" ".join(rng.choices(words, k=3)) for _ in range(12)]
    text = lambda: "".join((rng.choice(fixed) if rng.random() < 0.3 else rng.choices(words, weight)[0]) + rng.choices([" ", "\t ", ". ", "\n", "\r\n", ",", " \x1c "], [8, 1, 1, 1, 1, 1, 1])[0] for _ in range(rng.randint(0, 60)))
    return [(rng.choice(["en", "en", "de", None, "und"]), text()) for _ in range(n)]


@pytest.mark.parametrize(("top", "wave", "phrases"), [(2000, 4, 1 << 20), (15, 1, 50), (3, 2, 1 << 20)])
def test_phrases_match_brute_force(spark, top, wave, phrases, monkeypatch):
    monkeypatch.setattr(collocations, "PHRASES", phrases)
    docs = corpus(7, 300) + [("en", None), ("en", ""), ("fr", "w1 w2"), ("fr", None), ("es", "a b c " * 12 + ". " + "a b " * 3)]
    assert own_phrases(spark, docs, top=top, wave=wave, least=4) == brute_phrases(docs, top, 4)


def test_phrases_of_nothing(spark):
    assert own_phrases(spark, []) == []
    assert own_phrases(spark, [("en", None), (None, " \t.")]) == []


def test_hashes_agree_and_long_products_are_exact(spark):
    row = spark.sql("select 'en' as lang, 'wört' as x, 'b' as y").select(collocations.pair_column("lang", "x", "y").alias("h")).first()
    state = collocations.Language("en", None)
    state.coded(["wört b".encode()])
    assert int(collocations.pair_hash(*state.known()[1:, None])[0]) == row.h % (1 << 64)
    got = spark.sql("select 3000000000000l as a, 3000000000001l as l, 2999999999999l as r").select(collocations.score("a", "l", "r")).first()[0]
    assert got == 1_000_000 * 3_000_000_000_000**2 // (3_000_000_000_001 * 2_999_999_999_999)


def test_growth_counts_less_than_everything():
    """Of phrases of three words only those within the bounds are counted."""
    docs = [t.encode() for _, t in corpus(8, 200)]
    state = collocations.Language("en", np.full(1 << 16, collocations.FREQUENT, np.uint8))
    collocations.phrases_in(state, docs, 3)
    assert state.size == 0
    state.marks = np.full(1 << 16, collocations.FREQUENT | collocations.PREFIX | collocations.SUFFIX, np.uint8)
    collocations.phrases_in(state, docs, 3)
    assert state.size > 100


@pytest.mark.parametrize("name", ["op12_lexical", "op13_collocations"])
def test_queries_match_sql(spark, name):
    assert assert_same(spark, "/root/testdata/sf0.01", queries()[name], oracle_sql()[name]) > 300
