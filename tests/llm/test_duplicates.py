import hashlib
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from matrixloom.llm import simhash, suffix


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints, radius=4):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def test_bit_sliced_comparison():
    rng = np.random.default_rng(1)
    for radius in (0, 3, 4, 6):
        runs = []
        for _ in range(5):
            p = rng.integers(0, 1 << 63, 3, dtype=np.uint64)[rng.integers(0, 3, rng.integers(1, 150))]
            for _ in range(7):
                p = p ^ np.where(rng.random(len(p)) < 0.5, np.uint64(1) << rng.integers(0, 64, len(p)).astype(np.uint64), np.uint64(0))
            runs.append(p)
        size = np.array([len(r) for r in runs])
        first = np.repeat(np.cumsum(size) - size, size)
        got = {(int(i), int(j)) for a, b in simhash.near(np.concatenate(runs), first, np.repeat(size, size), radius, 97) for i, j in zip(a, b)}
        want, at = set(), 0
        for r in runs:
            i, j = np.nonzero(np.bitwise_count(r[:, None] ^ r[None, :]) <= radius)
            want |= {(at + int(x), at + int(y)) for x, y in zip(i, j) if y < x}
            at += len(r)
        assert got == want
    wide = rng.integers(0, 1 << 63, (3, 2), dtype=np.uint64)[rng.integers(0, 3, 200)]
    for _ in range(40):
        wide = wide ^ np.where(rng.random(wide.shape) < 0.5, np.uint64(1) << rng.integers(0, 64, wide.shape).astype(np.uint64), np.uint64(0))
    distance = np.bitwise_count(wide[:, None] ^ wide[None, :]).sum(2)
    for radius in (0, 20, 36, 37):
        got = {(int(i), int(j)) for a, b in simhash.near(wide, np.zeros(200, int), np.full(200, 200), radius, 97) for i, j in zip(a, b)}
        assert got == {(i, j) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(distance <= radius))) if j < i}


def test_groups_match_brute_force(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    base = [[rng.choice(words) for _ in range(rng.randint(0, 80))] for _ in range(25)]
    docs = []
    for i in range(150):
        w = list(rng.choice(base))
        if w and rng.random() < 0.5:
            w[rng.randrange(len(w))] = rng.choice(words)
        docs.append((i * 2, " ".join(w)))
    docs += [(900, None), (901, ""), (902, " \t"), (903, "One TWO"), (904, "one two"), (905, "É é")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("bits", F.lit("clash"))
    prints = [brute_fingerprint(t) for _, t in docs]
    want = {d: (format(p, "016x"), docs[r][0]) for (d, _), p, r in zip(docs, prints, brute_groups(prints))}
    for tile in (4096, 10):
        got = simhash.groups(df, tile=tile).withColumn("h", simhash.hexadecimal(F.col("bits"))).collect()
        assert {r.doc_id: (r.h, r.component_id) for r in got} == want


def test_one_of_each_and_odd_rows(spark):
    docs = [(1, "a b c d e", 1), (2, "a b c d e", 2), (2, "a b c d e", 2), (None, "a b c d e", 3), (7, "quite another text here", 4)]
    df = spark.createDataFrame(docs, "doc_id long, text string, component_id int")
    grouped = simhash.groups(df)
    assert {(r.doc_id, r.component_id) for r in grouped.collect()} == {(1, 1), (2, 1), (None, 1), (7, 7)}
    assert sorted(((r.doc_id or 0), r.component_id) for r in simhash.one_of_each(df, grouped).collect()) == [(0, 3), (1, 1), (7, 4)]
    assert simhash.groups(df.limit(0)).count() == 0


def brute_cut(docs, length=100):
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                gone[s : s + length] = True
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i] = (hashlib.sha256(kept).hexdigest(), int(gone.sum()), spans)
    return out


def own_cut(df):
    rows = suffix.cut(df, suffix.repeats(df)).collect()
    return [(r.doc_id, (hashlib.sha256(r.kept).hexdigest(), sum(b - a for a, b in r.removed), len(r.removed))) for r in rows]


def test_cut_matches_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefgh é\n") for _ in range(400)) for _ in range(5)] + ["ab" * 250, "x" * 400]
    docs = []
    for i in range(50):
        t = ""
        for _ in range(rng.randint(0, 5)):
            b, a = rng.choice(base), rng.randint(0, 300)
            t += b[a : a + rng.randint(50, 300)]
            if rng.random() < 0.6:
                t += "".join(rng.choice("xyzé") for _ in range(rng.randint(0, 60)))
        docs.append((i * 3, t))
    docs += [(500, None), (501, ""), (502, "x" * 99), (503, "x" * 100)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("runs", F.lit("clash")).withColumn("kept_bytes", F.lit(1)).repartition(3)
    assert dict(own_cut(df)) == brute_cut(docs)


def test_cut_of_odd_rows(spark):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(160))
    docs = [(1, passage), (1, passage), (None, passage), (2, "new " + passage)]
    got = own_cut(spark.createDataFrame(docs, "doc_id long, text string"))
    assert [x[1][1] for x in got if x[0] in (1, None)] == [0, 0, 0]
    assert [x[1][1] for x in got if x[0] == 2] == [len(passage)]
    assert own_cut(spark.createDataFrame([], "doc_id long, text string")) == []


def test_cut_keeps_texts_of_one_id_apart(spark):
    rng = random.Random(11)
    new = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    base = new(300)
    docs = [(1, base), (2, new(180)), (2, base[:90] + new(180)), (2, new(50) + base[100:250]), (3, base[:120]), (None, base)]
    docs.append(docs[3])
    got = spark.createDataFrame(docs, "doc_id long, text string")
    removed = {(r.doc_id, r.text): [tuple(x) for x in r.removed] for r in suffix.cut(got, suffix.repeats(got)).collect()}
    assert removed == {**{d: [] for d in docs}, docs[3]: [(50, 200)], docs[4]: [(0, 120)]}


def test_cut_of_long_texts(spark):
    """Texts beyond the chunk that is handled at once, with more runs than a slice has, and repeats across both edges."""
    rng = random.Random(12)
    long = "".join(rng.choices("abcdefgh é", k=1_150_000))
    blocks = "".join(long[i : i + 130] + str(i) for i in range(0, 700_000, 140))
    docs = [(1, long), (2, "x" + long[(1 << 19) - 900 : (1 << 19) + 700]), (3, blocks)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert dict(own_cut(df)) == brute_cut(docs)


def five_word_similarity(a, b):
    a, b = ({" ".join(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.lower().split(), b.lower().split()))
    return len(a & b) / len(a | b)


def test_pipeline_drops_by_exact_similarity(spark):
    import corpus_pipeline

    rng = random.Random(5)
    new = lambda: f"w{rng.randrange(50000)}"
    rows, linked, apart = [], set(), set()
    for k in range(150):
        base = [new() for _ in range(rng.choice([60, 200, 600]))]
        other = list(base)
        # A changed word changes five shingles, so the pairs lie around 0.8.
        for at in rng.sample(range(len(base)), max(1, round(len(base) * rng.uniform(0.01, 0.04)))):
            other[at] = new()
        a, b = " ".join(base), " ".join(other)
        rows += [(2 * k, a, "en", "h", len(a)), (2 * k + 1, b, "en", "h", len(b))]
        (linked if five_word_similarity(a, b) >= 0.8 else apart).add(2 * k + 1)
    assert len(linked) > 30 and len(apart) > 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == set(range(0, 300, 2)) | apart


def test_similar_groups_match_brute_force(spark):
    rng = random.Random(6)
    new = lambda: f"w{rng.randrange(300)}"
    base = [new() for _ in range(120)]
    texts = [None, "", "One two", "one  TWO"]
    for _ in range(60):  # one large bucket of texts of which some are linked; it is cut into tiles
        t = list(base)
        for at in rng.sample(range(len(t)), rng.randrange(6)):
            t[at] = new()
        texts.append(" ".join(t))
    words = [(t or "").lower().split() for t in texts]
    sets = [{" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in words]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for tile in (8, 2048):
        got = {r.doc_id: r.component_id for r in simhash.similar_groups(docs, tile=tile).collect()}
        assert got == dict(enumerate(root))
    assert simhash.similar_groups(docs.limit(0)).count() == 0


def test_files_find_pairs_at_the_least_similarity():
    rng = np.random.default_rng(8)
    flip = np.arccos(2 * 0.8 / 1.8) / np.pi
    bits = simhash.chosen_bits(10**6, 2, flip, 256, 1e-4)
    found = near = 0
    for _ in range(300):
        h = rng.integers(0, 1 << 63, 1100, np.uint64)
        a, b = simhash.wide_print(h[:900], 2), simhash.wide_print(np.concatenate([h[:800], h[1000:]]), 2)  # 800 of 1,000
        x, y = (np.unpackbits(p.view(np.uint8), bitorder="little") for p in (a, b))
        near += (x != y).sum() <= 37
        found += (x[bits] == y[bits]).all(1).any()
    assert near >= 299 and found >= 297


def test_unrelated_texts_are_no_candidates(spark, monkeypatch):
    """Texts that are alike by chance would join most of a larger corpus in one group of candidates; few files are made at once."""
    rng = random.Random(13)
    new = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    long = new(200).split()
    texts = [new(rng.randrange(20, 60)) for _ in range(6000)] + [new(6) for _ in range(1000)] + [" ".join(long), " ".join([*long[:-1], "x"])]
    met, files = [], []
    verify, file = simhash.verified_links, simhash.filed_by
    monkeypatch.setattr(simhash, "verified_links", lambda rows, *a: met.append(rows.count()) or verify(rows, *a))
    monkeypatch.setattr(simhash, "filed_by", lambda nodes, bits, *a: files.append(len(bits)) or file(nodes, bits, *a))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = simhash.similar_groups(docs).filter("doc_id <> component_id").collect()
    assert [tuple(r) for r in got] == [(7001, 7000)]
    assert met == [2]
    assert max(files) <= 8 and sum(files) >= 20


def test_genuine_replacement_characters_stay(spark):
    import corpus_pipeline

    rng = random.Random(9)
    passage = "é" + "".join(rng.choice("abcdefgh ") for _ in range(130)) + "😀"
    docs = [(1, passage, "x"), (2, f"a\ufffdb\u00a9{passage[1:]}c\ufffd", "y"), (3, None, "z")]  # the cut begins inside a character
    df = spark.createDataFrame(docs, "doc_id long, text string, kept_bytes string")
    got = {r.doc_id: (r.text, r.kept_bytes) for r in corpus_pipeline.cut_repeats(spark, df, "").collect()}
    assert got == {1: (passage, "x"), 2: ("a\ufffdbc\ufffd", "y"), 3: (None, "z")}
