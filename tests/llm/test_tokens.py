import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from matrixloom.llm import bins, bpe, packing, wordpieces

RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
PARTS = ["'", "s", "t", "re", "'ll", "'s", " ", "  ", "\n", "\t", "a", "é", "1", "½", "!", "$", "　", "\x1c", "\x85", "字", "😀", "İ", "́", ".", ","]
DOCS = [(1, "The it's  end.\n 'll go 字😀"), (2, None), (3, ""), (4, "x" * 9000), (None, "no id"), (5, "a b " * 3000), (5, "a b " * 3000)]


def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sample(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 16))) for _ in range(n)]


def test_encoder_matches_library():
    texts, enc = sample(4000, 1), reference()
    for a in range(0, len(texts), 7):
        part = texts[a : a + 7]
        got = [np.frombuffer(x, "<u4").tolist() for x in bpe.encoded([t.encode() for t in part], RANKS)]
        assert got == [enc.encode_ordinary(t) for t in part]


def test_every_code_point_matches_library():
    enc = reference()
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c} {c}1" for c in points[a : a + 2048]) for a in range(0, len(points), 2048)]
    for text in texts:
        assert np.frombuffer(next(bpe.encoded([text.encode()], RANKS)), "<u4").tolist() == enc.encode_ordinary(text)


def test_long_slice_matches_library():
    rng = random.Random(2)
    word = "".join(rng.choice("abcdefgh") for _ in range(3000))
    assert np.frombuffer(next(bpe.encoded([word.encode()], RANKS)), "<u4").tolist() == reference().encode_ordinary(word)


def test_scan_is_the_sequential_automaton():
    rng = np.random.default_rng(3)
    steps = bpe.TRANSITIONS[rng.integers(0, 8, 5000)]
    state, want = 0, []
    for f in steps.tolist():
        state = f >> 2 * state & 3
        want.append(state)
    assert bpe.scan(steps, 64).tolist() == want


def test_encode_round_trip_and_offsets(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("key", F.lit(2))
    out = bpe.encode(df, RANKS, outputs=("ids", "offsets", "decoded"))
    enc = reference()
    rows = out.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((d is None, d or 0) for d, _ in DOCS)
    texts = dict(DOCS)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == enc.encode_ordinary(data.decode()) and bytes(r.decoded) == data
        ends = np.frombuffer(r.offsets, "<u4").tolist()
        assert [data[a:b] for a, b in zip([0, *ends], ends)] == [enc.decode_single_token_bytes(i) for i in ids]
    again = bpe.decode(out.select("doc_id", "ids"), RANKS).collect()
    assert sorted(hashlib.md5(r.decoded).hexdigest() for r in again) == sorted(hashlib.md5(r.decoded).hexdigest() for r in rows)
    assert bpe.encode(df.limit(0), RANKS).count() == 0


def test_word_encoder_matches_library():
    tk, e = Tokenizer.from_file(WORDS), wordpieces.WordEncoder(WORDS)
    for t in [*sample(4000, 4), "A<|endoftext|>b", "A<|ENDOFTEXT|>B.", "Word. word, it's!. x.\ny", "a|b | c.| d", "Straße ß. é, e\u0301. ÷ x÷y Ωé", "one." * 3, ".", ", ."]:
        assert np.frombuffer(e.encode([t.encode()])[0], "<u4").tolist() == tk.encode(t, add_special_tokens=False).ids


def brute_best_fit(sizes, capacity):
    residual, place = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [(r, b) for b, r in enumerate(residual) if r >= sizes[i]]
        b = min(fits)[1] if fits else len(residual)
        if not fits:
            residual.append(capacity)
        residual[b] -= sizes[i]
        place[i] = b
    return len(residual), sorted(residual)


def test_best_fit_decreasing_and_bounds():
    rng = np.random.default_rng(5)
    for capacity in (7, 64, 2048):
        for _ in range(20):
            sizes = rng.integers(1, capacity + 1, rng.integers(1, 60))
            place, offset, used = bins.best_fit_decreasing(sizes, capacity)
            fill = np.bincount(place, sizes, used)
            assert (used, sorted((capacity - fill).astype(int).tolist())) == brute_best_fit(sizes.tolist(), capacity)
            for b in range(used):
                inside = np.flatnonzero(place == b)
                inside = inside[np.argsort(offset[inside])]
                assert offset[inside].tolist() == [0, *np.cumsum(sizes[inside])[:-1].tolist()] and sizes[inside].sum() <= capacity
            assert -(-int(sizes.sum()) // capacity) <= bins.lower_bound(sizes, capacity) <= used
    assert bins.lower_bound(np.array([1025] * 5), 2048) == 5


def pieces_of(text):
    ids = np.array([*Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids, 0], "<u4")
    return [ids[a : a + 2048] for a in range(0, len(ids), 2048)]


def test_pack(spark):
    docs = [*DOCS, *((100 + i, "w " * (i * 37 % 1500)) for i in range(300))]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("sequence_id", F.lit("x"))
    cut = packing.pieces(df, WORDS).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("crc"))
    rows = packing.pack(cut, part=64).collect()
    want = sorted((d or -1, n, 2048 * n, len(p), zlib.crc32(p.tobytes())) for d, t in docs for n, p in enumerate(pieces_of(t)))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.crc) for r in rows) == want
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in held.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    sizes = np.array([r.length for r in rows])
    assert len(held) <= bins.lower_bound(sizes, 2048) + 1
    assert packing.certificate(packing.pack(cut, part=64)) == (len(held), bins.lower_bound(sizes, 2048))
    assert packing.pack(cut.limit(0)).count() == 0


def test_sequence_numbers_of_many_rounds():
    bins_ = np.arange(3)
    made = [x for n in (0, 31, 32, 63, 64, 1000) for where in (0, 1, 1 << 20) for x in packing.sequence_numbers(n, where, bins_).tolist()]
    assert len(set(made)) == len(made) and min(made) >= 0
    for n, where in ((1 << 15, 0), (0, 1 << 24)):
        with pytest.raises(ValueError, match="no sequence number"):
            packing.sequence_numbers(n, where, bins_)


def test_matrices(spark, tmp_path):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    packed = packing.matrices(df, WORDS, held=4000)
    packing.write_matrices(packed, str(tmp_path / "m"), rows=2)
    seen = []
    for r in spark.read.parquet(str(tmp_path / "m")).collect():
        ids, positions = (np.frombuffer(x, "<u4") for x in (r.ids, r.positions))
        assert len(ids) == len(positions) == 2048 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        for d, n, a, b in zip(r.doc_ids, r.pieces, r.cu_seqlens, r.cu_seqlens[1:]):
            assert positions[a:b].tolist() == list(range(b - a))
            seen.append((d or -1, n, zlib.crc32(ids[a:b].tobytes())))
        assert not ids[r.n_tokens :].any()
    assert sorted(seen) == sorted((d or -1, n, zlib.crc32(p.tobytes())) for d, t in DOCS for n, p in enumerate(pieces_of(t)))
    assert packing.matrices(df.limit(0), WORDS).count() == 0


def test_encoder_with_a_full_cache(monkeypatch):
    monkeypatch.setattr(wordpieces, "CACHE_WORDS", 4)
    tk, e = Tokenizer.from_file(WORDS), wordpieces.WordEncoder(WORDS)
    texts = ["aa bb cc dd", "ee aa ff bb gg hh ii", "aa|x aa", "", "jj"]
    for part in (texts, texts[::-1]):
        assert [np.frombuffer(x, "<u4").tolist() for x in e.encode([t.encode() for t in part])] == [tk.encode(t, add_special_tokens=False).ids for t in part]


def test_batches_are_gathered_whole():
    import pyarrow as pa

    from matrixloom.llm.common import gathered

    rows = [(i, None if i % 5 == 0 else "x" * (i * 7 % 40)) for i in range(60)] + [(99, "y" * 500)]
    batches = [pa.RecordBatch.from_pylist([{"doc_id": a, "text": b} for a, b in rows[i : i + 4]], pa.schema([("doc_id", pa.int64()), ("text", pa.string())])) for i in range(0, 61, 4)]
    out = list(gathered(batches, "text", 100))
    assert [(r["doc_id"], r["text"]) for b in out for r in b.to_pylist()] == rows and len(out) < len(batches) + 10
    assert list(gathered([], "text")) == []
