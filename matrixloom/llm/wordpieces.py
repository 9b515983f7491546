"""Token ids of whole texts by a public word-level tokenizer file, with a cache of words.

The words of a batch are found by array operations over its bytes and numbered by Arrow's dictionary encoding, so Python
looks at each distinct word of a batch once; the ids of all its occurrences are then taken by number.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, pre_tokenizers

#: Words kept by a worker's cache before it starts anew, and the longest word it keeps.
CACHE_WORDS, LONGEST = 250_000, 64
#: New words are encoded together, this many in one text, with a mark between them that is one token and in none of them.
TOGETHER, MARK = 256, "|"
#: Words that normaliser and pre-tokeniser leave as they are: small Latin letters, composed.
PLAIN = re.compile("[a-zß-öø-ÿ]+")

#: ASCII white space, small letters, and the marks that are a token of their own at the end of a word.
BLANK, SMALL, STOP = (np.isin(np.arange(256), list(x)) for x in (b" \t\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz", b".,"))


def words_of(data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of a buffer as an Arrow array without copies of single words, and where in the buffer each begins.

    A full stop or comma between a small letter and white space is a word of its own: apart, both are cached better.
    """
    inside = ~BLANK[data]
    before, after = np.concatenate([[False], inside[:-1]]), np.concatenate([inside[1:], [False]])
    starts = inside & ~before
    starts[1:] |= STOP[data[1:]] & SMALL[data[:-1]] & ~after[1:]
    starts = np.flatnonzero(starts)
    packed = data[inside]
    # Where each word begins once white space is gone.
    edges = np.append(np.cumsum(inside, dtype=np.int32)[starts] - 1, len(packed)).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(packed)]), starts


class WordEncoder:
    """Ids of texts whose tokens never span ASCII white space.

    That holds where the tokenizer's pre-tokeniser drops white space and nothing before it looks across it, as in
    the public word vocabulary, which also lowers case; texts are then encoded word by word, and a word's ids can be kept.
    Texts that may hold a special token keep their case.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # The same merges without the normaliser and the patterns, for plain words.
        self.short = Tokenizer(self.tokenizer.model)
        self.short.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: dict[bytes, bytes] = {}
        (self.mark,) = self.tokenizer.encode(MARK, add_special_tokens=False).ids

    def new_codes(self, tokenizer: Tokenizer, words: list[str]) -> list[bytes]:
        """Packed ids of words of which none has the mark."""
        texts = [f" {MARK} ".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
        out: list[bytes] = []
        for code in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(code.ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids)).tolist()
            data = ids.tobytes()
            out += [data[4 * a : 4 * b] for a, b in zip([0, *(e + 1 for e in ends)], ends)]
        return out

    def codes(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of distinct words."""
        found = list(map(self.known.get, words))
        missing = [i for i, x in enumerate(found) if x is None]
        if missing:
            if len(self.known) + len(missing) > CACHE_WORDS:
                self.known.clear()
            sorts: dict[str, tuple[list[int], list[str]]] = {"plain": ([], []), "other": ([], []), "alone": ([], [])}
            for i in missing:
                w = words[i].decode()
                at, names = sorts["plain" if PLAIN.fullmatch(w) else "alone" if MARK in w else "other"]
                at.append(i)
                names.append(w)
            for sort, (at, names) in sorts.items():
                made = [np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in names] if sort == "alone" else self.new_codes(self.short if sort == "plain" else self.tokenizer, names)
                for i, code in zip(at, made, strict=True):
                    found[i] = code
            self.known.update((words[i], found[i]) for i in missing if len(words[i]) <= LONGEST)
        return found

    def encode(self, texts: list[bytes], end: bytes = b"") -> list[bytes]:
        """Packed ids (little-endian unsigned 32-bit) of each text, then ``end``."""
        joined = b"\n".join(t if b"<|" in t else t.lower() for t in texts)
        if not joined:
            return [end] * len(texts)
        words, starts = words_of(np.frombuffer(joined, np.uint8))
        numbered = words.dictionary_encode()
        found = pa.array(self.codes(numbered.dictionary.to_pylist()), pa.large_binary()).take(numbered.indices)
        if not len(found):
            return [end] * len(texts)
        _, offsets, ids = found.buffers()
        at = np.frombuffer(offsets, np.int64, len(found) + 1, 8 * found.offset)
        begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
        cuts = at[np.searchsorted(starts, begin)].tolist()
        whole = memoryview(ids) if ids is not None else memoryview(b"")
        return [bytes(whole[a:b]) + end for a, b in zip(cuts, cuts[1:])]


@lru_cache(4)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
