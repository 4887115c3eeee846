"""Per-worker caches of what a public tokenizer makes of a single word.

The tokenizers here never merge across ASCII white space, so the tokens of a
text are those of its words in order.  Words are looked up for a chunk of
texts at a time.  A word's tokens are looked up once per
worker process and kept in two generations of bounded size: when the young one
is full it becomes the old one, so memory stays bounded on any vocabulary.
"""

from __future__ import annotations

import gc
import os
from array import array
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quarry.llm.common import return_memory, words_of

GENERATION_WORDS = 300_000
LONG_WORD_BYTES = 64          # longer words are encoded each time, not kept
LATIN_END = "\u0250"          # first character behind the Latin letters
TRAILING_MARKS = b".,;:!?"


class WordCache:
    """``table(texts' words)`` covers every word asked for; ``make(list of words)`` computes missing ones."""

    def __init__(self, make, generation_words: int = GENERATION_WORDS, special: tuple[bytes, ...] = ()):
        self.make = make
        self.special = special
        self.limit = generation_words
        self.young: dict[bytes, object] = {}
        self.old: dict[bytes, object] = {}
        self.passing: list[bytes] = []

    def words(self, text: bytes) -> list[bytes]:
        """The words of ``text`` to look up, A-Z lowered; those that would then hold a special token stay as written.

        Special tokens are matched before lower-casing, so ``<|EndOfText|>`` is not one.
        """
        low = text.lower()
        for s in self.special:
            if s in low:
                return [w if any(x in w.lower() for x in self.special) else w.lower() for w in text.split()]
        return low.split()

    def distinct(self, texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Of a chunk of texts (UTF-8 bytes): how many words each has, the distinct words, and where each word of the texts is among them."""
        view = pc.ascii_lower(texts.view(pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string()))
        if any(pc.any(pc.match_substring(view, s.decode())).as_py() for s in self.special):
            own = [self.words(t) for t in texts.to_pylist()]
            lengths, words = np.array([len(w) for w in own], dtype=np.int64), pa.array([w for ws in own for w in ws], texts.type)
        else:
            lengths, words = words_of(texts)
        coded = words.dictionary_encode()
        return lengths, coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()

    def values(self, words: list[bytes]) -> list:
        """The values of distinct ``words``, in their order; none of them is ``None``."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        out = list(map(young.get, words))
        new = []
        for k in (k for k, value in enumerate(out) if value is None):
            kept = old.get(words[k])
            if kept is None:
                new.append(k)
            else:
                out[k] = young[words[k]] = kept
        for k, value in zip(new, self.make([words[k] for k in new])):
            out[k] = value
            if len(words[k]) <= LONG_WORD_BYTES:
                young[words[k]] = value
        return out

    def table(self, texts: list[list[bytes]]) -> dict[bytes, object]:
        """A mapping with a value for each word of ``texts``, valid until the next call."""
        for w in self.passing:
            self.young.pop(w, None)
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        missing = set().union(*texts).difference(young)
        again = missing.intersection(old)
        for w in again:
            young[w] = old[w]
        new = list(missing.difference(again))
        if new:
            young.update(zip(new, self.make(new)))
        self.passing = [w for w in new if len(w) > LONG_WORD_BYTES]
        return young


_current: dict[tuple[str, str], WordCache] = {}


def cache_for(kind: str, path: str, build) -> WordCache:
    """The worker's cache of this kind, made by ``build(path)``; a worker holds one kind at a time."""
    if (kind, path) not in _current:
        give_back()
        _current[kind, path] = build(path)
    return _current[kind, path]


def give_back() -> None:
    """Drop the worker's cache and vocabulary, and return what it holds unused to the system.

    Spark keeps Python workers for later stages; what they hold counts against
    the executor's memory all the while.
    """
    _current.clear()
    gc.collect()
    return_memory()


def byte_level_table() -> dict[int, int]:
    """Byte -> visible character, as byte-level vocabularies write it: printable Latin-1 stays, the rest counts up from 256."""
    stays = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = [b for b in range(256) if b not in stays]
    return {b: 256 + k for k, b in enumerate(moved)}


def word_end_ids(path: str) -> WordCache:
    """The worker's cache of :func:`word_end_cache`."""
    return cache_for("word-end", path, word_end_cache)


def word_end_cache(path: str) -> WordCache:
    """Words -> native (little-endian) uint32 ids of the lower-casing word-end BPE vocabulary at ``path``.

    The ids are those of ``encode(text, add_special_tokens=False)``: a special
    token written in the text has its own id.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = tuple(t.content.encode().lower() for t in tokenizer.get_added_tokens_decoder().values())
    known: dict[bytes, bytes] = {}

    merge, visible = tokenizer.model.tokenize, byte_level_table()

    def plain(text: str) -> bool:
        """Whether normalising and splitting leave the word as it is: composed lower-case Latin letters."""
        return text.isalpha() and (text.isascii() or (max(text) < LATIN_END and is_normalized("NFC", text))) and text == text.lower()

    def encode(word: bytes) -> bytes:
        if word.isalpha():                               # ASCII letters, lowered before
            return array("I", [t.id for t in merge(word.decode("ascii"))]).tobytes()
        text = word.decode("utf-8", "replace")
        if plain(text):
            return array("I", [t.id for t in merge(word.decode("latin-1").translate(visible))]).tobytes()
        return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def make(words: list[bytes]) -> list[bytes]:
        # Marks at the end of a word are a pre-token of their own.
        young, old, made, out = cache.young, cache.old, {}, []
        if len(known) > 10_000:
            known.clear()
        for word in words:
            stem = word.rstrip(TRAILING_MARKS)
            if len(stem) == len(word) or not stem[-1:].isalnum():
                stem, tail = word, b""
            else:
                tail = word[len(stem):]
            ids = young.get(stem) or old.get(stem) or made.get(stem)
            if ids is None:
                ids = made[stem] = encode(stem)
            if tail:
                if tail not in known:
                    known[tail] = encode(tail)
                ids = ids + known[tail]
            out.append(ids)
        return out

    cache = WordCache(make, special=special)
    return cache
