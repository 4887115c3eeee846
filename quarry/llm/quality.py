"""Quality rules: tokeniser fertility beside simple counts of words, symbols and repetition.

A public subword vocabulary with byte fallback is applied to every word.  Text
of the kind it was made for takes long tokens and few fallback bytes, and its
tokens are spread evenly.  Per document: characters per token, the share of
fallback bytes among the tokens, the entropy of its tokens in bits, and their
evenness: the entropy as a share of what ``min(tokens, 512)`` different tokens
would have, which makes short and long documents comparable.  A band of
accepted values belongs to each language; a document whose language has no
band is judged by its main script.

Base counts: words are runs without ASCII white space.  ``n_symbols`` counts
``#*$%&|<>``; ``n_dup_lines`` counts lines with a word that equal an earlier
line; ``n_repeat_words`` counts the words that lie in a 3-word window found
twice or more.

Defined results: a null or empty text has no words and fails the base rules;
repeated rows get equal verdicts; a null or unknown language is judged by
script; an empty table stays empty; other columns pass through untouched.
Each row is judged alone, so there is no shuffle.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_schema, clean_text, ddl, fresh_name, text_chunks
from quarry.llm.wordcache import WordCache, cache_for, give_back

MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
NOT_COUNTED = b" \t\n\v\f\r" + bytes(range(0x80, 0xC0))     # white space, and all but the first byte of a character
EVEN_TOKENS = 512             # evenness is measured against at most so many different tokens
FALLBACK_IDS = (3, 258)       # first and last id of the byte pieces in the vocabulary


@dataclass(frozen=True)
class Band:
    """Accepted values of one language or script."""

    min_chars_per_token: float
    max_chars_per_token: float
    max_byte_share: float
    min_evenness: float


#: By language code, then by script for documents of other or unknown languages.
LANGUAGE_BANDS = {
    "en": Band(2.06, 6.5, 0.02, 0.700),
    "de": Band(2.07, 6.5, 0.02, 0.695),
    "fr": Band(1.83, 6.5, 0.02, 0.685),
    "es": Band(1.80, 6.5, 0.02, 0.685),
}
SCRIPT_BANDS = {
    "latin": Band(1.5, 7.0, 0.10, 0.60),
    "greek": Band(0.8, 6.0, 0.30, 0.55),
    "cyrillic": Band(1.2, 6.0, 0.10, 0.55),
    "hebrew": Band(0.8, 5.0, 0.60, 0.45),
    "arabic": Band(0.8, 5.0, 0.60, 0.45),
    "indic": Band(0.3, 4.0, 0.95, 0.35),
    "thai": Band(0.3, 4.0, 0.95, 0.35),
    "hangul": Band(0.3, 3.0, 0.95, 0.35),
    "kana": Band(0.3, 3.0, 0.95, 0.35),
    "han": Band(0.3, 3.0, 0.95, 0.35),
    "other": Band(0.3, 8.0, 0.95, 0.30),
}
#: First code point of each block of letters, in order; the script from there on.
SCRIPT_STARTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "other"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x32000, "other"),
]
MEASURES = ddl(
    "n_words:long word_chars:long n_symbols:long n_dup_lines:long n_repeat_words:long base_failed:boolean "
    "n_tokens:long chars_per_token:double byte_share:double token_entropy:double token_evenness:double band:string kept:boolean"
)


def main_script(words: list[bytes]) -> str:
    """The script most of the words' letters belong to."""
    text = b"".join(words).decode("utf-8", "replace")
    text = re.sub(r"[\W\d_]+", "", text)
    if not text:
        return "other"
    starts = np.array([s for s, _ in SCRIPT_STARTS])
    block = np.searchsorted(starts, np.frombuffer(text.encode("utf-32-le"), dtype="<u4"), side="right") - 1
    counts: dict[str, int] = {}
    for i, n in enumerate(np.bincount(block, minlength=len(starts)).tolist()):
        counts[SCRIPT_STARTS[i][1]] = counts.get(SCRIPT_STARTS[i][1], 0) + n
    return max(sorted(counts), key=counts.__getitem__)


def piece_cache(path: str) -> WordCache:
    """Words -> native (little-endian) int32 ids under the vocabulary at ``path``."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def make(words: list[bytes]) -> list[bytes]:
        texts = [w.decode("utf-8", "replace") for w in words]
        return [array("i", ids).tobytes() for ids in model.encode(texts, num_threads=1)]

    return WordCache(make, generation_words=150_000)


def repeated_window_words(words: list) -> int:
    """Words that lie in a 3-word window occurring at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number = dict(zip(dict.fromkeys(words), range(n)))
    ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=n)
    _, pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)
    _, windows, counts = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[windows] > 1)
    marked = np.zeros(n, dtype=bool)
    for step in range(3):
        marked[starts + step] = True
    return int(marked.sum())


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


def judge(text: bytes, words: list[bytes], lang: str | None, pieces: dict, languages: dict, scripts: dict) -> tuple:
    """The measures of one document, in the order of ``MEASURES``; ``pieces`` covers its words."""
    n = len(words)
    repeat = repeated_window_words(words)
    failed = n < MIN_WORDS or 100 * repeat > 50 * n
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    if not n:
        return 0, 0, symbols, 0, 0, True, 0, None, None, None, None, None, False
    chars = len(text.translate(None, NOT_COUNTED))
    counts = np.bincount(np.frombuffer(b"".join(map(pieces.__getitem__, words)), dtype="<i4"), minlength=FALLBACK_IDS[1] + 1)
    total, byte_pieces = int(counts.sum()), int(counts[FALLBACK_IDS[0]:FALLBACK_IDS[1] + 1].sum())
    share = counts[counts > 0] / max(total, 1)
    entropy = float(-(share * np.log2(share)).sum()) + 0.0
    evenness = entropy / float(np.log2(max(2, min(total, EVEN_TOKENS))))
    name = lang if lang in languages else main_script(words)
    band = languages.get(name) or scripts.get(name) or scripts["other"]
    per_token, byte_share = chars / max(total, 1), byte_pieces / max(total, 1)
    good = (band.min_chars_per_token <= per_token <= band.max_chars_per_token
            and byte_share <= band.max_byte_share and evenness >= band.min_evenness)
    return (n, chars, symbols, duplicate_lines(text), repeat, failed,
            total, per_token, byte_share, entropy, evenness, name, good and not failed)


def measure(docs: DataFrame, vocabulary: str, text_col: str = "text", lang_col: str | None = "lang",
            languages: dict[str, Band] | None = None, scripts: dict[str, Band] | None = None,
            into: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``into`` of the measures and the verdict ``kept``.

    ``vocabulary`` is the path of a subword model with byte fallback that comes
    with a package installed on every executor.
    """
    languages = LANGUAGE_BANDS if languages is None else languages
    scripts = SCRIPT_BANDS if scripts is None else scripts
    kinds = arrow_schema(MEASURES)

    @F.arrow_udf(MEASURES)
    def judged(text: pa.Array, lang: pa.Array) -> pa.Array:
        cache = cache_for("pieces", vocabulary, piece_cache)
        rows = []
        for langs, texts in text_chunks([pa.RecordBatch.from_arrays([lang, text], names=["lang", "text"])]):
            words = [t.split() for t in texts]
            pieces = cache.table(words)
            rows += [judge(t, w, lg, pieces, languages, scripts) for t, w, lg in zip(texts, words, langs)]
        columns = list(zip(*rows)) or [()] * len(kinds)
        give_back()
        return pa.StructArray.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, kinds)], fields=list(kinds))

    lang = F.col(lang_col).cast("string") if lang_col and lang_col in docs.columns else F.lit(None).cast("string")
    return docs.withColumn(into, judged(clean_text(text_col).cast("binary"), lang))


def keep_good(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the same columns."""
    into = fresh_name(docs.columns, "quality")
    return measure(docs, vocabulary, into=into, **options).where(F.col(f"{into}.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
