"""Quality rules against a plain re-implementation of the base counts, and the fertility verdict."""

import re

import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__ as entry
from quarry.llm import quality

PATH = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 600 else _twice(windows)
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def _twice(windows):
    from collections import Counter

    return {w for w, c in Counter(windows).items() if c > 1}


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_query_counts_match_plain_code(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = entry.queries()["op7_quality"](spark, sf).collect()
    assert len(rows) == 200
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == plain(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


EDGES = ["", None, " \n\t", "a b a b a b a b", "x" * 70000, "a\x85b   c d", "one\n\none\n one\none",
         "# $ | <> &&& a*b%", "a b c " * 40000, "word\x1cword \x0bvt\x0cff"]


@pytest.mark.parametrize("text", EDGES)
def test_edge_texts(text, docs_frame):
    docs = docs_frame([(1, text), (1, text), (None, text)], extra=("quality_", "n_words"))
    rows = quality.measure(docs, PATH).collect()
    assert len(rows) == 3 and len({r.quality for r in rows}) == 1
    assert tuple(rows[0].quality[c] for c in COLUMNS) == plain(text)


def test_fertility_is_that_of_the_vocabulary():
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    text = "The quick brown fox ☃\U0001F600 jumps"
    words = text.encode().split()
    pieces = quality.piece_cache(PATH).table([words])
    row = quality.judge(text.encode(), words, "en", pieces, quality.LANGUAGE_BANDS, quality.SCRIPT_BANDS)
    ids = [i for w in text.split() for i in model.encode(w)]
    assert row[6] == len(ids)
    assert row[8] == sum(model.is_byte(i) for i in ids) / len(ids)


def test_scripts():
    assert quality.main_script(["привет".encode(), b"abc"]) == "cyrillic"
    assert quality.main_script([b"123"]) == "other"
    assert quality.main_script(["漢字".encode()]) == "han"


def test_keeps_clean_and_rejects_junk(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("quality", "good")
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(labels, "doc_id")
    rows = [r for r in quality.measure(docs, PATH).select("good", "quality.*").collect() if not r.base_failed]
    kept = {good: [r.kept for r in rows if r.good == good] for good in (0, 1)}
    assert sum(kept[1]) > 0.97 * len(kept[1])
    assert sum(kept[0]) < 0.25 * len(kept[0])


def test_keep_good_keeps_the_columns(spark, docs_frame):
    docs = docs_frame([(1, "too short")], extra=("quality",))
    assert quality.keep_good(docs, PATH).columns == docs.columns
    assert quality.keep_good(docs, PATH).collect() == []
    assert quality.keep_good(docs_frame([]), PATH).collect() == []
