"""Alignment against both libraries and sets of byte offsets."""

import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as entry
from quarry.llm import alignment

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

ODD = [None, "", " ", "x", "a <|endoftext|> b </s> <s> <0x41>", "one ▁ two", "tab\tline\n\n\r\n  end  ", "é é ﬁ ½ Ⅷ 　 🎉🎉 \u0000\u0007",
       "don't DON'T 1234567 12,345.67!!!???...", "a" * 5000, " " * 9000 + "x", "数据 данные δεδομένα", "word " * 3000, "﻿​­ "]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    stays = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = [b for b in range(256) if b not in stays]
    back = {chr(b): b for b in stays} | {chr(256 + k): b for k, b in enumerate(moved)}
    names = {i: n for n, i in json.load(open(A, encoding="utf-8"))["model"]["vocab"].items()}
    return a, (lambda i: bytes(back[c] for c in names[i])), sentencepiece.SentencePieceProcessor(model_file=B)


def plain(libraries, text):
    """Groups of (A ids, B ids), or none."""
    a, bytes_a, b = libraries
    if not text:
        return []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    pieces = [b.id_to_piece(i) for i in ids_b]
    parts_a = [bytes_a(i) for i in ids_a]
    parts_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in pieces]
    if not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
        return []

    def ends(parts):
        out, at = [], 0
        for p in parts:
            at += len(p)
            out.append(at)
        return out

    ends_a, ends_b = ends(parts_a), ends(parts_b)
    common, groups, i, j = sorted(set(ends_a) & set(ends_b)), [], 0, 0
    for c in common:
        p, q = ends_a.index(c) + 1, ends_b.index(c) + 1
        groups.append((ids_a[i:p], ids_b[j:q]))
        i, j = p, q
    return groups


def expected(libraries, docs):
    groups = [plain(libraries, t) for _, t in docs]
    links = [[(a[-1], b[-1]) for a, b in g] for g in groups]
    counts = Counter(p for each in links for p in each)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for (i, _), g, own in zip(docs, groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(own), sum(counts[p] == most[p[1]] for p in own),
                    sum(counts[p] for p in own), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


@pytest.mark.parametrize("links", [None, 50])
def test_texts_against_the_libraries(spark, docs_frame, libraries, monkeypatch, links):
    if links:                                         # long texts cut over many dictionaries
        monkeypatch.setattr(alignment, "CHUNK_LINKS", links)
        monkeypatch.setattr(alignment, "TEXT_CHUNK", 3000)
    rng = random.Random(1)
    words = ["the", "of", "naïve", "tokeniser's", "x1", "...", "\n", "Überfluss", "東京", "  ", "-", "🎈"]
    docs = [(k, t) for k, t in enumerate(ODD)] + [(None, "the of the"), (3, "the of the"), (3, "the of the")]
    docs += [(100 + k, rng.choice([" ", ""]).join(rng.choice(words) for _ in range(rng.randint(1, 80)))) for k in range(60)]
    df = alignment.align(docs_frame(docs, extra=("row", "chunk", "links")).repartition(3), A, B)
    assert sorted([(r.doc_id, *(r[c] for c in COUNTS)) for r in df.collect()], key=str) == expected(libraries, docs)


def test_very_long_runs(libraries):
    for text in (" " * 1_000_000, "\n" * 200_000 + "x", "a" * 300_000):
        ((_, of_a, of_b, cut_a, cut_b),) = alignment.aligned([text], A, B)
        _, _, len_a, len_b = alignment.vocabularies(A, B)
        assert len_a[of_a].sum() == len_b[of_b].sum() == len(text) + 1
        common = np.intersect1d(len_a[of_a].cumsum(), len_b[of_b].cumsum())
        assert (len_a[of_a].cumsum()[cut_a] == common).all() and (len_b[of_b].cumsum()[cut_b] == common).all()
    short = " " * 5000 + "x" + "\n" * 4500                    # one library or the other, the same ids
    assert alignment.ByteLevel(A).encode(short) == libraries[0].encode(short, add_special_tokens=False).ids


def test_galloping_intersection():
    rng = np.random.default_rng(1)
    for n, m, top in ((0, 5, 9), (1, 1, 2), (3, 4000, 5000), (900, 40, 2000), (700, 800, 900), (64, 64, 64)):
        for _ in range(20):
            a, b = np.unique(rng.integers(1, top + 1, n)), np.unique(rng.integers(1, top + 1, m))
            i, j = alignment.common_ends(a, b)
            want = np.intersect1d(a, b)
            assert a[i].tolist() == want.tolist() == b[j].tolist()
    i, j = alignment.common_ends(np.array([1, 3, 3, 7]), np.array([3, 5, 7, 7]))
    assert i.tolist() == [2, 3] and j.tolist() == [0, 3]


def test_overlap_ranges(docs_frame, libraries):
    (row,) = alignment.token_groups(docs_frame([(1, "untokenisable überfluss 1234567")]), A, B).collect()
    _, _, len_a, len_b = alignment.vocabularies(A, B)
    end_a, end_b = len_a[row.ids_a].cumsum(), len_b[row.ids_b].cumsum()
    for k, (first, many) in enumerate(zip(row.first_b, row.n_b)):
        low, high = (end_a[k - 1] if k else 0), end_a[k]
        touching = [j for j in range(len(end_b)) if (end_b[j - 1] if j else 0) < high and end_b[j] > low]
        assert touching == list(range(first, first + many))
    assert sum(row.n_b) == alignment.align(docs_frame([(1, "untokenisable überfluss 1234567")]), A, B).first().n_overlaps


def test_empty_table(docs_frame):
    assert alignment.align(docs_frame([]), A, B).collect() == []
    assert alignment.token_groups(docs_frame([(1, None)]), A, B).first().ids_a == []


def test_query(spark, libraries):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = entry.queries()["op13_alignment"](spark, SF).collect()
    assert sorted([(r.doc_id, *(r[c] for c in COUNTS)) for r in rows], key=str) == expected(libraries, docs)
