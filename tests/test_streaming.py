"""The keyword counts over a file stream equal the batch counts."""

import os

from quarry.operators import keywords as kw
from quarry.sources.text import articles_from_rows
from quarry.streaming import read_article_stream, start_keyword_counts


def test_stream_counts_match_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    batch1 = [("1", "Scala and Java"), ("2", "Java only")]
    batch2 = [("3", "Haskell and Java"), ("4", "Scala")]
    articles_from_rows(spark, batch1).write.parquet(os.path.join(src, "b1"))
    stream = read_article_stream(spark, os.path.join(src, "*"))
    query = start_keyword_counts(stream, ["Java", "Scala", "Haskell"], "kw_counts_test",
                                 checkpoint_location=os.path.join(tmp_dir, "ckpt"))
    try:
        query.processAllAvailable()
        first = {r["keyword"]: r["n_articles"] for r in spark.table("kw_counts_test").collect()}
        assert first == {"Java": 2, "Scala": 1}
        articles_from_rows(spark, batch2).write.parquet(os.path.join(src, "b2"))
        query.processAllAvailable()
        got = {r["keyword"]: r["n_articles"] for r in spark.table("kw_counts_test").collect()}
    finally:
        query.stop()
    batch = dict((r["keyword"], r["n_articles"]) for r in
                 kw.rank_combined(articles_from_rows(spark, batch1 + batch2), ["Java", "Scala", "Haskell"]).collect())
    assert got == batch == {"Java": 3, "Scala": 2, "Haskell": 1}


def test_tagged_line_stream(spark, tmp_dir):
    from quarry.streaming import read_tagged_line_stream

    src = os.path.join(tmp_dir, "lines")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("<page><title> 1</title><text>Scala and Java</text></page>  \n")
        f.write("<page><title> 2</title><text>Java</text></page>  \n")
    query = start_keyword_counts(read_tagged_line_stream(spark, src), ["Java", "Scala"], "kw_lines_test",
                                 checkpoint_location=os.path.join(tmp_dir, "ckpt"))
    try:
        query.processAllAvailable()
        got = {r["keyword"]: r["n_articles"] for r in spark.table("kw_lines_test").collect()}
    finally:
        query.stop()
    assert got == {"Java": 2, "Scala": 1}
