"""End-to-end pipelines from files."""

import os

from quarry import jobs
from quarry.operators import keywords as kw
from quarry.operators.kmeans import ClusterParams


def test_keyword_rankings_from_file(spark, tmp_dir):
    path = os.path.join(tmp_dir, "articles.txt")
    texts = ["Mixing Java with Scala works", "Old Java code lives long", "Haskell is lazy"]
    with open(path, "w") as f:
        for i, t in enumerate(texts):
            f.write(f"<page><title> {i}</title><text>{t}</text></page>  \n")
    r = jobs.keyword_rankings_from_file(spark, path, ["Java", "Scala", "Haskell", "Perl"])
    assert kw.ranking_list(r["scan"]) == [("Java", 2), ("Haskell", 1), ("Scala", 1), ("Perl", 0)]
    assert kw.ranking_list(r["index"]) == kw.ranking_list(r["combined"]) == [("Java", 2), ("Haskell", 1), ("Scala", 1)]


def test_cluster_postings_file(spark, tmp_dir):
    path = os.path.join(tmp_dir, "lines.txt")
    lines = []
    for qid in range(1, 41):
        lines.append(f"1,{qid},,,0,{'Java' if qid % 2 else 'Scala'}")
        lines.append(f"2,{1000 + qid},,{qid},{(qid * 7) % 23 - 5}")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    params = ClusterParams(keywords=["Java", "Scala"], spread=50000, kernels=4, eta=20.0, max_iterations=120)
    run = jobs.cluster_postings_file(spark, path, params)
    rows = run.summary.collect()
    assert sum(r["cluster_size"] for r in rows) == 40
    assert {r["lang_label"] for r in rows} == {"Java", "Scala"}
    assert all(r["lang_percent_int"] == 100.0 for r in rows)     # spread 50000 separates the keywords
    assert len(run.report.collect()) == len(rows)


def test_diary_forms(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "rows.csv"), "w") as f:
        f.write("tucaseid,telfs,tesex,teage,t010101,t050101,t020101\n")
        f.write("a,1,1,30,60,120,30\nb,1,1,40,90,60,45\nc,4,2,16,600,0,3\nd,5,1,30,1,1,1\n")
    out = jobs.diary_forms(spark, tmp_dir)
    assert out["summary"].count() == 3
    g = [tuple(r) for r in out["grouped"].collect()]
    assert g == [tuple(r) for r in out["grouped_sql"].collect()] == [tuple(r) for r in out["grouped_typed"].collect()]
    assert g == [("not working", "female", "young", 10.0, 0.0, 0.1), ("working", "male", "active", 1.3, 1.5, 0.6)]
