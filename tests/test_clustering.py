"""Postings, scores, vectors, sampling, k-means and cluster summaries."""

import os
import random

import pytest

from quarry.fixed import KMEANS_ETA, KMEANS_KERNELS, KMEANS_MAX_ITERATIONS, LANG_SPREAD, LANGUAGES
from quarry.functions import geometry
from quarry.operators import clusters, kmeans as km, qa, scoreindex
from quarry.sources.postings import POSTING_SCHEMA


def postings(spark, rows):
    return spark.createDataFrame(rows, POSTING_SCHEMA)


def q(id_, tags, score=0):
    return (1, id_, None, None, score, tags)


def a(id_, parent, score):
    return (2, id_, None, parent, score, None)


def vecs(spark, pts):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "id long, x int, y int")


def test_parameters_of_the_original_suite():
    p = km.ClusterParams(
        keywords=LANGUAGES, spread=LANG_SPREAD, kernels=KMEANS_KERNELS, eta=KMEANS_ETA,
        max_iterations=KMEANS_MAX_ITERATIONS,
    )
    assert (len(p.keywords), p.spread, p.kernels, p.eta, p.max_iterations) == (15, 50000, 45, 20.0, 120)
    assert p.per_keyword == 3 and p.stratified


def test_bad_parameters():
    with pytest.raises(ValueError):
        km.ClusterParams(spread=0)
    with pytest.raises(ValueError):
        km.ClusterParams(keywords=["a", "b"], kernels=3).per_keyword


def test_pairs_drop_unanswered_and_orphans(spark):
    df = postings(spark, [q(1, "Java"), q(2, "Scala"), a(10, 1, 5), a(11, 1, 7), a(12, 99, 3), (2, 13, None, None, 1, None)])
    rows = sorted((r["question_id"], r["answer_id"]) for r in qa.question_answer_pairs(df).collect())
    assert rows == [(1, 10), (1, 11)]


def test_high_score_all_negative_is_zero(spark):
    df = postings(spark, [q(1, "Java"), a(10, 1, -5), a(11, 1, -2), q(2, "Scala"), a(12, 2, 4), a(13, 2, 9)])
    rows = sorted((r["id"], r["high_score"]) for r in qa.high_scores(df).collect())
    assert rows == [(1, 0), (2, 9)]


def test_duplicate_question_keeps_least_tags_and_score(spark):
    df = postings(spark, [q(1, "Scala", 3), q(1, "Java", 9), q(1, "Java", 2), a(10, 1, 4)])
    rows = [tuple(r) for r in qa.high_scores(df).collect()]
    assert rows == [(1, "Java", 2, 4)]


def test_vectors_use_whole_tag_equality(spark):
    scored = spark.createDataFrame(
        [(1, "Java", 5), (2, "JavaScript", 6), (3, "Haskell", 1), (4, None, 2), (5, "Cobol", 3)],
        "id long, tags string, high_score int",
    )
    rows = sorted(tuple(r) for r in qa.vectors(scored, ["JavaScript", "Java", "Haskell"], 100).collect())
    assert rows == [(1, 100, 5), (2, 0, 6), (3, 200, 1)]


def test_equidistant_point_goes_to_lowest_index(spark):
    df = vecs(spark, [(5, 0)])
    means = [(0, 0), (10, 0), (5, 0)]
    assert km.assign_clusters(df, [(0, 0), (10, 0)]).first()["cluster"] == 0
    assert km.assign_clusters(df, [(10, 0), (0, 0)]).first()["cluster"] == 0
    assert km.assign_clusters(df, means).first()["cluster"] == 2


@pytest.mark.parametrize("k", [1, 5, 400])
def test_nearest_mean_has_one_form_for_every_k(spark, k):
    pts = [(x, y) for x in range(0, 300, 50) for y in range(-40, 41, 20)]
    means = [((i * 37) % 300, (i * 11) % 80 - 40) for i in range(k)]
    df = vecs(spark, pts)
    got = [r["cluster"] for r in km.assign_clusters(df, means).orderBy("id").collect()]
    far = [[geometry.point_distance(p, m) for m in means] for p in pts]
    assert got == [d.index(min(d)) for d in far]
    assert "array_min" in geometry.nearest_sql("x", "y", means)


@pytest.mark.parametrize("k", [1, 5, 60])
def test_nearest_mean_on_lines_is_a_binary_search(spark, k):
    lines = list(range(0, 300, 50))
    pts = [(x, y) for x in lines for y in range(-60, 61, 3)]
    means = [((i * 37) % 300, (i * 11) % 80 - 40) for i in range(k)]
    df = vecs(spark, pts)
    got = [r["cluster"] for r in km.assign_clusters(df, means, lines=lines).orderBy("id").collect()]
    far = [[geometry.point_distance(p, m) for m in means] for p in pts]
    assert got == [d.index(min(d)) for d in far]
    sql = geometry.nearest_sql("x", "y", means, lines)
    assert "->" not in sql and sql.count("if(") <= len(lines) * (k - 1)
    deepest = max(len(part) - len(part.lstrip("if(")) for part in sql.split("THEN "))
    assert deepest <= 3 * max(1, (k - 1).bit_length())
    with pytest.raises(Exception, match="no line at x = 7"):
        km.assign_clusters(vecs(spark, [(7, 1)]), means, lines=lines).collect()


def test_steps_of_the_lower_envelope():
    rng = random.Random(3)
    for _ in range(3000):
        reach = rng.choice([2, 8, 50])
        means = [(rng.randint(-reach, reach), rng.randint(-reach, reach)) for _ in range(rng.randint(1, 9))]
        x = rng.randint(-reach, reach)
        found = geometry.steps(x, means)
        assert found[0][0] is None and len(found) <= len(means)
        for y in range(-2 * reach, 2 * reach + 1):
            d = [(x - a) ** 2 + (y - b) ** 2 for a, b in means]
            assert [i for since, i in found if since is None or since <= y][-1] == d.index(min(d))
    far = 2 ** 40                                    # exact where doubles are not
    assert geometry.steps(0, [(0, far), (0, far + 1)]) == [(None, 0), (far + 1, 1)]


@pytest.mark.parametrize("reach, fan_kept, read", [(900, 1024, 256), (3_000_000, 1024, 256), (2 ** 33, 2, 3)])
def test_score_index_counts_below_any_end(spark, monkeypatch, reach, fan_kept, read):
    """One, two and four levels; few nodes kept and read at a time."""
    monkeypatch.setattr(scoreindex, "NODES_KEPT", fan_kept)
    monkeypatch.setattr(scoreindex, "NODES_READ", read)
    rng = random.Random(5)
    pts = [(rng.choice([0, 50, 100]), rng.randint(-reach, reach), rng.randint(1, 5)) for _ in range(400)] + [(50, 0, 3)] * 2
    index = scoreindex.ScoreIndex(spark.createDataFrame(pts, "x int, y long, w long"))
    assert index.lines == [0, 50, 100]
    ends = [(rng.choice([0, 50, 100, 7]), rng.choice([rng.randint(-reach - 9, reach + 9), rng.choice(pts)[1], rng.choice(pts)[1] + 1])) for _ in range(60)]
    for _ in range(2):                               # again, from the nodes that are kept
        got = index.below(ends)
        for x, y in ends:
            under = [(w, w * s) for p, s, w in pts if p == x and s < y]
            assert got[x, y] == (sum(w for w, _ in under), sum(s for _, s in under))
    assert index.total(50) == (sum(w for x, _, w in pts if x == 50), sum(w * y for x, y, w in pts if x == 50))
    assert len(index._nodes) <= fan_kept


def test_kmeans_over_no_points(spark):
    empty = spark.createDataFrame([], "x int, y int, w long")
    assert km.kmeans_pass(empty, [(0, 1), (5, 6)]) == [(0, 1), (5, 6)]


def test_empty_cluster_keeps_its_mean(spark):
    points = km.weighted_points(vecs(spark, [(0, 1), (0, 3), (0, 6)]))
    new = km.kmeans_pass(points, [(0, 0), (1000, 1000)])
    assert new == [(0, 3), (1000, 1000)]


def test_integer_mean_truncates_toward_zero(spark):
    points = km.weighted_points(vecs(spark, [(0, -1), (0, -2), (0, -4)]))
    assert km.kmeans_pass(points, [(0, 0)]) == [(0, -2)]    # -7 div 3 = -2


def test_kmeans_stops_below_eta_and_at_max(spark):
    points = km.weighted_points(vecs(spark, [(0, 0), (0, 10), (100, 0), (100, 10)]))
    p = km.ClusterParams(keywords=["a"], spread=100, kernels=2, eta=1.0, max_iterations=10)
    res = km.kmeans(points, [(0, 0), (100, 0)], p)
    assert res.means == [(0, 5), (100, 5)] and res.converged and res.passes == 2
    p0 = km.ClusterParams(keywords=["a"], spread=100, kernels=2, eta=0.0, max_iterations=3)
    res0 = km.kmeans(points, [(0, 0), (100, 0)], p0)
    assert res0.passes == 3 and not res0.converged
    assert [h[0] for h in res0.history] == [1, 1, 2, 2, 3, 3]
    assert res0.history[0][6:] == (25.0, 50.0)


def test_stratified_sample_checks_strata(spark):
    v = vecs(spark, [(0, 1), (0, 2), (0, 3), (100, 4)])
    p = km.ClusterParams(keywords=["a", "b"], spread=100 * 5, kernels=4)
    v5 = vecs(spark, [(0, 1), (0, 2), (0, 3), (500, 4)])
    with pytest.raises(ValueError):
        km.initial_means(v5, p)                        # stratum of x=500 is short
    p2 = km.ClusterParams(keywords=["a", "b"], spread=500, kernels=2)
    means = km.initial_means(vecs(spark, [(0, 1), (0, 2), (500, 3)]), p2)
    assert [m[0] for m in means] == [0, 500]
    assert v.count() == 4


def test_simple_sample_size(spark):
    v = vecs(spark, [(0, i) for i in range(20)])
    p = km.ClusterParams(keywords=["a"], spread=100, kernels=5)
    assert not p.stratified
    rows = km.simple_sample(v, p).collect()
    assert len(rows) == 5 and sorted(r["rank"] for r in rows) == [1, 2, 3, 4, 5]
    assert len(km.initial_means(v, p)) == 5


@pytest.mark.parametrize("scores, median", [([1, 2], 1), ([1, 2, 9], 2), ([-1, -2], -1), ([-1, -2, -4, -8], -3)])
def test_median(spark, scores, median):
    points = km.weighted_points(vecs(spark, [(0, s) for s in scores]))
    p = km.ClusterParams(keywords=["Java"], spread=100, kernels=1)
    row = clusters.cluster_summary(points, [(0, 0)], p).first()
    assert row["median_score"] == median and row["cluster_size"] == len(scores)


def test_cluster_summary_dominance_and_percent(spark):
    pts = [(0, 1), (0, 2), (100, 3), (100, 4), (100, 5), (200, 100)]
    p = km.ClusterParams(keywords=["A", "B", "C"], spread=100, kernels=3)
    summary = clusters.cluster_summary(km.weighted_points(vecs(spark, pts)), [(100, 3), (200, 100)], p)
    rows = [tuple(r) for r in summary.collect()]
    assert summary.columns == clusters.CLUSTER_SUMMARY_COLUMNS
    assert rows == [("B", 60.0, 0.0, 5, 3), ("C", 100.0, 100.0, 1, 100)]


def test_dominance_tie_takes_earliest_keyword(spark):
    pts = [(100, 1), (0, 2)]
    p = km.ClusterParams(keywords=["A", "B"], spread=100, kernels=2)
    row = clusters.cluster_summary(km.weighted_points(vecs(spark, pts)), [(50, 0)], p).first()
    assert row["lang_label"] == "A" and row["lang_percent"] == 50.0


def test_report_line_format(spark):
    summary = spark.createDataFrame(
        [("Java", 100.0, 100.0, 1234, -12)],
        "lang_label string, lang_percent double, lang_percent_int double, cluster_size long, median_score int",
    )
    line = clusters.cluster_report(summary).first()["line"]
    assert line == "    -12  Java              (100.0%)         1234"


def test_trace_frame(spark):
    points = km.weighted_points(vecs(spark, [(0, 0), (0, 10), (100, 0), (100, 10)]))
    p = km.ClusterParams(keywords=["a"], spread=100, kernels=2, eta=0.0, max_iterations=1)
    rows = [tuple(r) for r in km.kmeans(points, [(0, 0), (100, 0)], p).trace_frame(spark).collect()]
    assert rows == [(1, 0, 0, 0, 0, 5, 25.0, 50.0), (1, 1, 100, 0, 100, 5, 25.0, 50.0)]


def test_points_are_released_when_sampling_fails(spark):
    p = km.ClusterParams(keywords=["a", "b"], spread=500, kernels=4)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with pytest.raises(ValueError):
        km.cluster(vecs(spark, [(0, 1), (0, 2), (500, 3)]), p)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_stratified_sample_equals_plain_ranking(spark):
    v = vecs(spark, [((i % 2) * 500, i) for i in range(2000)])
    for per in (3, 700):
        p = km.ClusterParams(keywords=["a", "b"], spread=500, kernels=2 * per)
        v.createOrReplaceTempView("sampled_vectors")
        want = spark.sql(f"""SELECT id, x, y, rank FROM (SELECT *, row_number() OVER (PARTITION BY x
            ORDER BY md5(concat('42', cast(id AS string))), id) AS rank FROM sampled_vectors) WHERE rank <= {per}""")
        assert sorted(map(tuple, km.stratified_sample(v, p).collect())) == sorted(map(tuple, want.collect()))


def test_medians_over_many_blocks(spark):
    rng = random.Random(1)
    scores = [(c, rng.randint(-5000, 5000), rng.randint(1, 4)) for c in range(3) for _ in range(301 + c)]
    frame = spark.createDataFrame(scores, "cluster int, y int, w long")
    sizes = frame.groupBy("cluster").agg({"w": "sum"}).withColumnRenamed("sum(w)", "cluster_size")
    got = {r.cluster: r["median"] for r in clusters.weighted_medians(frame, sizes).collect()}
    for c in range(3):
        each = sorted(y for k, y, w in scores if k == c for _ in range(w))
        assert got[c] == (each[(len(each) - 1) // 2] + each[len(each) // 2]) / 2


def test_broken_off_loop_goes_on(spark, tmp_dir, monkeypatch):
    """A driver that dies in the middle of the passes: the next run takes tables, means and trace from the folder."""
    rows = [(i, (i % 2) * 500, (i * i * 31) % 997) for i in range(3000)]
    vecs = spark.createDataFrame(rows, "id long, x int, y int")
    params = km.ClusterParams(keywords=["a", "b"], spread=500, kernels=8, eta=2.0, max_iterations=60)
    want, _ = km.cluster(vecs, params)
    assert want.converged and want.passes > 4
    folder, passes = tmp_dir + "/run", []
    plain = km.kmeans_pass

    def dying(index, means):
        if len(passes) == 3:
            raise KeyboardInterrupt
        passes.append(means)
        return plain(index, means)

    monkeypatch.setattr(km, "kmeans_pass", dying)
    with pytest.raises(KeyboardInterrupt):
        km.cluster(vecs, params, state_folder=folder)
    seen = []
    monkeypatch.setattr(km, "kmeans_pass", lambda index, means: seen.append(means) or plain(index, means))
    lost = spark.createDataFrame([], vecs.schema)                          # the tables in the folder are complete
    got, points = km.cluster(lost, params, state_folder=folder)
    assert (got.means, got.passes, got.converged, got.history) == (want.means, want.passes, True, want.history)
    assert len(seen) == want.passes - 3 and points.agg({"w": "sum"}).first()[0] == 3000
    again, _ = km.cluster(lost, params, state_folder=folder)               # a finished run is only read
    assert again.history == want.history and len(seen) == want.passes - 3
    with pytest.raises(ValueError, match="other parameters"):
        km.cluster(vecs, km.ClusterParams(keywords=["a", "b"], spread=500, kernels=6), state_folder=folder)


def test_half_written_table_is_made_again(spark, tmp_dir):
    state = km.LoopState(spark, tmp_dir + "/s", km.ClusterParams())
    spark.range(5).write.parquet(tmp_dir + "/s/vectors")
    os.remove(tmp_dir + "/s/vectors/_SUCCESS")
    assert state.table("vectors", lambda: spark.range(9)).count() == 9
    assert state.table("vectors", lambda: spark.range(2)).count() == 9
