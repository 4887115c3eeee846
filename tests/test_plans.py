"""Plan-shape checks for the properties that matter at scale.

Each test inspects the physical plan: column pruning at the scan, partial
aggregation before every shuffle, bounded per-task sampling, no static
broadcast, and parse expressions that are not re-inlined into filters.
"""

from quarry.operators import keywords as kw
from quarry.operators import kmeans as km
from quarry.operators import qa
from quarry.plans import catalog
from quarry.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keyword_rank_prunes_and_combines(spark):
    p = plan(kw.rank_combined(fx.articles(spark, SF), fx.ARTICLE_KEYWORDS))
    assert "ReadSchema: struct<text:string>" in p
    assert "partial_count" in p
    # the partial count sits below the only exchange
    assert p.index("Exchange") < p.index("partial_count")


def test_scan_ranking_is_one_scan(spark):
    p = plan(kw.rank_by_scan(fx.articles(spark, SF), fx.ARTICLE_KEYWORDS))
    assert p.count("Scan parquet") == 1
    assert "partial_count_if" in p or "partial_count" in p


def test_high_scores_aggregate_answers_by_hash(spark):
    p = plan(catalog.question_high_scores(spark, SF))
    answers = next(line for line in p.splitlines() if "partial_max" in line)
    assert "HashAggregate" in answers
    assert p.count("Exchange hashpartitioning") == 2     # one for each side, none for the join


def test_pairs_use_no_static_broadcast(spark):
    p = plan(catalog.question_answer_pairs(spark, SF))
    assert "BroadcastExchange" not in p     # static broadcast is off; AQE decides on measured sizes
    assert "SortMergeJoin" in p


def test_parse_is_not_reinlined_into_filters(spark):
    p = plan(catalog.question_answer_pairs(spark, SF))
    assert "Generate inline" in p
    for line in p.splitlines():
        if "Filter" in line:
            assert "split(" not in line, line


def test_stratified_sample_ranks_parts_first_at_every_size(spark):
    vecs = catalog._vectors(spark, SF, fx.CLUSTER_SPREAD)
    for per in (3, 5000):
        p = plan(km.stratified_sample(vecs, fx.cluster_params(kernels=per * len(fx.CLUSTER_KEYWORDS))))
        spread = [line for line in p.splitlines() if "Exchange hashpartitioning(x" in line]
        assert any("part#" in line for line in spread) and len(spread) == 2


def test_simple_sample_is_top_k(spark):
    vecs = catalog._vectors(spark, SF, fx.SIMPLE_SAMPLE_SPREAD)
    p = plan(km.simple_sample(vecs, fx.cluster_params(spread=fx.SIMPLE_SAMPLE_SPREAD)))
    assert "TakeOrderedAndProject" in p


def test_kmeans_pass_aggregates_partially(spark):
    vecs = spark.createDataFrame([(i, (i % 3) * 100, i) for i in range(30)], "id long, x int, y int")
    points = km.weighted_points(vecs)
    assigned = km.assign_clusters(points, [(0, 0), (100, 10), (200, 20)], "idx")
    p = plan(assigned.groupBy("idx").agg({"w": "sum"}))
    assert "partial_sum" in p


def test_vectors_drop_unlisted_tags(spark):
    scored = qa.high_scores(catalog.parsed_postings(spark, SF))
    p = plan(qa.vectors(scored, fx.CLUSTER_KEYWORDS, fx.CLUSTER_SPREAD))
    assert "array_position" in p
