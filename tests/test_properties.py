"""Property tests: Spark operators against brute-force Python versions of the
original semantics, on random small inputs."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.operators import clusters
from quarry.operators import keywords as kw
from quarry.operators import kmeans as km
from quarry.sources.postings import parse_posting_lines
from quarry.sources.text import articles_from_rows

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

WORDS = ["Java", "Scala", "java", "Java,", "JavaScript", "", "C++", "x"]
SEPS = [" ", "  ", "\n", ",", " \n"]


@st.composite
def texts(draw):
    parts = draw(st.lists(st.sampled_from(WORDS), min_size=0, max_size=8))
    seps = draw(st.lists(st.sampled_from(SEPS), min_size=len(parts), max_size=len(parts)))
    return "".join(p + s for p, s in zip(parts, seps))


def java_split(s: str, sep: str) -> list[str]:
    """String.split with a literal one-character pattern: trailing empties dropped."""
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@SETTINGS
@given(st.lists(texts(), min_size=1, max_size=6))
def test_rankings_match_token_semantics(spark, docs):
    langs = ["Java", "Scala", "C++", "Perl"]
    arts = articles_from_rows(spark, [(str(i), t) for i, t in enumerate(docs)])
    expected = {k: sum(1 for t in docs if k in t.split(" ")) for k in langs}
    scan = dict(kw.ranking_list(kw.rank_by_scan(arts, langs)))
    combined = dict(kw.ranking_list(kw.rank_combined(arts, langs)))
    assert scan == expected
    assert combined == {k: n for k, n in expected.items() if n > 0}


@st.composite
def posting_lines(draw):
    t = draw(st.sampled_from(["1", "2"]))
    pid = str(draw(st.integers(0, 10**6)))
    acc = draw(st.sampled_from(["", "7"]))
    par = draw(st.sampled_from(["", "3"]))
    score = str(draw(st.integers(-50, 50)))
    tail = draw(st.sampled_from(["", ",", ",Java", ",,x", ",Java,,", ",C#,extra"]))
    return ",".join([t, pid, acc, par, score]) + tail


@SETTINGS
@given(st.lists(posting_lines(), min_size=1, max_size=8))
def test_posting_parse_matches_java_split(spark, lines):
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = [tuple(r) for r in parse_posting_lines(df).collect()]
    expected = []
    for line in lines:
        arr = java_split(line, ",")
        expected.append((
            int(arr[0]), int(arr[1]),
            None if arr[2] == "" else int(arr[2]),
            None if arr[3] == "" else int(arr[3]),
            int(arr[4]),
            arr[5] if len(arr) >= 6 else None,
        ))
    assert got == expected


def trunc_div(a, b):
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


@SETTINGS
@given(
    st.lists(st.tuples(st.sampled_from([0, 100, 200]), st.integers(-30, 30)), min_size=1, max_size=25),
    st.lists(st.tuples(st.sampled_from([0, 100, 200]), st.integers(-30, 30)), min_size=1, max_size=5),
)
def test_kmeans_pass_matches_brute_force(spark, pts, means):
    vecs = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "id long, x int, y int")
    got = km.kmeans_pass(km.weighted_points(vecs), means)
    # the original loop: closest by strict '<', integer means, empty clusters keep their mean
    groups = {}
    for p in pts:
        best, closest = 0, math.inf
        for i, m in enumerate(means):
            d = float(p[0] - m[0]) ** 2 + float(p[1] - m[1]) ** 2
            if d < closest:
                best, closest = i, d
        groups.setdefault(best, []).append(p)
    expected = list(means)
    for i, ps in groups.items():
        expected[i] = (trunc_div(sum(p[0] for p in ps), len(ps)), trunc_div(sum(p[1] for p in ps), len(ps)))
    assert got == expected


@SETTINGS
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=15))
def test_median_matches_original_rule(spark, scores):
    vecs = spark.createDataFrame([(i, 0, s) for i, s in enumerate(scores)], "id long, x int, y int")
    p = km.ClusterParams(keywords=["Java"], spread=100, kernels=1)
    row = clusters.cluster_summary(km.weighted_points(vecs), [(0, 0)], p).first()
    s = sorted(scores)
    lower, upper = s[: len(s) // 2], s[len(s) // 2:]
    expected = trunc_div(lower[-1] + upper[0], 2) if len(s) % 2 == 0 else upper[0]
    assert row["median_score"] == expected


@SETTINGS
@given(st.lists(
    st.tuples(st.sampled_from([0.0, 1.0, 2.0, 2.9, 3.0, 4.0, 5.0]), st.sampled_from([1.0, 2.0]),
              st.sampled_from([14.0, 15.0, 22.0, 22.5, 23.0, 55.0, 56.0, 70.0]),
              st.integers(0, 600), st.integers(0, 600), st.integers(0, 600)),
    min_size=1, max_size=12))
def test_diary_summary_matches_original_rules(spark, rows):
    from quarry.operators import diary as d

    names = ["tucaseid", "telfs", "tesex", "teage", "t010101", "t050101", "t020101"]
    data = [(str(i), t, s, a, float(p), float(w), float(o)) for i, (t, s, a, p, w, o) in enumerate(rows)]
    got = [tuple(r) for r in d.summary_from(spark.createDataFrame(data, "tucaseid string, " + ", ".join(f"{n} double" for n in names[1:]))).collect()]
    expected = []
    for _, t, s, a, p, w, o in data:
        if t > 4:
            continue
        working = "working" if 1 <= t < 3 else "not working"
        sex = "male" if s == 1 else "female"
        age = "young" if 15 <= a <= 22 else "active" if 23 <= a <= 55 else "elder"
        expected.append((working, sex, age, p / 60, w / 60, o / 60))
    assert got == expected


@SETTINGS
@given(st.lists(st.tuples(st.text(alphabet="ab <>/é\n", max_size=12), st.text(alphabet="ab <>/é\n,", max_size=30)),
                min_size=1, max_size=6))
def test_tagged_lines_round_trip(spark, pairs):
    from quarry.sources.text import parse_tagged_lines

    pairs = [(t, x) for t, x in pairs if "</title><text>" not in t]
    if not pairs:
        return
    lines = [(f"<page><title> {t}</title><text>{x}</text></page>  ",) for t, x in pairs]
    got = [tuple(r) for r in parse_tagged_lines(spark.createDataFrame(lines, "value string")).collect()]
    assert got == pairs
