"""Time diary: classification, bands, summaries, grouped forms."""

import pytest

from quarry.operators import diary as d

NAMES = ["tucaseid", "telfs", "tesex", "teage", "t010101", "t050101", "t020101"]


def table(spark, rows):
    return spark.createDataFrame(rows, "tucaseid string, " + ", ".join(f"{n} double" for n in NAMES[1:]))


def test_column_classes():
    names = ["t0101", "t1801", "t1803", "t1805", "t1806", "t17", "t50", "telfs"]
    assert [d.column_class(n) for n in names] == [
        "primary", "primary", "primary", "work", "other", None, None, None
    ]
    p, w, o = d.classify_columns(["t110101", "t050101", "t010101", "t180501", "t020101"])
    assert (p, w, o) == (["t110101", "t010101"], ["t050101", "t180501"], ["t020101"])


def test_column_hours(spark):
    rows = [("a", 1.0, 1.0, 20.0, 60.0, 30.0, 0.0), ("b", 5.0, 2.0, 30.0, 90.0, 30.0, None)]
    got = [tuple(r) for r in d.column_hours(NAMES, table(spark, rows)).collect()]
    assert got == [("t010101", "primary", 4, 2.5), ("t050101", "work", 5, 1.0), ("t020101", "other", 6, 0.0)]
    assert d.column_hours(["tucaseid", "telfs"], table(spark, rows)).collect() == []


def test_empty_group_raises(spark):
    df = table(spark, [("a", 1.0, 1.0, 20.0, 60.0, 60.0, 60.0)])
    with pytest.raises(ValueError):
        d.summary(["t010101"], [], ["t020101"], df)


def test_bands(spark):
    rows = []
    for i, telfs in enumerate([0.0, 1.0, 2.9, 3.0, 4.0, 5.0]):
        rows.append((f"w{i}", telfs, 1.0, 30.0, 60.0, 120.0, 30.0))
    for i, age in enumerate([14.0, 15.0, 22.0, 22.5, 23.0, 55.0, 56.0]):
        rows.append((f"a{i}", 1.0, 2.0, age, 0.0, 0.0, 0.0))
    summary = d.summary_from(table(spark, rows))
    got = [tuple(r) for r in summary.collect()]
    working = [g[0] for g in got[:5]]
    assert working == ["not working", "working", "working", "not working", "not working"]
    assert len(got) == 12                                # telfs 5 is dropped
    assert [g[2] for g in got[5:]] == ["elder", "young", "young", "elder", "active", "active", "elder"]
    assert got[1][1] == "male" and got[5][1] == "female"
    assert got[1][3:] == (1.0, 2.0, 0.5)


def test_grouped_forms_agree(spark):
    rows = [
        ("a", 1.0, 1.0, 30.0, 60.0, 120.0, 30.0),
        ("b", 1.0, 1.0, 40.0, 90.0, 60.0, 45.0),
        ("c", 4.0, 2.0, 16.0, 600.0, 0.0, 3.0),
    ]
    summary = d.summary_from(table(spark, rows))
    g1 = [tuple(r) for r in d.grouped(summary).collect()]
    g2 = [tuple(r) for r in d.grouped_sql(summary).collect()]
    g3 = [tuple(r) for r in d.grouped_typed(d.summary_typed(summary)).collect()]
    assert g1 == g2 == g3
    assert d.grouped(summary).columns == ["working", "sex", "age", "primaryNeeds", "work", "other"]
    assert g1 == [("not working", "female", "young", 10.0, 0.0, 0.1), ("working", "male", "active", 1.3, 1.5, 0.6)]


def test_round_half_up(spark):
    summary = spark.createDataFrame(
        [("working", "male", "young", 2.65, 0.25, 0.35)], d.SUMMARY_SCHEMA
    )
    row = d.grouped_typed(d.summary_typed(summary)).first()
    assert (row["primaryNeeds"], row["work"], row["other"]) == (2.7, 0.3, 0.4)


def test_typed_by_name_and_by_position(spark):
    df = spark.createDataFrame(
        [(1.0, "young", "male", "working", 2.0, 3.0)],
        "work double, age string, sex string, working string, primaryNeeds double, other double",
    )
    assert d.summary_typed(df).columns == ["working", "sex", "age", "primaryNeeds", "work", "other"]
    assert tuple(d.summary_typed(df).first()) == ("working", "male", "young", 2.0, 1.0, 3.0)
    pos = spark.createDataFrame([("working", "male", "young", 1.0, 2.0, 3.0)], "a string, b string, c string, d double, e double, f double")
    assert tuple(d.summary_typed_by_position(pos).first()) == ("working", "male", "young", 1.0, 2.0, 3.0)
