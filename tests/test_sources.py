"""Parsers: tagged lines, posting lines, diary CSV."""

import os

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from quarry.operators import diary, qa
from quarry.sources.diary import parse_diary_lines, read_diary, read_header
from quarry.sources.postings import parse_posting_lines, read_postings
from quarry.sources.text import parse_tagged_lines, read_articles

FAILURES = (PySparkException, Py4JJavaError)


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_tagged_line_round_trip(spark):
    line = "<page><title> My Title</title><text>Some text here</text></page>  "
    row = parse_tagged_lines(lines(spark, [line])).first()
    assert (row["title"], row["text"]) == ("My Title", "Some text here")


def test_tagged_line_with_empty_text(spark):
    line = "<page><title> T</title><text></text></page>  "
    row = parse_tagged_lines(lines(spark, [line])).first()
    assert (row["title"], row["text"]) == ("T", "")


def test_tagged_line_without_separator_fails(spark):
    with pytest.raises(FAILURES):
        parse_tagged_lines(lines(spark, ["<page><title> T no separator</page>  "])).collect()


def test_tagged_line_file_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "articles.txt")
    with open(path, "w") as f:
        f.write("<page><title> A</title><text>Java rocks</text></page>  \n")
        f.write("<page><title> B</title><text>Scala</text></page>  \n")
    rows = sorted(tuple(r) for r in read_articles(spark, path).collect())
    assert rows == [("A", "Java rocks"), ("B", "Scala")]


@pytest.mark.parametrize(
    "line, tag",
    [("1,5,,,3", None), ("1,5,,,3,", None), ("1,5,,,3,Java,x", "Java"), ("1,5,,,3,,x", ""), ("1,5,,,3,C#", "C#")],
)
def test_posting_tags(spark, line, tag):
    row = parse_posting_lines(lines(spark, [line])).first()
    assert (row["postingType"], row["id"], row["acceptedAnswer"], row["parentId"], row["score"]) == (1, 5, None, None, 3)
    assert row["tags"] == tag


def test_posting_answer_fields(spark):
    row = parse_posting_lines(lines(spark, ["2,27233496,,9002525,-1"])).first()
    assert tuple(row) == (2, 27233496, None, 9002525, -1, None)


@pytest.mark.parametrize("line", ["x,5,,,3", "1,5,,,", "1,,,,3", "1,5,,,3.5"])
def test_malformed_posting_fails(spark, line):
    with pytest.raises(FAILURES):
        parse_posting_lines(lines(spark, [line])).collect()


def test_posting_filter_does_not_hide_bad_fields(spark):
    # every field is parsed even when a later filter only uses postingType
    df = parse_posting_lines(lines(spark, ["1,5,,,3", "2,6,,x,4"]))
    with pytest.raises(FAILURES):
        df.where("postingType = 1").collect()


def test_posting_file_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "postings.csv")
    with open(path, "w") as f:
        f.write("1,27233496,,,0,C#\n2,23698767,,9002525,2\n")
    rows = [tuple(r) for r in read_postings(spark, path).orderBy("id").collect()]
    assert rows == [(2, 23698767, None, 9002525, 2, None), (1, 27233496, None, None, 0, "C#")]


def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_diary_read(spark, tmp_dir):
    write(os.path.join(tmp_dir, "part-0.csv"), "tucaseid,telfs,t010101\nA,1.0,60\nB,5,30.5\n")
    write(os.path.join(tmp_dir, "part-1.csv"), "tucaseid,telfs,t010101\nC,2,0\n")
    names, df = read_diary(spark, tmp_dir)
    assert names == ["tucaseid", "telfs", "t010101"]
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "double", "double"]
    assert sorted(tuple(r) for r in df.collect()) == [("A", 1.0, 60.0), ("B", 5.0, 30.5), ("C", 2.0, 0.0)]


@pytest.mark.parametrize("body", ["A,,60\n", "A,1\n", "A,1,2,3\n", "A,x,60\n"])
def test_diary_strict(spark, tmp_dir, body):
    write(os.path.join(tmp_dir, "d.csv"), "tucaseid,telfs,t010101\n" + body)
    _, df = read_diary(spark, tmp_dir)
    with pytest.raises(FAILURES):
        df.collect()


def test_diary_projection_still_checks_all_columns(spark, tmp_dir):
    write(os.path.join(tmp_dir, "d.csv"), "tucaseid,telfs,t010101\nA,1,\n")
    _, df = read_diary(spark, tmp_dir)
    with pytest.raises(FAILURES):
        df.select("telfs").collect()


def test_wide_diary(spark, tmp_dir):
    names = ["id"] + [f"t{i:06d}" for i in range(300)]
    write(os.path.join(tmp_dir, "wide.csv"),
          ",".join(names) + "\n" + "a," + ",".join(str(i) for i in range(300)) + "\n")
    got_names, df = read_diary(spark, tmp_dir)
    row = df.first()
    assert got_names == names and row["id"] == "a" and row["t000299"] == 299.0 and len(row) == 301
    bad = os.path.join(tmp_dir, "bad")
    os.makedirs(bad)
    write(os.path.join(bad, "wide.csv"),
          ",".join(names) + "\n" + "a," + ",".join(str(i) for i in range(299)) + ",\n")
    _, df_bad = read_diary(spark, bad)
    with pytest.raises(FAILURES):
        df_bad.select("id").collect()


def test_diary_check_runs_before_later_filters(spark, tmp_dir):
    # the malformed number sits on a line the summary's telfs <= 4 filter drops
    write(os.path.join(tmp_dir, "d.csv"),
          "tucaseid,telfs,tesex,teage,t010101,t050101,t020101\nA,1,1,30,60,60,60\nB,5,1,30,x,60,60\n")
    from quarry.operators import diary as d

    names, df = read_diary(spark, tmp_dir)
    with pytest.raises(FAILURES):
        d.summary_from(df, names).collect()


GOOD_POSTINGS = ["1,1,,,0,Java", "2,11,,1,4", "1,2,,,0,Perl", "2,12,,2,5"]
BAD_POSTINGS = ["x,5,,,3", "1,zz,,,3,Java", "2,7,,zz,3", "2,7,zz,1,3", "2,7,,1,zz", "2,7,,1,", "2,7", "", "1,,,,3", "2,7,,1,3.5"]
POSTING_USES = {
    "collect": lambda df: df.collect(), "count": lambda df: df.count(),
    "questions": lambda df: qa.questions(df).collect(), "answers": lambda df: qa.answers(df).count(),
    "pairs": lambda df: qa.question_answer_pairs(df).collect(), "high_scores": lambda df: qa.high_scores(df).collect(),
    **{f"filter {c}": (lambda df, c=c: df.where(f"{c} <= 4").count())
       for c in ("postingType", "id", "acceptedAnswer", "parentId", "score")},
    "filter tags": lambda df: df.where("tags = 'Java'").select("id").collect(),
}


@pytest.mark.parametrize("use", POSTING_USES)
def test_no_use_of_postings_hides_a_malformed_line(spark, use):
    for bad in BAD_POSTINGS:
        with pytest.raises(FAILURES):
            POSTING_USES[use](parse_posting_lines(lines(spark, [*GOOD_POSTINGS, bad])))
    POSTING_USES[use](parse_posting_lines(lines(spark, GOOD_POSTINGS)))


DIARY_NAMES = ["tucaseid", "telfs", "tesex", "teage", "t010101", "t050101", "t020101"]
DIARY_USES = {
    "collect": lambda df: df.collect(), "count": lambda df: df.count(),
    "summary": lambda df: diary.summary_from(df, DIARY_NAMES).collect(),
    "grouped": lambda df: diary.grouped(diary.summary_from(df, DIARY_NAMES)).collect(),
    "hours": lambda df: diary.column_hours(DIARY_NAMES, df).collect(),
    **{f"filter {c}": (lambda df, c=c: df.where(f"{c} <= 4").count()) for c in DIARY_NAMES[1:]},
}


@pytest.mark.parametrize("use", DIARY_USES)
def test_no_use_of_a_diary_hides_a_malformed_line(spark, use):
    good = ["A,1,1,30,60,60,60", "B,5,2,40,1,1,1"]
    bad = [",".join(["C", *["1" if k != i else v for k in range(6)]]) for i in range(6) for v in ("", "x")]
    for line in [*bad, "C,1,1", "C,1,1,1,1,1,1,1", ""]:
        with pytest.raises(FAILURES):
            DIARY_USES[use](parse_diary_lines(lines(spark, [*good, line]), DIARY_NAMES))
    DIARY_USES[use](parse_diary_lines(lines(spark, good), DIARY_NAMES))


@pytest.mark.parametrize("line", ["no separator at all, but long enough", "<page><title> T</title><text>", "x</title><text>y</text></page>  "])
def test_tagged_lines_raise_under_count_and_filters(spark, line):
    good = "<page><title> A</title><text>Java rocks</text></page>  "
    df = parse_tagged_lines(lines(spark, [good, line]))
    for use in (lambda: df.count(), lambda: df.where("title = 'A'").collect(), lambda: df.select("text").collect()):
        with pytest.raises(FAILURES):
            use()


def test_diary_header_only_in_the_first_file(spark, tmp_dir):
    write(os.path.join(tmp_dir, "part-0.csv"), "")
    write(os.path.join(tmp_dir, "part-1.csv"), "tucaseid,telfs,t010101\nA,1,60\n")
    write(os.path.join(tmp_dir, "part-2.csv"), "".join(f"B{i},2,{i}\n" for i in range(500)))
    names, df = read_diary(spark, tmp_dir)
    assert names == ["tucaseid", "telfs", "t010101"] and df.count() == 501


def test_diary_trailing_empty_fields(spark, tmp_dir):
    write(os.path.join(tmp_dir, "d.csv"), "tucaseid,telfs,t010101,\nA,1,60,\nB,2,30\n")
    names, df = read_diary(spark, tmp_dir)
    assert names == ["tucaseid", "telfs", "t010101"]
    assert sorted(map(tuple, df.collect())) == [("A", 1.0, 60.0), ("B", 2.0, 30.0)]


@pytest.mark.parametrize("folder, file", [("a bb", "part 0.csv"), ("50%25 off", "x%20y.csv"), ("n#1", "a#b.csv"), ("café é", "journée.csv"), ("plain", "k+l&m.csv")])
def test_diary_paths_that_need_escaping(spark, tmp_dir, folder, file):
    import os

    where = os.path.join(tmp_dir, folder)
    os.makedirs(where)
    for name, text in ((file, "tucaseid,telfs,t010101\nA,1,60\n"), ("zz " + file, "tucaseid,telfs,t010101\nB,2,30.5\n"), ("0 empty " + file, "")):
        with open(os.path.join(where, name), "w", encoding="utf-8") as f:
            f.write(text)
    for path in (where, [os.path.join(where, file), os.path.join(where, "zz " + file)], os.path.join(where, file)):
        names, df = read_diary(spark, path)
        assert names == ["tucaseid", "telfs", "t010101"]
        rows = sorted(map(tuple, df.collect()))
        assert rows == [("A", 1.0, 60.0), ("B", 2.0, 30.5)][:1 if path == os.path.join(where, file) else 2]


def test_header_skips_files_without_lines(spark, tmp_dir):
    import gzip
    import os

    with gzip.open(os.path.join(tmp_dir, "a.csv.gz"), "wt"):
        pass                                              # bytes, but no line
    open(os.path.join(tmp_dir, "b.csv"), "w").close()
    with gzip.open(os.path.join(tmp_dir, "c.csv.gz"), "wt") as f:
        f.write("id,t01\nA,1\n")
    with open(os.path.join(tmp_dir, "d.csv"), "w") as f:
        f.write("other,names\n")
    assert read_header(spark, tmp_dir) == ["id", "t01"]
