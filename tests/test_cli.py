"""The command line runs the three programs end to end."""

import io
import os

from quarry.cli import main


def test_keywords_cli(spark, tmp_dir):
    path = os.path.join(tmp_dir, "articles.txt")
    with open(path, "w") as f:
        f.write("<page><title> a</title><text>Perl beside Ruby</text></page>  \n")
        f.write("<page><title> b</title><text>more Ruby</text></page>  \n")
    out = io.StringIO()
    assert main(["keywords", path, "--keywords", "Ruby", "Perl", "CSS"], spark=spark, out=out) == 0
    lines = [x for x in out.getvalue().splitlines() if not x.startswith("[")]
    assert lines == ["Ruby,2", "Perl,1", "CSS,0", "Ruby,2", "Perl,1", "Ruby,2", "Perl,1"]


def test_cluster_cli(spark, tmp_dir):
    path = os.path.join(tmp_dir, "lines.txt")
    with open(path, "w") as f:
        for qid in range(1, 21):
            f.write(f"1,{qid},,,0,{'Java' if qid % 2 else 'Scala'}\n2,{100 + qid},,{qid},{qid * 3}\n")
    out = io.StringIO()
    main(["cluster", path, "--keywords", "Java", "Scala", "--kernels", "2", "--debug"], spark=spark, out=out)
    lines = out.getvalue().splitlines()
    assert lines[0].startswith("[passes] ") and lines[1].startswith("iteration,idx")
    report = lines[lines.index("[clusters] by median score") + 1:]
    assert len(report) == 2 and all("(100.0%)" in line for line in report)


def test_diary_cli(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "rows.csv"), "w") as f:
        f.write("tucaseid,telfs,tesex,teage,t010101,t050101,t020101\na,1,1,30,60,120,30\n")
    out = io.StringIO()
    main(["diary", tmp_dir], spark=spark, out=out)
    assert out.getvalue().splitlines().count("working,male,active,1.0,2.0,0.5") == 4
