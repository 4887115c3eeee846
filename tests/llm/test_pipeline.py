"""The pipeline's stages, each against its operator's plain version on its own input."""

from collections import Counter, defaultdict

import test_lines
import test_packing
import test_simhash

import __spark_entry__ as entry
import corpus_pipeline
from quarry.llm.common import write_shared

SF = "/root/testdata/sf0.001"


def test_stages_on_their_own_inputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    outputs = []
    for _, stage in corpus_pipeline.STAGES:
        docs = write_shared(stage(spark, docs, SF), "stage-test")
        outputs.append(docs)
    good, deduped, single, mixed, pieces = outputs
    assert all(d.columns == columns for d in outputs[:-1])

    before = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {r.doc_id: r.text for r in good.collect()}
    assert all(before[i] == t for i, t in kept.items()) and 0.6 * len(before) < len(kept) < len(before)

    given = list(kept.items())
    want = test_lines.brute(given, test_lines.hashes(spark, given))
    lines = {r.doc_id: (r.text, r.n_chars) for r in deduped.collect()}
    assert lines == {i: (want[i, t], len(want[i, t])) for i, t in given}

    prints = [(i, test_simhash.plain_fingerprint(t)) for i, (t, _) in lines.items()]
    groups = test_simhash.brute_components(prints)
    first = {groups[b] for _, b in prints}
    singles = {r.doc_id: r.text for r in single.collect()}
    assert set(singles) == first and all(lines[i][0] == t for i, t in singles.items())

    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= set(singles) and sum(copies.values()) > 0

    rows = pieces.collect()
    test_packing.check(rows, [(r.doc_id, r.text) for r in mixed.collect()])
    tokens = defaultdict(int)
    for r in rows:
        tokens[r.doc_id] += r.length
    assert all(tokens[i] == n * len(test_packing.expected_ids(singles[i])) for i, n in copies.items())


def test_run_is_registered_and_handles_odd_tables(spark, docs_frame, tmp_dir):
    assert entry.queries()["pipeline"](spark, SF).count() > 0
    for name, rows in (("none", []), ("odd", [(None, None), (1, ""), (1, "word " * 30000), (None, "x\n" * 100)])):
        docs_frame(rows, extra=("copy", "bits")).write.parquet(f"{tmp_dir}/{name}/documents.parquet")
        corpus_pipeline.run(spark, f"{tmp_dir}/{name}").collect()
