"""Shared-storage rules of the session helpers."""

import pytest

from quarry import session as session_module
from quarry.session import checkpoint_dir, release_scratch, scratch_mark, scratch_path


@pytest.fixture(autouse=True)
def no_paths_left(monkeypatch):
    """Paths of pretended clusters are forgotten after each test."""
    monkeypatch.setattr(session_module, "_scratch", list(session_module._scratch))


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master = master
        self._conf = _Conf(conf)
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf or {})
        self.conf = _Conf(conf or {})


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session("spark://master:7077"))


def test_cluster_uses_the_configured_folder():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert scratch_path(s, "points").startswith("hdfs:///shared/ckpt/points-")


def test_local_mode_falls_back_to_a_private_folder():
    s = _Session("local[2]")
    path = checkpoint_dir(s)
    assert path and s.sparkContext.getCheckpointDir() == path


def test_real_session_has_a_checkpoint_folder(spark):
    assert checkpoint_dir(spark)


class _ConnectLike:
    """A session without a SparkContext, as with Spark Connect."""

    def __init__(self, conf):
        self.conf = _Conf(conf)

    @property
    def sparkContext(self):
        raise AttributeError("no SparkContext in Spark Connect")


def test_connect_session_uses_conf():
    assert checkpoint_dir(_ConnectLike({"spark.checkpoint.dir": "s3a://b/ckpt"})) == "s3a://b/ckpt"
    with pytest.raises(RuntimeError):
        checkpoint_dir(_ConnectLike({"spark.master": "k8s://cluster"}))
    assert checkpoint_dir(_ConnectLike({"spark.master": "local[2]"}))


@pytest.mark.parametrize("path", ["file:///tmp/x", "/tmp/x"])
def test_cluster_refuses_a_local_folder(path):
    conf = {"spark.checkpoint.dir": path, "spark.master": "k8s://cluster"}
    with pytest.raises(RuntimeError, match="other executors do not see"):
        checkpoint_dir(_ConnectLike(conf))
    assert checkpoint_dir(_ConnectLike({**conf, "spark.quarry.checkpoint.sharedMount": "true"})) == path


def test_release_deletes_what_was_written(spark):
    import os

    mark = scratch_mark()
    path = scratch_path(spark, "short-lived")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    assert release_scratch(spark, mark) == 1 and not os.path.exists(local)


def test_tables_of_a_crashed_run_are_swept(spark):
    """Only the tables of a run with an expired lease go: not ours, not those of a living run, nothing else."""
    import os
    import time
    from urllib.parse import urlparse

    from quarry.session import RUN, read_text, sweep_expired, write_text

    own = scratch_path(spark, "points")
    spark.range(3).write.parquet(own)
    root = urlparse(checkpoint_dir(spark)).path
    dead, alive, unread = "a" * 16, "b" * 16, "c" * 16
    for run in (dead, alive, unread):
        spark.range(2).write.parquet(f"{root}/vectors-{run}{'0' * 16}")
    spark.range(2).write.parquet(f"{root}/points-{dead}{'1' * 16}")
    os.mkdir(f"{root}/kept-{dead}")
    write_text(spark, f"{root}/lease-{dead}", repr(time.time() - 5))
    write_text(spark, f"{root}/lease-{alive}", repr(time.time() + 500))
    write_text(spark, f"{root}/lease-{unread}", "soon")
    assert float(read_text(spark, f"{root}/lease-{RUN}")) > time.time()
    assert sweep_expired(spark) == 2
    left = set(os.listdir(root))
    assert {f"vectors-{alive}{'0' * 16}", f"vectors-{unread}{'0' * 16}", f"kept-{dead}", f"lease-{alive}", f"lease-{unread}", f"lease-{RUN}"} <= left
    assert f"lease-{dead}" not in left and not any(n.startswith((f"vectors-{dead}", f"points-{dead}")) for n in left)
    assert spark.read.parquet(own).count() == 3 and sweep_expired(spark) == 0
    assert sweep_expired(spark, now=time.time() + 1000) == 1                   # the living one has stopped


def test_small_files_are_replaced(spark, tmp_dir):
    from quarry.session import exists, read_text, write_text

    path = f"{tmp_dir}/a folder/state é"
    assert read_text(spark, path) is None and not exists(spark, path)
    for text in ("one", "", "zwei é\n", "3"):
        write_text(spark, path, text)
        assert read_text(spark, path) == text


@pytest.fixture
def as_cluster(spark, monkeypatch, tmp_dir):
    """The session as one of a cluster whose checkpoint folder is ``tmp_dir``, a path without a stated mount."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://master:7077")
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: f"file:{tmp_dir}")
    monkeypatch.setattr(session_module, "_trials", {}, raising=False)
    return spark


def test_cluster_uses_a_local_folder_that_a_trial_finds_shared(as_cluster, tmp_dir):
    """The queries that write intermediate tables run on a cluster whose folder is one mount on all machines."""
    import os

    from quarry.operators.kmeans import materialize

    assert checkpoint_dir(as_cluster) == f"file:{tmp_dir}"
    assert not [n for n in os.listdir(tmp_dir) if n.startswith("trial-")]
    written = materialize(as_cluster.range(7), "vectors")
    assert sorted(r.id for r in written.collect()) == list(range(7))
    assert all(f.startswith(f"file:{tmp_dir}/") or f.startswith(f"file://{tmp_dir}/") for f in written.inputFiles())


def test_cluster_refuses_a_local_folder_that_loses_files(as_cluster, monkeypatch):
    """A disk of each executor's own: the driver lists fewer files than were written."""
    import pyspark.sql.classic.dataframe as classic

    monkeypatch.setattr(classic.DataFrame, "count", lambda self, f=classic.DataFrame.count: f(self) - 1)
    with pytest.raises(RuntimeError, match="other executors do not see"):
        checkpoint_dir(as_cluster)


def test_cluster_without_checkpoint_dir_takes_a_shared_warehouse(as_cluster, monkeypatch):
    from quarry.session import SHARED_MOUNT

    monkeypatch.setattr(as_cluster.sparkContext, "getCheckpointDir", lambda: None)
    monkeypatch.setattr(as_cluster.sparkContext, "setCheckpointDir", lambda path: None)
    warehouse = as_cluster.conf.get("spark.sql.warehouse.dir")
    if as_cluster.sparkContext.getConf().get("spark.checkpoint.dir", None) is None:
        assert checkpoint_dir(as_cluster) == f"{warehouse}/quarry-checkpoints"
        as_cluster.conf.set(SHARED_MOUNT, "false")
        try:
            with pytest.raises(RuntimeError, match="spark.checkpoint.dir is not set"):
                checkpoint_dir(as_cluster)
        finally:
            as_cluster.conf.unset(SHARED_MOUNT)


def test_a_lease_that_cannot_be_written_is_no_error(spark, monkeypatch):
    def broken(*_):
        raise OSError("no room")

    monkeypatch.setattr(session_module, "_holder", None)
    monkeypatch.setattr(session_module, "write_text", broken)
    with pytest.warns(UserWarning, match="no lease"):
        assert scratch_path(spark, "points")


def test_small_files_on_a_store_without_a_file_context(spark, tmp_dir):
    from quarry.session import read_text, write_text

    conf = spark._jsc.hadoopConfiguration()
    name = "fs.AbstractFileSystem.viewfs.impl"
    bound = conf.get(name)
    conf.set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_dir}")
    conf.unset(name)
    try:
        for text in ("one", "two"):
            write_text(spark, "viewfs://store/in/state", text)
            assert read_text(spark, "viewfs://store/in/state") == text
    finally:
        conf.set(name, bound)


def test_an_unshared_folder_gives_way_to_a_shared_warehouse(as_cluster, monkeypatch, tmp_dir):
    """The trial finds the configured folder on each executor's own disk, the warehouse on a shared one."""
    taken = [f"file:{tmp_dir}"]
    monkeypatch.setattr(as_cluster.sparkContext, "getCheckpointDir", lambda: taken[-1])
    monkeypatch.setattr(as_cluster.sparkContext, "setCheckpointDir", taken.append)
    monkeypatch.setattr(session_module, "_is_shared", lambda path, *_: not path.startswith(f"file:{tmp_dir}"))
    with pytest.warns(UserWarning, match="is not shared"):
        assert checkpoint_dir(as_cluster) == f"{as_cluster.conf.get('spark.sql.warehouse.dir')}/quarry-checkpoints"


def test_local_cluster_has_no_private_folder(monkeypatch):
    """Executors of ``local-cluster`` are processes with a temporary folder of their own."""
    monkeypatch.setattr(session_module, "_is_shared", lambda *_: True)
    conf = {"spark.sql.warehouse.dir": "file:/shared/warehouse"}
    monkeypatch.setattr(session_module, "_on_local_disk", lambda *_: True)
    assert checkpoint_dir(_Session("local-cluster[3,4,10240]", conf)) == "file:/shared/warehouse/quarry-checkpoints"
    set_dir = {**conf, "spark.checkpoint.dir": "file:/shared/ckpt"}
    assert checkpoint_dir(_Session("local-cluster[3,4,10240]", set_dir)) == "file:/shared/ckpt"


def test_a_session_without_a_context_has_a_trial_too(spark, monkeypatch, tmp_dir):
    class Connect(_ConnectLike):
        range, read = spark.range, spark.read

    monkeypatch.setattr(session_module, "_trials", {})
    conf = {"spark.checkpoint.dir": f"file:{tmp_dir}", "spark.master": "spark://master:7077"}
    assert checkpoint_dir(Connect(conf)) == f"file:{tmp_dir}"


def test_a_trial_whose_files_cannot_be_deleted_still_counts(as_cluster, monkeypatch, tmp_dir):
    def refused(*_):
        raise OSError("no permission")

    monkeypatch.setattr(session_module, "_target", refused)
    with pytest.warns(UserWarning, match="stay in"):
        assert checkpoint_dir(as_cluster) == f"file:{tmp_dir}"


@pytest.fixture(scope="module")
def small_tables(spark):
    """90 orders with up to 7 lines each, and 12 documents."""
    import os
    import tempfile

    from quarry.plans.fixtures import CLUSTER_KEYWORDS

    folder = tempfile.mkdtemp(prefix="quarry-test-")
    texts = ["the and of that", "in en la\nthe", "of in the", "zzzz", "", "and the in of"]
    rows = {
        "documents": ("doc_id long, text string", [(d, texts[d % 6]) for d in range(12)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderpriority string",
                   [(k, k * 7 % 11, (CLUSTER_KEYWORDS + ["5-LOW"])[k % 5]) for k in range(1, 91)]),
        "lineitem": ("l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double",
                     [(k, n, float(k * n % 50 + 1), 900.25 + k * n * 7919 % 70000) for k in range(1, 91) for n in range(1, k % 8)]),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(os.path.join(folder, f"{name}.parquet"))
    return folder


@pytest.mark.parametrize("name", [
    "diary_column_hours", "diary_read", "keyword_conjunction", "keyword_pair_counts", "keyword_rank_bitmaps", "kmeans_converged",
    "kmeans_fixed", "kmeans_trace", "nearest_assignment", "postings_file_scan", "program_clusters", "program_clusters_default",
    "program_diary", "program_keywords",
])
def test_queries_with_intermediate_tables_run_on_a_cluster(as_cluster, small_tables, tmp_dir, name):
    """All rows of the SQL, with every intermediate table in the folder that the trial found shared."""
    import os

    import duckdb

    import __spark_entry__ as entry
    from quarry.session import _scratch

    mark = scratch_mark()
    df = entry.queries()[name](as_cluster, small_tables)
    found = [tuple(r) for r in df.collect()]
    written = _scratch[mark:]
    assert written and all(p.startswith(f"file:{tmp_dir}/") and os.path.isdir(p.removeprefix("file:")) for p in written)
    con = duckdb.connect()
    for table in ("documents", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{small_tables}/{table}.parquet/*.parquet')")
    wanted = con.execute(entry.oracle_sql()[name])
    at = [[d[0] for d in wanted.description].index(c) for c in df.columns]

    def rows(values):
        return sorted([tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in values], key=repr)

    assert rows(found) == rows(tuple(r[i] for i in at) for r in wanted.fetchall()) and found
