"""Session construction and shared-storage helpers.

Library functions never create a session; they take one.  ``build_session`` is
for tests, the bench and command-line use.  ``checkpoint_dir`` honours the
cluster's ``spark.checkpoint.dir``, falls back to the warehouse if that is shared,
and to a private folder only in local mode (local runs and tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import threading
import time
import uuid
import warnings
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "quarry",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume.

    AQE stays on so small shuffles are coalesced and skewed join partitions are
    split at run time.  Broadcasts are decided only at run time: the static
    threshold (which trusts compressed file-size estimates) is off, and AQE
    broadcasts a join side only after its shuffle has *measured* it below
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``.  The UI is off because
    nothing may open a port.

    ``shuffle_partitions`` is set only when given (tests and the local bench);
    under ``spark-submit`` the cluster's own setting is kept, since a small
    fixed count would cap every shuffle's parallelism at scale.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


CONNECT_TRIAL_FILES = 64                    # of a session that cannot ask for the number of cores
SHARED_MOUNT = "spark.quarry.checkpoint.sharedMount"

_scratch: list[str] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it if still unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage.  A path on the
    local filesystem is used if it is one mount on all machines: either
    ``spark.quarry.checkpoint.sharedMount`` says so (``true`` or ``false``), or,
    unset, a trial does (see :func:`_is_shared`).  Where it is unset or not
    shared, a folder in the warehouse is taken by the same rules.  If no folder
    is left, it is an error.  Only in local mode without executors of its own
    (not ``local-cluster``), when nothing is configured (local runs, tests), is
    a private temporary folder created.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        master = str(spark.conf.get("spark.master", ""))
        return _accepted(spark.conf.get("spark.checkpoint.dir", None), master, spark, None)
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            current = None
    path = _accepted(current, sc.master, spark, sc)
    if path != sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def _accepted(path: str | None, master: str, spark: SparkSession, sc) -> str:
    """The folder to use, or an error if executors could not share it."""
    if path and (master.startswith("local") or _usable(path, spark, sc)):
        return path
    if not path and re.fullmatch(r"local(\[.*\])?", master):
        return tempfile.mkdtemp(prefix="quarry-ckpt-")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    instead = f"{warehouse.rstrip('/')}/quarry-checkpoints" if warehouse else None
    if instead and _usable(instead, spark, sc):
        if path:
            warnings.warn(f"spark.checkpoint.dir {path!r} is not shared; intermediate tables go to {instead!r}", stacklevel=3)
        return instead
    if not path:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder on shared storage "
            "(it holds materialised intermediate tables and stream state)"
        )
    raise RuntimeError(
        f"spark.checkpoint.dir is {path!r}, a local path that other executors do not see: name a folder on shared "
        f"storage, or set {SHARED_MOUNT}=true if the path is one mount on all machines"
    )


def _usable(path: str, spark: SparkSession, sc) -> bool:
    """Whether driver and executors of a cluster see the same files in a folder."""
    if not _on_local_disk(path, sc):
        return True
    stated = str(spark.conf.get(SHARED_MOUNT, None) or "").lower()
    return stated == "true" if stated else _is_shared(path, spark, sc)


_trials: dict[tuple[str, str], bool] = {}       # outcomes by application and folder


def _is_shared(path: str, spark: SparkSession, sc) -> bool:
    """A trial: a file from each core of the cluster, listed by the driver and read back by other tasks.

    Files on an executor's own disk are missed by the commit, so fewer rows
    come back or the job fails.  It runs once for a folder and application, on
    the executors of that moment.  A session without a JVM of its own (Spark
    Connect) leaves the trial's small files behind.
    """
    key = (sc.applicationId if sc is not None else str(spark.conf.get("spark.app.id", "")), path)
    if key not in _trials:
        probe = os.path.join(path, f"trial-{RUN}{uuid.uuid4().hex[:16]}")
        files = max(8, 2 * sc.defaultParallelism) if sc is not None else CONNECT_TRIAL_FILES
        try:
            spark.range(0, files, 1, files).write.parquet(probe)
            _trials[key] = spark.read.schema("id long").parquet(probe).count() == files
        except Exception as error:
            warnings.warn(f"trial of {path!r} as shared storage failed: {str(error)[:300]}", stacklevel=2)
            _trials[key] = False
        if getattr(spark, "_jvm", None) is not None:
            try:
                folder, target = _target(spark, probe)
                folder.delete(target, True)
            except Exception as error:
                warnings.warn(f"files of the trial stay in {probe!r}: {str(error)[:300]}", stacklevel=2)
    return _trials[key]


def _on_local_disk(path: str, sc) -> bool:
    scheme = urlparse(path).scheme
    if scheme:
        return scheme == "file"
    default = sc._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///") if sc is not None else "file:///"
    return urlparse(default).scheme in ("", "file")


def _target(spark: SparkSession, path: str):
    """The file system and Hadoop path of ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _target(spark, path)
    return files.exists(target)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file of shared storage as text; None if there is none."""
    files, target = _target(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file on shared storage by a rename, so that readers see the old or the new one.

    A file system that Spark has no ``FileContext`` for (its
    ``AbstractFileSystem`` is not configured) cannot replace a file by a rename; there the file is written in place.
    """
    files, target = _target(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    try:
        context = hadoop.FileContext.getFileContext(target.makeQualified(files.getUri(), files.getWorkingDirectory()).toUri(),
                                                    spark._jsc.hadoopConfiguration())
    except Py4JJavaError as error:
        if "UnsupportedFileSystemException" not in error.java_exception.toString():
            raise
        _put(files, target, text)
        return
    _, fresh = _target(spark, f"{path}.{uuid.uuid4().hex}")
    _put(files, fresh, text)
    overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = hadoop.Options.Rename.OVERWRITE
    context.rename(fresh, target, overwrite)


def _put(files, target, text: str) -> None:
    stream = files.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


#: Seconds without a renewal after which a run's intermediate tables may be swept.
LEASE_SECONDS = 3600.0
RUN = uuid.uuid4().hex[:16]                 # this process, the first half of its tables' names
_holder: threading.Thread | None = None


def _lease(folder: str, run: str) -> str:
    return os.path.join(folder, f"lease-{run}")


def _hold_lease(spark: SparkSession, folder: str) -> None:
    """Write this process's lease and keep renewing it while its session lives.

    Without a lease tables are only never swept, so one that cannot be written is a warning, not an error.
    """
    global _holder
    if getattr(spark, "_jvm", None) is None or (_holder is not None and _holder.is_alive()):
        return                              # a session without a JVM of its own cannot reach the folder from here

    def renew() -> None:
        write_text(spark, _lease(folder, RUN), repr(time.time() + LEASE_SECONDS))

    def hold() -> None:
        try:
            while True:
                time.sleep(LEASE_SECONDS / 6)
                renew()
        except Exception:                   # the session has ended, and the lease runs out
            return

    try:
        renew()
    except Exception as error:
        warnings.warn(f"no lease in {folder!r}: {str(error)[:300]}", stacklevel=3)
        return
    _holder = threading.Thread(target=hold, name="quarry-lease", daemon=True)
    _holder.start()


def sweep_expired(spark: SparkSession, now: float | None = None) -> int:
    """Delete the intermediate tables of runs whose lease has run out (crashed drivers); returns how many.

    Only folders whose name carries the run of an expired lease are touched.
    A lease that cannot be read as a time is left alone.
    """
    folder = checkpoint_dir(spark)
    files, target = _target(spark, folder)
    if not files.exists(target):
        return 0
    names = [(status.getPath(), status.getPath().getName()) for status in files.listStatus(target)]
    now = time.time() if now is None else now
    removed = 0
    for path, name in names:
        run = name.removeprefix("lease-")
        if run == name or not re.fullmatch("[0-9a-f]{16}", run) or run == RUN:
            continue
        try:
            expires = float(read_text(spark, path.toString()) or "nan")
        except ValueError:
            continue
        if not expires < now:
            continue
        for table, table_name in names:
            if re.fullmatch(rf".+-{run}[0-9a-f]{{16}}", table_name):
                files.delete(table, True)
                removed += 1
        files.delete(path, False)
    return removed


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the checkpoint folder, remembered for :func:`release_scratch`.

    The process holds a lease on its paths; see :func:`sweep_expired`.
    """
    folder = checkpoint_dir(spark)
    _hold_lease(spark, folder)
    path = os.path.join(folder, f"{name}-{RUN}{uuid.uuid4().hex[:16]}")
    _scratch.append(path)
    return path


def release_scratch(spark: SparkSession, keep: int = 0) -> int:
    """Delete the intermediate tables written so far (but the first ``keep``); returns how many.

    Call it when no DataFrame made before is needed any more.  ``keep`` is a
    number from :func:`scratch_mark`.
    """
    paths = _scratch[keep:]
    del _scratch[keep:]
    for path in paths:
        files, target = _target(spark, path)
        files.delete(target, True)
    return len(paths)


def scratch_mark() -> int:
    """How many intermediate tables exist now; tables written later are released by ``release_scratch(spark, mark)``."""
    return len(_scratch)
