"""Command line for the three programs: ``python -m quarry <job> <path> [options]``.

* ``keywords PATH``  tagged-line articles -> the three rankings, each timed
* ``cluster PATH``   posting lines -> optional k-means trace and the cluster report
* ``diary PATH``     diary CSV -> summary and the grouped averages (DataFrame, SQL, typed)

Run under ``spark-submit`` on a cluster (the master comes from there); with
``--master`` a session is created for local use.  Only bounded results are
printed (rankings, k rows of clusters, 12 groups, ``--show`` summary rows).
"""

from __future__ import annotations

import argparse
import sys
import time
from collections.abc import Sequence

from pyspark.sql import SparkSession

from quarry import jobs
from quarry.fixed import (
    KMEANS_ETA,
    KMEANS_KERNELS,
    KMEANS_MAX_ITERATIONS,
    LANG_SPREAD,
    LANGUAGES,
)
from quarry.operators.keywords import ranking_list
from quarry.operators.kmeans import ClusterParams
from quarry.session import build_session, release_scratch, sweep_expired


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m quarry", description=__doc__.splitlines()[0])
    p.add_argument("--master", default=None, help="Spark master for a local session (default: from spark-submit)")
    sub = p.add_subparsers(dest="job", required=True)

    k = sub.add_parser("keywords", help="rank keywords over tagged-line articles")
    k.add_argument("path")
    k.add_argument("--keywords", nargs="+", default=LANGUAGES)

    c = sub.add_parser("cluster", help="cluster questions by keyword and best answer score")
    c.add_argument("path")
    c.add_argument("--keywords", nargs="+", default=LANGUAGES)
    c.add_argument("--spread", type=int, default=LANG_SPREAD)
    c.add_argument("--kernels", type=int, default=KMEANS_KERNELS)
    c.add_argument("--eta", type=float, default=KMEANS_ETA)
    c.add_argument("--max-iterations", type=int, default=KMEANS_MAX_ITERATIONS)
    c.add_argument("--state", default=None, help="folder on shared storage; a run broken off there is taken up")
    c.add_argument("--debug", action="store_true", help="print the per-pass trace")

    d = sub.add_parser("diary", help="time-diary summaries and grouped averages")
    d.add_argument("path")
    d.add_argument("--show", type=int, default=20, help="summary rows to print")

    sub.add_parser("sweep", help="delete intermediate tables of runs whose lease has run out")
    return p


def _print_rows(df, rows, out) -> None:
    print(",".join(df.columns), file=out)
    for r in rows:
        print(",".join(str(v) for v in r), file=out)


def _keywords(spark: SparkSession, args, out) -> None:
    for name, df in jobs.keyword_rankings_from_file(spark, args.path, args.keywords).items():
        t0 = time.perf_counter()
        ranked = ranking_list(df)
        print(f"[{name}] {time.perf_counter() - t0:.1f} s", file=out)
        for keyword, n in ranked:
            print(f"{keyword},{n}", file=out)


def _cluster(spark: SparkSession, args, out) -> None:
    params = ClusterParams(keywords=args.keywords, spread=args.spread, kernels=args.kernels,
                           eta=args.eta, max_iterations=args.max_iterations)
    run = jobs.cluster_postings_file(spark, args.path, params, args.state)
    if args.debug:
        trace = run.result.trace_frame(spark)
        print(f"[passes] {run.result.passes}, settled: {run.result.converged}", file=out)
        _print_rows(trace, run.result.history, out)
    print("[clusters] by median score", file=out)
    for row in run.report.collect():   # k rows, in the summary's order
        print(row["line"], file=out)


def _diary(spark: SparkSession, args, out) -> None:
    for name, df in jobs.diary_forms(spark, args.path).items():
        print(f"[{name}]", file=out)
        _print_rows(df, df.take(args.show) if name == "summary" else df.collect(), out)   # at most 12 groups


def _sweep(spark: SparkSession, args, out) -> None:
    print(f"{sweep_expired(spark)} tables deleted", file=out)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None, out=None) -> int:
    args = _parser().parse_args(argv)
    out = out or sys.stdout
    spark = spark or build_session(args.master, app_name=f"quarry-{args.job}")
    try:
        {"keywords": _keywords, "cluster": _cluster, "diary": _diary, "sweep": _sweep}[args.job](spark, args, out)
    finally:
        release_scratch(spark)
    return 0
