"""quarry: keyword ranking, Q&A clustering and time-diary summaries as Spark jobs.

Every operator takes and returns DataFrames (a SparkSession is passed in where
one is needed).  The heavy work is expressed with built-in DataFrame / SQL
expressions so Catalyst can prune, push down and partially aggregate; there is
no Python UDF anywhere in the library.

Sub-packages:

* ``quarry.sources``    text lines, tagged article lines, posting lines, diary CSV
* ``quarry.functions``  reusable column expressions (tokens, distances, bands)
* ``quarry.operators``  keyword ranking, postings / scores, k-means, diary summaries
* ``quarry.plans``      fixtures derived from the driver tables and the query catalog
* ``quarry.streaming``  the keyword ranking over a file stream
* ``quarry.jobs``       the three programs end to end; ``python -m quarry`` runs them
"""

from quarry.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]
