"""Structured Streaming entry points.

The original jobs are batch only; this package runs the same keyword
ranking (A5) over a growing folder of article files, so new files update the
counts incrementally.  No other streaming operator exists.
"""

from quarry.streaming.keywords import (
    keyword_counts,
    read_article_stream,
    read_tagged_line_stream,
    start_keyword_counts,
)

__all__ = ["keyword_counts", "read_article_stream", "read_tagged_line_stream", "start_keyword_counts"]
