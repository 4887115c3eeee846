"""Scans and parsers: text lines, tagged articles, postings, diary CSV."""

from quarry.sources.text import (
    ARTICLE_SCHEMA,
    articles_from_rows,
    parse_tagged_lines,
    read_articles,
    read_lines,
)
from quarry.sources.postings import POSTING_SCHEMA, parse_posting_lines, read_postings
from quarry.sources.diary import parse_diary_lines, read_diary, read_header

__all__ = [
    "ARTICLE_SCHEMA", "articles_from_rows", "parse_tagged_lines", "read_articles", "read_lines",
    "POSTING_SCHEMA", "parse_posting_lines", "read_postings",
    "parse_diary_lines", "read_diary", "read_header",
]
