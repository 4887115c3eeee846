"""Token expressions for the keyword predicate.

A keyword matches a text when it equals a whole blank-separated token of the
text: case-sensitive, and newlines or punctuation do not separate tokens
("Java," and "Java\\nScala" do not contain the token "Java").
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.fixed import TOKEN_SEPARATOR


def dedup(values: Iterable[str]) -> list[str]:
    """Keep the first occurrence of every value, in order."""
    seen: set[str] = set()
    out = []
    for v in values:
        if v not in seen:
            seen.add(v)
            out.append(v)
    return out


def keyword_array(keywords: Iterable[str]) -> Column:
    """The keyword list as an ``array<string>`` literal (empty list -> empty array)."""
    kws = dedup(keywords)
    if not kws:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(k) for k in kws])


def tokens(text: Column | str) -> Column:
    """Split on the blank only (the pattern is a single literal blank)."""
    return F.split(F.col(text) if isinstance(text, str) else text, TOKEN_SEPARATOR)


def has_token(text: Column | str, keyword: str) -> Column:
    """True when ``keyword`` is one of the blank-separated tokens of ``text``."""
    return F.array_contains(tokens(text), F.lit(keyword))


def present_keywords(text: Column | str, keywords: Iterable[str]) -> Column:
    """Distinct keywords that occur as tokens of ``text``.

    The text is split once per row; ``array_intersect`` hashes the (small)
    keyword array and streams the tokens, so the cost is linear in the text.
    """
    return F.array_intersect(tokens(text), keyword_array(keywords))
