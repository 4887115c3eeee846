"""SQL text helpers of the strict parsers."""

from __future__ import annotations


def sql_string(value: str) -> str:
    """A Spark SQL string literal for ``value``."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_ident(name: str) -> str:
    """A quoted Spark SQL identifier for ``name``."""
    return "`" + name.replace("`", "``") + "`"
