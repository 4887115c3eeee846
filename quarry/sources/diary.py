"""Header-driven wide CSV of the time diary.

The first line of the input names the columns; the first column is a string id
and every other column a double.  Fields are separated by plain commas (no quoting).
Parsing is strict: an empty or malformed number and a line with the wrong
number of fields fail the job, unlike the built-in CSV reader, which turns an
empty number into NULL even in FAILFAST mode.

Every field of every line is parsed and checked, whatever a later projection
uses (records are emitted through a Generate node, see
``quarry.sources.rows``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.fixed import DIARY_FIELD_SEPARATOR
from quarry.functions.strict import sql_ident, sql_string
from quarry.sources.rows import emit_checked_sql



def split_fields(line: str) -> list[str]:
    """Fields of a line; empty fields at its end do not count."""
    return line.rstrip(DIARY_FIELD_SEPARATOR).split(DIARY_FIELD_SEPARATOR)


def read_header(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names: the first line of the first file, in path order, that has one.

    Paths come from and go back to the file source's own hidden ``_metadata``
    columns, so names with blanks, ``%``, ``#`` or any other characters are
    never rewritten here, and files are listed by Spark, not in Python.  The
    least path of a file that is not empty is found without reading contents;
    the condition on it prunes all other files, and one line is read.
    """
    at, begins = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    lines = spark.read.text(path)
    name = files.agg(F.min(at)).first()[0]
    while name is not None:
        first = lines.where((at == F.lit(name)) & (begins == 0)).select("value").first()
        if first is not None:
            return split_fields(first[0])
        name = files.where(at > F.lit(name)).agg(F.min(at)).first()[0]     # a compressed file may hold no line
    raise ValueError(f"no header line in {path!r}")


def parse_diary_lines(lines: DataFrame, names: list[str], column: str = "value") -> DataFrame:
    """Lines (without headers) -> typed diary rows, column 0 a string, all others double.

    Each line is split once, empty fields at its end dropped.  A line with the
    wrong number of fields or any empty or malformed number raises in the
    generator that makes its row (see ``quarry.sources.rows``), so no filter or
    projection of a later query can hide it.  The expressions are SQL text: a
    diary has hundreds of columns.
    """
    n, sep = len(names), sql_string(DIARY_FIELD_SEPARATOR)
    split = lines.selectExpr(f"split(trim(TRAILING {sep} FROM {sql_ident(column)}), {sep}) AS f", f"{sql_ident(column)} AS line")
    fields = [(names[0], "get(f, 0)")]
    fields += [(names[i], f"try_cast(get(f, {i}) AS DOUBLE)") for i in range(1, n)]
    record = "named_struct(" + ", ".join(f"{sql_string(name)}, {expr}" for name, expr in fields) + ")"
    bad = f"size(f) <> {n} OR exists(slice(f, 2, {n}), x -> try_cast(x AS DOUBLE) IS NULL)"
    message = (
        f"concat({sql_string(f'malformed diary line (needs {n} fields, numbers in all but the first): ')}, "
        f"substring(line, 1, 120))"
    )
    return emit_checked_sql(split, record, bad, message)


def read_diary(spark: SparkSession, path: str | list[str]) -> tuple[list[str], DataFrame]:
    """Read a diary CSV folder or file: ``(column names, DataFrame)``.

    The header may stand in the first file only or, as Spark writes it, in
    every file: each line equal to it is dropped.
    """
    names = read_header(spark, path)
    header = DIARY_FIELD_SEPARATOR.join(names)
    kept = F.rtrim(F.col("value"), F.lit(DIARY_FIELD_SEPARATOR)) != F.lit(header)
    return names, parse_diary_lines(spark.read.text(path).where(kept), names)
