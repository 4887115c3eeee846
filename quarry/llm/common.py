"""Shared helpers of the operators in this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_shared(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder, with the writer's ``options``, and read it back.

    Cuts the lineage: later jobs reread the files when an executor is lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(taken: list[str], stem: str) -> str:
    """A column name that no column of ``taken`` has (names compare without case)."""
    low = {t.lower() for t in taken}
    name = stem
    while name.lower() in low:
        name += "_"
    return name


def clean_text(column: str | Column) -> Column:
    """The text as a string, null as empty."""
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(col.cast("string"), F.lit(""))


def utf8(column: str | Column) -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return clean_text(column).cast("binary")


def batches_of(schema: pa.Schema, columns: dict[str, list]) -> Iterator[pa.RecordBatch]:
    """One record batch from lists or arrays by column name, none when there are no rows."""
    arrays = [
        columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], type=f.type)
        for f in schema
    ]
    if len(arrays[0]):
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def text_chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int = 2 << 20) -> Iterator[tuple[list, list]]:
    """Lists (ids, texts) of at most about ``chunk_bytes`` from batches of two columns; a longer text comes alone."""
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        a = 0
        for b in chunk_ends(texts, chunk_bytes):
            yield ids.slice(a, b - a).to_pylist(), texts.slice(a, b - a).to_pylist()
            a = b


def chunk_ends(texts: pa.Array, chunk_bytes: int) -> list[int]:
    """Where to cut ``texts`` into runs of at most about ``chunk_bytes``, the last end included; none without texts."""
    if not len(texts):
        return []
    group = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).cumsum() // chunk_bytes
    return [*(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many words each text (UTF-8 bytes) has, and the words of all, A-Z lowered, as bytes."""
    large = pa.types.is_large_binary(texts.type)
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.large_string() if large else pa.string())))
    words = split.values
    real = pc.not_equal(pc.binary_length(words), 0)      # white space at the ends of a text leaves empty ones
    before = np.append(0, np.cumsum(real.to_numpy(zero_copy_only=False)))
    lengths = np.diff(before[split.offsets.to_numpy()])
    return lengths, words.filter(real).view(texts.type)


def return_memory() -> None:
    """Give what this worker has freed back to the system: kept workers' memory counts against their executor's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def arrow_schema(ddl: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(ddl)


def ddl(text: str) -> T.StructType:
    """A schema from a list of ``name:type`` separated by blanks."""
    kinds = {
        "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
        "binary": T.BinaryType(), "boolean": T.BooleanType(), "float": T.FloatType(),
        "longs": T.ArrayType(T.LongType()), "ints": T.ArrayType(T.IntegerType()),
        "doubles": T.ArrayType(T.DoubleType()), "strings": T.ArrayType(T.StringType()),
        "binaries": T.ArrayType(T.BinaryType()),
    }
    fields = [part.split(":") for part in text.split()]
    return T.StructType([T.StructField(name, kinds[kind], True) for name, kind in fields])
