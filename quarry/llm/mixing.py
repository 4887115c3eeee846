"""Mixing sources to target weights by Poisson replication.

Every listed source has a target weight; all other sources together have
``other_weight``.  A class of sources with share ``w`` of the weights and
``size`` of the corpus's ``total`` (UTF-8 bytes, and one for each document) is
repeated at the mean rate ``w * epochs * total / size``.  Each document draws
its number of copies by inverting the Poisson distribution of that mean at a
number from [0, 1) that is hashed from the seed and the document, so a
repeated task draws the same.  A mean above ``PART_RATE`` (a small source in a
large corpus) is the sum of equal parts, each inverted at a hashed number of
its own, so the work of a document is in proportion to its rate.  Copies are
exploded, in blocks of ``BLOCK_COPIES`` and then one by one, and shuffled
globally: the partition and the place in it come from a hash of document and
copy.

Only DataFrame functions are used.  What is broadcast has one row per listed
weight and one for the rest; ``MAX_WEIGHTS`` bounds it.  No row is moved
before the global shuffle, whose key is uniform however large a source is.

Defined results: a null or empty text counts one byte; a null source belongs
to the others unless ``None`` is listed; repeated rows draw equal numbers and
are written separately; an empty table stays empty; a class without documents
gives its weight to the rest; a document with 2^31 copies or more fails the
job; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import clean_text, fresh_name

MAX_WEIGHTS = 10_000
SEED = 17
UNIT_DIGITS = 13              # hexadecimal digits of a hash that make a number below 1
PART_RATE = 256               # mean of a distribution that is inverted at once, at most
BLOCK_COPIES = 4096


def _number(text: Column) -> Column:
    """52 hashed bits as a long."""
    return F.conv(F.substring(F.md5(text), 1, UNIT_DIGITS), 16, 10).cast("long")


def _distribution(rate: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, 2, ... up to far beyond the mean, from logarithms."""
    steps = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct((-rate).alias("log_p"), F.array(F.exp(-rate)).alias("upto"))

    def add(state: Column, k: Column) -> Column:
        log_p = state["log_p"] + F.log(rate) - F.log(k.cast("double"))
        return F.struct(log_p.alias("log_p"), F.concat(state["upto"], F.array(F.element_at(state["upto"], -1) + F.exp(log_p))).alias("upto"))

    return F.aggregate(F.sequence(F.lit(1), steps), start, add, lambda s: s["upto"])


def _copies(key: Column, parts: Column, upto: Column) -> Column:
    """Copies drawn for a key: a number for each part, the first from the key itself."""
    def unit(part: Column) -> Column:
        text = F.when(part == 0, key).otherwise(F.concat_ws("|", F.lit("part"), key, part))
        return _number(text) / F.lit(float(16 ** UNIT_DIGITS))

    units = F.transform(F.sequence(F.lit(0), parts - 1), unit)
    drawn = F.aggregate(units, F.lit(0).cast("long"), lambda sum_, u: sum_ + F.size(F.filter(upto, lambda c: c <= u)))
    return drawn.cast("int")


def mix(docs: DataFrame, weights: dict[str | None, float], other_weight: float = 0.0, epochs: float = 1.0, seed: int = SEED,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        copy_col: str | None = "copy", copies_col: str | None = "n_copies", order_col: str | None = "shuffle_key") -> DataFrame:
    """The documents repeated to the target weights, in a global random order.

    Adds the number of the copy (from 1), the document's number of copies and
    the place in the order; a name of ``None`` leaves that column out.
    """
    if len(weights) > MAX_WEIGHTS:
        raise ValueError(f"more than {MAX_WEIGHTS} weights")
    if min([*weights.values(), other_weight, epochs]) < 0:
        raise ValueError("weights must not be negative")
    spark = docs.sparkSession
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("class", T.IntegerType()),
                           T.StructField("weight", T.DoubleType())])
    listed = spark.createDataFrame([(s, k, float(w)) for k, (s, w) in enumerate(weights.items())], schema)
    rest = len(weights)

    whole = docs.select(F.struct("*").alias("doc"))
    text, source, doc_id = F.col("doc")[text_col], F.col("doc")[source_col], F.col("doc")[id_col]
    named = (
        whole.join(F.broadcast(listed), source.cast("string").eqNullSafe(F.col("name")), "left")
        .select("doc", F.coalesce("class", F.lit(rest)).alias("class"))
    )
    sizes = named.groupBy("class").agg(F.sum(F.octet_length(clean_text(text)).cast("long") + 1).alias("size"))
    all_weights = listed.select("class", "weight").unionAll(spark.createDataFrame([(rest, float(other_weight))], "class int, weight double"))
    shares = sizes.join(F.broadcast(all_weights), "class")
    everything = Window.partitionBy()                    # of at most one row for each listed weight, and one
    rates = (
        shares.withColumn("total", F.sum("size").over(everything)).withColumn("all_weight", F.sum("weight").over(everything))
        .where("weight > 0").select("class", (F.col("weight") / F.col("all_weight") * F.lit(float(epochs)) * F.col("total") / F.col("size")).alias("rate"))
        .where("rate > 0").withColumn("parts", F.ceil(F.col("rate") / PART_RATE).cast("int"))
        .select("class", "parts", _distribution(F.col("rate") / F.col("parts")).alias("upto"))
    )
    key = F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")),
                      F.coalesce(source.cast("string"), F.lit("")), F.md5(clean_text(text)))
    drawn = named.withColumn("key", key).join(F.broadcast(rates), "class")
    counted = drawn.select("doc", "key", _copies(F.col("key"), F.col("parts"), F.col("upto")).alias("copies")).where("copies > 0")
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0), F.expr(f"int((copies - 1) div {BLOCK_COPIES})"))))
    exploded = blocks.select("doc", "copies", "key", F.explode(F.expr(
        f"sequence(block * {BLOCK_COPIES} + 1, block * {BLOCK_COPIES} + least(copies - block * {BLOCK_COPIES}, {BLOCK_COPIES}))")).alias("copy"))
    ordered = exploded.withColumn("place", _number(F.concat_ws("|", F.lit("order"), F.col("key"), F.col("copy"))))
    shuffled = ordered.repartition("place").sortWithinPartitions("place", "copy")
    taken, extra = list(docs.columns), []
    for name, column in ((copy_col, "copy"), (copies_col, "copies"), (order_col, "place")):
        if name:
            taken.append(fresh_name(taken, name))
            extra.append(F.col(column).alias(taken[-1]))
    return shuffled.select(*[F.col("doc")[c].alias(c) for c in docs.columns], *extra)


def mix_sql(weights: dict[str, float], other_weight: float, epochs: float = 1.0, seed: int = SEED, table: str = "documents") -> str:
    """The same in DuckDB's SQL, with the distribution from the gamma function."""
    values = ", ".join(f"('{s}', {k}, {float(w)!r})" for k, (s, w) in enumerate(weights.items()))
    rest = len(weights)
    return f"""
WITH listed(name, class, weight) AS (VALUES {values}),
named AS (
  SELECT d.*, coalesce(l.class, {rest}) AS class,
         concat_ws('|', '{seed}', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(source, ''), md5(coalesce(text, ''))) AS key
  FROM {table} d LEFT JOIN listed l ON d.source IS NOT DISTINCT FROM l.name),
sizes AS (SELECT class, sum(strlen(coalesce(text, '')) + 1)::BIGINT AS size FROM named GROUP BY class),
shares AS (
  SELECT s.class, s.size, w.weight FROM sizes s
  JOIN (SELECT class, weight FROM listed UNION ALL SELECT {rest}, {float(other_weight)!r}) w ON s.class = w.class),
rates AS (
  SELECT class, weight / (SELECT sum(weight) FROM shares) * {float(epochs)!r} * (SELECT sum(size) FROM shares)::DOUBLE / size AS rate
  FROM shares WHERE weight > 0),
parts AS (SELECT class, CAST(ceil(rate / {PART_RATE}) AS INT) AS parts, rate / CAST(ceil(rate / {PART_RATE}) AS INT) AS rate FROM rates WHERE rate > 0),
steps AS (
  SELECT class, parts, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p
  FROM parts, (SELECT unnest(generate_series(0, (SELECT CAST(ceil(max(rate + 12 * sqrt(rate) + 40)) AS BIGINT) FROM parts))) AS k)),
upto AS (
  SELECT class, parts, list(c ORDER BY k) AS upto FROM (SELECT class, parts, k, sum(p) OVER (PARTITION BY class ORDER BY k) AS c FROM steps)
  GROUP BY class, parts),
units AS (
  SELECT n.*, u.upto, list_transform(generate_series(0, u.parts - 1), lambda i:
    ('0x' || substr(md5(CASE WHEN i = 0 THEN n.key ELSE concat_ws('|', 'part', n.key, CAST(i AS VARCHAR)) END), 1, {UNIT_DIGITS}))::BIGINT
    / {16 ** UNIT_DIGITS}.0::DOUBLE) AS units
  FROM named n JOIN upto u ON n.class = u.class),
drawn AS (
  SELECT *, list_sum(list_transform(units, lambda v: len(list_filter(upto, lambda x: x <= v))))::INT AS n_copies FROM units),
exploded AS (SELECT *, unnest(generate_series(1, n_copies))::INT AS copy FROM drawn WHERE n_copies > 0)
SELECT doc_id, text, lang, source, n_chars, copy, n_copies,
       ('0x' || substr(md5(concat_ws('|', 'order', key, CAST(copy AS VARCHAR))), 1, {UNIT_DIGITS}))::BIGINT AS shuffle_key
FROM exploded"""
