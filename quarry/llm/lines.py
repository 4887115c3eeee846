"""Line dedup over a deletion neighbourhood, with DataFrame functions only.

A line is compared as its lower-cased words.  It is removed when an earlier
line of the corpus has the same words or is within one edit of it (one unit
inserted, deleted or replaced).  The units of a line of ``MIN_WORDS`` words or
more are its words, those of a shorter one the characters of its words joined
by a blank; lines of under ``MIN_CHARS`` such characters, of which one edit is
a large part, are only compared exactly.  Earlier means a smaller document id
(none last), then the text's hash, then the line number; what was removed
still counts as earlier.  Blank lines stay.

The neighbourhood of a line within one edit is the line and all its variants
with one unit deleted.  Two lines within one edit share a variant: equal
lengths with the same position deleted, or one line is a variant of the other.
Variants are hashed keys, sums of 40-bit hashes of unit and place, so all keys
of a line follow from one running sum within its row.  Lines are joined by
equal keys without making pairs: all lines with one variant and position are
within one edit of each other and meet their earliest; a variant meets the one
line it equals.  What is found is verified by comparing the units.

Before keys are made, lines are dropped that can have no neighbour: one edit
leaves the first or the last half of the units as they are, so a line whose
halves are unique has none, and only the other half's positions are deleted.

Lines are aggregated to distinct lines before anything is joined.  Nothing is
marked for broadcast: the plan is the same at every size, and joins with the
lists of candidate and removed lines shuffle the texts by document.

Defined results: null and empty texts stay as they are; rows with equal id
and text are one document and keep the same lines; an empty table stays empty; a
document may lose all lines and keeps an empty text; other columns pass
through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import clean_text, fresh_name, write_shared

MIN_WORDS = 8
MIN_CHARS = 8
HASH_MASK = (1 << 40) - 1
SUM_UNITS = 256               # units whose running sum is made at a time

ORDER = "struct(doc_id IS NULL AS none, doc_id, text_hash, line_no)"


def line_words(line: str) -> str:
    """SQL for the lower-cased words of a line."""
    return rf"array_remove(split(lower({line}), '\\s+'), '')"


def held(table: DataFrame, *columns: str) -> DataFrame:
    """``table`` with SQL columns made by a generator, so that no later expression repeats them."""
    return table.selectExpr("*", f"inline(array(struct({', '.join(columns)})))")


def unit_columns(words: str) -> tuple[str, str]:
    """SQL for a line's units (null if it is only compared exactly) and whether they are words."""
    joined = f"array_join({words}, ' ')"
    by_word = f"size({words}) >= {MIN_WORDS}"
    return f"CASE WHEN {by_word} THEN {words} WHEN length({joined}) >= {MIN_CHARS} THEN split({joined}, '') END", by_word


def occurrences(source: DataFrame) -> DataFrame:
    """Every line with words: its place, hashes of its words, and the halves that one edit may leave."""
    lines = source.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    words = lines.selectExpr("doc_id", "text_hash", "line_no", f"{line_words('line')} AS w").where("size(w) > 0")
    units, by_word = unit_columns("w")
    measured = words.selectExpr("*", f"{units} AS u", f"{by_word} AS by_word").selectExpr("*", "coalesce(size(u), 0) AS n")
    half, less = "floor(n / 2)", "floor((n - 1) / 2)"

    def key(kind: str, length: str, when: str = "true") -> str:
        part = f"slice(u, 1, {length})" if kind == "p" else f"slice(u, n - {length} + 1, {length})"
        return f"CASE WHEN u IS NOT NULL AND {when} THEN xxhash64('{kind}', by_word, {part}) END"

    other = f"{less} < {half}"
    return measured.selectExpr(
        "doc_id", "text_hash", "line_no", "n", "xxhash64(w) AS h1", "xxhash64(1, w) AS h2",
        f"{key('p', f'int({half})')} AS p1", f"{key('p', f'int({less})', other)} AS p2",
        f"{key('s', f'int({half})')} AS s1", f"{key('s', f'int({less})', other)} AS s2",
    )


def with_neighbours(distinct: DataFrame) -> DataFrame:
    """Distinct lines that share a half with another one, and which half."""
    halves = distinct.where("p1 IS NOT NULL").selectExpr(
        "h1", "h2", "explode(array(struct(true AS first, p1 AS half), struct(true AS first, p2 AS half), "
        "struct(false AS first, s1 AS half), struct(false AS first, s2 AS half))) AS k").selectExpr("h1", "h2", "k.*").where("half IS NOT NULL")
    shared = halves.groupBy("half").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high").select("half")
    found = halves.join(shared, "half")
    return found.groupBy("h1", "h2").agg(F.max("first").alias("front"), F.max(~F.col("first")).alias("back"))


def variants(lines: DataFrame) -> DataFrame:
    """Keys of the deletion variants of each line (``place`` from 1), and of the line itself (``place`` 0).

    With ``h(u, i)`` the hash of a unit at place i, the key without place p is
    the sum of ``h(u, i)`` before p and of ``h(u, i - 1)`` behind it: from one
    place to the next it changes by ``h(u, p - 1)`` of the unit before less
    ``h(u, p - 1)`` of the unit at p, so all keys are one running sum.  Sums
    run within parts of ``SUM_UNITS`` and then over the parts, so the work of
    a line is in proportion to its length.
    """
    def hashed(seed: int, unit: str, place: str) -> str:
        return f"(xxhash64({seed}, by_word, {unit}, {place}) & {HASH_MASK}L)"

    def running(array: str) -> str:
        return f"aggregate({array}, CAST(array() AS array<bigint>), (acc, v) -> array_append(acc, coalesce(get(acc, size(acc) - 1), 0L) + v))"

    def total(array: str) -> str:
        return f"aggregate({array}, 0L, (acc, v) -> acc + v)"

    table = lines.selectExpr("h1", "h2", "n", "front", "back", "units", "by_word")
    for name, seed in (("a", 1), ("b", 2)):
        table = held(table, f"transform(units, (u, i) -> {hashed(seed, 'u', 'i')}) AS here", f"transform(units, (u, i) -> {hashed(seed, 'u', 'i - 1')}) AS moved")
        table = held(table, f"{total('here')} AS full_{name}", f"{total('moved')} AS behind",
                     "transform(moved, (v, i) -> if(i = 0, 0L, get(here, i - 1)) - v) AS step")
        table = held(table, f"transform(sequence(0, int((n - 1) div {SUM_UNITS})), c -> {running(f'slice(step, c * {SUM_UNITS} + 1, {SUM_UNITS})')}) AS part")
        table = held(table, f"{running('transform(part, p -> get(p, size(p) - 1))')} AS upto")
        table = held(table, f"flatten(transform(part, (p, c) -> transform(p, v -> v + behind + if(c = 0, 0L, get(upto, c - 1))))) AS key_{name}")
        table = table.drop("here", "moved", "behind", "step", "part", "upto")
    first, last = "if(back, 1, int(floor((n - 1) / 2)) + 1)", "if(front, n, int(floor(n / 2)))"
    keys = (f"inline(array_append(transform(sequence({first}, {last}), p -> struct(p AS place, get(key_a, p - 1) AS a, get(key_b, p - 1) AS b)), "
            "struct(0 AS place, full_a AS a, full_b AS b)))")
    return table.selectExpr("h1", "h2", keys)


def within_one_edit(x: str, y: str) -> str:
    """SQL: whether two arrays of units differ by at most one unit inserted, deleted or replaced."""
    def same(p: str, q: str) -> str:
        miss = f"array_position(zip_with({p}, {q}, (l, r) -> l <=> r), false)"
        return f"if({miss} = 0, greatest(size({x}), size({y})), {miss} - 1)"

    return (f"abs(size({x}) - size({y})) <= 1 AND {same(x, y)} + {same(f'reverse({x})', f'reverse({y})')} "
            f">= greatest(size({x}), size({y})) - 1")


def near_earlier(source: DataFrame, distinct: DataFrame) -> DataFrame:
    """``(h1, h2)`` of the distinct lines that have an earlier one within one edit."""
    found = with_neighbours(distinct).join(distinct.select("h1", "h2", "n", "rank"), ["h1", "h2"])
    wanted = found.groupBy(F.col("rank.doc_id").alias("doc_id"), F.col("rank.text_hash").alias("text_hash")).agg(
        F.collect_list(F.struct(F.col("rank.line_no").alias("line_no"), "h1", "h2", "n", "front", "back", "rank")).alias("wanted"))
    texts = split_once(join_documents(source, wanted, "inner"))
    lines = texts.selectExpr(
        f"inline(transform(wanted, x -> struct(x.h1, x.h2, x.n, x.front, x.back, x.rank, {line_words('lines[x.line_no]')} AS words)))")
    units, by_word = unit_columns("words")
    lines = lines.toDF("h1", "h2", "n", "front", "back", "rank", "words").dropDuplicates(["h1", "h2"])
    lines = write_shared(lines.selectExpr("h1", "h2", "n", "front", "back", "rank", f"{units} AS units", f"{by_word} AS by_word"), "lines")
    keys = write_shared(variants(lines), "variants")

    # Replaced words: one variant, one position.  All such lines are within one edit; each meets the earliest.
    several = keys.where("place > 0").groupBy("a", "b", "place").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high")
    members = keys.join(several.select("a", "b", "place"), ["a", "b", "place"])
    ranked = write_shared(members.join(lines.select("h1", "h2", "rank"), ["h1", "h2"]), "ranked")
    earliest = ranked.groupBy("a", "b", "place").agg(F.min(F.struct("rank", "h1", "h2")).alias("top"))
    replaced = ranked.join(earliest, ["a", "b", "place"]).where("rank > top.rank").selectExpr("h1", "h2", "top.h1 AS e1", "top.h2 AS e2")

    # Inserted words: a variant is another line.
    whole = keys.where("place = 0").selectExpr("a", "b", "h1 AS e1", "h2 AS e2")
    inserted = keys.where("place > 0").join(whole, ["a", "b"]).select("h1", "h2", "e1", "e2").distinct()
    ranks = lines.selectExpr("h1 AS e1", "h2 AS e2", "rank AS other")
    both = inserted.join(lines.select("h1", "h2", "rank"), ["h1", "h2"]).join(ranks, ["e1", "e2"])
    later = both.selectExpr(
        "if(rank > other, h1, e1) AS h1", "if(rank > other, h2, e2) AS h2", "if(rank > other, e1, h1) AS e1", "if(rank > other, e2, h2) AS e2")

    pairs = replaced.unionByName(later).distinct()
    mine, theirs = lines.selectExpr("h1", "h2", "by_word", "units AS x"), lines.selectExpr("h1 AS e1", "h2 AS e2", "by_word AS as_word", "units AS y")
    verified = pairs.join(mine, ["h1", "h2"]).join(theirs, ["e1", "e2"]).where(f"by_word = as_word AND {within_one_edit('x', 'y')}")
    return verified.select("h1", "h2").distinct()


def split_once(table: DataFrame) -> DataFrame:
    """``table`` with ``lines`` of its ``text``, split by a generator so that no later expression repeats it."""
    return table.selectExpr("*", "inline(array(struct(split(text, '\\n') AS lines)))")


def join_documents(source: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """``source`` with the columns of ``lists`` for the same id (or none) and text hash."""
    right = lists.withColumnRenamed("doc_id", "list_id").withColumnRenamed("text_hash", "list_hash")
    same = F.col("text_hash").eqNullSafe(F.col("list_hash")) & F.col("doc_id").eqNullSafe(F.col("list_id"))
    return source.join(right, same, how).drop("list_id", "list_hash")


def removed_lines(source: DataFrame) -> DataFrame:
    """For each document that loses lines, their numbers (from 0), from ``source(doc_id, text_hash, text)``."""
    places = write_shared(occurrences(source), "occurrences")
    distinct = write_shared(
        places.groupBy("h1", "h2").agg(
            F.min(F.expr(ORDER)).alias("rank"), F.count(F.lit(1)).alias("times"), F.min("n").alias("n"),
            *[F.min(c).alias(c) for c in ("p1", "p2", "s1", "s2")]), "distinct-lines")
    near = write_shared(near_earlier(source, distinct), "near").withColumn("near", F.lit(True))
    affected = distinct.select("h1", "h2", "rank", "times").join(near, ["h1", "h2"], "left").where("times > 1 OR near")
    hits = places.select("doc_id", "text_hash", "line_no", "h1", "h2").join(
        affected.select("h1", "h2", "rank", "near"), ["h1", "h2"]).where(f"near OR {ORDER} > rank")
    return hits.groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                lines_col: str | None = None, removed_col: str | None = None) -> DataFrame:
    """``docs`` with repeated lines taken out of its texts.

    Names given for ``lines_col`` and ``removed_col`` add the numbers of lines
    before and of removed lines.
    """
    given = next(c for c in docs.columns if c.lower() == text_col.lower())
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != given], F.lit(0).alias(fresh_name(docs.columns, "nothing")))
    whole = docs.select(others.alias("doc"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("given"))
    whole = whole.withColumn("text_hash", F.xxhash64(clean_text("given")))
    removed = removed_lines(whole.select("doc_id", "text_hash", clean_text("given").alias("text")))
    joined = split_once(join_documents(whole, removed, "left").withColumn("text", clean_text("given")))
    kept = F.expr("array_join(transform(array_except(sequence(0, size(lines) - 1), removed), i -> lines[i]), '\\n')")
    text: Column = F.when(F.col("removed").isNull(), F.col("given")).otherwise(kept)
    columns = [text.alias(c) if c == given else F.col("doc")[c].alias(c) for c in docs.columns]
    extra, taken = [], list(docs.columns)
    counts = {lines_col: F.size("lines").cast("long"), removed_col: F.when(F.col("removed").isNull(), 0).otherwise(F.size("removed")).cast("long")}
    for name, column in counts.items():
        if name:
            taken.append(fresh_name(taken, name))
            extra.append(column.alias(taken[-1]))
    return joined.select(*columns, *extra)
