"""Embedding near-duplicates by spherical-cap filters, verified by exact cosines.

Filters are directions of the unit sphere: a filter holds the vectors whose
inner product with its direction is at least ``cap``.  Directions come from
structured random product codes: after a random rotation the space is cut into
``BLOCKS`` blocks with a small code book each, and every combination of one
code word a block is a direction.  A vector's filters are listed without
looking at the others: block by block, partial sums are kept that the best
words of the blocks left could still lift over the cap.  Several rotations
give independent codes, so that no vector is badly served by all of them.

The cap follows the number of vectors: an unrelated vector is in a filter with
``STRANGERS`` expected others, and there are as many filters as make two
vectors at the wanted cosine share ``SHARED`` of them on average.  Both
numbers are the same at every size, so work for a vector grows with the number
of filters only.

A group of copies would make a pair of each two of them, so vectors are first
gathered into balls: each vector goes to its most frequent filter, and those
within half of the wanted angle of the mean of that filter's vectors are one
ball.  All vectors of a ball are linked (angles add up at most), so they are
counted without being paired.  Balls, and the vectors outside of any as balls
of one, meet in the filters of their members.  What joins two balls is decided
by the angle of their centres and their radii: all links, none, or, between,
member by member against the other ball's centre, and only for members where
that leaves it open by exact cosines in blocks.  Two single vectors are
compared exactly.  The only pairs written are pairs of balls and of members
with balls.  Components come from the links between balls.

Equal vectors are one vector with a count before all this.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and are their own component; vectors of different
lengths do not link; repeated ids are separate rows, also as each other's
links; a row without an id takes part, is never kept, and has no component if
no linked row has an id; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_schema, batches_of, ddl, write_shared
from quarry.llm.graph import components

COSINE = 0.95
STRANGERS = 0.1
SHARED = 32
ROTATIONS = 128
BLOCKS = 3
LEAST_WIDTH = 16             # shorter vectors are padded with zeros
DECODED_ROWS = 2048          # vectors decoded at a time
COMPARED_ROWS = 2048         # vectors on either side of an exact comparison
MARGIN = 1e-7                # added to angles wherever a bound decides
SEED = 7

RESULT = "vec_id long, n_links long, component_id long, kept boolean"


# --------------------------------------------------------------------------- geometry


def cap_share(width: int, cap: float) -> float:
    """The share of the unit sphere whose inner product with a direction is at least ``cap``."""
    inside, whole = np.linspace(cap, 1, 4001), np.linspace(-1, 1, 40_001)
    power = (width - 3) / 2
    return float(np.trapezoid((1 - inside * inside) ** power, inside) / np.trapezoid((1 - whole * whole) ** power, whole))


def cap_for(width: int, share: float) -> float:
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if cap_share(width, middle) > share else (low, middle)
    return low


def both_inside(width: int, cap: float, cosine: float) -> float:
    """How likely a vector at this cosine to one inside a cap is inside, too."""
    x, z = np.linspace(cap, 1, 2001), np.linspace(-1, 1, 20_001)
    weight = (1 - z * z) ** ((width - 4) / 2)
    above = np.cumsum(weight[::-1])[::-1] / weight.sum()
    need = (cap - cosine * x) / (math.sqrt(1 - cosine * cosine) * np.sqrt(1 - x * x) + 1e-12)
    density = (1 - x * x) ** ((width - 3) / 2)
    return float((density * np.interp(need, z, above, left=1, right=0)).sum() / density.sum())


class ProductCodes:
    """Random product codes of ``ROTATIONS`` rotations for vectors of one width, and their cap."""

    def __init__(self, width: int, vectors: int, cosine: float):
        self.width = max(width, LEAST_WIDTH)
        share = min(0.05, STRANGERS / max(vectors, 1))
        self.cap = cap_for(self.width, share)
        filters = SHARED / both_inside(self.width, self.cap, cosine) / share / ROTATIONS
        self.words = max(2, math.ceil(filters ** (1 / BLOCKS)))
        self.cuts = np.linspace(0, self.width, BLOCKS + 1).astype(int)
        rng = np.random.default_rng([SEED, self.width])
        self.rotations, self.books = [], []
        for _ in range(ROTATIONS):
            q, _ = np.linalg.qr(rng.standard_normal((self.width, self.width)))
            self.rotations.append(q.astype(np.float32))
            books = []
            for a, b in zip(self.cuts, self.cuts[1:]):
                code = rng.standard_normal((self.words, b - a))
                code *= math.sqrt((b - a) / self.width) / np.linalg.norm(code, axis=1)[:, None]
                books.append(code.astype(np.float32))
            self.books.append(books)

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All exceeding filters of unit vectors: rows of ``unit`` and filter numbers."""
        if unit.shape[1] < self.width:
            unit = np.pad(unit, ((0, 0), (0, self.width - unit.shape[1])))
        unit = unit.astype(np.float32)
        rows, filters = [], []
        for r, (rotation, books) in enumerate(zip(self.rotations, self.books)):
            who, code = self._decode_one(unit @ rotation, books)
            rows.append(who)
            filters.append(code + r * self.words ** BLOCKS)
        return np.concatenate(rows), np.concatenate(filters)

    def _decode_one(self, turned: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        parts = [turned[:, a:b] @ book.T for a, b, book in zip(self.cuts, self.cuts[1:], books)]
        n = len(turned)
        after = [np.zeros(n, np.float32)]                    # what the blocks behind can add at most
        for part in reversed(parts[1:]):
            after.append(after[-1] + part.max(axis=1))
        after.reverse()
        who, code = np.nonzero(parts[0] >= (self.cap - after[0])[:, None])
        score, code = parts[0][who, code], code.astype(np.int64)
        for part, rest in zip(parts[1:], after[1:]):
            best = np.full(n, -np.inf, np.float32)
            np.maximum.at(best, who, score)
            mine, word = np.nonzero(part >= (self.cap - rest - best)[:, None])
            many = np.bincount(mine, minlength=n)
            begin, each = np.cumsum(many) - many, many[who]
            prefix = np.repeat(np.arange(len(who)), each)
            at = begin[who[prefix]] + np.arange(len(prefix)) - np.repeat(np.cumsum(each) - each, each)
            total = score[prefix] + part[mine[at], word[at]]
            good = total >= (self.cap - rest)[who[prefix]]
            who, code, score = who[prefix][good], code[prefix][good] * self.words + word[at][good], total[good]
        return who, code


@functools.lru_cache(maxsize=4)
def codes_for(width: int, vectors: int, cosine: float) -> ProductCodes:
    return ProductCodes(width, vectors, cosine)


def units(m: np.ndarray) -> np.ndarray:
    """Rows divided by their lengths, safe against overflow."""
    scaled = m / np.abs(m).max(axis=1, initial=0)[:, None]
    return scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None]


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def by_width(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrices of the equally long vectors of a batch."""
    lists = batch.column(column)
    sizes = lists.value_lengths().to_numpy()
    for width in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == width)
        yield rows, matrix(lists.take(pa.array(rows)))


def angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Angles between rows of unit vectors; exact also where they are small."""
    return 2 * np.arctan2(np.sqrt(((x - y) ** 2).sum(axis=1)), np.sqrt(((x + y) ** 2).sum(axis=1)))


# --------------------------------------------------------------------------- balls


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``(u, vector, unit, copies, first_id)`` of the different vectors of ``rows(vec_id, vector)``."""
    grouped = rows.groupBy("vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"))
    result = ddl("vector:doubles copies:long first_id:long unit:doubles")

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(result)
        for batch in batches:
            for rows, m in by_width(batch, 0):
                part = batch.take(pa.array(rows))
                yield from batches_of(schema, {**{n: part[n].cast(schema.field(n).type) for n in ("vector", "copies", "first_id")},
                                               "unit": units(m).tolist()})

    made = grouped.mapInArrow(normalise, result)
    return write_shared(made.select(F.monotonically_increasing_id().alias("u"), "*"), "different-vectors")


def memberships(nodes: DataFrame, cosine: float) -> DataFrame:
    """``(u, width, filter, n)``: filters of each vector that hold ``n`` > 1 vectors."""
    total = nodes.count()
    result = ddl("u:long width:int filter:long")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(result)
        for batch in batches:
            for at in range(0, batch.num_rows, DECODED_ROWS):
                part = batch.slice(at, DECODED_ROWS)
                ids = part.column(0).to_numpy()
                for rows, m in by_width(part, 1):
                    who, code = codes_for(m.shape[1], total, cosine).decode(m)
                    yield from batches_of(schema, {"u": pa.array(ids[rows[who]]), "width": pa.array(np.full(len(who), m.shape[1]), pa.int32()),
                                                   "filter": pa.array(code)})

    listed = write_shared(nodes.select("u", "unit").mapInArrow(decode, result), "filters")
    shared = listed.groupBy("width", "filter").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return write_shared(listed.join(shared, ["width", "filter"]), "shared-filters")


def balls_of(nodes: DataFrame, shared: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """``members(u, ball, vector, unit, copies)`` and ``balls(ball, n, copies, first_id, radius, vector, centre)``."""
    homes = shared.groupBy("u").agg(F.max(F.struct("n", "filter")).alias("home")).select("u", F.col("home.filter").alias("home"))
    placed = write_shared(nodes.join(homes, "u").withColumn("width", F.size("unit")), "homes")
    several = placed.groupBy("width", "home").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("width", "home")
    axes = placed.join(several, ["width", "home"]).select("width", "home", F.posexplode("unit").alias("at", "v"))
    summed = axes.groupBy("width", "home", "at").agg(F.sum("v").alias("v"))
    centres = summed.groupBy("width", "home").agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("c")).select(
        "width", "home", F.col("c.v").alias("mean"))
    half = math.acos(cosine) / 2 - MARGIN
    result = ddl("u:long vector:doubles unit:doubles copies:long first_id:long width:int home:long centre:doubles angle:double")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(result)
        for batch in batches:
            for rows, mean in by_width(batch, batch.schema.get_field_index("mean")):
                part = batch.take(pa.array(rows))
                unit = matrix(part["unit"])
                good = np.flatnonzero(np.abs(mean).max(axis=1) > 1e-6)   # a mean of opposites has no direction
                centre = units(mean[good])
                angle = angles(unit[good], centre)
                keep = angle <= half
                at = pa.array(good[keep])
                yield from batches_of(schema, {**{n: part[n].take(at).cast(schema.field(n).type) for n in
                                                  ("u", "vector", "unit", "copies", "first_id", "width", "home")},
                                               "centre": centre[keep].tolist(), "angle": pa.array(angle[keep])})

    gathered = write_shared(placed.join(centres, ["width", "home"]).mapInArrow(near, result), "gathered")
    named = gathered.groupBy("width", "home").agg(
        F.min("u").alias("ball"), F.count(F.lit(1)).alias("n"), F.sum("copies").alias("copies"), F.min("first_id").alias("first_id"),
        F.max("angle").alias("radius"), F.first("centre").alias("centre"))
    named = write_shared(named, "named-balls")
    inside = gathered.join(named.select("width", "home", "ball"), ["width", "home"]).select("u", "ball", "vector", "unit", "copies")
    single = nodes.join(gathered.select("u"), "u", "left_anti")
    members = write_shared(inside.unionByName(single.select("u", F.col("u").alias("ball"), "vector", "unit", "copies")), "members")
    balls = named.select("ball", "n", "copies", "first_id", "radius", F.lit(None).cast("array<double>").alias("vector"), "centre").unionByName(
        single.select(F.col("u").alias("ball"), F.lit(1).cast("long").alias("n"), "copies", "first_id", F.lit(0.0).alias("radius"), "vector",
                      F.col("unit").alias("centre")))
    return members, write_shared(balls, "balls")


# --------------------------------------------------------------------------- links


def exact_cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of rows of ``x`` with the same rows of ``y``, in double precision."""
    return (units(x) * units(y)).sum(axis=1)


def decided(gap: np.ndarray, reach: np.ndarray, wanted: float) -> np.ndarray:
    """1 where all links exist, 0 where none does, 2 where the bounds leave it open."""
    return np.where(gap + reach <= wanted - MARGIN, 1, np.where(gap - reach > wanted + MARGIN, 0, 2))


def compare_balls(shared: DataFrame, members: DataFrame, balls: DataFrame, cosine: float) -> DataFrame:
    """Pairs of balls that share a filter and may be linked: ``(a, b, n_a, n_b, copies_a, copies_b, state)``."""
    known = shared.select("u", "width", "filter").join(members.select("u", "ball"), "u").select("width", "filter", "ball").distinct()
    known = write_shared(known, "ball-filters")
    mixed = known.groupBy("width", "filter").agg(F.min("ball").alias("low"), F.max("ball").alias("high")).where("low < high").select("width", "filter")
    open_ = known.join(mixed, ["width", "filter"])
    left, right = open_.withColumnRenamed("ball", "a"), open_.withColumnRenamed("ball", "b")
    pairs = left.join(right, ["width", "filter"]).where("a < b").select("a", "b").distinct()
    columns = ("n", "copies", "radius", "vector", "centre")
    sides = [balls.select(F.col("ball").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns]) for s in ("a", "b")]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    result = ddl("a:long b:long n_a:long n_b:long copies_a:long copies_b:long state:int")
    wanted = math.acos(cosine)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(result)
        for batch in batches:
            for rows, centre in by_width(batch, batch.schema.get_field_index("centre_a")):
                part = batch.take(pa.array(rows))
                reach = part["radius_a"].to_numpy() + part["radius_b"].to_numpy()
                state = decided(angles(centre, matrix(part["centre_b"])), reach, wanted)
                lone = np.flatnonzero((part["n_a"].to_numpy() == 1) & (part["n_b"].to_numpy() == 1)
                                      & part["vector_a"].is_valid().to_numpy(zero_copy_only=False) & part["vector_b"].is_valid().to_numpy(zero_copy_only=False))
                if len(lone):
                    at = pa.array(lone)
                    state[lone] = exact_cosines(matrix(part["vector_a"].take(at)), matrix(part["vector_b"].take(at))) >= cosine
                at = pa.array(np.flatnonzero(state))
                yield from batches_of(schema, {**{n: part[n].take(at) for n in ("a", "b", "n_a", "n_b", "copies_a", "copies_b")},
                                               "state": pa.array(state[state > 0], pa.int32())})

    return write_shared(both.mapInArrow(compare, result), "ball-pairs")


def compare_members(open_pairs: DataFrame, members: DataFrame, balls: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """Members of the smaller ball against the larger one's centre: decided ones, and ``(u, own, ball)`` left open."""
    turned = open_pairs.selectExpr("if(n_a <= n_b, a, b) AS own", "if(n_a <= n_b, b, a) AS other")
    asked = turned.join(members.withColumnRenamed("ball", "own"), "own")
    centres = balls.select(F.col("ball").alias("other"), "centre", "radius", F.col("copies").alias("other_copies"), F.col("n").alias("other_n"))
    both = asked.join(centres, "other")
    result = ddl("u:long own:long other:long copies:long other_copies:long other_n:long vector:doubles state:int")
    wanted = math.acos(cosine)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(result)
        for batch in batches:
            for rows, unit in by_width(batch, batch.schema.get_field_index("unit")):
                part = batch.take(pa.array(rows))
                state = decided(angles(unit, matrix(part["centre"])), part["radius"].to_numpy(), wanted)
                at = pa.array(np.flatnonzero(state))
                yield from batches_of(schema, {**{n: part[n].take(at).cast(schema.field(n).type) for n in
                                                  ("u", "own", "other", "copies", "other_copies", "other_n", "vector")},
                                               "state": pa.array(state[state > 0], pa.int32())})

    done = write_shared(both.mapInArrow(compare, result), "member-pairs")
    return done.where("state = 1"), done.where("state = 2")


def compare_exactly(open_members: DataFrame, members: DataFrame, cosine: float) -> DataFrame:
    """Open members with the members of the other ball, in blocks: ``(u, own, other, links)`` for both sides."""
    loads = open_members.groupBy("other").agg(F.count(F.lit(1)).alias("asking"), F.max("other_n").alias("held"))
    cuts = loads.select("other", F.ceil(F.col("asking") / COMPARED_ROWS).alias("shards"), F.ceil(F.col("held") / COMPARED_ROWS).alias("blocks"))
    cuts = write_shared(cuts, "cuts")
    asking = open_members.join(cuts, "other").select(
        "other", F.pmod(F.xxhash64("u", "own"), F.col("shards")).alias("shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        "u", "own", "copies", "vector")
    held = members.withColumnRenamed("ball", "other").join(cuts, "other").select(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), F.pmod(F.xxhash64("u"), F.col("blocks")).alias("block"),
        "u", "copies", "vector")
    result = ddl("u:long own:long other:long links:long")

    def compare(_key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        schema = arrow_schema(result)
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        x, y = (units(matrix(t["vector"].combine_chunks())) for t in (left, right))
        mine, theirs = left["copies"].to_numpy(), right["copies"].to_numpy()
        linked = x @ y.T
        # The product's last digits depend on its shape: what is close to the bound is summed in one order.
        rows, columns = np.nonzero(np.abs(linked - cosine) < 1e-9)
        linked[rows, columns] = (x[rows] * y[columns]).sum(axis=1)
        linked = (linked >= cosine).astype(np.int64)
        asked, found = linked @ theirs, mine @ linked
        a, b = np.flatnonzero(asked), np.flatnonzero(found)
        own, other = left["own"].to_numpy(), left["other"].to_numpy()
        return pa.table({"u": np.concatenate([left["u"].to_numpy()[a], right["u"].to_numpy()[b]]),
                         "own": np.concatenate([own[a], np.full(len(b), -1)]), "other": np.concatenate([other[a], np.full(len(b), -1)]),
                         "links": np.concatenate([asked[a], found[b]])}, schema=schema)

    slot = ("other", "shard", "block")
    return write_shared(asking.groupBy(*slot).cogroup(held.groupBy(*slot)).applyInArrow(compare, result), "member-links")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: ``(vec_id, n_links, component_id, kept)``."""
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = F.coalesce(finite & F.exists("vector", lambda v: v != 0), F.lit(False))
    rows = source.withColumn("usable", usable)
    nodes = distinct_vectors(rows.where("usable").select("vec_id", "vector"))
    shared = memberships(nodes, cosine)
    members, balls = balls_of(nodes, shared, cosine)

    pairs = compare_balls(shared, members, balls, cosine)
    sure, open_pairs = pairs.where("state = 1"), pairs.where("state = 2")
    decided_members, open_members = compare_members(open_pairs, members, balls, cosine)
    found = compare_exactly(open_members, members, cosine)

    to_balls = sure.select(F.col("a").alias("ball"), F.col("copies_b").alias("links")).unionAll(
        sure.select("b", "copies_a")).unionAll(decided_members.select("other", "copies"))
    to_balls = to_balls.groupBy("ball").agg(F.sum("links").alias("ball_links"))
    to_members = decided_members.select("u", F.col("other_copies").alias("links")).unionAll(found.select("u", "links"))
    to_members = to_members.groupBy("u").agg(F.sum("links").alias("own_links"))
    edges = sure.select("a", "b").unionAll(decided_members.select("own", "other")).unionAll(found.where("own >= 0").select("own", "other"))
    roots = components(edges)

    whole = balls.select("ball", "copies", "first_id").withColumnRenamed("copies", "ball_copies").join(
        roots.withColumnRenamed("node", "ball"), "ball", "left").withColumn("root", F.coalesce("root", "ball"))
    first = whole.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labelled = whole.join(first, "root").select("ball", "ball_copies", "component_id").join(to_balls, "ball", "left")
    counted = members.select("u", "ball").join(labelled, "ball").join(to_members, "u", "left").select(
        "u", "component_id", (F.col("ball_copies") - 1 + F.coalesce("ball_links", F.lit(0)) + F.coalesce("own_links", F.lit(0))).alias("n_links"))
    by_vector = nodes.select("u", "vector").join(counted, "u").select("vector", "n_links", "component_id")
    linked = rows.where("usable").select("vec_id", "vector").join(by_vector, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
