"""Lookup and range joins that stay balanced when one key holds most rows; as-of joins are in ``scans``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.columns import named
from tierlake.operators.scans import PIECE_ROWS, in_pieces, running_max, running_min, running_sum
from tierlake.session import materialize

SALT = "_salt"
CELL_STEP = 16
TARGET_ROWS = 1_000_000  # rows of one key that one task may join
MOST_HOT = 100_000       # keys over the target, at most
KEYLESS_SALTS = 4096
TILE_PAIRS = 1 << 22     # pairs of rows of one key that stay together
TASK_PAIRS = 1 << 24     # pairs that a task is meant to join
MOST_TASKS = 20_000
FEW_MATCHES = 64         # rows of a key on the right with which a join is a lookup
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; 0 when broadcasting is off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([bkmgt]?)b?", text).groups()
    return max(int(number) * _UNITS[unit], 0)


def _byte_width(field: T.StructField) -> Column:
    c = named(field.name)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + 16
    return F.lit(8)


def measured_bytes(df: DataFrame) -> int:
    """Bytes the rows really hold, summed on the executors (one column-pruned pass)."""
    width = sum((_byte_width(f) for f in df.schema.fields), F.lit(16))
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("b")).first()["b"]


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the measured size of ``df`` is within the session's broadcast limit."""
    limit = broadcast_limit(df.sparkSession)
    return limit > 0 and measured_bytes(df) <= limit


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Join a large left side to ``right``; ``how`` is left, inner, left_semi or left_anti.

    A right side whose *measured* size is within the broadcast limit is broadcast: the left
    rows do not move. A larger one takes part in a shuffle join with its hot keys salted.
    """
    if fits_broadcast(right):
        return left.join(F.broadcast(right), on, how)
    return salted_join(left, right, on, how, target_rows)


def hot_keys(df: DataFrame, on: list[str], target_rows: int) -> DataFrame:
    """Every key with more than ``target_rows`` rows and how many salts spread it: ``_salts``.

    Counts are exact and combined on the map side. There are at most ``MOST_HOT`` such keys, since
    the target is raised to a ``MOST_HOT``-th of all rows where it is below.
    """
    counts = materialize(
        df.select(*map(named, on)).dropna().groupBy(*map(named, on)).agg(F.count(F.lit(1)).alias("_n")))
    rows = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    target = max(target_rows, -(-rows // MOST_HOT), 1)
    return counts.where(F.col("_n") > target).select(
        *map(named, on), F.ceil(F.col("_n") / F.lit(target)).cast("int").alias("_salts"))


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Shuffle join on key plus salt, with as many salts as a key's rows need.

    Only the right rows of hot keys are copied, once per salt. The salt of a left row is its
    place in its input partition plus that partition's number, so that a retried task salts its
    rows the same. Left rows without a key match nothing and are spread as well.
    """
    hot = F.broadcast(hot_keys(left, on, target_rows))  # at most MOST_HOT rows
    no_key = F.lit(False)
    for name in on:
        no_key = no_key | named(name).isNull()
    place = F.monotonically_increasing_id() % (1 << 33) + F.spark_partition_id()
    salts = F.when(no_key, F.lit(KEYLESS_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted_left = left.join(hot, on, "left").withColumn(SALT, (place % salts).cast("int")).drop("_salts")
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    salted_right = right.join(hot, on, "left").withColumn(SALT, F.explode(every)).drop("_salts")
    return salted_left.join(salted_right, [*on, SALT], how).drop(SALT)


def pair_join(left: DataFrame, right: DataFrame, on: list[str], tile_pairs: int = TILE_PAIRS, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """Inner join of two sides that both repeat their keys, balanced by the pairs that its tasks make.

    Rows say little here: a few thousand on each side make millions of pairs. Both sides are counted by key. The
    pairs of a key with more than ``tile_pairs`` are a rectangle cut into tiles; a row is in one band of its side and
    copied once per band of the other, so that each pair is in one tile. The tiles and the other keys are dealt over
    as many tasks as there are ``task_pairs``, or ``spark.sql.shuffle.partitions`` if that is more. At most ``MOST_HOT``
    keys are cut. Where no key has over ``FEW_MATCHES`` rows on the right, left rows say enough: that is a ``lookup_join``.
    """
    def counted(df: DataFrame, rows: str) -> DataFrame:
        return df.groupBy(*map(named, on)).agg(F.count(F.lit(1)).alias(rows))

    both = counted(left, "_mine").join(counted(right, "_other"), on).withColumn(
        "_pairs", F.col("_mine").cast("double") * F.col("_other"))
    counts = materialize(both)
    pairs, matches = counts.agg(F.coalesce(F.sum("_pairs"), F.lit(0.0)), F.coalesce(F.max("_other"), F.lit(0))).first()
    if matches <= FEW_MATCHES:
        return lookup_join(left, right, on, "inner")
    tasks = min(int(pairs // task_pairs) + 1, MOST_TASKS)
    target = F.lit(max(tile_pairs, int(pairs) // MOST_HOT + 1, 1)).cast("long")
    wide = F.least("_mine", F.greatest(F.floor(F.sqrt(target)), F.floor(target / F.col("_other"))))
    high = F.greatest(F.floor(target / wide), F.lit(1))
    hot = F.broadcast(counts.where(F.col("_pairs") > target).select(
        *map(named, on), F.ceil(F.col("_mine") / wide).cast("int").alias("_bands"),
        F.ceil(F.col("_other") / high).cast("int").alias("_others")))
    if tasks == 1 and hot.isEmpty():
        return left.join(right, on, "inner")
    tasks = max(tasks, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    place = F.xxhash64(F.monotonically_increasing_id())  # hashed, as rows made of one row follow a beat

    def dealt(df: DataFrame, own: str, bands: str, other: str, others: str) -> DataFrame:
        banded = df.join(hot, on, "left").withColumn(own, F.pmod(place, F.coalesce(bands, F.lit(1))).cast("int"))
        # a row's copies share its band, so it is made before them
        cut = banded.withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(others, F.lit(1)) - 1)))
        return cut.drop("_bands", "_others").repartition(tasks, *map(named, on), F.col("_band"), F.col("_row"))

    mine = dealt(left, "_band", "_bands", "_row", "_others")
    return mine.join(dealt(right, "_row", "_others", "_band", "_bands"), [*on, "_band", "_row"], "inner").drop("_band", "_row")


def range_join(
    points: DataFrame,
    ranges: DataFrame,
    point: str,
    low: str,
    high: str,
    width: float,
) -> DataFrame:
    """Rows of ``points`` with the ranges where ``low <= point < high``.

    Instead of a nested loop both sides get an equality key: the number of a grid cell. Cells
    of size ``width`` serve the usual range; a longer one uses cells 16 times as large as often
    as it takes to touch at most 17 of them. So no range is repeated more often than that, and a
    point is looked up once in each cell size that occurs. Choose ``width`` near the usual
    range length. A cell may hold many points and many ranges; tasks are balanced by their pairs.
    """
    def cell(c: Column, level: Column) -> Column:
        return F.floor(c.cast("double") / (F.lit(float(width)) * F.pow(F.lit(float(CELL_STEP)), level)))

    length = (named(high).cast("double") - named(low).cast("double")) / float(width)
    level = F.greatest(F.ceil(F.log(F.greatest(length, F.lit(1.0))) / F.log(F.lit(float(CELL_STEP)))) - 1, F.lit(0)).cast("int")
    levelled = ranges.where(named(low) < named(high)).withColumn("_level", level)
    levels = sorted(r["_level"] for r in levelled.select("_level").distinct().collect())  # by powers of 16: some dozens
    celled = levelled.withColumn("_cell", F.explode(F.sequence(
        cell(named(low), F.col("_level")), cell(named(high), F.col("_level")))))
    left = points.withColumn("_level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn(
        "_cell", cell(named(point), F.col("_level")))
    hit = (named(point) >= named(low)) & (named(point) < named(high))
    return pair_join(left, celled, ["_level", "_cell"]).where(hit).drop("_level", "_cell")


def _ordinal(df: DataFrame, name: str) -> Column:
    """The column as a value that percentiles take and that orders as the column does."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(named(name))
    if isinstance(kind, T.DateType):
        return F.unix_date(named(name))
    if isinstance(kind, T.NumericType):
        return named(name)
    raise ValueError(f"inequalities take numbers, dates and timestamps, not {kind.simpleString()}: {name}")


def _cuts(left: Column, right: Column, sides: tuple[DataFrame, DataFrame], pieces: int) -> list:
    """Distinct quantiles of both sides together; a value held by over a ``pieces``-th of the rows is one of them."""
    values = sides[0].select(left.alias("v")).unionByName(sides[1].select(right.alias("v")))
    shares = [k / (2 * pieces) for k in range(1, 2 * pieces)]
    found = values.agg(F.percentile_approx("v", shares, 100 * pieces).alias("cuts")).first()["cuts"]
    return sorted(set(found or ()))


def _meetings(value: Column, cuts: list, falls: bool, or_equal: bool, upper: bool) -> Column:
    """Where a row meets its partners of one inequality: array of (level, node).

    Cuts part the values into numbered pieces: each cut value is a piece of its own, the values between two
    cuts are another. Two different pieces meet at one level alone, that of the highest bit their numbers differ
    in, with the lower one on the left of the node. Rows of one piece meet at level -1; rows of equal values
    there only if ``or_equal``.
    """
    among = F.array(*map(F.lit, cuts))
    at = 2 * F.size(F.filter(among, lambda cut: cut < value)) + F.array_contains(among, value).cast("int")
    last = 2 * len(cuts)
    piece = F.lit(last) - at if falls else at
    levels = F.sequence(F.lit(0), F.lit(max(last.bit_length() - 1, 0)))
    bit = F.lit(1 if upper else 0)
    nodes = F.transform(
        F.filter(levels, lambda level: F.call_function("shiftright", piece, level).bitwiseAND(F.lit(1)) == bit),
        lambda level: F.struct(level.alias("level"), F.call_function("shiftright", piece, level + 1).alias("node")))
    own = F.array(F.struct(F.lit(-1).alias("level"), piece.alias("node")))
    return F.concat(nodes, own if or_equal else F.when(at % 2 == 0, own).otherwise(F.slice(own, 1, 0)))


def theta_join(
    left: DataFrame, right: DataFrame, conditions: list[tuple[str, str, str]], pieces: int = 32,
    target_rows: int = TILE_PAIRS,
) -> DataFrame:
    """Pairs of rows that fulfil all ``conditions``, each (left column, ``<`` ``<=`` ``>`` or ``>=``, right column).

    No nested loop: quantiles cut the values of each inequality into pieces, and a pair of pieces meets under one
    equality key (``_meetings``). A row is repeated at most eight times per inequality with 32 pieces, and two rows that
    share a key are a result unless they share a piece between two cuts, which holds about one row in ``2 * pieces``.
    Frequent values are cuts, so a hot value costs results only. Tasks are balanced by pairs (``pair_join``), keys
    with over ``target_rows`` pairs are cut.
    Both columns of a condition need one type, number, date or timestamp; null matches nothing, NaN is
    the greatest number. The sides may share no column name. Repeated rows give repeated pairs.
    """
    shared = set(left.columns) & set(right.columns)
    if shared or not conditions:
        raise ValueError(f"columns on both sides: {sorted(shared)}" if shared else "a theta join needs a condition")
    hit = F.lit(True)
    for mine, sign, other in conditions:
        if left.schema[mine].dataType != right.schema[other].dataType:
            raise ValueError(f"cast one side: {mine} and {other} have different types")
        left, right = left.where(named(mine).isNotNull()), right.where(named(other).isNotNull())
        compared = {"<": named(mine) < named(other), "<=": named(mine) <= named(other),
                    ">": named(mine) > named(other), ">=": named(mine) >= named(other)}
        hit = hit & compared[sign]
    sides, keys = (left, right), []
    for number, (mine, sign, other) in enumerate(conditions):
        values = _ordinal(sides[0], mine), _ordinal(sides[1], other)
        cuts = _cuts(*values, sides, pieces)
        if not cuts:  # one side has no rows and the other none either
            return left.join(right, F.lit(False))
        key = f"_meet{number}"
        keys.append(key)
        left = left.withColumn(key, F.explode(_meetings(values[0], cuts, sign[0] == ">", len(sign) == 2, False)))
        right = right.withColumn(key, F.explode(_meetings(values[1], cuts, sign[0] == ">", len(sign) == 2, True)))
    return pair_join(left, right, keys, target_rows).where(hit).drop(*keys)


_TOTALS = {"count": (F.count, F.sum, running_sum), "sum": (F.sum, F.sum, running_sum),
           "min": (F.min, F.min, running_min), "max": (F.max, F.max, running_max)}


def theta_totals(
    left: DataFrame, right: DataFrame, conditions: list[tuple[str, str, str]], totals: dict[str, tuple[str, Column]],
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Right rows with ``totals`` over the left rows that fulfil all ``conditions``; those without any are left out.

    ``conditions`` are those of ``theta_join``, and the result is what its pairs would give by right row, but no pair is
    made: the cost is n log n for two conditions, with another log n for each further one. ``totals`` maps output
    names to (``count``, ``sum``, ``min`` or ``max``, left column or expression).

    Rows of equal values are one class. For each condition but the last the classes of both sides are put in one
    order, where a left one precedes just the right ones it fulfils the condition with, and numbered. Of two
    numbers the highest bit they differ in is 0 in the lower: so a left and a right class meet under one node, its bit and
    what is above it. Inside a node the last condition is a running total in its own order.
    """
    if not conditions or not totals:
        raise ValueError("totals of a theta join need a condition and a total")
    for mine, _, other in conditions:
        if left.schema[mine].dataType != right.schema[other].dataType:
            raise ValueError(f"cast one side: {mine} and {other} have different types")
        left, right = left.where(named(mine).isNotNull()), right.where(named(other).isNotNull())
    values = [f"_v{n}" for n in range(len(conditions))]
    mine = left.groupBy(*(named(c[0]).alias(v) for c, v in zip(conditions, values)))
    mine = mine.agg(F.count(F.lit(1)).alias("_rows"), *(_TOTALS[kind][0](c).alias(f"_t_{name}") for name, (kind, c) in totals.items()))
    asked = right.withColumns({v: named(c[2]) for c, v in zip(conditions, values)})
    rows = mine.withColumn("_asks", F.lit(0)).unionByName(
        asked.select(*values).distinct().withColumn("_asks", F.lit(1)), allowMissingColumns=True)

    def order(number: int) -> list[Column]:
        sign, by = conditions[number][1], F.col(values[number])
        side = F.col("_asks").asc() if len(sign) == 2 else F.col("_asks").desc()
        return [by.desc() if sign[0] == ">" else by.asc(), side, *(F.col(v).asc() for v in values if v != values[number])]

    nodes = [f"_node{n}" for n in range(len(conditions) - 1)]
    for number, node in enumerate(nodes):
        rows = in_pieces(rows, [], order(number), piece_rows).numbered(node).result()
    if nodes:
        bits = F.sequence(F.lit(0), F.lit(max(rows.count().bit_length() - 1, 0)))
    for node in nodes:
        at, side = F.col(node), F.col("_asks")
        meets = F.transform(
            F.filter(bits, lambda b: F.call_function("shiftright", at, b).bitwiseAND(F.lit(1)) == side),
            lambda b: F.struct(b.alias("bit"), F.call_function("shiftright", at, b + 1).alias("above")))
        rows = rows.withColumn(node, F.explode(meets)).withColumns({f"{node}_bit": F.col(f"{node}.bit"), node: F.col(f"{node}.above")})
    keys = [k for node in nodes for k in (f"{node}_bit", node)]
    running = {"_rows": running_sum(F.col("_rows"))} | {
        f"_t_{name}": _TOTALS[kind][2](F.col(f"_t_{name}")) for name, (kind, _) in totals.items()}
    summed = in_pieces(rows, keys, order(len(conditions) - 1), piece_rows).running(
        **{f"_r{c}": r for c, r in running.items()}).result()
    found = summed.where((F.col("_asks") == 1) & (F.col("_r_rows") > 0)).groupBy(*values).agg(
        *(_TOTALS[kind][1](f"_r_t_{name}").alias(name) for name, (kind, _) in totals.items()))
    return lookup_join(asked, materialize(found), values, "inner").select(
        *map(named, right.columns), *map(named, totals))
