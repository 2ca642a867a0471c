"""Window functions as segmented prefix scans, for keys of any size.

A SQL window sorts all rows of a key in one task. Here rows are range partitioned by (key, order), so
a hot key spreads over as many pieces as its rows need. Each piece is a segment of the global order and
is completed by windows over itself alone, with what it needs from others added to it:

* running values (numbers, ranks, sums, smallest, first, last) take a carry-in, scanned over one
  associative summary for each piece and key. Only keys that go on from one piece to the next have one,
  so at most two rows a piece are broadcast;
* lags, leads and frames of rows take halo rows, copies of the few rows next to a piece;
* sums over frames of order values are differences of running sums, found by as-of joins.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tierlake.functions.columns import named
from tierlake.session import materialize

PIECE_ROWS = 500_000  # rows a piece is meant to have
TASKS = 2             # tasks that the windows of a piece are dealt over, by key


@dataclass(frozen=True)
class Running:
    """A value that goes along the rows of a key: how a piece computes it, sums itself up, and takes a carry-in."""

    here: Callable[[WindowSpec], Column]
    summary: Column
    merge: Callable[[Column, WindowSpec], Column]
    join: Callable[[Column, Column], Column]


def _least_of(pick: Callable, combine: Callable) -> Callable[[Column], Running]:
    return lambda c: Running(lambda w: pick(c).over(w), pick(c), lambda s, w: pick(s).over(w), combine)


def _plus(carry: Column, here: Column) -> Column:
    return F.coalesce(carry + here, carry, here)


def running_sum(c: Column) -> Running:
    return _least_of(F.sum, _plus)(c)


def running_count(c: Column | None = None) -> Running:
    c = F.lit(1) if c is None else c
    return Running(lambda w: F.count(c).over(w), F.count(c), lambda s, w: F.sum(s).over(w), _plus)


def running_min(c: Column) -> Running:
    return _least_of(F.min, F.least)(c)


def running_max(c: Column) -> Running:
    return _least_of(F.max, F.greatest)(c)


def first_value(c: Column) -> Running:
    """The key's first row's value, null or not."""
    held = F.struct(c.alias("v"))
    return Running(lambda w: F.first(held).over(w), F.min_by(held, "_at"), lambda s, w: F.first(s, ignorenulls=True).over(w),
                   lambda carry, here: F.coalesce(carry, here)["v"])


def last_known(c: Column) -> Running:
    """The last value that is not null, up to the row."""
    return Running(lambda w: F.last(c, ignorenulls=True).over(w), F.max_by(c, F.when(c.isNotNull(), F.col("_at"))),
                   lambda s, w: F.last(s, ignorenulls=True).over(w), lambda carry, here: F.coalesce(here, carry))


@dataclass(frozen=True)
class Pieces:
    """Rows in global order: ``_piece`` numbers the segments, ``_at`` the rows of a segment.

    A step reads the rows several times, so what an earlier step has added is written first. Windows run in
    ``tasks`` tasks: adaptive execution would put many pieces, whose sorted rows are small when compressed, in one.
    """

    rows: DataFrame
    key: tuple[str, ...]
    tasks: int
    written: bool = False

    def _write(self) -> Pieces:
        return self if self.written else Pieces(materialize(self.rows), self.key, self.tasks, True)

    def _step(self, rows: DataFrame) -> Pieces:
        return Pieces(rows, self.key, self.tasks)

    def _dealt(self) -> DataFrame:
        """The rows as the windows of ``_spec`` want them."""
        return self.rows.repartition(self.tasks, "_piece", *map(named, self.key))

    def _numbered(self) -> Pieces:
        """With ``_pos``, the row's number within its key."""
        found = self if "_pos" in self.rows.columns else self.running(_pos=running_count())
        return found._write()

    def _spec(self, order: str = "_at") -> WindowSpec:
        return Window.partitionBy("_piece", *map(named, self.key)).orderBy(order)

    def _with(self, found: DataFrame, carried: DataFrame, names: list[str]) -> DataFrame:
        """``found`` with the columns ``names`` of its piece and key, null where ``carried`` has none."""
        own = {k: f"_own{i}" for i, k in enumerate(self.key)}
        on = F.col("_piece") == F.col("_of")
        for k, o in own.items():
            on = on & named(k).eqNullSafe(F.col(o))
        some = carried.filter(F.col("_pieces") > 1).select(
            F.col("_piece").alias("_of"), *(named(k).alias(o) for k, o in own.items()), *names)
        return found.join(F.broadcast(some), on, "left").drop("_of", *own.values())  # at most two rows a piece

    def _summaries(self, columns: dict[str, Column]) -> DataFrame:
        """One row for each piece and key; ``_pieces`` says over how many pieces the key goes."""
        ends = self.rows.groupBy("_piece", *map(named, self.key)).agg(*(c.alias(n) for n, c in columns.items()))
        return ends.withColumn("_pieces", F.count(F.lit(1)).over(Window.partitionBy(*map(named, self.key))))

    def running(self, **columns: Running) -> Pieces:
        """Each row with the running values, up to and with itself."""
        self = self._write()
        summed = self._summaries({f"_s_{n}": c.summary for n, c in columns.items()})
        before = Window.partitionBy(*map(named, self.key)).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
        carried = summed.withColumns({f"_c_{n}": c.merge(F.col(f"_s_{n}"), before) for n, c in columns.items()})
        here = self._spec().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        found = self._dealt().withColumns({f"_h_{n}": c.here(here) for n, c in columns.items()})
        found = self._with(found, carried, [f"_c_{n}" for n in columns])
        joined = found.withColumns({n: c.join(F.col(f"_c_{n}"), F.col(f"_h_{n}")) for n, c in columns.items()})
        return self._step(joined.drop(*(f"_{x}_{n}" for x in "ch" for n in columns)))

    def numbered(self, name: str = "row_number") -> Pieces:
        numbered = self._numbered()
        return self._step(numbered.rows.withColumn(name, F.col("_pos")))

    def totals(self, name: str = "total") -> Pieces:
        """Each row with the number of its key's rows."""
        self = self._write()
        summed = self._summaries({"_n": F.count(F.lit(1))})
        whole = summed.withColumn("_whole", F.sum("_n").over(Window.partitionBy(*map(named, self.key))))
        own = F.count(F.lit(1)).over(Window.partitionBy("_piece", *map(named, self.key)))
        found = self._with(self._dealt().withColumn("_own_rows", own), whole, ["_whole"])
        return self._step(found.withColumn(name, F.coalesce("_whole", "_own_rows")).drop("_whole", "_own_rows"))

    def ranked(self, peers: Column, rank: str = "rank", dense_rank: str = "dense_rank") -> Pieces:
        """SQL's ranks; rows of a key with equal ``peers`` must follow each other."""
        marked = self._step(self._numbered().rows.withColumn("_peers", F.struct(peers.alias("v")))).near(
            1, 0, _before=lambda w: F.lag("_peers").over(w))
        new = F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.col("_peers"))
        ranks = self._step(marked.rows.withColumn("_new", new)).running(
            **{rank: running_max(F.when(F.col("_new"), F.col("_pos"))), dense_rank: running_sum(F.col("_new").cast("long"))})
        return self._step(ranks.rows.drop("_peers", "_before", "_new"))

    def tiled(self, tiles: int, name: str = "ntile") -> Pieces:
        """SQL's ntile: the first tiles have one row more where rows do not divide."""
        found = self._numbered().totals("_total")
        size, more, at = F.floor(F.col("_total") / tiles), F.col("_total") % tiles, F.col("_pos") - 1
        wide = more * (size + 1)
        tile = F.when(at < wide, F.floor(at / (size + 1))).otherwise(more + F.floor((at - wide) / F.greatest(size, F.lit(1)))) + 1
        return self._step(found.rows.withColumn(name, tile.cast("long")).drop("_total"))

    def near(self, before: int, after: int, **columns: Callable[[WindowSpec], Column]) -> Pieces:
        """Columns over a window that looks at most ``before`` rows back and ``after`` rows ahead.

        Each piece gets copies of so many rows of its first key from the pieces before it, and of its
        last key from those behind it.
        """
        numbered = self._numbered()
        bounds = numbered._summaries({"_low": F.min("_pos"), "_high": F.max("_pos")}).filter("_pieces > 1").drop("_pieces")
        names = {k: f"_own{i}" for i, k in enumerate(self.key)}
        targets = bounds.select(F.col("_piece").alias("_to"), F.col("_low").alias("_first"), F.col("_high").alias("_last"),
                                *(named(k).alias(o) for k, o in names.items()))
        edges = numbered._with(numbered.rows, numbered._summaries({"_low": F.min("_pos"), "_high": F.max("_pos")}), ["_low", "_high"])
        edges = edges.filter((F.col("_pos") > F.col("_high") - before) | (F.col("_pos") < F.col("_low") + after)).drop("_low", "_high")
        on = F.lit(True)
        for k, o in names.items():
            on = on & named(k).eqNullSafe(F.col(o))
        reach = F.col("_pos").between(F.col("_first") - before, F.col("_first") - 1) | F.col("_pos").between(
            F.col("_last") + 1, F.col("_last") + after)
        halo = edges.join(F.broadcast(targets), on & reach).withColumn("_piece", F.col("_to")).select(
            *map(named, numbered.rows.columns), F.lit(True).alias("_halo"))
        whole = self._step(numbered.rows.withColumn("_halo", F.lit(False)).unionByName(halo))
        found = whole._dealt().withColumns({n: c(whole._spec("_pos")) for n, c in columns.items()})
        return self._step(found.filter(~F.col("_halo")).drop("_halo"))

    def result(self) -> DataFrame:
        return self.rows.drop("_piece", "_at", "_pos")


def in_pieces(df: DataFrame, key: list[str], order: list[Column], piece_rows: int = PIECE_ROWS) -> Pieces:
    """Range partition ``df`` by key and order, and number the pieces; written once, so that numbers stay.

    ``order`` holds sort columns such as ``F.col("ts").desc_nulls_last()``. Key columns may be null: nulls
    are a key like any other. Rows of equal key and order lie in one piece, in any order, so an order that
    tells most rows apart is wanted.
    """
    pieces = max(-(-df.count() // piece_rows), 1)
    by = [named(k).asc_nulls_first() for k in key] + list(order)
    spread = df.coalesce(1) if pieces == 1 else df.repartitionByRange(pieces, *by)
    cut = spread.sortWithinPartitions(*by).withColumns({
        "_piece": F.spark_partition_id(), "_at": F.monotonically_increasing_id() % (1 << 33)})
    return Pieces(materialize(cut), tuple(key), TASKS * pieces, True)


def asof_join(
    left: DataFrame, right: DataFrame, key: str, ts: str, values: dict[str, str], tie: str | None = None,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Every left row with ``values`` of the latest right row of its key at or before its time.

    ``values`` maps right columns to output names. Rows of equal key and time are ordered by
    ``tie``, of any type with an order, nulls first. Left rows without key or time find nothing
    and stay where they are. Both sides are put in one order and cut into pieces by row counts; the last right
    row so far is a running value, so neither a hot key nor a hot hour is one task.
    """
    picked = list(values)
    tie_type = right.schema[tie].dataType.simpleString() if tie else "bigint"
    whole = named(key).isNotNull() & named(ts).isNotNull()
    state = F.struct(*[named(c).alias(values[c]) for c in picked])
    right_rows = right.where(whole).select(
        named(key).alias("_k"), named(ts).alias("_t"), F.lit(1).alias("_side"),
        (named(tie) if tie else F.lit(0)).cast(tie_type).alias("_tie"), state.alias("_state"))
    left_rows = left.where(whole).select(
        named(key).alias("_k"), named(ts).alias("_t"), F.lit(2).alias("_side"), F.lit(None).cast(tie_type).alias("_tie"),
        F.struct(*[named(c) for c in left.columns]).alias("_row"))
    merged = right_rows.unionByName(left_rows, allowMissingColumns=True)
    order = [F.col("_t").asc(), F.col("_side").asc(), F.col("_tie").asc_nulls_first()]
    found = in_pieces(merged, ["_k"], order, piece_rows).running(_found=last_known(F.col("_state"))).rows.where("_side = 2")
    outputs = [F.col("_found")[name].alias(name) for name in values.values()]
    unmatched = left.where(~whole).select(
        *map(named, left.columns), *[F.lit(None).cast(right.schema[c].dataType).alias(n) for c, n in values.items()])
    return found.select("_row.*", *outputs).unionAll(unmatched)


def range_sum(
    df: DataFrame, key: str, order: str, value: Column, below: Column, name: str, piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """The sum of ``value`` over the rows of a key from above ``below`` to the row's ``order`` and its peers.

    ``below`` is the largest order value before a row's frame, such as ``F.date_sub("day", 3)`` for two days
    back. A frame may hold any number of rows: its sum is that of two running sums. Give integers or
    decimals, whose differences are exact. Rows without key or order get null.
    """
    numbered = in_pieces(df.withColumn("_value", value).withColumn("_below", below), [key], [named(order).asc_nulls_first()], piece_rows)
    # read several times by each join, so written
    summed = materialize(numbered.running(_sum=running_sum(F.coalesce("_value", F.lit(0))), _row=running_count()).result())
    sums = summed.select(named(key), named(order), "_sum", "_row")
    upper = materialize(asof_join(summed, sums, key, order, {"_sum": "_to"}, "_row", piece_rows))
    lower = asof_join(upper.withColumnsRenamed({order: "_order", "_below": order}), sums, key, order, {"_sum": "_from"}, "_row", piece_rows)
    total = F.col("_to") - F.coalesce("_from", F.lit(0))
    return lower.drop(order).withColumnRenamed("_order", order).select(*map(named, df.columns), total.alias(name))
