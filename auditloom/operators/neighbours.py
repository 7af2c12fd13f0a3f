"""Rules that compare a transaction with others of the same user.

Every rule has two forms with the same result. ``windowed`` sorts the rows of a user in one
task; all rules share one shuffle on the user. ``cells`` and ``attach`` are for users with too
many rows for a task: the rows are counted per key and hour with map-side combine, hours are
compared (a key has at most as many as the data has hours), and the answer is joined back.
"""

from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.functions.columns import all_present
from auditloom.operators.ordering import ONE_TASK_ROWS, number_rows, running_start
from auditloom.operators.skew import count_keys, lookup, shuffle_by, split_heavy
from auditloom.storage import concurrently, staged


def _stage_cells(cells, keys):
    payload = [c for c in cells.columns if c not in keys and c != "_n"]
    return staged(cells.select(F.struct(*keys).alias("_cell"), "_n", *payload), "cells")


def _attach(rows, cells, keys, flag, decide, spread):
    """Look up the cell of each row by its keys (missing keys are equal) and set the flag."""
    payload = [c for c in cells.columns if c not in ("_cell", "_n")]
    rows = lookup(rows.withColumn("_cell", F.struct(*keys)), cells, ["_cell"], "_n", **spread)
    return rows.withColumn(flag, F.coalesce(decide, F.lit(False))).drop("_cell", *payload)


@dataclass(frozen=True)
class Repeat:
    """Marks every row but the first (by row_id) of those equal on ``keys``."""

    keys: tuple
    flag: str

    def windowed(self, rows):
        order = Window.partitionBy(*self.keys).orderBy("row_id")
        return rows.withColumn(self.flag, F.row_number().over(order) > 1)

    def cells(self, rows):
        cells = rows.groupBy(*self.keys).agg(
            F.count("*").alias("_n"), F.min("row_id").alias("_first"))
        return _stage_cells(cells, self.keys)

    def attach(self, rows, cells, **spread):
        return _attach(rows, cells, self.keys, self.flag, F.col("row_id") > F.col("_first"), spread)


@dataclass(frozen=True)
class AnyRepeat:
    """Marks all rows that share their ``keys`` with another row."""

    keys: tuple
    flag: str

    def windowed(self, rows):
        return rows.withColumn(self.flag, F.count("*").over(Window.partitionBy(*self.keys)) > 1)

    def cells(self, rows):
        cells = rows.groupBy(*self.keys).agg(F.count("*").alias("_n")).withColumn("_many", F.col("_n") > 1)
        return _stage_cells(cells, self.keys)

    def attach(self, rows, cells, **spread):
        return _attach(rows, cells, self.keys, self.flag, F.col("_many"), spread)


@dataclass(frozen=True)
class Recent:
    """Marks rows whose predecessor with equal ``keys`` lies at most ``gap`` hours back.

    Missing keys are equal to nothing unless ``missing_equal``, as in SQL windows.
    """

    keys: tuple
    gap: int
    flag: str
    time: str = "step"
    missing_equal: bool = False

    def _comparable(self):
        return F.lit(True) if self.missing_equal else all_present(*self.keys)

    def windowed(self, rows):
        order = Window.partitionBy(*self.keys).orderBy(self.time, "row_id")
        back = F.col(self.time) - F.lag(self.time).over(order)
        near = self._comparable() & (back <= self.gap)
        return rows.withColumn(self.flag, F.coalesce(near, F.lit(False)))

    def cells(self, rows):
        keys = (*self.keys, self.time)
        hours = Window.partitionBy(*self.keys).orderBy(self.time)
        cells = (
            rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("row_id").alias("_first"))
            .withColumn("_back", F.col(self.time) - F.lag(self.time).over(hours))
        )
        return _stage_cells(cells, keys)

    def attach(self, rows, cells, **spread):
        near = self._comparable() & (
            (F.col("row_id") > F.col("_first")) | F.coalesce(F.col("_back") <= self.gap, F.lit(False)))
        return _attach(rows, cells, (*self.keys, self.time), self.flag, near, spread)


@dataclass(frozen=True)
class Burst:
    """Marks rows with two predecessors, or a successor, of the same user within ``span`` hours.

    Rows of an hour are taken in the order of ``ties``, then row_id.
    """

    user: str
    flag: str
    time: str = "step"
    ties: tuple = ("nameDest", "amount")
    span: int = 2

    def windowed(self, rows):
        order = Window.partitionBy(self.user).orderBy(
            *[F.asc_nulls_last(c) for c in (self.time, *self.ties, "row_id")])
        time = F.col(self.time)
        second_back = time - F.lag(self.time, 2).over(order) <= self.span
        next_on = F.lead(self.time).over(order) - time <= self.span
        burst = F.coalesce(second_back, F.lit(False)) | F.coalesce(next_on, F.lit(False))
        return rows.withColumn(self.flag, F.col(self.user).isNotNull() & burst)

    def cells(self, rows):
        keys = (self.user, self.time)
        place = []
        for c in self.ties:
            place += [F.col(c).isNull().alias(f"no_{c}"), F.col(c)]
        hours = Window.partitionBy(self.user).orderBy(self.time)
        cells = (
            rows.groupBy(*keys).agg(
                F.count("*").alias("_n"), F.max(F.struct(*place, "row_id")).alias("_last"))
            .withColumn("_last", F.col("_last.row_id"))
            .withColumn("_next", F.lead(self.time).over(hours) - F.col(self.time))
            .withColumn("_trail", F.sum("_n").over(hours.rangeBetween(-self.span, 0)))
        )
        return _stage_cells(cells, keys)

    def attach(self, rows, cells, **spread):
        burst = F.col(self.user).isNotNull() & (
            (F.col("row_id") != F.col("_last"))
            | F.coalesce(F.col("_next") <= self.span, F.lit(False))
            | (F.col("_trail") >= 3))
        return _attach(rows, cells, (self.user, self.time), self.flag, burst, spread)


@dataclass(frozen=True)
class Rank:
    """Numbers the rows of a user from 1 by time, ``ties`` and row_id."""

    user: str
    name: str
    time: str = "step"
    ties: tuple = ("nameDest", "amount")

    def _order(self):
        return [F.asc_nulls_last(c) for c in (self.time, *self.ties, "row_id")]

    def windowed(self, rows):
        order = Window.partitionBy(self.user).orderBy(*self._order())
        return rows.withColumn(self.name, F.row_number().over(order))

    def cells(self, rows):
        """One row per user; only heavy users come here, and their number is bounded."""
        sizes = staged(rows.groupBy(F.col(self.user).alias("_user")).agg(F.count("*").alias("_n")), "sizes")
        return running_start(sizes, [F.asc_nulls_last("_user")], "_n", "_start")

    def attach(self, rows, cells, **_):
        numbered = number_rows(rows, [F.asc_nulls_last(self.user), *self._order()], "_number")
        return (
            numbered.join(F.broadcast(cells), F.col(self.user).eqNullSafe(F.col("_user")))
            .withColumn(self.name, F.col("_number") - F.col("_start"))
            .drop("_user", "_n", "_start", "_number")
        )


def apply_rules(rows, user, rules, heavy_rows=None, attributes=None, **spread):
    """Apply the rules to the rows, whose keys all include ``user``.

    ``attributes`` is a table with one row per user, a missing one included, to left join
    while the rows lie together; its column ``_n`` is the number of rows of the user.
    """
    counts = count_keys(rows, user) if attributes is None else attributes
    light, heavy = split_heavy(rows, user, counts, heavy_rows)
    light = shuffle_by(light, counts.agg(F.sum("_n")).first()[0], user)
    for rule in rules:
        light = rule.windowed(light)
    if attributes is not None:
        light = light.join(attributes.drop("_n"), user, "left")
    if heavy is None:
        return light
    heavy = staged(heavy, "heavy_rows")
    cells = concurrently(heavy.sparkSession, *[lambda r=r: r.cells(heavy) for r in rules])
    # the rank first: it writes the rows, so nothing before it is computed twice
    for rule, table in sorted(zip(rules, cells), key=lambda pair: not isinstance(pair[0], Rank)):
        heavy = rule.attach(heavy, table, heavy_rows=heavy_rows, **spread)
    if attributes is not None:
        heavy = lookup(heavy, attributes, [user], "_n", heavy_rows=heavy_rows, **spread)
    return light.unionByName(heavy)
