"""Running values over ordered groups, safe when one group holds a large part of all rows.

A window puts a whole group into one task. ``ordered_scan`` first looks for groups above ``rows_per_split`` with one
aggregate. Without any it is a plain window. Otherwise only the rows of those groups are range-partitioned by (keys, order),
which cuts a large group into several ranges, and written once with the number of their range, so that the cut never
moves; all other rows go through the window. Each range is scanned as a group of its own, and what the earlier ranges of a
group contribute is carried over from one aggregate row per group and range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.session import materialize

ROWS_PER_SPLIT = 4_000_000
# ranges are summed in blocks of so many, so that no task gets the ranges of a whole table
RANGES_PER_BLOCK = 4096


@dataclass(frozen=True)
class Running:
    """Running ``sum``, ``max``, ``min`` or ``count`` of ``column``; without the row itself unless ``inclusive``."""

    fn: str
    column: str | Column
    inclusive: bool = True

    def value(self) -> Column:
        return F.col(self.column) if isinstance(self.column, str) else self.column

    def over(self, window) -> Column:
        return getattr(F, self.fn)(self.value()).over(window.rowsBetween(Window.unboundedPreceding, 0 if self.inclusive else -1))

    def total(self) -> Column:
        return getattr(F, self.fn)(self.value())

    def merge_fn(self) -> str:
        return "sum" if self.fn == "count" else self.fn

    def merge(self, local: Column, carry: Column) -> Column:
        if self.fn == "sum":
            return F.coalesce(local + carry, local, carry)
        if self.fn == "count":
            return F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))
        return (F.greatest if self.fn == "max" else F.least)(local, carry)


def hot_keys(df: DataFrame, keys: list[str], rows_per_split: int) -> DataFrame | None:
    """The groups above ``rows_per_split`` as a written table (columns ``_h_<key>`` and ``_rows``), None if there is none."""
    counts = df.groupBy(*[F.col(k).alias(f"_h_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_rows"))
    hot = materialize(counts.filter(F.col("_rows") > rows_per_split), "hot")
    return hot if hot.limit(1).count() else None


def same_keys(keys: list[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_h_{k}"))
    return condition


def cut(df: DataFrame, keys: list[str], order: list[str], rows_per_split: int) -> tuple[DataFrame, DataFrame] | None:
    """(rows of the large groups, written in ranges of (keys, order) of at most ``rows_per_split`` rows with their number as ``_split``;
    all other rows), or None when no group is too large."""
    if not keys:
        total = df.count()
        if total <= rows_per_split:
            return None
        large, rest = df, df.limit(0)
    else:
        hot = hot_keys(df, keys, rows_per_split)
        if hot is None:
            return None
        total = hot.agg(F.sum("_rows")).first()[0]
        large, rest = df.join(hot, same_keys(keys), "left_semi"), df.join(hot, same_keys(keys), "left_anti")
    return materialize(in_ranges(large, total, [*keys, *order], rows_per_split, "_split"), "ranges"), rest


def in_ranges(df: DataFrame, total: int, order: list[str], rows_per_split: int, name: str) -> DataFrame:
    """``df``, of ``total`` rows, with the number of its range in ``order``; a range has at most ``rows_per_split`` rows.

    Sorted partitions are cut into ranges, so that the number of tasks goes with the rows, however small the ranges are.
    """
    usual = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // ROWS_PER_SPLIT))
    ranged = df.repartitionByRange(min(-(-total // rows_per_split), usual), *order).sortWithinPartitions(*order)
    # the upper bits of this id are the number of the partition, so no range goes over the end of one
    return ranged.withColumn(name, F.expr(f"monotonically_increasing_id() div {rows_per_split}"))


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    running: dict[str, Running] | None = None,
    number: str | None = None,
    previous: dict[str, str] | None = None,
    descending: bool = False,
    rows_per_split: int = ROWS_PER_SPLIT,
    split: Column | None = None,
) -> DataFrame:
    """Add running values, the row number and values of the previous row, per ``keys`` in ``order``.

    ``order`` must be a total order inside a group for ``number`` and ``previous`` to be repeatable. With
    ``keys=[]`` the whole table is one group. ``split`` is a number that never falls along ``order``, for callers
    that know how to cut their groups; then nothing is counted or written.
    """
    running = dict(running or {})
    previous = dict(previous or {})
    columns = df.columns
    if number:
        running[number] = Running("count", F.lit(1))
    parts = (df.withColumn("_split", split), None) if split is not None else cut(df, keys, order, rows_per_split)
    group, rest = list(keys), None
    if parts is not None:
        (df, rest), group = parts, [*keys, "_split"]
    sorting = [F.col(o).desc() if descending else F.col(o).asc() for o in order]
    window = Window.partitionBy(*(group or [F.lit(0)])).orderBy(*sorting)
    local = df.select(
        "*",
        *[r.over(window).alias(f"_r_{n}") for n, r in running.items()],
        *[F.lag(F.struct(F.col(c).alias("v"))).over(window).alias(f"_p_{n}") for n, c in previous.items()],
    )
    if parts is None:
        return local.select(
            *columns,
            *[F.col(f"_r_{n}").alias(n) for n in running],
            *[F.col(f"_p_{n}").getField("v").alias(n) for n in previous],
        )
    last = F.min_by if descending else F.max_by
    totals = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[r.total().alias(f"_t_{n}") for n, r in running.items()],
        *[last(F.struct(F.col(c).alias("v")), F.struct(*order)).alias(f"_l_{n}") for n, c in previous.items()],
    )
    along = F.col("_split").desc() if descending else F.col("_split").asc()
    between = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(along)
    before = between.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *[F.col(g).alias(f"_c_{g}") for g in group],
        F.lag("_rows").over(between).alias("_before"),
        *[getattr(F, r.merge_fn())(f"_t_{n}").over(before).alias(f"_c_r_{n}") for n, r in running.items()],
        *[F.lag(f"_l_{n}").over(between).alias(f"_c_p_{n}") for n in previous],
    ).filter(F.col("_before").isNotNull())  # the first range of a group has nothing before it
    condition = F.lit(True)
    for g in group:
        condition = condition & local[g].eqNullSafe(carried[f"_c_{g}"])
    joined = local.join(carried, condition, "left")
    result = joined.select(
        *columns,
        *[r.merge(F.col(f"_r_{n}"), F.col(f"_c_r_{n}")).alias(n) for n, r in running.items()],
        *[F.coalesce(f"_p_{n}", f"_c_p_{n}").getField("v").alias(n) for n in previous],
    )
    if rest is None or not keys:
        return result
    window = Window.partitionBy(*keys).orderBy(*sorting)
    return result.unionByName(rest.select(
        *columns,
        *[r.over(window).alias(n) for n, r in running.items()],
        *[F.lag(F.struct(F.col(c).alias("v"))).over(window).getField("v").alias(n) for n, c in previous.items()],
    ))


def global_rank(df: DataFrame, order: list[str], name: str = "rank", ranges: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """1-based position of every row in ``order`` over the whole table, without a one-task sort.

    The table is range-partitioned, sorted and written once with the position of each row in its range; the number of rows
    in earlier ranges, one value per range, is added on reading. ``ranges`` is that of the session's shuffles by default. Only
    the columns ``keep`` are written and returned, all by default.
    """
    kept = keep or df.columns
    ranged = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    # the upper bits of this id are the number of the range, the lower 33 the position in it
    ranged = materialize(ranged.sortWithinPartitions(*order).select(*kept, F.monotonically_increasing_id().alias("_at")), "ranked")
    number, position = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    block = F.floor(F.col("_range") / RANGES_PER_BLOCK)
    sizes = ranged.groupBy(number.alias("_range")).agg(F.count(F.lit(1)).alias("_size")).withColumn("_block", block)
    within = Window.partitionBy("_block").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(F.lit(0)).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sizes.groupBy("_block").agg(F.sum("_size").alias("_whole")).select(F.col("_block").alias("_b"), F.sum("_whole").over(across).alias("_ahead"))
    offsets = sizes.withColumn("_near", F.sum("_size").over(within)).join(blocks, F.col("_block") == F.col("_b")).select(
        "_range", (F.coalesce("_near", F.lit(0)) + F.coalesce("_ahead", F.lit(0))).alias("_before"))
    # one row per range: broadcast, as a shuffle by it would move every row once more
    joined = ranged.join(F.broadcast(offsets), number == F.col("_range"))
    return joined.select(*kept, (F.col("_before") + position + 1).alias(name))


#: Keys are counted by so many buckets of their hash to find those that may be too many rows for a task.
KEY_BUCKETS = 65_536


def with_key_values(df: DataFrame, key: str, values: dict[str, Column], counted: DataFrame | None = None, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """``df`` with aggregates over all rows of the same ``key`` (``values``, by name): rows are shuffled once, with no other copy of them.

    Buckets of keys with more than ``rows_per_split`` rows are aggregated and looked up instead, so that no task gets all rows of a key;
    rows without a key have NULLs there. ``counted`` has the same keys as ``df`` where that is dear to compute.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS))
    counts = (df if counted is None else counted).filter(F.col(key).isNotNull()).groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
    hot = [row["_bucket"] for row in counts.filter(F.col("_rows") > rows_per_split).select("_bucket").collect()]
    # rows without a key are told apart, so that they do not meet in one task either
    own = Window.partitionBy(key, F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
    if not hot:
        return df.select("*", *[v.over(own).alias(n) for n, v in values.items()])
    df = materialize(df, "keyed")
    large = bucket.isin(hot) & F.col(key).isNotNull()
    found = df.filter(large).groupBy(F.col(key).alias("_key")).agg(*[v.alias(n) for n, v in values.items()])
    looked_up = df.filter(large).join(found, F.col(key) == F.col("_key")).drop("_key")
    return looked_up.unionByName(df.filter(~large).select("*", *[v.over(own).alias(n) for n, v in values.items()]))


def seq_split(rows_per_split: int, seq: str = "seq") -> Column:
    """Ranges of a whole-number order that is dense inside a group: none holds more than ``rows_per_split`` rows of it."""
    return F.floor(F.col(seq) / F.lit(rows_per_split))
