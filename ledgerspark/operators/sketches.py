"""Stored sketches that merge: percentiles per key and day, and column profiles per file set.

A report over any period, or over a table that has grown, is made from a few stored rows; neither the rows of the period nor those
of the table are read again. Sketches of a batch that comes later are appended as more rows of the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.functions.scalars import percent_of

#: Size of a KLL sketch; the place of a percentile is off by less than ``RANK_ERROR`` of the rows.
KLL_SIZE, RANK_ERROR = 800, 0.01
#: log2 of the registers of an HLL sketch; counts of different values are off by less than ``COUNT_ERROR``, more than three standard errors.
HLL_BITS, COUNT_ERROR = 14, 0.03


def daily_sketches(df: DataFrame, value: str, at: str, *keys: str) -> DataFrame:
    """(keys, day, rows, sketch): one KLL sketch of ``value`` per key and day. NULL values do not count."""
    day = F.to_date(F.col(at)).alias("day")
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, day).agg(
        F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_double(F.col(value).cast("double"), KLL_SIZE).alias("sketch"))


def merged_percentiles(sketches: DataFrame, percentiles: dict[str, float], *keys: str, condition: Column | None = None) -> DataFrame:
    """(keys, rows, one column per percentile) of all sketches, or of the days that meet ``condition``."""
    chosen = sketches if condition is None else sketches.filter(condition)
    merged = chosen.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch", KLL_SIZE).alias("_sketch"))
    found = [F.kll_sketch_get_quantile_double("_sketch", F.lit(float(p))).alias(name) for name, p in percentiles.items()]
    return merged.select(*keys, "rows", *found)


def rank_errors(df: DataFrame, value: str, estimates: DataFrame, percentiles: dict[str, float], *keys: str) -> DataFrame:
    """(keys, one column per percentile): how far each estimate's place among the rows is from the wanted one, 0 where it holds it."""
    known = estimates.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(n).alias(f"_e_{n}") for n in percentiles])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = df.filter(F.col(value).isNotNull()).join(known, same)
    counts = joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(value) < F.col(f"_e_{n}")).alias(f"_b_{n}") for n in percentiles],
        *[F.count_if(F.col(value) <= F.col(f"_e_{n}")).alias(f"_u_{n}") for n in percentiles])
    off = [F.greatest(F.col(f"_b_{n}") / F.col("_n") - p, p - F.col(f"_u_{n}") / F.col("_n"), F.lit(0.0)).alias(n) for n, p in percentiles.items()]
    return counts.select(*keys, *off)


def _countable(df: DataFrame, column: str) -> Column:
    """A column as a type that sketches take; equal values stay equal."""
    plain = isinstance(df.schema[column].dataType, (T.IntegerType, T.LongType, T.StringType, T.BinaryType))
    return F.col(column) if plain else F.col(column).cast("string")


def column_sketches(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row with what a profile needs of every column (or the given ones): rows, values, smallest, largest and an HLL sketch,
    in one pass. Rows of several batches are kept in one table."""
    columns = columns or df.columns
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.struct(
            F.count(c).alias("with_value"), F.min(c).alias("smallest"), F.max(c).alias("largest"),
            F.hll_sketch_agg(_countable(df, c), HLL_BITS).alias("sketch")).alias(c) for c in columns])


def profile(sketches: DataFrame) -> DataFrame:
    """(column, rows, null_pct, different, smallest, largest) of everything that was sketched; ``different`` is an estimate."""
    columns = [c for c in sketches.columns if c != "rows"]
    merged = sketches.agg(F.sum("rows").alias("rows"), *[
        F.struct(
            F.sum(F.col(c)["with_value"]).alias("with_value"), F.min(F.col(c)["smallest"]).cast("string").alias("smallest"),
            F.max(F.col(c)["largest"]).cast("string").alias("largest"), F.hll_union_agg(F.col(c)["sketch"]).alias("sketch")).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col("rows"), *[F.col(c)[f].alias(f) for f in ("with_value", "smallest", "largest", "sketch")]) for c in columns])
    listed = merged.select(F.explode(rows).alias("p")).select("p.*")
    return listed.select(
        "column", "rows", percent_of(F.col("rows") - F.col("with_value"), F.col("rows"), 4).alias("null_pct"),
        F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("different"), "smallest", "largest")


def key_sketches(df: DataFrame, key: str, *groups: str) -> DataFrame:
    """(groups, keys): a theta sketch of the different keys of each group, for unions and overlaps."""
    return df.groupBy(*groups).agg(F.theta_sketch_agg(_countable(df, key), HLL_BITS).alias("keys"))


def overlap(sketches: DataFrame, group: str, first, second) -> DataFrame:
    """(in_first, in_second, in_both, in_any) of two groups of ``key_sketches``, each merged from all its rows; estimates."""
    def merged(value):
        return F.theta_union_agg(F.when(F.col(group) == F.lit(value), F.col("keys")), HLL_BITS)

    both = sketches.agg(merged(first).alias("a"), merged(second).alias("b"))
    count = F.theta_sketch_estimate
    return both.select(
        count("a").alias("in_first"), count("b").alias("in_second"),
        count(F.theta_intersection("a", "b")).alias("in_both"), count(F.theta_union("a", "b")).alias("in_any"))
