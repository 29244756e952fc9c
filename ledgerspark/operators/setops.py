"""Comparing two versions of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that occur more often on one side, with the surplus: positive on the left, negative on the right.

    One aggregation over both tables instead of two ``exceptAll``.
    """
    columns = left.columns
    both = left.select("*", F.lit(1).alias("_n")).unionByName(right.select("*", F.lit(-1).alias("_n")))
    return both.groupBy(*columns).agg(F.sum("_n").alias("surplus")).filter(F.col("surplus") != 0)


def restore_check(source: DataFrame, copy: DataFrame, money: str) -> DataFrame:
    """Rows and money of a table and of its restored copy, side by side."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(money).alias("money")).withColumn("side", F.lit(name))

    both = side(source, "source").unionByName(side(copy, "copy"))

    def of(name: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col(column)))

    return both.agg(
        of("source", "rows").alias("source_rows"),
        of("copy", "rows").alias("copy_rows"),
        of("source", "money").alias("source_money"),
        of("copy", "money").alias("copy_money"),
    ).withColumn(
        "equal",
        F.col("source_rows").eqNullSafe(F.col("copy_rows")) & F.col("source_money").eqNullSafe(F.col("copy_money")),
    )
