"""Values along the order of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.scans import ROWS_PER_SPLIT, Running, ordered_scan

ORDER = ["created_at", "id"]


def running_total(entries: DataFrame, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Sum of the entries of an account up to and with each entry."""
    total = {"running_total": Running("sum", "amount_minor")}
    return ordered_scan(entries, ["account_id"], ORDER, running=total, rows_per_split=rows_per_split)


def latest_per_group(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The last row of each group. An aggregate keeps one candidate per group and task, so nothing is sorted
    and a hot group costs no more than any other."""
    rest = [c for c in df.columns if c != group]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return df.groupBy(group).agg(last).select(group, "_last.*")


def gap_to_previous(payments: DataFrame, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Seconds since the previous payment of the account, NULL for the first."""
    scanned = ordered_scan(
        payments, ["account_id"], ORDER, previous={"_before": "created_at"}, rows_per_split=rows_per_split
    )
    return scanned.withColumn("gap_seconds", F.timestamp_diff("SECOND", F.col("_before"), F.col("created_at"))).drop("_before")


def changed_since_previous(
    df: DataFrame, keys: list[str], order: list[str], value: str, rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Whether the value differs from the row before; false for the first row."""
    scanned = ordered_scan(df, keys, order, previous={"_before": value}, rows_per_split=rows_per_split)
    return scanned.withColumn("changed", F.coalesce(F.col(value) != F.col("_before"), F.lit(False))).drop("_before")


def row_numbers_desc(entries: DataFrame, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Running total upwards and row number from the newest entry down, from a single ordering of the rows."""
    scanned = ordered_scan(
        entries, ["account_id"], ORDER, running={"running_total": Running("sum", "amount_minor")}, number="_up",
        rows_per_split=rows_per_split,
    )
    sizes = entries.groupBy(F.col("account_id").alias("_account")).agg(F.count(F.lit(1)).alias("_size"))
    joined = scanned.join(sizes, F.col("account_id") == F.col("_account"))
    return joined.withColumn("rn", F.col("_size") - F.col("_up") + 1).drop("_size", "_up", "_account")
