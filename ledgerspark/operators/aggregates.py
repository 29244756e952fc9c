"""Grouped reports. Each is one partial and one final aggregation, so a hot group is combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.scalars import percent_of
from ledgerspark.operators.scans import ROWS_PER_SPLIT, Running, ordered_scan

# fixed values: upper bounds in milliseconds of the latency histogram
LATENCY_BOUNDS = [1, 2, 5, 10, 20, 50, 100, 200, 500, 1000]


def group_count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"))


def share_of_total(df: DataFrame, keys: list[str], value: Column, name: str, digits: int) -> DataFrame:
    """Value per group and its percentage of all; the total is a scalar subquery over the grouped rows."""
    groups = df.groupBy(*keys).agg(value.alias(name))
    total = groups.agg(F.sum(name)).scalar()
    return groups.withColumn("percent", percent_of(F.col(name), total, digits))


def filtered_aggregates(payments: DataFrame, group: str = "account_id") -> DataFrame:
    """Counts per status and the completed sum of each group in one pass."""

    def of(status: str) -> Column:
        return F.col("status") == status

    return payments.groupBy(group).agg(
        F.count(F.lit(1)).alias("payments_total"),
        F.count_if(of("COMPLETED")).alias("completed"),
        F.count_if(of("PENDING")).alias("pending"),
        F.count_if(of("FAILED")).alias("failed"),
        F.sum(F.when(of("COMPLETED"), F.col("amount_minor"))).alias("completed_minor"),
    )


def having_turnover(payments: DataFrame, above_minor: int) -> DataFrame:
    groups = payments.filter(F.col("status") == "COMPLETED").groupBy("account_id")
    turnover = groups.agg(F.count(F.lit(1)).alias("completed_count"), F.sum("amount_minor").alias("turnover_minor"))
    return turnover.filter(F.col("turnover_minor") > above_minor)


def monthly_rollup(payments: DataFrame) -> DataFrame:
    return payments.groupBy(F.date_trunc("month", "created_at").cast("timestamp_ntz").alias("month")).agg(
        F.count(F.lit(1)).alias("payments"),
        F.sum(F.when(F.col("status") == "COMPLETED", F.col("amount_minor"))).alias("completed_minor"),
    )


def daily_totals(payments: DataFrame) -> DataFrame:
    """Completed sum per account and day; filter on ``account_id`` for one account."""
    done = payments.filter(F.col("status") == "COMPLETED")
    return done.groupBy("account_id", F.to_date("created_at").alias("day")).agg(F.sum("amount_minor").alias("total"))


def global_aggregate(df: DataFrame, condition: Column, value: str) -> DataFrame:
    return df.filter(condition).agg(F.count(F.lit(1)).alias("total"), F.sum(value).alias("amount"))


def count_semantics(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """All rows, rows with a value, different values."""
    distinct = F.approx_count_distinct(column) if approximate else F.count_distinct(F.col(column))
    return df.agg(F.count(F.lit(1)).alias("all_rows"), F.count(column).alias("with_value"), distinct.alias("different"))


def duplicate_groups(df: DataFrame, keys: list[Column], name: str = "copies") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def unbalanced_groups(entries: DataFrame, key: str) -> DataFrame:
    """Transfers whose entries do not sum to zero."""
    sums = entries.groupBy(key).agg(F.count(F.lit(1)).alias("entries"), F.sum("amount_minor").alias("imbalance"))
    return sums.filter(F.col("imbalance") != 0)


def latency_histogram(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Rows per latency bucket. Bucket counts of several tables or days add up; percentiles of them would not."""
    bound = F.lit(None).cast("bigint")
    for upper in reversed(LATENCY_BOUNDS):
        bound = F.when(F.col(value) <= upper, F.lit(upper).cast("bigint")).otherwise(bound)
    return df.groupBy(*keys, bound.alias("le")).agg(F.count(F.lit(1)).alias("requests"))


PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def latency_percentiles(df: DataFrame, value: str, *keys: str, exact: bool = False, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """p50, p95 and p99, a bounded sketch per group; ``exact`` interpolates between the two values around the place.

    The exact way counts each value of a group, runs over the counts in ranges (so no buffer holds a group), and looks
    up the values at the wanted places.
    """
    if not exact:
        return df.groupBy(*keys).agg(*[F.percentile_approx(value, p, 10000).alias(n) for n, p in PERCENTILES.items()])
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    scanned = ordered_scan(counts, list(keys), ["_v"], running={"_seen": Running("sum", "_n")}, rows_per_split=rows_per_split)
    whole = counts.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.sum("_n").alias("_all"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = scanned.join(whole, same) if keys else scanned.withColumn("_all", counts.agg(F.sum("_n")).scalar())
    places = {n: (F.col("_all") - 1) * p for n, p in PERCENTILES.items()}
    found = joined.groupBy(*keys).agg(
        F.max("_all").alias("_all"),
        *[F.min(F.when(F.col("_seen") > f(place), F.col("_v"))).alias(f"_{n}_{end}")
          for n, place in places.items() for end, f in (("low", F.floor), ("high", F.ceil))],
    )
    between = [(F.col(f"_{n}_low") + (F.col(f"_{n}_high") - F.col(f"_{n}_low")) * (place - F.floor(place))).alias(n) for n, place in places.items()]
    return found.select(*keys, *between)


def histogram_quantile(histogram: DataFrame, quantile: float, *keys: str) -> DataFrame:
    """Smallest bucket bound that holds ``quantile`` of the requests, from the few bucket rows of each key.

    NULL means above the largest bound.
    """
    totals = histogram.groupBy(*keys).agg(
        F.sum("requests").alias("_all"),
        F.array_sort(F.collect_list(F.struct(F.coalesce("le", F.lit(2**62)).alias("le"), "requests"))).alias("_buckets"),
    )
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("le"))

    def step(state: Column, bucket: Column) -> Column:
        seen = state["seen"] + bucket["requests"]
        reached = (seen >= F.col("_all") * quantile) & state["le"].isNull()
        return F.struct(seen.alias("seen"), F.when(reached, bucket["le"]).otherwise(state["le"]).alias("le"))

    found = F.aggregate("_buckets", start, step)["le"]
    return totals.select(*keys, F.nullif(found, F.lit(2**62)).alias("le"))


def pipelined_ratio(df: DataFrame, part: Column, whole: Column, digits: int, *keys: str) -> DataFrame:
    """Percentage of two sums per group, NULL where the whole is zero."""
    return df.groupBy(*keys).agg(percent_of(F.sum(part), F.sum(whole), digits).alias("percent"))


def selectivity_report(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """Share of all rows per predicate, in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("_all"), *[F.count_if(p).alias(n) for n, p in predicates.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("predicate"), F.col(n).alias("matching")) for n in predicates])
    return counts.select(F.explode(rows).alias("r"), "_all").select(
        "r.predicate", "r.matching", percent_of(F.col("r.matching"), F.col("_all"), 4).alias("percent")
    )
