"""Joins. Sides are aggregated before they meet, so no join multiplies rows; sizes and skew are left to AQE."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.ledger import ledger_sums
from ledgerspark.operators.scans import ROWS_PER_SPLIT, Running, ordered_scan


def join_inner_3way(users: DataFrame, accounts: DataFrame, payments: DataFrame) -> DataFrame:
    """Every payment with its account's currency and its owner's email."""
    u = users.select(F.col("id").alias("_user"), "email")
    a = accounts.select(F.col("id").alias("_account"), "owner_id", "currency")
    owned = a.join(u, F.col("owner_id") == F.col("_user")).select("_account", "currency", "email")
    return payments.join(owned, F.col("account_id") == F.col("_account")).select(
        "id", "email", "currency", "amount_minor", "status", "created_at"
    )


def with_ledger_balance(accounts: DataFrame, entries: DataFrame) -> DataFrame:
    """Accounts with the sum of their entries, zero where there are none."""
    sums = ledger_sums(entries).withColumnRenamed("account_id", "_account")
    joined = accounts.join(sums, accounts["id"] == sums["_account"], "left").drop("_account")
    return joined.withColumn("ledger_balance", F.coalesce("ledger_balance", F.lit(0).cast("bigint")))


def account_snapshot(accounts: DataFrame, entries: DataFrame, payments: DataFrame) -> DataFrame:
    """Stored balance, ledger balance and number of payments per account; filter on ``id`` for one account."""
    counts = payments.groupBy(F.col("account_id").alias("_payer")).agg(F.count(F.lit(1)).alias("payment_count"))
    joined = with_ledger_balance(accounts, entries).join(counts, F.col("id") == F.col("_payer"), "left")
    return joined.select(
        "id",
        F.col("balance_minor").alias("stored_balance"),
        "ledger_balance",
        F.coalesce("payment_count", F.lit(0).cast("bigint")).alias("payment_count"),
    )


def anti_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` without a partner."""
    return left.join(right.select(F.col(right_key).alias("_key")), F.col(left_key) == F.col("_key"), "left_anti")


def lateral_unnest_join(df: DataFrame, key: str, partners: str, keep: list[str]) -> DataFrame:
    """Each element of an array column, joined back to the row of that key (columns prefixed ``other_``)."""
    pairs = df.select(key, *keep, F.explode(partners).alias("other_key"))
    other = df.select(F.col(key).alias("_other"), *[F.col(c).alias(f"other_{c}") for c in keep])
    return pairs.join(other, F.col("other_key") == F.col("_other")).drop("_other")


def left_join_condition(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, condition: Column, keep: list[str]
) -> DataFrame:
    """Left join with a condition on the right side; rows of ``left`` without a match stay."""
    chosen = right.filter(condition).select(F.col(right_key).alias("_key"), *keep)
    return left.join(chosen, F.col(left_key) == F.col("_key"), "left").drop("_key")


def join_fetch(
    parents: DataFrame,
    children: DataFrame,
    child_key: str,
    order: list[str],
    fields: list[str],
    chunk: int = 1000,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Parents with their children as sorted arrays of at most ``chunk`` elements: one row per parent and chunk.

    A parent with few children gives one row (chunk 0), one without children an empty array; a parent with
    very many gives many rows instead of one array that no task could hold.
    """
    numbered = ordered_scan(
        children.select(child_key, *dict.fromkeys([*order, *fields])), [child_key], order, number="_n",
        rows_per_split=rows_per_split,
    )
    packed = (
        numbered.withColumn("chunk", F.floor((F.col("_n") - 1) / chunk))
        .groupBy(F.col(child_key).alias("_parent"), "chunk")
        .agg(F.array_sort(F.collect_list(F.struct("_n", *fields))).alias("_children"))
        .withColumn("children", F.transform("_children", lambda c: F.struct(*[c[f].alias(f) for f in fields])))
        .drop("_children")
    )
    joined = parents.join(packed, F.col("id") == F.col("_parent"), "left").drop("_parent")
    none = F.array().cast(packed.schema["children"].dataType)
    return joined.withColumn("chunk", F.coalesce("chunk", F.lit(0).cast("bigint"))).withColumn(
        "children", F.coalesce("children", none)
    )


def join_fetch_rows(
    parents: DataFrame, children: DataFrame, child_key: str, order: list[str], fields: list[str], rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Parents with their children, one row each: ``position`` counts a parent's children in ``order``. A parent without
    children has one row with NULLs; no parent is too large for a task, whatever the number of its children."""
    numbered = ordered_scan(
        children.select(child_key, *dict.fromkeys([*order, *fields])), [child_key], order, number="position", rows_per_split=rows_per_split)
    listed = numbered.select(F.col(child_key).alias("_parent"), "position", F.struct(*fields).alias("child"))
    return parents.join(listed, F.col("id") == F.col("_parent"), "left").drop("_parent")


LEVEL_GROWTH = 16


def overlap_join(
    left: DataFrame, right: DataFrame, keys: list[str], start: str, end: str, bucket_seconds: int
) -> DataFrame:
    """Pairs of half-open periods of one key that overlap, as structs ``l`` and ``r``.

    Both sides are cut into time buckets, so the equi-join spreads a hot key over its buckets and only compares
    neighbours in time; a pair is given in the bucket where its overlap begins, so it appears once. A period
    longer than a bucket belongs to a level of larger buckets, so that it falls in two at most, and meets shorter
    ones there. At each level the left periods of that level meet all right ones up to it (``_side`` 0), and the shorter left
    ones only the right ones of that level (``_side`` 1), so short periods never meet in large buckets.
    """
    seconds = _epoch(F.col(end)) - _epoch(F.col(start))
    level = F.greatest(F.ceil(F.log(float(LEVEL_GROWTH), seconds / bucket_seconds)), F.lit(0))
    lhs, rhs = (
        df.filter(F.col(start) < F.col(end)).select(*[F.col(c).alias(f"_{n}_{c}") for c in df.columns], level.alias(f"_{n}_own"))
        for df, n in ((left, "l"), (right, "r"))
    )
    # a handful of numbers: each level is sixteen times as long as the one before
    of_left, of_right = ({int(row["m"]) for row in df.select(F.col(f"_{n}_own").alias("m")).distinct().collect()} for df, n in ((lhs, "l"), (rhs, "r")))

    def buckets(df: DataFrame, name: str) -> DataFrame:
        parts = []
        for m in sorted(of_left | of_right):
            width = bucket_seconds * LEVEL_GROWTH**m
            first = F.floor(_epoch(F.col(f"_{name}_{start}")) / width)
            last = F.floor((_epoch(F.col(f"_{name}_{end}")) - 1e-6) / width)
            own = F.col(f"_{name}_own")
            # 0 where no left period has this level, 1 where none has a lower one: nothing to meet there
            met = [m in of_left, any(x < m for x in of_left) and m in of_right]
            for side, of in enumerate((own == m, own < m) if name == "l" else (own <= m, own == m)):
                if met[side]:
                    # bucket, level (5 bits) and side (1) as one number: rows are shuffled as narrow as they can be
                    place = F.explode(F.transform(F.sequence(first, last), lambda b: b * 64 + (2 * m + side)))
                    parts.append(df.filter(of).select(*kept[name], place.alias(f"_{name}_place")))
        none = df.limit(0).select(*kept[name], F.lit(0).cast("bigint").alias(f"_{name}_place"))
        return reduce(DataFrame.unionByName, parts) if parts else none

    kept = {"l": [f"_l_{c}" for c in left.columns], "r": [f"_r_{c}" for c in right.columns]}
    condition = F.col("_l_place") == F.col("_r_place")
    for k in keys:
        condition = condition & (F.col(f"_l_{k}") == F.col(f"_r_{k}"))
    l_start, r_start = F.col(f"_l_{start}"), F.col(f"_r_{start}")
    bucket, level_of = F.shiftright("_l_place", 6), F.shiftright(F.col("_l_place").bitwiseAND(F.lit(63)), 1)
    width = F.lit(bucket_seconds) * F.pow(F.lit(float(LEVEL_GROWTH)), level_of)
    begin = F.floor(_epoch(F.greatest(l_start, r_start)) / width)
    overlaps = (l_start < F.col(f"_r_{end}")) & (r_start < F.col(f"_l_{end}")) & (begin == bucket)
    joined = buckets(lhs, "l").join(buckets(rhs, "r"), condition & overlaps)
    return joined.select(*[F.struct(*[F.col(f"_{n}_{c}").alias(c) for c in df.columns]).alias(n) for df, n in ((left, "l"), (right, "r"))])


def _epoch(at: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), at.cast("timestamp_ntz")) / 1e6


def range_overlap_join(periods: DataFrame, key: str, start: str, end: str, bucket_seconds: int = 86400) -> DataFrame:
    """Pairs of overlapping periods of one key, the smaller id first."""
    pairs = overlap_join(periods, periods, [key], start, end, bucket_seconds)
    return pairs.filter(F.col("l.id") < F.col("r.id")).select(
        F.col(f"l.{key}").alias(key), F.col("l.id").alias("left_id"), F.col("r.id").alias("right_id")
    )


def overlap_counts(periods: DataFrame, key: str, start: str, end: str, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """(id, overlaps): with how many other periods of its key each half-open period overlaps. ``id`` is unique.

    By a sweep over all starts and ends, without pairs: what overlaps a period has started before its end, and has not ended
    by its start. A period that is empty or lacks an end or a key overlaps nothing.
    """
    real = F.coalesce((F.col(start) < F.col(end)) & F.col(key).isNotNull(), F.lit(False))
    ends = F.array(
        F.struct(F.col(start).alias("at"), F.lit(1).alias("starts")), F.struct(F.col(end).alias("at"), F.lit(0).alias("starts")))
    marks = periods.filter(real).select("id", key, F.explode(ends).alias("_m")).select("id", key, "_m.at", "_m.starts")
    # at one time, ends come before starts: periods that only touch do not overlap
    swept = ordered_scan(marks, [key], ["at", "starts", "id"], rows_per_split=rows_per_split, running={
        "_started": Running("sum", "starts"), "_ended": Running("sum", 1 - F.col("starts"))})
    seen = F.when(F.col("starts") == 1, -F.col("_ended")).otherwise(F.col("_started"))
    counts = swept.groupBy("id").agg((F.sum(seen) - 1).alias("overlaps"))
    return counts.unionByName(periods.filter(~real).select("id", F.lit(0).cast("bigint").alias("overlaps")))


def overlaps_of(periods: DataFrame, named: DataFrame, key: str, start: str, end: str, bucket_seconds: int = 86400) -> DataFrame:
    """(key, id, other_id): the partners of the periods whose id is in ``named``, and of no others."""
    chosen = periods.join(named.select(F.col(named.columns[0]).alias("_id")), F.col("id") == F.col("_id"), "left_semi")
    pairs = overlap_join(chosen, periods, [key], start, end, bucket_seconds).filter(F.col("l.id") != F.col("r.id"))
    return pairs.select(F.col(f"l.{key}").alias(key), F.col("l.id").alias("id"), F.col("r.id").alias("other_id"))


def overlapping_periods(
    periods: DataFrame, key: str, start: str, end: str, rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Periods that begin before an earlier one of the same key has ended: one row each, however many they overlap."""
    scanned = ordered_scan(
        periods, [key], [start, "id"], running={"latest_end": Running("max", end, inclusive=False)},
        rows_per_split=rows_per_split,
    )
    return scanned.filter(F.col("latest_end") > F.col(start))
