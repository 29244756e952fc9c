"""Set-based writes: each takes the old table and gives the new one, to be published as its next version."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.scalars import normalized_email


def update_where(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """Set columns on the rows that meet the condition; NULL does not meet it."""
    return df.select(*[
        F.when(condition, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns
    ])


def state_transition(rows: DataFrame, requests: DataFrame, to: str, allowed_from: list[str]) -> tuple[DataFrame, DataFrame]:
    """New table and one outcome per requested id: APPLIED, REJECTED or NOT_FOUND."""
    state = rows.select(F.col("id").alias("_id"), F.col("status").alias("_status"))
    may = F.col("_status").isin([*allowed_from, to])
    outcomes = requests.join(state, F.col("id") == F.col("_id"), "left").select(
        *requests.columns, F.when(F.col("_id").isNull(), "NOT_FOUND").when(may, "APPLIED").otherwise("REJECTED").alias("outcome")
    )
    wanted = requests.select(F.col("id").alias("_wanted")).distinct()
    joined = rows.join(wanted, F.col("id") == F.col("_wanted"), "left")
    hit = F.col("_wanted").isNotNull() & F.col("status").isin(allowed_from)
    return update_where(joined, hit, status=F.lit(to)).drop("_wanted"), outcomes


def _first_per_key(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(seq)).alias("_row")).select(*keys, "_row.*")


def upsert(stored: DataFrame, new: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Rows of ``new`` replace stored rows of the same key; of several new ones the last by ``seq`` wins.

    One aggregation over both tables: each task keeps one candidate per key.
    """
    columns = stored.columns
    rest = [c for c in columns if c not in keys]
    both = stored.withColumn("_at", F.struct(F.lit(0).alias("new"), F.lit(0).cast("bigint").alias("seq"))).unionByName(
        new.select(*columns, F.struct(F.lit(1).alias("new"), F.col(seq).cast("bigint").alias("seq")).alias("_at"))
    )
    last = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_at").alias("_row"))
    return last.select(*keys, "_row.*").select(*columns)


def insert_ignore(stored: DataFrame, new: DataFrame, key: str, seq: str) -> DataFrame:
    """Rows that get inserted: the first per key by ``seq`` among keys not stored yet.

    The number of affected rows is the count of the result; all other rows of ``new`` are ignored.
    """
    taken = stored.select(F.col(key).alias("_taken"))
    fresh = new.join(taken, F.col(key) == F.col("_taken"), "left_anti")
    return _first_per_key(fresh, [key], seq).select(*new.columns)


def insert_checked(
    new: DataFrame, rules: dict[str, Column], parents: dict[str, tuple[str, DataFrame, str]] | None = None
) -> DataFrame:
    """``new`` with ``failed_rule``: the first rule a row breaks, NULL when it is accepted.

    A rule that is NULL passes, as a CHECK does. ``parents`` maps a rule name to (column, parent table, parent
    key); a NULL reference passes.
    """
    result, cases = new, []
    for i, (name, (column, parent, key)) in enumerate((parents or {}).items()):
        known = parent.select(F.col(key).alias(f"_parent{i}")).distinct()
        result = result.join(known, F.col(column) == F.col(f"_parent{i}"), "left")
        cases.append((name, F.col(f"_parent{i}").isNotNull() | F.col(column).isNull()))
    failed = F.lit(None).cast("string")
    for name, passes in reversed([*rules.items(), *cases]):
        failed = F.when(~passes, name).otherwise(failed)
    return result.select(*new.columns, failed.alias("failed_rule"))


def insert_unique_email(users: DataFrame, new: DataFrame, seq: str = "seq") -> DataFrame:
    """Registration requests with the normalised email and the outcome INSERTED or TAKEN, first come first served."""
    requests = new.withColumn("email", normalized_email("email"))
    taken = users.select(normalized_email("email").alias("_taken")).distinct()
    first = requests.groupBy(F.col("email").alias("_email")).agg(F.min(seq).alias("_first"))
    # the winner of an email is decided once per email, then looked up by each request
    winners = first.join(taken, F.col("_email") == F.col("_taken"), "left_anti")
    joined = requests.join(winners, F.col("email") == F.col("_email"), "left")
    won = F.coalesce(F.col(seq) == F.col("_first"), F.lit(False))
    return joined.select(*new.columns, F.when(won, "INSERTED").otherwise("TAKEN").alias("outcome"))


def delete_by_key(df: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Remaining rows, and one outcome per key: DELETED or NOT_FOUND."""
    wanted = keys.select(F.col(key).alias("_key")).distinct()
    remaining = df.join(wanted, F.col(key) == F.col("_key"), "left_anti")
    known = df.select(F.col(key)).distinct().withColumn("_known", F.lit(True))
    outcome = wanted.withColumnRenamed("_key", key).join(known, key, "left").select(
        key, F.when(F.col("_known"), "DELETED").otherwise("NOT_FOUND").alias("outcome")
    )
    return remaining, outcome


def purge_expired_keys(keys: DataFrame, as_of: dt.datetime, ttl_hours: int) -> DataFrame:
    """Keys that are at most ``ttl_hours`` old."""
    oldest = as_of - dt.timedelta(hours=ttl_hours)
    return keys.filter(F.col("created_at") >= F.lit(oldest).cast("timestamp_ntz"))
