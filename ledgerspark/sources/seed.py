"""Generated rows. Draws are hashes of the row's own id, so any task that is run again draws the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def draw(bound: int, salt: str, *row: str) -> Column:
    """Uniform whole number in [0, bound)."""
    return F.pmod(F.xxhash64(F.lit(salt), *row), F.lit(bound))


def pick(values: list[str], index: Column) -> Column:
    """Element of a list by 0-based index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def pick_rounded(values: list[str], salt: str, *row: str) -> Column:
    """Pick with an index that is rounded, not cut: the first and last value get half the share of the others."""
    steps = len(values) - 1
    unit = draw(1_000_000, salt, *row) / F.lit(1_000_000.0)
    return pick(values, F.round(unit * steps))


def cross_generate(parents: DataFrame, per_parent: int, name: str = "n") -> DataFrame:
    """``per_parent`` rows for each row, numbered from 1; rows multiply in place, without a join."""
    return parents.withColumn(name, F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(per_parent).cast("bigint"))))


def generate_seed(
    ids: DataFrame, key: str, as_of: Column, statuses: list[str], rare_status: str | None = None,
    accounts: int = 10_000, max_minor: int = 100_000, max_days: int = 365,
) -> DataFrame:
    """A payment per id: account, status, amount and age drawn from the id.

    With ``rare_status`` two in a hundred rows get it and the rest the first of ``statuses``; otherwise the
    statuses are spread evenly.
    """
    even = pick(statuses, draw(len(statuses), "status", key))
    status = even if rare_status is None else F.when(draw(100, "rare", key) < 2, rare_status).otherwise(statuses[0])
    return ids.select(
        F.col(key).alias("id"),
        (draw(accounts, "account", key) + 1).alias("account_id"),
        (draw(max_minor, "amount", key) + 100).alias("amount_minor"),
        status.alias("status"),
        (as_of - F.make_dt_interval(secs=draw(max_days * 86400, "age", key))).alias("created_at"),
    )


def modular_seed(ids: DataFrame, key: str, as_of: Column, statuses: list[str], accounts: int) -> DataFrame:
    """The repeatable variant by remainders of the id."""
    i = F.col(key)
    return ids.select(
        i.alias("id"),
        F.lpad((i % accounts).cast("string"), 12, "0").alias("account_id"),
        (100 + i % 90_000).alias("amount_minor"),
        pick(statuses, i % len(statuses)).alias("status"),
        (as_of - F.make_dt_interval(secs=i % 15_552_000)).alias("created_at"),
    )


def append_json_log(ids: DataFrame, key: str, start: Column, step_seconds: int) -> DataFrame:
    """Append-only log in time order with a JSON document per row."""
    n = F.col(key)
    document = F.struct(
        pick(["web", "ios", "android"], n % 3).alias("channel"),
        F.when(n % 3 == 0, F.array(F.lit("retry")))
        .when(n % 3 == 1, F.array(F.lit("manual"), F.lit("review")))
        .otherwise(F.array().cast("array<string>"))
        .alias("tags"),
        F.concat(F.lit("m-"), n % 977).alias("merchant"),
    )
    return ids.select(
        n.alias("id"),
        F.concat(F.lit("User-"), n % 5000 + 1, F.lit("@Example.TEST")).alias("email"),
        F.to_json(document).alias("metadata"),
        (start + F.make_dt_interval(secs=n * step_seconds)).alias("created_at"),
    )
