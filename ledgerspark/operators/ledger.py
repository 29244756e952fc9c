"""The immutable ledger and the balances projected from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.scalars import request_hash


def union_entries(*parts: DataFrame) -> DataFrame:
    """All entries of several sources with the same columns, matched by name."""
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def post_ledger(
    accounts: DataFrame, payments: DataFrame, opening_minor: int, opening_time: str | Column, key_shift: int
) -> DataFrame:
    """One opening entry per account and one negative entry per COMPLETED payment; other payments move no money.

    The entry id is derived from the source row, so a repeated run gives the same ids.
    """
    when = F.lit(opening_time).cast("timestamp_ntz") if isinstance(opening_time, str) else opening_time
    opening = accounts.select(
        "id",
        F.col("id").alias("account_id"),
        F.lit(None).cast("bigint").alias("payment_id"),
        F.lit(opening_minor).cast("bigint").alias("amount_minor"),
        when.alias("created_at"),
    )
    posted = payments.filter(F.col("status") == "COMPLETED").select(
        (F.col("id") + key_shift).alias("id"),
        "account_id",
        F.col("id").alias("payment_id"),
        (-F.col("amount_minor")).alias("amount_minor"),
        "created_at",
    )
    return union_entries(opening, posted)


def ledger_sums(entries: DataFrame) -> DataFrame:
    return entries.groupBy("account_id").agg(F.sum("amount_minor").alias("ledger_balance"))


def rebuild_projection(accounts: DataFrame, entries: DataFrame) -> DataFrame:
    """Balances recomputed from the entries; an account without entries keeps what it has."""
    sums = ledger_sums(entries).withColumnRenamed("account_id", "_account")
    joined = accounts.join(sums, accounts["id"] == sums["_account"], "left")
    balance = F.coalesce("ledger_balance", F.col("balance_minor").cast("bigint")).alias("balance_minor")
    return joined.select(*[balance if c == "balance_minor" else accounts[c] for c in accounts.columns])


def derive_request_keys(payments: DataFrame) -> DataFrame:
    """One idempotency key per payment that reached processing, with the hash of its payload."""
    return payments.filter(F.col("status") != "FAILED").select(
        F.concat(F.lit("seed-"), "id").alias("key"),
        request_hash("account_id", "amount_minor").alias("request_hash"),
        F.col("id").alias("payment_id"),
        "created_at",
    )


def compensate(entries: DataFrame, chosen: DataFrame, key_shift: int, when: Column) -> DataFrame:
    """Reversals: a new entry of opposite sign per chosen entry id, pointing at the original. Nothing is changed or removed."""
    picked = entries.join(chosen.select("id").distinct(), "id", "left_semi")
    return picked.select(
        (F.col("id") + key_shift).alias("id"),
        "account_id",
        "payment_id",
        (-F.col("amount_minor")).alias("amount_minor"),
        when.alias("created_at"),
        F.col("id").alias("reverses_id"),
    )


def append_audit(transfers: DataFrame, event_type: str = "TRANSFER_COMPLETED") -> DataFrame:
    """One audit row per applied transfer: who and what, no payload."""
    return transfers.select("actor", F.lit(event_type).alias("event_type"), F.col("transfer_id").alias("entity_id"))
