"""Integrity rules as jobs. Each gives the violating rows; ``validate_all`` gives the number per rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.scalars import is_currency, is_request_name
from ledgerspark.operators.aggregates import duplicate_groups
from ledgerspark.operators.joins import anti_join, overlapping_periods, with_ledger_balance
from ledgerspark.sources.schemas import PAYMENT_STATUSES


def not_null(column: str) -> Column:
    return F.col(column).isNotNull()


def check_predicates(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations) for rules about single rows, all in one pass. A rule that is NULL passes."""
    counts = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def violating_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with the names of the broken ones."""
    broken = F.array_compact(F.array(*[F.when(~rule, name) for name, rule in rules.items()]))
    return df.withColumn("broken", broken).filter(F.size("broken") > 0)


def payment_rules() -> dict[str, Column]:
    return {
        "account_not_null": not_null("account_id"),
        "amount_positive": F.col("amount_minor") > 0,
        "status_known": F.col("status").isin(PAYMENT_STATUSES),
    }


def account_rules() -> dict[str, Column]:
    return {"currency_code": is_currency("currency"), "balance_not_negative": F.col("balance_minor") >= 0}


def transfer_rules() -> dict[str, Column]:
    return {
        "key_valid": is_request_name("idempotency_key"),
        "amount_positive": F.col("amount_minor") > 0,
        "accounts_differ": F.col("from_account") != F.col("to_account"),
    }


def ledger_rules() -> dict[str, Column]:
    return {"account_not_null": not_null("account_id"), "amount_not_zero": F.col("amount_minor") != 0}


def check_unique(df: DataFrame, keys: list[Column], where: Column | None = None) -> DataFrame:
    """Key values that occur more than once; NULLs never collide. ``where`` limits the rule to some rows."""
    rows = df if where is None else df.filter(where)
    named = [k.alias(f"key{i}") for i, k in enumerate(keys)]
    present = F.lit(True)
    for k in keys:
        present = present & k.isNotNull()
    return duplicate_groups(rows.filter(present), named)


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows that name a parent which does not exist; NULL passes."""
    return anti_join(child.filter(F.col(column).isNotNull()), parent, column, key)


check_no_overlap = overlapping_periods


def reconcile_drift(accounts: DataFrame, entries: DataFrame) -> DataFrame:
    """Accounts whose stored balance differs from the sum of their entries, the largest difference first."""
    both = with_ledger_balance(accounts, entries)
    drift = both.withColumn("drift_minor", F.col("balance_minor") - F.col("ledger_balance"))
    wrong = drift.filter(F.col("drift_minor") != 0).select("id", "balance_minor", "ledger_balance", "drift_minor")
    return wrong.orderBy(F.desc(F.abs("drift_minor")), "id")


def unposted_payments(payments: DataFrame, entries: DataFrame) -> DataFrame:
    """COMPLETED payments without an entry."""
    done = payments.filter(F.col("status") == "COMPLETED")
    return anti_join(done, entries.filter(F.col("payment_id").isNotNull()), "id", "payment_id")


def multi_key_payments(keys: DataFrame) -> DataFrame:
    """Payments that more than one idempotency key points to."""
    return duplicate_groups(keys.filter(F.col("payment_id").isNotNull()), [F.col("payment_id")], "keys_pointing_here")


def money_conserved(before: DataFrame, after: DataFrame, entries: DataFrame) -> DataFrame:
    """One row: total balances of two versions, sum of the entries between them, and whether they agree."""
    total = F.coalesce(F.sum("balance_minor"), F.lit(0)).cast("bigint")
    old = before.agg(total.alias("v")).scalar()
    moved = entries.agg(F.coalesce(F.sum("amount_minor"), F.lit(0)).cast("bigint").alias("v")).scalar()
    result = after.agg(total.alias("after_minor"))
    result = result.select(old.alias("before_minor"), "after_minor", moved.alias("entries_minor"))
    same = (F.col("before_minor") == F.col("after_minor")) & (F.col("entries_minor") == 0)
    return result.withColumn("conserved", same)


def ledger_append_only(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Entries of the older version that the newer one has changed or lost."""
    columns = older.columns
    digest = F.sha2(F.to_json(F.struct(*columns)), 256)
    known = newer.select(F.col("id").alias("_id"), digest.alias("_known"))
    same = (F.col("id") == F.col("_id")) & (F.col("_digest") == F.col("_known"))
    return older.withColumn("_digest", digest).join(known, same, "left_anti").select(*columns)


def validate_all(accounts: DataFrame, payments: DataFrame, entries: DataFrame, keys: DataFrame) -> DataFrame:
    """(rule, violations) of every rule of the payments model."""

    def named(prefix: str, df: DataFrame) -> DataFrame:
        return df.withColumn("rule", F.concat(F.lit(f"{prefix}."), "rule"))

    def rows(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("rule"), "violations")

    parts = [
        named("payments", check_predicates(payments, payment_rules())),
        named("accounts", check_predicates(accounts, account_rules())),
        named("ledger", check_predicates(entries, ledger_rules())),
        rows("accounts.owner_currency_unique", check_unique(accounts, [F.col("owner_id"), F.col("currency")])),
        rows("keys.key_unique", check_unique(keys, [F.col("key")])),
        rows("keys.payment_unique", multi_key_payments(keys)),
        rows("payments.account_exists", check_foreign_key(payments, "account_id", accounts, "id")),
        rows("ledger.account_exists", check_foreign_key(entries, "account_id", accounts, "id")),
        rows("ledger.payment_exists", check_foreign_key(entries, "payment_id", payments, "id")),
        rows("accounts.no_drift", reconcile_drift(accounts, entries)),
        rows("payments.posted", unposted_payments(payments, entries)),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
