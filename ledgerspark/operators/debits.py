"""Guarded debits: a debit applies only while the balance covers it, in the order of ``seq``.

Three exact ways, chosen per account by aggregates:

* the debits of the account together do not exceed its balance: all apply, nothing is ordered;
* otherwise, up to ``rows_per_split`` debits: one pass over the rows sorted by (account, seq), with only the
  balance of the current account in memory;
* above that: phases, each a distributed running sum. With T the balance at the start of a phase, debits of at
  most T/2 all apply until they have used up T/2, and the first larger debit that still fits ends the phase.
  Either way less than T/2 is left, so there are at most as many phases as the balance has bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.batches import extended, lists
from ledgerspark.operators.scans import ROWS_PER_SPLIT, Running, ordered_scan, seq_split
from ledgerspark.session import materialize


def guarded_debits(
    accounts: DataFrame, debits: DataFrame, rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """``debits`` (seq, account_id, amount_minor, ...) with ``outcome``: APPLIED, REJECTED, NOT_FOUND or INVALID."""
    columns = debits.columns
    known = accounts.select(F.col("id").alias("_id"), F.col("balance_minor").alias("_balance"))
    valid = F.col("amount_minor") > 0
    needs = debits.filter(valid).groupBy(F.col("account_id").alias("_payer")).agg(
        F.sum("amount_minor").alias("_needed"), F.count(F.lit(1)).alias("_debits")
    )
    # one row per account that has debits: the balance, what is asked of it, and how many debits it gets
    state = needs.join(known, F.col("_payer") == F.col("_id"), "left").drop("_id")
    joined = debits.join(state, (F.col("account_id") == F.col("_payer")) & valid, "left")
    way = (
        F.when(~F.coalesce(valid, F.lit(False)), "INVALID")
        .when(F.col("_balance").isNull(), "NOT_FOUND")
        .when(F.col("_needed") <= F.col("_balance"), "APPLIED")
        .when(F.col("_debits") <= rows_per_split, "fold")
        .otherwise("phases")
    )
    routed = joined.withColumn("outcome", way)
    fold = _fold(routed.filter(F.col("outcome") == "fold").select(*columns, "_balance"), columns)
    result = routed.filter(~F.col("outcome").isin("fold", "phases")).select(*columns, "outcome").unionByName(fold)
    if state.filter((F.col("_debits") > rows_per_split) & (F.col("_needed") > F.col("_balance"))).limit(1).count():
        hot = routed.filter(F.col("outcome") == "phases").select(*columns, "_balance")
        result = result.unionByName(_phases(hot, columns, rows_per_split))
    return result


def balances_after(accounts: DataFrame, outcomes: DataFrame) -> DataFrame:
    spent = outcomes.filter(F.col("outcome") == "APPLIED").groupBy(F.col("account_id").alias("_payer")).agg(
        F.sum("amount_minor").alias("_spent")
    )
    joined = accounts.join(spent, F.col("id") == F.col("_payer"), "left").drop("_payer")
    left = F.col("balance_minor") - F.coalesce("_spent", F.lit(0))
    return joined.withColumn("balance_minor", left).drop("_spent")


def _outcome(applies: Column) -> Column:
    return F.when(applies, "APPLIED").otherwise("REJECTED").alias("outcome")


def _fold(rows: DataFrame, columns: list[str]) -> DataFrame:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        account, balance = None, 0
        for batch in batches:
            applied = []
            for payer, amount, opening in zip(*lists(batch, "account_id", "amount_minor", "_balance"), strict=True):
                if payer != account:
                    account, balance = payer, opening
                fits = amount <= balance
                if fits:
                    balance -= amount
                applied.append(fits)
            yield extended(batch, columns, _applied=pa.array(applied, pa.bool_()))

    ordered = rows.repartition("account_id").sortWithinPartitions("account_id", "seq")
    schema = rows.select(*columns, F.lit(True).alias("_applied")).schema
    return ordered.mapInArrow(step, schema).select(*columns, _outcome(F.col("_applied")))


def _phases(rows: DataFrame, columns: list[str], rows_per_split: int) -> DataFrame:
    left = materialize(rows, "debits")
    # one row per hot account; each has more than rows_per_split debits, so the table is small
    state = materialize(left.groupBy(F.col("account_id").alias("_payer")).agg(F.max("_balance").alias("_now")), "state")
    amount, now, used, end = F.col("amount_minor"), F.col("_now"), F.col("_used"), F.col("_end")
    is_small = amount * 2 <= now
    done = []
    while True:
        with_state = left.select(*columns).join(state, F.col("account_id") == F.col("_payer")).drop("_payer")
        scanned = ordered_scan(
            with_state.withColumn("_small", F.when(is_small, amount).otherwise(0)), ["account_id"], ["seq"],
            running={"_used": Running("sum", "_small", inclusive=False)}, split=seq_split(rows_per_split),
        )
        scanned = materialize(scanned.withColumn("_used", F.coalesce(used, F.lit(0))), "phase")
        # the first row after which less than half of the balance is left
        ends = F.when(is_small, (used + amount) * 2 > now).otherwise(used + amount <= now)
        closing = scanned.filter(ends).groupBy(F.col("account_id").alias("_payer")).agg(
            F.min("seq").alias("_end"), F.min_by(now - used - amount, "seq").alias("_next")
        )
        closing = materialize(closing, "ends")
        marked = scanned.join(closing, F.col("account_id") == F.col("_payer"), "left").drop("_payer")
        # a debit above the balance is settled wherever it stands, since the balance never grows
        settled = end.isNull() | (F.col("seq") <= end) | (amount > now)
        applies = (is_small & (end.isNull() | (F.col("seq") <= end))) | F.coalesce(F.col("seq") == end, F.lit(False))
        done.append(marked.filter(settled).select(*columns, _outcome(applies)))
        left = marked.filter(~settled).select(*columns)
        sizes = left.groupBy(F.col("account_id").alias("_account")).agg(F.count(F.lit(1)).alias("_left"))
        balances = closing.select("_payer", F.col("_next").alias("_now"))
        state = materialize(balances.join(sizes, F.col("_payer") == F.col("_account")).drop("_account"), "state")
        # accounts with few open debits are finished in one pass
        few = state.filter(F.col("_left") <= rows_per_split).select("_payer", F.col("_now").alias("_balance"))
        rest = left.join(few, F.col("account_id") == F.col("_payer")).drop("_payer")
        done.append(_fold(rest, columns))
        state = state.filter(F.col("_left") > rows_per_split).drop("_left")
        if not state.limit(1).count():
            return reduce(DataFrame.unionByName, done)
