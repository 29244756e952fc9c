"""Idempotent transfers of a batch of requests, with the result of serial execution in the order of ``seq``.

Checks that need neither balances nor keys are joins. What is left is a fixpoint: a request is accepted when no
accepted request of the same key comes before it and the balance of its account, given the accepted requests
before it, covers the amount. Starting from "the first request of each key is accepted", every round decides all
requests anew from the decisions of the round before. A decision only depends on smaller ``seq``, so the right decisions grow from the
front, the fixpoint is unique, and it equals serial execution.

An account that has the money for all its debits without any credit is not ordered at all, and most requests of
such accounts are settled before the first round. For the others a round goes through each account's entries in order, so a chain of rejections inside one account is settled in
one round; only effects on other accounts take further rounds, and these only look at the accounts concerned.
An account with very many entries is cut into ranges of at most ``rows_per_split`` entries, which are followed side by
side, each from the balance that the decisions of the round before give it. A range is right one round after the ranges
before it at the latest, so the rounds grow with the ranges, not with the rows, of such an account. Every round is a
written table, so lineage stays short.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.batches import extended, lists
from ledgerspark.functions.scalars import is_request_name, stable_id
from ledgerspark.operators.scans import ROWS_PER_SPLIT, in_ranges, with_key_values
from ledgerspark.session import discard, materialize

PAYLOAD = ["from_account", "to_account", "amount_minor"]


def apply_transfers(
    accounts: DataFrame, stored: DataFrame, requests: DataFrame, rows_per_split: int = ROWS_PER_SPLIT, on_round=None
) -> DataFrame:
    """``requests`` with ``outcome``, ``reason`` and ``transfer_id``.

    COMPLETED moves money; REPLAY gives the id of the earlier transfer of that key; INVALID_REQUEST is a bad
    argument or a key used for another payload; OPERATION_REJECTED a missing account, another currency or too
    little money. A request that fails does not use up its key. ``on_round`` is told the number of changed
    decisions of each round, which is the number of rows that it writes.
    """
    judged = requests.withColumn("_valid", _valid())
    state = materialize(_account_states(accounts, judged, rows_per_split), "accounts")
    checked = with_key_values(_check(judged, state, stored), "idempotency_key", _of_key(), requests, rows_per_split)
    if not state.filter("NOT covered").limit(1).count():
        return _label(checked, None, requests.columns)  # every key is settled
    checked = materialize(checked, "requests")
    return _label(checked, _decide(checked, rows_per_split, on_round), requests.columns)


#: Changes of so many rounds are kept apart before they are written into one table with the requests.
FLIPS_FOLDED = 24

# What the rounds know about the two accounts of a request: the balance of the payer, whether it covers all debits of
# the batch without any credit, whether the payer has very many entries, and for the payee whether credits can matter.
FLAGS = ["opening", "covered", "hot", "matters", "to_hot"]


def _of_key() -> dict[str, Column]:
    """What a request knows of the candidates of its key: how many there are, whether the accounts of all are covered, and the first."""
    first = {f"_first_{c}": F.min_by(c, "_candidate") for c in PAYLOAD}
    return {"_uses": F.count("_candidate"), "_all_covered": F.bool_and("_candidate_covered"), "_first": F.min("_candidate"), **first}


def _account_states(accounts: DataFrame, requests: DataFrame, rows_per_split: int) -> DataFrame:
    """One row per account that the requests name and that exists."""
    debit = F.struct(F.col("from_account").alias("account"), F.col("amount_minor").alias("amount"))
    credit = F.struct(F.col("to_account").alias("account"), F.lit(None).cast("bigint").alias("amount"))
    sides = requests.filter("_valid").select(F.explode(F.array(debit, credit)).alias("s")).select("s.*")
    busy = sides.groupBy("account").agg(F.count(F.lit(1)).alias("_entries"), F.sum("amount").alias("_needed"))
    covered = F.coalesce(F.col("_needed") <= F.col("balance_minor"), F.lit(True))
    return busy.join(accounts.select("id", "currency", "balance_minor"), F.col("account") == F.col("id")).select(
        "account", "currency", F.col("balance_minor").alias("opening"), covered.alias("covered"),
        (~covered & (F.col("_entries") > rows_per_split)).alias("hot"),
    )


def _valid() -> Column:
    return (
        is_request_name("idempotency_key")
        & is_request_name("actor")
        & F.coalesce(F.col("amount_minor") > 0, F.lit(False))
        & F.coalesce(F.col("from_account") != F.col("to_account"), F.lit(False))
    )


def _check(judged: DataFrame, state: DataFrame, stored: DataFrame) -> DataFrame:
    payer = state.select(F.col("account").alias("_payer"), F.col("currency").alias("_c1"), "opening", "covered", "hot")
    payee = state.select(
        F.col("account").alias("_payee"), F.col("currency").alias("_c2"), (~F.col("covered")).alias("matters"),
        F.col("hot").alias("to_hot"),
    )
    known = stored.select(
        F.col("idempotency_key").alias("_key"), F.col("transfer_id").alias("_stored_id"), F.struct(*PAYLOAD).alias("_stored")
    )
    same_currency = F.coalesce(F.col("_c1") == F.col("_c2"), F.lit(False))
    return (
        judged.join(payer, F.col("from_account") == F.col("_payer"), "left")
        .join(payee, F.col("to_account") == F.col("_payee"), "left")
        .join(known, F.col("idempotency_key") == F.col("_key"), "left")
        .withColumn("_open", F.col("_valid") & F.col("_stored_id").isNull() & same_currency)
        .withColumn("_candidate", F.when(F.col("_open"), F.col("seq")))
        .withColumn("_candidate_covered", F.when(F.col("_open"), F.col("covered")))
        .drop("_payer", "_payee", "_key", "_c1", "_c2")
    )


def _decide(checked: DataFrame, rows_per_split: int, on_round=None) -> DataFrame | None:
    """The accepted candidates of the keys that are not settled from the start; None where there are no such keys.

    A key is settled when the accounts of all its candidates are covered: the first of them is accepted. Only the others go
    through the rounds.
    """
    first = F.col("_first") == F.col("seq")
    settled = checked.filter(F.col("_open") & F.col("_all_covered") & first)
    open_rows = checked.filter("_open AND NOT _all_covered").select(
        "seq", "idempotency_key", *PAYLOAD, *FLAGS, (F.col("_uses") > 1).alias("repeats"), first.alias("accept"), F.lit(True).alias("changed"))
    result = ["seq", "idempotency_key", *PAYLOAD]
    if not open_rows.limit(1).count():
        return None
    credits = settled.filter("matters").select("seq", "to_account", "amount_minor", "to_hot")
    any_hot = open_rows.filter("hot").limit(1).count() > 0
    ranges = _ranges(open_rows, credits, rows_per_split) if any_hot else None
    credits = materialize(_placed(credits, ranges, "to_account", "to_range"), "credits")
    base = _placed(_placed(open_rows, ranges, "from_account", "range"), ranges, "to_account", "to_range")
    base = materialize(base, "open") if any_hot else base
    flips, concerned, frontier = [], None, None
    while True:
        if len(flips) == FLIPS_FOLDED:
            state = materialize(_current(base, flips), "open")
            discard(base, *flips)
            base, flips = state, []
        changed = materialize(_round(base, flips, credits, concerned, frontier, any_hot), "round")
        discard(concerned)
        changes, first = changed.agg(F.count(F.lit(1)), F.min("seq")).first()
        if on_round:
            on_round(changes)
        if changes == 0:
            return _current(base, flips).filter("accept").select(*result)
        flips, frontier = [*flips, changed], first
        concerned = _concerned(base, changed)


def _current(base: DataFrame, flips: list[DataFrame]) -> DataFrame:
    """``base`` with the decisions turned round that changed an odd number of times since it was written."""
    if not flips:
        return base
    turned = reduce(DataFrame.unionByName, [f.select(F.col("seq").alias("_turned")) for f in flips])
    odd = turned.groupBy("_turned").agg(F.count(F.lit(1)).alias("_times")).filter("_times % 2 = 1")
    accept = F.col("accept") != F.col("_turned").isNotNull()
    return base.join(odd, F.col("seq") == F.col("_turned"), "left").select(*[accept.alias(c) if c == "accept" else c for c in base.columns])


def _ranges(open_rows: DataFrame, credits: DataFrame, rows_per_split: int) -> DataFrame:
    """(_account, _seq, _range) of all entries of accounts with very many of them; written, so that the cut never moves."""
    own = open_rows.filter("hot").select(F.col("from_account").alias("_account"), F.col("seq").alias("_seq"))
    incoming = open_rows.filter("matters").select(*credits.columns).unionByName(credits).filter("to_hot")
    entries = own.unionByName(incoming.select(F.col("to_account").alias("_account"), F.col("seq").alias("_seq")))
    return materialize(in_ranges(entries, entries.count(), ["_account", "_seq"], rows_per_split, "_range"), "ranges")


def _placed(rows: DataFrame, ranges: DataFrame | None, account: str, name: str) -> DataFrame:
    """``rows`` with the range of their entry of ``account``; 0 where the account is not cut."""
    if ranges is None:
        return rows.withColumn(name, F.lit(0).cast("bigint"))
    same = (F.col(account) == F.col("_account")) & (F.col("seq") == F.col("_seq"))
    return rows.join(ranges, same, "left").withColumn(name, F.coalesce("_range", F.lit(0).cast("bigint"))).drop("_account", "_seq", "_range")


def _concerned(base: DataFrame, changed: DataFrame) -> DataFrame:
    """Accounts whose decisions have to be taken again after the changes of the last round."""
    credited = changed.filter("matters").select(F.col("to_account").alias("_account"))
    itself = changed.filter("hot").select(F.col("from_account").alias("_account"))
    keys = changed.filter("repeats").select(F.col("idempotency_key").alias("_k")).distinct()
    same_key = base.filter("repeats").join(keys, F.col("idempotency_key") == F.col("_k"), "left_semi")
    parts = [credited, itself, same_key.select(F.col("from_account").alias("_account"))]
    return materialize(reduce(DataFrame.unionByName, parts).distinct(), "concerned")


def _before(debits: DataFrame, credits: DataFrame, frontier: int) -> DataFrame:
    """(_settled_account, _settled): what the decisions up to the frontier have moved on each account."""
    out = debits.filter((F.col("seq") <= frontier) & F.col("accept")).select(F.col("from_account").alias("_settled_account"), (-F.col("amount_minor")).alias("_moved"))
    into = credits.filter(F.col("seq") <= frontier).select(F.col("to_account").alias("_settled_account"), F.col("amount_minor").alias("_moved"))
    return out.unionByName(into).groupBy("_settled_account").agg(F.sum("_moved").alias("_settled"))


def _round(base: DataFrame, flips: list[DataFrame], settled: DataFrame, concerned: DataFrame | None, frontier: int | None, any_hot: bool) -> DataFrame:
    """The requests after the frontier, of the accounts concerned, whose decision changes. Rows of other accounts are left out
    before the decisions since ``base`` are looked up."""
    columns = base.columns
    debits, credits = base, base.filter("matters").select(*settled.columns, "accept")
    if concerned is not None:
        debits = base.join(concerned, F.col("from_account") == F.col("_account"), "left_semi")
        credits = credits.join(concerned, F.col("to_account") == F.col("_account"), "left_semi")
        settled = settled.join(concerned, F.col("to_account") == F.col("_account"), "left_semi")
    debits = _current(debits, flips)
    credits = _current(credits, flips).filter("accept").drop("accept").unionByName(settled)
    if concerned is not None:
        moved = _before(debits, credits, frontier)
        debits = debits.filter(F.col("seq") > frontier).join(moved, F.col("from_account") == F.col("_settled_account"), "left")
        opening = F.col("opening") + F.coalesce("_settled", F.lit(0))
        debits = debits.select(*[opening.alias(c) if c == "opening" else c for c in columns])
        credits = credits.filter(F.col("seq") > frontier)
    # the first accepted request of each repeated key; all other keys are free by definition
    uses = _current(base.filter("repeats").select("seq", "idempotency_key", "accept"), flips)
    first = uses.filter("accept").groupBy(F.col("idempotency_key").alias("_k")).agg(F.min("seq").alias("_first"))
    repeated = debits.filter("repeats").join(first, F.col("idempotency_key") == F.col("_k"), "left")
    free = F.coalesce(F.col("_first") >= F.col("seq"), F.lit(True)).alias("free")
    debits = debits.filter("NOT repeats").select(*columns, F.lit(True).alias("free")).unionByName(repeated.select(*columns, free))
    incoming = credits.select(
        "seq", F.col("to_account").alias("account"), F.col("amount_minor").alias("credit"), F.col("to_hot").alias("hot"), F.col("to_range").alias("range"))
    own = debits.select("*", F.col("from_account").alias("account"), F.lit(None).cast("bigint").alias("credit"))
    entries = own.filter("NOT covered").unionByName(incoming, allowMissingColumns=True)
    taken = _compared(own.filter("covered").withColumn("_new", F.col("free")), columns).unionByName(
        _in_order(_carried(entries) if any_hot else entries.withColumn("_carry", F.lit(0).cast("bigint")), columns))
    return taken.filter("changed")


def _carried(entries: DataFrame) -> DataFrame:
    """``entries`` with what earlier ranges of their account have moved, by the decisions of the round before."""
    value = F.coalesce("credit", F.when(F.col("accept"), -F.col("amount_minor")).otherwise(0))
    moved = entries.filter("hot").groupBy("account", "range").agg(F.sum(value).alias("_moved"))
    earlier = Window.partitionBy("account").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carry = moved.select(F.col("account").alias("_of"), F.col("range").alias("_at"), F.sum("_moved").over(earlier).alias("_carry")).filter("_carry IS NOT NULL")
    joined = entries.join(carry, F.col("hot") & (F.col("account") == F.col("_of")) & (F.col("range") == F.col("_at")), "left")
    return joined.drop("_of", "_at").withColumn("_carry", F.coalesce("_carry", F.lit(0).cast("bigint")))


def _in_order(entries: DataFrame, columns: list[str]) -> DataFrame:
    """Decide the debits of each account, or of each range of one, in order, with the credits of the round before."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, moved = None, 0
        for batch in batches:
            is_credit, accept = lists(batch, "_credit")[0], []
            for owner, part, credit, amount, opening, free in zip(
                *lists(batch, "account", "_part", "_credit", "_amount", "_opening", "_free"), strict=True
            ):
                if (owner, part) != place:
                    place, moved = (owner, part), 0
                fits = not credit and free and opening + moved >= amount
                if credit:
                    moved += amount
                elif fits:
                    moved -= amount
                accept.append(fits)
            own = pa.array([not c for c in is_credit], pa.bool_())
            yield extended(batch, kept, _new=pa.array(accept, pa.bool_())).filter(own)

    # plain values for the loop; the columns of the state travel as they are
    prepared = entries.select(
        F.struct(*columns).alias("_state"),
        "account",
        "seq",
        F.col("credit").isNotNull().alias("_credit"),
        F.coalesce("credit", "amount_minor").alias("_amount"),
        (F.coalesce("opening", F.lit(0).cast("bigint")) + F.col("_carry")).alias("_opening"),
        F.coalesce("free", F.lit(False)).alias("_free"),
        F.when(F.col("hot"), F.col("range")).otherwise(0).alias("_part"),
    ).select("_state.*", "account", "_credit", "_amount", "_opening", "_free", "_part")
    ordered = prepared.repartition("account", "_part").sortWithinPartitions("account", "_part", "seq")
    kept = [c for c in columns if c != "changed"]
    schema = ordered.select(*kept, F.lit(True).alias("_new")).schema
    decided = ordered.mapInArrow(step, schema)
    return _compared(decided, columns)


def _compared(decided: DataFrame, columns: list[str]) -> DataFrame:
    compared = {"accept": F.col("_new"), "changed": F.col("_new") != F.col("accept")}
    return decided.select(*[compared[c].alias(c) if c in compared else F.col(c) for c in columns])


def _label(checked: DataFrame, accepted: DataFrame | None, columns: list[str]) -> DataFrame:
    # at most one request of a key is accepted: the first one of a settled key, which its requests know
    settled = F.coalesce("_all_covered", F.lit(True))
    known = F.col("_valid") & F.col("_first").isNotNull()
    won = F.struct(*[F.col(f"_first_{c}").alias(c) for c in PAYLOAD])
    joined = checked.withColumn("_seq", F.when(known, F.col("_first"))).withColumn("_won", F.when(known, won))
    if accepted is not None:
        winner = accepted.select(F.col("idempotency_key").alias("_key"), F.col("seq").alias("_seq"), F.struct(*PAYLOAD).alias("_won"))
        others = checked.filter(~settled).join(winner, F.col("_valid") & (F.col("idempotency_key") == F.col("_key")), "left").drop("_key")
        joined = joined.filter(settled).unionByName(others)
    joined = joined.withColumn("_won_id", F.when(F.col("_seq").isNotNull(), stable_id(F.lit("transfer"), "idempotency_key", "_seq")))
    payload = F.struct(*PAYLOAD)
    stored, earlier = F.col("_stored_id").isNotNull(), F.coalesce(F.col("_seq") < F.col("seq"), F.lit(False))
    case = (
        F.when(~F.col("_valid"), "bad arguments")
        .when(stored & (F.col("_stored") == payload), "stored")
        .when(stored, "key reused")
        .when(F.coalesce(F.col("_seq") == F.col("seq"), F.lit(False)), "accepted")
        .when(earlier & (F.col("_won") == payload), "repeated")
        .when(earlier, "key reused")
        .when(~F.col("_open"), "accounts")
        .otherwise("funds")
    )
    c = F.col("_case")
    outcome = (
        F.when(c == "accepted", "COMPLETED")
        .when(c.isin("stored", "repeated"), "REPLAY")
        .when(c.isin("bad arguments", "key reused"), "INVALID_REQUEST")
        .otherwise("OPERATION_REJECTED")
    )
    transfer = F.when(c == "stored", F.col("_stored_id")).when(c.isin("accepted", "repeated"), F.col("_won_id"))
    reason = F.when(~c.isin("accepted", "stored", "repeated"), c)
    return joined.withColumn("_case", case).select(
        *columns, outcome.alias("outcome"), reason.alias("reason"), transfer.alias("transfer_id")
    )


def completed(decisions: DataFrame) -> DataFrame:
    """New rows of the transfers table."""
    return decisions.filter(F.col("outcome") == "COMPLETED").select(
        "seq", "transfer_id", "idempotency_key", *PAYLOAD, "actor", F.lit("COMPLETED").alias("status")
    )


def entries_of(transfers: DataFrame) -> DataFrame:
    """Two ledger entries per transfer, which sum to zero; the id is derived from the position of the request."""
    two = F.array(
        F.struct((F.col("seq") * 2).alias("id"), F.col("from_account").alias("account_id"), (-F.col("amount_minor")).alias("amount_minor")),
        F.struct((F.col("seq") * 2 + 1).alias("id"), F.col("to_account").alias("account_id"), F.col("amount_minor").alias("amount_minor")),
    )
    return transfers.select("transfer_id", F.explode(two).alias("e")).select("e.id", "transfer_id", "e.account_id", "e.amount_minor")


def balances_after(accounts: DataFrame, entries: DataFrame) -> DataFrame:
    moved = entries.groupBy(F.col("account_id").alias("_account")).agg(F.sum("amount_minor").alias("_moved"))
    joined = accounts.join(moved, F.col("id") == F.col("_account"), "left").drop("_account")
    return joined.withColumn("balance_minor", F.col("balance_minor") + F.coalesce("_moved", F.lit(0))).drop("_moved")
