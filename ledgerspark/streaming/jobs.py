"""The same semantics on streams: duplicates, metrics, sessions, balances, stuck operations, outbox.

All jobs read what is there and end (``availableNow``). Jobs that keep tables do so in ``foreachBatch`` on a
``VersionedStore``: the batch id is published together with the data, so a batch that is run again after a crash
changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ledgerspark.operators.debits import guarded_debits
from ledgerspark.operators.scans import ROWS_PER_SPLIT, Running, ordered_scan
from ledgerspark.session import discard, materialize
from ledgerspark.sources.store import VersionedStore

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a timestamp with zone."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def drain(stream: DataFrame, checkpoint: str, path: str) -> DataFrame:
    """Run a stream over all available input into parquet files and return what they hold."""
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def drain_batches(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    query = (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def closed(streamed: DataFrame, whole: DataFrame, keys: list[str]) -> DataFrame:
    """What a drained stream gave out, and the groups that were still open when its input had ended.

    ``whole`` is the same job over the finished input (streaming operators are plain ones there), as a written table; groups are
    told apart by ``keys``, and those that the stream has given out are not repeated.
    """
    done = streamed.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return streamed.unionByName(whole.join(done, same, "left_anti"))


# ---- built-in state


def stream_dedupe(stream: DataFrame, keys: list[str], at: str, delay: str) -> DataFrame:
    """The first row of each key; a key is forgotten when the watermark is ``delay`` past it."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def stream_request_metrics(stream: DataFrame, at: str, delay: str, length: str, slide: str | None = None) -> DataFrame:
    """Requests, total and longest time per window, method and status; a window is given out once it is closed."""
    window = F.window(at, length, slide) if slide else F.window(at, length)
    grouped = stream.withWatermark(at, delay).groupBy(window.alias("w"), "method", "status")
    metrics = grouped.agg(F.count(F.lit(1)).alias("requests"), F.sum("ms").alias("total_ms"), F.max("ms").alias("max_ms"))
    return metrics.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "method", "status",
        "requests", "total_ms", "max_ms",
    )


def stream_sessions(stream: DataFrame, key: str, at: str, delay: str, gap: str) -> DataFrame:
    """Bursts of activity of a key with pauses shorter than ``gap``; given out when they are over."""
    grouped = stream.withWatermark(at, delay).groupBy(F.session_window(at, gap).alias("s"), key)
    return grouped.agg(F.count(F.lit(1)).alias("requests")).select(
        key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "requests"
    )


# ---- tables kept by batches


def _seen(store: VersionedStore, job: str, batch_id: int) -> bool:
    return int(store.manifest().notes.get(f"batch:{job}", "-1")) >= batch_id


def current_balances(store: VersionedStore) -> DataFrame:
    """Balances (id, balance_minor): the table written last and the changes since then."""
    tables = store.manifest().tables
    parts = []
    if "balances" in tables:
        parts.append(store.read("balances").select("id", "balance_minor"))
    if "changes" in tables:
        parts.append(store.read("changes").select(F.col("account_id").alias("id"), F.col("amount_minor").alias("balance_minor")))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.groupBy("id").agg(F.sum("balance_minor").alias("balance_minor"))


def publish_changes(
    store: VersionedStore, job: str, batch_id: int, changes: DataFrame, append: dict[str, DataFrame], fold_every: int
) -> None:
    """Add a batch's changes per account; every ``fold_every`` batches fold them into the balances, so that most
    batches write in proportion to their own rows."""
    notes = {f"batch:{job}": str(batch_id)}
    store.publish(append={**append, "changes": changes}, notes=notes)
    if (batch_id + 1) % fold_every == 0:
        base = store.manifest()
        folded = current_balances(store)
        store.publish(replace={"balances": folded, "changes": changes.limit(0)}, base=base)


def rebuild_projection_batch(store: VersionedStore, fold_every: int = 50) -> Callable[[DataFrame, int], None]:
    """Handler for a stream of ledger entries (account_id, amount_minor)."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        if _seen(store, "projection", batch_id):
            return
        changes = batch.groupBy("account_id").agg(F.sum("amount_minor").alias("amount_minor"))
        publish_changes(store, "projection", batch_id, changes, {}, fold_every)

    return handle


def running_balance_batch(store: VersionedStore, fold_every: int = 50) -> Callable[[DataFrame, int], None]:
    """Handler for a stream of debits (seq, account_id, amount_minor): each applies only if the balance covers it.

    The outcomes go to the table ``outcomes``. A batch is decided as one set, so a hot account is spread as in
    the batch job.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if _seen(store, "debits", batch_id):
            return
        debits = materialize(batch, "debits")
        asked = debits.select(F.col("account_id").alias("_asked")).distinct()
        balances = current_balances(store).join(asked, F.col("id") == F.col("_asked"), "left_semi")
        outcomes = materialize(guarded_debits(balances, debits), "outcomes")
        applied = outcomes.filter(F.col("outcome") == "APPLIED")
        changes = applied.groupBy("account_id").agg((-F.sum("amount_minor")).alias("amount_minor"))
        publish_changes(store, "debits", batch_id, changes, {"outcomes": outcomes}, fold_every)

    return handle


RANGES = "first_id BIGINT, last_id BIGINT"


def not_in_ranges(rows: DataFrame, ranges: DataFrame, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Rows (id, ...) whose id is in none of the ranges (first_id, last_id), which do not overlap: ranges and ids are passed over
    once in their order, so no row meets a range."""
    starts = ranges.select(F.col("first_id").alias("_at"), F.lit(0).alias("_kind"), F.col("last_id").alias("_to"))
    asked = rows.select(F.col("id").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast("bigint").alias("_to"))
    covered = ordered_scan(starts.union(asked), [], ["_at", "_kind"], running={"_reach": Running("max", "_to")}, rows_per_split=rows_per_split)
    free = covered.filter((F.col("_kind") == 1) & (F.coalesce("_reach", F.col("_at") - 1) < F.col("_at"))).select(F.col("_at").alias("_free"))
    return rows.join(free, F.col("id") == F.col("_free"), "left_semi")


def merge_ranges(ranges: DataFrame, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Ranges (first_id, last_id) that do not overlap, with those that touch made one."""
    rows = ordered_scan(ranges, [], ["first_id"], previous={"_up_to": "last_id"}, rows_per_split=rows_per_split)
    begins = F.when(F.coalesce(F.col("_up_to") + 1 == F.col("first_id"), F.lit(False)), None).otherwise(F.col("first_id"))
    runs = ordered_scan(rows.withColumn("_begin", begins), [], ["first_id"], running={"_run": Running("max", "_begin")}, rows_per_split=rows_per_split)
    return runs.groupBy("_run").agg(F.max("last_id").alias("last_id")).select(F.col("_run").alias("first_id"), "last_id")


def low_water_mark(store: VersionedStore) -> int | None:
    """The id up to which, from the first one seen, every id is settled; None before the first batch."""
    if "sent" not in store.manifest().tables:
        return None
    return store.read("sent").agg(F.min_by("last_id", "first_id")).first()[0]


def relay_outbox_batch(
    store: VersionedStore, deliver: Callable[[DataFrame], None], wanted: Column | None = None, rows_per_split: int = ROWS_PER_SPLIT
) -> Callable[[DataFrame, int], None]:
    """Handler for a stream of outbox rows (id, ...): deliver the unsent ones, then note them as sent.

    What is noted (table ``sent``) are the ranges of settled ids: one up to the low-water mark, and one behind each gap above it. A gap
    are ids that have not come yet, such as those of transactions that are still open or were rolled back, so the table is bounded by
    them and not by what was ever sent. However late the row of a gap comes, it is delivered and closes the gap. Rows that are not
    ``wanted`` are settled without delivery. A crash between delivery and note delivers again, so delivery is at least once and
    consumers have to know the id. ids are whole numbers; a row without one is not delivered.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if _seen(store, "outbox", batch_id):
            return
        base = store.manifest()
        rows = batch.filter("id IS NOT NULL").dropDuplicates(["id"])
        known = store.read("sent", base.version) if "sent" in base.tables else batch.sparkSession.createDataFrame([], RANGES)
        came = materialize(rows, "came")
        unsent = materialize(not_in_ranges(came, known, rows_per_split), "unsent")
        due = unsent if wanted is None else unsent.filter(wanted)
        deliver(due.repartitionByRange("id").sortWithinPartitions("id"))
        one = F.col("id").cast("bigint")
        # two scans read it: written, so that both see the same rows
        both = materialize(known.unionByName(unsent.select(one.alias("first_id"), one.alias("last_id"))), "settled")
        store.publish(replace={"sent": merge_ranges(both, rows_per_split)}, notes={"batch:outbox": str(batch_id)}, base=base)
        discard(came, unsent, both)

    return handle


# ---- state per operation


#: State is kept per bucket of keys, since a call for every key costs far more than its rows. The number never changes during
#: the life of a checkpoint; it does not go with the tables, so what a bucket holds does.
BUCKETS = 16_384


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_bucket")


class StuckOperations(StatefulProcessor):
    """Reports an operation when ``age_ms`` of event time have passed since its last reservation without a final
    status after it. Only the two latest times are kept, so the order inside a batch does not matter. The state of a bucket is one
    value with the operations that have not reached that age, and one timer for the first that will."""

    def __init__(self, age_ms: int):
        self.age_ms = age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "key ARRAY<STRING>, reserved ARRAY<BIGINT>, final ARRAY<BIGINT>, timer BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, timer = self._held()
        for frame in rows:
            for name, status, at in zip(*(frame[c].tolist() for c in ("idempotency_key", "status", "at_ms"))):
                times = held.setdefault(name, [-1, -1])
                kind = 0 if status == "RESERVED" else 1
                if at > times[kind]:
                    times[kind] = int(at)
        self._keep(held, timer)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, _ = self._held()
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        over = {name: times for name, times in held.items() if max(times) + self.age_ms <= now}
        self._keep({name: times for name, times in held.items() if name not in over}, -1)
        stuck = [(name, reserved) for name, (reserved, final) in over.items() if reserved > final]
        if stuck:
            yield pd.DataFrame(stuck, columns=["idempotency_key", "reserved_ms"])

    def _held(self) -> tuple[dict, int]:
        if not self.open.exists():
            return {}, -1
        names, reserved, final, timer = self.open.get()
        return {name: [r, f] for name, r, f in zip(names, reserved, final)}, timer

    def _keep(self, held: dict, timer: int) -> None:
        if not held:
            self.open.clear()
            return
        first = min(map(max, held.values())) + self.age_ms
        if timer == -1 or first < timer:
            self.handle.registerTimer(first)
            timer = first
        self.open.update((list(held), [r for r, _ in held.values()], [f for _, f in held.values()], timer))

    def close(self) -> None:
        pass


class RunningBalance(StatefulProcessor):
    """Debits of a bucket of accounts, each applied only if its account's balance covers it. The state is one value: of every account
    the balance and the last ``seq`` that was decided. A row that comes after a later one of its account was decided, or once
    more, is LATE and moves nothing."""

    def __init__(self, account: str):
        self.schema = f"account ARRAY<{account}>, balance ARRAY<BIGINT>, last ARRAY<BIGINT>"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.accounts = handle.getValueState("accounts", self.schema)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        held = self._held()
        for account, balance in zip(initialState["account_id"].tolist(), initialState["balance_minor"].tolist()):
            held.setdefault(account, [int(balance), -(2**63)])
        self._keep(held)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        debits = pd.concat(list(rows))[["seq", "account_id", "amount_minor"]].sort_values("seq", kind="stable")
        held, outcomes = self._held(), []
        for seq, account, amount in zip(*(debits[c].tolist() for c in debits.columns)):
            state = held.get(account)
            if state is None:
                outcomes.append("NOT_FOUND")
            elif seq <= state[1]:
                outcomes.append("LATE")
            else:
                fits = amount <= state[0]
                state[0], state[1] = state[0] - amount if fits else state[0], seq
                outcomes.append("APPLIED" if fits else "REJECTED")
        if held:
            self._keep(held)
        yield debits.assign(outcome=outcomes)

    def _held(self) -> dict:
        if not self.accounts.exists():
            return {}
        return {account: [balance, last] for account, balance, last in zip(*self.accounts.get())}

    def _keep(self, held: dict) -> None:
        self.accounts.update((list(held), [b for b, _ in held.values()], [n for _, n in held.values()]))

    def close(self) -> None:
        pass


def stream_running_balance(spark: SparkSession, stream: DataFrame, balances: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Debits (seq, account_id, amount_minor) with ``outcome``: APPLIED, REJECTED, NOT_FOUND, INVALID or LATE.

    Every account's balance is the stream's own state, which starts from ``balances`` (id, balance_minor; one row per account) and is
    checkpointed with the stream: a batch that is run again after a crash changes nothing. Inside a batch the rows of an
    account are taken by ``seq``, whatever order they come in. Rows without seq, account or a positive amount are INVALID.
    Accounts are followed in ``buckets`` groups, a number that stays the same as long as the checkpoint.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    columns = ["seq", "account_id", "amount_minor"]
    valid = F.coalesce(F.col("seq").isNotNull() & F.col("account_id").isNotNull() & (F.col("amount_minor") > 0), F.lit(False))
    kinds = ", ".join(f"{c} {stream.schema[c].dataType.simpleString()}" for c in columns)
    opening = balances.filter("id IS NOT NULL").select(F.col("id").cast(stream.schema["account_id"].dataType).alias("account_id"), "balance_minor")
    decided = stream.filter(valid).select(*columns, bucket_of("account_id", buckets)).groupBy("_bucket").transformWithStateInPandas(
        statefulProcessor=RunningBalance(stream.schema["account_id"].dataType.simpleString()),
        outputStructType=f"{kinds}, outcome STRING",
        outputMode="Append",
        timeMode="None",
        initialState=opening.select("*", bucket_of("account_id", buckets)).groupBy("_bucket"),
    )
    return decided.union(stream.filter(~valid).select(*columns, F.lit("INVALID").alias("outcome")))


def open_stuck_operations(operations: DataFrame, at: str, age_ms: int) -> DataFrame:
    """The same question to a finished table, with its last time as now."""
    last = operations.groupBy("idempotency_key").agg(
        F.max(F.when(F.col("status") == "RESERVED", F.unix_millis(at))).alias("reserved_ms"),
        F.max(F.when(F.col("status") != "RESERVED", F.unix_millis(at))).alias("final_ms"),
    )
    now = operations.agg(F.max(F.unix_millis(at))).scalar()
    stuck = (F.col("reserved_ms") > F.coalesce("final_ms", F.lit(-1))) & (F.col("reserved_ms") + age_ms <= now)
    return last.filter(stuck).select("idempotency_key", F.timestamp_millis("reserved_ms").alias("reserved_at"))


def stream_stuck_operations(spark: SparkSession, stream: DataFrame, at: str, delay: str, age_ms: int, buckets: int = BUCKETS) -> DataFrame:
    """Operations (idempotency_key, status, ``at``) that stay RESERVED too long, with the time of the reservation.

    Operations are followed in ``buckets`` groups, a number that stays the same as long as the checkpoint.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = stream.withWatermark(at, delay).select("idempotency_key", "status", F.unix_millis(at).alias("at_ms"), at, bucket_of("idempotency_key", buckets))
    found = rows.groupBy("_bucket").transformWithStateInPandas(
        statefulProcessor=StuckOperations(age_ms),
        outputStructType="idempotency_key STRING, reserved_ms BIGINT",
        outputMode="Append",
        timeMode="EventTime",
    )
    return found.select("idempotency_key", F.timestamp_millis("reserved_ms").alias("reserved_at"))
