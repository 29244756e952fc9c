"""Registered queries: streams over the given tables, run until all input is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.plans.fixtures import OPENING_MINOR, SMALL_OPENING_MINOR
from ledgerspark.plans.registry import query
from ledgerspark.plans.stateful import WALK, balances
from ledgerspark.plans.writes import new_store
from ledgerspark.session import materialize, scratch_path
from ledgerspark.sources.tables import stream_named
from ledgerspark.streaming import jobs as J


def events(v):
    return J.with_event_time(stream_named(v.spark, v.folder, "events"), "ts")


def past(v):
    """The same rows as a finished table."""
    return J.with_event_time(v.table("events"), "ts")


def payments(v):
    return stream_named(v.spark, v.folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("account_id"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount_minor"), F.col("o_orderstatus").alias("status"),
    )


def drained(v, stream):
    return J.drain(stream, scratch_path(v.spark, "checkpoint"), scratch_path(v.spark, "stream"))


def plain(*columns: str):
    """Zoned times back to the zoneless ones of the tables."""
    return [F.col(c).cast("timestamp_ntz").alias(c) for c in columns]


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(v):
    stream = J.stream_dedupe(events(v), ["user_id", "event_type"], "ts", "40 days")
    return drained(v, stream.select("user_id", "event_type"))


METRICS = """SELECT window_start, window_start + INTERVAL {length} AS window_end, method, status, count(*) AS requests,
  round(sum(value), 3) AS total_ms, max(value) AS max_ms FROM (
  SELECT unnest({starts}) AS window_start, event_type AS method, CAST(props->>'$.k' AS BIGINT) % 5 AS status, value FROM events)
GROUP BY ALL"""


def metrics(v, *window):
    """All windows: those that the stream has closed, and from the last rows those that were open at its end."""

    def job(rows):
        log = rows.select(
            "ts", F.col("event_type").alias("method"), (F.get_json_object("props", "$.k").cast("bigint") % 5).alias("status"),
            F.col("value").alias("ms"),
        )
        return J.stream_request_metrics(log, "ts", "10 minutes", *window)

    recent = past(v).filter(F.col("ts") >= past(v).agg(F.max("ts") - F.expr("interval 3 hours")).scalar())
    first = recent.agg(F.min("ts")).scalar()
    tail = materialize(job(recent).filter(F.col("window_start") >= first), "windows")
    rows = J.closed(drained(v, job(events(v))), tail, ["window_start", "method", "status"])
    times = plain("window_start", "window_end")
    return rows.select(*times, "method", "status", "requests", F.round("total_ms", 3).alias("total_ms"), "max_ms")


@query(METRICS.format(length="1 HOUR", starts="[date_trunc('hour', ts)]"))
def stream_request_metrics(v):
    return metrics(v, "1 hour")


@query(METRICS.format(length="1 HOUR", starts="[time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]"))
def stream_request_metrics_sliding(v):
    return metrics(v, "1 hour", "30 minutes")


@query("""SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 2 HOUR AS session_end, count(*) AS requests FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM (
    SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh
    FROM events)) GROUP BY user_id, session""")
def stream_sessions(v):
    def job(rows):
        return J.stream_sessions(rows, "user_id", "ts", "10 minutes", "2 hours")

    rows = J.closed(drained(v, job(events(v))), materialize(job(past(v)), "sessions"), ["user_id", "session_start"])
    return rows.select("user_id", *plain("session_start", "session_end"), "requests")


@query(raw=WALK.format(account="o_custkey"))
def stream_running_balance(v):
    debits = payments(v).select(F.col("id").alias("seq"), "account_id", "amount_minor")
    return drained(v, J.stream_running_balance(v.spark, debits, balances(v, SMALL_OPENING_MINOR)))


@query(raw=WALK.format(account="o_custkey"))
def stream_running_balance_batches(v):
    """The same with the balances in a table that each batch publishes."""
    store = new_store(v)
    store.publish(replace={"balances": balances(v, SMALL_OPENING_MINOR)})
    debits = payments(v).select(F.col("id").alias("seq"), "account_id", "amount_minor")
    J.drain_batches(debits, scratch_path(v.spark, "checkpoint"), J.running_balance_batch(store))
    return store.read("outcomes").select("seq", "account_id", "amount_minor", "outcome")


@query("SELECT account_id, CAST(sum(amount_minor) AS BIGINT) AS balance_minor FROM ledger_entries GROUP BY 1")
def stream_rebuild_projection(v):
    """Opening entries as the table that the stream of debits starts from."""
    store = new_store(v)
    store.publish(replace={"balances": balances(v, OPENING_MINOR)})
    entries = payments(v).filter("status = 'F'").select("account_id", (-F.col("amount_minor")).alias("amount_minor"))
    J.drain_batches(entries, scratch_path(v.spark, "checkpoint"), J.rebuild_projection_batch(store))
    return J.current_balances(store).select(F.col("id").alias("account_id"), "balance_minor")


@query("""SELECT concat('op-', CAST(event_id // 2 AS VARCHAR)) AS idempotency_key,
  max(CASE WHEN event_id % 2 = 0 THEN date_trunc('milliseconds', ts) END) AS reserved_at FROM events GROUP BY event_id // 2
HAVING count(*) FILTER (WHERE event_id % 2 = 1 AND event_type <> 'error') = 0
  AND max(date_trunc('milliseconds', ts)) FILTER (WHERE event_id % 2 = 0) + INTERVAL 1 HOUR
    <= (SELECT max(date_trunc('milliseconds', ts)) FROM events WHERE event_id % 2 = 0 OR event_type <> 'error')""")
def stream_stuck_operations(v):
    """Every even event reserves an operation; the next one completes it, unless it is an error."""
    event = F.col("event_id")

    def log(rows):
        return rows.filter((event % 2 == 0) | (F.col("event_type") != "error")).select(
            F.concat(F.lit("op-"), F.floor(event / 2)).alias("idempotency_key"),
            F.when(event % 2 == 0, "RESERVED").otherwise("COMPLETED").alias("status"), "ts",
        )

    hour = 3_600_000
    found = drained(v, J.stream_stuck_operations(v.spark, log(events(v)), "ts", "10 minutes", hour))
    found = J.closed(found, J.open_stuck_operations(log(past(v)), "ts", hour), ["idempotency_key"])
    return found.select("idempotency_key", *plain("reserved_at"))


@query("SELECT id, amount_minor FROM payments WHERE status = 'COMPLETED'")
def relay_outbox(v):
    """The outbox has a row for every payment; those that are not completed are settled without a message."""
    store, sink = new_store(v), scratch_path(v.spark, "sink")
    outbox = payments(v).select("id", "amount_minor", "status")
    wanted = F.col("status") == "F"
    handler = J.relay_outbox_batch(store, lambda rows: rows.select("id", "amount_minor").write.mode("append").parquet(sink), wanted)
    J.drain_batches(outbox, scratch_path(v.spark, "checkpoint"), handler)
    delivered = v.spark.read.schema("id BIGINT, amount_minor BIGINT").parquet(sink)
    settled = J.not_in_ranges(delivered.select("id"), store.read("sent")).select(F.col("id").alias("_unsettled"))
    return delivered.join(settled, F.col("id") == F.col("_unsettled"), "left_anti")


@query("""SELECT min(id) AS first_id, max(id) AS last_id FROM (SELECT id, id - row_number() OVER (ORDER BY id) AS run FROM payments
WHERE status = 'COMPLETED') GROUP BY run""")
def outbox_ranges(v):
    """What the relay keeps where the payments that are not completed never come: a range behind each gap."""
    store = new_store(v)
    outbox = payments(v).filter("status = 'F'").select("id")
    J.drain_batches(outbox, scratch_path(v.spark, "checkpoint"), J.relay_outbox_batch(store, lambda rows: rows.write.format("noop").mode("overwrite").save()))
    return store.read("sent")
