"""Registered queries: diagnostics over logs and snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerspark.operators import diagnostics as D
from ledgerspark.plans.registry import query

QUERY_LOG = """query_log AS (
  SELECT event_id, concat('SELECT   * FROM ', event_type, ' WHERE id = ', CAST(event_id AS VARCHAR), ' AND owner = ''u', CAST(user_id AS VARCHAR),
         ''' ORDER BY created_at, updated_at, id FOR ', CASE WHEN user_id % 2 = 0 THEN 'UPDATE' ELSE 'SHARE' END) AS query,
         event_type, value AS ms, event_id % 17 AS rows, event_id % 101 AS blocks,
         CASE WHEN event_id % 2 = 0 THEN 'before' ELSE 'after' END AS phase FROM events)"""


def query_log(v):
    event = F.col("event_id")
    text = F.concat(
        F.lit("SELECT   * FROM "), "event_type", F.lit(" WHERE id = "), event, F.lit(" AND owner = 'u"), "user_id",
        F.lit("' ORDER BY created_at, updated_at, id FOR "), F.when(F.col("user_id") % 2 == 0, "UPDATE").otherwise("SHARE")
    )
    return v.table("events").select(
        "event_id", text.alias("query"), "event_type", F.col("value").alias("ms"), (event % 17).alias("rows"),
        (event % 101).alias("blocks"), F.when(event % 2 == 0, "before").otherwise("after").alias("phase"),
    )


STATEMENTS = """SELECT left(statement, 70) AS query, calls, total_ms, mean_ms, rows, blocks FROM (
  SELECT regexp_replace(regexp_replace(query, '''[^'']*''|\\b[0-9]+\\b', '?', 'g'), '\\s+', ' ', 'g') AS statement,
    count(*) AS calls, round(sum(ms), 1) AS total_ms, round(sum(ms) / count(*), 2) AS mean_ms,
    CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(blocks) AS BIGINT) AS blocks FROM query_log GROUP BY 1)"""


@query(STATEMENTS, also=QUERY_LOG)
def query_stats(v):
    """Statements that only differ behind the part that is shown are rows of their own."""
    return D.query_stats(query_log(v))


@query(STATEMENTS + " ORDER BY total_ms DESC, statement LIMIT 3", also=QUERY_LOG)
def query_stats_top(v):
    return D.query_stats(query_log(v), top=3)


@query("""SELECT event_type, count(*) FILTER (WHERE phase = 'before') AS before_calls, count(*) FILTER (WHERE phase = 'after') AS after_calls,
  round(sum(ms) FILTER (WHERE phase = 'before') / count(*) FILTER (WHERE phase = 'before'), 3) AS before_mean_ms,
  round(sum(ms) FILTER (WHERE phase = 'after') / count(*) FILTER (WHERE phase = 'after'), 3) AS after_mean_ms,
  CAST(sum(blocks) FILTER (WHERE phase = 'before') AS BIGINT) AS before_blocks,
  CAST(sum(blocks) FILTER (WHERE phase = 'after') AS BIGINT) AS after_blocks FROM query_log GROUP BY 1""", also=QUERY_LOG)
def before_after(v):
    return D.before_after(query_log(v), "event_type")


PAIRS = "pairs AS (SELECT pid AS waiting_pid, unnest(blocked_by) AS blocking_pid FROM sessions)"


def pairs(v):
    return v.sessions.select(F.col("pid").alias("waiting_pid"), F.explode("blocked_by").alias("blocking_pid"))


@query("""SELECT w.pid AS waiting_pid, left(regexp_replace(w.query, '\\s+', ' ', 'g'), 40) AS waiting_query, b.pid AS blocking_pid,
  left(regexp_replace(b.query, '\\s+', ' ', 'g'), 40) AS blocking_query, b.state AS blocking_state,
  CAST(floor(date_diff('microsecond', b.xact_start, TIMESTAMP '2024-02-01') / 1000000) AS BIGINT) AS blocker_age_seconds
FROM sessions w JOIN pairs p ON p.waiting_pid = w.pid JOIN sessions b ON b.pid = p.blocking_pid""", also=PAIRS)
def wait_pairs(v):
    return D.wait_pairs(v.sessions, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))


@query("""SELECT pid, on_cycle FROM (
  WITH RECURSIVE reach AS (
    SELECT waiting_pid AS pid, blocking_pid AS dest FROM pairs
    UNION SELECT r.pid, p.blocking_pid FROM reach r JOIN pairs p ON p.waiting_pid = r.dest),
  cyclic AS (SELECT DISTINCT pid FROM reach WHERE pid = dest)
  SELECT DISTINCT pid, pid IN (SELECT pid FROM cyclic) AS on_cycle FROM reach WHERE dest IN (SELECT pid FROM cyclic))""", also=PAIRS)
def wait_cycles(v):
    return D.wait_cycles(pairs(v))


@query("""SELECT pid, deadlock FROM (
  WITH RECURSIVE reach AS (
    SELECT waiting_pid AS pid, blocking_pid AS dest FROM pairs
    UNION SELECT r.pid, p.blocking_pid FROM reach r JOIN pairs p ON p.waiting_pid = r.dest)
  SELECT r.pid, min(r.dest) AS deadlock FROM reach r JOIN reach s ON s.pid = r.dest AND s.dest = r.pid GROUP BY r.pid)""", also=PAIRS)
def deadlocks(v):
    """The sessions of each deadlock, under one name."""
    return D.deadlocks(pairs(v))


@query("""SELECT blocking_pid, count(DISTINCT waiting_pid) AS waiters FROM pairs
WHERE blocking_pid NOT IN (SELECT waiting_pid FROM pairs) GROUP BY 1""", also=PAIRS)
def root_blockers(v):
    return D.root_blockers(pairs(v))


@query("""SELECT l.l_orderkey AS pid, l.mode, l.granted, left(regexp_replace(s.query, '\\s+', ' ', 'g'), 50) AS query
FROM (SELECT l_orderkey, l_returnflag AS mode, l_linestatus = 'F' AS granted FROM lineitem) l LEFT JOIN sessions s ON s.pid = l.l_orderkey""")
def lock_queue(v):
    locks = v.table("lineitem").select(
        F.col("l_orderkey").alias("pid"), F.col("l_returnflag").alias("mode"), (F.col("l_linestatus") == "F").alias("granted")
    )
    return D.lock_queue(locks, v.sessions)


@query("""SELECT pid, state, CAST(floor(date_diff('microsecond', xact_start, TIMESTAMP '2024-01-20') / 1000000) AS BIGINT) AS age_seconds,
  state = 'idle in transaction' AS idle FROM sessions WHERE xact_start < TIMESTAMP '2024-01-20' - INTERVAL 5 SECOND""")
def long_transactions(v):
    return D.long_transactions(v.sessions, dt.datetime(2024, 1, 20))


SNAPSHOTS = """snapshots AS (
  SELECT event_type AS datname, ts AS taken_at, event_id * 3 AS xact_commit, event_id // 10 AS xact_rollback, event_id // 100 AS deadlocks,
         event_id * 90 AS blks_hit, event_id * 10 + event_id % 10 AS blks_read FROM events)"""
RATES = """SELECT datname, taken_at, xact_commit - lag(xact_commit) OVER w AS xact_commit, xact_rollback - lag(xact_rollback) OVER w AS xact_rollback,
  deadlocks - lag(deadlocks) OVER w AS deadlocks, round(CAST(blks_hit - lag(blks_hit) OVER w AS DOUBLE) * 100 /
  nullif(CAST(blks_hit - lag(blks_hit) OVER w + blks_read - lag(blks_read) OVER w AS DOUBLE), 0), 2) AS cache_hit_pct
FROM snapshots WINDOW w AS (PARTITION BY datname ORDER BY taken_at)"""


def rates(v, **options):
    e = F.col("event_id")
    snapshots = v.table("events").select(
        F.col("event_type").alias("datname"), F.col("ts").alias("taken_at"), (e * 3).alias("xact_commit"),
        F.floor(e / 10).alias("xact_rollback"), F.floor(e / 100).alias("deadlocks"), (e * 90).alias("blks_hit"),
        (e * 10 + e % 10).alias("blks_read"),
    )
    counters = ["xact_commit", "xact_rollback", "deadlocks"]
    return D.counter_rates(snapshots, ["datname"], "taken_at", counters, "blks_hit", "blks_read", **options)


@query(RATES, also=SNAPSHOTS)
def counter_rates(v):
    return rates(v)


@query(RATES, also=SNAPSHOTS)
def counter_rates_split(v):
    return rates(v, rows_per_split=500)


@query("""SELECT relname, seq_scan, seq_tup_read, idx_scan FROM (SELECT concat('table_', CAST(user_id AS VARCHAR)) AS relname,
  count(*) FILTER (WHERE event_type = 'view') AS seq_scan, CAST(sum(event_id) AS BIGINT) AS seq_tup_read,
  count(*) FILTER (WHERE event_type <> 'view') AS idx_scan FROM events GROUP BY 1)
WHERE seq_scan > 0 ORDER BY seq_tup_read DESC, relname LIMIT 5""")
def scan_heavy_tables(v):
    stats = v.table("events").groupBy(F.concat(F.lit("table_"), "user_id").alias("relname")).agg(
        F.count_if(F.col("event_type") == "view").alias("seq_scan"),
        F.sum("event_id").alias("seq_tup_read"),
        F.count_if(F.col("event_type") != "view").alias("idx_scan"),
    )
    return D.scan_heavy_tables(stats)


@query("""SELECT event_type AS method, CAST(props->>'$.k' AS BIGINT) % 5 AS status, count(*) AS requests,
  round(sum(value), 3) AS total_ms, max(value) AS max_ms FROM events GROUP BY 1, 2""")
def request_metrics(v):
    log = v.table("events").select(
        F.col("event_type").alias("method"), (F.get_json_object("props", "$.k").cast("bigint") % 5).alias("status"),
        F.col("value").alias("ms"),
    )
    return D.request_metrics(log, "method", "status")


@query("""SELECT event_id, CASE WHEN event_id % 6 = 0 THEN regexp_replace(md5(concat('request_id|', CAST(event_id AS VARCHAR))),
  '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') ELSE concat(event_type, ':', CAST(event_id AS VARCHAR)) END AS request_id FROM events""")
def sanitize_ids(v):
    e = F.col("event_id")
    sent = F.when(e % 6 == 0, F.concat("event_type", F.lit(" \n"), e)).otherwise(F.concat_ws(":", "event_type", e))
    return D.sanitize_ids(v.table("events").select("event_id", sent.alias("request_id")), "request_id", "event_id")
