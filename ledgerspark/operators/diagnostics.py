"""Reports over query logs, lock snapshots and counters."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.scalars import is_safe_id, one_line, percent_of, stable_id
from ledgerspark.operators.joins import lateral_unnest_join
from ledgerspark.operators.scans import ROWS_PER_SPLIT, ordered_scan
from ledgerspark.session import discard, materialize


def query_stats(log: DataFrame, width: int = 70, top: int | None = None) -> DataFrame:
    """Calls, total and mean time, rows and blocks per statement (query, ms, rows, blocks), literals folded.

    Statements are told apart by their whole text, only what is shown is cut. ``top`` gives the costliest ones, the
    largest total time first.
    """
    text = F.regexp_replace(F.regexp_replace(F.col("query"), r"'[^']*'|\b\d+\b", "?"), r"\s+", " ")
    stats = log.groupBy(F.trim(text).alias("_text")).agg(
        F.count(F.lit(1)).alias("calls"),
        F.round(F.sum("ms"), 1).alias("total_ms"),
        F.round(F.sum("ms") / F.count(F.lit(1)), 2).alias("mean_ms"),
        F.sum("rows").alias("rows"),
        F.sum("blocks").alias("blocks"),
    )
    if top is not None:
        stats = stats.orderBy(F.desc("total_ms"), "_text").limit(top)
    return stats.select(F.left("_text", F.lit(width)).alias("query"), "calls", "total_ms", "mean_ms", "rows", "blocks")


def before_after(log: DataFrame, key: str) -> DataFrame:
    """The same workload in two phases (``phase`` is before or after): calls, mean time and blocks side by side."""

    def of(phase: str) -> Column:
        return F.col("phase") == phase

    return log.groupBy(key).agg(
        *[F.count_if(of(p)).alias(f"{p}_calls") for p in ("before", "after")],
        *[F.round(F.sum(F.when(of(p), F.col("ms"))) / F.count_if(of(p)), 3).alias(f"{p}_mean_ms") for p in ("before", "after")],
        *[F.sum(F.when(of(p), F.col("blocks"))).alias(f"{p}_blocks") for p in ("before", "after")],
    )


def wait_pairs(sessions: DataFrame, as_of: Column) -> DataFrame:
    """Who waits for whom, the blocker's state and the age of its transaction."""
    pairs = lateral_unnest_join(sessions, "pid", "blocked_by", ["state", "query", "xact_start"])
    return pairs.select(
        F.col("pid").alias("waiting_pid"),
        one_line("query", 40).alias("waiting_query"),
        F.col("other_key").alias("blocking_pid"),
        one_line("other_query", 40).alias("blocking_query"),
        F.col("other_state").alias("blocking_state"),
        F.timestamp_diff("SECOND", F.col("other_xact_start"), as_of).alias("blocker_age_seconds"),
    )


def wait_cycles(edges: DataFrame, on_round=None) -> DataFrame:
    """Sessions of the wait-for graph (waiting_pid, blocking_pid) that can never go on: those on a cycle
    (``on_cycle``, or between two cycles) and those queued behind one.

    A session can never go on if its blockers lead to a cycle; looked at from the other end, those that a cycle
    leads to as well make up the cycles.
    """
    distinct = materialize(edges.select("waiting_pid", "blocking_pid").distinct(), "edges")
    stuck = _reaches_cycle(distinct.toDF("a", "b"), on_round)
    inside = distinct.join(stuck, F.col("waiting_pid") == F.col("pid"), "left_semi")
    on = _reaches_cycle(inside.select(F.col("blocking_pid").alias("a"), F.col("waiting_pid").alias("b")), on_round)
    on = on.select(F.col("pid").alias("_c"))
    return stuck.join(on, F.col("pid") == F.col("_c"), "left").select("pid", F.col("_c").isNotNull().alias("on_cycle"))


def _reaches_cycle(edges: DataFrame, on_round=None) -> DataFrame:
    """(pid) of the nodes from which the edges a -> b lead to a cycle.

    A node with a single edge follows it by doubling: after k rounds its pointer is 2**k steps further, or at the first
    node with several edges or none. Once a round brings no more pointers to such an end, those that still move go round
    a cycle. What is left are the nodes with several edges: one whose edges all end is taken out, round by round.
    """
    degree = materialize(edges.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.max("b").alias("to")), "degrees")
    single = degree.filter("n = 1").select(F.col("a").alias("v"), F.col("to").alias("at"), F.lit(True).alias("moved"))
    pointer, rounds = materialize(single, "pointers"), 0
    moved, before = pointer.count(), -1
    while moved and moved != before:
        step = pointer.select(F.col("v").alias("_v"), F.col("at").alias("_at"))
        further = pointer.join(step, F.col("at") == F.col("_v"), "left")
        old, pointer = pointer, materialize(further.select("v", F.coalesce("_at", "at").alias("at"), F.col("_v").isNotNull().alias("moved")), "pointers")
        discard(old)
        moved, before = pointer.filter("moved").count(), moved
        rounds += 1
        if on_round:
            on_round(rounds)
    ends = pointer.select("v", "at", F.col("moved").alias("endless"))
    several = edges.join(degree.filter("n > 1").select(F.col("a").alias("_b")), F.col("a") == F.col("_b"), "left_semi")
    rows = materialize(
        several.join(ends, F.col("b") == F.col("v"), "left").select("a", F.coalesce("at", "b").alias("b"), F.coalesce("endless", F.lit(False)).alias("endless")).distinct(), "edges")
    size = rows.count()
    while size:
        alive, before = rows.select(F.col("a").alias("_a")).distinct(), rows
        kept = rows.join(alive, F.col("b") == F.col("_a"), "left")
        rows = materialize(kept.filter(F.col("endless") | F.col("_a").isNotNull()).select("a", "b", "endless"), "edges")
        discard(before)
        smaller = rows.count()
        if on_round:
            on_round(rounds)
        if smaller == size:
            break
        size = smaller
    left = rows.select(F.col("a").alias("pid")).distinct()
    behind = ends.join(left, F.col("at") == F.col("pid"), "left").filter(F.col("endless") | F.col("pid").isNotNull())
    return materialize(left.unionByName(behind.select(F.col("v").alias("pid"))).distinct(), "stuck")


def deadlocks(edges: DataFrame, on_round=None) -> DataFrame:
    """(pid, deadlock) of the sessions that wait for themselves through others: each deadlock is a strongly connected component of the
    wait-for graph (waiting_pid, blocking_pid), named by its smallest pid. Repeated edges count once, null ends are no edges.

    Colouring, forward and backward: every session gets the greatest one that it leads to; those of a colour that the greatest
    one leads back to are a component, the others go on without it. Sessions are compared by a hash, so that what is known of a
    chain grows by a factor in every round instead of by a link.
    """
    links = edges.select(F.col("waiting_pid").alias("a"), F.col("blocking_pid").alias("b")).filter("a IS NOT NULL AND b IS NOT NULL").distinct()
    # only those between cycles are left, so most components are found at once
    on = wait_cycles(links.toDF("waiting_pid", "blocking_pid"), on_round).filter("on_cycle").select(F.col("pid").alias("v"))
    nodes = materialize(on, "nodes")
    links = materialize(_between(links, nodes), "links")
    loops = links.filter("a = b").select(F.col("a").alias("pid"))
    found = []
    while nodes.limit(1).count():
        ahead = _greatest(nodes, links, on_round)
        colour = ahead.select("v", F.col("top").alias("colour"))
        ends = links.join(colour, F.col("a") == F.col("v")).select("a", "b", F.col("colour").alias("own")).join(colour, F.col("b") == F.col("v"))
        inside = materialize(ends.filter("own = colour").select("a", "b"), "links")
        back = _greatest(nodes, inside.select(F.col("b").alias("a"), F.col("a").alias("b")), on_round).select(F.col("v").alias("_v"), F.col("top").alias("origin"))
        both = materialize(colour.join(back, F.col("v") == F.col("_v")).select("v", "colour", (F.col("origin") == F.col("colour")).alias("done")), "colours")
        found.append(both.filter("done").select(F.col("v").alias("pid"), "colour"))
        discard(nodes, ahead)
        nodes = materialize(both.filter("NOT done").select("v"), "nodes")
        links = materialize(_between(inside, nodes), "links")
        discard(inside)
    if not found:
        return on.select(F.col("v").alias("pid"), F.col("v").alias("deadlock"))
    members = reduce(DataFrame.unionByName, found)
    names = members.groupBy(F.col("colour").alias("_c")).agg(F.min("pid").alias("deadlock"), F.count(F.lit(1)).alias("n"))
    named = members.join(names, F.col("colour") == F.col("_c")).join(loops.select(F.col("pid").alias("_l")), F.col("pid") == F.col("_l"), "left")
    return named.filter("n > 1 OR _l IS NOT NULL").select("pid", "deadlock")


def _between(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """The links (a, b) with both ends among the nodes (v)."""
    return links.join(nodes, F.col("a") == F.col("v"), "left_semi").join(nodes, F.col("b") == F.col("v"), "left_semi")


def _greatest(nodes: DataFrame, links: DataFrame, on_round=None) -> DataFrame:
    """(v, top): of the nodes that the links a -> b lead to from v, v included, the one with the greatest hash. In each round a node asks
    its neighbours, the one that it knows as the greatest so far, and one that is twice as many links ahead as in the round before."""
    first = links.groupBy("a").agg(F.max_by("b", F.xxhash64("a", "b")).alias("at"))
    known = materialize(nodes.join(first, F.col("v") == F.col("a"), "left").select("v", F.col("v").alias("top"), F.coalesce("at", "v").alias("at")), "tops")
    while True:
        told = known.select(F.col("v").alias("_v"), F.col("top").alias("_top"), F.col("at").alias("_at"))
        none = F.lit(None).cast(known.schema["v"].dataType)
        asked = known.select("v", "top", none.alias("at"), F.col("top").alias("before"))
        near = links.join(told, F.col("b") == F.col("_v")).select(F.col("a").alias("v"), F.col("_top").alias("top"), none.alias("at"), none.alias("before"))
        far = known.join(told, F.col("top") == F.col("_v")).select("v", F.col("_top").alias("top"), none.alias("at"), none.alias("before"))
        ahead = known.join(told, F.col("at") == F.col("_v")).select("v", F.col("_top").alias("top"), F.col("_at").alias("at"), none.alias("before"))
        best = asked.unionByName(near).unionByName(far).unionByName(ahead).groupBy("v").agg(
            F.max_by("top", F.struct(F.xxhash64("top"), F.col("top"))).alias("top"), F.max("at").alias("at"), F.max("before").alias("before"))
        old, step = known, materialize(best, "tops")
        known = step.select("v", "top", "at")
        known.scratch_path = step.scratch_path
        discard(old)
        if on_round:
            on_round(1)
        if not step.filter("top <> before").limit(1).count():
            return known


def root_blockers(edges: DataFrame) -> DataFrame:
    """Sessions that block others and wait for nobody, with the number of sessions right behind them."""
    waiting = edges.select(F.col("waiting_pid").alias("_w"))
    behind = edges.groupBy("blocking_pid").agg(F.count_distinct(F.col("waiting_pid")).alias("waiters"))
    return behind.join(waiting, F.col("blocking_pid") == F.col("_w"), "left_anti")


def lock_queue(locks: DataFrame, sessions: DataFrame) -> DataFrame:
    """Locks (pid, mode, granted, relation) with the session's statement; not granted ones are the queue."""
    s = sessions.select(F.col("pid").alias("_pid"), one_line("query", 50).alias("query"))
    return locks.join(s, F.col("pid") == F.col("_pid"), "left").drop("_pid")


def long_transactions(sessions: DataFrame, as_of: dt.datetime, seconds: int = 5) -> DataFrame:
    """Transactions older than the limit; ``idle`` marks those that hold it without working."""
    rows = sessions.filter(F.col("xact_start") < F.lit(as_of - dt.timedelta(seconds=seconds)).cast("timestamp_ntz"))
    age = F.timestamp_diff("SECOND", F.col("xact_start"), F.lit(as_of).cast("timestamp_ntz"))
    return rows.select("pid", "state", age.alias("age_seconds"), (F.col("state") == "idle in transaction").alias("idle"))


def counter_rates(
    snapshots: DataFrame, keys: list[str], at: str, counters: list[str], hit: str, read: str, rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Growth of counters since the snapshot before, and the cache hit percentage of that growth."""
    names = list(dict.fromkeys([*counters, hit, read]))
    scanned = ordered_scan(snapshots, keys, [at], previous={f"_{n}": n for n in names}, rows_per_split=rows_per_split)
    grown = scanned.select(*keys, at, *[(F.col(n) - F.col(f"_{n}")).alias(n) for n in names])
    ratio = percent_of(F.col(hit), F.col(hit) + F.col(read), 2)
    return grown.select(*keys, at, *counters, ratio.alias("cache_hit_pct"))


def scan_heavy_tables(stats: DataFrame, k: int = 5) -> DataFrame:
    """Tables read most by full scans (relname, seq_scan, seq_tup_read, idx_scan)."""
    return stats.filter(F.col("seq_scan") > 0).orderBy(F.desc("seq_tup_read"), "relname").limit(k)


# fixed values: the only columns a metric may be grouped by; ids would make one series per request
METRIC_TAGS = ("method", "status", "endpoint", "operation", "outcome")


def request_metrics(log: DataFrame, *tags: str) -> DataFrame:
    """Count, total and maximum time per combination of low-cardinality tags."""
    refused = [t for t in tags if t not in METRIC_TAGS]
    if refused:
        raise ValueError(f"not a metric tag: {', '.join(refused)}")
    return log.groupBy(*tags).agg(
        F.count(F.lit(1)).alias("requests"), F.round(F.sum("ms"), 3).alias("total_ms"), F.max("ms").alias("max_ms")
    )


def sanitize_ids(df: DataFrame, column: str, *row_key: str) -> DataFrame:
    """Unsafe or missing request ids replaced by an id derived from the row."""
    return df.withColumn(column, F.when(is_safe_id(column), F.col(column)).otherwise(stable_id(F.lit(column), *row_key)))
