"""Ordered commands on keys: request keys, row versions, payment operations, tokens, job queues."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.batches import extended, lists
from ledgerspark.functions.scalars import request_hash
from ledgerspark.operators.scans import ROWS_PER_SPLIT, cut, global_rank, with_key_values
from ledgerspark.session import discard, materialize

#: Maps of so many neighbouring ranges of a row are composed at once.
FAN_OUT = 4


def classify_requests(requests: DataFrame, payload: list[str], rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """FIRST, REPLAY (same payload as the first of its key) or CONFLICT per request.

    Requests are shuffled once, by their key; no key is too large for a task.
    """
    of_first = {f"_first_{c}": F.min_by(c, "seq") for c in payload}
    named = requests.filter("idempotency_key IS NOT NULL")
    found = with_key_values(named, "idempotency_key", {"_first": F.min("seq"), **of_first}, rows_per_split=rows_per_split)
    kind = (
        F.when(F.col("seq") == F.col("_first"), "FIRST")
        .when(request_hash(*payload) == request_hash(*of_first), "REPLAY")
        .otherwise("CONFLICT")
    )
    return found.select(*requests.columns, kind.alias("kind"))


# ---- row versions. A missing row counts as version -1, so that a create is "version + 1" in every case.


def optimistic_updates(
    rows: DataFrame, commands: DataFrame, rows_per_split: int = ROWS_PER_SPLIT, on_round: Callable[[str, int], None] | None = None
) -> DataFrame:
    """``commands`` (seq, row_id, expected_version) with ``outcome`` and the resulting ``version``.

    NULL as expected version creates or overwrites the row. Otherwise the row must exist (NOT_FOUND) and be at
    the expected version (STALE); a success adds one to the version. ``rows`` (id, version) is the start. ``seq`` orders the
    commands of a row; it may be of any kind that can be sorted, with any gaps.

    Rows with up to ``rows_per_split`` commands are followed in order in one pass over sorted data. The commands
    of a row with more are cut into ranges; each range is turned into the map from the version before
    it to the version after it, neighbouring maps are composed in log rounds (``on_round`` hears of each), and with the version
    at the begin of every range all ranges are followed side by side. Commands without a row id are NOT_FOUND.
    """
    columns = commands.columns
    nameless = commands.filter(F.col("row_id").isNull()).select(*columns, F.lit("NOT_FOUND").alias("outcome"), F.lit(None).cast("bigint").alias("version"))
    commands = commands.filter(F.col("row_id").isNotNull())
    start = rows.select(F.col("id").alias("_id"), F.col("version").alias("_start"))

    def started(some: DataFrame) -> DataFrame:
        joined = some.join(start, F.col("row_id") == F.col("_id"), "left").drop("_id")
        return joined.withColumn("_start", F.coalesce("_start", F.lit(-1).cast("bigint")))

    parts = cut(commands, ["row_id"], ["seq"], rows_per_split)
    if parts is None:
        return _follow(started(commands).withColumn("_split", F.lit(0).cast("bigint")), columns).unionByName(nameless)
    large, rest = parts
    large = started(large.withColumn("_split", F.col("_split").cast("bigint")))
    points, ranges = _range_maps(large)
    begins = _begins(points, materialize(ranges, "ranges"), on_round)
    placed = large.drop("_start").join(begins, ["row_id", "_split"]).withColumnRenamed("_begin", "_start")
    placed = placed.unionByName(started(rest).withColumn("_split", F.lit(0).cast("bigint")))
    return _follow(placed, columns).unionByName(nameless)


def _number_expected(df: DataFrame) -> DataFrame:
    """-1 stands for a create, -2 for a version that no row can have."""
    e = F.col("expected_version")
    return df.withColumn("_expected", F.when(e.isNull(), -1).when(e < 0, -2).otherwise(e).cast("bigint"))


def _follow(commands: DataFrame, columns: list[str]) -> DataFrame:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, version = None, -1
        for batch in batches:
            outcome, after = [], []
            for row, split, start, expected in zip(*lists(batch, "row_id", "_split", "_start", "_expected"), strict=True):
                if (row, split) != current:
                    current, version = (row, split), start
                if expected == -1 or (version >= 0 and version == expected):
                    version += 1
                    outcome.append("APPLIED")
                else:
                    outcome.append("NOT_FOUND" if version < 0 else "STALE")
                after.append(version)
            yield extended(batch, columns, outcome=pa.array(outcome, pa.string()), _after=pa.array(after, pa.int64()))

    numbered = _number_expected(commands)
    ordered = numbered.repartition("row_id", "_split").sortWithinPartitions("row_id", "_split", "seq")
    ordered = ordered.select(*columns, "_start", "_split", "_expected")
    schema = commands.select(*columns, F.lit("").alias("outcome"), F.lit(0).cast("bigint").alias("_after")).schema
    followed = ordered.mapInArrow(step, schema)
    return followed.select(*columns, "outcome", F.when(F.col("_after") >= 0, F.col("_after")).alias("version"))


def _range_maps(commands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What each range makes of the version before it: points (row_id, _split, _version, _out), and per range its start, its
    creates (``_shift``), which move every version without a point, and its number of commands."""

    kind = commands.schema["row_id"].dataType.simpleString()
    names = ["row_id", "_split", "_version", "_out"]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come newest first: ``results`` maps a version, counted with the creates still to come, to the end
        current, results, shift, types = None, {}, 0, None
        for batch in batches:
            types = batch.schema
            for row, split, expected in zip(*lists(batch, "row_id", "_split", "_expected"), strict=True):
                if (row, split) != current:
                    if current is not None:
                        yield table(current, results, shift, types)
                    current, results, shift = (row, split), {}, 0
                if expected == -1:
                    shift += 1
                elif expected >= 0:
                    after = expected + 1 + shift
                    results[expected + shift] = results.get(after, after)
        if current is not None:
            yield table(current, results, shift, types)

    def table(current, results, shift, types) -> pa.RecordBatch:
        n = len(results)
        columns = [pa.array([current[0]] * n, types.field("row_id").type), pa.array([current[1]] * n, pa.int64())]
        columns += [pa.array([v - shift for v in results], pa.int64()), pa.array(list(results.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    numbered = _number_expected(commands).select("row_id", "_split", "seq", "_start", "_expected")
    creates = F.count_if(F.col("_expected") == -1).alias("_shift")
    ranges = numbered.groupBy("row_id", "_split").agg(F.min("_start").alias("_start"), creates, F.count(F.lit(1)).alias("_commands"))
    ordered = numbered.repartition("row_id", "_split").sortWithinPartitions("row_id", "_split", F.desc("seq"))
    return ordered.mapInArrow(step, f"row_id {kind}, _split bigint, _version bigint, _out bigint"), ranges


def _begins(points: DataFrame, ranges: DataFrame, on_round: Callable[[str, int], None] | None) -> DataFrame:
    """(row_id, _split, _begin): the version at the begin of every range, by a tree over the ranges of each row.

    ``points`` (row_id, _split, _version, _out) is the map of every range where it does more than its creates, ``ranges``
    (row_id, _split, _start, _shift, _commands) has one row per range; every other version is moved by ``_shift``. Maps of
    ``FAN_OUT`` neighbours are composed into one, level by level up; then the begins are handed down. A level is one written
    table, and all its lookups are joins on (row, range, version), so a row is never followed by one task.
    """
    along = Window.partitionBy("row_id").orderBy("_split")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    placed = materialize(ranges.select(
        "row_id", "_split", "_start", "_shift", (F.row_number().over(along) - 1).cast("bigint").alias("_node"),
        (F.col("_start") + F.coalesce(F.sum("_shift").over(before), F.lit(0))).alias("_least"),
        (F.col("_start") + F.coalesce(F.sum("_commands").over(before), F.lit(0))).alias("_most")), "places")
    # versions that a row cannot have at the begin of a range are never looked up
    level = points.join(placed.select("row_id", "_split", "_node", "_least", "_most"), ["row_id", "_split"])
    level = level.filter("_version BETWEEN _least AND _most").select("row_id", "_node", "_version", "_out")
    levels = [(materialize(level, "maps"), placed.select("row_id", "_node", "_shift"))]
    nodes = (placed.agg(F.max("_node")).first()[0] or 0) + 1
    while nodes > FAN_OUT:
        maps, shifts = levels[-1]
        levels.append((materialize(_composed(maps, shifts), "maps"), materialize(_grouped(shifts).select("row_id", "_node", _ahead(FAN_OUT).alias("_shift")), "shifts")))
        nodes = -(-nodes // FAN_OUT)
        if on_round:
            on_round("up", nodes)
    begins = placed.filter("_node = 0").select("row_id", "_node", F.col("_start").alias("_begin"))
    for maps, shifts in reversed(levels):
        begins = materialize(_handed_down(begins, maps, shifts), "begins")
        if on_round:
            on_round("down", nodes)
    for maps, _ in levels:
        discard(maps)
    return begins.join(placed, ["row_id", "_node"]).select("row_id", "_split", "_begin")


def _grouped(shifts: DataFrame) -> DataFrame:
    """(row_id, _node of the level above, ``_s0`` ...): the creates of its ranges, NULL where there is none."""
    place = F.col("_node") % FAN_OUT
    sums = [F.sum(F.when(place == k, F.col("_shift"))).alias(f"_s{k}") for k in range(FAN_OUT)]
    return shifts.groupBy("row_id", F.floor(F.col("_node") / FAN_OUT).alias("_node")).agg(*sums)


def _ahead(place: int) -> Column:
    """Creates of a group's ranges before the given one."""
    return sum((F.coalesce(f"_s{k}", F.lit(0)) for k in range(place)), F.lit(0).cast("bigint"))


def _composed(maps: DataFrame, shifts: DataFrame) -> DataFrame:
    """The maps of ``FAN_OUT`` neighbours as one. What an earlier range sends on is looked up in the later ones; the points of a
    later range hold for the versions that only creates bring to it, unless an earlier one has the version itself."""
    group = _grouped(shifts)
    place, node = F.col("_node") % FAN_OUT, F.floor(F.col("_node") / FAN_OUT)
    parts = maps.withColumn("_place", place).withColumn("_node", node).join(group, ["row_id", "_node"])
    extra = [f"_s{k}" for k in range(FAN_OUT)]
    held = None
    for k in range(FAN_OUT):
        own = parts.filter(F.col("_place") == k)
        if held is not None:
            later = own.select(F.col("row_id").alias("_r"), F.col("_node").alias("_n"), F.col("_version").alias("_at"), F.col("_out").alias("_next"))
            met = (F.col("row_id") == F.col("_r")) & (F.col("_node") == F.col("_n")) & (F.col("_out") == F.col("_at"))
            out = F.coalesce("_next", F.col("_out") + F.coalesce(f"_s{k}", F.lit(0)))
            held = held.join(later, met, "left").select("row_id", "_node", "_version", out.alias("_out"), "_first", *extra)
        brought = own.select("row_id", "_node", (F.col("_version") - _ahead(k)).alias("_version"), "_out", F.lit(k).alias("_first"), *extra)
        held = brought if held is None else held.unionByName(brought)
    return held.groupBy("row_id", "_node", "_version").agg(F.min_by("_out", "_first").alias("_out"))


def _handed_down(begins: DataFrame, maps: DataFrame, shifts: DataFrame) -> DataFrame:
    """Begins of a level's ranges from those of the level above."""
    now = begins.join(_grouped(shifts), ["row_id", "_node"]).withColumn("_b0", F.col("_begin"))
    for k in range(FAN_OUT - 1):
        own = maps.filter(F.col("_node") % FAN_OUT == k)
        own = own.select(F.col("row_id").alias("_r"), F.floor(F.col("_node") / FAN_OUT).alias("_n"), F.col("_version").alias("_at"), F.col("_out").alias("_next"))
        met = (F.col("row_id") == F.col("_r")) & (F.col("_node") == F.col("_n")) & (F.col(f"_b{k}") == F.col("_at"))
        after = F.coalesce("_next", F.col(f"_b{k}") + F.coalesce(f"_s{k}", F.lit(0)))
        now = now.join(own, met, "left").withColumn(f"_b{k + 1}", after).drop("_r", "_n", "_at", "_next")
    children = F.array(*[F.when(F.col(f"_s{k}").isNotNull(), F.struct((F.col("_node") * FAN_OUT + k).alias("_node"), F.col(f"_b{k}").alias("_begin"))) for k in range(FAN_OUT)])
    return now.select("row_id", F.explode(F.filter(children, lambda c: c.isNotNull())).alias("_c")).select("row_id", "_c._node", "_c._begin")


def versions_after(rows: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(id, version) of all rows after the commands."""
    last = outcomes.filter(F.col("outcome") == "APPLIED").groupBy(F.col("row_id").alias("id")).agg(F.max("version").alias("_new"))
    joined = rows.select("id", "version").join(last, "id", "full")
    return joined.select("id", F.coalesce("_new", "version").alias("version"))


# ---- payment operations


def operation_state(attempts: DataFrame) -> DataFrame:
    """``attempts`` (seq, idempotency_key, amount_minor, gateway) with ``outcome`` and the resulting ``status``.

    ``gateway`` is what the external call does: OK, ERROR or TIMEOUT. The first valid attempt fixes the amount;
    another amount is REJECTED. COMPLETED is final and later attempts get it back (REPLAY). A failed operation
    may be tried again; after a timeout it stays RESERVED, since nobody knows what the gateway did.

    An attempt only depends on the first amount of its key and the first success, so two aggregates replace the
    walk over each key.
    """
    valid = F.coalesce((F.length(F.trim("idempotency_key")) > 0) & (F.col("amount_minor") > 0), F.lit(False))
    per_amount = attempts.filter(valid).groupBy("idempotency_key", "amount_minor").agg(
        F.min("seq").alias("_seq"), F.min(F.when(F.col("gateway") == "OK", F.col("seq"))).alias("_done")
    )
    chosen = F.struct(F.col("amount_minor").alias("amount"), "_done")
    per_key = per_amount.groupBy(F.col("idempotency_key").alias("_key")).agg(F.min_by(chosen, "_seq").alias("_op"))
    joined = attempts.withColumn("_valid", valid).join(per_key, F.col("_valid") & (F.col("idempotency_key") == F.col("_key")), "left")
    done, seq = F.col("_op._done"), F.col("seq")
    outcome = (
        F.when(~F.col("_valid"), "INVALID")
        .when(F.col("amount_minor") != F.col("_op.amount"), "REJECTED")
        .when(done < seq, "REPLAY")
        .when(F.col("gateway") == "OK", "CHARGED")
        .when(F.col("gateway") == "ERROR", "GATEWAY_ERROR")
        .otherwise("UNKNOWN")
    )
    status = (
        F.when(F.col("outcome").isin("REPLAY", "CHARGED"), "COMPLETED")
        .when(F.col("outcome") == "GATEWAY_ERROR", "FAILED")
        .when(F.col("outcome") == "UNKNOWN", "RESERVED")
    )
    return joined.withColumn("outcome", outcome).select(*attempts.columns, "outcome", status.alias("status"))


def operations_after(outcomes: DataFrame) -> DataFrame:
    """Stored operation per key: its amount and its last status."""
    saved = outcomes.filter(F.col("status").isNotNull())
    return saved.groupBy("idempotency_key").agg(F.max_by(F.struct("amount_minor", "status"), "seq").alias("_last")).select(
        "idempotency_key", "_last.*"
    )


def stale_operations(operations: DataFrame, as_of: dt.datetime, older_than: dt.timedelta) -> DataFrame:
    """PENDING operations older than the limit, with their age."""
    at = F.lit(as_of).cast("timestamp_ntz")
    oldest = F.lit(as_of - older_than).cast("timestamp_ntz")
    rows = operations.filter((F.col("status") == "PENDING") & (F.col("created_at") < oldest))
    return rows.withColumn("age_seconds", F.timestamp_diff("SECOND", F.col("created_at"), at))


def stale_summary(stale: DataFrame) -> DataFrame:
    """The two dashboard numbers: how many, and the age of the oldest."""
    return stale.agg(F.count(F.lit(1)).alias("pending"), F.max("age_seconds").alias("max_age_seconds"))


# ---- tokens


def one_use_tokens(tokens: DataFrame, uses: DataFrame) -> DataFrame:
    """``uses`` (use_id, token, used_at) of refresh tokens (token, expires_at) with ``outcome``.

    The first use takes the token away: ROTATED, or EXPIRED when ``expires_at`` is not after it. Any later use is
    REVOKED; a token that was never issued is UNKNOWN.
    """
    first = uses.groupBy(F.col("token").alias("_token")).agg(F.min(F.struct("used_at", "use_id")).alias("_first"))
    issued = tokens.select(F.col("token").alias("_issued"), "expires_at")
    known = first.join(issued, F.col("_token") == F.col("_issued"), "left")
    joined = uses.join(known, F.col("token") == F.col("_token"))
    outcome = (
        F.when(F.col("_issued").isNull(), "UNKNOWN")
        .when(F.col("use_id") != F.col("_first.use_id"), "REVOKED")
        .when(F.col("expires_at") > F.col("used_at"), "ROTATED")
        .otherwise("EXPIRED")
    )
    return joined.select(*uses.columns, outcome.alias("outcome"))


def access_checks(tokens: DataFrame, uses: DataFrame) -> DataFrame:
    """``uses`` of access tokens with the user they stand for, NULL when unknown or expired at that time."""
    issued = tokens.select(F.col("token").alias("_issued"), "user_id", "expires_at")
    joined = uses.join(issued, F.col("token") == F.col("_issued"), "left")
    return joined.select(*uses.columns, F.when(F.col("expires_at") > F.col("used_at"), F.col("user_id")).alias("user_id"))


# ---- queues and errors


def claim_jobs(jobs: DataFrame, workers: int, per_worker: int) -> DataFrame:
    """READY jobs in id order, ``per_worker`` for each worker in turn; jobs beyond the last worker stay unclaimed (NULL).

    Only as many ids as can be claimed are ranked. ``id`` is unique.
    """
    ready = jobs.filter(F.col("status") == "READY")
    first = ready.select(F.col("id").alias("_claimed")).orderBy("_claimed").limit(workers * per_worker)
    ranked = global_rank(first, ["_claimed"], "_rank")
    claimed = ranked.select("_claimed", F.floor((F.col("_rank") - 1) / per_worker).alias("worker"))
    return ready.join(claimed, F.col("id") == F.col("_claimed"), "left").drop("_claimed")


# fixed values: error classes and whether the whole transaction may be run again
ERROR_CLASSES = {
    "40001": ("serialization failure", "yes"),
    "40P01": ("deadlock detected", "yes"),
    "55P03": ("lock timeout", "with care"),
    "23505": ("unique violation", "no"),
    "23514": ("check violation", "no"),
    "57014": ("statement cancelled", "no"),
}


def retryable_errors(errors: DataFrame, code: str) -> DataFrame:
    """Errors per code, with the class and the advice for it; codes outside the list are not to be repeated."""

    def look_up(i: int) -> Column:
        pairs = [F.lit(x) for key, values in ERROR_CLASSES.items() for x in (key, values[i])]
        return F.try_element_at(F.create_map(*pairs), F.col(code))

    counts = errors.groupBy(code).agg(F.count(F.lit(1)).alias("errors"))
    return counts.select(
        code, "errors", F.coalesce(look_up(0), F.lit("other")).alias("class"), F.coalesce(look_up(1), F.lit("no")).alias("retry")
    )
