"""Registered queries: table layouts, file and column profiles."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators import layout as L
from ledgerspark.operators import sketches as K
from ledgerspark.operators.aggregates import selectivity_report as selectivity
from ledgerspark.plans.registry import query
from ledgerspark.plans.relational import METADATA, documents
from ledgerspark.session import materialize, scratch_path
from ledgerspark.sources.schemas import TABLES


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def read_back(v, df, path):
    return v.spark.read.schema(df.schema).parquet(path)


@query()
def layout_sorted(v):
    """Files and blocks of 1000 rows that one account's history of a year cannot skip, in both column orders."""
    payments = v.payments.select("account_id", "created_at", "id", "amount_minor")
    bounds = {"account_id": (F.lit(42), F.lit(42)), "created_at": (ntz("1996-01-01 00:00:00"), ntz("1997-01-01 00:00:00"))}
    reports = []
    for name, order in {"account, time": ["account_id", "created_at"], "time, account": ["created_at", "account_id"]}.items():
        path = scratch_path(v.spark, "sorted")
        L.layout_sorted(payments, order, path)
        for unit, rows in {"file": None, "block": 1000}.items():
            touched = L.zones_touched(read_back(v, payments, path), bounds, rows)
            reports.append(touched.select(F.lit(name).alias("order"), F.lit(unit).alias("unit"), "*"))
    return reduce(DataFrame.unionByName, reports)


@query("""SELECT id, amount_minor FROM payments WHERE account_id = 42 AND created_at >= TIMESTAMP '1996-01-01'""")
def layout_sorted_rows(v):
    payments = v.payments.select("account_id", "created_at", "id", "amount_minor")
    path = scratch_path(v.spark, "sorted")
    L.layout_sorted(payments, ["account_id", "created_at"], path)
    since = F.col("created_at") >= ntz("1996-01-01 00:00:00")
    return read_back(v, payments, path).filter((F.col("account_id") == 42) & since).select("id", "amount_minor")


@query("SELECT id, created_at FROM payments WHERE status = 'PENDING' AND created_at < TIMESTAMP '2001-07-01'")
def layout_subset(v):
    pending = F.col("status") == "PENDING"
    side = L.layout_subset(v.payments, pending, ["id", "created_at"], scratch_path(v.spark, "subset"), ["created_at"])
    return side.filter(F.col("created_at") < ntz("2001-07-01 00:00:00"))


@query("""SELECT account_id, count(*) AS total, CAST(sum(amount_minor) AS BIGINT) AS amount FROM payments
WHERE created_at > TIMESTAMP '2001-05-01' GROUP BY 1""")
def layout_covering(v):
    narrow = L.layout_covering(v.payments, ["account_id", "created_at"], ["amount_minor"], scratch_path(v.spark, "covering"))
    recent = narrow.filter(F.col("created_at") > ntz("2001-05-01 00:00:00"))
    return recent.groupBy("account_id").agg(F.count(F.lit(1)).alias("total"), F.sum("amount_minor").alias("amount"))


@query("SELECT id, created_at FROM operations WHERE created_at >= TIMESTAMP '2024-01-08' AND created_at < TIMESTAMP '2024-01-15'")
def layout_time_ranges(v):
    """An append-only log in time order, read through its zone map."""
    log = v.operations.select("id", "created_at")
    path = scratch_path(v.spark, "zones")
    L.layout_sorted(log, ["created_at"], path)
    low, high = ntz("2024-01-08 00:00:00"), ntz("2024-01-15 00:00:00")
    return L.prune_by_zone(v.spark, read_back(v, log, path), "created_at", low, high)


@query("""SELECT count(*) AS rows, min(created_at) AS first_at, max(created_at) AS last_at FROM operations""")
def zone_map_totals(v):
    log = v.operations.select("id", "created_at")
    path = scratch_path(v.spark, "zones")
    L.layout_sorted(log, ["created_at"], path)
    zones = L.zone_map(read_back(v, log, path), ["created_at"])
    return zones.agg(F.sum("rows").alias("rows"), F.min("min_created_at").alias("first_at"), F.max("max_created_at").alias("last_at"))


@query("SELECT id, email FROM operations WHERE lower(email) = 'user-42@example.test'")
def layout_normalized_key(v):
    rows = v.operations.select("id", "email")
    keyed = L.layout_normalized_key(rows, "email", "email_key", scratch_path(v.spark, "keyed"))
    return keyed.filter(F.col("email_key") == "user-42@example.test").select("id", "email")


@query("SELECT id FROM documents_of WHERE metadata->>'$.merchant' = 'm-42' AND list_contains(CAST(metadata->'$.tags' AS VARCHAR[]), 'retry')",
       also=METADATA)
def layout_inverted(v):
    index = L.layout_inverted(documents(v), "id", "metadata", scratch_path(v.spark, "inverted"))
    return L.inverted_lookup(index, "id", merchant="m-42", tags="retry")


@query("SELECT id FROM operations WHERE merchant = 'm-42' AND channel = 'web'")
def layout_inverted_nested(v):
    """Members below the top level: the document is held by another one."""
    inner = F.struct(F.struct("channel", "tags").alias("how"), F.array(F.struct("merchant")).alias("who"))
    nested = v.operations.select("id", F.to_json(F.struct(inner.alias("call"))).alias("metadata"))
    index = L.layout_inverted(nested, "id", "metadata", scratch_path(v.spark, "inverted"))
    return L.inverted_lookup(index, "id", **{"call.who.merchant": "m-42", "call.how.channel": "web"})


@query("SELECT id FROM operations WHERE merchant = 'm-42' AND channel = 'web'")
def layout_inverted_kinds(v):
    """Names with dots, texts that look like JSON, numbers beside equal texts, and members of one array element."""
    merchant, channel = F.col("merchant"), F.col("channel")
    items = F.array(F.struct(merchant.alias("m"), channel.alias("c")), F.struct(F.lit("m-42").alias("m"), F.lit("none").alias("c")))
    document = F.struct(
        channel.alias("a.b"), F.struct(merchant.alias("b")).alias("a"), F.concat(F.lit('["'), channel, F.lit('"]')).alias("text"),
        F.when(channel == "web", 1.5).alias("n"), F.lit("1.5").alias("s"), items.alias("items"))
    rows = v.operations.select("id", F.to_json(document).alias("metadata"))
    index = L.layout_inverted(rows, "id", "metadata", scratch_path(v.spark, "inverted"))
    return L.inverted_lookup(index, "id", {
        L.json_path("a.b"): "web", "a.b": "m-42", "text": '["web"]', "n": 1.50, "s": "1.5", "items": {"m": "m-42", "c": "web"}})


@query("SELECT account_id, count(*) AS payments, CAST(sum(amount_minor) AS BIGINT) AS amount FROM payments GROUP BY 1")
def layout_bucketed(v):
    path = scratch_path(v.spark, "bucketed")
    table = "bucketed_" + path.rsplit("-", 1)[1]
    bucketed = L.layout_bucketed(v.payments, table, "account_id", None, path)
    return bucketed.groupBy("account_id").agg(F.count(F.lit(1)).alias("payments"), F.sum("amount_minor").alias("amount"))


@query()
def write_cost_report(v):
    rows = v.payments.select("id", "account_id", "amount_minor", "status", "created_at")
    return L.write_cost_report(rows, {"by account": ["account_id", "created_at"], "by time": ["created_at"]})


PROFILED = ["id", "account_id", "payment_id", "amount_minor", "created_at"]


def _profile(different: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, round(CAST(count(*) - count({c}) AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE), 4) AS null_pct,
  {different.format(c)}, CAST(min({c}) AS VARCHAR) AS smallest, CAST(max({c}) AS VARCHAR) AS largest FROM ledger_entries""" for c in PROFILED)


@query(_profile("count(DISTINCT {}) AS different"))
def profile_columns(v):
    return L.profile_columns(v.ledger_entries, PROFILED, exact=True)


@query(_profile("true AS near"))
def profile_sketches(v):
    """Two batches, sketched apart, as one profile; the estimates are compared with the exact counts."""
    entries, late = v.ledger_entries, F.col("id") % 3 == 0
    stored = K.column_sketches(entries.filter(~late)).unionByName(K.column_sketches(entries.filter(late)))
    found = K.profile(materialize(stored, "sketches"))
    exact = L.profile_columns(entries, PROFILED, exact=True).select(F.col("column").alias("_column"), F.col("different").alias("_exact"))
    near = F.abs(F.col("different") - F.col("_exact")) <= F.col("_exact") * K.COUNT_ERROR
    return found.join(exact, F.col("column") == F.col("_column")).select("column", "rows", "null_pct", near.alias("near"), "smallest", "largest")


@query("""SELECT event_type, count(*) AS total, round(CAST(count(*) AS DOUBLE) * 100 / CAST(sum(count(*)) OVER () AS DOUBLE), 4) AS percent
FROM events GROUP BY 1 ORDER BY total DESC, event_type LIMIT 3""")
def common_values(v):
    return L.common_values(v.table("events"), "event_type", 3)


@query("""SELECT 'status is COMPLETED' AS predicate, count(*) FILTER (WHERE status = 'COMPLETED') AS matching,
  round(CAST(count(*) FILTER (WHERE status = 'COMPLETED') AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE), 4) AS percent FROM payments
UNION ALL SELECT 'account is 42', count(*) FILTER (WHERE account_id = 42),
  round(CAST(count(*) FILTER (WHERE account_id = 42) AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE), 4) FROM payments
UNION ALL SELECT 'since 2000', count(*) FILTER (WHERE created_at >= TIMESTAMP '2000-01-01'),
  round(CAST(count(*) FILTER (WHERE created_at >= TIMESTAMP '2000-01-01') AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE), 4) FROM payments""")
def selectivity_report(v):
    return selectivity(v.payments, {
        "status is COMPLETED": F.col("status") == "COMPLETED",
        "account is 42": F.col("account_id") == 42,
        "since 2000": F.col("created_at") >= F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz"),
    })


@query("""SELECT 'events.parquet' AS file, round(corr(CAST(event_id AS DOUBLE), epoch(ts)), 6) AS ts,
  round(corr(CAST(event_id AS DOUBLE), CAST(user_id AS DOUBLE)), 6) AS user_id FROM events""")
def order_correlation(v):
    """The events are stored in the order of their id."""
    found = L.order_correlation(v.table("events"), {"ts": F.col("ts").cast("timestamp"), "user_id": F.col("user_id")})
    return found.select("file", F.round("ts", 6).alias("ts"), F.round("user_id", 6).alias("user_id"))


@query("SELECT 'orders.parquet' AS file, CAST(i // 1000 AS BIGINT) AS page, count(*) AS tuples FROM range(0, (SELECT count(*) FROM orders)) t(i) GROUP BY ALL")
def rows_per_page(v):
    return L.rows_per_page(v.table("orders"), 1000)


@query("SELECT event_id, 'events.parquet' AS file, event_id AS row_index FROM events")
def physical_address(v):
    """The events are stored in the order of their id."""
    return L.physical_address(v.table("events"), "event_id")


@query()
def table_sizes(v):
    return L.table_sizes({name: v.table(name) for name in TABLES})


@query(" UNION ALL ".join(f"SELECT '{name}' AS relname, count(*) AS rows FROM {name}" for name in TABLES))
def table_rows(v):
    return L.table_sizes({name: v.table(name) for name in TABLES}).select("relname", "rows")


VERSIONS = """versions AS (
  SELECT l_orderkey AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS version,
         l_partkey AS value FROM lineitem)"""


def versions(v):
    """All line items of an order as versions of one row; the stored order decides nothing."""
    return v.table("lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("version"),
        F.col("l_partkey").alias("value"),
    )


@query("SELECT count(DISTINCT id) AS live, count(*) - count(DISTINCT id) AS dead FROM versions", also=VERSIONS)
def live_and_dead(v):
    return L.live_and_dead(versions(v), "id", "version")


@query("SELECT id, arg_max(value, version) AS value FROM versions GROUP BY id", also=VERSIONS)
def compact(v):
    return L.compact(versions(v), "id", "version", scratch_path(v.spark, "compact")).select("id", "value")
