"""The payments model derived from the given tables, as DataFrames and as the SQL text the oracles start from."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators import ledger
from ledgerspark.operators.scans import global_rank
from ledgerspark.sources.tables import scan_named

OPENING_MINOR = 1_000_000_000
SMALL_OPENING_MINOR = 50_000_000
OPENING_TIME = "1995-01-01 00:00:00"
KEY_SHIFT = 1_000_000_000

TRANSFER_ORDER = [
    "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    "l_extendedprice", "l_quantity", "l_discount", "l_tax",
]

PRELUDE = """
WITH users AS (
  SELECT c_custkey AS id, concat('User-', CAST(c_custkey AS VARCHAR), '@Example.TEST') AS email FROM customer),
accounts_base AS (
  SELECT c_custkey AS id, c_custkey AS owner_id,
         CASE c_nationkey % 3 WHEN 0 THEN 'RUB' WHEN 1 THEN 'USD' ELSE 'EUR' END AS currency
  FROM customer),
payments AS (
  SELECT o_orderkey AS id, o_custkey AS account_id, CAST(round(o_totalprice * 100) AS BIGINT) AS amount_minor,
         CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'P' THEN 'PENDING' ELSE 'FAILED' END AS status,
         o_orderdate AS created_at
  FROM orders),
ledger_entries AS (
  SELECT id, id AS account_id, CAST(NULL AS BIGINT) AS payment_id, CAST(1000000000 AS BIGINT) AS amount_minor,
         CAST('1995-01-01 00:00:00' AS TIMESTAMP) AS created_at
  FROM accounts_base
  UNION ALL
  SELECT 1000000000 + id, account_id, id, -amount_minor, created_at FROM payments WHERE status = 'COMPLETED'),
ledger_sums AS (
  SELECT account_id, CAST(sum(amount_minor) AS BIGINT) AS total FROM ledger_entries GROUP BY account_id),
accounts AS (
  SELECT a.id, a.owner_id, a.currency,
         coalesce(s.total, 0) + CASE WHEN a.id % 10 = 0 THEN 1 ELSE 0 END AS balance_minor, CAST(0 AS BIGINT) AS version
  FROM accounts_base a LEFT JOIN ledger_sums s ON s.account_id = a.id),
idempotency_keys AS (
  SELECT concat('seed-', CAST(id AS VARCHAR)) AS key,
         md5(concat(CAST(account_id AS VARCHAR), ':', CAST(amount_minor AS VARCHAR))) AS request_hash,
         id AS payment_id, created_at
  FROM payments WHERE status <> 'FAILED'),
transfer_requests AS (
  SELECT row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                     l_extendedprice, l_quantity, l_discount, l_tax) AS seq,
         concat(CAST(l_orderkey AS VARCHAR), ':', CAST(l_linenumber AS VARCHAR)) AS idempotency_key,
         o_custkey AS from_account, l_partkey % (SELECT count(*) FROM customer) AS to_account,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS amount_minor,
         concat('user-', CAST(o_custkey AS VARCHAR)) AS actor
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
operations AS (
  SELECT event_id AS id, concat('User-', CAST(user_id AS VARCHAR), '@Example.TEST') AS email,
         CASE event_id % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'ios' ELSE 'android' END AS channel,
         CASE event_id % 3 WHEN 0 THEN ['retry'] WHEN 1 THEN ['manual', 'review'] ELSE CAST([] AS VARCHAR[]) END AS tags,
         concat('m-', CAST(event_id % 977 AS VARCHAR)) AS merchant, ts AS created_at
  FROM events),
access_log AS (
  SELECT event_id AS tx, user_id AS read_row, (user_id * 7 + event_id) % 50 AS write_row, ts AS started_at,
         ts + to_seconds(60 + event_id % 240) AS committed_at,
         event_id AS written_version, event_id - 1 - event_id % 3 AS read_version
  FROM events),
sessions AS (
  SELECT event_id AS pid,
         CASE WHEN event_id % 7 = 0 THEN 'idle in transaction' ELSE 'active' END AS state,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'Lock' END AS wait_event_type,
         concat(event_type, '   on  row ', CAST(user_id AS VARCHAR)) AS query, ts AS xact_start,
         CASE WHEN event_id % 100 = 50 THEN [event_id + 1] WHEN event_id % 100 = 51 THEN [event_id - 1]
              WHEN event_id % 7 <> 0 THEN [event_id - 1] ELSE CAST([] AS BIGINT[]) END AS blocked_by
  FROM events),
rate_periods AS (
  SELECT o_orderkey AS id, o_custkey AS currency, o_orderdate AS starts_at,
         o_orderdate + to_days(CAST(1 + o_orderkey % 9 AS INTEGER)) AS ends_at
  FROM orders)
"""


class Views:
    """Lazy DataFrames over one data folder; each equals the CTE of the same name in ``PRELUDE``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return scan_named(self.spark, self.folder, name)

    @cached_property
    def users(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("id"), F.concat(F.lit("User-"), "c_custkey", F.lit("@Example.TEST")).alias("email")
        )

    @cached_property
    def accounts_base(self) -> DataFrame:
        kind = F.col("c_nationkey") % 3
        return self.table("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_custkey").alias("owner_id"),
            F.when(kind == 0, "RUB").when(kind == 1, "USD").otherwise("EUR").alias("currency"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("account_id"),
            F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount_minor"),
            F.when(status == "F", "COMPLETED").when(status == "P", "PENDING").otherwise("FAILED").alias("status"),
            F.col("o_orderdate").alias("created_at"),
        )

    @cached_property
    def ledger_entries(self) -> DataFrame:
        return ledger.post_ledger(self.accounts_base, self.payments, OPENING_MINOR, OPENING_TIME, KEY_SHIFT)

    @cached_property
    def accounts(self) -> DataFrame:
        """Stored balances that drift by one minor unit on every tenth account."""
        rebuilt = ledger.rebuild_projection(self.accounts_base.withColumn("balance_minor", F.lit(0)), self.ledger_entries)
        drift = F.when(F.col("id") % 10 == 0, 1).otherwise(0)
        return rebuilt.withColumn("balance_minor", F.col("balance_minor") + drift).withColumn("version", F.lit(0).cast("bigint"))

    @cached_property
    def idempotency_keys(self) -> DataFrame:
        return ledger.derive_request_keys(self.payments)

    @cached_property
    def transfer_requests(self) -> DataFrame:
        customers = self.table("customer").agg(F.count(F.lit(1)).alias("n"))
        lines = self.table("lineitem").select(*TRANSFER_ORDER)
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        read = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "o_custkey"]
        return global_rank(joined, TRANSFER_ORDER, "seq", keep=read).select(
            "seq",
            F.concat_ws(":", "l_orderkey", "l_linenumber").alias("idempotency_key"),
            F.col("o_custkey").alias("from_account"),
            (F.col("l_partkey") % customers.scalar()).alias("to_account"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("amount_minor"),
            F.concat(F.lit("user-"), "o_custkey").alias("actor"),
        )

    @cached_property
    def operations(self) -> DataFrame:
        kind = F.col("event_id") % 3
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.concat(F.lit("User-"), "user_id", F.lit("@Example.TEST")).alias("email"),
            F.when(kind == 0, "web").when(kind == 1, "ios").otherwise("android").alias("channel"),
            F.when(kind == 0, F.array(F.lit("retry")))
            .when(kind == 1, F.array(F.lit("manual"), F.lit("review")))
            .otherwise(F.array().cast("array<string>"))
            .alias("tags"),
            F.concat(F.lit("m-"), F.col("event_id") % 977).alias("merchant"),
            F.col("ts").alias("created_at"),
        )

    @cached_property
    def access_log(self) -> DataFrame:
        event = F.col("event_id")
        return self.table("events").select(
            event.alias("tx"),
            F.col("user_id").alias("read_row"),
            ((F.col("user_id") * 7 + event) % 50).alias("write_row"),
            F.col("ts").alias("started_at"),
            (F.col("ts") + F.make_dt_interval(secs=(60 + event % 240))).alias("committed_at"),
            event.alias("written_version"),
            (event - 1 - event % 3).alias("read_version"),
        )

    @cached_property
    def sessions(self) -> DataFrame:
        pid = F.col("event_id")
        none = F.array().cast("array<bigint>")
        return self.table("events").select(
            pid.alias("pid"),
            F.when(pid % 7 == 0, "idle in transaction").otherwise("active").alias("state"),
            F.when(pid % 7 != 0, "Lock").alias("wait_event_type"),
            F.concat("event_type", F.lit("   on  row "), "user_id").alias("query"),
            F.col("ts").alias("xact_start"),
            F.when(pid % 100 == 50, F.array(pid + 1))
            .when(pid % 100 == 51, F.array(pid - 1))
            .when(pid % 7 != 0, F.array(pid - 1))
            .otherwise(none)
            .alias("blocked_by"),
        )

    @cached_property
    def rate_periods(self) -> DataFrame:
        start = F.col("o_orderdate")
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("currency"),
            start.alias("starts_at"),
            (start + F.make_dt_interval(days=(1 + F.col("o_orderkey") % 9).cast("int"))).alias("ends_at"),
        )
