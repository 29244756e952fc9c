"""Registered queries: generated rows, stored tables, write jobs and migrations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.operators import dml, ledger, migrate, setops
from ledgerspark.operators.scans import global_rank
from ledgerspark.plans.fixtures import KEY_SHIFT, TRANSFER_ORDER
from ledgerspark.plans.registry import query
from ledgerspark.session import materialize, scratch_path
from ledgerspark.sources import seed
from ledgerspark.sources import store as stores
from ledgerspark.sources.schemas import PAYMENT_STATUSES
from ledgerspark.sources.store import VersionedStore


def new_store(v) -> VersionedStore:
    return VersionedStore(v.spark, scratch_path(v.spark, "store"))


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


# ---- generated rows


@query()
def generate_seed(v):
    """One generated payment per order, with the rare PENDING status."""
    return seed.generate_seed(v.payments, "id", ntz("2026-01-01 00:00:00"), ["COMPLETED"], "PENDING")


@query("""SELECT id, lpad(CAST(id % 5000 AS VARCHAR), 12, '0') AS account_id, 100 + id % 90000 AS amount_minor,
  (['PENDING', 'COMPLETED', 'FAILED'])[1 + id % 3] AS status,
  TIMESTAMP '2026-01-01' - to_seconds(id % 15552000) AS created_at FROM payments""")
def generate_seed_modular(v):
    return seed.modular_seed(v.payments, "id", ntz("2026-01-01 00:00:00"), PAYMENT_STATUSES, 5000)


@query("SELECT a.id, a.currency, n FROM accounts_base a CROSS JOIN range(1, 11) t(n)")
def cross_generate(v):
    return seed.cross_generate(v.accounts_base.select("id", "currency"), 10)


@query("""SELECT event_id AS id, concat('User-', CAST(event_id % 5000 + 1 AS VARCHAR), '@Example.TEST') AS email,
  CAST(to_json({'channel': (['web', 'ios', 'android'])[1 + event_id % 3],
    'tags': CASE event_id % 3 WHEN 0 THEN ['retry'] WHEN 1 THEN ['manual', 'review'] ELSE CAST([] AS VARCHAR[]) END,
    'merchant': concat('m-', CAST(event_id % 977 AS VARCHAR))}) AS VARCHAR) AS metadata,
  TIMESTAMP '2024-01-01' + to_seconds(event_id * 30) AS created_at FROM events""")
def append_json_log(v):
    return seed.append_json_log(v.table("events"), "event_id", ntz("2024-01-01 00:00:00"), 30)


# ---- stored tables


@query("SELECT account_id, count(*) AS payments, CAST(sum(amount_minor) AS BIGINT) AS amount FROM payments GROUP BY 1")
def create_table_as(v):
    totals = v.payments.groupBy("account_id").agg(F.count(F.lit(1)).alias("payments"), F.sum("amount_minor").alias("amount"))
    return stores.create_table_as(new_store(v), "totals", totals)


@query("SELECT id, account_id, amount_minor FROM ledger_entries")
def insert_select(v):
    store, columns = new_store(v), ["id", "account_id", "amount_minor"]
    stores.create_table_as(store, "entries", v.ledger_entries.filter("payment_id IS NULL").select(columns))
    return stores.insert_select(store, "entries", v.ledger_entries.filter("payment_id IS NOT NULL").select(columns))


@query("SELECT id, concat('job-', CAST(id AS VARCHAR)) AS payload FROM payments WHERE status = 'PENDING'")
def truncate_reload(v):
    store = new_store(v)
    jobs = v.payments.select("id", F.concat(F.lit("job-"), "id").alias("payload"), "status")
    stores.create_table_as(store, "jobs", jobs.drop("status"))
    return stores.truncate_reload(store, "jobs", jobs.filter("status = 'PENDING'").drop("status"))


@query("""SELECT a.id, s.total AS balance_minor, count(*) AS entries FROM accounts_base a
JOIN ledger_entries e ON e.account_id = a.id JOIN ledger_sums s ON s.account_id = a.id GROUP BY 1, 2""")
def publish_versioned(v):
    """Ledger and balances are published by one job; the reader takes both from the same manifest."""
    store = new_store(v)
    base = store.manifest()
    entries = v.ledger_entries
    balances = ledger.rebuild_projection(v.accounts_base.withColumn("balance_minor", F.lit(0).cast("bigint")), entries)
    version = store.publish(replace={"ledger_entries": entries, "accounts": balances}, base=base)
    counts = store.read("ledger_entries", version).groupBy("account_id").agg(F.count(F.lit(1)).alias("entries"))
    accounts = store.read("accounts", version)
    return accounts.join(counts, F.col("id") == F.col("account_id")).select("id", "balance_minor", "entries")


@query("SELECT id, amount_minor FROM payments")
def snapshot_read(v):
    """The first version, read after a second one has replaced it."""
    store = new_store(v)
    payments = v.payments.select("id", "amount_minor")
    first = store.publish(replace={"payments": payments})
    store.publish(replace={"payments": payments.withColumn("amount_minor", F.col("amount_minor") - 100)})
    return store.read("payments", first)


@query("""SELECT count(*) AS source_rows, count(*) AS copy_rows, CAST(sum(amount_minor) AS BIGINT) AS source_money,
CAST(sum(amount_minor) AS BIGINT) AS copy_money, true AS equal FROM payments""")
def restore_check(v):
    return setops.restore_check(v.payments, materialize(v.payments, "copy"), "amount_minor")


# ---- ledger and writes


@query("SELECT id, account_id, payment_id, amount_minor, created_at FROM ledger_entries")
def post_ledger(v):
    return v.ledger_entries


@query("SELECT key, request_hash, payment_id, created_at FROM idempotency_keys")
def derive_request_keys(v):
    return v.idempotency_keys


@query("SELECT a.id, a.owner_id, a.currency, s.total AS balance_minor, CAST(0 AS BIGINT) AS version FROM accounts_base a JOIN ledger_sums s ON s.account_id = a.id")
def rebuild_projection(v):
    """The drifting balances, recomputed from the entries."""
    return ledger.rebuild_projection(v.accounts, v.ledger_entries)


@query("""SELECT id, CASE WHEN status = 'PENDING' AND id <= 5000 THEN 'COMPLETED' ELSE status END AS status,
  CASE WHEN status = 'PENDING' AND id <= 5000 THEN amount_minor + 1 ELSE amount_minor END AS amount_minor FROM payments""")
def update_where(v):
    hit = (F.col("status") == "PENDING") & (F.col("id") <= 5000)
    rows = v.payments.select("id", "status", "amount_minor")
    return dml.update_where(rows, hit, status=F.lit("COMPLETED"), amount_minor=F.col("amount_minor") + 1)


COMPLETIONS = "completions AS (SELECT l_orderkey * 2 AS id, count(*) AS asked FROM lineitem GROUP BY 1)"


def completions(v):
    return v.table("lineitem").groupBy((F.col("l_orderkey") * 2).alias("id")).agg(F.count(F.lit(1)).alias("asked"))


@query("""SELECT c.id, c.asked, CASE WHEN p.id IS NULL THEN 'NOT_FOUND' WHEN p.status IN ('PENDING', 'COMPLETED') THEN 'APPLIED'
ELSE 'REJECTED' END AS outcome FROM completions c LEFT JOIN payments p ON p.id = c.id""", also=COMPLETIONS)
def state_transition(v):
    return dml.state_transition(v.payments, completions(v), "COMPLETED", ["PENDING"])[1]


@query("""SELECT p.id, CASE WHEN c.id IS NOT NULL AND p.status = 'PENDING' THEN 'COMPLETED' ELSE p.status END AS status
FROM payments p LEFT JOIN completions c ON c.id = p.id""", also=COMPLETIONS)
def state_transition_table(v):
    return dml.state_transition(v.payments, completions(v), "COMPLETED", ["PENDING"])[0].select("id", "status")


BALANCES = """new_balances AS (
  SELECT l_orderkey % 3000 AS id, CAST(round(l_extendedprice * 100) AS BIGINT) AS balance_minor, rank AS seq FROM (
    SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
      l_quantity, l_discount, l_tax) AS rank FROM lineitem))"""


def new_balances(v):
    ranked = global_rank(v.table("lineitem").select(*TRANSFER_ORDER), TRANSFER_ORDER, "seq")
    amount = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return ranked.select((F.col("l_orderkey") % 3000).alias("id"), amount.alias("balance_minor"), "seq")


@query("""SELECT coalesce(n.id, a.id) AS id, coalesce(n.balance_minor, a.balance_minor) AS balance_minor FROM accounts a
FULL JOIN (SELECT id, arg_max(balance_minor, seq) AS balance_minor FROM new_balances GROUP BY id) n ON n.id = a.id""",
       also=BALANCES)
def upsert(v):
    return dml.upsert(v.accounts.select("id", "balance_minor"), new_balances(v), ["id"], "seq")


@query("""SELECT id, arg_min(balance_minor, seq) AS balance_minor, min(seq) AS seq FROM new_balances
WHERE id NOT IN (SELECT id FROM accounts) GROUP BY id""", also=BALANCES)
def insert_ignore(v):
    return dml.insert_ignore(v.accounts.select("id", "balance_minor"), new_balances(v), "id", "seq")


@query("""SELECT id, account_id, amount_minor, status, CASE WHEN NOT amount_minor > 500000 THEN 'amount'
  WHEN status NOT IN ('PENDING', 'COMPLETED') THEN 'status'
  WHEN account_id NOT IN (SELECT id FROM accounts_base) THEN 'account_exists' END AS failed_rule
FROM (SELECT id, account_id + CASE WHEN id % 20 = 0 THEN 1000000000 ELSE 0 END AS account_id, amount_minor, status FROM payments)""")
def insert_checked(v):
    far = F.when(F.col("id") % 20 == 0, 1_000_000_000).otherwise(0)
    new = v.payments.select("id", (F.col("account_id") + far).alias("account_id"), "amount_minor", "status")
    rules = {"amount": F.col("amount_minor") > 500_000, "status": F.col("status").isin("PENDING", "COMPLETED")}
    return dml.insert_checked(new, rules, {"account_exists": ("account_id", v.accounts_base, "id")})


@query("""SELECT seq, email, CASE WHEN seq = min(seq) OVER (PARTITION BY lower(email))
  AND lower(email) NOT IN (SELECT lower(email) FROM users) THEN 'INSERTED' ELSE 'TAKEN' END AS outcome
FROM (SELECT event_id AS seq, concat('user-', CAST(event_id % 4000 AS VARCHAR), '@example.test') AS email FROM events)""")
def insert_unique_email(v):
    new = v.table("events").select(
        F.col("event_id").alias("seq"),
        F.concat(F.when(F.col("event_id") % 2 == 0, "User-").otherwise(" user-"), F.col("event_id") % 4000, F.lit("@example.TEST")).alias("email"),
    )
    return dml.insert_unique_email(v.users, new)


DELETES = "deletes AS (SELECT DISTINCT l_orderkey * 3 AS id FROM lineitem)"


@query("SELECT id, amount_minor FROM payments WHERE id NOT IN (SELECT id FROM deletes)", also=DELETES)
def delete_by_key(v):
    keys = v.table("lineitem").select((F.col("l_orderkey") * 3).alias("id"))
    return dml.delete_by_key(v.payments.select("id", "amount_minor"), keys, "id")[0]


@query("""SELECT d.id, CASE WHEN p.id IS NULL THEN 'NOT_FOUND' ELSE 'DELETED' END AS outcome
FROM deletes d LEFT JOIN payments p ON p.id = d.id""", also=DELETES)
def delete_by_key_outcomes(v):
    keys = v.table("lineitem").select((F.col("l_orderkey") * 3).alias("id"))
    return dml.delete_by_key(v.payments, keys, "id")[1]


@query("SELECT key, payment_id FROM idempotency_keys WHERE created_at >= TIMESTAMP '2001-07-29 00:00:00'")
def purge_expired_keys(v):
    return dml.purge_expired_keys(v.idempotency_keys, dt.datetime(2001, 8, 1), 72).select("key", "payment_id")


@query("""SELECT 5000000000 + id AS id, account_id, payment_id, -amount_minor AS amount_minor,
TIMESTAMP '2002-01-01' AS created_at, id AS reverses_id FROM ledger_entries
WHERE payment_id IN (SELECT id FROM payments WHERE amount_minor > 40000000)""")
def compensate(v):
    chosen = v.payments.filter("amount_minor > 40000000 AND status = 'COMPLETED'").select((F.col("id") + KEY_SHIFT).alias("id"))
    return ledger.compensate(v.ledger_entries, chosen, 5 * KEY_SHIFT, ntz("2002-01-01 00:00:00"))


@query("""SELECT concat('user-', CAST(account_id AS VARCHAR)) AS actor, 'TRANSFER_COMPLETED' AS event_type, id AS entity_id
FROM payments WHERE status = 'COMPLETED'""")
def append_audit(v):
    applied = v.payments.filter("status = 'COMPLETED'")
    return ledger.append_audit(applied.select(F.concat(F.lit("user-"), "account_id").alias("actor"), F.col("id").alias("transfer_id")))


# ---- expand, backfill, contract


@query("""SELECT id, account_id, CASE WHEN status = 'PENDING' THEN 'USD' ELSE 'EUR' END AS currency FROM payments""")
def add_column_default(v):
    """Files without the new column and files with it, read as one table."""
    old = scratch_path(v.spark, "before")
    new = scratch_path(v.spark, "after")
    rows = v.payments.select("id", "account_id", "status")
    rows.filter("status <> 'PENDING'").drop("status").write.parquet(old)
    rows.filter("status = 'PENDING'").drop("status").withColumn("currency", F.lit("USD")).write.parquet(new)
    schema = v.payments.select("id", "account_id").schema
    return migrate.add_column_default(v.spark, [old, new], schema, "currency", T.StringType(), "'EUR'")


@query("""SELECT id, status, CASE WHEN status = 'COMPLETED' THEN created_at + INTERVAL 1 HOUR END AS settled_at FROM payments""")
def backfill_batches(v):
    store = new_store(v)
    table = v.payments.select("id", "status", "created_at", F.lit(None).cast("timestamp_ntz").alias("settled_at"))
    store.publish(replace={"payments": table.repartitionByRange("id")})
    pending = F.col("settled_at").isNull() & (F.col("status") == "COMPLETED")
    hour = F.col("created_at") + F.expr("interval 1 hour")
    size = max(1, v.payments.count() // 3)
    migrate.backfill_batches(store, "payments", pending, {"settled_at": hour}, size)
    return store.read("payments").select("id", "status", "settled_at")


@query("""SELECT '1 check new rows' AS step, count(*) FILTER (WHERE ref IS NULL AND id > 10000) AS violations,
  count(*) FILTER (WHERE ref IS NULL AND id > 10000) = 0 AS allowed FROM refs
UNION ALL SELECT '2 validate all rows', count(*) FILTER (WHERE ref IS NULL), count(*) FILTER (WHERE ref IS NULL) = 0 FROM refs
UNION ALL SELECT '3 require', count(*) FILTER (WHERE ref IS NULL), count(*) FILTER (WHERE ref IS NULL) = 0 FROM refs""",
       also="""refs AS (SELECT id, CASE WHEN id > 10000 OR status = 'COMPLETED' THEN concat('legacy-', CAST(id AS VARCHAR)) END AS ref
  FROM payments)""")
def validate_then_require(v):
    filled = (F.col("id") > 10_000) | (F.col("status") == "COMPLETED")
    refs = v.payments.select("id", F.when(filled, F.concat(F.lit("legacy-"), "id")).alias("ref"))
    return migrate.validate_then_require(refs, "ref", F.col("id") > 10_000)


@query("""SELECT id, CAST(amount_minor AS VARCHAR) AS amount_minor, left(status, 32) AS status FROM payments""")
def change_type(v):
    """bigint to decimal(20,0), shown as text."""
    rows = migrate.change_type(v.payments.select("id", "amount_minor", "status"), "amount_minor", "decimal(20,0)")
    return rows.withColumn("amount_minor", F.col("amount_minor").cast("string"))


@query("""SELECT id, amount, amount <= 2147483647 AS fits, CASE WHEN amount <= 2147483647 THEN CAST(amount AS INTEGER) END AS changed
FROM (SELECT id, amount_minor * 100 AS amount FROM payments)""")
def change_type_split(v):
    """Amounts to int: those that are too large keep their value and are marked."""
    rows = v.payments.select("id", (F.col("amount_minor") * 100).alias("amount"))
    return migrate.change_split(rows, "amount", "int")


@query("SELECT doc_id, length(source) <= 4 AS fits, CASE WHEN length(source) <= 4 THEN source END AS changed FROM documents")
def narrow_text(v):
    """A text column to at most four characters."""
    return migrate.change_split(v.table("documents").select("doc_id", "source"), "source", "string", 4).drop("source")


@query("SELECT id, status FROM payments")
def widen_text(v):
    """32 characters, then 64: nothing is in the way."""
    narrow = migrate.change_type(v.payments.select("id", "status"), "status", "string", 32)
    return migrate.change_type(narrow, "status", "string", 64)


@query("SELECT id, concat('legacy-', CAST(id AS VARCHAR)) AS ref FROM payments")
def require_column(v):
    """A column that every row has got becomes required."""
    return migrate.require_column(v.payments.select("id", F.concat(F.lit("legacy-"), "id").alias("ref")), "ref")


@query("SELECT id, amount_minor * 100 AS amount FROM payments WHERE amount_minor * 100 > 2147483647")
def change_type_violations(v):
    rows = v.payments.select("id", (F.col("amount_minor") * 100).alias("amount"))
    return migrate.change_violations(rows, "amount", "int")
