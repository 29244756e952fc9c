"""Registered queries: integrity rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.operators import rules as R
from ledgerspark.plans.registry import query
from ledgerspark.plans.relational import TRANSFER_ENTRIES, transfer_entries

BROKEN = """broken AS (
  SELECT id, CASE WHEN id % 97 <> 0 THEN account_id END AS account_id,
         CASE WHEN id % 89 = 0 THEN -amount_minor ELSE amount_minor END AS amount_minor,
         CASE WHEN id % 83 = 0 THEN lower(status) ELSE status END AS status, created_at FROM payments)"""


def broken(v):
    key = F.col("id")
    return v.payments.select(
        "id",
        F.when(key % 97 != 0, F.col("account_id")).alias("account_id"),
        F.when(key % 89 == 0, -F.col("amount_minor")).otherwise(F.col("amount_minor")).alias("amount_minor"),
        F.when(key % 83 == 0, F.lower("status")).otherwise(F.col("status")).alias("status"),
        "created_at",
    )


@query("SELECT id, amount_minor FROM broken WHERE account_id IS NULL", also=BROKEN)
def check_not_null(v):
    return R.violating_rows(broken(v), {"account": R.not_null("account_id")}).select("id", "amount_minor")


@query("""SELECT 'account_not_null' AS rule, count(*) FILTER (WHERE account_id IS NULL) AS violations FROM broken
UNION ALL SELECT 'amount_positive', count(*) FILTER (WHERE amount_minor <= 0) FROM broken
UNION ALL SELECT 'status_known', count(*) FILTER (WHERE status NOT IN ('PENDING', 'COMPLETED', 'FAILED')) FROM broken""",
       also=BROKEN)
def check_predicate(v):
    return R.check_predicates(broken(v), R.payment_rules())


@query("""SELECT id, concat_ws(',', CASE WHEN account_id IS NULL THEN 'account_not_null' END,
  CASE WHEN amount_minor <= 0 THEN 'amount_positive' END,
  CASE WHEN status NOT IN ('PENDING', 'COMPLETED', 'FAILED') THEN 'status_known' END) AS broken
FROM broken WHERE account_id IS NULL OR amount_minor <= 0 OR status NOT IN ('PENDING', 'COMPLETED', 'FAILED')""", also=BROKEN)
def violating_rows(v):
    rows = R.violating_rows(broken(v), R.payment_rules())
    return rows.select("id", F.array_join("broken", ",").alias("broken"))


@query("""SELECT l_orderkey AS key0, l_linenumber AS key1, count(*) AS copies FROM lineitem
GROUP BY ALL HAVING count(*) > 1""")
def check_unique(v):
    return R.check_unique(v.table("lineitem"), [F.col("l_orderkey"), F.col("l_linenumber")])


@query("""SELECT lower(email) AS key0, count(*) AS copies FROM operations WHERE channel <> 'web'
GROUP BY 1 HAVING count(*) > 1""")
def check_unique_conditional(v):
    return R.check_unique(v.operations, [F.lower("email")], F.col("channel") != "web")


@query("""SELECT id, account_id FROM (SELECT id, account_id + CASE WHEN id % 50 = 0 THEN 1000000000 ELSE 0 END AS account_id
FROM broken) WHERE account_id NOT IN (SELECT id FROM accounts_base)""", also=BROKEN)
def check_foreign_key(v):
    far = F.when(F.col("id") % 50 == 0, 1_000_000_000).otherwise(0)
    child = broken(v).select("id", (F.col("account_id") + far).alias("account_id"))
    return R.check_foreign_key(child, "account_id", v.accounts_base, "id")


OVERLAP = """SELECT id, currency, starts_at, latest_end FROM (SELECT *, max(ends_at) OVER (PARTITION BY currency
ORDER BY starts_at, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest_end FROM {}) WHERE latest_end > starts_at"""


@query(OVERLAP.format("rate_periods"))
def check_no_overlap(v):
    rows = R.check_no_overlap(v.rate_periods, "currency", "starts_at", "ends_at")
    return rows.select("id", "currency", "starts_at", "latest_end")


@query(OVERLAP.format("hot_periods"), also="""hot_periods AS (
  SELECT id, CASE WHEN currency % 3 = 0 THEN 0 ELSE currency END AS currency, starts_at, ends_at FROM rate_periods)""")
def check_no_overlap_hot(v):
    currency = F.when(F.col("currency") % 3 == 0, 0).otherwise(F.col("currency"))
    rows = R.check_no_overlap(v.rate_periods.withColumn("currency", currency), "currency", "starts_at", "ends_at", 2000)
    return rows.select("id", "currency", "starts_at", "latest_end")


@query("""SELECT a.id, a.balance_minor, coalesce(s.total, 0) AS ledger_balance, a.balance_minor - coalesce(s.total, 0) AS drift_minor
FROM accounts a LEFT JOIN ledger_sums s ON s.account_id = a.id WHERE a.balance_minor <> coalesce(s.total, 0)""")
def reconcile_drift(v):
    return R.reconcile_drift(v.accounts, v.ledger_entries)


@query("""SELECT id, account_id FROM payments WHERE status = 'COMPLETED'
AND id NOT IN (SELECT payment_id FROM ledger_entries WHERE payment_id IS NOT NULL AND id % 7 <> 0)""")
def unposted_payments(v):
    """Against a ledger that has lost every seventh entry."""
    return R.unposted_payments(v.payments, v.ledger_entries.filter("id % 7 <> 0")).select("id", "account_id")


@query("""SELECT payment_id, count(*) AS keys_pointing_here FROM (SELECT payment_id FROM idempotency_keys
UNION ALL SELECT payment_id FROM idempotency_keys WHERE payment_id % 60 = 0) GROUP BY 1 HAVING count(*) > 1""")
def multi_key_payments(v):
    """Every sixtieth payment has got a second key."""
    keys = v.idempotency_keys.select("payment_id")
    return R.multi_key_payments(keys.unionByName(keys.filter("payment_id % 60 = 0")))


@query("""SELECT *, before_minor = after_minor AND entries_minor = 0 AS conserved FROM (
SELECT (SELECT CAST(sum(balance_minor) AS BIGINT) FROM accounts) AS before_minor,
  (SELECT CAST(sum(balance_minor) AS BIGINT) FROM accounts) + (SELECT CAST(sum(amount_minor) AS BIGINT) FROM transfer_entries
   WHERE account_id IN (SELECT id FROM accounts)) AS after_minor,
  (SELECT CAST(sum(amount_minor) AS BIGINT) FROM transfer_entries) AS entries_minor)""", also=TRANSFER_ENTRIES)
def money_conserved(v):
    entries = transfer_entries(v)
    moved = entries.groupBy(F.col("account_id").alias("_id")).agg(F.sum("amount_minor").alias("_moved"))
    after = v.accounts.join(moved, F.col("id") == F.col("_id"), "left").select(
        "id", (F.col("balance_minor") + F.coalesce("_moved", F.lit(0))).alias("balance_minor")
    )
    return R.money_conserved(v.accounts, after, entries)


@query("SELECT id, account_id, amount_minor FROM ledger_entries WHERE id % 61 = 0 OR id % 53 = 0")
def ledger_append_only(v):
    """Against a newer version that has lost some entries and changed others."""
    rows = v.ledger_entries.select("id", "account_id", "amount_minor", "created_at")
    changed = F.when(F.col("id") % 53 == 0, F.col("amount_minor") + 1).otherwise(F.col("amount_minor"))
    newer = rows.filter("id % 61 <> 0").withColumn("amount_minor", changed)
    return R.ledger_append_only(rows, newer).select("id", "account_id", "amount_minor")


@query("""SELECT rule, CAST(violations AS BIGINT) AS violations FROM (
  SELECT 'payments.account_not_null' AS rule, count(*) FILTER (WHERE account_id IS NULL) AS violations FROM broken
  UNION ALL SELECT 'payments.amount_positive', count(*) FILTER (WHERE amount_minor <= 0) FROM broken
  UNION ALL SELECT 'payments.status_known', count(*) FILTER (WHERE status NOT IN ('PENDING', 'COMPLETED', 'FAILED')) FROM broken
  UNION ALL SELECT 'accounts.currency_code', count(*) FILTER (WHERE NOT regexp_full_match(currency, '[A-Z]{3}')) FROM accounts
  UNION ALL SELECT 'accounts.balance_not_negative', count(*) FILTER (WHERE balance_minor < 0) FROM accounts
  UNION ALL SELECT 'ledger.account_not_null', count(*) FILTER (WHERE account_id IS NULL) FROM ledger_entries
  UNION ALL SELECT 'ledger.amount_not_zero', count(*) FILTER (WHERE amount_minor = 0) FROM ledger_entries
  UNION ALL SELECT 'accounts.owner_currency_unique', count(*) FROM (SELECT 1 FROM accounts GROUP BY owner_id, currency HAVING count(*) > 1)
  UNION ALL SELECT 'keys.key_unique', count(*) FROM (SELECT 1 FROM idempotency_keys GROUP BY key HAVING count(*) > 1)
  UNION ALL SELECT 'keys.payment_unique', count(*) FROM (SELECT 1 FROM idempotency_keys GROUP BY payment_id HAVING count(*) > 1)
  UNION ALL SELECT 'payments.account_exists', count(*) FROM broken WHERE account_id NOT IN (SELECT id FROM accounts)
  UNION ALL SELECT 'ledger.account_exists', count(*) FROM ledger_entries WHERE account_id NOT IN (SELECT id FROM accounts)
  UNION ALL SELECT 'ledger.payment_exists', count(*) FROM ledger_entries WHERE payment_id NOT IN (SELECT id FROM broken)
  UNION ALL SELECT 'accounts.no_drift', count(*) FROM accounts a LEFT JOIN ledger_sums s ON s.account_id = a.id WHERE a.balance_minor <> coalesce(s.total, 0)
  UNION ALL SELECT 'payments.posted', count(*) FROM broken WHERE status = 'COMPLETED' AND id NOT IN
    (SELECT payment_id FROM ledger_entries WHERE payment_id IS NOT NULL))""", also=BROKEN)
def validate_all(v):
    return R.validate_all(v.accounts, broken(v), v.ledger_entries, v.idempotency_keys)
