"""Registered queries: projections, filters, joins, aggregates, windows, pages and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerspark.functions import scalars as S
from ledgerspark.operators import aggregates as A
from ledgerspark.operators import filters as P
from ledgerspark.operators import joins as J
from ledgerspark.operators import ledger, paging, setops
from ledgerspark.operators import sketches as K
from ledgerspark.operators import windows as W
from ledgerspark.operators.postings import TextIndex
from ledgerspark.plans.registry import query
from ledgerspark.session import materialize, scratch_path

# Groups above this many rows are cut in the ``*_hot`` queries, which put a third of all rows on one account.
HOT_SPLIT = 2000
HOT_LEDGER = """hot_ledger AS (
  SELECT id, CASE WHEN account_id % 3 = 0 THEN 0 ELSE account_id END AS account_id, amount_minor, created_at
  FROM ledger_entries)"""


def hot_account():
    return F.when(F.col("account_id") % 3 == 0, 0).otherwise(F.col("account_id")).alias("account_id")


def hot_ledger(v):
    return v.ledger_entries.select("id", hot_account(), "amount_minor", "created_at")


# ---- projections and filters


@query("SELECT * FROM orders")
def scan_table(v):
    return v.table("orders")


@query("SELECT id, account_id, amount_minor, status, created_at FROM payments WHERE id = 42")
def point_lookup(v):
    return P.point_lookup(v.payments, "id", 42)


@query("SELECT id, account_id, amount_minor FROM payments WHERE account_id = (SELECT max(account_id) FROM payments)")
def lookup_by_subquery(v):
    newest = v.payments.agg(F.max("account_id"))
    return P.lookup_by_subquery(v.payments, "account_id", newest).select("id", "account_id", "amount_minor")


@query("""SELECT id, account_id, status, amount_minor, created_at FROM payments
WHERE account_id = 42 AND created_at >= TIMESTAMP '1996-01-01' ORDER BY created_at DESC, id DESC LIMIT 50""")
def history(v):
    rows = P.history(v.payments, "account_id", 42, dt.datetime(1996, 1, 1), 50)
    return rows.select("id", "account_id", "status", "amount_minor", "created_at")


@query("""SELECT id, amount_minor FROM payments
WHERE created_at >= TIMESTAMP '1996-06-01' AND created_at < TIMESTAMP '1996-06-08'""")
def history_between(v):
    return P.history_between(v.payments, dt.datetime(1996, 6, 1), dt.datetime(1996, 6, 8)).select("id", "amount_minor")


@query("""SELECT id, created_at FROM payments WHERE status = 'PENDING' AND created_at < TIMESTAMP '1996-01-01'
ORDER BY created_at, id LIMIT 100""")
def pending_before(v):
    return P.pending_before(v.payments, dt.datetime(1996, 1, 1), 100).select("id", "created_at")


@query("SELECT id, account_id, amount_minor FROM ledger_entries WHERE payment_id IS NULL")
def filter_null(v):
    return P.filter_null(v.ledger_entries, "payment_id").select("id", "account_id", "amount_minor")


@query("SELECT id, account_id, payment_id FROM ledger_entries WHERE payment_id IS DISTINCT FROM 7")
def filter_null_safe(v):
    return P.filter_null_safe(v.ledger_entries, "payment_id", 7).select("id", "account_id", "payment_id")


@query("SELECT id, currency FROM accounts_base WHERE id IN (1, 5, 42, 100)")
def filter_in_list(v):
    return P.filter_in_list(v.accounts_base, "id", [1, 5, 42, 100]).select("id", "currency")


@query("SELECT id, currency FROM accounts_base WHERE id IN (SELECT account_id FROM payments WHERE status = 'PENDING')")
def filter_in_subquery(v):
    pending = v.payments.filter("status = 'PENDING'").select("account_id")
    return P.filter_in_subquery(v.accounts_base, "id", pending).select("id", "currency")


REQUEST_NAMES = """request_names AS (
  SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN 'RUB' WHEN 1 THEN 'usd' WHEN 2 THEN 'EURO' ELSE 'EUR' END AS currency,
         CASE event_id % 5 WHEN 0 THEN concat('req id ', event_type) WHEN 1 THEN repeat('x', 129)
              ELSE concat(event_type, ':', CAST(event_id AS VARCHAR)) END AS request_id
  FROM events)"""


def request_names(v):
    e = F.col("event_id")
    return v.table("events").select(
        e.alias("id"),
        F.when(e % 4 == 0, "RUB").when(e % 4 == 1, "usd").when(e % 4 == 2, "EURO").otherwise("EUR").alias("currency"),
        F.when(e % 5 == 0, F.concat(F.lit("req id "), "event_type"))
        .when(e % 5 == 1, F.repeat(F.lit("x"), 129))
        .otherwise(F.concat_ws(":", "event_type", e))
        .alias("request_id"),
    )


@query("""SELECT id, currency, request_id FROM request_names
WHERE regexp_full_match(currency, '[A-Z]{3}') AND regexp_full_match(request_id, '[A-Za-z0-9._:-]+')
  AND length(request_id) <= 128""", also=REQUEST_NAMES)
def filter_regex(v):
    return P.filter_regex(request_names(v), "currency", "request_id")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment ILIKE '%u%' AND c_mktsegment NOT ILIKE '%furn%'")
def filter_ilike(v):
    return P.filter_ilike(v.table("customer"), "c_mktsegment", "%u%", "%furn%").select("c_custkey", "c_mktsegment")


@query("SELECT id, email FROM operations WHERE lower(email) = lower('user-42@example.test')")
def filter_case_insensitive(v):
    return P.filter_case_insensitive(v.operations, "email", "USER-42@example.test").select("id", "email")


def documents(v):
    members = {c: F.col(c) for c in ("channel", "tags", "merchant")}
    return P.json_build(v.operations, "metadata", **members).select("id", "created_at", "metadata")


METADATA = """documents_of AS (
  SELECT id, created_at, to_json({'channel': channel, 'tags': tags, 'merchant': merchant}) AS metadata FROM operations)"""


@query("SELECT id, created_at, CAST(metadata AS VARCHAR) AS metadata FROM documents_of", also=METADATA)
def json_build(v):
    return documents(v)


@query("""SELECT id FROM documents_of
WHERE metadata->>'$.channel' = 'ios' AND list_contains(CAST(metadata->'$.tags' AS VARCHAR[]), 'review')""", also=METADATA)
def json_contains(v):
    return P.filter_json(documents(v), "metadata", {"channel": "ios", "tags": ["review"]}).select("id")


@query("SELECT event_id, props->>'$.k' AS k FROM events")
def json_extract(v):
    return P.json_extract(v.table("events"), "props", ["k"]).select("event_id", "k")


WORDS = r"list_contains(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{M}}\p{{N}}]+'), '{}')"


@query(f"SELECT doc_id FROM documents WHERE {WORDS.format('the')} AND {WORDS.format('license')}")
def text_search(v):
    return P.text_search(v.table("documents"), "text", ["the", "license"]).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE {WORDS.format('ñ')} AND {WORDS.format('los')}")
def text_search_spanish(v):
    return P.text_search(v.table("documents"), "text", ["Ñ", "los"]).select("doc_id")


def document_index(v):
    """Index of two thirds of the documents, and of the others as an appended batch with some of the first once more."""
    docs, part = v.table("documents"), F.pmod(F.xxhash64("doc_id"), F.lit(48))
    index = TextIndex.build(docs.filter(part > 15), "doc_id", "text", scratch_path(v.spark, "postings"))
    index.append(docs.filter(part < 17), "doc_id", "text")
    return index


@query(f"SELECT doc_id FROM documents WHERE {WORDS.format('the')} AND {WORDS.format('license')}")
def text_search_postings(v):
    return document_index(v).search(["the", "License"]).select(F.col("id").alias("doc_id"))


@query(r"""SELECT doc_id FROM documents
WHERE regexp_matches(lower(text), '(^|[^\p{L}\p{M}\p{N}])on[^\p{L}\p{M}\p{N}]+the($|[^\p{L}\p{M}\p{N}])')""")
def text_search_phrase(v):
    return document_index(v).phrase(["on", "the"]).select(F.col("id").alias("doc_id"))


@query(r"""SELECT word, count(*) AS documents FROM (
  SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def text_terms(v):
    """After a merge, the index is that of all documents."""
    index = document_index(v)
    index.merge()
    return index.terms()


@query("SELECT id AS payment, amount_minor AS amount FROM payments")
def projection(v):
    return P.projection(v.payments, payment="id", amount="amount_minor")


@query("""SELECT id, CASE WHEN id % 50 = 0 THEN 'PENDING' WHEN amount_minor > 20000000 THEN 'LARGE' ELSE 'COMPLETED' END
AS label FROM payments""")
def case_label(v):
    cases = [(F.col("id") % 50 == 0, "PENDING"), (F.col("amount_minor") > 20_000_000, "LARGE")]
    return P.case_label(v.payments, "label", cases, "COMPLETED").select("id", "label")


READS = """reads AS (
  SELECT o_orderkey AS request_id, o_custkey + CASE WHEN o_orderkey % 4 = 0 THEN 1000000000 ELSE 0 END AS account_id,
         CASE WHEN o_orderkey % 3 = 0 THEN o_custkey + 1 ELSE o_custkey END AS principal FROM orders)"""


@query("""SELECT r.request_id, r.account_id, r.principal,
  CASE WHEN a.id IS NULL THEN 'NOT_FOUND' WHEN a.owner_id = r.principal THEN 'VISIBLE' ELSE 'NOT_OWNER' END AS outcome,
  CASE WHEN a.owner_id = r.principal THEN a.balance_minor END AS balance_minor
FROM reads r LEFT JOIN accounts a ON a.id = r.account_id""", also=READS)
def owned_rows(v):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    reads = v.table("orders").select(
        key.alias("request_id"),
        (cust + F.when(key % 4 == 0, 1_000_000_000).otherwise(0)).alias("account_id"),
        F.when(key % 3 == 0, cust + 1).otherwise(cust).alias("principal"),
    )
    return P.owned_rows(reads, v.accounts)


# ---- joins


@query("""SELECT p.id, u.email, a.currency, p.amount_minor, p.status, p.created_at
FROM users u JOIN accounts_base a ON a.owner_id = u.id JOIN payments p ON p.account_id = a.id
ORDER BY p.created_at DESC, p.id DESC LIMIT 20""")
def join_inner_3way(v):
    joined = J.join_inner_3way(v.users, v.accounts_base, v.payments)
    return paging.top_k(joined, [F.desc("created_at"), F.desc("id")], 20)


@query("""SELECT a.id, a.balance_minor, coalesce(s.total, 0) AS ledger_balance
FROM accounts a LEFT JOIN ledger_sums s ON s.account_id = a.id""")
def join_left_aggregate(v):
    return J.with_ledger_balance(v.accounts, v.ledger_entries).select("id", "balance_minor", "ledger_balance")


@query("""SELECT a.id, a.balance_minor AS stored_balance, coalesce(s.total, 0) AS ledger_balance,
  coalesce(p.total, 0) AS payment_count
FROM accounts a LEFT JOIN ledger_sums s ON s.account_id = a.id
LEFT JOIN (SELECT account_id, count(*) AS total FROM payments GROUP BY account_id) p ON p.account_id = a.id""")
def account_snapshot(v):
    return J.account_snapshot(v.accounts, v.ledger_entries, v.payments)


@query("""SELECT a.id FROM accounts_base a LEFT JOIN (SELECT * FROM payments WHERE amount_minor > 45000000) p
ON p.account_id = a.id WHERE p.id IS NULL""")
def anti_join_left_null(v):
    return J.anti_join(v.accounts_base, v.payments.filter("amount_minor > 45000000"), "id", "account_id").select("id")


@query("""SELECT p.id, p.account_id FROM payments p WHERE p.status = 'COMPLETED'
AND NOT EXISTS (SELECT 1 FROM ledger_entries le WHERE le.payment_id = p.id AND le.id % 5 <> 0)""")
def anti_join_not_exists(v):
    """Against a ledger that has lost every fifth entry."""
    done = v.payments.filter("status = 'COMPLETED'")
    return J.anti_join(done, v.ledger_entries.filter("id % 5 <> 0"), "id", "payment_id").select("id", "account_id")


@query("""SELECT a.id, a.balance_minor FROM accounts a WHERE a.balance_minor <>
(SELECT coalesce(sum(amount_minor), 0) FROM ledger_entries le WHERE le.account_id = a.id)""")
def correlated_scalar(v):
    both = J.with_ledger_balance(v.accounts, v.ledger_entries)
    return both.filter("balance_minor <> ledger_balance").select("id", "balance_minor")


@query("""SELECT account_id, CAST(turnover AS BIGINT) AS turnover,
  round(turnover * 100.0::DOUBLE / (SELECT CAST(sum(turnover) AS DOUBLE) FROM t), 4) AS percent FROM t""",
       also="t AS (SELECT account_id, sum(amount_minor) AS turnover FROM payments WHERE status = 'COMPLETED' GROUP BY 1)")
def cross_join_scalar(v):
    done = v.payments.filter("status = 'COMPLETED'")
    return A.share_of_total(done, ["account_id"], F.sum("amount_minor"), "turnover", 4)


@query("""SELECT w.pid, w.state, w.b AS other_key, o.state AS other_state
FROM (SELECT pid, state, unnest(blocked_by) AS b FROM sessions) w JOIN sessions o ON o.pid = w.b""")
def lateral_unnest_join(v):
    return J.lateral_unnest_join(v.sessions, "pid", "blocked_by", ["state"])


@query("""SELECT a.id, p.id AS payment_id FROM accounts_base a
LEFT JOIN payments p ON p.account_id = a.id AND p.status = 'COMPLETED' AND p.amount_minor > 40000000""")
def left_join_condition(v):
    payments = v.payments.withColumnRenamed("id", "payment_id")
    condition = (F.col("status") == "COMPLETED") & (F.col("amount_minor") > 40_000_000)
    joined = J.left_join_condition(v.accounts_base, payments, "id", "account_id", condition, ["payment_id"])
    return joined.select("id", "payment_id")


JOIN_FETCH = """SELECT id, chunk, string_agg(CAST(pid AS VARCHAR), ',' ORDER BY n) AS payments, count(pid) AS size FROM (
  SELECT a.id, p.id AS pid, p.n, coalesce((p.n - 1) // {chunk}, 0) AS chunk FROM accounts_base a LEFT JOIN (
    SELECT id, {account} AS account_id, row_number() OVER (PARTITION BY {account} ORDER BY created_at, id) AS n
    FROM payments) p ON p.account_id = a.id) GROUP BY id, chunk"""


def fetch(v, payments, chunk, **options):
    fetched = J.join_fetch(v.accounts_base, payments, "account_id", ["created_at", "id"], ["id"], chunk, **options)
    ids = F.transform("children", lambda c: c["id"].cast("string"))
    listed = F.when(F.size("children") > 0, F.array_join(ids, ","))
    return fetched.select("id", "chunk", listed.alias("payments"), F.size("children").cast("bigint").alias("size"))


@query(JOIN_FETCH.format(chunk=1000, account="account_id"))
def join_fetch(v):
    return fetch(v, v.payments, 1000)


@query(JOIN_FETCH.format(chunk=100, account="CASE WHEN account_id % 3 = 0 THEN 0 ELSE account_id END"))
def join_fetch_hot(v):
    payments = v.payments.withColumn("account_id", hot_account())
    return fetch(v, payments, 100, rows_per_split=HOT_SPLIT)


@query("""SELECT a.id, row_number() OVER (PARTITION BY a.id ORDER BY p.created_at, p.id) AS position, p.id AS payment
FROM accounts_base a JOIN payments p ON p.account_id = a.id UNION ALL
SELECT id, NULL, NULL FROM accounts_base WHERE id NOT IN (SELECT account_id FROM payments)""")
def join_fetch_rows(v):
    fetched = J.join_fetch_rows(v.accounts_base, v.payments, "account_id", ["created_at", "id"], ["id"])
    return fetched.select("id", "position", F.col("child.id").alias("payment"))


LONG_PERIODS = """long_periods AS (
  SELECT id, currency % 5 AS currency, starts_at, CASE WHEN id % 1000 = 0 THEN starts_at + INTERVAL 4000 DAY ELSE ends_at END AS ends_at FROM rate_periods)"""


def long_periods(v):
    end = F.when(F.col("id") % 1000 == 0, F.col("starts_at") + F.expr("interval 4000 day")).otherwise(F.col("ends_at"))
    return v.rate_periods.withColumn("currency", F.col("currency") % 5).withColumn("ends_at", end)


COUNTED = """SELECT p.id, count(q.id) AS overlaps FROM {0} p LEFT JOIN {0} q
ON q.currency = p.currency AND q.id <> p.id AND q.starts_at < p.ends_at AND p.starts_at < q.ends_at GROUP BY p.id"""


@query(COUNTED.format("rate_periods"))
def overlap_counts(v):
    return J.overlap_counts(v.rate_periods, "currency", "starts_at", "ends_at")


@query(COUNTED.format("long_periods"), also=LONG_PERIODS)
def overlap_counts_hot(v):
    """Few keys with many periods each, some of them very long."""
    return J.overlap_counts(long_periods(v), "currency", "starts_at", "ends_at", HOT_SPLIT)


@query("""SELECT l.currency, l.id, r.id AS other_id FROM long_periods l JOIN long_periods r ON l.currency = r.currency AND l.id <> r.id
AND l.starts_at < r.ends_at AND r.starts_at < l.ends_at WHERE l.id % 97 = 0""", also=LONG_PERIODS)
def overlaps_of(v):
    """The partners of some periods only."""
    periods = long_periods(v)
    return J.overlaps_of(periods, periods.filter("id % 97 = 0").select("id"), "currency", "starts_at", "ends_at", 86400 * 4)


@query("""SELECT l.currency, l.id AS left_id, r.id AS right_id FROM long_periods l JOIN long_periods r
ON l.currency = r.currency AND l.id < r.id AND l.starts_at < r.ends_at AND r.starts_at < l.ends_at
WHERE l.id % 1000 = 0 AND r.id % 1000 = 0""", also=LONG_PERIODS)
def overlap_join_levels(v):
    """Long periods of a few keys against each other and against short ones; the long ones' pairs are shown."""
    long = long_periods(v).filter("id % 1000 = 0")
    return J.range_overlap_join(long, "currency", "starts_at", "ends_at", 86400 * 4)


@query("""SELECT l.currency, l.id AS left_id, r.id AS right_id FROM rate_periods l JOIN rate_periods r
ON l.currency = r.currency AND l.id < r.id AND l.starts_at < r.ends_at AND r.starts_at < l.ends_at""")
def range_overlap_join(v):
    return J.range_overlap_join(v.rate_periods, "currency", "starts_at", "ends_at", 86400 * 4)


# ---- aggregates


@query("SELECT status, count(*) AS total FROM payments GROUP BY status")
def group_count(v):
    return A.group_count(v.payments, "status")


@query("""SELECT status, count(*) AS total,
round(CAST(count(*) AS DOUBLE) * 100 / CAST(sum(count(*)) OVER () AS DOUBLE), 2) AS percent FROM payments GROUP BY status""")
def status_distribution(v):
    return A.share_of_total(v.payments, ["status"], F.count(F.lit(1)), "total", 2)


@query("""SELECT account_id, count(*) AS payments_total, count(*) FILTER (WHERE status = 'COMPLETED') AS completed,
  count(*) FILTER (WHERE status = 'PENDING') AS pending, count(*) FILTER (WHERE status = 'FAILED') AS failed,
  CAST(sum(amount_minor) FILTER (WHERE status = 'COMPLETED') AS BIGINT) AS completed_minor
FROM payments GROUP BY account_id""")
def filtered_aggregates(v):
    return A.filtered_aggregates(v.payments)


@query("""SELECT account_id, count(*) AS completed_count, CAST(sum(amount_minor) AS BIGINT) AS turnover_minor
FROM payments WHERE status = 'COMPLETED' GROUP BY account_id HAVING sum(amount_minor) > 100000000""")
def having_turnover(v):
    return A.having_turnover(v.payments, 100_000_000)


@query("""SELECT CAST(date_trunc('month', created_at) AS TIMESTAMP) AS month, count(*) AS payments,
CAST(sum(amount_minor) FILTER (WHERE status = 'COMPLETED') AS BIGINT) AS completed_minor FROM payments GROUP BY 1""")
def monthly_rollup(v):
    return A.monthly_rollup(v.payments)


@query("""SELECT account_id, CAST(created_at AS DATE) AS day, CAST(sum(amount_minor) AS BIGINT) AS total
FROM payments WHERE status = 'COMPLETED' GROUP BY 1, 2""")
def daily_totals(v):
    return A.daily_totals(v.payments)


@query("""SELECT count(*) AS total, CAST(sum(amount_minor) AS BIGINT) AS amount
FROM payments WHERE created_at >= TIMESTAMP '1997-01-01'""")
def global_aggregate(v):
    since = F.lit(dt.datetime(1997, 1, 1)).cast("timestamp_ntz")
    return A.global_aggregate(v.payments, F.col("created_at") >= since, "amount_minor")


@query("""SELECT status, count(*) AS total FROM (SELECT * FROM payments WHERE created_at >= TIMESTAMP '2000-01-01')
GROUP BY status""")
def recent_group_count(v):
    return A.group_count(v.payments.filter("created_at >= timestamp_ntz'2000-01-01 00:00:00'"), "status")


@query("""SELECT count(*) AS all_rows, count(payment_id) AS with_value, count(DISTINCT payment_id) AS different
FROM ledger_entries""")
def count_semantics(v):
    return A.count_semantics(v.ledger_entries, "payment_id")


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_groups(v):
    return A.duplicate_groups(v.table("lineitem"), [F.col("l_orderkey"), F.col("l_linenumber")])


TRANSFER_ENTRIES = """transfer_entries AS (
  SELECT o_orderkey AS transfer_id, o_custkey AS account_id, -CAST(round(o_totalprice * 100) AS BIGINT) AS amount_minor
  FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey + 1, CAST(round(o_totalprice * 100) AS BIGINT) - CASE WHEN o_orderkey % 100 = 0 THEN 1 ELSE 0 END
  FROM orders)"""


def transfer_entries(v):
    """Two entries per transfer; every hundredth pair is off by one unit."""
    payment = v.payments.withColumn("transfer_id", F.col("id"))
    debit = payment.select("transfer_id", "account_id", (-F.col("amount_minor")).alias("amount_minor"))
    off = F.when(F.col("id") % 100 == 0, 1).otherwise(0)
    credit = payment.select("transfer_id", (F.col("account_id") + 1).alias("account_id"), (F.col("amount_minor") - off).alias("amount_minor"))
    return ledger.union_entries(debit, credit)


@query("""SELECT transfer_id, count(*) AS entries, CAST(sum(amount_minor) AS BIGINT) AS imbalance
FROM transfer_entries GROUP BY transfer_id HAVING sum(amount_minor) <> 0""", also=TRANSFER_ENTRIES)
def entries_balance_zero(v):
    return A.unbalanced_groups(transfer_entries(v), "transfer_id")


HISTOGRAM = """histogram AS (
  SELECT event_type, CAST(CASE WHEN value <= 1 THEN 1 WHEN value <= 2 THEN 2 WHEN value <= 5 THEN 5 WHEN value <= 10 THEN 10
    WHEN value <= 20 THEN 20 WHEN value <= 50 THEN 50 WHEN value <= 100 THEN 100 WHEN value <= 200 THEN 200
    WHEN value <= 500 THEN 500 WHEN value <= 1000 THEN 1000 END AS BIGINT) AS le, count(*) AS requests
  FROM events GROUP BY ALL)"""


@query("SELECT event_type, le, requests FROM histogram", also=HISTOGRAM)
def latency_histogram(v):
    return A.latency_histogram(v.table("events"), "value", "event_type")


@query("""SELECT event_type, min(le) AS le FROM (
  SELECT event_type, le, sum(requests) OVER (PARTITION BY event_type ORDER BY le NULLS LAST) AS seen,
         sum(requests) OVER (PARTITION BY event_type) AS every FROM histogram)
WHERE seen >= every * 0.95 GROUP BY event_type""", also=HISTOGRAM)
def latency_histogram_p95(v):
    return A.histogram_quantile(A.latency_histogram(v.table("events"), "value", "event_type"), 0.95, "event_type")


@query("""SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type""")
def latency_percentiles(v):
    exact = A.latency_percentiles(v.table("events"), "value", "event_type", exact=True)
    return exact.select("event_type", *[F.round(p, 6).alias(p) for p in ("p50", "p95", "p99")])


@query(name="latency_percentiles_sketch")
def latency_percentiles_sketch(v):
    return A.latency_percentiles(v.table("events"), "value", "event_type")


@query("""SELECT event_type, count(*) AS rows, true AS p50_holds, true AS p95_holds, true AS p99_holds FROM events
WHERE CAST(ts AS DATE) > (SELECT min(CAST(ts AS DATE)) FROM events) GROUP BY event_type""")
def latency_percentiles_merged(v):
    """Percentiles of all days but the first from stored daily sketches, and whether their places are right in the rows."""
    events, wanted = v.table("events"), A.PERCENTILES
    stored = materialize(K.daily_sketches(events, "value", "ts", "event_type"), "sketches")
    first = stored.agg(F.min("day")).scalar()
    found = K.merged_percentiles(stored, wanted, "event_type", condition=F.col("day") > first)
    errors = K.rank_errors(events.filter(F.to_date("ts") > first), "value", found, wanted, "event_type")
    holds = [(F.col(f"_{p}") < K.RANK_ERROR).alias(f"{p}_holds") for p in wanted]
    errors = errors.select(F.col("event_type").alias("_type"), *[F.col(p).alias(f"_{p}") for p in wanted])
    return found.join(errors, F.col("event_type") == F.col("_type")).select("event_type", "rows", *holds)


@query("""SELECT event_type, round(CAST(sum(event_id % 7) AS DOUBLE) * 100 / nullif(CAST(sum(event_id % 11) AS DOUBLE), 0), 2)
AS percent FROM events GROUP BY event_type""")
def pipelined_ratio(v):
    return A.pipelined_ratio(v.table("events"), F.col("event_id") % 7, F.col("event_id") % 11, 2, "event_type")


# ---- windows

RUNNING = """SELECT id, account_id, created_at, amount_minor,
CAST(sum(amount_minor) OVER (PARTITION BY account_id ORDER BY created_at, id) AS BIGINT) AS running_total FROM {}"""


@query(RUNNING.format("ledger_entries"))
def running_total(v):
    return W.running_total(v.ledger_entries).select("id", "account_id", "created_at", "amount_minor", "running_total")


@query(RUNNING.format("hot_ledger"), also=HOT_LEDGER)
def running_total_hot(v):
    return W.running_total(hot_ledger(v), HOT_SPLIT)


@query("""SELECT account_id, id, amount_minor, status, created_at FROM (SELECT *, row_number() OVER (
PARTITION BY account_id ORDER BY created_at DESC, id DESC) AS rn FROM payments) WHERE rn = 1""")
def latest_per_group(v):
    return W.latest_per_group(v.payments, "account_id", ["created_at", "id"])


GAP = """SELECT id, account_id, created_at, date_diff('second',
lag(created_at) OVER (PARTITION BY account_id ORDER BY created_at, id), created_at) AS gap_seconds FROM {}"""


@query(GAP.format("payments"))
def gap_to_previous(v):
    return W.gap_to_previous(v.payments).select("id", "account_id", "created_at", "gap_seconds")


@query(GAP.format("hot_ledger"), also=HOT_LEDGER)
def gap_to_previous_hot(v):
    return W.gap_to_previous(hot_ledger(v), HOT_SPLIT).select("id", "account_id", "created_at", "gap_seconds")


@query("""SELECT account_id, count(*) AS total,
round(CAST(count(*) AS DOUBLE) * 100 / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS percent FROM payments GROUP BY 1""")
def share_of_total(v):
    return A.share_of_total(v.payments, ["account_id"], F.count(F.lit(1)), "total", 6)


@query("""SELECT id, account_id, status, coalesce(status <> lag(status) OVER (PARTITION BY account_id
ORDER BY created_at, id), false) AS changed FROM payments""")
def changed_since_previous(v):
    changed = W.changed_since_previous(v.payments, ["account_id"], ["created_at", "id"], "status")
    return changed.select("id", "account_id", "status", "changed")


ROW_NUMBERS = """SELECT id, account_id, CAST(sum(amount_minor) OVER (PARTITION BY account_id ORDER BY created_at, id) AS BIGINT)
AS running_total, row_number() OVER (PARTITION BY account_id ORDER BY created_at DESC, id DESC) AS rn FROM {}"""


@query(ROW_NUMBERS.format("ledger_entries"))
def row_numbers_desc(v):
    return W.row_numbers_desc(v.ledger_entries).select("id", "account_id", "running_total", "rn")


@query(ROW_NUMBERS.format("hot_ledger"), also=HOT_LEDGER)
def row_numbers_desc_hot(v):
    return W.row_numbers_desc(hot_ledger(v), HOT_SPLIT).select("id", "account_id", "running_total", "rn")


# ---- sort, top-k, pages


@query("""SELECT account_id, CAST(sum(amount_minor) AS BIGINT) AS turnover_minor FROM payments WHERE status = 'COMPLETED'
GROUP BY 1 ORDER BY turnover_minor DESC, account_id LIMIT 20""")
def top_k(v):
    turnover = v.payments.filter("status = 'COMPLETED'").groupBy("account_id").agg(F.sum("amount_minor").alias("turnover_minor"))
    return paging.top_k(turnover, [F.desc("turnover_minor"), F.col("account_id")], 20)


@query("""SELECT account_id, CAST(sum(amount_minor) FILTER (WHERE status = 'COMPLETED' AND amount_minor > 30000000) AS BIGINT)
AS large_minor FROM payments GROUP BY 1 ORDER BY large_minor DESC NULLS LAST, account_id LIMIT 500""")
def order_nulls_last(v):
    large = F.when((F.col("status") == "COMPLETED") & (F.col("amount_minor") > 30_000_000), F.col("amount_minor"))
    groups = v.payments.groupBy("account_id").agg(F.sum(large).alias("large_minor"))
    return paging.top_k(groups, [F.desc_nulls_last("large_minor"), F.col("account_id")], 500)


@query("""SELECT account_id, CAST(sum(amount_minor) - 900000000 AS BIGINT) AS drift FROM ledger_entries GROUP BY 1
ORDER BY abs(drift) DESC, account_id LIMIT 20""")
def order_by_expression(v):
    drift = v.ledger_entries.groupBy("account_id").agg((F.sum("amount_minor") - 900_000_000).alias("drift"))
    return paging.top_k(drift, [F.abs("drift").desc(), F.col("account_id")], 20)


@query("""SELECT id, payment_id, amount_minor FROM ledger_entries WHERE account_id = 7 AND id < 1000010000
ORDER BY id DESC LIMIT 5""")
def keyset_page_id(v):
    return paging.keyset_page_id(v.ledger_entries, 7, 1_000_010_000, 5).select("id", "payment_id", "amount_minor")


@query("""SELECT id, created_at, amount_minor FROM ledger_entries WHERE account_id = 7
AND (created_at, id) < (TIMESTAMP '1999-01-01', 1000005000) ORDER BY created_at DESC, id DESC LIMIT 5""")
def keyset_page_tuple(v):
    after = (dt.datetime(1999, 1, 1), 1_000_005_000)
    return paging.keyset_page_tuple(v.ledger_entries, 7, after, 5).select("id", "created_at", "amount_minor")


@query("SELECT id, created_at FROM payments ORDER BY created_at, id LIMIT 50 OFFSET 200")
def offset_page(v):
    return paging.offset_page(v.payments, [F.col("created_at"), F.col("id")], 200, 50).select("id", "created_at")


PAGES = """SELECT id, account_id, (row_number() OVER w - 1) // {limit} AS page, (row_number() OVER w - 1) % {limit} AS position
FROM {table} WINDOW w AS (PARTITION BY account_id ORDER BY id DESC)"""


@query(PAGES.format(limit=5, table="ledger_entries"))
def all_pages(v):
    return paging.all_pages(v.ledger_entries, 5).select("id", "account_id", "page", "position")


@query(PAGES.format(limit=100, table="hot_ledger"), also=HOT_LEDGER)
def all_pages_hot(v):
    return paging.all_pages(hot_ledger(v), 100, HOT_SPLIT).select("id", "account_id", "page", "position")


# ---- set operations


@query("SELECT id, account_id, payment_id, amount_minor, created_at FROM ledger_entries")
def union_entries(v):
    opening = v.ledger_entries.filter("payment_id IS NULL")
    posted = v.ledger_entries.filter("payment_id IS NOT NULL")
    return ledger.union_entries(opening, posted)


@query("""SELECT id, amount_minor, CAST(sum(n) AS BIGINT) AS surplus FROM (
  SELECT id, amount_minor, 1 AS n FROM payments
  UNION ALL SELECT id, amount_minor + CASE WHEN id % 40 = 0 THEN 1 ELSE 0 END, -1 FROM payments WHERE id % 25 <> 3)
GROUP BY 1, 2 HAVING sum(n) <> 0""")
def table_diff(v):
    """Against a copy with lost and changed rows."""
    left = v.payments.select("id", "amount_minor")
    changed = (F.col("amount_minor") + F.when(F.col("id") % 40 == 0, 1).otherwise(0)).alias("amount_minor")
    return setops.table_diff(left, left.filter("id % 25 <> 3").select("id", changed))


# ---- scalar functions


@query("""SELECT c_custkey, lower(c_name) AS low, left(c_name, 8) AS head, lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS padded,
  repeat('x', 4) AS xs, trim(concat('  ', c_mktsegment, ' ')) AS trimmed, regexp_replace(c_name, '#0+', '/') AS short
FROM customer""")
def scalar_strings(v):
    return v.table("customer").select(
        "c_custkey",
        F.lower("c_name").alias("low"),
        F.left("c_name", F.lit(8)).alias("head"),
        F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("padded"),
        F.repeat(F.lit("x"), 4).alias("xs"),
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("trimmed"),
        F.regexp_replace("c_name", "#0+", "/").alias("short"),
    )


@query("""SELECT id, md5(concat(CAST(account_id AS VARCHAR), ':', CAST(amount_minor AS VARCHAR))) AS request_hash,
  regexp_replace(md5(concat('payment|', CAST(id AS VARCHAR))), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS uuid
FROM payments""")
def scalar_hash(v):
    return v.payments.select(
        "id", S.request_hash("account_id", "amount_minor").alias("request_hash"), S.stable_id(F.lit("payment"), "id").alias("uuid")
    )


@query("""SELECT event_id, CAST(ts AS DATE) AS day, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month,
  ts - INTERVAL 90 DAY AS since, ts + to_seconds(event_id % 1000) AS later,
  date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', ts)) AS age_seconds FROM events""")
def scalar_dates(v):
    ts, start = F.col("ts"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return v.table("events").select(
        "event_id",
        F.to_date(ts).alias("day"),
        F.date_trunc("month", ts).cast("timestamp_ntz").alias("month"),
        (ts - F.expr("interval 90 days")).alias("since"),
        (ts + F.make_dt_interval(secs=F.col("event_id") % 1000)).alias("later"),
        F.timestamp_diff("SECOND", start, ts).alias("age_seconds"),
    )


@query("""SELECT event_id, round(value, 1) AS rounded, abs(value - 50) AS distance, CAST(floor(value) AS BIGINT) AS whole,
  event_id % 7 AS remainder, coalesce(nullif(event_id % 3, 0), -1) AS filled,
  CAST(round(value) AS BIGINT) AS to_int FROM events""")
def scalar_math(v):
    value, e = F.col("value"), F.col("event_id")
    return v.table("events").select(
        "event_id",
        F.round(value, 1).alias("rounded"),
        F.abs(value - 50).alias("distance"),
        F.floor(value).alias("whole"),
        (e % 7).alias("remainder"),
        F.coalesce(F.nullif(e % 3, F.lit(0).cast("bigint")), F.lit(-1)).alias("filled"),
        F.round(value).cast("bigint").alias("to_int"),
    )


@query("""SELECT event_id, (['PENDING', 'COMPLETED', 'FAILED'])[1 + event_id % 3] AS status, len(tags) AS size, tag
FROM (SELECT e.event_id, o.tags, unnest(CASE WHEN len(o.tags) = 0 THEN ['none'] ELSE o.tags END) AS tag
      FROM events e JOIN operations o ON o.id = e.event_id)""")
def scalar_arrays(v):
    statuses = F.array(*[F.lit(s) for s in ("PENDING", "COMPLETED", "FAILED")])
    filled = F.when(F.size("tags") == 0, F.array(F.lit("none"))).otherwise(F.col("tags"))
    return v.operations.select(
        F.col("id").alias("event_id"),
        F.element_at(statuses, (1 + F.col("id") % 3).cast("int")).alias("status"),
        F.size("tags").cast("bigint").alias("size"),
        F.explode(filled).alias("tag"),
    )


@query("""SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, (CAST(props->>'$.k' AS BIGINT) = 42) AS is_42,
  to_json({'type': event_type, 'ids': [event_id, user_id]}) AS doc FROM events""")
def scalar_json(v):
    events = P.json_build(
        v.table("events"), "doc", type=F.col("event_type"), ids=F.array("event_id", "user_id")
    )
    return events.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        S.json_contains("props", {"k": 42}).alias("is_42"),
        "doc",
    )
