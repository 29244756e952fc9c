"""Registered queries: ordered commands, transfers, queues and anomalies."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerspark.operators import accesslog, commands, debits, transfers
from ledgerspark.operators.scans import global_rank, ordered_scan
from ledgerspark.plans.fixtures import OPENING_MINOR, SMALL_OPENING_MINOR, TRANSFER_ORDER
from ledgerspark.plans.registry import query
from ledgerspark.plans.relational import hot_account
from ledgerspark.session import materialize
from ledgerspark.sources.schemas import TRANSFERS

REPEAT = 1_000_000_000
HOT_SPLIT = 2000


def balances(v, opening: int):
    return v.accounts_base.select("id", F.lit(opening).cast("bigint").alias("balance_minor"))


# ---- guarded debits: one debit per payment of an account


def asked(v):
    return v.payments.select(F.col("id").alias("seq"), "account_id", "amount_minor")


@query(f"""SELECT id AS seq, account_id, amount_minor, CASE WHEN max(total) OVER (PARTITION BY account_id) <= {OPENING_MINOR} THEN 'APPLIED'
  ELSE 'ordered' END AS outcome FROM (SELECT *, sum(amount_minor) OVER (PARTITION BY account_id ORDER BY id) AS total FROM payments)""")
def guarded_debits_covered(v):
    return debits.guarded_debits(balances(v, OPENING_MINOR), asked(v))


# One serial walk per account, as a recursive query: the n-th debit of every account per step.
WALK = """WITH RECURSIVE numbered AS MATERIALIZED (
  SELECT o_orderkey AS seq, {account} AS account_id, CAST(round(o_totalprice * 100) AS BIGINT) AS amount_minor,
         row_number() OVER (PARTITION BY {account} ORDER BY o_orderkey) AS n FROM orders),
walk AS (
  SELECT seq, account_id, amount_minor, n, amount_minor <= 50000000 AS applied,
         50000000 - CASE WHEN amount_minor <= 50000000 THEN amount_minor ELSE 0 END AS rest FROM numbered WHERE n = 1
  UNION ALL
  SELECT d.seq, d.account_id, d.amount_minor, d.n, d.amount_minor <= w.rest,
         w.rest - CASE WHEN d.amount_minor <= w.rest THEN d.amount_minor ELSE 0 END
  FROM walk w JOIN numbered d ON d.account_id = w.account_id AND d.n = w.n + 1)
SELECT seq, account_id, amount_minor, CASE WHEN applied THEN 'APPLIED' ELSE 'REJECTED' END AS outcome FROM walk"""


@query(raw=WALK.format(account="o_custkey"))
def guarded_debits(v):
    return debits.guarded_debits(balances(v, SMALL_OPENING_MINOR), asked(v))


@query(raw=WALK.format(account="CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END"))
def guarded_debits_hot(v):
    """A third of all debits on one account, decided in phases."""
    hot = v.payments.select(F.col("id").alias("seq"), hot_account(), "amount_minor")
    return debits.guarded_debits(balances(v, SMALL_OPENING_MINOR), hot, HOT_SPLIT)


# ---- transfers

REQUESTS_SQL = """requests AS (
  SELECT seq, idempotency_key, from_account, to_account, amount_minor, actor FROM transfer_requests
  UNION ALL
  SELECT seq + 1000000000, idempotency_key, from_account, to_account, amount_minor, actor FROM transfer_requests WHERE seq % 5 = 0)"""


def requests(v):
    """All transfer requests, and every fifth a second time."""
    once = v.transfer_requests  # ranked rows are a written table
    again = once.filter("seq % 5 = 0").withColumn("seq", F.col("seq") + REPEAT)
    return once.unionByName(again)


def wallets(v, opening: int):
    """One currency, but for every fiftieth account."""
    currency = F.when(F.col("id") % 50 == 0, "USD").otherwise("RUB")
    return balances(v, opening).withColumn("currency", currency)


def nothing_stored(v):
    return v.spark.createDataFrame([], TRANSFERS)


@query("""SELECT seq, idempotency_key, from_account, to_account, amount_minor, actor,
  CASE WHEN seq = first_seq THEN 'FIRST' WHEN from_account = p.f AND to_account = p.t AND amount_minor = p.a THEN 'REPLAY'
       ELSE 'CONFLICT' END AS kind
FROM (SELECT *, first_value({'f': from_account, 't': to_account, 'a': amount_minor}) OVER w AS p, min(seq) OVER w AS first_seq
      FROM requests WINDOW w AS (PARTITION BY idempotency_key ORDER BY seq))""", also=REQUESTS_SQL)
def classify_requests(v):
    return commands.classify_requests(requests(v), ["from_account", "to_account", "amount_minor"])


# Without a rejection for lack of money the first request of a key that passes the account checks wins.
COVERED = REQUESTS_SQL + """,
judged AS (
  SELECT *, from_account <> to_account AND amount_minor > 0 AS valid,
         (from_account % 50 = 0) = (to_account % 50 = 0) AND to_account IN (SELECT id FROM accounts_base)
           AND from_account IN (SELECT id FROM accounts_base) AS same_currency FROM requests),
winners AS (
  SELECT idempotency_key AS k, min(seq) AS first_seq, arg_min({'f': from_account, 't': to_account, 'a': amount_minor}, seq) AS p
  FROM judged WHERE valid AND same_currency GROUP BY 1),
labelled AS (
  SELECT j.seq, j.idempotency_key, j.from_account, j.to_account, j.amount_minor, w.first_seq,
    CASE WHEN NOT valid THEN 'bad arguments' WHEN seq = w.first_seq THEN 'accepted'
         WHEN w.first_seq < seq AND w.p = {'f': from_account, 't': to_account, 'a': amount_minor} THEN 'repeated'
         WHEN w.first_seq < seq THEN 'key reused' ELSE 'accounts' END AS label
  FROM judged j LEFT JOIN winners w ON w.k = j.idempotency_key)"""
OUTCOME = """CASE label WHEN 'accepted' THEN 'COMPLETED' WHEN 'repeated' THEN 'REPLAY' WHEN 'bad arguments' THEN 'INVALID_REQUEST'
  WHEN 'key reused' THEN 'INVALID_REQUEST' ELSE 'OPERATION_REJECTED' END"""
TRANSFER_ID = """CASE WHEN label IN ('accepted', 'repeated') THEN regexp_replace(md5(concat('transfer|', idempotency_key, '|',
  CAST(first_seq AS VARCHAR))), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') END"""
AMPLE = 100 * OPENING_MINOR


@query(f"""SELECT seq, idempotency_key, from_account, to_account, amount_minor, {OUTCOME} AS outcome,
  CASE WHEN label NOT IN ('accepted', 'repeated') THEN label END AS reason, {TRANSFER_ID} AS transfer_id FROM labelled""",
       also=COVERED)
def apply_transfers_covered(v):
    return transfers.apply_transfers(wallets(v, AMPLE), nothing_stored(v), requests(v)).drop("actor")


@query(f"""SELECT a.id, {AMPLE} + CAST(coalesce(sum(m.amount), 0) AS BIGINT) AS balance_minor FROM accounts_base a LEFT JOIN (
  SELECT from_account AS account, -amount_minor AS amount FROM labelled WHERE label = 'accepted'
  UNION ALL SELECT to_account, amount_minor FROM labelled WHERE label = 'accepted') m ON m.account = a.id GROUP BY a.id""",
       also=COVERED)
def apply_transfers_balances(v):
    accounts = wallets(v, AMPLE)
    decided = transfers.apply_transfers(accounts, nothing_stored(v), requests(v))
    entries = transfers.entries_of(transfers.completed(decided))
    return transfers.balances_after(accounts.select("id", "balance_minor"), entries)


# The right decisions are the only ones that follow from themselves: a request is accepted if no accepted one of its key comes
# before it and the accepted ones before it leave enough money. Every round works all of them out from the round before, until
# one changes nothing.
SETTLED = REQUESTS_SQL + """,
judged AS (
  SELECT *, from_account <> to_account AND amount_minor > 0 AS valid,
         (from_account % 50 = 0) = (to_account % 50 = 0) AND to_account IN (SELECT id FROM accounts_base)
           AND from_account IN (SELECT id FROM accounts_base) AS same_currency FROM requests),
candidates AS MATERIALIZED (
  SELECT seq, idempotency_key AS k, from_account AS f, to_account AS t, amount_minor AS a FROM judged WHERE valid AND same_currency),
settled AS (
  SELECT seq AS first_seq, k, f, t, a FROM (
    WITH RECURSIVE rounds AS (
      SELECT 0 AS n, seq, k, f, t, a, seq = min(seq) OVER (PARTITION BY k) AS accepted FROM candidates
      UNION ALL
      SELECT n + 1, seq, k, f, t, a, now FROM (
        SELECT *, bool_or(now <> accepted) OVER () AS moving FROM (
          SELECT *, coalesce(earliest, seq) >= seq AND OPENING + coalesce(moved, 0) >= a AS now FROM (
            SELECT *, min(CASE WHEN accepted THEN seq END) OVER (PARTITION BY k) AS earliest,
                   sum(CASE WHEN accepted THEN delta ELSE 0 END) OVER (
                     PARTITION BY account ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS moved
            FROM (SELECT *, f AS account, -a AS delta, true AS own FROM rounds UNION ALL SELECT *, t, a, false FROM rounds))
          WHERE own))
      WHERE moving)
    SELECT * FROM rounds WHERE n = (SELECT max(n) FROM rounds)) WHERE accepted),
labelled AS (
  SELECT j.seq, j.idempotency_key, j.from_account, j.to_account, j.amount_minor, w.first_seq,
    CASE WHEN NOT valid THEN 'bad arguments' WHEN seq = w.first_seq THEN 'accepted'
         WHEN w.first_seq < seq AND w.f = from_account AND w.t = to_account AND w.a = amount_minor THEN 'repeated'
         WHEN w.first_seq < seq THEN 'key reused' WHEN NOT same_currency THEN 'accounts' ELSE 'funds' END AS label
  FROM judged j LEFT JOIN settled w ON w.k = j.idempotency_key)""".replace("OPENING", str(SMALL_OPENING_MINOR))


@query(f"""SELECT seq, idempotency_key, from_account, to_account, amount_minor, {OUTCOME} AS outcome,
  CASE WHEN label NOT IN ('accepted', 'repeated') THEN label END AS reason, {TRANSFER_ID} AS transfer_id FROM labelled""",
       also=SETTLED)
def apply_transfers(v):
    """Small openings, so that many requests lack the money."""
    return transfers.apply_transfers(wallets(v, SMALL_OPENING_MINOR), nothing_stored(v), requests(v)).drop("actor")


# ---- versions and operations


VERSIONS = """WITH RECURSIVE ranked AS (
  SELECT l_orderkey AS row_id, CAST(l_linenumber - 1 AS BIGINT) AS expected_version, row_number() OVER (ORDER BY l_shipdate, l_orderkey,
    l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) AS seq FROM lineitem),
numbered AS MATERIALIZED (
  SELECT r.*, row_number() OVER (PARTITION BY row_id ORDER BY seq) AS n,
         CASE WHEN o.o_orderstatus IN ('F', 'P') THEN CAST(0 AS BIGINT) END AS opening
  FROM ranked r LEFT JOIN orders o ON o.o_orderkey = r.row_id),
walk AS (
  SELECT *, opening AS before, CASE WHEN expected_version = opening THEN opening + 1 ELSE opening END AS version FROM numbered WHERE n = 1
  UNION ALL
  SELECT d.*, w.version, CASE WHEN d.expected_version = w.version THEN w.version + 1 ELSE w.version END
  FROM walk w JOIN numbered d ON d.row_id = w.row_id AND d.n = w.n + 1)
SELECT seq, row_id, expected_version, CASE WHEN before IS NULL THEN 'NOT_FOUND' WHEN expected_version = before THEN 'APPLIED'
  ELSE 'STALE' END AS outcome, version FROM walk"""


@query(raw=VERSIONS)
def optimistic_updates(v):
    """One command per line item on the version of its order."""
    ranked = global_rank(v.table("lineitem").select(*TRANSFER_ORDER), TRANSFER_ORDER, "seq")
    lines = ranked.select("seq", F.col("l_orderkey").alias("row_id"), (F.col("l_linenumber") - 1).cast("bigint").alias("expected_version"))
    rows = v.payments.filter("status <> 'FAILED'").select("id", F.lit(0).cast("bigint").alias("version"))
    return commands.optimistic_updates(rows, materialize(lines, "commands"))


ATTEMPTS = """attempts AS (
  SELECT event_id AS seq, concat('op-', CAST(event_id % 3000 AS VARCHAR)) AS idempotency_key,
         CAST(CASE WHEN event_id % 13 = 0 THEN 200 ELSE 100 END AS BIGINT) AS amount_minor,
         CASE event_type WHEN 'purchase' THEN 'OK' WHEN 'error' THEN 'ERROR' ELSE 'TIMEOUT' END AS gateway FROM events)"""
OPERATION = """first_try AS (SELECT idempotency_key AS k, arg_min(amount_minor, seq) AS amount FROM attempts GROUP BY 1),
done AS (SELECT a.idempotency_key AS k, min(a.seq) AS at FROM attempts a JOIN first_try f ON f.k = a.idempotency_key
  AND f.amount = a.amount_minor WHERE a.gateway = 'OK' GROUP BY 1)"""


def attempts(v):
    event = F.col("event_id")
    kind = F.col("event_type")
    return v.table("events").select(
        event.alias("seq"),
        F.concat(F.lit("op-"), event % 3000).alias("idempotency_key"),
        F.when(event % 13 == 0, 200).otherwise(100).cast("bigint").alias("amount_minor"),
        F.when(kind == "purchase", "OK").when(kind == "error", "ERROR").otherwise("TIMEOUT").alias("gateway"),
    )


@query("""SELECT a.seq, a.idempotency_key, a.amount_minor, a.gateway,
  CASE WHEN a.amount_minor <> f.amount THEN 'REJECTED' WHEN d.at < a.seq THEN 'REPLAY' WHEN a.gateway = 'OK' THEN 'CHARGED'
       WHEN a.gateway = 'ERROR' THEN 'GATEWAY_ERROR' ELSE 'UNKNOWN' END AS outcome,
  CASE WHEN a.amount_minor <> f.amount THEN NULL WHEN d.at < a.seq OR a.gateway = 'OK' THEN 'COMPLETED'
       WHEN a.gateway = 'ERROR' THEN 'FAILED' ELSE 'RESERVED' END AS status
FROM attempts a JOIN first_try f ON f.k = a.idempotency_key LEFT JOIN done d ON d.k = a.idempotency_key""",
       also=ATTEMPTS + ", " + OPERATION)
def operation_state(v):
    return commands.operation_state(attempts(v))


JOBS = "jobs AS (SELECT id, CASE WHEN status = 'PENDING' THEN 'READY' ELSE 'DONE' END AS status FROM payments)"
CLAIM = """SELECT id, status, CASE WHEN (row_number() OVER (ORDER BY id) - 1) // 50 < 60
  THEN (row_number() OVER (ORDER BY id) - 1) // 50 END AS worker FROM jobs WHERE status = 'READY'"""


def jobs(v):
    return v.payments.select("id", F.when(F.col("status") == "PENDING", "READY").otherwise("DONE").alias("status"))


@query(CLAIM, also=JOBS)
def claim_jobs(v):
    return commands.claim_jobs(jobs(v), 60, 50)


@query(CLAIM, also=JOBS)
def claim_jobs_split(v):
    return commands.claim_jobs(jobs(v).repartitionByRange(3, "id"), 60, 50)


@query("""SELECT id, account_id, created_at, date_diff('second', created_at, TIMESTAMP '2001-08-02') AS age_seconds FROM payments
WHERE status = 'PENDING' AND created_at < TIMESTAMP '2001-08-02' - INTERVAL 60 DAY""")
def stale_operations(v):
    stale = commands.stale_operations(v.payments, dt.datetime(2001, 8, 2), dt.timedelta(days=60))
    return stale.select("id", "account_id", "created_at", "age_seconds")


@query("""SELECT count(*) AS pending, max(date_diff('second', created_at, TIMESTAMP '2001-08-02')) AS max_age_seconds FROM payments
WHERE status = 'PENDING' AND created_at < TIMESTAMP '2001-08-02' - INTERVAL 120 SECOND""")
def stale_operations_summary(v):
    return commands.stale_summary(commands.stale_operations(v.payments, dt.datetime(2001, 8, 2), dt.timedelta(minutes=2)))


TOKENS = """tokens AS (
  SELECT concat('t-', CAST(c_custkey AS VARCHAR)) AS token, c_custkey AS user_id,
         TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 40 AS INTEGER)) AS expires_at FROM customer),
uses AS (SELECT event_id AS use_id, concat('t-', CAST(user_id * 11 AS VARCHAR)) AS token, ts AS used_at FROM events)"""


def tokens_and_uses(v):
    key = F.col("c_custkey")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    tokens = v.table("customer").select(
        F.concat(F.lit("t-"), key).alias("token"), key.alias("user_id"),
        (start + F.make_dt_interval(days=(key % 40).cast("int"))).alias("expires_at"),
    )
    uses = v.table("events").select(
        F.col("event_id").alias("use_id"), F.concat(F.lit("t-"), F.col("user_id") * 11).alias("token"), F.col("ts").alias("used_at")
    )
    return tokens, uses


@query("""SELECT u.use_id, u.token, u.used_at, CASE WHEN t.token IS NULL THEN 'UNKNOWN'
  WHEN row_number() OVER (PARTITION BY u.token ORDER BY u.used_at, u.use_id) > 1 THEN 'REVOKED'
  WHEN t.expires_at > u.used_at THEN 'ROTATED' ELSE 'EXPIRED' END AS outcome
FROM uses u LEFT JOIN tokens t ON t.token = u.token""", also=TOKENS)
def one_use_tokens(v):
    return commands.one_use_tokens(*tokens_and_uses(v))


@query("""SELECT u.use_id, u.token, u.used_at, CASE WHEN t.expires_at > u.used_at THEN t.user_id END AS user_id
FROM uses u LEFT JOIN tokens t ON t.token = u.token""", also=TOKENS)
def access_checks(v):
    return commands.access_checks(*tokens_and_uses(v))


ERRORS = """errors AS (SELECT event_id, (['40001', '40P01', '55P03', '23505', '23514', '57014', '08006'])[1 + user_id % 7] AS sqlstate
  FROM events WHERE event_type = 'error')"""


@query("""SELECT e.sqlstate, count(*) AS errors, coalesce(c.class, 'other') AS class, coalesce(c.retry, 'no') AS retry FROM errors e
LEFT JOIN (VALUES ('40001', 'serialization failure', 'yes'), ('40P01', 'deadlock detected', 'yes'), ('55P03', 'lock timeout', 'with care'),
  ('23505', 'unique violation', 'no'), ('23514', 'check violation', 'no'), ('57014', 'statement cancelled', 'no')) c(code, class, retry)
ON c.code = e.sqlstate GROUP BY ALL""", also=ERRORS)
def retryable_errors(v):
    codes = F.array(*[F.lit(c) for c in ("40001", "40P01", "55P03", "23505", "23514", "57014", "08006")])
    errors = v.table("events").filter("event_type = 'error'").select(
        F.element_at(codes, (1 + F.col("user_id") % 7).cast("int")).alias("sqlstate")
    )
    return commands.retryable_errors(errors, "sqlstate")


# ---- anomalies

ROW_WRITES = """row_writes AS (
  SELECT id AS tx, account_id AS row_id, created_at AS committed_at, id AS written_version,
         CASE WHEN id % 10 = 0 THEN id - 1 ELSE before END AS read_version
  FROM (SELECT *, lag(id) OVER (PARTITION BY account_id ORDER BY created_at, id) AS before FROM payments))"""


def row_writes(v):
    scanned = ordered_scan(v.payments, ["account_id"], ["created_at", "id"], previous={"before": "id"})
    return scanned.select(
        F.col("id").alias("tx"), F.col("account_id").alias("row_id"), F.col("created_at").alias("committed_at"),
        F.col("id").alias("written_version"),
        F.when(F.col("id") % 10 == 0, F.col("id") - 1).otherwise(F.col("before")).alias("read_version"),
    )


@query("""SELECT tx, row_id, read_version, current_version FROM (SELECT *, lag(written_version) OVER (PARTITION BY row_id
ORDER BY committed_at, tx) AS current_version FROM row_writes) WHERE current_version <> read_version""", also=ROW_WRITES)
def lost_update_scan(v):
    return accesslog.lost_update_scan(row_writes(v)).select("tx", "row_id", "read_version", "current_version")


TX_LOG = """tx_log AS (
  SELECT event_id AS tx, ts AS started_at, ts + to_seconds(3600 + event_id % 36000) AS committed_at,
         user_id // 2 * 2 AS a, user_id // 2 * 2 + 1 AS b, CASE WHEN event_id % 2 = 0 THEN user_id // 2 * 2 ELSE user_id // 2 * 2 + 1 END AS w
  FROM events)"""


@query("""SELECT x.tx AS first_tx, y.tx AS second_tx FROM tx_log x JOIN tx_log y ON x.tx < y.tx AND x.a = y.a AND x.w <> y.w
  AND x.started_at < y.committed_at AND y.started_at < x.committed_at""", also=TX_LOG)
def write_skew_pairs(v):
    """Each transaction reads the two rows of a pair of users and writes one of them."""
    event, user = F.col("event_id"), F.col("user_id")
    a = user - user % 2
    log = v.table("events").select(
        event.alias("tx"), F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(secs=3600 + event % 36000)).alias("committed_at"),
        F.array(a, a + 1).alias("reads"), F.array(a + event % 2).alias("writes"),
    )
    return accesslog.write_skew_pairs(log)


RING_LOG = """ring_log AS (
  SELECT event_id AS tx, ts AS started_at, ts + to_seconds(3600 + event_id % 36000) AS committed_at,
         user_id // 3 * 3 + event_id % 3 AS w, user_id // 3 * 3 + (event_id + 1) % 3 AS r
  FROM events),
access AS (
  SELECT tx, started_at, committed_at, 0 AS kind, w AS row_key, committed_at AS moment FROM ring_log
  UNION ALL SELECT tx, started_at, committed_at, 1, unnest([r, w]), started_at FROM ring_log),
version AS (
  SELECT *, last_value(CASE WHEN kind = 0 THEN tx END IGNORE NULLS) OVER earlier AS written_by,
         first_value(CASE WHEN kind = 0 THEN tx END IGNORE NULLS) OVER later AS next_by
  FROM access WINDOW earlier AS (PARTITION BY row_key ORDER BY moment, kind, tx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                     later AS (PARTITION BY row_key ORDER BY moment, kind, tx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))"""


def ring_log(v):
    """Each transaction reads two neighbours in a ring of three users and writes the first of them, so that most cycles have three."""
    event, user = F.col("event_id"), F.col("user_id")
    ring = user - user % 3
    first, second = ring + event % 3, ring + (event + 1) % 3
    return v.table("events").select(
        event.alias("tx"), F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(secs=3600 + event % 36000)).alias("committed_at"),
        F.array(first, second).alias("reads"), F.array(first).alias("writes"),
    )


@query("""SELECT written_by AS from_tx, tx AS to_tx, CASE kind WHEN 0 THEN 'ww' ELSE 'wr' END AS kind, row_key FROM version WHERE written_by <> tx
UNION ALL SELECT tx, next_by, 'rw', row_key FROM version WHERE kind = 1 AND next_by <> tx""", also=RING_LOG)
def serialization_edges(v):
    return accesslog.serialization_edges(ring_log(v))


@query("""SELECT p.tx, (SELECT count(*) FROM rw WHERE writer = p.tx) AS readers_of, (SELECT count(*) FROM rw WHERE reader = p.tx) AS overwritten_by
FROM ring_log p WHERE EXISTS (SELECT 1 FROM rw i JOIN rw o ON i.writer = o.reader WHERE i.writer = p.tx
  AND o.writer_commits < p.committed_at AND o.writer_commits <= i.reader_commits)""", also=RING_LOG + """,
rw AS (SELECT a.tx AS reader, a.committed_at AS reader_commits, n.tx AS writer, n.committed_at AS writer_commits
  FROM version a JOIN ring_log n ON n.tx = a.next_by WHERE a.kind = 1 AND n.tx <> a.tx AND n.started_at < a.committed_at)""")
def dangerous_structures(v):
    return accesslog.dangerous_structures(ring_log(v))
