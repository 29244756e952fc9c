"""Ordered operators against serial runs, with ordinary and with hot keys."""

import random

import pytest
from pyspark.sql import functions as F

import serial
from ledgerspark.operators import commands, debits, transfers
from ledgerspark.sources.schemas import REQUESTS, TRANSFERS

PLAIN, HOT = 4_000_000, 40


def skewed(rng, n):
    """A third of all draws fall on 0."""
    return 0 if rng.random() < 0.34 else rng.randrange(1, n)


@pytest.mark.parametrize("split, seed", [(PLAIN, 1), (HOT, 1), (HOT, 2), (3, 2)])
def test_guarded_debits_equal_serial(spark, split, seed):
    rng = random.Random(seed)
    balances = {a: rng.choice([0, 1, 1000, 5000, 10**6]) for a in range(20)}
    rows = [(s, skewed(rng, 23), rng.choice([rng.randrange(-3, 400), 1, 2**rng.randrange(12)])) for s in range(1000)]
    rng.shuffle(rows)
    accounts = spark.createDataFrame(list(balances.items()), "id bigint, balance_minor bigint")
    asked = spark.createDataFrame(rows, "seq bigint, account_id bigint, amount_minor bigint")
    got = debits.guarded_debits(accounts, asked, split)
    assert {r.seq: r.outcome for r in got.collect()} == serial.guarded_debits(balances, rows)


def test_twenty_debits_of_a_tenth_apply_ten_times(spark):
    accounts = spark.createDataFrame([(1, 1000)], "id bigint, balance_minor bigint")
    asked = spark.range(20).select(F.col("id").alias("seq"), F.lit(1).cast("bigint").alias("account_id"), F.lit(100).cast("bigint").alias("amount_minor"))
    got = debits.guarded_debits(accounts, asked).cache()
    assert got.filter("outcome = 'APPLIED'").count() == 10
    assert debits.balances_after(accounts, got).first().balance_minor == 0


def run_transfers(spark, accounts, stored, requests, split):
    a = spark.createDataFrame([(i, c, b) for i, (c, b) in accounts.items()], "id bigint, currency string, balance_minor bigint")
    s = spark.createDataFrame([(i, k, *p) for k, (i, p) in stored.items()], TRANSFERS)
    r = spark.createDataFrame(requests, REQUESTS)
    return a, transfers.apply_transfers(a, s, r, split)


def named(rows):
    """Outcomes with transfer ids replaced by the seq of the request that made them."""
    by_id = {r.transfer_id: ("seq", r.seq) for r in rows if r.outcome == "COMPLETED"}
    return {
        r.seq: (r.outcome, by_id.get(r.transfer_id, ("stored", r.transfer_id)) if r.transfer_id else None) for r in rows
    }


@pytest.mark.parametrize("split, seed", [(PLAIN, 3), (60, 4)])
def test_transfers_equal_serial(spark, split, seed):
    rng = random.Random(seed)
    accounts = {a: ("USD" if a % 9 == 8 else "RUB", rng.choice([0, 50, 300, 2000])) for a in range(30)}
    stored = {f"k{i}": (f"old-{i}", (1, 2, 10)) for i in range(5)}
    requests = []
    for seq in range(500):
        key = "" if rng.random() < 0.01 else f"k{skewed(rng, 400)}"
        requests.append((seq, key, skewed(rng, 32), rng.randrange(32), rng.choice([0, 5, 10, 40, 200]), "me" if rng.random() < 0.98 else " "))
    for seq, *rest in rng.sample(requests, 100):
        requests.append((seq + 1000, *rest))
    a, decided = run_transfers(spark, accounts, stored, requests, split)
    rows = decided.collect()
    want, balances = serial.transfers(accounts, stored, requests)
    assert named(rows) == want
    entries = transfers.entries_of(transfers.completed(decided)).cache()
    after = {r.id: r.balance_minor for r in transfers.balances_after(a, entries).collect()}
    assert after == balances and min(after.values()) >= 0
    assert entries.agg(F.sum("amount_minor")).first()[0] in (0, None)
    assert entries.groupBy("transfer_id").agg(F.count("*").alias("n"), F.sum("amount_minor").alias("s")).filter("n <> 2 OR s <> 0").count() == 0


@pytest.mark.parametrize("n", [24, 240, 1200])
def test_rounds_of_a_hot_account_grow_with_its_ranges(spark, n):
    """Debits of 1, B, 1, B - 1, ...: every second one only fails because of all before it."""
    balance, ranges = 10_000, 6
    requests = [(s, f"k{s}", 1, 2, 1 if s % 2 == 0 else balance - s // 2, "me") for s in range(n)]
    accounts = {1: ("RUB", balance), 2: ("RUB", 0)}
    rounds = []
    a = spark.createDataFrame([(i, c, b) for i, (c, b) in accounts.items()], "id bigint, currency string, balance_minor bigint")
    r = spark.createDataFrame(requests, REQUESTS)
    got = transfers.apply_transfers(a, spark.createDataFrame([], TRANSFERS), r, n // ranges, rounds.append).collect()
    assert {x.seq for x in got if x.outcome == "COMPLETED"} == {s for s in range(n) if s % 2 == 0}
    assert len(rounds) <= ranges + 3


def test_rounds_write_what_changes(spark, monkeypatch):
    """A chain of payers, each of which needs the money of the one before, beside many accounts that are settled after the
    first rounds: a round of the chain changes one decision, and writes that one row."""
    monkeypatch.setattr(transfers, "FLIPS_FOLDED", 3)
    links, rng = 12, random.Random(1)
    accounts = {i: ("RUB", 0) for i in range(links + 1)} | {100 + i: ("RUB", 40) for i in range(60)}
    requests = [(s, f"n{s}", rng.randrange(100, 160), rng.randrange(100, 160), rng.choice([5, 20, 30]), "me") for s in range(900)]
    requests += [(1000 + i, f"c{i}", i, i + 1, 10, "me") for i in range(links)]
    rounds = []
    a = spark.createDataFrame([(i, c, b) for i, (c, b) in accounts.items()], "id bigint, currency string, balance_minor bigint")
    got = transfers.apply_transfers(a, spark.createDataFrame([], TRANSFERS), spark.createDataFrame(requests, REQUESTS), PLAIN, rounds.append)
    assert named(got.collect()) == serial.transfers(accounts, {}, requests)[0]
    assert len(rounds) >= 6 and rounds[-1] == 0
    assert sum(rounds[1:]) < len(requests) and max(rounds[len(rounds) // 2 :]) < rounds[0] / 4


def test_registered_transfers_equal_serial(spark, small):
    """The registered query with many rejections, on all requests of the small tables."""
    from ledgerspark.plans import stateful
    from ledgerspark.plans.fixtures import SMALL_OPENING_MINOR, Views

    v = Views(spark, small)
    accounts = {r.id: (r.currency, r.balance_minor) for r in stateful.wallets(v, SMALL_OPENING_MINOR).collect()}
    requests = [tuple(r) for r in stateful.requests(v).collect()]
    want, _ = serial.transfers(accounts, {}, requests)
    got = stateful.apply_transfers(v).collect()
    assert named(got) == want
    assert {r.reason for r in got} >= {None, "funds", "key reused", "accounts"}


def test_same_key_runs_once_and_cannot_change(spark):
    accounts = {1: ("RUB", 1000), 2: ("RUB", 1000)}
    requests = [(1, "same-key", 1, 2, 100, "t"), (2, "same-key", 1, 2, 100, "t"), (3, "same-key", 1, 2, 200, "t")]
    a, decided = run_transfers(spark, accounts, {}, requests, PLAIN)
    rows = {r.seq: r for r in decided.collect()}
    assert [rows[i].outcome for i in (1, 2, 3)] == ["COMPLETED", "REPLAY", "INVALID_REQUEST"]
    assert rows[1].transfer_id == rows[2].transfer_id


def test_a_failed_request_does_not_use_up_its_key(spark):
    accounts = {1: ("RUB", 50), 2: ("RUB", 1000)}
    requests = [(1, "k", 1, 2, 100, "t"), (2, "fund", 2, 1, 100, "t"), (3, "k", 1, 2, 100, "t")]
    _, decided = run_transfers(spark, accounts, {}, requests, PLAIN)
    assert [r.outcome for r in decided.orderBy("seq").collect()] == ["OPERATION_REJECTED", "COMPLETED", "COMPLETED"]


def test_fifty_transfers_back_and_forth_keep_the_total(spark):
    accounts = {1: ("RUB", 1000), 2: ("RUB", 1000)}
    requests = [(n, f"parallel-{n}", *((1, 2) if n % 2 == 0 else (2, 1)), 1, "t") for n in range(1, 51)]
    a, decided = run_transfers(spark, accounts, {}, requests, PLAIN)
    done = transfers.completed(decided).cache()
    entries = transfers.entries_of(done).cache()
    assert done.count() == 50 and entries.count() == 100
    assert transfers.balances_after(a, entries).agg(F.sum("balance_minor")).first()[0] == 2000


@pytest.mark.parametrize("split", [PLAIN, HOT, 11])
def test_optimistic_updates_equal_serial(spark, split):
    rng = random.Random(5)
    versions = {r: rng.randrange(4) for r in range(10)}
    rows, guess = [], dict(versions)
    for seq in range(1500):
        row = skewed(rng, 14)
        expected = None if rng.random() < 0.03 else max(-1, guess.get(row, 0) + rng.choice([0, 0, 0, -1, 1]))
        if rng.random() < 0.6:
            guess[row] = guess.get(row, -1) + 1
        rows.append((seq * 10**9 + rng.randrange(10**9), row, expected))  # gaps as of a clock
    stored = spark.createDataFrame(list(versions.items()), "id bigint, version bigint")
    asked = spark.createDataFrame(rows, "seq bigint, row_id bigint, expected_version bigint")
    got = commands.optimistic_updates(stored, asked, split)
    assert {r.seq: (r.outcome, r.version) for r in got.collect()} == serial.optimistic(versions, rows)


def test_begins_of_ten_thousand_ranges(spark):
    """Random maps of one row's ranges and a shorter row beside it, against following them one after the other."""
    rng = random.Random(9)
    rounds, points, ranges, want = [], [], [], {}
    for row, n in ((7, 10_000), (8, 5)):
        version = 3
        for split in range(n):
            shift = int(rng.random() < 0.2)
            known = {version + rng.randrange(-3, 4) for _ in range(2)} if rng.random() < 0.5 else set()
            moves = {v: v + shift + 1 + rng.randrange(2) for v in known if v >= 0}
            points += [(row, 5 * split, v, out) for v, out in moves.items()]
            ranges.append((row, 5 * split, 3, shift, 4))
            want[row, 5 * split] = version
            version = moves.get(version, version + shift)
    got = commands._begins(
        spark.createDataFrame(points, "row_id long, _split long, _version long, _out long"),
        spark.createDataFrame(ranges, "row_id long, _split long, _start long, _shift long, _commands long"), lambda *r: rounds.append(r))
    assert {(r["row_id"], r["_split"]): r["_begin"] for r in got.collect()} == want
    assert 10 < len(rounds) <= 15


def test_commands_without_a_row(spark):
    stored = spark.createDataFrame([(1, 0)], "id bigint, version bigint")
    asked = spark.createDataFrame([(1, None, None), (2, None, 0), (3, 1, 0)], "seq bigint, row_id bigint, expected_version bigint")
    for split in (1, 100):
        got = commands.optimistic_updates(stored, asked, split)
        assert [(r.outcome, r.version) for r in got.orderBy("seq").collect()] == [("NOT_FOUND", None), ("NOT_FOUND", None), ("APPLIED", 1)]


def test_a_long_run_of_right_versions_on_one_row(spark):
    n = 600
    rows = [(i, 1, i) for i in range(n)]
    stored = spark.createDataFrame([(1, 0)], "id bigint, version bigint")
    asked = spark.createDataFrame(rows, "seq bigint, row_id bigint, expected_version bigint")
    got = commands.optimistic_updates(stored, asked, HOT)
    assert got.filter("outcome = 'APPLIED'").count() == n
    assert commands.versions_after(stored, got).first().version == n


def test_operation_state_equals_serial(spark):
    rng = random.Random(6)
    rows = [
        (s, rng.choice(["", "a", "b", f"k{rng.randrange(60)}"]), rng.choice([0, 100, 100, 100, 200]), rng.choice(["OK", "ERROR", "TIMEOUT", "TIMEOUT"]))
        for s in range(500)
    ]
    got = commands.operation_state(spark.createDataFrame(rows, "seq bigint, idempotency_key string, amount_minor bigint, gateway string"))
    assert {r.seq: (r.outcome, r.status) for r in got.collect()} == serial.operations(rows)


def test_operation_cases(spark):
    rows = [(1, "same", 100, "OK"), (2, "same", 100, "OK"), (3, "same", 200, "OK"), (4, "slow", 100, "TIMEOUT")]
    got = commands.operation_state(spark.createDataFrame(rows, "seq bigint, idempotency_key string, amount_minor bigint, gateway string"))
    assert [r.outcome for r in got.orderBy("seq").collect()] == ["CHARGED", "REPLAY", "REJECTED", "UNKNOWN"]
    assert {r.idempotency_key: r.status for r in commands.operations_after(got).collect()} == {"same": "COMPLETED", "slow": "RESERVED"}


def test_notes(spark):
    rows = [(1, "n", None), (2, "n", 0), (3, "n", 0), (4, "missing", 0)]
    got = commands.optimistic_updates(
        spark.createDataFrame([], "id string, version bigint"),
        spark.createDataFrame(rows, "seq bigint, row_id string, expected_version bigint"),
    )
    assert [(r.outcome, r.version) for r in got.orderBy("seq").collect()] == [("APPLIED", 0), ("APPLIED", 1), ("STALE", 1), ("NOT_FOUND", None)]


def test_claims_do_not_overlap(spark):
    jobs = spark.range(100).selectExpr("id", "if(id % 3 = 0, 'DONE', 'READY') AS status")
    got = commands.claim_jobs(jobs, 5, 4).orderBy("id").collect()
    ready = [i for i in range(100) if i % 3]
    assert [(r.id, r.worker) for r in got] == [(i, n // 4 if n // 4 < 5 else None) for n, i in enumerate(ready)]


def test_tokens(spark):
    tokens = spark.createDataFrame([("a", 100), ("b", 5)], "token string, expires_at bigint")
    uses = spark.createDataFrame([(1, "a", 10), (2, "a", 20), (3, "b", 5), (4, "b", 6), (5, "x", 1)], "use_id bigint, token string, used_at bigint")
    got = commands.one_use_tokens(tokens, uses).orderBy("use_id").collect()
    assert [r.outcome for r in got] == ["ROTATED", "REVOKED", "EXPIRED", "REVOKED", "UNKNOWN"]


def test_error_classes(spark):
    errors = spark.createDataFrame([("40001",), ("40001",), ("23505",), ("99999",)], "sqlstate string")
    got = {r.sqlstate: (r.errors, r.retry) for r in commands.retryable_errors(errors, "sqlstate").collect()}
    assert got == {"40001": (2, "yes"), "23505": (1, "no"), "99999": (1, "no")}


def test_covered_transfers_shuffle_requests_once_by_key(spark, capsys):
    """requests went by their key four times, and were written twice before that."""
    accounts = spark.createDataFrame([(i, "RUB", 10**6) for i in range(5)], "id bigint, currency string, balance_minor bigint")
    requests = spark.createDataFrame([(i, f"k{i % 20}", i % 5, (i + 1 + i % 3) % 5, 10, "a") for i in range(60)], REQUESTS)
    decided = transfers.apply_transfers(accounts, spark.createDataFrame([], TRANSFERS), requests)
    decided.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning(idempotency_key") == 1
    got = {r.seq: (r.outcome, r.reason) for r in decided.collect()}
    same = lambda i: (i % 20 % 5, (i % 20 + 1 + i % 20 % 3) % 5) == (i % 5, (i + 1 + i % 3) % 5)
    assert got == {i: ("COMPLETED", None) if i < 20 else ("REPLAY", None) if same(i) else ("INVALID_REQUEST", "key reused") for i in range(60)}
