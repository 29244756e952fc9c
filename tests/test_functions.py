"""Column expressions and small operators on hand-made rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerspark.functions import scalars as S
from ledgerspark.operators import aggregates, diagnostics, filters, joins, ledger


def values(spark, expression, *rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize(
    "pattern, want",
    [
        ({"channel": "ios"}, [True, True, False, False, False]),
        ({"n": 1}, [True, True, False, False, False]),
        ({"n": 1.0}, [True, True, False, False, False]),
        ({"n": "1"}, [False, False, True, False, False]),
        ({"tags": ["b"]}, [True, False, False, False, False]),
        ({"tags": ["b", "a"]}, [True, False, False, False, False]),
        ({"tags": []}, [True, True, False, False, False]),
        ({"o": {"p": {"q": True}}}, [True, False, False, False, False]),
        ({"o": {}}, [True, True, False, False, False]),
        ({"z": None}, [True, False, False, False, False]),
        ({"list": [{"k": 1}]}, [True, False, False, False, False]),
        ({}, [True, True, True, False, False]),
    ],
)
def test_json_contains(spark, pattern, want):
    rows = [
        '{"channel":"ios","n":1,"tags":["a","b"],"o":{"p":{"q":true,"r":0}},"z":null,"list":[{"j":2,"k":1}]}',
        '{"channel":"ios","n":1.0,"tags":[],"o":{"p":{"q":false}},"z":0,"list":[{"k":2}]}',
        '{"channel":"web","n":"1","tags":"b"}',
        "not json",
        None,
    ]
    assert values(spark, S.json_contains("x", pattern), *rows) == want


def test_words(spark):
    rows = ["The licence", "other", "breathe the, air", "THE", "the_end", "wreathes"]
    assert values(spark, S.has_word("x", "the"), *rows) == [True, False, True, True, True, False]
    with pytest.raises(ValueError):
        S.has_word("x", "a b")


def test_ids_and_currencies(spark):
    assert values(spark, S.is_safe_id("x"), "a-B.9:_", "", "a b", "x" * 129, "x" * 128, "a\n", None) == [
        True, False, False, False, True, False, False
    ]
    assert values(spark, S.is_currency("x"), "EUR", "eur", "EURO", "EUR\n", None) == [True, False, False, False, False]
    assert values(spark, S.is_request_name("x"), "k", " ", "", "x" * 129, None) == [True, False, False, False, False]


def test_null_is_distinct_from_a_value(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    assert filters.filter_null_safe(df, "x", 1).count() == 2


def test_null_order_is_explicit(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "id int, x int")
    assert [r.id for r in df.orderBy(F.desc_nulls_last("x")).collect()] == [3, 1, 2]


def test_zero_whole_gives_null(spark):
    df = spark.createDataFrame([("a", 1, 0), ("b", 1, 4)], "k string, p int, w int")
    got = aggregates.pipelined_ratio(df, F.col("p"), F.col("w"), 2, "k")
    assert {r.k: r.percent for r in got.collect()} == {"a": None, "b": 25.0}


def test_left_join_keeps_the_left_side(spark):
    left = spark.createDataFrame([(1,), (2,)], "id int")
    right = spark.createDataFrame([(1, "A"), (2, "B")], "k int, status string")
    got = joins.left_join_condition(left, right, "id", "k", F.col("status") == "A", ["status"])
    assert sorted((r.id, r.status) for r in got.collect()) == [(1, "A"), (2, None)]


def test_sums_above_bigint_stop_the_job(spark):
    big = spark.createDataFrame([(1, 2**62), (1, 2**62)], "account_id bigint, amount_minor bigint")
    with pytest.raises(Exception, match="(?i)overflow"):
        ledger.ledger_sums(big).collect()


def test_histograms_of_two_days_add_up(spark):
    one = spark.createDataFrame([(1, float(x)) for x in range(60)], "day int, ms double")
    two = spark.createDataFrame([(1, float(x)) for x in range(40, 3000, 50)], "day int, ms double")
    apart = aggregates.latency_histogram(one, "ms", "day").unionByName(aggregates.latency_histogram(two, "ms", "day"))
    summed = apart.groupBy("day", "le").agg(F.sum("requests").alias("requests"))
    together = aggregates.latency_histogram(one.unionByName(two), "ms", "day")
    assert summed.exceptAll(together).count() == 0
    assert aggregates.histogram_quantile(together, 0.5, "day").first()["le"] in (50, 100)


def test_metrics_refuse_ids_as_tags(spark):
    log = spark.createDataFrame([("GET", "r1", 1.0)], "method string, request_id string, ms double")
    with pytest.raises(ValueError):
        diagnostics.request_metrics(log, "method", "request_id")


def test_deadlock_is_found_behind_a_queue(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 2), (4, 5), (5, 6), (7, 1), (8, 8)], "waiting_pid int, blocking_pid int")
    got = {r.pid: r.on_cycle for r in diagnostics.wait_cycles(edges).collect()}
    assert got == {1: False, 2: True, 3: True, 7: False, 8: True}
    assert [r.blocking_pid for r in diagnostics.root_blockers(edges).collect()] == [6]


def components(edges):
    """Those that reach each other, by plain search."""
    after = {}
    for a, b in edges:
        after.setdefault(a, set()).add(b)

    def reach(a):
        seen, todo = set(), [a]
        while todo:
            new = after.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        return seen

    ahead = {a: reach(a) for a in after}
    return {a: min(b for b in ahead[a] if a in ahead.get(b, ())) for a in after if a in ahead[a]}


def test_each_deadlock_has_a_name(spark):
    for seed in range(3):
        rng = random.Random(seed)
        edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(45)] + [(None, 1), (1, None)]
        got = diagnostics.deadlocks(spark.createDataFrame(edges * 2, "waiting_pid bigint, blocking_pid bigint")).collect()
        want = components([e for e in edges if None not in e])
        assert sorted((r.pid, r.deadlock) for r in got) == sorted(want.items())
    chain = spark.createDataFrame([(1, 2), (2, 3)], "waiting_pid bigint, blocking_pid bigint")
    assert diagnostics.deadlocks(chain).count() == 0 and diagnostics.deadlocks(chain.limit(0)).count() == 0


def test_a_long_deadlock_of_doubly_blocked_sessions_takes_few_rounds(spark):
    """1,000 sessions, each blocked by the next two, round in a ring: colours go forward once and backward once."""
    rounds = []
    edges = [(i, (i + k) % 1000) for i in range(1000) for k in (1, 2)] + [(2000, 5), (5000, 5001), (5001, 5000)]
    got = diagnostics.deadlocks(spark.createDataFrame(edges, "waiting_pid bigint, blocking_pid bigint"), rounds.append).collect()
    assert {(r.pid, r.deadlock) for r in got} == {(i, 0) for i in range(1000)} | {(5000, 5000), (5001, 5000)}
    assert len(rounds) <= 40, len(rounds)


def test_overlap_counts_without_pairs(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["k", "k", "l", None]), rng.choice([None, *range(40)]), rng.randrange(45)) for i in range(250)]
    df = spark.createDataFrame([(i, k, None if s is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=s), dt.datetime(2024, 1, 1) + dt.timedelta(hours=e)) for i, k, s, e in rows],
                               "id bigint, k string, s timestamp_ntz, e timestamp_ntz")
    real = [r for r in rows if r[1] and r[2] is not None and r[2] < r[3]]
    want = {i: 0 for i, *_ in rows} | {i: sum(k == k2 and i != j and s < e2 and s2 < e for j, k2, s2, e2 in real) for i, k, s, e in real}
    for split in (10**6, 20):
        got = joins.overlap_counts(df, "k", "s", "e", split)
        assert {r.id: r.overlaps for r in got.collect()} == want
    named = spark.createDataFrame([(3,), (4,), (4,), (999,)], "who bigint")
    partners = joins.overlaps_of(df, named, "k", "s", "e", 3600 * 5).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in partners} == {i: want[i] for i in (3, 4) if want[i]}


def test_overlap_join_shuffles_narrow_rows(spark, capsys):
    """every row was shuffled with its columns twice and its bucket, level and side as numbers of their own."""
    from pyspark.sql.types import LongType

    rows = [(i, i % 2, f"2024-01-{1 + i:02d} 00:00:00", f"2024-01-{4 + i:02d} 00:00:00") for i in range(6)]
    df = spark.createDataFrame(rows, "id bigint, k int, s string, e string").select(
        "id", "k", F.col("s").cast("timestamp_ntz").alias("s"), F.col("e").cast("timestamp_ntz").alias("e"))
    pairs = joins.overlap_join(df.filter("id % 5 = 0"), df, ["k"], "s", "e", 86400 * 4)
    assert [f.name for f in pairs.schema["r"].dataType] == ["id", "k", "s", "e"] and isinstance(pairs.schema["r"].dataType["id"].dataType, LongType)
    assert sorted((r.l.id, r.r.id) for r in pairs.collect()) == [(0, 0), (0, 2), (5, 3), (5, 5)]
    pairs.explain("formatted")
    outputs = [line for line in capsys.readouterr().out.splitlines() if line.startswith("Output [") and "_r_place" in line]
    assert outputs and all(line.count(",") <= 5 for line in outputs)


def test_overlaps_across_buckets_appear_once(spark):
    rows = [(i, 1, f"2024-01-{1 + i:02d} 00:00:00", f"2024-01-{4 + i:02d} 00:00:00") for i in range(6)]
    df = spark.createDataFrame(rows, "id int, k int, s string, e string").select(
        "id", "k", F.col("s").cast("timestamp_ntz").alias("s"), F.col("e").cast("timestamp_ntz").alias("e")
    )
    got = sorted((r.left_id, r.right_id) for r in joins.range_overlap_join(df, "k", "s", "e", 3600 * 7).collect())
    assert got == [(a, b) for a in range(6) for b in range(a + 1, 6) if b - a < 3]
    assert sorted(r.id for r in joins.overlapping_periods(df, "k", "s", "e").collect()) == [1, 2, 3, 4, 5]
    assert sorted(r.id for r in joins.overlapping_periods(df, "k", "s", "e", 2).collect()) == [1, 2, 3, 4, 5]


def test_long_and_short_periods_meet(spark):
    import random

    rng = random.Random(9)
    rows = []
    for i in range(120):
        start = rng.randrange(0, 500_000)
        rows.append((i, i % 2, start, start + rng.choice([1, 50, 3600, 4000, 70_000, 400_000, 9_000_000])))
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    df = spark.createDataFrame(rows, "id int, k int, a bigint, b bigint").select(
        "id", "k", (base + F.make_dt_interval(secs=F.col("a"))).alias("s"), (base + F.make_dt_interval(secs=F.col("b"))).alias("e")
    )
    got = sorted((r.left_id, r.right_id) for r in joins.range_overlap_join(df, "k", "s", "e", 3600).collect())
    want = [(x[0], y[0]) for x in rows for y in rows if x[0] < y[0] and x[1] == y[1] and x[2] < y[3] and y[2] < x[3]]
    assert got == sorted(want)


def test_worker_functions_travel_with_the_job():
    from pyspark import cloudpickle

    from ledgerspark.functions import batches

    code = batches.lists.__code__.co_code
    assert code in cloudpickle.dumps(batches.lists)  # the function itself, not a reference to a module


def test_database_reads_are_partitioned():
    from ledgerspark.sources.jdbc import read_options

    options = read_options("jdbc:postgresql://host/db", "payments", "id", 1, 1000, 8, user="reader")
    assert (options["partitionColumn"], options["numPartitions"], options["user"]) == ("id", "8", "reader")
    with pytest.raises(ValueError):
        read_options("jdbc:x", "t", "id", 5, 1, 8)


def test_long_chains_of_waiters_take_few_rounds(spark):
    rounds = []
    chain = [(i, i + 1) for i in range(1000)]
    behind = [(2000 + i, 2001 + i) for i in range(300)] + [(2300, 2290)]
    edges = spark.createDataFrame(chain + behind, "waiting_pid bigint, blocking_pid bigint")
    got = {r.pid: r.on_cycle for r in diagnostics.wait_cycles(edges, rounds.append).collect()}
    assert got == {2000 + i: i >= 290 for i in range(301)}
    assert len(rounds) < 30


def test_words_in_any_language(spark):
    df = spark.createDataFrame([(1, "éthe license"), (2, "Лицензия на код"), (3, "лицензия2"), (4, "the été."), (5, None)], "id int, t string")
    from ledgerspark.functions.scalars import has_word

    def found(word):
        return [r.id for r in df.filter(has_word("t", word)).collect()]

    assert found("the") == [4] and found("лицензия") == [2] and found("Été") == [4]
    with pytest.raises(ValueError):
        has_word("t", "two words")


def test_short_periods_do_not_meet_because_of_a_long_one(spark):
    import datetime as dt

    day = dt.timedelta(days=1)
    at = dt.datetime(2020, 1, 1)
    rows = [(i, 1, at + i * day, at + i * day + day / 2) for i in range(400)] + [(1000, 1, at, at + 4000 * day)]
    df = spark.createDataFrame(rows, "id bigint, k int, s timestamp_ntz, e timestamp_ntz")
    pairs = {(r.left_id, r.right_id) for r in joins.range_overlap_join(df, "k", "s", "e", 86400).collect()}
    assert pairs == {(i, 1000) for i in range(400)}
