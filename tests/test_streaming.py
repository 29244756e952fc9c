"""Streams of several batches: late rows, repeated batches, timers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import serial
from ledgerspark.session import scratch_path
from ledgerspark.sources.store import VersionedStore
from ledgerspark.streaming import jobs

START = dt.datetime(2024, 1, 1)


class Feed:
    """A folder that gets one file per step, read one file per batch."""

    def __init__(self, spark, schema):
        self.spark, self.schema, self.path = spark, schema, scratch_path(spark, "feed")
        self.n = 0

    def add(self, *rows):
        folder = f"{self.path}/{self.n:04d}"
        self.n += 1
        self.spark.createDataFrame(list(rows), self.schema).coalesce(1).write.parquet(folder)

    def stream(self):
        reader = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
        return reader.option("recursiveFileLookup", "true").parquet(self.path)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def collect(spark, stream):
    return jobs.drain(stream, scratch_path(spark, "checkpoint"), scratch_path(spark, "out")).collect()


def test_dedupe_forgets_after_the_watermark(spark):
    feed = Feed(spark, "k string, ts timestamp")
    feed.add(("a", at(0)), ("a", at(1)), ("b", at(2)))
    feed.add(("a", at(5)), ("c", at(60)))
    feed.add(("c", at(62)))
    feed.add(("late", at(1)), ("a", at(63)))
    rows = collect(spark, jobs.stream_dedupe(feed.stream(), ["k"], "ts", "10 minutes"))
    assert sorted(r.k for r in rows) == ["a", "a", "b", "c"]  # the second "a" after the first was forgotten


def test_windows_drop_late_rows(spark):
    feed = Feed(spark, "ts timestamp, method string, status bigint, ms double")
    feed.add((at(1), "GET", 200, 5.0), (at(2), "GET", 200, 7.0))
    feed.add((at(40), "GET", 200, 1.0))
    feed.add((at(41), "GET", 200, 1.0))
    feed.add((at(3), "GET", 200, 100.0), (at(90), "GET", 200, 1.0))
    rows = collect(spark, jobs.stream_request_metrics(feed.stream(), "ts", "5 minutes", "10 minutes"))
    first = min(rows, key=lambda r: r.window_start)
    assert (first.requests, first.total_ms, first.max_ms) == (2, 12.0, 7.0)


def test_sessions_end_after_the_gap(spark):
    feed = Feed(spark, "pid bigint, ts timestamp")
    feed.add((1, at(0)), (1, at(3)), (1, at(30)), (2, at(1)))
    feed.add((3, at(200)))
    rows = collect(spark, jobs.stream_sessions(feed.stream(), "pid", "ts", "1 minute", "10 minutes"))
    assert sorted((r.pid, r.requests) for r in rows) == [(1, 1), (1, 2), (2, 1)]


def test_running_balance_over_batches_and_replay(spark):
    store = VersionedStore(spark, scratch_path(spark, "store"))
    store.publish(replace={"balances": spark.createDataFrame([(1, 1000), (2, 500)], "id bigint, balance_minor bigint")})
    rows = [(s, 1 + s % 2, 90) for s in range(30)]
    feed = Feed(spark, "seq bigint, account_id bigint, amount_minor bigint")
    for i in range(0, 30, 10):
        feed.add(*rows[i : i + 10])
    handler = jobs.running_balance_batch(store, fold_every=2)
    jobs.drain_batches(feed.stream(), scratch_path(spark, "checkpoint"), handler)
    want = serial.guarded_debits({1: 1000, 2: 500}, rows)
    assert {r.seq: r.outcome for r in store.read("outcomes").collect()} == want
    left = {r.id: r.balance_minor for r in jobs.current_balances(store).collect()}
    assert left == {1: 1000 - 11 * 90, 2: 500 - 5 * 90}
    version = store.versions()[-1]
    handler(spark.createDataFrame(rows[20:], feed.schema), 2)  # the last batch once more
    assert store.versions()[-1] == version


def test_running_balance_as_state_of_the_stream(spark):
    """Several batches, one of them run again from the checkpoint, rows out of order, late and repeated rows."""
    balances = spark.createDataFrame([(1, 1000), (2, 500)], "id bigint, balance_minor bigint")
    rows = [(s, 1 + s % 2, 90) for s in range(30)]
    feed = Feed(spark, "seq bigint, account_id bigint, amount_minor bigint")
    checkpoint, out = scratch_path(spark, "checkpoint"), scratch_path(spark, "out")

    def run():
        return {(r.seq, r.account_id): r.outcome for r in jobs.drain(jobs.stream_running_balance(spark, feed.stream(), balances), checkpoint, out).collect()}

    feed.add(*rows[10:0:-1], rows[0])
    feed.add(*rows[11:20])
    want = serial.guarded_debits({1: 1000, 2: 500}, rows[:20])
    assert {s: o for (s, _), o in run().items()} == want
    assert len(run()) == 20  # nothing new: nothing is decided again
    feed.add((25, 1, 10), (3, 7, 10), (26, 1, 0), (27, None, 5))
    feed.add((24, 1, 10), (28, 1, 10), (28, 2, 5))
    got = run()
    assert [got[k] for k in ((25, 1), (3, 7), (26, 1), (27, None), (24, 1), (28, 1), (28, 2))] == ["REJECTED" if 1000 - 11 * 90 < 10 else "APPLIED", "NOT_FOUND", "INVALID", "INVALID", "LATE", got[28, 1], "APPLIED"]
    assert len(got) == 27
    assert jobs.drain(jobs.stream_running_balance(spark, feed.stream(), balances), checkpoint, out).count() == 27


def test_projection_over_batches(spark):
    store = VersionedStore(spark, scratch_path(spark, "store"))
    feed = Feed(spark, "account_id bigint, amount_minor bigint")
    feed.add((1, 100), (1, -30))
    feed.add((2, 5), (1, 1))
    jobs.drain_batches(feed.stream(), scratch_path(spark, "checkpoint"), jobs.rebuild_projection_batch(store))
    assert {r.id: r.balance_minor for r in jobs.current_balances(store).collect()} == {1: 71, 2: 5}


def test_outbox_is_delivered_again_only_after_a_crash(spark):
    store, sent = VersionedStore(spark, scratch_path(spark, "store")), []

    def deliver(rows):
        sent.extend(r.id for r in rows.collect())
        if len(sent) == 2:
            raise RuntimeError("crash after delivery")

    handler = jobs.relay_outbox_batch(store, deliver)
    rows = spark.createDataFrame([(1,), (2,)], "id bigint")
    with pytest.raises(RuntimeError):
        handler(rows, 0)
    handler(rows, 0)
    handler(rows, 0)
    handler(spark.createDataFrame([(2,), (3,)], "id bigint"), 1)
    assert sent == [1, 2, 1, 2, 3]


def test_outbox_keeps_ranges_between_open_ids(spark):
    """Ids come out of order and again; a crash between delivery and note delivers a batch once more."""
    store, sent = VersionedStore(spark, scratch_path(spark, "store")), []
    handler = jobs.relay_outbox_batch(store, lambda rows: sent.extend(r.id for r in rows.collect()), F.col("id") % 10 != 0, rows_per_split=7)
    draw, late = random.Random(1), {17, 18, 55}
    ids = [i for i in range(1, 121) if i not in late]
    batches = [ids[k : k + 20] for k in range(0, len(ids), 20)]
    assert jobs.low_water_mark(store) is None
    for number, batch in enumerate(batches):
        again = draw.sample(ids[: 20 * number + 1], min(5, number))
        mixed = [*batch, *again, batch[0], None]
        draw.shuffle(mixed)
        handler(spark.createDataFrame([(i,) for i in mixed], "id bigint"), number)
        assert store.read("sent").count() <= 1 + 2  # one range up to each of the two gaps, and the rest
    assert jobs.low_water_mark(store) == 16
    assert sorted(map(tuple, store.read("sent").collect())) == [(1, 16), (19, 54), (56, 120)]
    handler(spark.createDataFrame([(18,), (55,), (20,)], "id bigint"), 10)
    assert sorted(map(tuple, store.read("sent").collect())) == [(1, 16), (18, 120)]
    handler(spark.createDataFrame([(17,)], "id bigint"), 11)
    handler(spark.createDataFrame([], "id bigint"), 12)
    assert [tuple(r) for r in store.read("sent").collect()] == [(1, 120)] and jobs.low_water_mark(store) == 120
    assert sorted(sent) == [i for i in range(1, 121) if i % 10]


def test_stuck_operations(spark):
    feed = Feed(spark, "idempotency_key string, status string, ts timestamp")
    feed.add(("done", "RESERVED", at(0)), ("stuck", "RESERVED", at(1)), ("tick", "COMPLETED", at(1)))
    feed.add(("done", "COMPLETED", at(3)), ("retried", "FAILED", at(4)), ("retried", "RESERVED", at(5)))
    feed.add(("tick", "COMPLETED", at(120)))
    feed.add(("tick", "COMPLETED", at(121)))
    rows = collect(spark, jobs.stream_stuck_operations(spark, feed.stream(), "ts", "1 minute", 600_000))
    assert sorted((r.idempotency_key, r.reserved_at.replace(tzinfo=None)) for r in rows) == [("retried", at(5)), ("stuck", at(1))]


def test_many_keys_share_the_state_of_a_bucket(spark):
    """a call per key. Here 40 keys are followed in 3 buckets, over several batches, with the results of serial runs."""
    balances = spark.createDataFrame([(a, 300) for a in range(39)] + [(None, 5)], "id bigint, balance_minor bigint")
    feed = Feed(spark, "seq bigint, account_id bigint, amount_minor bigint")
    rows = [(s, s * 7 % 40, 20 + s % 50) for s in range(400)]
    feed.add(*rows[200:0:-1], rows[0])
    feed.add(*rows[200:])
    got = collect(spark, jobs.stream_running_balance(spark, feed.stream(), balances, 3))
    assert {r.seq: r.outcome for r in got} == serial.guarded_debits({a: 300 for a in range(39)}, rows)
    feed = Feed(spark, "idempotency_key string, status string, ts timestamp")
    feed.add(*[(f"k{i}", "RESERVED", at(i)) for i in range(40)], (None, "RESERVED", at(2)))
    feed.add(*[(f"k{i}", "COMPLETED" if i % 3 else "RESERVED", at(i + 2)) for i in range(0, 40, 2)])
    feed.add(("tick", "COMPLETED", at(40)))
    feed.add(("tick", "COMPLETED", at(200)))
    feed.add(("tick", "COMPLETED", at(201)))
    got = collect(spark, jobs.stream_stuck_operations(spark, feed.stream(), "ts", "1 minute", 600_000, 3))
    want = {f"k{i}": at(i if i % 2 else i + 2) for i in range(40) if i % 2 or i % 3 == 0} | {None: at(2)}
    assert len(got) == len(want) and {r.idempotency_key: r.reserved_at.replace(tzinfo=None) for r in got} == want


def test_event_time_needs_a_zone(spark):
    df = spark.createDataFrame([(START,)], "ts timestamp_ntz")
    assert jobs.with_event_time(df, "ts").schema["ts"].dataType.simpleString() == "timestamp"
    assert jobs.with_event_time(df, "ts").select(F.col("ts").cast("timestamp_ntz")).first()[0] == START
