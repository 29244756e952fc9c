"""Stored sketches against exact counts: errors within the stated bounds, batches that merge into the whole."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerspark.operators import sketches as S

WANTED = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def latencies(spark, n=60_000):
    rng = random.Random(4)
    rows = [("a" if rng.random() < 0.7 else None, dt.datetime(2024, 1, 1 + rng.randrange(9)), None if i % 50 == 0 else round(rng.lognormvariate(3, 1), 2)) for i in range(n)]
    return spark.createDataFrame(rows, "kind string, at timestamp_ntz, ms double")


def test_percentiles_of_any_period_from_daily_sketches(spark):
    df = latencies(spark).cache()
    first, second = df.filter("ms < 20 OR ms IS NULL"), df.filter("ms >= 20")  # a batch that comes later is more rows
    stored = S.daily_sketches(first, "ms", "at", "kind").unionByName(S.daily_sketches(second, "ms", "at", "kind")).cache()
    assert stored.count() == 36
    for condition in (None, F.col("day").between(dt.date(2024, 1, 3), dt.date(2024, 1, 5))):
        rows = df if condition is None else df.filter(F.to_date("at").between(dt.date(2024, 1, 3), dt.date(2024, 1, 5)))
        found = S.merged_percentiles(stored, WANTED, "kind", condition=condition)
        assert {r["kind"]: r["rows"] for r in found.collect()} == {r["kind"]: r["n"] for r in rows.groupBy("kind").agg(F.count("ms").alias("n")).collect()}
        errors = S.rank_errors(rows, "ms", found, WANTED, "kind").collect()
        assert len(errors) == 2 and all(r[p] < S.RANK_ERROR for r in errors for p in WANTED)


def test_a_profile_grows_without_the_table(spark):
    df = spark.range(40_000).select(
        "id", (F.col("id") % 700).cast("int").alias("few"), F.when(F.col("id") % 4 == 0, F.col("id") / 3).alias("part"),
        F.concat(F.lit("m-"), F.col("id") % 9000).alias("name"), F.lit(None).cast("string").alias("none"),
        F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("at"), (F.col("id") % 2 == 0).alias("flag"))
    parts = [S.column_sketches(df.filter(F.col("id") % 3 == k)) for k in range(3)]
    found = {r["column"]: r for r in S.profile(parts[0].unionByName(parts[1]).unionByName(parts[2])).collect()}
    assert set(found) == set(df.columns)
    for c in df.columns:
        exact = df.agg(F.count_distinct(c), F.count(c), F.min(c).cast("string"), F.max(c).cast("string")).first()
        assert abs(found[c]["different"] - exact[0]) <= S.COUNT_ERROR * exact[0]
        assert (found[c]["rows"], found[c]["smallest"], found[c]["largest"]) == (40_000, exact[2], exact[3])
        assert found[c]["null_pct"] == round((40_000 - exact[1]) / 400, 4)
    empty = {r["column"]: r for r in S.profile(S.column_sketches(df.limit(0))).collect()}
    assert all(r["rows"] == 0 and r["different"] == 0 and r["smallest"] is None for r in empty.values())


def test_overlap_of_two_groups(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 20_000, F.lit("a")).otherwise(F.lit("b")).alias("kind"), (F.col("id") % 15_000).alias("who"))
    stored = S.key_sketches(df.filter("id % 2 = 0"), "who", "kind").unionByName(S.key_sketches(df.filter("id % 2 = 1"), "who", "kind"))
    got = S.overlap(stored, "kind", "a", "b").first()
    for name, exact in (("in_first", 15_000), ("in_second", 10_000), ("in_both", 10_000), ("in_any", 15_000)):
        assert abs(got[name] - exact) < 0.05 * exact
