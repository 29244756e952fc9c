"""The ordered scan: cut groups give what a plain window gives."""

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators.scans import Running, cut, global_rank, ordered_scan, seq_split, with_key_values


@pytest.fixture(scope="module")
def rows(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    key = F.when(F.col("o_custkey") % 3 == 0, 0).when(F.col("o_custkey") % 7 == 0, None).otherwise(F.col("o_custkey"))
    value = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey") % 100)
    return orders.select(key.alias("k"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("at"), value.alias("v")).cache()


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("descending", [False, True])
def test_cut_groups_equal_whole_groups(rows, keys, descending):
    wanted = {
        "running": {
            "total": Running("sum", "v"), "before": Running("sum", "v", inclusive=False), "top": Running("max", "v"),
            "low": Running("min", "v", inclusive=False), "n": Running("count", "v"),
        },
        "number": "rank",
        "previous": {"last": "v"},
        "descending": descending,
    }
    whole = ordered_scan(rows, keys, ["at", "id"], **wanted).orderBy("id").toPandas()
    cut = ordered_scan(rows, keys, ["at", "id"], rows_per_split=40, **wanted).orderBy("id").toPandas()
    assert whole.equals(cut)


def test_hot_group_is_spread(rows):
    sizes = cut(rows, ["k"], ["at", "id"], 40)[0].filter("k = 0").groupBy("_split").count().toPandas()["count"]
    assert len(sizes) > 5 and sizes.max() < 0.5 * sizes.sum()


def test_nothing_is_cut_when_every_group_is_small(rows):
    assert cut(rows, ["k"], ["at", "id"], 100_000) is None


def test_a_known_split_needs_no_count(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq"))
    got = ordered_scan(df, ["k"], ["seq"], running={"n": Running("count", "seq")}, split=seq_split(16))
    assert all(r.n == r.seq // 3 + 1 for r in got.collect())


def test_equal_order_values_keep_all_rows(spark):
    same = spark.range(500).select(F.lit(1).alias("k"), F.lit(7).alias("at"), F.col("id"))
    got = ordered_scan(same, ["k"], ["at"], number="n", rows_per_split=20)
    assert sorted(r.n for r in got.collect()) == list(range(1, 501))


@pytest.mark.parametrize("ranges", [None, 1, 30])
def test_global_rank(spark, ranges, monkeypatch):
    monkeypatch.setattr("ledgerspark.operators.scans.RANGES_PER_BLOCK", 4)
    got = global_rank(spark.range(300).select((F.lit(1000) - F.col("id")).alias("x")), ["x"], "r", ranges)
    assert all(r.r == r.x - 700 for r in got.collect())


def test_only_large_groups_are_written(rows):
    large, rest = cut(rows, ["k"], ["at", "id"], 40)
    sizes = {r["k"]: r["count"] for r in rows.groupBy("k").count().collect()}
    assert {r.k for r in large.select("k").distinct().collect()} == {k for k, n in sizes.items() if n > 40}
    assert large.count() + rest.count() == rows.count()


def test_no_rank_in_one_task(spark):
    """A rank is a sort by ranges: the only window without keys is over one row per block of ranges."""
    plan = global_rank(spark.range(300), ["id"], "r")._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan


def test_small_ranges_do_not_make_many_tasks(spark):
    """F8: 3,000 ranges of 10 rows were 3,000 tasks, each of which reports to the driver."""
    parts, _ = cut(spark.range(30_000).select(F.lit(1).alias("k"), "id"), ["k"], ["id"], 10)
    assert parts.rdd.getNumPartitions() <= 8 and len(parts.inputFiles()) <= 8
    ranges = parts.groupBy("_split").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("n")).orderBy("_split").toPandas()
    assert ranges["n"].max() <= 10 and ranges["n"].sum() == 30_000 and (ranges["a"][1:].values > ranges["b"][:-1].values).all()


def test_ranked_rows_are_not_shuffled_again(spark, capsys):
    """rows were shuffled by the number of their range to add one value for each range."""
    ranked = global_rank(spark.range(100).select((99 - F.col("id")).alias("a"), F.lit("x").alias("b")), ["a"], "n", keep=["a"])
    assert ranked.columns == ["a", "n"] and all(r.n == r.a + 1 for r in ranked.collect())
    ranked.explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out


@pytest.mark.parametrize("rows_per_split", [10**6, 30])
def test_first_of_every_key_in_one_shuffle(spark, capsys, rows_per_split):
    from ledgerspark.operators.commands import classify_requests

    rows = [(i, None if i % 11 == 0 else f"k{i % 7 if i % 2 else i}", i % 3 if i % 5 else None) for i in range(200)]
    requests = spark.createDataFrame(rows, "seq bigint, idempotency_key string, a bigint")
    firsts = {}
    for i, k, a in rows:
        firsts.setdefault(k, (i, a))
    kinds = classify_requests(requests, ["a"], rows_per_split)
    got = {r.seq: r.kind for r in kinds.collect()}
    assert got.keys() == {i for i, k, _ in rows if k}
    assert all(got[i] == ("FIRST" if firsts[k][0] == i else got[i]) and (a is None or firsts[k][1] is None or got[i] == "FIRST" or got[i] == ("REPLAY" if firsts[k][1] == a else "CONFLICT")) for i, k, a in rows if k)
    if rows_per_split > 200:
        classify_requests(requests, ["a"], rows_per_split).explain()
        assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1
    counted = with_key_values(requests, "idempotency_key", {"n": F.count(F.lit(1))}, rows_per_split=rows_per_split)
    assert counted.filter("idempotency_key = 'k3'").first().n == sum(k == "k3" for _, k, _ in rows) and counted.count() == 200
