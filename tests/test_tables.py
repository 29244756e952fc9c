"""Stored tables, write jobs and migrations."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.operators import dml, layout, migrate, rules
from ledgerspark.session import scratch_path
from ledgerspark.sources import seed
from ledgerspark.sources.store import ConcurrentPublish, VersionedStore, create_table_as


@pytest.fixture
def store(spark):
    return VersionedStore(spark, scratch_path(spark, "store"))


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_tables_change_together(spark, store):
    store.publish(replace={"a": spark.range(3), "b": spark.range(5)})
    store.publish(replace={"a": spark.range(1)}, append={"b": spark.range(5, 6)})
    assert (store.read("a").count(), store.read("b").count()) == (1, 6)
    assert (store.read("a", 1).count(), store.read("b", 1).count()) == (3, 5)


def test_a_failed_job_leaves_nothing_visible(spark, store):
    store.publish(replace={"a": spark.range(3)})
    bad = spark.range(3).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stop"):
        store.publish(replace={"a": spark.range(1), "b": bad})
    assert store.versions() == [1] and store.read("a").count() == 3


def test_second_publish_of_a_version_is_refused(spark, store):
    base = store.manifest()
    store.publish(replace={"a": spark.range(3)}, base=base)
    with pytest.raises(ConcurrentPublish):
        store.publish(replace={"a": spark.range(1)}, base=base)
    assert store.read("a").count() == 3


def test_create_refuses_an_existing_table(spark, store):
    create_table_as(store, "a", spark.range(1))
    with pytest.raises(ValueError):
        create_table_as(store, "a", spark.range(1))


def test_append_with_other_columns_is_refused(spark, store):
    store.publish(replace={"a": spark.range(1)})
    with pytest.raises(ValueError):
        store.publish(append={"a": spark.range(1).withColumnRenamed("id", "x")})


def test_backfill_goes_on_after_a_stop(spark, store):
    table = spark.range(0, 100, 1, 8).select("id", F.lit(None).cast("string").alias("ref"), (F.col("id") % 4).alias("kind"))
    store.publish(replace={"t": table})
    pending = F.col("ref").isNull() & (F.col("kind") != 0)
    values = {"ref": F.concat(F.lit("legacy-"), "id")}
    seen = []

    def stop_after_two(i):
        seen.append(i)
        if len(seen) == 2:
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        migrate.backfill_batches(store, "t", pending, values, 10, stop_after_two)
    assert store.read("t").filter("ref IS NOT NULL").count() == 0  # not visible before the end
    # what a batch had written before it was stopped is written anew
    target = json.loads(store.manifest().notes["backfill:t"])["target"]
    spark.range(5).selectExpr("id", "'half' AS ref", "id AS kind").write.parquet(f"{store.root}/{target}/2")
    assert migrate.backfill_batches(store, "t", pending, values, 10) == 6
    done = store.read("t")
    assert done.count() == 100 and done.filter(pending).count() == 0
    assert done.filter("kind = 0 AND ref IS NOT NULL").count() == 0
    assert done.filter("ref <> concat('legacy-', id)").count() == 0
    assert migrate.backfill_batches(store, "t", pending, values, 10) == 0


def test_backfill_does_not_overwrite_later_rows(spark, store):
    store.publish(replace={"t": spark.range(0, 20, 1, 2).select("id", F.lit(None).cast("string").alias("ref"))})
    values, pending = {"ref": F.lit("x")}, F.col("ref").isNull()

    def new_row(i):
        if i == 0:
            store.publish(append={"t": spark.range(20, 21, 1, 1).select("id", F.lit(None).cast("string").alias("ref"))})

    with pytest.raises(ConcurrentPublish):
        migrate.backfill_batches(store, "t", pending, values, 10, new_row)
    assert migrate.backfill_batches(store, "t", pending, values, 10) == 3
    assert store.read("t").count() == 21 and store.read("t").filter(pending).count() == 0


def test_backfill_batches_are_bounded(spark):
    path = scratch_path(spark, "files")
    spark.range(0, 100, 1, 10).write.parquet(path)
    plan = migrate.backfill_plan(spark.read.parquet(path), F.col("id") % 2 == 0, 25)
    sizes = {r.batch: (r.rows, r.pending) for r in plan.groupBy("batch").agg(F.sum("rows").alias("rows"), F.sum("pending").alias("pending")).collect()}
    assert sizes == {0: (30, 15), 1: (20, 10), 2: (30, 15), 3: (20, 10)}
    assert all(rows < 25 + 10 for rows, _ in sizes.values())


def test_backfill_reads_each_file_once_without_a_shuffle(spark, store, monkeypatch):
    """The batches read disjoint files, all of them together the table; directories that need nothing stay."""
    kinds = "id bigint, ref string"
    store.publish(replace={"t": spark.range(0, 40, 1, 4).selectExpr("id", "CAST(NULL AS STRING) AS ref")})
    store.publish(append={"t": spark.createDataFrame([(100, "there")], kinds)})
    full = store.manifest().tables["t"]["paths"][1]
    read, plans = [], []
    plain = type(spark.read).parquet

    def watched(self, *paths, **options):
        if all(p.endswith(".parquet") for p in paths):
            read.extend(paths)
            got = plain(self, *paths, **options)
            plans.append(got._jdf.queryExecution().toString())
            return got
        return plain(self, *paths, **options)

    monkeypatch.setattr(type(spark.read), "parquet", watched)
    assert migrate.backfill_batches(store, "t", F.col("ref").isNull(), {"ref": F.lit("x")}, 10) == 4
    assert len(read) == len(set(read)) == 4 and not any("Exchange" in p for p in plans)
    assert full in store.manifest().tables["t"]["paths"]
    assert {r.ref: r["count"] for r in store.read("t").groupBy("ref").count().collect()} == {"x": 40, "there": 1}
    assert migrate.backfill_batches(store, "t", F.col("id") > 1000, {"ref": F.lit("y")}, 10) == 0  # nothing pending
    monkeypatch.undo()
    store.publish(notes={"backfill:t": "null"})  # a second backfill, of the directories that the first one wrote
    assert migrate.backfill_batches(store, "t", F.col("id") == 5, {"ref": F.lit("z")}, 1000) == 1
    assert {r.ref: r["count"] for r in store.read("t").groupBy("ref").count().collect()} == {"x": 39, "z": 1, "there": 1}


def test_required_column(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id bigint, ref string")
    with pytest.raises(ValueError):
        migrate.require_column(df, "ref")
    path = scratch_path(spark, "refs")
    df.filter("ref IS NOT NULL").write.parquet(path)
    ready = migrate.require_column(spark.read.schema(df.schema).parquet(path), "ref")
    assert [r.ref for r in ready.collect()] == ["a"]
    df.filter("ref IS NULL").write.mode("append").parquet(path)
    later = spark.read.schema(df.schema).parquet(path)
    with pytest.raises(ValueError):
        migrate.require_column(later, "ref")


def test_new_column_has_its_default_in_old_files(spark):
    path = scratch_path(spark, "old")
    spark.range(3).write.parquet(path)
    schema = T.StructType([T.StructField("id", T.LongType())])
    for default, want in (("'EUR'", "EUR"), (None, None)):
        got = migrate.add_column_default(spark, [path], schema, "currency", T.StringType(), default)
        assert {r.currency for r in got.collect()} == {want}


def test_change_plan():
    steps = [("status", "string", "varchar(32)"), ("status", "varchar(32)", "varchar(64)"), ("amount", "bigint", "decimal(20,0)")]
    assert [p["rewrites_files"] for p in migrate.change_plan(steps)] == [True, False, True]


def test_a_value_that_does_not_fit_stops_the_change(spark):
    df = spark.createDataFrame([(1, 5, "a"), (2, 3_000_000_000, "b" * 40), (3, None, None)], "id bigint, n bigint, t string")
    for column, to, length in (("n", "int", None), ("t", "string", 32)):
        with pytest.raises(Exception, match="does not fit"):
            migrate.change_type(df, column, to, length).collect()
        kept = migrate.change_type(df.filter("id <> 2"), column, to, length)
        assert kept.count() == 2
    assert migrate.change_type(df, "n", "int").schema["n"].dataType.simpleString() == "int"
    assert [(r.id, r.fits, r.changed) for r in migrate.change_split(df, "n", "int").orderBy("id").collect()] == [(1, True, 5), (2, False, None), (3, True, None)]


def test_a_change_of_type_loses_nothing(spark):
    """Values that the new type could only hold rounded or cut off are in the way."""
    cases = [
        ("double", "int", [(3.0, True), (3.7, False), (float("nan"), False), (1e12, False)]),
        ("bigint", "double", [(2**53, True), (2**53 + 1, False)]),
        ("decimal(10,4)", "decimal(10,2)", [(Decimal("1.25"), True), (Decimal("1.255"), False)]),
        ("timestamp_ntz", "date", [(dt.datetime(2024, 1, 1), True), (dt.datetime(2024, 1, 1, 10), False)]),
        ("bigint", "boolean", [(1, True), (5, False)]),
        ("string", "int", [("5", True), ("05", True), ("3.7", False), ("x", False)]),
        ("string", "double", [("0.1", True), ("1e300", True), ("9007199254740993", False)]),
        ("string", "date", [("2024-01-01", True), ("2024-01-01 10:00:00", False)]),
    ]
    for old, new, values in cases:
        rows = [(k, value) for k, (value, _) in enumerate(values)] + [(99, None)]
        df = spark.createDataFrame(rows, f"id bigint, v {old}")
        wrong = [k for k, (_, fits) in enumerate(values) if not fits]
        assert ids(migrate.change_violations(df, "v", new).select("id")) == wrong, (old, new)
        split = {r.id: (r.fits, r.changed is None) for r in migrate.change_split(df, "v", new).collect()}
        assert split == {k: (fits, not fits) for k, (_, fits) in enumerate(values)} | {99: (True, True)}
        with pytest.raises(Exception, match="does not fit"):
            migrate.change_type(df, "v", new).collect()


def test_narrowing_finds_values_that_do_not_fit(spark):
    df = spark.createDataFrame([(1, "PENDING"), (2, "A" * 40)], "id bigint, status string")
    assert ids(migrate.change_violations(df, "status", "string", 32).select("id")) == [2]


def test_upsert_takes_the_last_row(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, None, 1)], "id bigint, v string, seq bigint")
    got = dml.upsert(old, new, ["id"], "seq")
    assert sorted((r.id, r.v) for r in got.collect()) == [(1, "a"), (2, "d"), (3, None)]


def test_insert_ignore_first_wins(spark):
    old = spark.createDataFrame([("k1",)], "key string")
    new = spark.createDataFrame([("k1", 1), ("k2", 3), ("k2", 2)], "key string, seq bigint")
    assert [(r.key, r.seq) for r in dml.insert_ignore(old, new, "key", "seq").collect()] == [("k2", 2)]


def test_state_transition(spark):
    rows = spark.createDataFrame([(1, "PENDING"), (2, "FAILED"), (3, "COMPLETED")], "id bigint, status string")
    asked = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id bigint")
    table, outcome = dml.state_transition(rows, asked, "COMPLETED", ["PENDING"])
    assert [r.status for r in table.orderBy("id").collect()] == ["COMPLETED", "FAILED", "COMPLETED"]
    assert [r.outcome for r in outcome.orderBy("id").collect()] == ["APPLIED", "REJECTED", "APPLIED", "NOT_FOUND"]


def test_null_reference_passes_and_unknown_one_fails(spark):
    new = spark.createDataFrame([(1, 7), (2, None), (3, 8)], "id bigint, parent bigint")
    parents = spark.createDataFrame([(7,)], "id bigint")
    got = dml.insert_checked(new, {"id": F.col("id") > 0}, {"fk": ("parent", parents, "id")})
    assert {r.id: r.failed_rule for r in got.collect()} == {1: None, 2: None, 3: "fk"}


def test_unique_ignores_null(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k bigint")
    assert [(r.key0, r.copies) for r in rules.check_unique(df, [F.col("k")]).collect()] == [(1, 2)]


def test_seeds_repeat_and_are_spread_as_asked(spark):
    at = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    one = seed.generate_seed(spark.range(20_000), "id", at, ["COMPLETED"], "PENDING")
    again = seed.generate_seed(spark.range(20_000).repartition(7), "id", at, ["COMPLETED"], "PENDING")
    assert one.exceptAll(again).count() == 0
    share = one.filter("status = 'PENDING'").count() / 20_000
    assert 0.015 < share < 0.025
    picked = spark.range(20_000).select(seed.pick_rounded(["a", "b", "c"], "s", "id").alias("x")).groupBy("x").count()
    shares = {r.x: r["count"] / 20_000 for r in picked.collect()}
    assert abs(shares["b"] - 0.5) < 0.02 and abs(shares["a"] - 0.25) < 0.02


def test_sorted_layout_touches_fewer_files(spark, medium):
    payments = spark.read.parquet(f"{medium}/orders.parquet").select("o_custkey", "o_orderdate", "o_orderkey")
    touched = {}
    for name, order in {"key": ["o_custkey", "o_orderdate"], "time": ["o_orderdate", "o_custkey"]}.items():
        path = scratch_path(spark, "sorted")
        layout.layout_sorted(payments, order, path, 8)
        report = layout.zones_touched(spark.read.parquet(path), {"o_custkey": (F.lit(42), F.lit(42))}).first()
        assert report["zones"] == 8
        touched[name] = report["zones_touched"]
        blocks = layout.zones_touched(spark.read.parquet(path), {"o_custkey": (F.lit(42), F.lit(42))}, 100).first()
        assert blocks["zones"] >= 150 and blocks["rows_touched"] <= report["rows_touched"]
    assert touched["key"] <= 2 and touched["time"] == 8


def test_scratch_tables_can_be_removed(spark):
    from ledgerspark.session import discard, materialize

    one, two = materialize(spark.range(3)), materialize(spark.range(4))
    discard(one, None, spark.range(1))
    assert two.count() == 4
    with pytest.raises(Exception):
        spark.read.parquet(one.scratch_path).count()


def test_inverted_members_keep_their_kind_and_place(spark):
    documents = [
        (1, '{"a": "{\\"b\\":1}", "n": "1"}'), (2, '{"a": {"b": 1}, "n": 1}'), (3, '{"a": ["x"], "n": 1.0}'), (4, '{"a.b": 1, "a": "[\\"x\\"]"}'),
        (5, '{"a": [{"b": 1, "c": 2}, {"b": 3, "c": [4, 5]}], "t": true, "z": null}'), (6, "no json"), (7, None), (8, '[{"a": [[{"b": 1}]]}]'), (9, "{}"), (10, '{"t": "true", "z": NaN}')]
    df = spark.createDataFrame(documents, "id bigint, doc string")
    index = layout.layout_inverted(df, "id", "doc", scratch_path(spark, "inverted")).cache()

    def found(wanted):
        return ids(layout.inverted_lookup(index, "id", wanted))

    assert found({"a.b": 1}) == [2, 5, 8]
    assert found({layout.json_path("a.b"): 1}) == [4]
    assert found({"a": '{"b":1}'}) == [1] and found({"a": '["x"]'}) == [4] and found({"a": "x"}) == [3]
    assert found({"n": 1}) == [2, 3] and found({"n": "1"}) == [1]
    assert found({"t": True}) == [5] and found({"t": "true"}) == [] and found({"z": None}) == [5]
    assert found({"a.b": 1, "a.c": 4}) == [5] and found({"a": {"b": 1, "c": 4}}) == [] and found({"a": {"b": 3, "c": 4}}) == [5]
    assert [r["at"] for r in index.filter("id = 8").collect()] == [["0", "0.0", ""]]
    assert not index.filter("id IN (6, 7, 9, 10)").count()
    plan = layout.inverted_lookup(index.sparkSession.read.schema(index.schema).parquet(*index.inputFiles()), "id", {"n": 1})._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(path,n)" in plan and "EqualTo(kind,number)" in plan and "Scan parquet" in plan
