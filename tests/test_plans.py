"""Plans: what reaches the scan, what is not shuffled, what is not sorted in one task."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import filters, joins, paging, windows
from ledgerspark.operators import rules as R
from ledgerspark.plans.fixtures import Views
from ledgerspark.session import scratch_path


@pytest.fixture(scope="module")
def v(spark, small):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return Views(spark, small)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_is_pushed_down_and_pruned(v):
    text = plan(filters.history(v.payments, "account_id", 42, dt.datetime(1996, 1, 1), 50).select("id", "amount_minor"))
    assert "EqualTo(o_custkey,42)" in text and "GreaterThanOrEqual(o_orderdate" in text
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert "o_orderpriority" not in text


def test_keyset_cursor_is_pushed_down(spark, v):
    path = scratch_path(spark, "ledger")
    v.ledger_entries.write.parquet(path)
    entries = spark.read.parquet(path)
    text = plan(paging.keyset_page_tuple(entries, 7, (dt.datetime(1999, 1, 1), 5), 10))
    assert "LessThanOrEqual(created_at" in text and "EqualTo(account_id,7)" in text


def test_latest_per_group_does_not_sort_groups(v):
    text = plan(windows.latest_per_group(v.payments, "account_id", ["created_at", "id"]))
    assert "Window" not in text and text.count("Exchange") == 1


def test_anti_joins(v):
    assert "LeftAnti" in plan(R.unposted_payments(v.payments, v.ledger_entries))


def test_reconciliation_aggregates_before_it_joins(v):
    text = plan(joins.with_ledger_balance(v.accounts_base, v.ledger_entries))
    assert "partial_sum" in text and "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["cross_join_scalar", "range_overlap_join", "write_skew_pairs", "cross_generate"])
def test_no_cross_joins(spark, small, name):
    import __spark_entry__

    text = plan(__spark_entry__.queries()[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_narrow_copy_reads_no_other_column(spark, v):
    text = plan(v.payments.agg(F.sum("amount_minor")))
    assert "ReadSchema: struct<o_totalprice:double>" in text


def test_normalised_key_is_pushed_down(spark, v):
    from ledgerspark.operators.layout import layout_normalized_key

    keyed = layout_normalized_key(v.users, "email", "email_key", scratch_path(spark, "keyed"), 2)
    assert "EqualTo(email_key,user-42@example.test)" in plan(keyed.filter(F.col("email_key") == "user-42@example.test"))
    assert "EqualTo" not in plan(filters.filter_case_insensitive(v.users, "email", "x"))


def test_bucketed_grouping_has_no_shuffle(spark, v):
    from ledgerspark.operators.layout import layout_bucketed

    path = scratch_path(spark, "bucketed")
    bucketed = layout_bucketed(v.payments, "bucketed_plan_test", "account_id", 4, path)
    assert "Exchange" not in plan(bucketed.groupBy("account_id").count())


def test_arguments_are_checked(v):
    with pytest.raises(ValueError):
        filters.history(v.payments, "account_id", 1, dt.datetime(1996, 1, 1), 101)
    with pytest.raises(ValueError):
        paging.keyset_page_id(v.ledger_entries, 1, 0, 10)
    with pytest.raises(ValueError):
        paging.all_pages(v.ledger_entries, 0)


def test_pages_do_not_overlap(v):
    first = [r.id for r in paging.keyset_page_id(v.ledger_entries, 7, None, 3).collect()]
    second = [r.id for r in paging.keyset_page_id(v.ledger_entries, 7, first[-1], 3).collect()]
    assert first + second == sorted(set(first + second), reverse=True)
