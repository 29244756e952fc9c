"""Projections, lookups and filters. Plain predicates on stored columns reach the parquet scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.scalars import has_word, is_currency, is_safe_id, json_contains, normalized_email

MAX_PAGE = 100


def check_limit(limit: int) -> None:
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be between 1 and {MAX_PAGE}")


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def lookup_by_subquery(df: DataFrame, key: str, one_value: DataFrame) -> DataFrame:
    """Rows whose key equals the value of a one-row, one-column query."""
    return df.filter(F.col(key) == one_value.scalar())


def history(df: DataFrame, owner: str, value, since: dt.datetime, limit: int) -> DataFrame:
    """Newest rows of one owner at or after ``since``."""
    check_limit(limit)
    rows = df.filter((F.col(owner) == F.lit(value)) & (F.col("created_at") >= F.lit(since).cast("timestamp_ntz")))
    return rows.orderBy(F.desc("created_at"), F.desc("id")).limit(limit)


def history_between(df: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Half-open range: ``start`` is in, ``end`` is out."""
    at = F.col("created_at")
    return df.filter((at >= F.lit(start).cast("timestamp_ntz")) & (at < F.lit(end).cast("timestamp_ntz")))


def pending_before(df: DataFrame, before: dt.datetime, limit: int) -> DataFrame:
    """Oldest PENDING rows strictly older than ``before``."""
    check_limit(limit)
    rows = df.filter((F.col("status") == "PENDING") & (F.col("created_at") < F.lit(before).cast("timestamp_ntz")))
    return rows.orderBy("created_at", "id").limit(limit)


def filter_null(df: DataFrame, column: str, keep_null: bool = True) -> DataFrame:
    return df.filter(F.col(column).isNull() if keep_null else F.col(column).isNotNull())


def filter_null_safe(df: DataFrame, column: str, value) -> DataFrame:
    """IS DISTINCT FROM: NULL counts as different from any value."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def filter_in_list(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(F.col(column).isin(values))


def filter_in_subquery(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose value occurs in the first column of ``keys``."""
    right = keys.select(F.col(keys.columns[0]).alias("_key"))
    return df.join(right, F.col(column) == F.col("_key"), "left_semi")


def filter_regex(df: DataFrame, currency: str, identifier: str) -> DataFrame:
    return df.filter(is_currency(currency) & is_safe_id(identifier))


def filter_ilike(df: DataFrame, column: str, like: str, unlike: str | None = None) -> DataFrame:
    rows = df.filter(F.col(column).ilike(like))
    return rows.filter(~F.col(column).ilike(unlike)) if unlike else rows


def filter_case_insensitive(df: DataFrame, column: str, value: str) -> DataFrame:
    """Compares the lower-case column; tables read this way often keep a normalised copy (``layout_normalized_key``)."""
    return df.filter(F.lower(column) == value.lower())


def filter_json(df: DataFrame, column: str, pattern: dict) -> DataFrame:
    return df.filter(json_contains(column, pattern))


def json_extract(df: DataFrame, column: str, fields: list[str]) -> DataFrame:
    """Members of a JSON object as text columns, parsed once."""
    return df.select("*", F.json_tuple(column, *fields).alias(*fields))


def json_build(df: DataFrame, name: str, **members: Column) -> DataFrame:
    document = F.to_json(F.struct(*[c.alias(n) for n, c in members.items()]))
    return df.withColumn(name, document)


def text_search(df: DataFrame, text: str, words: list[str]) -> DataFrame:
    """Rows whose text holds every word, read over the whole text, without a shuffle."""
    condition = F.lit(True)
    for word in words:
        condition = condition & has_word(text, word)
    return df.filter(condition)


def projection(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under new names; the scan reads no others."""
    return df.select(*[F.col(source).alias(name) for name, source in columns.items()])


def case_label(df: DataFrame, name: str, cases: list[tuple[Column, str]], default: str) -> DataFrame:
    label = F.lit(default)
    for condition, value in reversed(cases):
        label = F.when(condition, value).otherwise(label)
    return df.withColumn(name, label)


def owned_rows(requests: DataFrame, accounts: DataFrame) -> DataFrame:
    """Outcome of reading one account per request as ``principal``: NOT_FOUND, NOT_OWNER or VISIBLE."""
    known = accounts.select(F.col("id").alias("_id"), "owner_id", "balance_minor")
    joined = requests.join(known, F.col("account_id") == F.col("_id"), "left")
    visible = F.col("owner_id") == F.col("principal")
    return joined.select(
        *requests.columns,
        F.when(F.col("_id").isNull(), "NOT_FOUND").when(visible, "VISIBLE").otherwise("NOT_OWNER").alias("outcome"),
        F.when(visible, F.col("balance_minor")).alias("balance_minor"),
    )


def emails_equal(left: str | Column, right: str | Column) -> Column:
    return normalized_email(left) == normalized_email(right)
