"""Sorting, top-k and pages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.filters import check_limit
from ledgerspark.operators.scans import ROWS_PER_SPLIT, ordered_scan


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows; each task keeps only its own first ``k``."""
    return df.orderBy(*order).limit(k)


def keyset_page_id(entries: DataFrame, account, cursor: int | None, limit: int) -> DataFrame:
    """Entries of one account below the cursor, newest id first. The cursor is the last id of the page before."""
    check_limit(limit)
    if cursor is not None and cursor <= 0:
        raise ValueError("cursor must be positive")
    rows = entries.filter(F.col("account_id") == F.lit(account))
    if cursor is not None:
        rows = rows.filter(F.col("id") < cursor)
    return rows.orderBy(F.desc("id")).limit(limit)


def keyset_page_tuple(entries: DataFrame, account, after: tuple[dt.datetime, int], limit: int) -> DataFrame:
    """As ``keyset_page_id`` with the cursor (created_at, id), written so that the time bound reaches the scan."""
    check_limit(limit)
    at, last = F.lit(after[0]).cast("timestamp_ntz"), after[1]
    earlier = (F.col("created_at") <= at) & ((F.col("created_at") < at) | (F.col("id") < last))
    rows = entries.filter((F.col("account_id") == F.lit(account)) & earlier)
    return rows.orderBy(F.desc("created_at"), F.desc("id")).limit(limit)


def offset_page(df: DataFrame, order: list[Column], offset: int, limit: int) -> DataFrame:
    check_limit(limit)
    return df.orderBy(*order).offset(offset).limit(limit)


def all_pages(entries: DataFrame, limit: int, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Every page of every account in one pass: 0-based page number and position, newest id first."""
    check_limit(limit)
    numbered = ordered_scan(
        entries, ["account_id"], ["id"], number="_n", descending=True, rows_per_split=rows_per_split
    )
    at = F.col("_n") - 1
    return numbered.withColumn("page", F.floor(at / limit)).withColumn("position", at % limit).drop("_n")
