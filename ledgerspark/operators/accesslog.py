"""Concurrency anomalies found in a log of transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.joins import overlap_join
from ledgerspark.operators.scans import ROWS_PER_SPLIT, Running, ordered_scan


def lost_update_scan(writes: DataFrame, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Writes (tx, row_id, committed_at, read_version, written_version) computed from a version that another
    transaction had already replaced, with the version they overwrote unseen."""
    scanned = ordered_scan(
        writes, ["row_id"], ["committed_at", "tx"], previous={"current_version": "written_version"},
        rows_per_split=rows_per_split,
    )
    return scanned.filter(F.col("current_version") != F.col("read_version"))


def write_skew_pairs(log: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """Pairs of overlapping transactions that each read a row the other one wrote, with no row written by both.

    ``log`` is (tx, started_at, committed_at, reads, writes) with arrays of row keys. All accesses meet the writes of the
    same row once, in time buckets; a pair is a finding when the dependency goes both ways and no meeting is of two writes.
    """
    span = ["tx", "started_at", "committed_at"]
    none = F.array().cast(log.schema["writes"].dataType)
    read, written = F.coalesce("reads", none), F.coalesce("writes", none)
    access = log.select(*span, read.alias("reads"), written.alias("writes"), F.explode(F.array_union(read, written)).alias("row_key")).select(
        *span, "row_key", F.array_contains("reads", F.col("row_key")).alias("is_read"), F.array_contains("writes", F.col("row_key")).alias("is_write"))
    met = overlap_join(access, access.filter("is_write").drop("is_read"), ["row_key"], "started_at", "committed_at", bucket_seconds)
    one, other = F.col("l.tx"), F.col("r.tx")
    pairs = met.filter(one != other).groupBy(F.least(one, other).alias("first_tx"), F.greatest(one, other).alias("second_tx")).agg(
        F.bool_or(F.col("l.is_read") & (one < other)).alias("_forward"), F.bool_or(F.col("l.is_read") & (one > other)).alias("_back"),
        F.bool_or("l.is_write").alias("_conflict"))
    return pairs.filter("_forward AND _back AND NOT _conflict").select("first_tx", "second_tx")


def serialization_edges(log: DataFrame, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Dependencies (from_tx, to_tx, kind, row_key) that a serial order of the transactions has to respect.

    ``log`` is (tx, started_at, committed_at, reads, writes) with arrays of row keys; a transaction reads what was committed up to
    its start. Only neighbouring versions are linked: ``ww`` from the writer of a version to that of the next one, ``wr`` from the
    writer of a version to its readers, ``rw`` from the readers of a version to the writer of the next one. So there are at
    most two edges for each access, however popular a row is. Equal commit times of a row are ordered by ``tx``. Transactions
    without ``committed_at`` and null row keys take no part; a row that is named twice by a transaction is one access.
    """
    scanned = _accesses(log, rows_per_split)
    is_write, before, after = F.col("_kind") == 0, F.col("_earlier.tx"), F.col("_later.tx")
    edges = F.array(
        F.struct(before.alias("from_tx"), F.col("tx").alias("to_tx"), F.when(is_write, "ww").otherwise("wr").alias("kind")),
        F.struct(F.col("tx").alias("from_tx"), F.when(~is_write, after).alias("to_tx"), F.lit("rw").alias("kind")),
    )
    rows = scanned.select("row_key", F.explode(edges).alias("e")).select("e.from_tx", "e.to_tx", "e.kind", "row_key")
    return rows.filter(F.col("from_tx") != F.col("to_tx"))  # of two ends, none is missing and none is the other


def dangerous_structures(log: DataFrame, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Pivots (tx, readers_of, overwritten_by): transactions that can make a snapshot history not serialisable.

    A pivot read a version that an overlapping transaction replaced, and replaced one that an overlapping transaction had read; the
    one that replaced its version committed before the pivot and no later than such a reader. Every cycle of dependencies under
    snapshot isolation goes through a pivot, however many transactions it has. ``readers_of`` and ``overwritten_by`` count the
    dependencies in and out, by row. Both sides are aggregates per transaction: nobody is paired with anybody.
    """
    scanned = _accesses(log, rows_per_split).filter((F.col("_kind") == 1) & F.col("_later.tx").isNotNull())
    over = scanned.filter((F.col("_later.tx") != F.col("tx")) & (F.col("_later.started_at") < F.col("committed_at")))
    # each edge is looked at from both ends: out of the reader, into the writer
    ends = F.array(
        F.struct(F.col("tx").alias("tx"), F.col("committed_at").alias("own"), F.col("_later.committed_at").alias("out_at"), F.lit(None).cast(over.schema["committed_at"].dataType).alias("in_at")),
        F.struct(F.col("_later.tx").alias("tx"), F.col("_later.committed_at").alias("own"), F.lit(None).cast(over.schema["committed_at"].dataType).alias("out_at"), F.col("committed_at").alias("in_at")),
    )
    sides = over.select(F.explode(ends).alias("e")).select("e.*").groupBy("tx").agg(
        F.max("own").alias("own"), F.min("out_at").alias("first_out"), F.max("in_at").alias("last_in"),
        F.count("in_at").alias("readers_of"), F.count("out_at").alias("overwritten_by"))
    return sides.filter("first_out < own AND first_out <= last_in").select("tx", "readers_of", "overwritten_by")


def _accesses(log: DataFrame, rows_per_split: int) -> DataFrame:
    """Each read (``_kind`` 1, at the start) and write (0, at the commit) of a row with the last write before it and the first one
    after it. At the same time the write comes first: it is seen."""
    kept = log.filter(F.col("tx").isNotNull() & F.col("committed_at").isNotNull())
    key = log.schema["writes"].dataType.elementType
    none = F.array().cast(log.schema["writes"].dataType)
    both = F.concat(
        F.transform(F.array_distinct(F.coalesce("writes", none)), lambda k: F.struct(F.lit(0).alias("_kind"), k.cast(key).alias("row_key"), F.col("committed_at").alias("_at"))),
        F.transform(F.array_distinct(F.coalesce("reads", none)), lambda k: F.struct(F.lit(1).alias("_kind"), k.cast(key).alias("row_key"), F.col("started_at").alias("_at"))),
    )
    access = kept.select("tx", "started_at", "committed_at", F.explode(both).alias("a")).select("tx", "started_at", "committed_at", "a.*")
    access = access.filter("row_key IS NOT NULL AND _at IS NOT NULL")
    # times first, so that the greatest and the least struct are the last and the first write
    write = F.when(F.col("_kind") == 0, F.struct("committed_at", "tx", "started_at"))
    order = ["_at", "_kind", "tx"]
    seen = ordered_scan(access, ["row_key"], order, running={"_earlier": Running("max", write, inclusive=False)}, rows_per_split=rows_per_split)
    return ordered_scan(seen, ["row_key"], order, running={"_later": Running("min", write, inclusive=False)}, descending=True, rows_per_split=rows_per_split)
