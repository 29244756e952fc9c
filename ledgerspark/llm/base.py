"""What several operators of this subpackage share: the held-out rule, Arrow output, whole-text pieces, scratch tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.session import discard, materialize, scratch_path  # noqa: F401


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; the path is only ever read by Spark."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Bytes of an Arrow batch on its way to a Python worker, and rows that the Parquet reader holds at once.
BATCH_BYTES, READER_ROWS = 4 << 20, 512


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's limits for Arrow batches and the Parquet reader lowered to ``BATCH_BYTES`` and
    ``READER_ROWS``: long texts are held several times, by the reader, in Arrow and in Python, by every task of an executor.
    (A row above the limit is a batch of its own.)"""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.parquet.columnarReaderBatchSize", READER_ROWS)):
        if not 0 < int(re.sub(r"\D", "", conf.get(key)) or 0) <= most:
            conf.set(key, str(most))
    return df


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows that no classifier may learn from: crc32 of the id as text, modulo 4, is 2 (null ids: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def unused(names: Iterable[str], wanted: str) -> str:
    """``wanted``, or a longer name where the table already has such a column."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def batches(rows: Iterable[tuple], schema: pa.Schema, at_once: int = 2048, bytes_at_once: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches that are bounded by rows and by the bytes of their texts."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (str, bytes, list)))
        if len(held) >= at_once or size >= bytes_at_once:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[str]:
    """The texts of a batch one by one, null as the empty text; no list of all of them is made."""
    for value in batch.column(name):
        yield value.as_py() or ""


def pieces(text: str, limit: int, is_border) -> Iterator[str]:
    """A text in pieces of about ``limit`` characters or more, cut only where ``is_border(text, i)`` allows a cut before i.

    A text without such a place stays whole: callers choose borders for which the pieces' results add up to the text's.
    """
    start, n = 0, len(text)
    while n - start > limit:
        cut = start + limit
        while cut < n and not is_border(text, cut):
            cut += 1
        if cut >= n:
            break
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text
