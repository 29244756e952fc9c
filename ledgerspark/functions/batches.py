"""Small helpers for passes over sorted Arrow batches."""

from __future__ import annotations

import pyarrow as pa


def lists(batch: pa.RecordBatch, *names: str) -> list[list]:
    """Columns as Python lists; by way of numpy where there are no NULLs, which is much faster."""
    columns = [batch.column(name) for name in names]
    return [c.to_pylist() if c.null_count else c.to_numpy(zero_copy_only=False).tolist() for c in columns]


def extended(batch: pa.RecordBatch, keep: list[str], **new: pa.Array) -> pa.RecordBatch:
    """The kept columns as they are, then the new ones."""
    return pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], *new.values()], names=[*keep, *new])
