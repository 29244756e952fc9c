"""Expand, backfill, contract."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.operators.scans import Running, ordered_scan
from ledgerspark.session import materialize
from ledgerspark.sources.store import ConcurrentPublish, VersionedStore


def add_column_default(spark: SparkSession, paths: list[str], schema: T.StructType, name: str, kind: T.DataType, default: str | None) -> DataFrame:
    """Table read with one more column. Files written before it existed are not rewritten: the reader fills in
    the default (an SQL literal), files that have the column give their own values."""
    known = {} if default is None else {"CURRENT_DEFAULT": default, "EXISTS_DEFAULT": default}
    wider = T.StructType([*schema.fields, T.StructField(name, kind, True, known)])
    return spark.read.schema(wider).parquet(*paths)


def backfill_plan(df: DataFrame, pending: Column, batch_rows: int, directory: Column | None = None) -> DataFrame:
    """(file, directory, rows, pending, batch) of the files that ``df`` reads, in the order of their names, but for those of
    directories (an expression of ``file``) without a pending row. A batch is closed as soon as it has ``batch_rows`` rows, so it
    holds less than that and one file more. Reads the columns of ``pending`` only."""
    counts = df.select(F.col("_metadata.file_path").alias("file"), pending.alias("_p")).groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("_p").alias("pending"))
    files = materialize(counts.select("file", (F.lit("") if directory is None else directory).alias("directory"), "rows", "pending"), "files")
    concerned = files.groupBy(F.col("directory").alias("_d")).agg(F.sum("pending").alias("_n")).filter("_n > 0")
    todo = files.join(concerned, F.col("directory") == F.col("_d"), "left_semi")
    ahead = ordered_scan(todo, [], ["file"], running={"_ahead": Running("sum", "rows", inclusive=False)})
    return ahead.select("file", "directory", "rows", "pending", F.floor(F.coalesce("_ahead", F.lit(0)) / batch_rows).alias("batch"))


def backfill_batches(
    store: VersionedStore,
    table: str,
    pending: Column,
    values: dict[str, Column],
    batch_rows: int,
    on_batch: Callable[[int], None] | None = None,
) -> int:
    """Fill columns of the pending rows in batches of bounded size, and publish the table when none is left.

    A batch is a group of the table's files, so that every file is read once over all batches, written without a shuffle, and keeps
    its order; no key is needed. A finished batch is a directory with a note in the store, which names the last one only: a job that
    was stopped goes on after it, and writes a batch that it had begun anew. A finished job finds nothing to do. Directories
    of the table without a pending row are kept as they are. Returns the number of batches run by this call.
    """
    note = f"backfill:{table}"
    manifest = store.manifest()
    source = manifest.tables[table]
    progress = json.loads(manifest.notes.get(note, "null"))
    if progress is None or progress["source"] != source["paths"]:
        progress = _begin_backfill(store, table, source, pending, batch_rows)
        if progress is None:
            return 0
        store.publish(notes={note: json.dumps(progress)})
    plan, ran = _stored_plan(store, progress["plan"]), 0
    while (batch := plan.filter(F.col("batch") > progress["last"]).agg(F.min("batch")).first()[0]) is not None:
        files = [r.file for r in plan.filter(F.col("batch") == batch).select("file").collect()]
        part = store.spark.read.schema(source["schema"]).parquet(*files)
        filled = part.select(*[F.when(pending, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in part.columns])
        filled.write.mode("overwrite").parquet(f"{store.root}/{progress['target']}/{batch}")
        progress["last"] = batch
        store.publish(notes={note: json.dumps(progress)})
        ran += 1
        if on_batch:
            on_batch(ran - 1)
    base = store.manifest()
    if base.tables[table]["paths"] != progress["source"]:
        raise ConcurrentPublish(f"{table} has changed since the backfill began; run it again on the new version")
    store.attach(table, source["schema"], [*progress["kept"], f"{progress['target']}/*"], base)
    return ran


def _begin_backfill(store: VersionedStore, table: str, source: dict, pending: Column, batch_rows: int) -> dict | None:
    """Write the plan of a table's backfill and return its first note, None if no row is pending."""
    below = F.split_part(F.col("file"), F.lit(f"/{store.root.rsplit('/', 1)[-1]}/{table}/"), F.lit(2))
    run = uuid.uuid4().hex
    path = f"_plans/{table}-{run}"
    backfill_plan(store.read(table), pending, batch_rows, F.split_part(below, F.lit("/"), F.lit(1))).write.parquet(f"{store.root}/{path}")
    # one name for each directory of the manifest at most
    concerned = {r.directory for r in _stored_plan(store, path).select("directory").distinct().collect()}
    if not concerned:
        return None
    kept = [p for p in source["paths"] if p.split("/")[1] not in concerned]
    return {"source": source["paths"], "kept": kept, "plan": path, "target": f"{table}/filled-{run}", "last": -1}


def _stored_plan(store: VersionedStore, path: str) -> DataFrame:
    return store.spark.read.schema("file STRING, directory STRING, rows BIGINT, pending BIGINT, batch BIGINT").parquet(f"{store.root}/{path}")


def validate_then_require(df: DataFrame, column: str, is_new: Column, rule: Column | None = None) -> DataFrame:
    """The steps to a required column as rows (step, violations, allowed).

    NOT VALID only looks at new rows, VALIDATE at all, and the column can be required when none is left.
    """
    holds = F.col(column).isNotNull() if rule is None else rule
    counts = df.agg(
        F.count_if(is_new & ~F.coalesce(holds, F.lit(False))).alias("new"),
        F.count_if(~F.coalesce(holds, F.lit(False))).alias("every"),
    )
    steps = [("1 check new rows", "new"), ("2 validate all rows", "every"), ("3 require", "every")]
    rows = F.array(*[F.struct(F.lit(s).alias("step"), F.col(c).alias("violations")) for s, c in steps])
    return counts.select(F.explode(rows).alias("r")).select("r.*", (F.col("r.violations") == 0).alias("allowed"))


def require_column(df: DataFrame, column: str) -> DataFrame:
    """The table with a required column: refused while a stored row has no value, and a job that meets such a row
    later stops."""
    if df.filter(F.col(column).isNull()).limit(1).count():
        raise ValueError(f"{column} has rows without a value")
    stop = F.raise_error(F.lit(f"{column} is required")).cast(df.schema[column].dataType)
    return df.withColumn(column, F.coalesce(F.col(column), stop))


# fixed values: whether a change of type reads or rewrites the stored rows
CHANGES = {"widen text": (False, False), "narrow text": (True, True), "other type": (True, True)}


def change_type(df: DataFrame, column: str, to: str, max_length: int | None = None) -> DataFrame:
    """The table with a column of another type, or of another length for text: a value that the new type cannot hold exactly
    (3.7 as int, a time of day as date, a long with more digits than a double) stops the job; no value is rounded.

    Widening text never stops. ``change_violations`` lists the rows in the way, ``change_split`` parts them from the others.
    """
    kind = "string" if max_length is not None else to
    stop = F.raise_error(F.concat(F.lit(f"{column} does not fit: "), F.col(column).cast("string"))).cast(kind)
    changed = F.when(_lost(df, column, to, max_length), stop).otherwise(F.col(column).try_cast(kind))
    return df.withColumn(column, changed)


def change_violations(df: DataFrame, column: str, to: str, max_length: int | None = None) -> DataFrame:
    """Rows whose value does not survive the change: lost or altered by the cast, or longer than ``max_length``."""
    return df.filter(_lost(df, column, to, max_length))


def change_split(df: DataFrame, column: str, to: str, max_length: int | None = None) -> DataFrame:
    """All rows with ``fits``, and in ``changed`` the new value of those that fit (NULL for the others, whose old value stays)."""
    lost = _lost(df, column, to, max_length)
    return df.withColumn("fits", ~lost).withColumn("changed", F.when(~lost, F.col(column).try_cast("string" if max_length is not None else to)))


def _lost(df: DataFrame, column: str, to: str, max_length: int | None) -> Column:
    """A value is lost where the new type cannot hold it exactly: a fraction, a digit, a time of day or the range. Nothing is rounded.
    Texts are judged by what they say, not by how it is written: 05 is 5."""
    value, old = F.col(column), df.schema[column].dataType.simpleString()
    new = value.try_cast(to)
    lost = value.isNotNull() & new.isNull()
    if old == "string" and to in ("float", "double"):
        exact = "decimal(38,18)"
        lost = lost | F.coalesce(value.try_cast(exact) != new.try_cast(exact), F.lit(False))
    elif old == "string" and to == "date":
        lost = lost | F.coalesce(value.try_cast("timestamp_ntz") != new.try_cast("timestamp_ntz"), F.lit(False))
    elif old != "string" and to != old:
        lost = lost | ~new.try_cast(old).eqNullSafe(value)
    if max_length is not None:
        lost = lost | F.coalesce(F.length(value) > max_length, F.lit(False))
    return lost


def change_plan(steps: list[tuple[str, str, str]]) -> list[dict]:
    """For each (column, old type, new type): whether stored rows must be read and rewritten."""

    def length(kind: str) -> int | None:
        return int(kind[kind.index("(") + 1 : -1]) if kind.startswith("varchar") else None

    plan = []
    for column, old, new in steps:
        text = all(k == "string" or k.startswith("varchar") for k in (old, new))
        if not text:
            reads, rewrites = (False, False) if old == new else CHANGES["other type"]
        elif length(new) is None or (length(old) is not None and length(old) <= length(new)):
            reads, rewrites = CHANGES["widen text"]
        else:
            reads, rewrites = CHANGES["narrow text"]
        plan.append({"column": column, "from": old, "to": new, "reads_rows": reads, "rewrites_files": rewrites})
    return plan
