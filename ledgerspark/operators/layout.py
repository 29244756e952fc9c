"""Table layouts for fast range and key reads, and profiles of tables and files."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.scalars import normalized_email, percent_of
from ledgerspark.session import scratch_path


def layout_sorted(df: DataFrame, columns: list[str], path: str, files: int | None = None, row_group_bytes: int | None = None) -> None:
    """Write range-partitioned and sorted by ``columns``: equality on the first and a range on the next one
    touch few row groups. The sort is on all columns, so one hot first value is spread over several files. The number of
    files follows the data (shuffle partitions, joined by AQE where they are small) unless it is given."""
    ranged = df.repartitionByRange(files, *columns) if files else df.repartitionByRange(*columns)
    writer = ranged.sortWithinPartitions(*columns).write
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def zone_map(df: DataFrame, columns: list[str], block_rows: int | None = None) -> DataFrame:
    """Smallest and largest value per file of a DataFrame read from files, or per block of ``block_rows`` rows of a
    file: the summary a range read prunes with."""
    ranges = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    zone = [F.col("_metadata.file_path").alias("file")]
    if block_rows:
        zone.append(F.floor(F.col("_metadata.row_index") / block_rows).alias("block"))
    return df.groupBy(*zone).agg(F.count(F.lit(1)).alias("rows"), *ranges)


def zones_touched(df: DataFrame, bounds: dict[str, tuple], block_rows: int | None = None) -> DataFrame:
    """One row: zones in all, zones and rows that a range read on ``bounds`` {column: (low, high)} cannot skip."""
    zones = zone_map(df, list(bounds), block_rows)
    overlaps = F.lit(True)
    for c, (low, high) in bounds.items():
        overlaps = overlaps & (F.col(f"max_{c}") >= low) & (F.col(f"min_{c}") <= high)
    return zones.agg(
        F.count(F.lit(1)).alias("zones"),
        F.count_if(overlaps).alias("zones_touched"),
        F.sum(F.when(overlaps, F.col("rows")).otherwise(0)).alias("rows_touched"),
    )


def prune_by_zone(spark: SparkSession, df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows with ``low <= column < high``, read only from the files whose range allows it."""
    zones = zone_map(df, [column])
    hit = zones.filter((F.col(f"max_{column}") >= low) & (F.col(f"min_{column}") < high))
    files = [r["file"] for r in hit.select("file").collect()]  # paths of the files to read, as any scan lists them
    condition = (F.col(column) >= low) & (F.col(column) < high)
    if not files:
        return df.filter(F.lit(False))
    return spark.read.schema(df.schema).parquet(*files).filter(condition)


def layout_subset(df: DataFrame, condition: Column, columns: list[str], path: str, order: list[str]) -> DataFrame:
    """A small side table of the rows that meet a condition, sorted for its one query."""
    df.filter(condition).select(*columns).repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    return df.sparkSession.read.schema(df.select(*columns).schema).parquet(path)


def layout_covering(df: DataFrame, key: list[str], included: list[str], path: str, files: int | None = None) -> DataFrame:
    """A narrow copy with only the columns a query needs, in the order of its key."""
    narrow = df.select(*key, *included)
    layout_sorted(narrow, key, path, files)
    return df.sparkSession.read.schema(narrow.schema).parquet(path)


def layout_normalized_key(df: DataFrame, column: str, name: str, path: str, files: int | None = None) -> DataFrame:
    """The table with a stored lower-case key, sorted by it and with a bloom filter for as many values as there are, so that
    equality is pushed down."""
    keyed = df.withColumn(name, normalized_email(column))
    values = keyed.agg(F.approx_count_distinct(name)).first()[0]
    ranged = keyed.repartitionByRange(files, name) if files else keyed.repartitionByRange(name)
    (
        ranged.sortWithinPartitions(name)
        .write.option(f"parquet.bloom.filter.enabled#{name}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{name}", str(max(1000, values)))
        .parquet(path)
    )
    return df.sparkSession.read.schema(keyed.schema).parquet(path)


def layout_inverted(df: DataFrame, key: str, document: str, path: str) -> DataFrame:
    """(path, kind, value, at, key): one row per scalar of a JSON document at any depth, sorted by (path, kind, value).

    ``path`` joins the names on the way by dots, with dots and backslashes inside names escaped. ``kind`` is string, number,
    boolean or null, so that the text "1" is not the number 1, and a text that looks like JSON is a text; numbers are
    written in one way (1.50 as 1.5). ``at`` has, for the document and for every name of the path, the positions in the arrays
    opened there ("0.2" is the third element of the first array): members of one array element have the same beginning. A text
    that is no JSON has no members; of members of one name the last counts.
    """
    kind = df.schema[key].dataType.simpleString()

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, keys = ([], [], [], []), []
            for place, text in enumerate(batch.column(1).to_pylist()):
                for row in scalars_of(text):
                    keys.append(place)
                    for column, value in zip(found, row, strict=True):
                        column.append(value)
            types = (pa.string(), pa.string(), pa.string(), pa.list_(pa.string()))
            arrays = [pa.array(c, t) for c, t in zip(found, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column(0).take(pa.array(keys, pa.int64()))], names=["path", "kind", "value", "at", key])

    rows = df.select(key, document).mapInArrow(members, f"path string, kind string, value string, at array<string>, `{key}` {kind}")
    # ranges of (path, kind, value, id), so that neither a frequent member nor a frequent value becomes one writing task
    order = ["path", "kind", "value", key]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def json_path(*names: str) -> str:
    """The ``path`` of nested names in an inverted layout."""
    return ".".join(n.replace("\\", "\\\\").replace(".", "\\.") for n in names)


def scalars_of(text: str | None) -> Iterator[tuple[str, str, str | None, list[str]]]:
    """(path, kind, value, at) of every scalar of a JSON text."""
    try:
        root = json.loads(text, parse_float=Decimal, parse_constant=_no_json) if text is not None else {}
    except (ValueError, RecursionError, ArithmeticError):
        return
    todo = [((), [""], root)]
    while todo:
        names, at, value = todo.pop()
        if isinstance(value, dict):
            todo.extend(((*names, name), [*at, ""], member) for name, member in value.items())
        elif isinstance(value, list):
            todo.extend((names, [*at[:-1], f"{at[-1]}.{k}" if at[-1] else str(k)], member) for k, member in enumerate(value))
        else:
            yield (json_path(*names), *kind_and_text(value), at)


def _no_json(name: str):
    raise ValueError(name)


def kind_and_text(value: str | bool | int | float | Decimal | None) -> tuple[str, str | None]:
    """How a scalar is kept: equal numbers are written alike."""
    if value is None:
        return "null", None
    if isinstance(value, bool):
        return "boolean", str(value).lower()
    if isinstance(value, str):
        return "string", value
    if isinstance(value, int):
        return "number", str(value)
    number = (Decimal(repr(value)) if isinstance(value, float) else value).normalize()
    return "number", f"{number:f}" if abs(number.adjusted()) < 100 else str(number)


def inverted_lookup(index: DataFrame, key: str, wanted: dict | None = None, **members) -> DataFrame:
    """Ids whose document has all the given members, each found by one range of the index.

    Members are given by path (``json_path``, or plain dotted names) with a value of the kind that is looked for. A dict as
    value stands for one array element, or one object, that has all of its members (by their names below it) together.
    """
    hits = None
    for path, value in {**(wanted or {}), **members}.items():
        if isinstance(value, dict):
            # the place in the document after as many names as the path has
            depth, found = re.sub(r"\\.", "", path).count(".") + 1, None
            for inner, own in value.items():
                rows = _holding(index, f"{path}.{inner}", own).select(key, F.slice("at", 1, depth + 1).alias("_at")).distinct()
                found = rows if found is None else found.join(rows, [key, "_at"], "left_semi")
            found = found.select(key)
        else:
            found = _holding(index, path, value).select(key)
        hits = found.distinct() if hits is None else hits.join(found, key, "left_semi")
    return hits


def _holding(index: DataFrame, path: str, value) -> DataFrame:
    kind, text = kind_and_text(value)
    rows = index.filter((F.col("path") == path) & (F.col("kind") == kind))
    return rows if text is None else rows.filter(F.col("value") == text)


def layout_bucketed(df: DataFrame, table: str, key: str, buckets: int | None, path: str) -> DataFrame:
    """A table bucketed and sorted by ``key``: joins and groupings on it need no shuffle. As many buckets as the session's
    shuffles have partitions where ``buckets`` is None, so that both sides of a join agree. The caller drops the table."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").saveAsTable(table)
    return spark.table(table)


def write_cost_report(df: DataFrame, layouts: dict[str, list[str]], files: int | None = None) -> DataFrame:
    """Rows, files, bytes and seconds of writing the same table unsorted and in each sorted layout."""
    spark = df.sparkSession
    parts = []
    for name, columns in {"as is": [], **layouts}.items():
        path = scratch_path(spark, "layout")
        started = time.perf_counter()
        if columns:
            layout_sorted(df, columns, path, files)
        else:
            df.write.parquet(path)
        seconds = time.perf_counter() - started
        sizes = table_size(spark.read.schema(df.schema).parquet(path))
        parts.append(sizes.select(F.lit(name).alias("layout"), "*", F.lit(seconds).alias("seconds")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def per_file(df: DataFrame) -> DataFrame:
    """Rows and bytes of each file."""
    return df.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("bytes")
    )


def table_size(df: DataFrame) -> DataFrame:
    return per_file(df).agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, files and bytes of each table."""
    parts = [table_size(df).select(F.lit(name).alias("relname"), "*") for name, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def physical_address(df: DataFrame, key: str) -> DataFrame:
    """File and position in the file of each row."""
    return df.select(key, F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row_index"))


def rows_per_page(df: DataFrame, page_rows: int) -> DataFrame:
    """Rows per page of a fixed number of positions in each file."""
    page = F.floor(F.col("_metadata.row_index") / page_rows).alias("page")
    return df.groupBy(F.col("_metadata.file_name").alias("file"), page).agg(F.count(F.lit(1)).alias("tuples"))


def order_correlation(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Correlation of physical position and value per file: near 1 or -1 means that ranges prune well."""
    position = F.col("_metadata.row_index").cast("double")
    return df.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        *[F.corr(position, value.cast("double")).alias(name) for name, value in columns.items()]
    )


def profile_columns(df: DataFrame, columns: list[str], exact: bool = False) -> DataFrame:
    """Per column: rows, share of NULLs, different values (a bounded sketch unless ``exact``), smallest and largest."""

    def different(c: str) -> Column:
        return F.count_distinct(F.col(c)) if exact else F.approx_count_distinct(c)

    def row(c: str) -> Column:
        return F.struct(
            F.lit(c).alias("column"),
            F.col("_rows").alias("rows"),
            percent_of(F.col("_rows") - F.col(f"n_{c}"), F.col("_rows"), 4).alias("null_pct"),
            F.col(f"d_{c}").alias("different"),
            F.col(f"min_{c}").alias("smallest"),
            F.col(f"max_{c}").alias("largest"),
        )

    stats = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[different(c).alias(f"d_{c}") for c in columns],
        *[F.min(c).cast("string").alias(f"min_{c}") for c in columns],
        *[F.max(c).cast("string").alias(f"max_{c}") for c in columns],
    )
    return stats.select(F.explode(F.array(*[row(c) for c in columns])).alias("p")).select("p.*")


def common_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The most frequent values and their share."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("total"))
    whole = counts.agg(F.sum("total")).scalar()
    return counts.withColumn("percent", percent_of(F.col("total"), whole, 4)).orderBy(F.desc("total"), column).limit(k)


def live_and_dead(versions: DataFrame, key: str, version: str) -> DataFrame:
    """Live and dead rows of a table that keeps every version of a row."""
    per_key = versions.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.count(F.lit(1)).alias("live"), (F.sum("_n") - F.count(F.lit(1))).alias("dead"))


def compact(versions: DataFrame, key: str, version: str, path: str, files: int | None = None) -> DataFrame:
    """Rewrite with only the newest version of each row, in a few sorted files."""
    rest = [c for c in versions.columns if c != key]
    newest = versions.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_row")).select(key, "_row.*")
    newest = newest.select(*versions.columns)
    layout_sorted(newest, [key], path, files)
    return versions.sparkSession.read.schema(newest.schema).parquet(path)
