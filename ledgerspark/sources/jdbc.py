"""Tables of a relational database, read in key ranges and appended in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_options(url: str, table: str, key: str, low: int, high: int, partitions: int, **extra: str) -> dict[str, str]:
    """Options of a partitioned read. ``low`` and ``high`` only shape the ranges: rows outside are read too."""
    if partitions < 1 or high < low:
        raise ValueError("need at least one partition and low <= high")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
        "sessionInitStatement": "SET default_transaction_read_only = on",
        **extra,
    }


def read_jdbc(spark: SparkSession, schema: str | None = None, **options) -> DataFrame:
    """A table as a DataFrame; filters and columns are pushed to the database. Needs its driver on the classpath."""
    reader = spark.read.format("jdbc").options(**read_options(**options))
    return (reader.option("customSchema", schema) if schema else reader).load()


def append_jdbc(df: DataFrame, url: str, table: str, connections: int = 16, **extra: str) -> None:
    """Append over a bounded number of connections. A task that runs twice inserts twice, so the table needs a
    unique key, or the rows go to a staging table first."""
    writer = df.write.format("jdbc").mode("append").options(**extra)
    writer.option("url", url).option("dbtable", table).option("numPartitions", connections).option("batchsize", 5000).save()
