"""Reading tables with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.sources.schemas import TABLES


def scan_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def scan_named(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return scan_table(spark, f"{folder}/{name}.parquet", TABLES[name])


def stream_named(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as a stream of its files."""
    return spark.readStream.schema(TABLES[name]).option("pathGlobFilter", f"{name}.parquet").parquet(folder)
