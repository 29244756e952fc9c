"""Session settings, and tables written to the shared scratch folder to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "ledgerspark", cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the bench. A cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="ledgerspark-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return f"{configured.rstrip('/')}/ledgerspark-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the scratch folder and read it back: loops stay short-lived and survive lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(*tables: DataFrame | None) -> None:
    """Remove materialized tables that nothing reads any more, such as the state before the last round of a loop."""
    for table in tables:
        path = getattr(table, "scratch_path", None) if table is not None else None
        if isinstance(path, str):
            _remove(table.sparkSession, path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all of this application's scratch tables, once its results are written elsewhere."""
    _remove(spark, scratch_dir(spark))


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
