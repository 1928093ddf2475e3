"""File tables: the parquet fixtures and any file format Spark reads or writes."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Read a table from files. Give ``schema`` for text formats (no inference at scale)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture table ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None, **options) -> None:
    """Write a table; ``partition_by`` lays it out in folders for partition pruning."""
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.save(path)


def materialize(df: DataFrame, name: str, root: str | None = None, mode: str = "overwrite") -> DataFrame:
    """Write ``df`` once as parquet and return a DataFrame reading it back.

    For sources that are expensive to read more than once (a JDBC table checked by a
    multi-pass report), or to cut a long lineage. The table goes under ``root``,
    default the shared folder named by ``spark.checkpoint.dir``, so it outlives lost
    executors; never a machine-local folder on a cluster.
    """
    from ..session import checkpoint_dir
    base = root or checkpoint_dir(df.sparkSession)
    path = base.rstrip("/") + "/tables/" + name
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)
