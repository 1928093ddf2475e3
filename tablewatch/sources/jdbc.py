"""JDBC tables (S1 read, S2 write).

Connection details (URL, user, password, driver class) are always supplied by the
caller; nothing is stored in code. A plain JDBC read is one task; pass a numeric or
date ``partition_column`` with bounds to read in ``num_partitions`` parallel range
queries. Filters and projections applied to the result are pushed into the SQL sent
to the database.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetch_size: int | None = None) -> DataFrame:
    """Read a table (or a ``(SELECT ...) alias`` subquery) over JDBC."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    if fetch_size:
        reader = reader.option("fetchsize", str(fetch_size))
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
               mode: str = "overwrite", truncate: bool = False, batch_size: int | None = None,
               num_partitions: int | None = None) -> None:
    """Write a DataFrame to a table; each partition writes over its own connection.

    ``truncate=True`` with overwrite keeps the table definition; ``num_partitions``
    caps the number of concurrent connections (the frame is coalesced to it).
    """
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    if truncate:
        writer = writer.option("truncate", "true")
    if batch_size:
        writer = writer.option("batchsize", str(batch_size))
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    writer.save()
