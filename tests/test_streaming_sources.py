import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tablewatch.plans import checks as K
from tablewatch.sources import files as SF
from tablewatch.sources import jdbc as J
from tablewatch.streaming import check_each_batch, running_check_counts


def test_file_roundtrip_partitioned(spark, sf_small):
    o = SF.table(spark, sf_small, "orders")
    out = tempfile.mkdtemp(prefix="tw-files-")
    SF.write_table(o.select("o_orderkey", "o_orderstatus"), out, partition_by="o_orderstatus")
    back = SF.read_table(spark, out).filter(F.col("o_orderstatus") == "F")
    assert back.count() == o.filter(F.col("o_orderstatus") == "F").count()
    assert "PartitionFilters: [isnotnull(o_orderstatus" in back._jdf.queryExecution().executedPlan().toString()


def test_materialize_under_checkpoint_dir(spark, sf_small):
    from tablewatch.session import checkpoint_dir
    o = SF.table(spark, sf_small, "orders").select("o_orderkey", "o_totalprice")
    staged = SF.materialize(o, "orders_stage")
    assert staged.count() == o.count()
    assert checkpoint_dir(spark) in staged.inputFiles()[0]


def test_jdbc_partition_options_validated(spark):
    with pytest.raises(ValueError):
        J.read_jdbc(spark, "jdbc:none", "t", partition_column="id", num_partitions=4)


def test_stream_checks(spark, sf_small):
    src = tempfile.mkdtemp(prefix="tw-stream-src-")
    li = SF.table(spark, sf_small, "lineitem").select("l_orderkey", "l_quantity")
    li.write.mode("overwrite").parquet(os.path.join(src, "part1"))
    stream = spark.readStream.schema(li.schema).parquet(os.path.join(src, "part1"))
    results = tempfile.mkdtemp(prefix="tw-stream-out-")
    q = check_each_batch(stream, lambda b: [K.value_range(b, "l_quantity", 5, 45)], results,
                         checkpoint_location=tempfile.mkdtemp(prefix="tw-ckpt-"))
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(results).collect()
    expected = li.filter((F.col("l_quantity") < 5) | (F.col("l_quantity") > 45)).count()
    assert sum(r.failing for r in got) == expected

    stream2 = spark.readStream.schema(li.schema).parquet(os.path.join(src, "part1"))
    running = running_check_counts(stream2, [K.value_range(stream2, "l_quantity", 5, 45)])
    q2 = (running.writeStream.outputMode("complete").format("memory").queryName("tw_running")
          .option("checkpointLocation", tempfile.mkdtemp(prefix="tw-ckpt2-")).start())
    q2.processAllAvailable()
    q2.stop()
    r = spark.sql("SELECT * FROM tw_running").collect()[0]
    assert r.failing == expected and r.total == li.count()


class _Recorder:
    """Stands in for DataFrameReader/Writer: records format, options and mode."""

    def __init__(self):
        self.calls = {}

    def format(self, f):
        self.calls["format"] = f
        return self

    def option(self, k, v):
        self.calls[k] = v
        return self

    def mode(self, m):
        self.calls["mode"] = m
        return self

    def load(self):
        return "loaded"

    def save(self):
        self.calls["saved"] = True


def test_jdbc_options_are_passed_through():
    rec = _Recorder()

    class FakeSpark:
        read = rec
    out = J.read_jdbc(FakeSpark(), "jdbc:x://h/db", "(SELECT * FROM t) q", {"user": "u", "password": "p"},
                      partition_column="id", lower_bound=1, upper_bound=1000, num_partitions=8, fetch_size=500)
    assert out == "loaded"
    assert rec.calls == {"format": "jdbc", "url": "jdbc:x://h/db", "dbtable": "(SELECT * FROM t) q", "user": "u",
                         "password": "p", "partitionColumn": "id", "lowerBound": "1", "upperBound": "1000",
                         "numPartitions": "8", "fetchsize": "500"}
    wrec = _Recorder()

    class FakeDF:
        write = wrec
    J.write_jdbc(FakeDF(), "jdbc:x://h/db", "out", {"user": "u"}, mode="overwrite", truncate=True, batch_size=1000,
                 num_partitions=4)
    assert wrec.calls["mode"] == "overwrite" and wrec.calls["truncate"] == "true"
    assert wrec.calls["batchsize"] == "1000" and wrec.calls["numPartitions"] == "4" and wrec.calls["saved"]
