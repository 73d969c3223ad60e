"""Incremental Bronze: new files are appended once, restarts do not repeat them."""

import os
import tempfile

from forgeline.streaming.bronze_stream import stream_bronze


def _write(d, name, lines):
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join(["machine_id,timestamp,temperature", *lines]) + "\n")


def test_available_now_appends_each_file_once(spark):
    src = tempfile.mkdtemp(prefix="forgeline-stream-src-")
    out = os.path.join(tempfile.mkdtemp(prefix="forgeline-stream-out-"), "bronze_temperature")
    _write(src, "a.csv", ["MACH-01,2025-01-01 00:00:00,30.5", "abc,bad,x"])
    q = stream_bronze(spark, "temperature", src, out, name="t-test")
    q.awaitTermination(120)
    df = spark.read.parquet(out)
    assert df.count() == 2 and df.where("parse_ok").count() == 1
    _write(src, "b.csv", ["MACH-02,2025-01-01 01:00:00,31.0"])
    q = stream_bronze(spark, "temperature", src, out, name="t-test")
    q.awaitTermination(120)
    df = spark.read.parquet(out)
    assert df.count() == 3
    assert sorted(r.source_file for r in df.select("source_file").distinct().collect()) == ["a.csv", "b.csv"]


def test_replayed_epoch_does_not_duplicate(spark):
    from pyspark.sql import functions as F

    from forgeline.operators import validate

    out = os.path.join(tempfile.mkdtemp(prefix="forgeline-stream-out-"), "bronze")
    batch = spark.createDataFrame([("MACH-01", "2025-01-01 00:00:00", "1.0", "a.csv")],
                                  "machine_id_raw string, timestamp_raw string, temperature_raw string, source_file string")
    for _ in range(2):  # the same epoch written twice, as after a failure
        (validate.validate_temperature(batch).withColumn("stream_epoch", F.lit(0).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stream_epoch").parquet(out))
    assert spark.read.parquet(out).count() == 1
