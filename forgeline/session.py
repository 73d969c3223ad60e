"""Session helpers: build a session, pin the settings every plan relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(app: str = "forgeline", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Return a session with the settings the engine assumes.

    On a cluster ``master`` stays ``None`` and the submitter's settings win;
    locally (tests, bench) a ``local[N]`` master is passed in.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    pin_session(spark)
    return spark


def pin_session(spark: SparkSession) -> SparkSession:
    """Settings every operator depends on (see SURVEY 4.4, traps T4/T6).

    Timestamps are ``timestamp_ntz`` carrying UTC wall clock; ``date_trunc``
    goes through the session zone, so the zone must be UTC.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master,
    where driver and executors are one process, may leave it unset: then a
    fresh temporary folder serves the session.  Elsewhere a folder of the
    driver's machine would not be seen by the executors, so that raises.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="forgeline-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


def materialize(df, name: str = "stage"):
    """Cut the lineage of ``df`` by writing it as a table in the shared folder.

    Used at layer boundaries (normalised readings, deduplicated Silver,
    unified Silver) so later plans start from stored columnar data instead
    of re-planning and re-running every upstream step; a lost executor then
    re-reads the stored table instead of recomputing the lineage.  Writing
    parquet computes the plan once (an RDD checkpoint would run it twice)
    and the read-back keeps column pruning and filter pushdown.
    """
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
