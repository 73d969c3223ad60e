"""File-system helpers through Hadoop's FileSystem API.

Paths may be local, HDFS or object stores; the same calls work for all of
them because they go through the session's Hadoop configuration.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def list_names(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """(name, full path, length) of the direct children of ``path``, sorted by name."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = [(st.getPath().getName(), st.getPath().toString(), int(st.getLen())) for st in fs.listStatus(p)]
    return sorted(out)


def stamp(spark: SparkSession, path: str) -> tuple[int, int]:
    """(bytes, latest modification time) of a file or of a folder's files."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return 0, 0
    files = list(fs.listStatus(p))
    return sum(int(f.getLen()) for f in files), max((int(f.getModificationTime()) for f in files), default=0)


def replace_table(df, path: str, partition_by: list[str] | None = None) -> None:
    """Store ``df`` as the table at ``path``: written beside it, then moved into its place.

    A write that fails leaves the old table as it was, so ``df`` may read it.
    The old one stays as ``<path>.previous`` until the next replacement; should
    the run end between the two moves, ``recovered`` finds it.
    """
    spark = df.sparkSession
    new, previous = path.rstrip("/") + ".new", path.rstrip("/") + ".previous"
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(new)
    fs, at = _fs(spark, path)
    _, old = _fs(spark, previous)
    _, fresh = _fs(spark, new)
    if fs.exists(at):
        fs.delete(old, True)
        if not fs.rename(at, old):
            raise OSError(f"can't move {path} to {previous}")
    if not fs.rename(fresh, at):
        raise OSError(f"can't move {new} to {path}")


def recovered(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path``, after moving a previous one back that a run has left without successor."""
    fs, at = _fs(spark, path)
    _, old = _fs(spark, path.rstrip("/") + ".previous")
    if not fs.exists(at) and fs.exists(old):
        fs.rename(old, at)
    return bool(fs.exists(at))
