"""Sinks: partitioned tables with reconciled counts, verified copies, side outputs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class ReconciliationError(ValueError):
    """What was written is not what was read."""


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = (), expected: int | None = None) -> int:
    """Replaces the partitions that ``df`` holds, and no others; returns the rows written.

    Rows are sorted within files, so that readers skip row groups. They are written beside the
    table first and counted; where the count differs from ``expected`` an error
    names both and the table stays as it was. Only then each partition's folder takes the
    place of the former one by a rename.
    """
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}/_nuevo-{uuid.uuid4().hex}"
    seen = Observation()
    out = df.repartition(*partition_by).sortWithinPartitions(*partition_by, *sort_by) if partition_by else df
    writer = out.observe(seen, F.count(F.lit(1)).alias("n")).write.option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(beside)
    written = seen.get["n"]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(conf)
    if expected is not None and written != expected:
        fs.delete(hadoop(beside), True)
        raise ReconciliationError(f"{path}: {expected} rows read, {written} written")
    _move_leaves(fs, hadoop, beside, path.rstrip("/"), len(partition_by))
    fs.delete(hadoop(beside), True)
    return written


def _move_leaves(fs, hadoop, source: str, target: str, depth: int) -> None:
    """Moves each folder ``depth`` levels below ``source`` to the same place below ``target``, in place of what is there."""
    entries = [s for s in fs.listStatus(hadoop(source)) if not s.getPath().getName().startswith(("_", "."))]
    if depth == 0:
        for old in fs.listStatus(hadoop(target)) if fs.exists(hadoop(target)) else []:
            if old.isFile() and not old.getPath().getName().startswith("_"):
                fs.delete(old.getPath(), False)
        fs.mkdirs(hadoop(target))
        for s in entries:
            fs.rename(s.getPath(), hadoop(f"{target}/{s.getPath().getName()}"))
        return
    for s in entries:
        name = s.getPath().getName()
        if depth > 1:
            _move_leaves(fs, hadoop, f"{source}/{name}", f"{target}/{name}", depth - 1)
            continue
        if fs.exists(hadoop(f"{target}/{name}")):
            fs.delete(hadoop(f"{target}/{name}"), True)
        fs.mkdirs(hadoop(target))
        fs.rename(s.getPath(), hadoop(f"{target}/{name}"))


def replace_files(existing: DataFrame, incoming: DataFrame, file: str) -> DataFrame:
    """Rows of a table in which the files of ``incoming`` take the place of their former rows."""
    return existing.join(incoming.select(file).distinct(), file, "left_anti").unionByName(incoming, allowMissingColumns=True)


def write_snapshot(df: DataFrame, path: str) -> None:
    """Replaces a whole table."""
    df.write.mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Adds rows in one commit."""
    df.write.mode("append").parquet(path)


def clustered_table(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
    """A table bucketed and sorted by keys: later joins on them need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def side_outputs(df: DataFrame, good: Column, path: str, failed_path: str) -> None:
    """Good rows and failed ones to their own places; a null test fails."""
    passed = F.coalesce(good, F.lit(False))
    df.where(passed).write.mode("append").parquet(path)
    df.where(~passed).write.mode("append").parquet(failed_path)


def copy_verified(spark: SparkSession, source: str, target: str) -> str:
    """Copies one file byte by byte on the Hadoop file systems and compares checksums; returns the MD5."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    conf = context._jsc.hadoopConfiguration()
    a, b = hadoop.Path(source), hadoop.Path(target)
    hadoop.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, True, conf)
    read = lambda p: spark.read.format("binaryFile").load(p).select(F.md5("content")).first()[0]
    if (md5 := read(source)) != read(target):
        raise ReconciliationError(f"{target} is no copy of {source}")
    return md5


def audit_sheet(df: DataFrame, path: str, label: str) -> None:
    """A bounded sample as one CSV file with an empty column for the auditor."""
    df.withColumn(label, F.lit(None).cast("string")).coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
