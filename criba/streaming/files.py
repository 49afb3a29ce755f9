"""Streams: files as they arrive, late rows flagged, runs of failures."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType


def arriving_parquet(spark: SparkSession, path: str, schema: StructType | None = None, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the Parquet files of a folder, new ones included as they appear; or of one file."""
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return reader.parquet(path)
    # A stream reads folders: that of the file, narrowed to its name.
    return reader.option("pathGlobFilter", place.getName()).parquet(place.getParent().toString())


def drain(stream: DataFrame, target: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Writes all that has arrived to a table, exactly once, and ends; the next call goes on from there."""
    writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    query = (writer.partitionBy(*partition_by) if partition_by else writer).start()
    query.awaitTermination()
    return query


def drain_each(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Hands each micro-batch of what has arrived to ``write``, for sinks that upsert."""
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def windowed_counts(stream: DataFrame, time: str, by: list[str], value: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows and sum of ``value`` in windows of event time; rows later than the watermark are not counted."""
    windows = stream.withWatermark(time, late).groupBy(F.window(time, width).alias("v"), *by)
    return windows.agg(F.count("*").alias("n"), F.sum(value).alias("suma")).select(F.col("v.start").alias("inicio"), F.col("v.end").alias("fin"), *by, "n", "suma")


def flag_late(stream: DataFrame, month: str, declared: str, name: str = "desfase_mes") -> DataFrame:
    """Rows of another month than declared flagged, not dropped: no watermark is needed."""
    return stream.withColumn(name, F.coalesce(F.col(month) != F.col(declared), F.lit(False)))


def failure_alerts(stream: DataFrame, source: str, time: str, failed: str, limit: int = 8) -> DataFrame:
    """An alert whenever a source reaches ``limit`` failures in a row: ``source, momento, fallos``.

    The count per source is state across micro-batches; a success or an alert resets it.
    Rows of one micro-batch count in order of time.
    """
    kind = dict(stream.dtypes)

    def count(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run = state.get[0] if state.exists else 0
        batch = pd.concat(list(rows)).sort_values("t")
        alerts = []
        for moment, bad in zip(batch["t"], batch["f"]):
            run = run + 1 if bad else 0
            if run >= limit:
                alerts.append((key[0], moment, run))
                run = 0
        state.update((run,))
        yield pd.DataFrame(alerts, columns=["s", "t", "n"])

    told = stream.select(F.col(source).alias("s"), F.col(time).alias("t"), F.coalesce(F.col(failed), F.lit(False)).alias("f"))
    found = told.groupBy("s").applyInPandasWithState(count, f"s {kind[source]}, t {kind[time]}, n bigint", "run bigint", "append", GroupStateTimeout.NoTimeout)
    return found.select(F.col("s").alias(source), F.col("t").alias("momento"), F.col("n").alias("fallos"))
