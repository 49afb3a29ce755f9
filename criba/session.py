"""Session, table and lineage helpers."""

from __future__ import annotations

import sys
import tempfile
import types
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session with the settings the library expects (UTC, AQE)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("criba")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Percentiles of many small groups stay in a hash map instead of being sorted.
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "100000")
        # Checkpoints go once nothing refers to them any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a data folder (a Parquet file or a folder of them)."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset and
    the session is local, as in tests, a temporary folder takes its place; a
    cluster without the setting is refused, since executors would not share it.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None)
    if named:
        if not context._jsc.sc().getCheckpointDir().isDefined():
            context.setCheckpointDir(named)
        return named
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="criba-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def worker_memory(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, made once a Python worker and kept for its later tasks.

    It lives in a module of its own rather than in one of this package, whose
    functions and globals travel with every task.
    """
    place = sys.modules.setdefault("criba_worker_memory", types.ModuleType("criba_worker_memory"))
    if not hasattr(place, name):
        setattr(place, name, make())
    return getattr(place, name)
