"""Keyed state without a transactional format: upserts, versions, manifests."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from criba.operators.relational import first_row


def upsert(existing: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """``existing`` with the rows of ``changes`` in place of those of the same key.

    Columns that either side lacks are null there. Keys of ``changes`` must be
    unique; a null key never replaces.
    """
    kept = existing.join(changes.select(*key).distinct(), list(key), "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)


def changed_rows(existing: DataFrame, incoming: DataFrame, key: Sequence[str], mark: str) -> DataFrame:
    """Rows of ``incoming`` that are new or whose ``mark`` (a hash) differs from the one held."""
    held = existing.select(*key, F.col(mark).alias("_held"), F.lit(True).alias("_is")).distinct()
    joined = incoming.join(held, list(key), "left")
    return joined.where(F.col("_is").isNull() | ~F.col(mark).eqNullSafe(F.col("_held"))).drop("_held", "_is")


def without_orphans(existing: DataFrame, owners: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key the owning table still has."""
    return existing.join(owners.select(*key).distinct(), list(key), "left_semi")


#: Seconds after which the lock of a writer that never finished lapses.
LEASE_SECONDS = 600


class VersionedTable:
    """A table as folders of versions and a pointer to the current one.

    A new version is written beside the others and only then pointed to, by one
    rename that replaces the pointer, so readers see either the old rows or the
    new ones and never none. Folders are on the shared file system. A writer that started
    from a version that is no longer the current one is refused, and keeps
    nothing: two writers never lose an update. ``keep`` versions stay for readers
    that still hold them; older ones go.
    """

    def __init__(self, spark: SparkSession, folder: str, keep: int = 2):
        self.spark, self.folder, self.keep = spark, folder.rstrip("/"), keep

    def _context(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(self.folder).toUri(), conf), path(self.folder).getFileSystem(conf), path, jvm

    def _pointed(self) -> str | None:
        _, fs, path, _ = self._context()
        if not fs.exists(path(f"{self.folder}/current")):
            return None
        return self.spark.read.text(f"{self.folder}/current").first()[0]

    def read(self) -> DataFrame | None:
        """The current version, or None before the first."""
        version = self._pointed()
        return self.spark.read.parquet(f"{self.folder}/{version}") if version else None

    def replace(self, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Writes ``df`` as a new version and points to it; ``df`` may read the current one."""
        self._publish(df, partition_by, self._pointed())

    def _publish(self, df: DataFrame, partition_by: Sequence[str], seen: str | None) -> None:
        version = f"v-{int(time.time() * 1000):015d}-{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(f"{self.folder}/{version}")
        context, fs, path, jvm = self._context()
        # Whoever makes the lock, which names the version it replaces, may point; one left by a dead writer lapses.
        lock = path(f"{self.folder}/.after-{seen or 'none'}")
        if fs.exists(lock) and time.time() - fs.getFileStatus(lock).getModificationTime() / 1000 > LEASE_SECONDS:
            fs.delete(lock, False)
        if self._pointed() != seen or not fs.createNewFile(lock):
            fs.delete(path(f"{self.folder}/{version}"), True)
            raise StaleVersionError(f"{self.folder}: another writer has replaced version {seen}")
        fresh = path(f"{self.folder}/.current-{version}")
        out = fs.create(fresh, True)
        out.write(bytearray(version, "utf-8"))
        out.close()
        option = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(option, 1)
        options[0] = option.OVERWRITE
        context.rename(fresh, path(f"{self.folder}/current"), options)
        fs.delete(lock, False)
        self._expire(fs, path, version)

    def _expire(self, fs, path, current: str) -> None:
        found = sorted(s.getPath().getName() for s in fs.listStatus(path(self.folder)) if s.isDirectory() and s.getPath().getName().startswith("v-"))
        for name in [n for n in found if n < current][: -self.keep + 1 or None] if self.keep > 0 else []:
            fs.delete(path(f"{self.folder}/{name}"), True)

    def merge(self, changes: DataFrame, key: Sequence[str]) -> None:
        """Upserts ``changes`` by key into the current version; refused where another writer got in between."""
        seen = self._pointed()
        held = self.spark.read.parquet(f"{self.folder}/{seen}") if seen else None
        self._publish(changes if held is None else upsert(held, changes, key), (), seen)


class StaleVersionError(RuntimeError):
    """The table has changed since the writer read it."""


def latest_entries(manifest: DataFrame, key: str = "ruta_origen", version: str = "version") -> DataFrame:
    """The entry of highest version of each path of an append-only manifest."""
    return first_row(manifest, [key], [F.desc(version)])


def load_decisions(files: DataFrame, manifest: DataFrame, key: str = "ruta_origen", checksum: str = "md5") -> DataFrame:
    """What to do with each file: ``accion, version, motivo``.

    manifest columns: key, ``version, md5, estado`` (OK or ERROR) and ``con_bronce``.
    A file never seen, failed before, without its table, or with another checksum is
    loaded under the next version; one held with the same checksum is skipped, as is
    an empty one that needs no table.
    """
    last = latest_entries(manifest, key).select(key, F.col("version").alias("_v"), F.col(checksum).alias("_c"), F.col("estado").alias("_e"), F.col("con_bronce").alias("_b"))
    joined = files.join(last, key, "left")
    empty = F.coalesce(F.col("filas"), F.lit(1)) == 0
    reason: Column = (
        F.when(F.col("_v").isNull(), "nuevo")
        .when(F.col("_e") == "ERROR", "reintento")
        .when(~F.col("_c").eqNullSafe(F.col(checksum)), "cambio")
        .when(~F.coalesce("_b", F.lit(False)) & ~empty, "sin_tabla")
        .otherwise("igual")
    )
    return joined.withColumn("motivo", reason).select(
        *files.columns,
        F.when(F.col("motivo") == "igual", "omitir").otherwise("cargar").alias("accion"),
        F.when(F.col("motivo") == "igual", F.col("_v")).otherwise(F.coalesce("_v", F.lit(0)) + 1).cast("bigint").alias("version"),
        "motivo",
    )


def manifest_summary(manifest: DataFrame, by: Sequence[str]) -> DataFrame:
    """Files and rows of the current entries by status and the given columns."""
    return latest_entries(manifest).groupBy("estado", *by).agg(F.count("*").alias("archivos"), F.sum("filas").alias("filas"))


def held_copies(files: DataFrame, objects: DataFrame, key: str = "ruta_origen", checksum: str = "md5") -> DataFrame:
    """``files`` with ``ya_esta``: whether the target already holds an object of that path and checksum.

    objects: ``key`` and ``checksum`` of what lies at the target. A safety net for files that the manifest does
    not know: one already there need not be sent again.
    """
    there = objects.select(key, checksum).where(F.col(checksum).isNotNull()).distinct().withColumn("ya_esta", F.lit(True))
    return files.join(there, [key, checksum], "left").withColumn("ya_esta", F.coalesce("ya_esta", F.lit(False))).select(*files.columns, "ya_esta")


def load_plan(profiles: DataFrame, declared: DataFrame, target: str, shop: str | None = None, month: str | None = None, until: str | None = None) -> DataFrame:
    """What a load would do, without doing it: ``ruta, destino, accion, motivo, marcas``.

    profiles: ``ruta, filas, fuera_de_mes, mes_mayoritario``. An empty file is skipped. ``marcas``, in order: ``SIN_HEADER``,
    ``DESCARTA:<columnas>``, ``SOSPECHA_COPIA``, ``DESFASE_MES:<filas>`` (with the month of most rows where it is another), ``VACIO``.
    """
    told = profiles.join(declared.select("ruta", "tienda", "anio_mes", "sin_header", "columnas_descartar", "copia_de").dropDuplicates(["ruta"]), "ruta")
    for column, value in (("tienda", shop), ("anio_mes", month)):
        told = told if value is None else told.where(F.col(column) == value)
    told = told if until is None else told.where(F.col("anio_mes") <= until)
    empty = F.coalesce("filas", F.lit(0)) == 0
    other = F.when(F.col("mes_mayoritario") != F.col("anio_mes"), F.concat(F.lit("->"), F.col("mes_mayoritario"))).otherwise(F.lit(""))
    marks = F.array(
        F.when(F.coalesce("sin_header", F.lit(False)), "SIN_HEADER"),
        F.when(F.size(F.coalesce("columnas_descartar", F.array().cast("array<string>"))) > 0, F.concat(F.lit("DESCARTA:"), F.array_join("columnas_descartar", ","))),
        F.when(F.col("copia_de").isNotNull(), "SOSPECHA_COPIA"),
        F.when(F.col("fuera_de_mes") > 0, F.concat(F.lit("DESFASE_MES:"), F.col("fuera_de_mes").cast("string"), other)),
        F.when(empty, "VACIO"),
    )
    name = F.regexp_replace(F.element_at(F.split("ruta", "/"), -1), r"\.[^.]*$", ".parquet")
    place = F.concat(F.lit(target.rstrip("/")), F.lit("/tienda="), F.col("tienda"), F.lit("/anio_mes="), F.col("anio_mes"), F.lit("/"), name)
    return told.select("ruta", place.alias("destino"), F.when(empty, "omitir").otherwise("cargar").alias("accion"), F.when(empty, "sin filas").alias("motivo"), F.array_compact(marks).alias("marcas"))


def outcomes(decided: DataFrame, results: DataFrame, key: str = "ruta_origen") -> DataFrame:
    """How each decided file ended: ``key, version, desenlace, estado``; ``estado`` is what the manifest records.

    results: ``key, filas, escritas, error`` of the files that were loaded. ``saltado`` (nothing recorded), ``procesado`` (OK, or
    VACIO without rows), ``fallido``: ERROR where loading failed, and nothing recorded where rows were
    lost on the way, so that the file is tried again from the start.
    """
    told = decided.join(results.select(key, F.col("filas").alias("_f"), F.col("escritas").alias("_w"), F.col("error").alias("_e")), key, "left")
    skipped, failed = F.col("accion") == "omitir", F.col("_e").isNotNull()
    lost = ~F.col("_f").eqNullSafe(F.col("_w"))
    return told.select(
        key,
        "version",
        F.when(skipped, "saltado").when(failed | lost, "fallido").otherwise("procesado").alias("desenlace"),
        F.when(skipped, None).when(failed, "ERROR").when(lost, None).when(F.col("_f") == 0, "VACIO").otherwise("OK").alias("estado"),
    )


def next_batch(wanted: DataFrame, bank: DataFrame, key: str, size: int) -> DataFrame:
    """The next ``size`` rows whose key the bank lacks, in order of the key: the same at every run. The limit is the batch."""
    return wanted.dropDuplicates([key]).join(bank.select(key).distinct(), key, "left_anti").orderBy(key).limit(size)


def append_to_bank(bank: DataFrame, made: DataFrame, key: str, status: str) -> DataFrame:
    """Rows to append to a bank keyed by hash: those that came out without an error and that it lacks.

    A row with a status text, or without a key, stays out and so is asked for again. Existing rows are never replaced.
    """
    good = made.where((F.coalesce(status, F.lit("")) == "") & F.col(key).isNotNull()).dropDuplicates([key])
    return good.drop(status).join(bank.select(key).distinct(), key, "left_anti")
