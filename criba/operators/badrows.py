"""Rows that fail to parse: valid rows loaded, the rest set aside with every reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from criba.functions.dates import parse_date
from criba.functions.prices import price_unreadable
from criba.functions.text import is_blank
from criba.operators import capture


def _reasons(*tests: tuple[Column, str]) -> Column:
    """Array of the names whose test holds; a test that can't be told does not hold."""
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for test, name in tests]))


def checked_rows(files: DataFrame, loaded: DataFrame, lines: DataFrame, stores: DataFrame) -> DataFrame:
    """Every data row, loaded or not, as text with ``errores``: an array of reasons.

    A row has exactly one of these reasons: ``fila_vacia`` (all cells blank), else
    ``comillas`` (broken quoting), else ``columnas`` (not as many cells as the file
    has columns); or else one for each of ``precio_actual`` and ``fecha_captura``
    that can't be read. Texts that say there is no price are fine, a blank date is
    not; a column that the file lacks is not judged. Lines of a file of unknown
    columns are judged by their blanks and quotes only. Recorded parse flags are
    not consulted. Rows with an empty array are valid.
    """
    date_bad = lambda c: F.coalesce(parse_date(c).isNull(), F.lit(True))
    held = capture.loaded_cells(loaded)
    # array() over blank tests is cheaper than joining the texts.
    empty = F.lit(True)
    for c in capture.CANONICAL:
        empty = empty & is_blank(c)
    of_loaded = held.withColumn(
        "errores",
        F.when(empty, F.array(F.lit("fila_vacia"))).otherwise(
            _reasons((price_unreadable("precio_actual"), "precio_actual"), (date_bad("fecha_captura"), "fecha_captura"))
        ),
    )
    laid = capture.canonical_cells(lines, capture.column_roles(lines, capture.file_layouts(lines, files), stores))
    of_lines = laid.withColumn(
        "errores",
        F.when(F.forall("celdas", lambda c: is_blank(c)), F.array(F.lit("fila_vacia")))
        .when(F.col("comillas"), F.array(F.lit("comillas")))
        .when(F.size("celdas") != F.size("nombres"), F.array(F.lit("columnas")))
        .otherwise(
            _reasons(
                (F.col("pos_precio_actual").isNotNull() & price_unreadable("precio_actual"), "precio_actual"),
                (F.col("pos_fecha_captura").isNotNull() & date_bad("fecha_captura"), "fecha_captura"),
            )
        ),
    )
    columns = ["_archivo_origen", "_fila_num", *capture.CANONICAL, "errores"]
    return of_loaded.select(columns).unionByName(of_lines.select(columns))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("errores") == 0).drop("errores")


def quarantined(checked: DataFrame) -> DataFrame:
    """A row for each reason of each row set aside: ``_archivo_origen, _fila_num, motivo``."""
    return checked.select("_archivo_origen", "_fila_num", F.explode("errores").alias("motivo"))
