"""Validated settings and inventories: what is wrong is named before any work starts."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence
from typing import Any, TypeVar

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from criba.functions.calendar import month_of_path, valid_month
from criba.functions.text import is_blank

T = TypeVar("T")


class ConfigError(ValueError):
    """A setting or declaration that can't be used, named in the message."""


@dataclasses.dataclass(frozen=True)
class LoadSettings:
    """Where captures come from and where layers go; all are texts and none may be blank."""

    carpeta_capturas: str
    carpeta_crudo: str
    carpeta_bronce: str
    prefijo: str
    anio_mes_maximo: str

    def __post_init__(self) -> None:
        try:
            valid_month(self.anio_mes_maximo)
        except ValueError:
            raise ConfigError(f"anio_mes_maximo: {self.anio_mes_maximo!r} is no yyyy-MM") from None
        if self.prefijo.startswith("/"):
            raise ConfigError(f"prefijo: {self.prefijo!r} must be relative")

    def table(self, layer: str, name: str) -> str:
        """Folder of a table in a layer, ``crudo`` or ``bronce``: names are taken as they are."""
        base = {"crudo": self.carpeta_crudo, "bronce": self.carpeta_bronce}[layer]
        return f"{base.rstrip('/')}/{self.prefijo.strip('/')}/{name}"


def settings(raw: Any, kind: type[T]) -> T:
    """A dataclass of texts from a mapping; keys missing, unknown, of another type or blank raise ConfigError by name."""
    if not isinstance(raw, Mapping):
        raise ConfigError(f"a mapping was expected, not {type(raw).__name__}")
    wanted = [f.name for f in dataclasses.fields(kind)]
    faults = [(f"missing: {', '.join(sorted(set(wanted) - set(raw)))}", set(wanted) - set(raw)), (f"unknown: {', '.join(sorted(set(raw) - set(wanted)))}", set(raw) - set(wanted))]
    for text, found in faults:
        if found:
            raise ConfigError(text)
    for name in wanted:
        if not isinstance(raw[name], str):
            raise ConfigError(f"{name}: a text was expected, not {type(raw[name]).__name__}")
        if not raw[name].strip():
            raise ConfigError(f"{name}: blank")
    return kind(**{name: raw[name].strip() for name in wanted})


def inventory_faults(files: DataFrame) -> DataFrame:
    """``ruta, falta`` for every fault of declared files, none for a sound inventory.

    ``sin_ruta``, ``sin_tienda`` and ``sin_mes`` (blank), ``repetida`` (declared more than once), ``mes_de_carpeta`` (month and
    folder disagree), ``sin_columnas`` (no header and no columns declared), ``copia_desconocida`` (``copia_de`` names
    no declared file), ``destino`` (another path of the same shop, month and file name). All
    files are judged at once, in parallel.
    """
    name = F.element_at(F.split("ruta", "/"), -1)
    known = files.select(F.col("ruta").alias("copia_de")).where("copia_de is not null").distinct().withColumn("_hay", F.lit(True))
    times = Window.partitionBy("ruta")
    target = Window.partitionBy("tienda", "anio_mes", "_n")
    told = files.withColumn("_n", name).withColumn("_veces", F.count("*").over(times)).join(known, "copia_de", "left")
    told = told.withColumn("_otra", F.min("ruta").over(target) != F.max("ruta").over(target))
    tests = {
        "sin_ruta": is_blank("ruta"),
        "sin_tienda": is_blank("tienda"),
        "sin_mes": is_blank("anio_mes"),
        "repetida": ~is_blank("ruta") & (F.col("_veces") > 1),
        "mes_de_carpeta": ~is_blank("ruta") & ~is_blank("anio_mes") & ~F.coalesce(month_of_path("ruta") == F.col("anio_mes"), F.lit(False)),
        "sin_columnas": F.coalesce("sin_header", F.lit(False)) & (F.size(F.coalesce("columnas", F.array().cast("array<string>"))) == 0),
        "copia_desconocida": F.col("copia_de").isNotNull() & F.col("_hay").isNull(),
        "destino": F.coalesce("_otra", F.lit(False)),
    }
    faults = F.array_compact(F.array(*[F.when(test, F.lit(n)) for n, test in tests.items()]))
    return told.select("ruta", F.explode(faults).alias("falta")).distinct()


def sound_inventory(files: DataFrame, shown: int = 20) -> DataFrame:
    """The inventory itself; raises ConfigError naming its faults, the first so many."""
    bad = [f"{r['ruta']}: {r['falta']}" for r in inventory_faults(files).orderBy("ruta", "falta").limit(shown).collect()]
    if bad:
        raise ConfigError("; ".join(bad))
    return files


def text_variant(variant: str, columns: Mapping[str, Sequence[str]]) -> Sequence[str]:
    """The columns that a named variant of entity texts is made of; an unknown variant raises ConfigError."""
    if variant not in columns:
        raise ConfigError(f"variant {variant!r}; known: {', '.join(sorted(columns))}")
    return columns[variant]
