"""Capture files: their columns, what each column holds, and their rows as text.

A file is declared with its header (or, headerless, with its columns). The
columns of any file map to the eight canonical ones by known names first and,
for names never seen, by what their cells hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from criba.functions import csvline
from criba.functions.dates import parse_date, value_kind
from criba.functions.prices import price_digits
from criba.functions.text import bind, column_name, fold_accents, is_blank, squeeze, strip

CANONICAL = ("sku", "url_producto", "producto", "precio_actual", "precio_oferta", "url_imagen", "fecha_captura", "tienda")

#: Kinds of filled values; of kinds equally frequent the first stands.
VALUE_KINDS = ("numero", "fecha", "fecha_hora", "texto")

# Names under which the canonical columns are known, in normal form.
KNOWN_NAMES = {
    "sku": ("sku",),
    "url_producto": ("url_producto",),
    "producto": ("producto",),
    "precio_actual": ("precio_actual", "precio_normal"),
    "precio_oferta": ("precio_oferta",),
    "url_imagen": ("url_imagen",),
    "fecha_captura": ("fecha_captura", "fecha_hora_captura", "fecha"),
    "tienda": ("tienda",),
}


def role_by_name(name: Column) -> Column:
    """Canonical column that a normal-form name is known for, else null."""
    role = F.lit(None).cast("string")
    for canonical, names in KNOWN_NAMES.items():
        role = F.when(name.isin(*names), canonical).otherwise(role)
    return role


def declared_columns(files: DataFrame) -> DataFrame:
    """``files`` with ``nombres`` and ``descartes``: the normal-form column names of each file, in order, and those declared dropped.

    They come from the first line, or from ``columnas`` where the file has no
    header. A file without either has an empty array.
    """
    header = F.when(~F.coalesce("sin_header", F.lit(False)) & ~is_blank("primera_linea"), csvline.cells("primera_linea"))
    plain = lambda names: F.transform(F.coalesce(*names, F.array().cast("array<string>")), lambda n: F.coalesce(column_name(n), F.lit("")))
    dropped = F.col("columnas_descartar") if "columnas_descartar" in files.columns else F.lit(None).cast("array<string>")
    return files.withColumn("nombres", plain([header, F.col("columnas")])).withColumn("descartes", plain([dropped]))


def file_layouts(lines: DataFrame, files: DataFrame) -> DataFrame:
    """One row a file that has captured lines or is declared: ``_archivo_origen, dicho, espera, con_filas, nombres, papeles``.

    ``dicho`` is the declaration (serie, anio_mes, tienda, nombres, descartes), null for a file
    without one, of several the greatest, whole; ``espera`` tells that the file has captured lines, so is not loaded
    yet, ``con_filas`` that data lines are among them. ``nombres`` are the columns of
    the file's own header line, else of its declaration; null where neither tells.
    ``papeles`` is the role that each name gives its column: a canonical column,
    ``otra`` for a column declared dropped, else null.
    """
    told = declared_columns(files).select(F.col("ruta").alias("_archivo_origen"), F.struct("serie", "anio_mes", "tienda", "nombres", "descartes").alias("dicho"))
    own = lines.select("_archivo_origen", F.when(F.col("_fila_num") == 0, F.col("linea")).alias("cabeza"), F.lit(True).alias("espera"), (F.col("_fila_num") > 0).alias("con_filas"))
    # One aggregation of both, without a join: the plans that follow read its result twice.
    every = (
        own.unionByName(told, allowMissingColumns=True)
        .groupBy("_archivo_origen")
        .agg(F.max("dicho").alias("dicho"), F.min("cabeza").alias("cabeza"), *[F.coalesce(F.max(c), F.lit(False)).alias(c) for c in ("espera", "con_filas")])
    )
    names = F.coalesce(F.transform(csvline.cells("cabeza"), column_name), F.when(F.size("dicho.nombres") > 0, F.col("dicho.nombres")))
    dropped = F.coalesce("dicho.descartes", F.array().cast("array<string>"))
    return every.select("_archivo_origen", "dicho", "espera", "con_filas", names.alias("nombres")).withColumn(
        "papeles", F.transform("nombres", lambda n: F.when(F.array_contains(dropped, n), "otra").otherwise(role_by_name(n)))
    )


def raw_records(lines: DataFrame, layouts: DataFrame) -> DataFrame:
    """Data lines of files not loaded yet with their cells and the columns of ``layouts``.

    lines: ``_archivo_origen, _fila_num, linea``; line 0 is a header. Result:
    ``_archivo_origen, _fila_num, comillas`` (quoting broken), ``celdas`` (null
    where broken) and what ``layouts`` tells of the file, null for an unknown one.
    """
    broken = csvline.quoting_broken("linea")
    return (
        lines.where("_fila_num > 0")
        .select(
            "_archivo_origen",
            "_fila_num",
            broken.alias("comillas"),
            F.when(~broken, F.coalesce(csvline.cells("linea"), F.array(F.lit("")))).alias("celdas"),
        )
        .join(layouts, "_archivo_origen", "left")
    )


def _is_image(text: Column) -> Column:
    return text.rlike(r"(?i)\Ahttps?://\S+\.(jpe?g|png|webp|gif)(\?\S*)?\z")


def column_profiles(lines: DataFrame, layouts: DataFrame, stores: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """What the columns of files not loaded yet hold: one row a file, ``_archivo_origen, perfiles``.

    Looked at are the columns whose name gives no role and, for the kinds of their
    values, those whose name gives a role of ``also``. ``perfiles`` has for each
    ``pos, suelta`` (no role by name), ``llenas`` (filled cells), ``media``, the most frequent
    kind of content ``tipo`` with its share ``parte``, and ``valores``, the number of values of each of
    ``VALUE_KINDS`` (null without ``also``).
    """
    same = lambda c: F.lower(fold_accents(squeeze(c)))
    known = stores.select(F.col("tienda_slug").alias("tienda"), same("tienda_nombre").alias("tienda_nombre")).dropDuplicates(["tienda"])
    looked = F.array_compact(F.transform("papeles", lambda r, i: F.when(r.isNull() | r.isin(*also), F.struct(i.alias("pos"), r.isNull().alias("suelta")))))
    named = layouts.select("_archivo_origen", "nombres", F.col("dicho.tienda").alias("tienda"), looked.alias("miradas")).join(known, "tienda", "left")
    cell, loose = F.col("celda"), F.col("suelta")
    kinds = {
        "url_imagen": _is_image(cell),
        "url_producto": cell.rlike(r"(?i)\Ahttps?://\S+\z") & ~_is_image(cell),
        "fecha_captura": parse_date(cell).isNotNull(),
        "tienda": same(cell).isin(F.col("tienda_slug"), F.col("tienda_nombre")),
        "precio": price_digits(cell).isNotNull() & cell.rlike(r"[.,$]"),
        "sku": cell.rlike(r"\A[A-Za-z]?\d{5,14}\z"),
        "producto": cell.rlike(r"\p{L}{3}.*\s.*\d") & ~cell.rlike(r"(?i)\Ahttps?://"),
    }
    cells = F.transform("miradas", lambda m: F.struct(m["pos"].alias("pos"), m["suelta"].alias("suelta"), strip(F.get("celdas", m["pos"])).alias("celda")))
    counted = (
        raw_records(lines, named.select("_archivo_origen", "nombres", "miradas", same("tienda").alias("tienda_slug"), "tienda_nombre"))
        .where("celdas is not null and size(celdas) = size(nombres)")
        .select("_archivo_origen", "tienda_slug", "tienda_nombre", F.explode(cells).alias("x"))
        .select("_archivo_origen", "tienda_slug", "tienda_nombre", "x.*")
        .where("celda <> ''")
        .withColumn("valor", value_kind(cell) if also else F.lit(None).cast("string"))
        .groupBy("_archivo_origen", "pos", "suelta")
        .agg(
            F.count("*").alias("llenas"),
            F.avg(F.when(loose, price_digits(cell).try_cast("double"))).alias("media"),
            *[F.count_if(loose & test).alias(f"n_{k}") for k, test in kinds.items()],
            *[F.count_if(F.col("valor") == k).alias(f"v_{k}") for k in VALUE_KINDS if also],
        )
    )
    best = F.array_max(F.array(*[F.struct((F.col(f"n_{k}") / F.col("llenas")).alias("parte"), F.lit(k).alias("tipo")) for k in kinds]))
    values = F.array(*[F.col(f"v_{k}") for k in VALUE_KINDS]) if also else F.lit(None).cast("array<bigint>")
    return (
        counted.select("_archivo_origen", "pos", "suelta", "llenas", "media", best.alias("m"), values.alias("valores"))
        .groupBy("_archivo_origen")
        .agg(F.collect_list(F.struct("pos", "suelta", "llenas", "media", "m.parte", "m.tipo", "valores")).alias("perfiles"))
    )


def _by_content() -> Column:
    """Position, by content, of each of ``CANONICAL`` in order; null where none is told. Of ``papeles`` and ``perfiles``."""
    told = F.filter("perfiles", lambda p: p["suelta"] & (p["parte"] >= 0.6))
    free = lambda role: ~F.array_contains(F.array_compact(F.col("papeles")), role)

    def ranked(kind: str) -> Column:
        """Columns of one kind as sortable entries, the best one least."""
        own = F.filter(told, lambda p: p["tipo"] == kind)
        share = lambda p: F.lit(0.0) if kind == "precio" else -p["parte"]
        return F.transform(own, lambda p: F.struct(share(p).alias("parte"), (-p["llenas"]).alias("llenas"), F.coalesce(-p["media"], F.lit(float("inf"))).alias("media"), p["pos"].alias("pos")))

    prices = F.array_sort(ranked("precio"))
    first = {
        "precio_actual": F.get(prices, F.lit(0))["pos"],
        "precio_oferta": F.get(prices, F.when(free("precio_actual"), 1).otherwise(0))["pos"],
    }
    return F.array(*[F.when(free(c), first[c] if c in first else F.array_min(ranked(c))["pos"]) for c in CANONICAL])


def column_roles(lines: DataFrame, layouts: DataFrame, stores: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """``layouts`` with what each column holds: ``roles``, in the order of ``nombres``, and the ``perfiles`` of ``column_profiles``.

    A role is a canonical column, ``otra`` (declared dropped), or null where neither
    name nor content tells. In files not loaded yet content speaks for unknown names: the kind of at least
    60 % of the filled cells decides, among the canonical columns that no known name
    took; of several columns of one kind the one with the larger such share goes first, of two price
    columns the one filled more often, then the dearer one, is ``precio_actual``.

    Of a loaded file the loader has put all eight canonical columns under their names, so an
    unknown name stands for one that no known name took: where a file has as many of
    the one as of the other they pair in order, else they stay untold.
    """
    untold = F.array_compact(F.transform("papeles", lambda r, i: F.when(r.isNull(), i)))
    every = F.array(*[F.lit(c) for c in CANONICAL])
    pairs = layouts.join(column_profiles(lines, layouts, stores, also), "_archivo_origen", "left").select(
        *layouts.columns, "perfiles", _by_content().alias("vistas"), untold.alias("sueltas"), F.array_except(every, F.col("papeles")).alias("libres")
    )
    # Entry i of "de" is the role of the column whose position is entry i of "lugares".
    told = pairs.select(
        *layouts.columns,
        "perfiles",
        F.when(F.col("espera"), F.col("vistas")).when(F.size("sueltas") == F.size("libres"), F.col("sueltas")).alias("lugares"),
        F.when(F.col("espera"), every).otherwise(F.col("libres")).alias("de"),
    )
    guess = lambda i: F.get("de", F.array_position("lugares", i) - 1)
    return told.select(*layouts.columns, "perfiles", F.transform("papeles", lambda r, i: F.coalesce(r, guess(i))).alias("roles"))


def position_of(role: str) -> Column:
    """Cell position of the first column of a role in ``roles``; null where the file lacks one."""
    return F.nullif(F.array_position("roles", role), F.lit(0)) - 1


def canonical_cells(lines: DataFrame, roles: DataFrame) -> DataFrame:
    """Data lines under the canonical names: text of each column, null where it can't be told.

    A column the file lacks is null; so are all columns of a row with broken
    quoting or another number of cells than its file has columns.
    """
    whole = F.col("celdas").isNotNull() & (F.size("celdas") == F.size("nombres"))
    at = raw_records(lines, roles.select("_archivo_origen", "nombres", *[position_of(c).alias(f"pos_{c}") for c in CANONICAL]))
    return at.select(
        "_archivo_origen",
        "_fila_num",
        "comillas",
        "celdas",
        "nombres",
        *[F.when(whole, F.get("celdas", F.col(f"pos_{c}"))).alias(c) for c in CANONICAL],
        *[F.col(f"pos_{c}") for c in ("precio_actual", "fecha_captura")],
    )


LOADED_TEXT = {
    "sku": "sku_raw",
    "url_producto": "url_producto",
    "producto": "producto",
    "precio_actual": "precio_actual_raw",
    "precio_oferta": "precio_oferta_raw",
    "url_imagen": "url_imagen",
    "fecha_captura": "fecha_captura_raw",
    "tienda": "tienda_raw",
}


def loaded_cells(loaded: DataFrame) -> DataFrame:
    """Rows of loaded files as captured: the canonical columns as text."""
    return loaded.select("_archivo_origen", "_fila_num", *[F.col(raw).alias(c) for c, raw in LOADED_TEXT.items()])


def kind_counts(cells: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Number of values of each of ``VALUE_KINDS``, in their order, per file and column: ``_archivo_origen, valores_<column>``."""
    kinds = cells.select("_archivo_origen", *[value_kind(c).alias(c) for c in columns])
    counted = kinds.groupBy("_archivo_origen").agg(*[F.count_if(F.col(c) == k).alias(f"{c}_{k}") for c in columns for k in VALUE_KINDS])
    return counted.select("_archivo_origen", *[F.array(*[F.col(f"{c}_{k}") for k in VALUE_KINDS]).alias(f"valores_{c}") for c in columns])


def most_frequent(*counts: Column) -> Column:
    """The kind of ``VALUE_KINDS`` that arrays of counts add up highest for; null where no value is filled. A null array counts nothing."""
    none = F.array(*[F.lit(0).cast("bigint") for _ in VALUE_KINDS])
    totals = none
    for c in counts:
        totals = F.zip_with(totals, F.coalesce(c, none), lambda a, b: a + b)
    ranked = F.array_max(F.transform(totals, lambda n, i: F.struct(n.alias("n"), (-i).alias("orden"))))
    return bind(ranked, lambda m: F.when(m["n"] > 0, F.get(F.array(*[F.lit(k) for k in VALUE_KINDS]), -m["orden"])))
