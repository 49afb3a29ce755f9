"""Assembly of the loaded table: header variants, typed columns, quality flags, lineage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from criba.functions import csvline, keys, prices
from criba.functions.dates import parse_date
from criba.functions.text import is_blank, strip
from criba.operators import capture

# The exact headers of the known variants; V4 has no header and declares its columns.
VARIANTS = {
    "V1": "SKU,URL_PRODUCTO,Producto,Precio_Actual,Precio_Oferta,URL_IMAGEN,Fecha_Hora_Captura,Tienda",
    "V2": "SKU,URL_PRODUCTO,PRODUCTO,PRECIO_ACTUAL,PRECIO_OFERTA,URL_IMAGEN,FECHA,TIENDA",
    "V3": "SKU,URL_Producto,Producto,Precio_Normal,Precio_Oferta,URL_IMAGEN,Fecha_Hora_Captura,Tienda",
    "V5": "SKU,URL_PRODUCTO,PRODUCTO,PRECIO_ACTUAL,PRECIO_OFERTA,URL_IMAGEN,FECHA,TIENDA,NDF",
    "V6": "SKU,URL_PRODUCTO,Producto,Precio_Actual,Precio_Oferta,URL_IMAGEN,Fecha,Tienda",
}

# The columns of the loaded table, in order.
COLUMNS = (
    "tienda", "anio_mes", "sku", "url_producto", "producto", "url_imagen", "precio_actual", "precio_oferta", "fecha_captura",
    "sku_raw", "precio_actual_raw", "precio_oferta_raw", "fecha_captura_raw", "tienda_raw", "calidad_flags", "precio_parse_ok", "fecha_parse_ok",
    "sku_es_centinela", "fila_vacia", "desfase_mes", "anio_mes_dato", "_archivo_origen", "_md5_origen", "_variante_schema", "_fila_num", "_ingestado_en",
)


class SchemaError(ValueError):
    """Files whose header is of no known variant, named with the reason."""


def header_variants(files: DataFrame) -> DataFrame:
    """``ruta, variante, error`` of declared files; ``error`` is null where the file can be loaded.

    files: ``ruta, sin_header, columnas, columnas_descartar, primera_linea``. A header must
    equal a known one to the letter; a file without header is V4 and its first line must have as many
    cells as columns are declared. Of the errors the first that applies stands: ``sin_encabezado``,
    ``ancho``, ``desconocido``, ``sin_equivalente:<columna>`` (neither canonical nor declared
    dropped), ``repetida:<canonica>``, ``faltan:<canonicas>``.
    """
    declared = capture.declared_columns(files)
    bare = F.coalesce("sin_header", F.lit(False))
    header = F.array_join(F.transform(csvline.cells("primera_linea"), strip), ",")
    variant = F.lit(None).cast("string")
    for name, text in VARIANTS.items():
        variant = F.when(header == text, name).otherwise(variant)
    variant = F.when(bare, "V4").otherwise(variant)
    kept = F.filter("nombres", lambda n: ~F.array_contains(F.col("descartes"), n))
    roles = F.transform(kept, capture.role_by_name)
    told = declared.withColumn("_kept", kept).withColumn("_roles", roles).withColumn("variante", variant)
    odd = F.try_element_at(F.filter(F.arrays_zip("_kept", "_roles"), lambda x: x["_roles"].isNull()), F.lit(1))["_kept"]
    twice = F.try_element_at(F.filter(F.array_distinct("_roles"), lambda r: F.size(F.filter("_roles", lambda x: x == r)) > 1), F.lit(1))
    absent = F.array_except(F.array(*[F.lit(c) for c in capture.CANONICAL]), F.coalesce("_roles", F.array().cast("array<string>")))
    error = (
        F.when(~bare & is_blank("primera_linea"), "sin_encabezado")
        .when(bare & F.col("primera_linea").isNotNull() & (F.size(csvline.cells("primera_linea")) != F.size("nombres")), "ancho")
        .when(F.col("variante").isNull(), "desconocido")
        .when(odd.isNotNull(), F.concat(F.lit("sin_equivalente:"), odd))
        .when(twice.isNotNull(), F.concat(F.lit("repetida:"), twice))
        .when(F.size(absent) > 0, F.concat(F.lit("faltan:"), F.array_join(absent, ",")))
    )
    return told.select("ruta", "variante", error.alias("error"))


def loadable(variants: DataFrame, shown: int = 20) -> DataFrame:
    """``ruta, variante``; raises SchemaError naming files (the first so many) that can't be loaded."""
    bad = [f"{r['ruta']}: {r['error']}" for r in variants.where("error is not null").orderBy("ruta").limit(shown).collect()]
    if bad:
        raise SchemaError("; ".join(bad))
    return variants.select("ruta", "variante")


def row_flags(empty: Column, copied: Column | None = None, sku: str = "sku_raw", price: str = "precio_actual_raw", sale: str = "precio_oferta_raw", date: str = "fecha_captura_raw") -> Column:
    """Quality flags of a row in their fixed order, each once.

    ``FILA_VACIA, SKU_CENTINELA``, those of the price, those of the sale price,
    ``FECHA_NO_PARSEABLE``, and ``SOSPECHA_COPIA`` for rows of a file declared a copy.
    """
    flag = lambda test, name: F.array_compact(F.array(F.when(test, name)))
    own = F.array_distinct(F.concat(flag(empty, "FILA_VACIA"), flag(keys.sku_is_sentinel(sku), "SKU_CENTINELA"), prices.price_flags(price), prices.price_flags(sale), flag(parse_date(date).isNull(), "FECHA_NO_PARSEABLE")))
    return own if copied is None else F.concat(own, flag(F.coalesce(copied, F.lit(False)), "SOSPECHA_COPIA"))


def assembled(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of text columns as the 26 columns of the loaded table, none left out.

    rows: ``_archivo_origen, _fila_num``, the eight canonical columns as text (null where a
    short row ends before them), ``_md5_origen`` and ``_ingestado_en``. files: ``ruta, tienda, anio_mes, copia_de,
    variante``. Prices are decimal, the date a wall-clock timestamp; ``precio_parse_ok`` holds where
    both prices read. A row without a date claims no ``desfase_mes``. Rows of files not declared keep null declarations.
    """
    told = files.dropDuplicates(["ruta"]).select(F.col("ruta").alias("_archivo_origen"), F.col("tienda").alias("_t"), "anio_mes", F.col("copia_de").isNotNull().alias("_copia"), F.col("variante").alias("_variante_schema"))
    raw = {c: F.coalesce(F.col(c), F.lit("")) for c in capture.CANONICAL}
    joined = rows.join(told, "_archivo_origen", "left").select(
        "_archivo_origen", "_fila_num", "_md5_origen", "_ingestado_en", F.col("_t"), "anio_mes", "_copia", "_variante_schema",
        *[raw[c].alias(capture.LOADED_TEXT[c]) for c in capture.CANONICAL],
    )
    empty = reduce(Column.__and__, [is_blank(c) for c in capture.LOADED_TEXT.values()])
    reads = lambda c: prices.parse_price(c).isNotNull()
    typed = joined.withColumns(
        {
            "fila_vacia": empty,
            "sku": keys.parse_sku("sku_raw"),
            "precio_actual": prices.parse_price("precio_actual_raw"),
            "precio_oferta": prices.parse_price("precio_oferta_raw"),
            "fecha_captura": parse_date("fecha_captura_raw"),
            "precio_parse_ok": reads("precio_actual_raw") & reads("precio_oferta_raw"),
            "sku_es_centinela": keys.sku_is_sentinel("sku_raw"),
        }
    )
    month = F.date_format("fecha_captura", "yyyy-MM")
    done = typed.withColumns(
        {
            "tienda": F.col("_t"),
            "calidad_flags": row_flags(F.col("fila_vacia"), F.col("_copia")),
            "fecha_parse_ok": F.col("fecha_captura").isNotNull(),
            "anio_mes_dato": month,
            "desfase_mes": F.coalesce(month != F.col("anio_mes"), F.lit(False)),
        }
    )
    return done.select(*COLUMNS)
