"""Schemas that drift between files: one consistent table and a log of every change."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from criba.functions.dates import parse_date
from criba.functions.prices import parse_price
from criba.functions.text import strip
from criba.operators import capture

TYPED = ("precio_actual", "precio_oferta", "fecha_captura")

# The lattice of kinds. Each kind with the kinds it can be read as, itself first.
LATTICE = {
    "vacio": ("vacio", "numero", "fecha", "fecha_hora", "texto"),
    "numero": ("numero", "texto"),
    "fecha": ("fecha", "fecha_hora", "texto"),
    "fecha_hora": ("fecha_hora", "texto"),
    "texto": ("texto",),
}


def promote(a: str | None, b: str | None) -> str | None:
    """Least kind that both kinds can be read as; an unknown kind (None) gives way."""
    if a is None or b is None:
        return a or b
    return next(k for k in LATTICE[a] if k in LATTICE[b])


def fold_kinds(kinds: Column) -> Column:
    """``promote`` over an array of kinds, inside the plan; null for none."""
    pairs = F.create_map(*[F.lit(x) for a in LATTICE for b in LATTICE for x in (f"{a}+{b}", promote(a, b))])
    step = lambda acc, k: F.when(acc.isNull(), k).when(k.isNull(), acc).otherwise(F.try_element_at(pairs, F.concat(acc, F.lit("+"), k)))
    return F.aggregate(kinds, F.lit(None).cast("string"), step)


def file_schemas(files: DataFrame, loaded: DataFrame, lines: DataFrame, stores: DataFrame) -> DataFrame:
    """Schema of every file that is declared or has rows.

    One row a file: ``ruta, serie, anio_mes, columnas`` (array of nombre and rol in
    order) and ``tipos`` (kinds of most values by canonical column). Headers are
    parsed in the plan, in parallel; kinds come from one aggregation over the rows
    of loaded files and one over the lines of those not loaded yet, which also counts
    what tells the columns of unknown names. The plan is kept short: the driver
    holds, optimizes and compiles all of it, whatever the input's size.
    """
    roles = capture.column_roles(lines, capture.file_layouts(lines, files), stores, TYPED)
    held = capture.kind_counts(capture.loaded_cells(loaded), TYPED)
    columns = F.when(F.col("dicho").isNotNull(), F.transform("nombres", lambda n, i: F.struct(n.alias("nombre"), F.get("roles", i).alias("rol"))))
    none = F.array().cast("array<struct<nombre:string,rol:string>>")
    of_lines = lambda c: F.get(F.filter("perfiles", lambda p: p["pos"] == capture.position_of(c)), F.lit(0))["valores"]
    return (
        roles.join(held.withColumn("cargado", F.lit(True)), "_archivo_origen", "full")
        .where("dicho is not null or con_filas or cargado")
        .select(
            F.col("_archivo_origen").alias("ruta"),
            "dicho.serie",
            "dicho.anio_mes",
            F.coalesce(columns, none).alias("columnas"),
            F.struct(*[capture.most_frequent(F.col(f"valores_{c}"), of_lines(c)).alias(c) for c in TYPED]).alias("tipos"),
        )
    )


def changes(schemas: DataFrame) -> DataFrame:
    """Ordered differences between each file and the serie's file of the month before.

    Result: ``ruta, serie, anio_mes, cambio, columna, antes``. ``cambio`` is
    ``agregada``, ``eliminada``, ``renombrada`` (another name for the same canonical
    column) or ``tipo`` (another kind of most values in a price or date column).
    ``columna`` is the name in ``ruta``, for ``eliminada`` the former one; ``antes``
    the former name or kind. Order, case and accents are no change, nor is a kind
    that either file can't tell. The first file of a serie has no changes; files
    without a serie are not compared.
    """
    line = Window.partitionBy("serie").orderBy("anio_mes", "ruta")
    paired = (
        schemas.where("serie is not null")
        .withColumn("antes", F.lag(F.struct("columnas", "tipos")).over(line))
        .where("antes is not null")
    )
    names = lambda columns: F.transform(columns, lambda c: c["nombre"])
    fresh = F.filter("columnas", lambda c: ~F.array_contains(names(F.col("antes.columnas")), c["nombre"]))
    gone = F.filter(F.col("antes.columnas"), lambda c: ~F.array_contains(names(F.col("columnas")), c["nombre"]))
    # A column of a known role pairs with the vanished one of the same role.
    twin = lambda c, others: F.try_element_at(F.filter(others, lambda o: (o["rol"] == c["rol"]) & (c["rol"] != "otra")), F.lit(1))
    entry = lambda kind, column, before: F.struct(kind.alias("cambio"), column.alias("columna"), before.alias("antes"))
    of_fresh = F.transform(
        "nuevas",
        lambda c: entry(
            F.when(twin(c, F.col("idas")).isNull(), F.lit("agregada")).otherwise(F.lit("renombrada")),
            c["nombre"],
            twin(c, F.col("idas"))["nombre"],
        ),
    )
    of_gone = F.transform(
        F.filter("idas", lambda c: twin(c, F.col("nuevas")).isNull()),
        lambda c: entry(F.lit("eliminada"), c["nombre"], c["nombre"]),
    )
    # The lambda takes its canonical name from a closure: a second parameter would be an index.
    held_in = lambda canonical: F.try_element_at(F.filter("columnas", lambda x: x["rol"] == canonical), F.lit(1))["nombre"]
    of_kind = [
        F.when(F.col(f"tipos.{c}") != F.col(f"antes.tipos.{c}"), entry(F.lit("tipo"), held_in(c), F.col(f"antes.tipos.{c}")))
        for c in TYPED
    ]
    return (
        paired.withColumn("nuevas", fresh)
        .withColumn("idas", gone)
        .select("ruta", "serie", "anio_mes", F.explode(F.concat(of_fresh, of_gone, F.array_compact(F.array(*of_kind)))).alias("x"))
        .select("ruta", "serie", "anio_mes", "x.*")
        .where("columna is not null")
    )


def union_schema(schemas: DataFrame) -> DataFrame:
    """Kind of each typed canonical column over all files, folded through the lattice.

    The kinds found are first reduced to a set, so the fold never sees more than
    five of them. One row a column: ``columna, tipo, variantes`` (number of kinds).
    """
    rows = [schemas.select(F.lit(c).alias("columna"), F.col(f"tipos.{c}").alias("tipo")) for c in TYPED]
    kinds = reduce(DataFrame.unionByName, rows).groupBy("columna").agg(F.array_sort(F.collect_set("tipo")).alias("t"))
    return kinds.select("columna", fold_kinds(F.col("t")).alias("tipo"), F.size("t").cast("bigint").alias("variantes"))


#: How a captured text is read as each kind; a text is itself.
_READ = {
    "numero": parse_price,
    "fecha": lambda c: parse_date(c).cast("date"),
    "fecha_hora": parse_date,
    "texto": lambda c: strip(c),
    "vacio": lambda c: F.lit(None).cast("string"),
}


def consistent_rows(files: DataFrame, loaded: DataFrame, lines: DataFrame, stores: DataFrame, schema: dict[str, str | None] | None = None) -> DataFrame:
    """All rows of all files under the canonical names, cast to the union schema.

    schema: the kind of each typed column; by default that of ``union_schema`` over all
    files, which is worked out first (three rows). A column of kind ``numero`` is
    decimal, ``fecha`` a date, ``fecha_hora`` a timestamp; where the files' kinds only meet in
    ``texto`` the column is the trimmed text, so that nothing is lost. What a column of any kind
    reads as is in ``*_leido`` (decimal or timestamp, null where unreadable), the text as captured in
    ``*_raw``. Rows that can't be laid out (broken quoting, wrong number of cells) keep
    their place with null columns.
    """
    if schema is None:
        schema = {r["columna"]: r["tipo"] for r in union_schema(file_schemas(files, loaded, lines, stores)).collect()}
    roles = capture.column_roles(lines, capture.file_layouts(lines, files), stores)
    columns = ["_archivo_origen", "_fila_num", *capture.CANONICAL]
    every = capture.loaded_cells(loaded).select(columns).unionByName(capture.canonical_cells(lines, roles).select(columns))
    cast = {c: _READ[schema.get(c) or "vacio"](c) for c in TYPED}
    return every.select(
        "_archivo_origen",
        "_fila_num",
        *[cast[c].alias(c) if c in cast else F.col(c) for c in capture.CANONICAL],
        *[parse_price(c).alias(f"{c}_leido") for c in ("precio_actual", "precio_oferta")],
        parse_date("fecha_captura").alias("fecha_captura_leido"),
        *[F.col(c).alias(f"{c}_raw") for c in TYPED],
    )
