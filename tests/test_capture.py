"""Broken rows and drifting schemas on small files written out by hand."""

import collections
import os

import pytest
from pyspark.sql import functions as F

from criba.functions import csvline
from criba.functions.text import column_name
from criba.operators import badrows, capture, drift

V1 = "SKU,URL_PRODUCTO,Producto,Precio_Actual,Precio_Oferta,URL_IMAGEN,Fecha_Hora_Captura,Tienda"
GOOD = '123456,https://a.example/p/x-123456,"Uno, 5 mg 10 Tabletas",10.50,,https://i.example/1.jpg,2025-01-05,Botica'
FILES = "ruta string, serie string, tienda string, anio_mes string, sin_header boolean, columnas array<string>, primera_linea string, nombres string"
LOADED = "_archivo_origen string, _fila_num bigint, sku_raw string, url_producto string, producto string, precio_actual_raw string, precio_oferta_raw string, url_imagen string, fecha_captura_raw string, tienda_raw string, comillas string"


@pytest.fixture
def tables(spark):
    def make(files=(), loaded=(), lines=(), stores=(("botica", "Botica"),)):
        return (
            spark.createDataFrame(list(files), FILES),
            spark.createDataFrame(list(loaded), LOADED),
            spark.createDataFrame(list(lines), "_archivo_origen string, _fila_num bigint, linea string, celdas int"),
            spark.createDataFrame(list(stores), "tienda_slug string, tienda_nombre string"),
        )

    return make


@pytest.mark.parametrize(
    "line,broken,cells",
    [
        ("a,b", False, ["a", "b"]),
        ("", False, [""]),
        (",,", False, ["", "", ""]),
        ('"a,b",c', False, ["a,b", "c"]),
        ('"say ""hi""",x', False, ['say "hi"', "x"]),
        ('"",x', False, ["", "x"]),
        ('"two\nlines",x', False, ["two\nlines", "x"]),
        ('"""",x', False, ['"', "x"]),
        ('"open,x', True, None),
        ('"a"b,x', True, None),
        ('"a" ,x', True, None),
        ('x,"a"b', True, None),
        ('x,"a" "', True, None),
        (None, False, None),
    ],
)
def test_csv_cells(spark, line, broken, cells):
    df = spark.createDataFrame([(line,)], "l string")
    row = df.select(csvline.quoting_broken("l").alias("b"), csvline.cells("l").alias("c")).first()
    assert row.b == broken
    if not broken:
        assert row.c == cells


def test_reasons(spark, tables):
    lines = [
        (0, V1), (1, GOOD), (2, ",,,,,,,"), (3, ',"",, ,,,,'), (4, None), (5, ""), (6, GOOD.replace('"Uno', 'Uno')),
        (7, GOOD.replace("10.50", '"10.50')), (8, GOOD.replace("Botica", '"Botica"x')), (9, GOOD + ","), (10, "123456,https"),
        (11, GOOD.replace("10.50", "abc")), (12, GOOD.replace("10.50", "No disponible")), (13, GOOD.replace("2025-01-05", "")),
        (14, GOOD.replace("10.50", '"1,2345"').replace("2025-01-05", "ayer")), (15, GOOD.replace("10.50", '"1,118"')),
    ]
    t = tables(files=[("f", "s", "botica", "2025-01", False, None, V1, "clash")], lines=[("f", n, x, 1) for n, x in lines] + [("unknown", 1, "a,b", 1)])
    checked = badrows.checked_rows(*t)
    found = sorted((r._archivo_origen, r._fila_num, r.motivo) for r in badrows.quarantined(checked).collect())
    assert found == [
        ("f", 2, "fila_vacia"), ("f", 3, "fila_vacia"), ("f", 4, "fila_vacia"), ("f", 5, "fila_vacia"), ("f", 6, "comillas"),
        ("f", 7, "comillas"), ("f", 8, "comillas"), ("f", 9, "columnas"), ("f", 10, "columnas"), ("f", 11, "precio_actual"),
        ("f", 13, "fecha_captura"), ("f", 14, "fecha_captura"), ("f", 14, "precio_actual"),
    ]
    assert badrows.valid_rows(checked).count() + checked.where("size(errores) > 0").count() == checked.count()


def test_loaded_rows_are_judged_by_their_texts(spark, tables):
    row = ["1", "u", "p", "10", "", "i", "2025-01-01", "t"]
    rows = [("f", 1, *row, "x"), ("f", 2, *[None] * 8, "x"), ("f", 3, *["", " ", " "] + [""] * 5, "x"), ("f", 4, *row[:3], "$", *row[4:], "x"), ("f", 5, *row[:6], None, "t", "x")]
    found = {(r._fila_num, r.motivo) for r in badrows.quarantined(badrows.checked_rows(*tables(loaded=rows))).collect()}
    assert found == {(2, "fila_vacia"), (3, "fila_vacia"), (4, "precio_actual"), (5, "fecha_captura")}


def test_empty_tables(spark, tables):
    t = tables()
    assert badrows.checked_rows(*t).count() == 0
    assert drift.changes(drift.file_schemas(*t)).count() == 0
    assert drift.consistent_rows(*t).count() == 0


def _changes(tables, first, second, first_lines=(), second_lines=(), loaded=False):
    files = [("a", "s", "botica", "2025-01", False, None, first, "x"), ("b", "s", "botica", "2025-02", False, None, second, "x"), ("c", None, "botica", "2025-02", False, None, first, "x")]
    lines = [(f, n, line, 1) for f, head, rows in (("a", first, first_lines), ("b", second, second_lines)) for n, line in enumerate([head, *rows]) if not loaded]
    found = drift.changes(drift.file_schemas(*tables(files=files, lines=lines))).collect()
    return {(r.ruta, r.cambio, r.columna) for r in found}


def test_names_in_another_form_or_order_are_no_change(spark, tables):
    assert _changes(tables, V1, "tienda,SKU,url_producto,PRODÚCTO,Precio Actual,PRECIO_OFERTA,URL IMAGEN,fecha_hora_captura".replace("Ú", "U")) == set()


def test_added_removed_renamed(spark, tables):
    second = V1.replace("Precio_Actual", "Precio_Normal").replace(",Tienda", ",Código Postal").replace("SKU,", "Clave,EAN,")
    rows = [f"{123450 + i}," + GOOD for i in range(5)]
    rows = [r.replace(",123456,", f",{'si' if i else 'no'},").replace(",Botica", ",06100") for i, r in enumerate(rows)]
    assert _changes(tables, V1, second, [GOOD], rows) == {
        ("b", "renombrada", "precio_normal"), ("b", "renombrada", "clave"), ("b", "agregada", "ean"), ("b", "agregada", "codigo_postal"), ("b", "eliminada", "tienda"),
    }
    # Without rows no content says that a column of an unknown name is an old one.
    assert _changes(tables, V1, V1.replace("SKU", "Clave")) == {("b", "agregada", "clave"), ("b", "eliminada", "sku")}


def test_no_name_but_the_canonical_ones_is_needed(spark):
    """Every other name in the files not loaded yet replaced by one that says nothing: the same changes under the new names."""
    place = "/root/testdata/sf0.01"
    if not os.path.isdir(place):
        pytest.skip("the test tables are not here")
    names = ("archivo_declarado", "precios_ext", "captura_cruda", "dim_tienda")
    files, loaded, lines, stores = (spark.read.parquet(f"{place}/{n}.parquet") for n in names)
    known = [n for names in capture.KNOWN_NAMES.values() for n in names]
    mask = lambda cells: F.transform(cells, lambda c: F.when(column_name(c).isin(*known), c).otherwise(F.concat(F.lit("q"), F.substring(F.md5(column_name(c)), 1, 8))))
    header = lambda c: F.array_join(mask(csvline.cells(c)), ",")
    masked_files = files.withColumn("primera_linea", F.when(~F.col("cargado") & ~F.col("sin_header"), header("primera_linea")).otherwise(F.col("primera_linea")))
    masked_files = masked_files.withColumn("columnas", F.when(~F.col("cargado"), mask(F.col("columnas"))).otherwise(F.col("columnas")))
    masked_files = masked_files.withColumn("columnas_descartar", F.when(~F.col("cargado"), mask(F.col("columnas_descartar"))).otherwise(F.col("columnas_descartar")))
    masked_lines = lines.withColumn("linea", F.when(F.col("_fila_num") == 0, header("linea")).otherwise(F.col("linea")))
    rows = lambda f, l: collections.Counter((r.ruta, r.cambio) for r in drift.changes(drift.file_schemas(f, loaded, l, stores)).collect())
    plain = rows(files, lines)
    hidden = rows(masked_files, masked_lines)
    # A dropped column that both files have under its own name has another one in the masked file only.
    both = {(k, n) for k, n in plain.items() if k[1] in ("renombrada", "tipo")}
    assert both and both == {(k, n) for k, n in hidden.items() if k[1] in ("renombrada", "tipo")}


def test_unknown_names_of_loaded_files(spark, tables):
    """Loaded rows hold all canonical columns, so names and columns left over pair in order."""
    second = V1.replace("SKU", "Clave").replace("Tienda", "Sucursal")
    assert _changes(tables, V1, second, loaded=True) == {("b", "renombrada", "clave"), ("b", "renombrada", "sucursal")}
    assert _changes(tables, V1, V1.replace("SKU", "Clave,Algo"), loaded=True) == {("b", "agregada", "clave"), ("b", "agregada", "algo"), ("b", "eliminada", "sku")}


def test_unknown_name_is_told_by_content(spark, tables):
    rows = [GOOD.replace("123456", str(123450 + i)) for i in range(5)]
    second = V1.replace("URL_IMAGEN", "Retrato").replace("Precio_Actual", "Importe")
    assert _changes(tables, V1, second, rows, rows) == {("b", "renombrada", "retrato"), ("b", "renombrada", "importe")}


def test_kind_of_most_values(spark, tables):
    dated = [GOOD, GOOD, GOOD.replace("10.50", "")]
    timed = [g.replace("2025-01-05", "05/01/25 10:30").replace("10.50", "$10.50") for g in dated]
    assert _changes(tables, V1, V1, dated, timed) == {("b", "tipo", "fecha_hora_captura"), ("b", "tipo", "precio_actual")}
    nothing = [GOOD.replace("2025-01-05", "").replace("10.50", "N/A")]
    assert _changes(tables, V1, V1, dated, nothing) == set()


def test_kinds_of_a_file_that_is_loaded_in_part(spark, tables):
    """Values of loaded rows and of captured lines count together; rows of a file that is not declared are kept, its header alone is not."""
    files = [(f, "s", "botica", m, False, None, V1, "x") for f, m in (("a", "2025-01"), ("b", "2025-02"))]
    held = lambda f, n, price: (f, n, "1", "u", "p", price, "", "i", "2025-01-01", "Botica", "x")
    lines = [("a", 1, GOOD, 1), ("b", 1, GOOD, 1), ("z", 0, V1, 1), ("y", 1, GOOD, 1)]
    t = tables(files=files, loaded=[held("b", 2, "$1"), held("b", 3, "$2"), held("x", 1, "$1")], lines=lines)
    schemas = drift.file_schemas(*t)
    assert {(r.ruta, r.tipos.precio_actual, len(r.columnas)) for r in schemas.collect()} == {("a", "numero", 8), ("b", "texto", 8), ("x", "texto", 0), ("y", None, 0)}
    assert [(r.ruta, r.cambio, r.columna, r.antes) for r in drift.changes(schemas).collect()] == [("b", "tipo", "precio_actual", "numero")]


def test_two_price_columns_of_unknown_names(spark, tables):
    """The one filled more often, then the dearer one, is the regular price; a second column of another kind stays untold."""
    second = V1.replace("Precio_Actual", "Rebaja").replace("Precio_Oferta", "Importe").replace("URL_IMAGEN", "Foto") + ",Foto2"
    rows = [GOOD.replace("10.50,,", "10.50,12.50,") + ",https://i.example/2.jpg" for _ in range(3)]
    found = lambda rows: {x for x in _changes(tables, V1, second, [GOOD], rows) if x[1] != "tipo"}
    assert found(rows) == {("b", "renombrada", "rebaja"), ("b", "renombrada", "importe"), ("b", "renombrada", "foto"), ("b", "agregada", "foto2")}
    files = [("f", "s", "botica", "2025-01", False, None, second, "x")]
    read = lambda rows: {(r.precio_actual_raw, r.precio_oferta_raw) for r in drift.consistent_rows(*tables(files=files, lines=[("f", n, r, 1) for n, r in enumerate([second, *rows])])).collect()}
    assert read(rows) == {("12.50", "10.50")}
    assert ("10.50", "") in read([*rows[:2], rows[2].replace("12.50", "")])


def test_a_file_declared_twice_counts_once(spark, tables):
    files = [("a", "s", "botica", "2025-01", False, None, V1, "x"), *[("b", "s", "botica", "2025-02", False, None, V1.replace("SKU", "Clave"), "x")] * 2]
    assert sorted((r.ruta, r.cambio, r.columna) for r in drift.changes(drift.file_schemas(*tables(files=files))).collect()) == [("b", "renombrada", "clave")]


def test_plan_of_changes_is_short(spark, tables):
    """The driver plans, compiles and reports all of it at each step, so its memory follows the number of exchanges, not the input."""
    plan = drift.changes(drift.file_schemas(*tables()))._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.count("Exchange ") <= 10
    assert plan.count("Join ") <= 5


def test_lattice(spark):
    assert drift.promote("numero", "texto") == "texto"
    assert drift.promote("fecha", "fecha_hora") == "fecha_hora"
    assert drift.promote("numero", "fecha") == "texto"
    assert drift.promote(None, "fecha") == "fecha"
    for a in drift.LATTICE:
        assert drift.promote(a, a) == a
        for b in drift.LATTICE:
            assert drift.promote(a, b) == drift.promote(b, a)
            for c in drift.LATTICE:
                assert drift.promote(drift.promote(a, b), c) == drift.promote(a, drift.promote(b, c))
    df = spark.createDataFrame([(["fecha", "fecha_hora"],), ([],), (["numero", None, "vacio"],)], "k array<string>")
    assert [r[0] for r in df.select(drift.fold_kinds(F.col("k"))).collect()] == ["fecha_hora", None, "numero"]


def test_canonical_rows(spark, tables):
    files = [("f", "s", "botica", "2025-01", True, ["Tienda", "SKU", "Precio"], None, "x")]
    t = tables(files=files, lines=[("f", 1, "Botica,55,12.5", 1), ("f", 2, "Botica,55", 1)])
    rows = {r._fila_num: r for r in drift.consistent_rows(*t).collect()}
    assert (rows[1].tienda, rows[1].sku, float(rows[1].precio_actual), rows[1].producto) == ("Botica", "55", 12.5, None)
    assert rows[2].sku is None
    # Where the files' kinds only meet in text, a typed column is text and what it reads as stands beside.
    mixed = tables(files=files, lines=[("f", 1, "Botica,55,12.5", 1)], loaded=[("g", 1, *["1", "u", "p", "$1,200.50 ", "", "i", "05/01/25 10:30", "t"], "x")])
    rows = {r._archivo_origen: r for r in drift.consistent_rows(*mixed).collect()}
    assert (rows["f"].precio_actual, rows["g"].precio_actual, float(rows["g"].precio_actual_leido)) == ("12.5", "$1,200.50", 1200.5)
    assert str(rows["g"].fecha_captura) == "2025-01-05 10:30:00" and rows["g"].precio_oferta is None
    assert drift.consistent_rows(*mixed, schema={"precio_actual": "numero"}).schema["precio_actual"].dataType.simpleString() == "decimal(38,9)"
    assert capture.CANONICAL[0] == "sku"
