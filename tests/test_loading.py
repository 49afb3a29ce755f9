"""Loading, settings, publishing and decisions on cases written out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from criba import config
from criba.functions import calendar, magnitudes, text
from criba.operators import bronze, matching, publish, quality, relational, state

DECLARED = "ruta string, tienda string, anio_mes string, sin_header boolean, columnas array<string>, columnas_descartar array<string>, copia_de string, primera_linea string"


def _declared(spark, *rows):
    return spark.createDataFrame(list(rows), DECLARED)


def test_header_variants(spark):
    v = bronze.VARIANTS
    plain = v["V1"].split(",")
    cases = {
        "v1": (False, None, None, v["V1"]), "v5": (False, None, ["NDF"], v["V5"]), "v5_undeclared": (False, None, None, v["V5"]), "v4": (True, plain, None, "1,u,p,2,3,i,f,t"),
        "v4_wide": (True, plain, None, "1,u,p,2,3,i,f,t,x"), "case": (False, None, None, v["V1"].replace("Producto,", "PRODUCTO,")), "none": (False, None, None, None),
        "twice": (True, [*plain[:7], "Fecha"], None, None), "missing": (True, plain[:7], None, None), "odd": (True, [*plain, "Raro"], None, None),
    }
    df = _declared(spark, *[(name, "t", "2026-01", *x[:3], None, x[3]) for name, x in cases.items()])
    got = {r.ruta: (r.variante, r.error) for r in bronze.header_variants(df).collect()}
    assert got == {
        "v1": ("V1", None), "v5": ("V5", None), "v5_undeclared": ("V5", "sin_equivalente:ndf"), "v4": ("V4", None), "v4_wide": ("V4", "ancho"), "case": (None, "desconocido"),
        "none": (None, "sin_encabezado"), "twice": ("V4", "repetida:fecha_captura"), "missing": ("V4", "faltan:tienda"), "odd": ("V4", "sin_equivalente:raro"),
    }
    assert bronze.loadable(bronze.header_variants(df.where("ruta in ('v1', 'v4')"))).count() == 2
    with pytest.raises(bronze.SchemaError, match="case: desconocido"):
        bronze.loadable(bronze.header_variants(df))


def test_assembled_rows(spark):
    files = _declared(spark, ("f", "heb", "2026-03", False, None, None, None, None), ("g", "heb", "2026-03", False, None, None, "f", None)).withColumn("variante", F.lit("V1"))
    raw = "_archivo_origen string, _fila_num bigint, sku string, url_producto string, producto string, precio_actual string, precio_oferta string, url_imagen string, fecha_captura string, tienda string, _md5_origen string, _ingestado_en timestamp"
    now = dt.datetime(2026, 4, 1)
    rows = [
        ("f", 1, "900437", "u", "P", "$1,787.00", "1.173.00", "i", "06/03/26 2:32", "HEB", "m", now), ("f", 2, "N/A", "u", "P", "No disponible", "0.00", "i", "2026-03-05", "HEB", "m", now),
        ("f", 3, "", "", "", "", "", "", "", "", "m", now), ("f", 4, "7", "u", "P", "abc", None, None, None, None, "m", now), ("g", 1, "7", "u", "P", "5", "4", "i", "2026-02-05", "HEB", "m", now), ("x", 1, "7", "u", "P", "5", "4", "i", "2026-02-05", "HEB", "m", now),
    ]
    made = bronze.assembled(spark.createDataFrame(rows, raw), files)
    assert tuple(made.columns) == bronze.COLUMNS and made.schema["precio_actual"].dataType.simpleString() == "decimal(38,9)"
    got = {(r._archivo_origen, r._fila_num): r for r in made.collect()}
    one, two, blank, short, copied, unknown = (got[k] for k in (("f", 1), ("f", 2), ("f", 3), ("f", 4), ("g", 1), ("x", 1)))
    assert (one.sku, float(one.precio_actual), float(one.precio_oferta), str(one.fecha_captura), one.calidad_flags, one.precio_parse_ok, one.desfase_mes) == ("900437", 1787.0, 1173.0, "2026-03-06 02:32:00", [], True, False)
    assert two.calidad_flags == ["SKU_CENTINELA", "PRECIO_NO_DISPONIBLE", "PRECIO_CERO"] and two.sku is None and not two.precio_parse_ok
    assert blank.calidad_flags == ["FILA_VACIA", "SKU_CENTINELA", "PRECIO_NO_DISPONIBLE", "FECHA_NO_PARSEABLE"] and blank.fila_vacia and not blank.desfase_mes
    assert short.calidad_flags == ["PRECIO_NO_PARSEABLE", "PRECIO_NO_DISPONIBLE", "FECHA_NO_PARSEABLE"] and short.url_imagen == ""
    assert copied.calidad_flags == ["SOSPECHA_COPIA"] and copied.desfase_mes and copied.anio_mes_dato == "2026-02"
    assert (unknown.tienda, unknown.desfase_mes) == (None, False)


def test_settings():
    good = {"carpeta_capturas": "d", "carpeta_crudo": "r", "carpeta_bronce": "b/", "prefijo": "precios", "anio_mes_maximo": "2026-08 "}
    assert config.settings(good, config.LoadSettings).table("bronce", "x") == "b/precios/x"
    for change, word in (({"prefijo": "/p"}, "prefijo"), ({"anio_mes_maximo": "2026-8"}, "anio_mes_maximo"), ({"prefijo": " "}, "prefijo: blank"), ({"prefijo": 5}, "prefijo"), ({"otro": "x"}, "unknown: otro")):
        with pytest.raises(config.ConfigError, match=word):
            config.settings(good | change, config.LoadSettings)
    with pytest.raises(config.ConfigError, match="missing: prefijo"):
        config.settings({k: v for k, v in good.items() if k != "prefijo"}, config.LoadSettings)
    with pytest.raises(config.ConfigError):
        config.settings(["x"], config.LoadSettings)
    assert config.text_variant("v4", {"v1": ["presentacion"], "v4": ["presentacion_expandida"]}) == ["presentacion_expandida"]
    with pytest.raises(config.ConfigError):
        config.text_variant("v2", {"v1": ["presentacion"]})


def test_inventory(spark):
    rows = [
        ("2026/01_enero/a.csv", "heb", "2026-01", False, None, None, None, "h"), ("2026/01_enero/b.csv", "heb", "2026-02", False, None, None, None, "h"), ("2026/01_enero/c.csv", "gi", "2026-01", True, None, None, "2026/01_enero/z.csv", None),
        ("2026/01_enero/d.csv", "gi", "2026-01", True, ["SKU"], None, "2026/01_enero/a.csv", None), ("2026/01_enero/d.csv", "gi", "2026-01", True, ["SKU"], None, None, None), ("x/2026/01_enero/a.csv", "heb", "2026-01", False, None, None, None, "h"), (None, " ", None, False, None, None, None, None),
    ]
    df = _declared(spark, *rows)
    got = {(r.ruta, r.falta) for r in config.inventory_faults(df).collect()}
    assert got == {
        ("2026/01_enero/a.csv", "destino"), ("x/2026/01_enero/a.csv", "destino"), ("2026/01_enero/b.csv", "mes_de_carpeta"), ("2026/01_enero/c.csv", "sin_columnas"), ("2026/01_enero/c.csv", "copia_desconocida"),
        ("2026/01_enero/d.csv", "repetida"), (None, "sin_ruta"), (None, "sin_tienda"), (None, "sin_mes"),
    }
    with pytest.raises(config.ConfigError, match="repetida"):
        config.sound_inventory(df)
    assert config.sound_inventory(df.limit(1)).count() == 1 and config.inventory_faults(df.limit(0)).count() == 0


def test_plan_outcomes_and_bank(spark):
    declared = _declared(spark, ("2026/06_junio/a.csv", "heb", "2026-06", False, None, None, None, "h"), ("2026/06_junio/b.csv", "gi", "2026-06", True, ["SKU"], ["NDF"], "x", None), ("2026/07_julio/c.csv", "gi", "2026-07", False, None, None, None, "h"))
    profiles = spark.createDataFrame([("2026/06_junio/a.csv", 10, 0, "2026-06"), ("2026/06_junio/b.csv", 5, 2, "2026-05"), ("2026/07_julio/c.csv", 0, 0, None)], "ruta string, filas bigint, fuera_de_mes bigint, mes_mayoritario string")
    got = {r.ruta: (r.destino, r.accion, r.motivo, r.marcas) for r in state.load_plan(profiles, declared, "b/").collect()}
    assert got["2026/06_junio/a.csv"] == ("b/tienda=heb/anio_mes=2026-06/a.parquet", "cargar", None, [])
    assert got["2026/06_junio/b.csv"][3] == ["SIN_HEADER", "DESCARTA:NDF", "SOSPECHA_COPIA", "DESFASE_MES:2->2026-05"]
    assert got["2026/07_julio/c.csv"][1:] == ("omitir", "sin filas", ["VACIO"])
    assert state.load_plan(profiles, declared, "b", shop="gi").count() == 2 and state.load_plan(profiles, declared, "b", month="2026-06").count() == 2 and state.load_plan(profiles, declared, "b", until="2026-06").count() == 2
    decided = spark.createDataFrame([(f, "omitir" if f == "same" else "cargar", 1) for f in ("same", "ok", "empty", "lost", "broken")], "ruta_origen string, accion string, version int")
    results = spark.createDataFrame([("ok", 5, 5, None), ("empty", 0, 0, None), ("lost", 5, 4, None), ("broken", None, None, "boom")], "ruta_origen string, filas int, escritas int, error string")
    ends = {r.ruta_origen: (r.desenlace, r.estado) for r in state.outcomes(decided, results).collect()}
    assert ends == {"same": ("saltado", None), "ok": ("procesado", "OK"), "empty": ("procesado", "VACIO"), "lost": ("fallido", None), "broken": ("fallido", "ERROR")}
    held = state.held_copies(spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "ruta_origen string, md5 string"), spark.createDataFrame([("a", "1"), ("b", "9"), ("c", None)], "ruta_origen string, md5 string"))
    assert {r.ruta_origen: r.ya_esta for r in held.collect()} == {"a": True, "b": False, "c": False}
    bank = spark.createDataFrame([("h1", [1.0])], "h string, v array<double>")
    wanted = spark.createDataFrame([(h,) for h in ("h3", "h1", "h2", "h4", "h2")], "h string")
    assert [r.h for r in state.next_batch(wanted, bank, "h", 2).collect()] == ["h2", "h3"]
    made = spark.createDataFrame([("h2", [2.0], ""), ("h3", None, "quota"), ("h1", [9.0], None), (None, [1.0], "")], "h string, v array<double>, e string")
    assert [tuple(r) for r in state.append_to_bank(bank, made, "h", "e").collect()] == [("h2", [2.0])]


def test_published_prices_and_months(spark):
    df = spark.createDataFrame([(10.0, 8.0), (10.0, 10.0), (10.0, 12.0), (None, 9.0), (10.0, None), (None, None)], "l double, o double")
    listed, sale = publish.resolved_prices("l", "o")
    assert [tuple(r) for r in df.select(listed, sale).collect()] == [(10.0, 8.0), (10.0, None), (10.0, None), (9.0, None), (10.0, None), (None, None)]
    assert [r[0] for r in df.select(publish.discount("l", "o")).collect()][:1] == [0.2]
    assert df.select(publish.price_per("l", F.lit(4)), publish.price_per("l", F.lit(0))).first() == (2.5, None)
    day = lambda m, d=5: dt.date(2025 + (m > 12), (m - 1) % 12 + 1, d)
    rows = [(day(m), s) for m in (9, 10, 12, 13, 21) for s in "abcd"] + [(day(11), "a")]
    facts = spark.createDataFrame(rows, "d date, s string")
    months = lambda moment: sorted(str(r.mes) for r in publish.publishable_months(facts, "d", "s", "2025-10-01", 4, moment).collect())
    # September 2025 lies before the start, November has one place, September 2026 is open.
    assert months("2026-09-15 12:00:00") == ["2025-10-01", "2025-12-01", "2026-01-01"]
    # Early on 1 October in UTC it is still September in Mexico.
    assert months("2026-10-01 03:00:00") == months("2026-09-15 12:00:00") and months("2026-10-01 07:00:00")[-1] == "2026-09-01"
    offers = spark.createDataFrame([("n", "t", day(10, 5), 10.0, None, "p1"), ("n", "t", day(10, 6), 12.0, 9.0, "p2"), ("n", "t", day(10, 7), 11.0, 9.0, "p1"), ("n", "t", day(11), 1.0, None, "p1")], "n string, t string, d date, l double, o double, p string")
    panel = publish.monthly_panel(offers, publish.publishable_months(facts, "d", "s", "2025-10-01", 4, "2026-09-15 12:00:00"), ["n"], "t", "d", "l", "o", "p").collect()
    assert [(r.precio, r.precio_regular, r.precio_oferta, r.descuento_pct, r.listings_n) for r in panel] == [(9.0, 11.0, 9.0, 0.1818, 2)]
    both = publish.with_summary_rows(df.limit(1), spark.createDataFrame([(5.0, 3)], "l double, n int"), "sintetica").collect()
    assert [(r.l, r.o, r.n, r.sintetica) for r in both] == [(10.0, 8.0, None, False), (5.0, None, 3, True)]
    shop = spark.createDataFrame([(None, "https://x/a-55?x", "a"), (None, "https://x/a-55", "b"), ("7", "https://x/a-55", "a")], "s string, u string, t string")
    assert [r[0] for r in shop.select(publish.sku_or_from_url("s", "u", "t", {"a": "cola"})).collect()] == ["55", None, "7"]


def test_decisions_and_reasons(spark):
    df = spark.createDataFrame([("a", 0.5, True), ("b", 0.01, True), ("c", 0.5, False), ("d", None, None)], "k string, m double, g boolean")
    assert {r.k: r.x for r in df.select("k", matching.quarantine_reason(F.col("m"), F.col("g"), 0.02).alias("x")).collect()} == {"a": "estrato_forzado", "b": "margen", "c": "guarda", "d": "margen"}
    decided = spark.createDataFrame([("a", "n1", 0.1, "match"), ("b", "n2", 0.9, "sin_match")], "k string, t string, d double, decision string")
    assert sorted(tuple(r) for r in matching.decisions(df, decided, "k", ["t", "d"]).collect()) == [("a", "n1", 0.1, "match"), ("b", None, None, "sin_match"), ("c", None, None, "sin_match"), ("d", None, None, "sin_match")]
    target, method = matching.first_method({"uno": "a", "dos": "b"})
    rows = spark.createDataFrame([("x", "y"), (None, "y"), (None, None)], "a string, b string")
    assert [tuple(r) for r in rows.select(target, method).collect()] == [("x", "uno"), ("y", "dos"), (None, None)]
    assert [r[0] for r in rows.select(matching.any_pair([{"a": "x", "b": "y"}])).collect()] == [True, False, False]
    truth = spark.createDataFrame([("a", "n1", "g"), ("b", "n9", "g")], "k string, t string, s string")
    assert tuple(matching.recall_at(truth, decided, "k", "t", ["s"]).first()) == ("g", 2, 1, 0.5)


def test_small_aggregations(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 1, None), ("b", None, False), ("c", 2, None)], "k string, n int, t boolean")
    assert {r.k: r.x for r in relational.all_hold(df, ["k"], F.col("t"), "x").collect()} == {"a": True, "b": False, "c": None}
    assert tuple(relational.distinct_keys(df, ["k", "n"]).first()) == (4, 2)
    assert {tuple(r) for r in relational.labelled_values(df, "n", "k").collect()} == {(1, "a"), (2, "c")}
    done, missing = relational.translated(df.select("k"), "k", spark.createDataFrame([(" a ", "A"), ("b", None)], "de string, a string"), "de", "a")
    assert sorted(r.k or "" for r in done.collect()) == ["", "", "A", "A"] and [r.k for r in missing.collect()] == ["c"]
    assert [r[0] for r in spark.createDataFrame([("2026-02",), ("202602",), ("2026-13",), ("x",), (None,)], "x string").select(calendar.month_date("x").cast("string")).collect()] == ["2026-02-01", "2026-02-01", None, None, None]
    assert [r[0] for r in spark.createDataFrame([("A1",), ("S",), (None,)], "x string").select(magnitudes.route("x")).collect()] == ["ORAL", None, None]
    keys = spark.createDataFrame([("M", "ORAL"), ("SIN SAL", "ORAL"), ("M", None)], "a string, b string").select(magnitudes.group_key("a", "b", none=("SIN SAL",)))
    assert [r[0] for r in keys.collect()] == ["M | ORAL", None, None]
    spaced = spark.createDataFrame([("  A \t\u00a0B\u200bC\n",), ("",), (None,)], "x string").select(text.single_spaced("x"))
    assert [r[0] for r in spaced.collect()] == ["A BC", "", None]


def test_reconciliation_tests(spark):
    judged = spark.createDataFrame([(True,), (True,), (False,), (None,)], "ok boolean")
    fails = lambda df: df.first().fallas
    assert (fails(quality.least_precision(judged, "ok", 0.6, "t")), fails(quality.least_precision(judged, "ok", 0.7, "t")), fails(quality.least_precision(judged.limit(0), "ok", 0.7, "t"))) == (0, 1, 0)
    ranked = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1), ("c", 2)], "k string, r int")
    assert fails(quality.complete_ranks(ranked, ["k"], "r", 2, "t")) == 2
    assert fails(quality.covered(ranked, ranked.where("k = 'a'"), ["k"], "t")) == 2
    cells = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1)], "k string, n int")
    assert fails(quality.complete_grid(cells, ["k", "n"], "t")) == 2
