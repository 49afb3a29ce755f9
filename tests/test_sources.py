"""Files, workbooks, pages, sinks and streams."""

import datetime as dt
import zipfile

import pytest
from pyspark.sql import functions as F

from criba.sources import files, markup, sinks
from criba.streaming import files as streams


def test_capture_lines(spark, tmp_path):
    base = tmp_path / "in"
    (base / "2026" / "03_marzo").mkdir(parents=True)
    (base / "2026" / "03_marzo" / "a.csv").write_bytes('A,B\r\n1,"two\nlines"\n2,x\n'.encode())
    (base / "b.csv").write_bytes("Año,Niño\n".encode("latin-1"))
    (base / "empty.csv").write_bytes(b"")
    (base / ".hidden.csv").write_bytes(b"x")
    (base / "c.txt").write_bytes(b"x")
    got = {(r._archivo_origen, r._fila_num): r.linea for r in files.capture_lines(spark, str(base)).collect()}
    assert got == {("2026/03_marzo/a.csv", 0): "A,B", ("2026/03_marzo/a.csv", 1): '1,"two\nlines"', ("2026/03_marzo/a.csv", 2): "2,x", ("b.csv", 0): "Año,Niño"}
    assert {r.ruta for r in files.checksums(spark, str(base), "*.txt").collect()} == {"c.txt"}


def test_an_open_quote_does_not_swallow_the_file():
    assert files.split_records('h1,h2\n1,"open\n2,sound\n3,sound\n') == ["h1,h2", '1,"open', "2,sound", "3,sound"]


def test_code_table_and_seed(spark, tmp_path):
    (tmp_path / "t.txt").write_bytes('001\tFarmacia "X\tñ\n002\tY\t\n'.encode("latin-1"))
    assert [tuple(r) for r in files.code_table(spark, str(tmp_path / "t.txt"), ["a", "b", "c"]).collect()] == [("001", 'Farmacia "X', "ñ"), ("002", "Y", None)]
    (tmp_path / "s.csv").write_text("k,n\n1,uno\nx,dos\n")
    assert [tuple(r) for r in files.seed_table(spark, str(tmp_path / "s.csv"), "k bigint, n string").collect()] == [(1, "uno"), (None, "dos")]


def _workbook(path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Base" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>CLAVE</t></si><si><t>TEXTO</t></si><si><r><t>do</t></r><r><t>s</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row><c r="A2"><v>007</v></c><c r="B2" t="s"><v>2</v></c></row><row><c r="B3" t="inlineStr"><is><t>tres</t></is></c></row></sheetData></worksheet>')


def test_workbook(spark, tmp_path):
    path = str(tmp_path / "b.xlsx")
    _workbook(path)
    assert [tuple(r) for r in files.workbook_table(spark, path, "Base", {"CLAVE": "k", "TEXTO": "t"}).collect()] == [("007", "dos"), (None, "tres")]
    with pytest.raises(ValueError, match="not expected"):
        files.workbook_table(spark, path, "Base", {"CLAVE": "k"})
    with pytest.raises(ValueError, match="no sheet"):
        files.workbook_table(spark, path, "Otra", {"CLAVE": "k"})


def test_inventory_and_profiles(spark):
    found = spark.createDataFrame([("2026/01_enero/a.csv",), ("2026/02_febrero/b.csv",), ("2026/09_septiembre/z.csv",)], "ruta string")
    declared = spark.createDataFrame([("2026/01_enero/a.csv", "2026-01"), ("2026/01_enero/c.csv", "2026-01")], "ruta string, anio_mes string")
    got = {r.ruta[8:]: r.estado for r in files.reconcile_inventory(found, declared, "2026-08").collect()}
    assert sorted(got.values()) == ["declarado", "faltante", "fuera_de_corte", "sin_declarar"]
    states = spark.createDataFrame([("a", "declarado"), ("b", "faltante"), ("c", "fuera_de_corte")], "ruta string, estado string")
    assert files.sound_discovery(states).count() == 3
    with pytest.raises(files.InventoryError, match="not declared: x, y"):
        files.sound_discovery(states.unionByName(spark.createDataFrame([("y", "sin_declarar"), ("x", "sin_declarar")], states.schema)))
    rows = spark.createDataFrame([("f", "2026-01", d) for d in ("2026-01-05", "2026-01-06", "03/02/26", "x", None)], "f string, m string, d string")
    assert tuple(files.file_profiles(rows, "f", "m", "d").first()) == ("f", 5, "2026-01", 1)


def test_markup(spark):
    page = '<html><title> Uno </title><body><a href="/p/x-1?u=2">x</a><a class="b" href="https://o/y">y</a><div class="precio final">$ <b>12</b>.50</div><script>{"productId":"77"}</script>'
    df = spark.createDataFrame([(1, page), (2, None), (3, "<div class='precio'>roto")], "i int, html string")
    row = df.select(markup.title("html").alias("t"), markup.links("html", "https://s").alias("l"), markup.script_value("html", "productId").alias("s")).first()
    assert (row.t, row.l, row.s) == ("Uno", ["https://o/y", "https://s/p/x-1"], "77")
    got = {r.i: (r.precio, r.titulo) for r in markup.select_texts(df, "html", {"precio": ("div", "precio"), "titulo": ("title", None)}).collect()}
    assert got == {1: ("$ 12.50", "Uno"), 2: (None, None), 3: ("roto", None)}


def test_answers(spark):
    answer = '{"code":"5","price":{"value":9.5},"images":[{"format":"zoom","url":"z"},{"format":"product","url":"p"}]}'
    df = spark.createDataFrame([(1, answer), (2, "no json")], "i int, a string").withColumn("p", markup.from_answer("a", markup.PRODUCT_JSON))
    assert [tuple(r) for r in df.select("p.code", "p.price.value", markup.image_of(F.col("p"))).orderBy(F.desc_nulls_last("code")).collect()] == [("5", 9.5, "p"), (None, None, None)]
    paged = spark.createDataFrame([(1, '{"data":{"items":[{"id":"a"},{"id":"b"}]}}')], "page int, a string")
    assert [tuple(r) for r in markup.listed_items(paged, "a", "data.items", "id: string", ["page"]).collect()] == [(1, "a"), (1, "b")]
    one, two = spark.createDataFrame([("a", None), ("b", 1)], "k string, v int"), spark.createDataFrame([("a", 5), ("b", 7)], "k string, v int")
    assert {tuple(r) for r in markup.with_fallback(one, two, "k", ["v"]).collect()} == {("a", 5), ("b", 1)}


def test_attributes_and_struck_prices(spark):
    rows = [
        (1, """<a href='/uno?x=1'>u</a><a href=/dos>d</a><span class="precio-x"></span><meta class="p precio" content="12.50">"""),
        (2, "<p><del><span>$ 90.00</span></del> <ins>$ <b>70.00</b></ins></p>"), (3, "<b>$ 50.00</b>"), (4, "nada"), (5, None),
    ]
    df = spark.createDataFrame(rows, "i int, html string")
    old, now = markup.struck_and_current("html")
    got = {r.i: (r.l, r.c, r.a, r.b) for r in df.select("i", markup.links("html", "https://s").alias("l"), markup.attribute("html", "meta", "precio", "content").alias("c"), old.alias("a"), now.alias("b")).collect()}
    assert got[1] == (["https://s/dos", "https://s/uno"], "12.50", None, None)
    assert got[2][2:] == ("$ 90.00", "$ 70.00") and got[3][2:] == ("$ 50.00", "$ 50.00") and got[4][2:] == got[5][2:] == (None, None)


def test_fetching_tries_again_and_pages_end(spark):
    def get(url):
        if url.endswith("lost"):
            raise OSError("gone")
        if url.endswith("busy"):
            return 468, ""
        page = int(url.rsplit("=", 1)[1]) if "=" in url else 1
        return (200, ",".join(f"{page}{c}" for c in "ab")) if page <= 2 else (200, "")

    asked = spark.createDataFrame([("u/ok",), ("u/lost",), ("u/busy",), (None,)], "url string")
    got = {r.url: (r.estado, r.respuesta) for r in markup.fetched(asked, "url", get, tries=2, wait=0.0).collect()}
    assert got == {"u/ok": (200, "1a,1b"), "u/lost": (-1, None), "u/busy": (468, None), None: (None, None)}
    lists = spark.createDataFrame([("u?page={page}",), ("lost",)], "url string")
    items = markup.paged(lists, "url", get, lambda text: [x for x in text.split(",") if x], tries=1, wait=0.0)
    assert sorted((r.pagina, r.item) for r in items.collect()) == [(1, "1a"), (1, "1b"), (2, "2a"), (2, "2b")]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("s", "2026-01", 1), ("s", "2026-02", 2)], "tienda string, anio_mes string, v int")
    assert sinks.write_partitioned(df, path, ["tienda", "anio_mes"], ["v"], expected=2) == 2
    sinks.write_partitioned(df.where("v = 2").withColumn("v", F.lit(9)), path, ["tienda", "anio_mes"])
    assert sorted((r.anio_mes, r.v) for r in files.partitioned_parquet(spark, path).collect()) == [("2026-01", 1), ("2026-02", 9)]
    with pytest.raises(sinks.ReconciliationError):
        sinks.write_partitioned(df, path, ["tienda", "anio_mes"], expected=3)
    # What does not reconcile is not published.
    assert sorted((r.anio_mes, r.v) for r in files.partitioned_parquet(spark, path).collect()) == [("2026-01", 1), ("2026-02", 9)]
    assert not [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("_nuevo")]
    assert sinks.write_partitioned(df, str(tmp_path / "flat"), []) == 2 and sinks.write_partitioned(df.limit(1), str(tmp_path / "flat"), []) == 1
    assert spark.read.parquet(str(tmp_path / "flat")).count() == 1
    sinks.clustered_table(df, "criba_agrupada", ["tienda"], 4)
    assert spark.table("criba_agrupada").count() == 2
    spark.sql("drop table criba_agrupada")
    sinks.audit_sheet(df, str(tmp_path / "hoja"), "veredicto")
    assert spark.read.option("header", "true").csv(str(tmp_path / "hoja")).columns == ["tienda", "anio_mes", "v", "veredicto"]
    sinks.side_outputs(df, F.when(F.col("v") == 1, True), str(tmp_path / "ok"), str(tmp_path / "bad"))
    assert (spark.read.parquet(str(tmp_path / "ok")).count(), spark.read.parquet(str(tmp_path / "bad")).count()) == (1, 1)
    (tmp_path / "raw.bin").write_bytes(b"abc")
    assert sinks.copy_verified(spark, str(tmp_path / "raw.bin"), str(tmp_path / "copy.bin")) == "900150983cd24fb0d6963f7d28e17f72"
    sinks.write_snapshot(df, path + "s")
    sinks.append_rows(df, path + "s")
    assert files.text_parquet(spark, path + "s", ["v"]).count() == 4


def test_streams(spark, tmp_path):
    source = str(tmp_path / "in")
    t0 = dt.datetime(2026, 1, 1)
    rows = [("a", t0 + dt.timedelta(minutes=i), True, "2026-01", 1.0) for i in range(5)] + [("b", t0, True, "2025-12", 1.0)]
    frame = lambda r: spark.createDataFrame(r, "s string, t timestamp, f boolean, m string, v double")
    frame(rows).coalesce(1).write.parquet(source)
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    late = lambda: streams.flag_late(streams.arriving_parquet(spark, source).withColumn("dicho", F.lit("2026-01")), "m", "dicho")
    streams.drain(late(), out, mark)
    streams.drain(late(), out, mark)
    assert spark.read.parquet(out).groupBy("desfase_mes").count().orderBy("desfase_mes").collect() == [(False, 5), (True, 1)]
    frame([("a", t0 + dt.timedelta(hours=i), True, "2026-01", 1.0) for i in range(1, 5)] + [("b", t0 + dt.timedelta(hours=9), False, "2026-01", 1.0)]).coalesce(1).write.mode("append").parquet(source)
    streams.drain(late(), out, mark)
    assert spark.read.parquet(out).count() == 11
    got = []
    alerts = streams.failure_alerts(streams.arriving_parquet(spark, source), "s", "t", "f", 4)
    streams.drain_each(alerts, str(tmp_path / "m2"), lambda df, _: got.extend(map(tuple, df.collect())))
    assert [(s, n) for s, _, n in got] == [("a", 4), ("a", 4)]
    windows = streams.windowed_counts(streams.arriving_parquet(spark, source), "t", ["s"], "v")
    done = []
    streams.drain_each(windows, str(tmp_path / "m3"), lambda df, _: done.extend(map(tuple, df.collect())))
    hour = lambda h: t0 + dt.timedelta(hours=h)
    # The window of the last row is still open.
    want = [(hour(0), hour(1), "a", 5, 5.0), (hour(0), hour(1), "b", 1, 1.0)] + [(hour(h), hour(h + 1), "a", 1, 1.0) for h in range(1, 5)]
    assert sorted(done) == sorted(want)
