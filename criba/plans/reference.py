"""Queries of the library's own operators over a data folder, with their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from criba.functions import calendar, keys, magnitudes, prices, stats, stores, text
from criba.functions.abbreviations import ABBREVIATIONS
from criba.functions.dates import parse_date
from criba.operators import matching, panel, quality, relational, robust, state
from criba.session import checkpoint_folder, read_table
from criba.sources import files, markup
from criba.streaming.files import arriving_parquet, drain, flag_late

ORACLES: dict[str, str] = {}
QUERIES: dict = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL where SQL can express it."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


# --- robust statistics -------------------------------------------------------------------------

_PANEL_SQL = """
with lines as (
  select l_partkey, s_nationkey, cast(date_trunc('year', l_shipdate) as date) as periodo,
         l_extendedprice / l_quantity as lista,
         case when l_discount > 0 then l_extendedprice / l_quantity * (1 - l_discount) end as oferta,
         l_orderkey, l_linenumber, l_suppkey, l_extendedprice
  from lineitem join supplier on l_suppkey = s_suppkey),
ranked as (
  select *, row_number() over (partition by l_partkey, s_nationkey, periodo
    order by coalesce(oferta, lista), lista, l_orderkey, l_linenumber, l_suppkey, l_extendedprice) as rn from lines),
cheap as (select l_partkey, s_nationkey, periodo, coalesce(oferta, lista) as precio, lista from ranked where rn = 1),
a as (select *, ln(precio) as x, count(*) over g as n, quantile_cont(ln(precio), 0.5) over g as m from cheap where precio > 0
      window g as (partition by l_partkey, periodo)),
b as (select *, quantile_cont(abs(x - m), 0.5) over g as mad, avg(abs(x - m)) over g as mean from a window g as (partition by l_partkey, periodo)),
z as (select *, case when n >= 4 then case when mad > 0 then 0.6745 * (x - m) / mad when mean > 0 then (x - m) / (1.2533 * mean) else 0.0 end end as z from b),
o as (select *, coalesce(abs(z) > 3.5, false) as atipico from z),
p as (select *, count(case when not atipico then 1 end) over g as k, quantile_cont(case when not atipico then precio end, 0.5) over g as med from o
      window g as (partition by l_partkey, periodo))
"""


def _six(c: str) -> Column:
    """Six decimals; what lies just between two goes up in either engine."""
    return F.round(F.col(c) + 1e-9, 6)


def _panel(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").join(read_table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    listed = F.col("l_extendedprice") / F.col("l_quantity")
    sale = F.when(F.col("l_discount") > 0, listed * (1 - F.col("l_discount")))
    priced = lines.select("l_partkey", "s_nationkey", F.trunc("l_shipdate", "year").alias("periodo"), listed.alias("lista"), F.coalesce(sale, listed).alias("precio"), "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    order = ["precio", "lista", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    cheap = relational.first_values(priced, ["l_partkey", "s_nationkey", "periodo"], ["precio", "lista"], order)
    return robust.robust_scores(cheap, ["l_partkey", "periodo"], "precio")


@query(_PANEL_SQL + """
select l_partkey, s_nationkey, periodo, round(precio + 1e-9, 6) as precio, n, round(z + 1e-9, 6) as z, atipico,
       round(case when k >= 4 then med end + 1e-9, 6) as mediana,
       case when k >= 4 then case when precio / med - 1 <= -0.15 then 'Muy por debajo' when precio / med - 1 < -0.05 then 'Por debajo'
            when precio / med - 1 <= 0.05 then 'En paridad' when precio / med - 1 < 0.15 then 'Por encima' else 'Muy por encima' end end as tramo
from p""")
def precio_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Cheapest price of each part, nation and year with its robust score and position among nations."""
    labels = ("Muy por debajo", "Por debajo", "En paridad", "Por encima", "Muy por encima")
    tramo = stats.band("pct", (-0.15, -0.05, 0.05, 0.15), labels, (True, False, True, False))
    return _panel(spark, folder).select("l_partkey", "s_nationkey", "periodo", _six("precio").alias("precio"), "n", _six("z").alias("z"), "atipico", _six("mediana").alias("mediana"), tramo.alias("tramo"))


@query(_PANEL_SQL + """
select l_partkey, periodo, count(*) as n,
  round(case when count(*) >= 4 then min(precio) end + 1e-9, 6) as minimo, round(case when count(*) >= 4 then quantile_cont(precio, 0.25) end + 1e-9, 6) as p25,
  round(case when count(*) >= 4 then quantile_cont(precio, 0.5) end + 1e-9, 6) as p50, round(case when count(*) >= 4 then quantile_cont(precio, 0.75) end + 1e-9, 6) as p75,
  round(case when count(*) >= 4 then max(precio) end + 1e-9, 6) as maximo,
  case when count(*) >= 4 then first(s_nationkey order by precio, s_nationkey) end as quien_minimo,
  case when count(*) >= 4 then first(s_nationkey order by precio desc, s_nationkey) end as quien_maximo,
  round(case when count(*) >= 4 then max(precio) / min(precio) - 1 end + 1e-9, 6) as rango_rel,
  round(case when count(*) >= 4 then (quantile_cont(precio, 0.75) - quantile_cont(precio, 0.25)) / quantile_cont(precio, 0.5) end + 1e-9, 6) as iqr_rel,
  round(quantile_cont(precio, 0.5) + 1e-9, 6) as tipico
from p where not atipico group by 1, 2""")
def precio_resumen(spark: SparkSession, folder: str) -> DataFrame:
    """Distribution of prices by part and year without outliers: quartiles, extremes and who has them."""
    told = robust.summary(_panel(spark, folder).where("not atipico"), ["l_partkey", "periodo"], "precio", "s_nationkey")
    numbers = ("minimo", "p25", "p50", "p75", "maximo", "rango_rel", "iqr_rel", "tipico")
    return told.select("l_partkey", "periodo", "n", *[_six(c).alias(c) for c in numbers], "quien_minimo", "quien_maximo")


@query("""
with r as (select p_partkey, p_type, p_brand, p_retailprice, count(*) over (partition by p_type) as n,
  rank() over (partition by p_type order by p_retailprice) - 1 as menores, count(*) over (partition by p_type, p_retailprice) as iguales from part),
m as (select p_type, count(case when p_brand = 'Brand#1' then 1 end) as k, quantile_cont(case when p_brand = 'Brand#1' then p_retailprice end, 0.5) as med from part group by 1)
select p_partkey, n, menores, iguales, round(case when n >= 5 then 100.0 * (menores + 0.5 * iguales) / n end, 6) as percentil,
  round(case when k >= 3 then p_retailprice / med end, 6) as prima from r join m using (p_type)""")
def competencia(spark: SparkSession, folder: str) -> DataFrame:
    """Mid-rank percentile of each part's price in its type and its premium over a reference brand's median."""
    part = read_table(spark, folder, "part")
    ranked = robust.mid_ranks(part, ["p_type"], "p_retailprice")
    told = robust.premium_over(ranked, ["p_type"], "p_retailprice", F.col("p_brand") == "Brand#1")
    return told.select("p_partkey", "n", "menores", "iguales", F.round("percentil", 6).alias("percentil"), F.round("prima", 6).alias("prima"))


@query("""
with t as (select p_partkey, p_type, p_retailprice, row_number() over (partition by p_type order by p_retailprice, p_partkey) as barato,
  row_number() over (partition by p_type order by p_retailprice desc, p_partkey) as caro from part)
select p_partkey, p_type, least(barato, caro) as lugar, barato <= 10 as entre_baratos from t where barato <= 10 or caro <= 10""")
def competencia_extremos(spark: SparkSession, folder: str) -> DataFrame:
    """The ten cheapest and the ten dearest parts of each type."""
    part = read_table(spark, folder, "part").select("p_partkey", "p_type", "p_retailprice")
    low = relational.top_k(part, ["p_type"], [F.col("p_retailprice"), F.col("p_partkey")], 10, "barato")
    high = relational.top_k(part, ["p_type"], [F.desc("p_retailprice"), F.col("p_partkey")], 10, "caro").select("p_partkey", "p_type", "caro")
    both = low.select("p_partkey", "p_type", "barato").join(high, ["p_partkey", "p_type"], "full")
    return both.select("p_partkey", "p_type", F.least("barato", "caro").cast("bigint").alias("lugar"), F.col("barato").isNotNull().alias("entre_baratos"))


@query("""
with v as (select distinct ndf_id, tienda_key, mes from mart_precio_cadena_mes where precio is not null),
c as (select distinct tienda_key, mes from v)
select n.ndf_id, t.tienda_key, m.mes,
  case when v.ndf_id is not null then 'Detectado' when c.mes is not null then 'No detectado' else 'Cadena sin captura' end as estado
from (select distinct ndf_id from v) n cross join (select tienda_key from dim_tienda) t cross join (select distinct mes from v) m
left join v on v.ndf_id = n.ndf_id and v.tienda_key = t.tienda_key and v.mes = m.mes left join c on c.tienda_key = t.tienda_key and c.mes = m.mes""")
def presencia(spark: SparkSession, folder: str) -> DataFrame:
    """Every presentation, chain and month: seen, not seen, or chain not captured."""
    seen = read_table(spark, folder, "mart_precio_cadena_mes").where("precio is not null")
    grid = relational.presence_grid(seen, seen, read_table(spark, folder, "dim_tienda"), seen, "ndf_id", "tienda_key", "mes")
    return grid.select("ndf_id", "tienda_key", "mes", "estado")


@query("""
select a.ndf_id, a.mes, round(cast(a.precio_mediana as double) / cast(b.precio_mediana as double) - 1, 6) as variacion
from mart_precio_ndf_mes a left join mart_precio_ndf_mes b on a.ndf_id = b.ndf_id and cast(a.mes - interval 1 month as date) = b.mes""")
def variacion_mensual(spark: SparkSession, folder: str) -> DataFrame:
    """Change of a presentation's median on the calendar month before."""
    told = relational.previous_month(read_table(spark, folder, "mart_precio_ndf_mes"), ["ndf_id"], "mes", "precio_mediana", "antes")
    return told.select("ndf_id", "mes", F.round(stats.ratio("precio_mediana", "antes") - 1, 6).alias("variacion"))


@query()
def cpd_cadena(spark: SparkSession, folder: str) -> DataFrame:
    """Price level of each chain in each month, presentations held equal (regression; no SQL)."""
    return panel.chain_effects(read_table(spark, folder, "mart_precio_cadena_mes"), "mes", "ndf_id", "tienda_key", "precio")


@query()
def tpd_indice(spark: SparkSession, folder: str) -> DataFrame:
    """Price index over months, presentations and chains held equal (regression; no SQL)."""
    return panel.month_index(read_table(spark, folder, "mart_precio_cadena_mes"), "mes", ["ndf_id", "tienda_key"], "precio", "2025-01-01")


# --- deduplication, latest rows, splits ----------------------------------------------------------

_RAW8 = ("sku_raw", "url_producto", "producto", "precio_actual_raw", "precio_oferta_raw", "url_imagen", "fecha_captura_raw", "tienda_raw")


@query(f"""
select _archivo_origen, _fila_num, rn from (select _archivo_origen, _fila_num, row_number() over
  (partition by {', '.join(_RAW8)} order by anio_mes, _archivo_origen, _fila_num) as rn from precios_ext) where rn > 1""")
def duplicados_exactos(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that repeat another one in all captured columns, numbered in order of month."""
    rows = read_table(spark, folder, "precios_ext")
    numbered = relational.numbered_duplicates(rows, _RAW8, ["anio_mes", "_archivo_origen", "_fila_num"])
    return numbered.where("rn > 1").select("_archivo_origen", "_fila_num", F.col("rn").cast("bigint").alias("rn"))


@query("""
select tienda, sku, url_producto, producto from (select *, row_number() over (partition by tienda, sku
  order by fecha_captura desc nulls last, url_producto nulls first, producto nulls first, _archivo_origen, _fila_num) as rn
  from precios_ext where sku is not null) where rn = 1""")
def scd1_actual(spark: SparkSession, folder: str) -> DataFrame:
    """Latest attributes of every shop's SKU."""
    rows = read_table(spark, folder, "precios_ext").where("sku is not null")
    order = [F.desc_nulls_last("fecha_captura"), F.col("url_producto"), F.col("producto"), F.col("_archivo_origen"), F.col("_fila_num")]
    return relational.first_row(rows, ["tienda", "sku"], order).select("tienda", "sku", "url_producto", "producto")


@query("""
select tienda, sku, dia, cast(precio_actual as double) as precio_actual, cast(precio_oferta as double) as precio_oferta from (
  select *, cast(fecha_captura as date) as dia, row_number() over (partition by tienda, sku, cast(fecha_captura as date)
    order by precio_actual nulls first, precio_oferta nulls first, url_producto nulls first, _archivo_origen, _fila_num) as rn
  from precios_ext where sku is not null and precio_actual > 0 and fecha_captura is not null) where rn = 1""")
def fact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The lowest listed price of each SKU and day."""
    rows = read_table(spark, folder, "precios_ext").where("sku is not null and precio_actual > 0 and fecha_captura is not null").withColumn("dia", F.to_date("fecha_captura"))
    order = ["precio_actual", "precio_oferta", "url_producto", "_archivo_origen", "_fila_num"]
    best = relational.first_values(rows, ["tienda", "sku", "dia"], ["precio_actual", "precio_oferta"], order)
    return best.select("tienda", "sku", "dia", F.col("precio_actual").cast("double"), F.col("precio_oferta").cast("double"))


@query("""
with r as (select case when coalesce(trim(producto), '') = '' then 'SIN_DESCRIPCION' when precio_actual is null or precio_actual <= 0 then 'SIN_PRECIO'
  when sku is null then 'SIN_SKU' end as motivo from precios_ext)
select coalesce(motivo, 'VALIDA') as motivo, count(*) as filas from r group by 1""")
def cuarentena(spark: SparkSession, folder: str) -> DataFrame:
    """Rows by the first reason to set them aside; valid and set-aside rows add up to all."""
    rows = read_table(spark, folder, "precios_ext")
    no_price = F.col("precio_actual").isNull() | (F.col("precio_actual") <= 0)
    reason = relational.first_reason(("SIN_DESCRIPCION", F.coalesce(F.trim("producto"), F.lit("")) == ""), ("SIN_PRECIO", no_price), ("SIN_SKU", F.col("sku").isNull()))
    valid, aside = relational.split_by_reason(rows, reason)
    every = valid.select(F.lit("VALIDA").alias("motivo")).unionByName(aside.select(F.col("motivo_descarte").alias("motivo")))
    return every.groupBy("motivo").agg(F.count("*").alias("filas"))


@query("""
select producto_key, fecha_corte, descripcion from (select *, row_number() over (partition by producto_key
  order by fecha_corte desc, cargado_en desc, descripcion nulls first, url_producto_actual nulls first) as rn from dim_producto_corte) where rn = 1""")
def ultima_version(spark: SparkSession, folder: str) -> DataFrame:
    """The last snapshot row of every listing."""
    order = [F.desc("fecha_corte"), F.desc("cargado_en"), F.col("descripcion"), F.col("url_producto_actual")]
    return relational.first_row(read_table(spark, folder, "dim_producto_corte"), ["producto_key"], order).select("producto_key", "fecha_corte", "descripcion")


@query("""
with e as (select *, row_number() over (partition by user_id order by ts, event_id) - row_number() over (partition by user_id, event_type = 'error' order by ts, event_id) as g from events)
select user_id, min(ts) as inicio, max(ts) as fin, count(*) as largo from e where event_type = 'error' group by user_id, g having count(*) >= 2""")
def racha_fallos(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of at least two errors in a row of each user."""
    found = relational.runs(read_table(spark, folder, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")
    return found.where("valor and largo >= 2").select("user_id", "inicio", "fin", "largo")


@query("""
with s as (select *, row_number() over (partition by tienda_key order by md5('57|' || producto_key), producto_key) as rn, count(*) over (partition by tienda_key) as m from dim_producto)
select tienda_key, producto_key from s where rn <= 5 and m >= 10""")
def muestra_estratificada(spark: SparkSession, folder: str) -> DataFrame:
    """Five listings of each shop with at least ten, the same at every run."""
    return relational.stratified_sample(read_table(spark, folder, "dim_producto"), ["tienda_key"], "producto_key", 5, 57, 10).select("tienda_key", "producto_key")


# --- calendar, keys, texts -----------------------------------------------------------------------


@query("""
with d as (select unnest(generate_series(cast(min(fecha_captura) as date), cast(max(fecha_captura) as date), interval 1 day)) as x from precios_ext)
select cast(x as date) as fecha, year(x) as anio, quarter(x) as trimestre, month(x) as mes_num,
  ['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre','octubre','noviembre','diciembre'][month(x)] as mes_nombre,
  cast(date_trunc('month', x) as date) as mes, last_day(cast(x as date)) as fin_mes, weekofyear(x) as semana_iso, isodow(x) as dia_semana,
  ['lunes','martes','miércoles','jueves','viernes','sábado','domingo'][isodow(x)] as dia_nombre, day(x) as dia from d""")
def dim_fecha(spark: SparkSession, folder: str) -> DataFrame:
    """Every day of the captures with its calendar attributes."""
    days = calendar.date_spine(read_table(spark, folder, "precios_ext"), "fecha_captura", "fecha_captura", "fecha")
    return calendar.date_attributes(days, "fecha")


@query("""select ruta, anio_mes as mes_de_ruta from archivo_declarado""")
def mes_de_ruta(spark: SparkSession, folder: str) -> DataFrame:
    """The month that a file's path names."""
    return read_table(spark, folder, "archivo_declarado").select("ruta", calendar.month_of_path("ruta").alias("mes_de_ruta"))


@query("""
select producto_key, md5(coalesce(cast(tienda_key as varchar), '_dbt_utils_surrogate_key_null_') || '-' || coalesce(sku, '_dbt_utils_surrogate_key_null_')) as llave,
  md5('modelo|96|busqueda|' || descripcion) as texto_hash, case when position(substr(md5(producto_key), 1, 1) in '02468ace') > 0 then 'calibracion' else 'reserva' end as mitad from dim_producto""")
def llaves(spark: SparkSession, folder: str) -> DataFrame:
    """Surrogate keys, text identities and the stable half of each listing."""
    sold = read_table(spark, folder, "dim_producto")
    hashed = F.when(F.col("descripcion").isNotNull(), keys.text_hash("descripcion", "modelo", 96, "busqueda"))
    return sold.select("producto_key", keys.surrogate_key("tienda_key", "sku").alias("llave"), hashed.alias("texto_hash"), keys.split_half("producto_key").alias("mitad"))


@query(r"""
select producto_key, trim(regexp_replace(replace(regexp_replace(regexp_replace(strip_accents(lower(trim(producto))), '(\d)\.(\d)', '\1~\2', 'g'),
  '[^\p{L}\p{N}\s~]', ' ', 'g'), '~', '.'), '\s+', ' ', 'g')) as limpio from dim_producto""")
def limpiar_texto(spark: SparkSession, folder: str) -> DataFrame:
    """Search form of listing names."""
    return read_table(spark, folder, "dim_producto").select("producto_key", text.clean_text("producto").alias("limpio"))


_ATTR_SQL = r"""
with t as (select ndf_id, upper(trim(regexp_replace(replace(regexp_replace(regexp_replace(strip_accents(lower(trim(producto || ' ' || presentacion))), '(\d)\.(\d)', '\1~\2', 'g'),
  '[^\p{L}\p{N}\s~]', ' ', 'g'), '~', '.'), '\s+', ' ', 'g'))) as t from dim_ndf),
a as (select ndf_id, t,
  coalesce(try_cast(regexp_extract(t, '(\d+(?:\.\d+)?)\s*MG\b', 1) as double), try_cast(regexp_extract(t, '(\d+(?:\.\d+)?)\s*MCG\b', 1) as double) / 1000,
    try_cast(regexp_extract(t, '(\d+(?:\.\d+)?)\s*G\b', 1) as double) * 1000) as dosis_mg,
  coalesce(try_cast(regexp_extract_all(t, '(\d+(?:\.\d+)?)\s*ML\b', 1)[-1] as double), try_cast(regexp_extract_all(t, '(\d+(?:\.\d+)?)\s*L\b', 1)[-1] as double) * 1000) as volumen_ml,
  coalesce(try_cast(regexp_extract(t, '(\d+(?:\.\d+)?)\s*G\b', 1) as double), try_cast(regexp_extract(t, '(\d+(?:\.\d+)?)\s*GR\b', 1) as double),
    try_cast(regexp_extract(t, '(\d+(?:\.\d+)?)\s*KG\b', 1) as double) * 1000) as masa_g,
  coalesce(try_cast(regexp_extract(t, '(\d+)\s*TAB[A-Z]*\b', 1) as bigint), try_cast(regexp_extract(t, '(\d+)\s*CAP[A-Z]*\b', 1) as bigint),
    try_cast(regexp_extract(t, '(\d+)\s*GRAG[A-Z]*\b', 1) as bigint), try_cast(regexp_extract(t, '(\d+)\s*PZ[A-Z]*\b', 1) as bigint),
    try_cast(regexp_extract(t, '\bC\s+(\d+)\b', 1) as bigint), try_cast(regexp_extract(t, '(\d+)\s*$', 1) as bigint)) as piezas from t)
"""


def _catalogue_text(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "dim_ndf").select("ndf_id", text.clean_text(F.concat("producto", F.lit(" "), "presentacion")).alias("t"))


@query(_ATTR_SQL + "select ndf_id, round(dosis_mg, 6) as dosis_mg, round(volumen_ml, 6) as volumen_ml, round(masa_g, 6) as masa_g, piezas from a")
def extraer_atributos(spark: SparkSession, folder: str) -> DataFrame:
    """Dose, volume, mass and pieces of catalogue texts."""
    x = _catalogue_text(spark, folder).select("ndf_id", magnitudes.extract_attributes("t").alias("x"))
    return x.select("ndf_id", *[F.round(F.col(f"x.{c}").cast("double"), 6).alias(c) for c in ("dosis_mg", "volumen_ml", "masa_g")], "x.piezas")


@query(_ATTR_SQL + r""", l as (select *, '(\d+(?:\.\d+)?)\s*MG\s+(\d+(?:\.\d+)?)?\s*ML\s+(\d+(?:\.\d+)?)\s*ML\b' as pat from a),
m as (select *, try_cast(regexp_extract(t, pat, 1) as double) as mg, coalesce(try_cast(regexp_extract(t, pat, 2) as double), 1.0) as ml, try_cast(regexp_extract(t, pat, 3) as double) as v from l)
select ndf_id, round(case when mg is not null then mg / ml when volumen_ml is null then dosis_mg end, 6) as mg_por_unidad,
  case when mg is not null then 'MG/ML' when volumen_ml is null and dosis_mg is not null then 'MG' end as unidad,
  round(case when mg is not null then mg / ml * v when volumen_ml is null then dosis_mg * piezas end, 6) as mg_por_envase from m""")
def mg_por_envase(spark: SparkSession, folder: str) -> DataFrame:
    """Milligrams a unit and a pack of catalogue texts."""
    x = _catalogue_text(spark, folder).select("ndf_id", magnitudes.mg_per_pack("t").alias("x"))
    return x.select("ndf_id", F.round("x.mg_por_unidad", 6).alias("mg_por_unidad"), "x.unidad", F.round("x.mg_por_envase", 6).alias("mg_por_envase"))


@query(r"select ndf_id, array_to_string(list_transform(regexp_extract_all(presentacion, '(\p{L}+|[^\p{L}]+)', 1), lambda p: coalesce(map {"
       + ", ".join(f"'{a}': '{b}'" for a, b in ABBREVIATIONS.items()) + "}[p], p)), '') as expandida from dim_ndf")
def expandir_abreviaturas(spark: SparkSession, folder: str) -> DataFrame:
    """Presentations with their abbreviations written out."""
    return read_table(spark, folder, "dim_ndf").select("ndf_id", text.replace_words("presentacion", ABBREVIATIONS).alias("expandida"))


@query(r"""
with f as (select distinct producto, ' ' || trim(regexp_replace(upper(producto), '[^A-Z0-9]+', ' ', 'g')) || ' ' as p from dim_ndf where producto is not null),
t as (select ' ' || trim(regexp_replace(upper(descripcion), '[^A-Z0-9]+', ' ', 'g')) || ' ' as t from dim_producto where descripcion is not null)
select producto, count(t) as textos, count(t) > 0 as alcanzable from f left join t on contains(t, p) group by producto""")
def marcas_alcanzables(spark: SparkSession, folder: str) -> DataFrame:
    """In how many listings each catalogue brand stands, by an equality join on word sequences."""
    known = read_table(spark, folder, "dim_ndf").where("producto is not null")
    return matching.phrase_reach(known, "producto", read_table(spark, folder, "dim_producto").where("descripcion is not null"), "descripcion")


# --- field parsers -------------------------------------------------------------------------------

_PRICE_SQL = r"""
with t as (select _archivo_origen, _fila_num, regexp_replace(regexp_replace(coalesce(precio_actual_raw, ''), '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g'), '^$', '') as t, precio_actual_raw as raw from precios_ext),
b as (select *, upper(t) in ('', 'NO DISPONIBLE', 'N/A', 'NULL', '#N/D') as none, regexp_replace(translate(t, '$ ' || chr(160), ''), '\.+$', '') as x from t),
c as (select *, string_split(x, ',')[-1] as dec from b),
d as (select *, case when not contains(x, ',') then x when contains(x, '.') then replace(x, ',', '') when length(dec) = 3 then replace(x, ',', '')
  when length(dec) in (1, 2) then replace(x, ',', '.') end as y from c),
e as (select *, case when length(y) - length(replace(y, '.', '')) > 1 then array_to_string(string_split(y, '.')[:-2], '') || '.' || string_split(y, '.')[-1] else y end as z from d),
f as (select *, case when regexp_full_match(z, '[0-9]+(\.[0-9]+)?') then z end as n from e)
"""


@query(_PRICE_SQL + """
select _archivo_origen, _fila_num, case when not none then try_cast(n as double) end as precio,
  case when none then 'PRECIO_NO_DISPONIBLE' when n is null then 'PRECIO_NO_PARSEABLE' when try_cast(n as double) = 0 then 'PRECIO_CERO' end as bandera from f""")
def parsear_precio(spark: SparkSession, folder: str) -> DataFrame:
    """Captured prices as numbers, with the flag of those that are none or zero."""
    flag = F.try_element_at(prices.price_flags("precio_actual_raw"), F.lit(1))
    return read_table(spark, folder, "precios_ext").select("_archivo_origen", "_fila_num", prices.parse_price("precio_actual_raw").cast("double").alias("precio"), flag.alias("bandera"))


_DATE_SQL = r"""try_strptime(regexp_replace(fecha_captura_raw, '^\s+|\s+$', '', 'g'), ['%d/%m/%y', '%Y-%m-%d %H:%M:%S', '%d/%m/%y %H:%M', '%d/%m/%Y %H:%M', '%Y-%m-%d'])"""


@query(f"select _archivo_origen, _fila_num, strftime({_DATE_SQL}, '%Y-%m-%d %H:%M:%S') as fecha from precios_ext")
def parsear_fecha(spark: SparkSession, folder: str) -> DataFrame:
    """Captured dates by the fixed cascade of forms."""
    return read_table(spark, folder, "precios_ext").select("_archivo_origen", "_fila_num", F.date_format(parse_date("fecha_captura_raw"), "yyyy-MM-dd HH:mm:ss").alias("fecha"))


@query("""select _archivo_origen, _fila_num, case when upper(trim(sku_raw)) not in ('', 'SEARCH', 'N/A') then trim(sku_raw) end as sku,
  lpad(case when upper(trim(sku_raw)) not in ('', 'SEARCH', 'N/A') then trim(sku_raw) end, 15, '0') as sku_15 from precios_ext""")
def parsear_sku(spark: SparkSession, folder: str) -> DataFrame:
    """Captured SKUs, and padded to the width of the crosswalk."""
    return read_table(spark, folder, "precios_ext").select("_archivo_origen", "_fila_num", keys.parse_sku("sku_raw").alias("sku"), keys.padded(keys.parse_sku("sku_raw")).alias("sku_15"))


@query(_PRICE_SQL + f""", g as (select f.*, p.sku_raw, p.precio_oferta_raw, {_DATE_SQL} as fecha,
    {' and '.join(f"coalesce(trim(p.{c}), '') = ''" for c in _RAW8)} as vacia
  from f join precios_ext p using (_archivo_origen, _fila_num)),
h as (select unnest(list_filter([case when vacia then 'FILA_VACIA' end, case when upper(coalesce(trim(sku_raw), '')) in ('', 'SEARCH', 'N/A') then 'SKU_CENTINELA' end,
  case when none or upper(coalesce(trim(precio_oferta_raw), '')) in ('', 'NO DISPONIBLE', 'N/A', 'NULL', '#N/D') then 'PRECIO_NO_DISPONIBLE' end,
  case when not none and n is null then 'PRECIO_NO_PARSEABLE' end, case when try_cast(n as double) = 0 then 'PRECIO_CERO' end,
  case when fecha is null then 'FECHA_NO_PARSEABLE' end], lambda b: b is not null)) as bandera from g)
select bandera, count(*) as filas from h group by 1""")
def banderas_calidad(spark: SparkSession, folder: str) -> DataFrame:
    """Rows by quality flag; a row's flags are an ordered list without repeats."""
    empty = F.lit(True)
    for c in _RAW8:
        empty = empty & text.is_blank(c)
    flag = lambda test, name: F.array_compact(F.array(F.when(test, name)))
    flags = F.array_distinct(F.concat(flag(empty, "FILA_VACIA"), flag(keys.sku_is_sentinel("sku_raw"), "SKU_CENTINELA"), prices.price_flags("precio_actual_raw"), prices.price_flags("precio_oferta_raw"), flag(parse_date("fecha_captura_raw").isNull(), "FECHA_NO_PARSEABLE")))
    return read_table(spark, folder, "precios_ext").select(F.explode(flags).alias("bandera")).groupBy("bandera").agg(F.count("*").alias("filas"))


@query(r"""
select _archivo_origen, _fila_num, coalesce(nullif(regexp_extract(translate(precio_actual_raw, '$,', ''), '(\d+(?:\.\d{1,2})?)', 1), ''), '0.00') as primero,
  replace(regexp_replace(precio_actual_raw, '[^\d,.]', '', 'g'), ',', '.') as puntos, regexp_replace(precio_actual_raw, '[^0-9.]', '', 'g') as cifras from precios_ext""")
def formas_de_precio(spark: SparkSession, folder: str) -> DataFrame:
    """Captured prices as three of the shops' forms read them."""
    c = "precio_actual_raw"
    return read_table(spark, folder, "precios_ext").select("_archivo_origen", "_fila_num", stores.first_amount(c).alias("primero"), stores.commas_to_dots(c).alias("puntos"), stores.digits_and_dots(c).alias("cifras"))


# --- pages, URLs, JSON ---------------------------------------------------------------------------


@query(r"""select producto_key, regexp_replace(trim(url_producto_actual), '[?#].*$', '') as url,
  nullif(regexp_extract(url_producto_actual, '-([A-Za-z]?\d+)(?:[?#]|$)', 1), '') as sku_url from dim_producto""")
def urls(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical product URLs and the SKU that they end in."""
    c = "url_producto_actual"
    return read_table(spark, folder, "dim_producto").select("producto_key", keys.canonical_url(c).alias("url"), keys.sku_from_url(c, "cola").alias("sku_url"))


@query("select distinct regexp_replace(trim(url_producto), '[?#].*$', '') as url from precios_ext where coalesce(trim(url_producto), '') <> ''")
def urls_vistas(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct canonical URLs of the captures."""
    return read_table(spark, folder, "precios_ext").select(keys.canonical_url("url_producto").alias("url")).where("url <> ''").distinct()


@query("""select event_type, count(*) as n, cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as suma_k from events group by 1""")
def json_props(spark: SparkSession, folder: str) -> DataFrame:
    """A number inside JSON properties, summed by type of event."""
    told = read_table(spark, folder, "events").withColumn("p", markup.from_answer("props", "k bigint"))
    return told.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("p.k").alias("suma_k")).withColumn("suma_k", F.col("suma_k").cast("bigint"))


@query("""select source, count(*) as n, count(case when regexp_matches(text, '(?i)captcha|verifica que (eres|no eres) (humano|un robot)|unusual traffic|acceso denegado|access denied|\\b403 forbidden\\b|robot check') then 1 end) as bloqueadas from documents group by 1""")
def paginas_bloqueadas(spark: SparkSession, folder: str) -> DataFrame:
    """Texts by source, and those that read like a block page."""
    blocked = F.count_if(F.coalesce(stores.is_blocked("text"), F.lit(False)))
    return read_table(spark, folder, "documents").groupBy("source").agg(F.count("*").alias("n"), blocked.alias("bloqueadas"))


# --- entity resolution ---------------------------------------------------------------------------


@query("""
with c as (select distinct lpad(sku, 15, '0') as k, ndf_id from dim_producto where ndf_id is not null and ndf_id in (select ndf_id from dim_ndf)),
u as (select p.producto_key, min(c.ndf_id) as a, max(c.ndf_id) as b from dim_producto p join c on lpad(p.sku, 15, '0') = c.k group by 1)
select producto_key, a as ndf_id from u where a = b""")
def crosswalk_unico(spark: SparkSession, folder: str) -> DataFrame:
    """Listings whose padded SKU leads to exactly one catalogue entry."""
    sold = read_table(spark, folder, "dim_producto").withColumn("k", keys.padded("sku"))
    table = sold.where("ndf_id is not null").select(F.col("k").alias("codigo"), "ndf_id")
    return matching.crosswalk(sold.drop("ndf_id"), ["producto_key"], "k", table, "codigo", "ndf_id", read_table(spark, folder, "dim_ndf"))


@query(r"""
with c as (select producto_key, tienda_key, ndf_id, regexp_replace(regexp_replace(sku, '\D', '', 'g'), '^0+', '') as c from dim_producto),
l as (select distinct tienda_key as s, c as d, ndf_id as t from c where ndf_id is not null), q as (select * from c where ndf_id is null),
e as (select producto_key, t, 1 as r from q join l on c = d and tienda_key <> s where length(c) >= 8
  union all select producto_key, t, 2 from q join l on length(c) = 12 and length(d) = 13 and c = substr(d, 1, 12) and tienda_key <> s
  union all select producto_key, t, 2 from q join l on length(c) = 13 and length(d) = 12 and substr(c, 1, 12) = d and tienda_key <> s),
w as (select producto_key, min(r) as r from e group by 1)
select producto_key, min(t) as ndf_id, r as regla from e join w using (producto_key, r) group by producto_key, r having min(t) = max(t)""")
def ean_cruzado(spark: SparkSession, folder: str) -> DataFrame:
    """Catalogue entries that listings borrow from equal long codes of other shops."""
    return matching.cross_store(read_table(spark, folder, "dim_producto"), "producto_key", "tienda_key", "sku", "ndf_id")


_KNN_SQL = """
with p as (select a.vec_id as q, b.vec_id as b, a.label as la, b.label as lb, round(list_cosine_distance(a.embedding::double[], b.embedding::double[]), 9) as d
  from embeddings a join embeddings b on a.vec_id <> b.vec_id),
k as (select *, row_number() over (partition by q order by d, cast(b as varchar)) as lugar from p)
"""


def _neighbours(vectors: DataFrame, k: int) -> DataFrame:
    q, b = vectors.withColumnRenamed("vec_id", "q"), vectors.withColumnRenamed("vec_id", "b")
    return matching.exact_neighbours(q, "q", b, "b", "embedding", k, skip_self=True)


@query(_KNN_SQL + "select cast(q as varchar) as q, cast(b as varchar) as b, round(d, 5) as distancia, cast(lugar as integer) as lugar from k where lugar <= 5")
def knn_coseno(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest other vectors of each vector, by comparing all."""
    found = _neighbours(read_table(spark, folder, "embeddings"), 5)
    return found.select("q", "b", F.round("distancia", 5).alias("distancia"), "lugar")


def _first_candidates(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    told = relational.margin_to_next(_neighbours(vectors, 2).drop("lugar"), ["q"], "distancia", "b").where("lugar = 1")
    label = lambda id, name: vectors.select(F.col("vec_id").cast("string").alias(id), F.col("label").alias(name))
    return told.join(label("q", "la"), "q").join(label("b", "lb"), "b").withColumn("acierto", F.col("la") == F.col("lb"))


@query(_KNN_SQL + """, f as (select *, lead(d) over (partition by q order by d, cast(b as varchar)) - d as margen from k where lugar <= 2)
select cast(q as varchar) as q, cast(b as varchar) as b, case when d > case when la < 5 then 0.75 else 0.7 end then 'sin_match'
  when la = lb and margen >= 0.02 then 'match' else 'cuarentena' end as decision from f where lugar = 1""")
def decision_vectorial(spark: SparkSession, folder: str) -> DataFrame:
    """Decision on each vector's first candidate by distance, margin and guard."""
    told = _first_candidates(spark, folder)
    ruled = matching.decision(F.col("distancia"), F.col("margen"), F.col("acierto"), F.col("la") < 5, 0.75, 0.7, 0.02)
    return told.select("q", "b", ruled.alias("decision"))


@query(_KNN_SQL + """, f as (select la < 5 as grupo, greatest(0, ceil(round(d / 0.025, 6))) as i, la = lb as ok from k where lugar = 1),
n as (select grupo, count(*) as total from f group by 1)
select grupo, round(cast(s as double) * 0.025, 3) as tau, count(*) as aceptados, count(case when ok then 1 end) as aciertos,
  round(count(case when ok then 1 end) / count(*), 6) as precision, round(count(*) / any_value(total), 6) as volumen
from f join n using (grupo) join range(0, 41) t(s) on f.i <= s group by grupo, s""")
def calibracion_tau(spark: SparkSession, folder: str) -> DataFrame:
    """Precision and volume of first candidates at each distance threshold."""
    swept = matching.threshold_sweep(_first_candidates(spark, folder).withColumn("grupo", F.col("la") < 5), ["grupo"], "distancia", "acierto", 41, 0.025)
    return swept.select("grupo", "tau", "aceptados", "aciertos", F.round("precision", 6).alias("precision"), F.round("volumen", 6).alias("volumen"))


@query(_KNN_SQL + """, f as (select la as label, count(*) as n, count(case when la = lb then 1 end) as aciertos from k where lugar = 1 group by 1)
select label, n, aciertos, round(aciertos / n, 6) as precision,
  round(((aciertos / n + 1.96*1.96 / (2 * n)) - 1.96 * sqrt((aciertos / n) * (1 - aciertos / n) / n + 1.96*1.96 / (4.0 * n * n))) / (1 + 1.96*1.96 / n), 6) as ic_bajo,
  round(((aciertos / n + 1.96*1.96 / (2 * n)) + 1.96 * sqrt((aciertos / n) * (1 - aciertos / n) / n + 1.96*1.96 / (4.0 * n * n))) / (1 + 1.96*1.96 / n), 6) as ic_alto from f""")
def auditoria_precision(spark: SparkSession, folder: str) -> DataFrame:
    """Precision of first candidates by label with its interval."""
    told = matching.audit(_first_candidates(spark, folder).withColumnRenamed("la", "label"), ["label"], "acierto", 0.9)
    return told.select("label", "n", "aciertos", *[F.round(c, 6).alias(c) for c in ("precision", "ic_bajo", "ic_alto")])


# --- state, inventory, quality -------------------------------------------------------------------


@query("""
with c as (select producto_key, descripcion from dim_producto_corte
  qualify row_number() over (partition by producto_key order by fecha_corte desc, cargado_en desc, coalesce(descripcion, '') desc) = 1)
select p.producto_key, case when c.producto_key is not null and md5(c.descripcion) is distinct from md5(p.descripcion) then c.descripcion else p.descripcion end as descripcion
from dim_producto p left join c using (producto_key)
union all select producto_key, descripcion from c where producto_key not in (select producto_key from dim_producto)""")
def upsert_hash(spark: SparkSession, folder: str) -> DataFrame:
    """Listings with the descriptions of their last snapshot where the hash differs."""
    marked = lambda df: df.select("producto_key", "descripcion", F.md5("descripcion").alias("marca"))
    snapshots = read_table(spark, folder, "dim_producto_corte").withColumn("orden", F.coalesce("descripcion", F.lit("")))
    last = relational.first_row(snapshots, ["producto_key"], [F.desc("fecha_corte"), F.desc("cargado_en"), F.desc("orden")])
    held = marked(read_table(spark, folder, "dim_producto"))
    return state.upsert(held, state.changed_rows(held, marked(last), ["producto_key"], "marca"), ["producto_key"]).select("producto_key", "descripcion")


@query("select producto_key from dim_producto p where not exists (select 1 from emb_producto e where e.producto_key = p.producto_key and embedding is not null)")
def anti_pendientes(spark: SparkSession, folder: str) -> DataFrame:
    """Listings that still lack a vector."""
    done = read_table(spark, folder, "emb_producto").where("embedding is not null")
    return relational.pending(read_table(spark, folder, "dim_producto"), done, ["producto_key"]).select("producto_key")


@query("""select estado, count(*) as archivos from (select coalesce(f, ruta) as ruta, case when anio_mes > '2026-03' then 'fuera_de_corte' when f is not null and ruta is not null then 'declarado'
  when f is not null then 'sin_declarar' else 'faltante' end as estado from (select distinct _archivo_origen as f from precios_ext) full join archivo_declarado on f = ruta) group by 1""")
def inventario(spark: SparkSession, folder: str) -> DataFrame:
    """Files with rows against declared ones, by state."""
    found = read_table(spark, folder, "precios_ext").select(F.col("_archivo_origen").alias("ruta")).distinct()
    told = files.reconcile_inventory(found, read_table(spark, folder, "archivo_declarado"), "2026-03")
    return told.groupBy("estado").agg(F.count("*").alias("archivos"))


@query(f"""
with m as (select _archivo_origen, anio_mes, strftime({_DATE_SQL}, '%Y-%m') as m from precios_ext),
c as (select _archivo_origen, m, count(*) as n from m where m is not null group by 1, 2), t as (select _archivo_origen, first(m order by n desc, m) as mes_mayoritario from c group by 1)
select _archivo_origen, count(*) as filas, any_value(mes_mayoritario) as mes_mayoritario, count(case when m <> anio_mes then 1 end) as fuera_de_mes
from m left join t using (_archivo_origen) group by 1""")
def perfil_archivos(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, majority month and rows of other months of every file."""
    return files.file_profiles(read_table(spark, folder, "precios_ext"), "_archivo_origen", "anio_mes", "fecha_captura_raw")


@query("""
select 'dim_producto' as tabla, 'not_null_descripcion' as prueba, count(*) as fallas from dim_producto where descripcion is null
union all select 'dim_producto', 'accepted_values_match_method', count(*) from dim_producto where match_method not in ('aportadores', 'ean_cruzado', 'vectorial')
union all select 'dim_producto', 'accepted_range_dias_observados', count(*) from dim_producto where dias_observados < 1
union all select 'dim_producto', 'expression_fechas', count(*) from dim_producto where not (fecha_primera_captura <= fecha_ultima_captura)
union all select 'dim_producto', 'unique_producto_key', count(*) from (select producto_key from dim_producto where producto_key is not null group by 1 having count(*) > 1)
union all select 'dim_producto', 'unique_tienda_key_sku', count(*) from (select tienda_key, sku from dim_producto where tienda_key is not null and sku is not null group by 1, 2 having count(*) > 1)
union all select 'dim_producto', 'relationship_ndf_id', count(*) from dim_producto where ndf_id is not null and ndf_id not in (select ndf_id from dim_ndf)
union all select 'emb_ndf', 'equal_rowcount', abs((select count(*) from emb_ndf) - (select count(*) from dim_ndf))
union all select 'mart_precio_ndf_mes', 'sin_huecos_mes', (select date_diff('day', min(mes), max(mes)) + 1 - count(distinct mes) from mart_precio_ndf_mes)
union all select 'precios_ext', 'equal_rowcount', 0""")
def dq_reporte(spark: SparkSession, folder: str) -> DataFrame:
    """Failing rows of generic and reconciliation tests."""
    sold, known = read_table(spark, folder, "dim_producto"), read_table(spark, folder, "dim_ndf")
    rows = quality.run_row_tests(
        sold,
        "dim_producto",
        [
            quality.not_null("descripcion"),
            quality.accepted_values("match_method", ("aportadores", "ean_cruzado", "vectorial")),
            quality.accepted_range("dias_observados", low=1),
            quality.expression_is_true("fechas", F.col("fecha_primera_captura") <= F.col("fecha_ultima_captura"), severity="warn"),
        ],
    )
    captured = read_table(spark, folder, "precios_ext")
    valid, aside = relational.split_by_reason(captured, relational.first_reason(("SIN_SKU", F.col("sku").isNull())))
    return quality.report(
        rows,
        quality.unique(sold, "dim_producto", ["producto_key"]),
        quality.unique(sold, "dim_producto", ["tienda_key", "sku"]),
        quality.relationship(sold, "dim_producto", "ndf_id", known, "ndf_id"),
        quality.equal_row_count(read_table(spark, folder, "emb_ndf"), known, "emb_ndf"),
        quality.missing_days(read_table(spark, folder, "mart_precio_ndf_mes"), "mes", "mart_precio_ndf_mes"),
        quality.conserved(captured, [valid, aside], "precios_ext"),
    ).select("tabla", "prueba", "fallas")


@query("select tienda, count(*) as filas, count(case when anio_mes_dato <> anio_mes then 1 end) as desfasadas from precios_ext group by 1")
def flujo_capturas(spark: SparkSession, folder: str) -> DataFrame:
    """Captured rows through a file stream, late ones flagged, and counted by shop."""
    place = f"{checkpoint_folder(spark)}/flujo-{uuid.uuid4().hex}"
    rows = flag_late(arriving_parquet(spark, f"{folder}/precios_ext.parquet"), "anio_mes_dato", "anio_mes", "tarde")
    drain(rows.select("tienda", "tarde"), f"{place}/filas", f"{place}/estado")
    return spark.read.parquet(f"{place}/filas").groupBy("tienda").agg(F.count("*").alias("filas"), F.count_if("tarde").alias("desfasadas"))
