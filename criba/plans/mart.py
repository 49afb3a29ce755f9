"""Queries of the loading, publishing and matching operators over a data folder, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from criba import config
from criba.functions import calendar, magnitudes, stores, text
from criba.operators import bronze, capture, matching, publish, quality, relational, state
from criba.plans.reference import _ATTR_SQL, _DATE_SQL, _KNN_SQL, _PRICE_SQL, _RAW8, _first_candidates, _neighbours
from criba.session import read_table
from criba.sources import files

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


# --- loading -------------------------------------------------------------------------------------

_NONE = "('', 'NO DISPONIBLE', 'N/A', 'NULL', '#N/D')"
_SALE_SQL = _PRICE_SQL.replace("precio_actual_raw", "precio_oferta_raw")
_TRIMMED = r"regexp_replace(coalesce({}, ''), '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g')"


@query(f"""
with a as ({_PRICE_SQL} select _archivo_origen, _fila_num, none, n from f), o as ({_SALE_SQL} select _archivo_origen, _fila_num, none as none_o, n as n_o from f),
r as (select p.*, a.none, a.n, o.none_o, o.n_o, {_DATE_SQL} as f, d.copia_de is not null as copia, d.anio_mes as mes_d,
    {' and '.join(f"{_TRIMMED.format('p.' + c)} = ''" for c in _RAW8)} as vacia, upper({_TRIMMED.format('sku_raw')}) in ('', 'SEARCH', 'N/A') as centinela
  from precios_ext p join a using (_archivo_origen, _fila_num) join o using (_archivo_origen, _fila_num) left join archivo_declarado d on d.ruta = p._archivo_origen)
select _archivo_origen, _fila_num, case when not centinela then {_TRIMMED.format('sku_raw')} end as sku, case when not none then try_cast(n as double) end as precio_actual,
  case when not none_o then try_cast(n_o as double) end as precio_oferta, strftime(f, '%Y-%m-%d %H:%M:%S') as fecha_captura,
  array_to_string(list_filter([case when vacia then 'FILA_VACIA' end, case when centinela then 'SKU_CENTINELA' end, case when none then 'PRECIO_NO_DISPONIBLE' when n is null then 'PRECIO_NO_PARSEABLE' when try_cast(n as double) = 0 then 'PRECIO_CERO' end,
    case when none_o and not none then 'PRECIO_NO_DISPONIBLE' when not none_o and n_o is null and (none or n is not null) then 'PRECIO_NO_PARSEABLE' when not none_o and try_cast(n_o as double) = 0 and (none or coalesce(try_cast(n as double), 1) <> 0) then 'PRECIO_CERO' end,
    case when f is null then 'FECHA_NO_PARSEABLE' end, case when copia then 'SOSPECHA_COPIA' end], lambda x: x is not null), ',') as banderas,
  not none and n is not null and not none_o and n_o is not null as precio_parse_ok, f is not null as fecha_parse_ok, centinela as sku_es_centinela, vacia as fila_vacia,
  coalesce(strftime(f, '%Y-%m') <> mes_d, false) as desfase_mes, strftime(f, '%Y-%m') as anio_mes_dato from r""")
def bronce(spark: SparkSession, folder: str) -> DataFrame:
    """Captured rows assembled anew from their texts: typed columns, ordered flags, months that differ."""
    rows = read_table(spark, folder, "precios_ext")
    told = capture.loaded_cells(rows).join(rows.select("_archivo_origen", "_fila_num", "_md5_origen", "_ingestado_en").dropDuplicates(["_archivo_origen", "_fila_num"]), ["_archivo_origen", "_fila_num"])
    declared = read_table(spark, folder, "archivo_declarado")
    variants = bronze.header_variants(declared)
    made = bronze.assembled(told, declared.join(variants, "ruta"))
    return made.select(
        "_archivo_origen", "_fila_num", "sku", F.col("precio_actual").cast("double"), F.col("precio_oferta").cast("double"), F.date_format("fecha_captura", "yyyy-MM-dd HH:mm:ss").alias("fecha_captura"),
        F.array_join("calidad_flags", ",").alias("banderas"), "precio_parse_ok", "fecha_parse_ok", "sku_es_centinela", "fila_vacia", "desfase_mes", "anio_mes_dato",
    )


_KNOWN_HEADERS = ", ".join(f"('{name}', '{text_}')" for name, text_ in bronze.VARIANTS.items())


@query(f"""
with v(variante, h) as (values {_KNOWN_HEADERS}),
t as (select ruta, sin_header, columnas, primera_linea, case when sin_header then 'V4' else v.variante end as variante from archivo_declarado left join v on not sin_header and v.h = primera_linea)
select coalesce(variante, 'ninguna') as variante, count(*) as archivos, count(case when variante is null then 1 end) as rechazados from t group by 1""")
def variantes_encabezado(spark: SparkSession, folder: str) -> DataFrame:
    """Declared files by header variant, and those that a strict loader refuses."""
    told = bronze.header_variants(read_table(spark, folder, "archivo_declarado"))
    unknown = F.count_if(F.col("error") == "desconocido")
    return told.groupBy(F.coalesce("variante", F.lit("ninguna")).alias("variante")).agg(F.count("*").alias("archivos"), unknown.alias("rechazados"))


#: Declarations of two months again, with faults: a copy of no file; another folder for the same target.
_FAULTY_SQL = """with declarado as (select ruta, tienda, anio_mes, sin_header, columnas, copia_de from archivo_declarado
  union all select ruta, tienda, anio_mes, true, null, 'nunca/visto.csv' from archivo_declarado where anio_mes = '2025-03'
  union all select replace(ruta, '04_abril', '05_mayo'), tienda, anio_mes, sin_header, columnas, copia_de from archivo_declarado where anio_mes = '2025-04')"""


@query(_FAULTY_SQL + """,
n as (select *, string_split(ruta, '/')[-1] as nombre from declarado), d as (select tienda, anio_mes, nombre from n group by all having count(distinct ruta) > 1)
select ruta, 'destino' as falta from n semi join d using (tienda, anio_mes, nombre)
union select ruta, 'repetida' from declarado group by ruta having count(*) > 1
union select ruta, 'copia_desconocida' from declarado where copia_de is not null and copia_de not in (select ruta from declarado)
union select ruta, 'sin_columnas' from declarado where sin_header and coalesce(len(columnas), 0) = 0
union select ruta, 'mes_de_carpeta' from declarado where regexp_extract(ruta, '^(\\d{4})/(\\d{2})_', 1) || '-' || regexp_extract(ruta, '^(\\d{4})/(\\d{2})_', 2) <> anio_mes""")
def inventario_faltas(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of the declared files, with those of two months declared once more and wrongly."""
    declared = read_table(spark, folder, "archivo_declarado").select("ruta", "tienda", "anio_mes", "sin_header", "columnas", "copia_de")
    copied = declared.where("anio_mes = '2025-03'").withColumns({"sin_header": F.lit(True), "columnas": F.lit(None).cast("array<string>"), "copia_de": F.lit("nunca/visto.csv")})
    moved = declared.where("anio_mes = '2025-04'").withColumn("ruta", F.replace("ruta", F.lit("04_abril"), F.lit("05_mayo")))
    return config.inventory_faults(declared.unionByName(copied).unionByName(moved))


@query(f"""
with m as (select _archivo_origen, anio_mes, strftime({_DATE_SQL}, '%Y-%m') as m from precios_ext), c as (select _archivo_origen, m, count(*) as n from m where m is not null group by 1, 2),
t as (select _archivo_origen, first(m order by n desc, m) as mayor from c group by 1),
p as (select _archivo_origen as ruta, count(*) as filas, any_value(mayor) as mayor, count(case when m <> anio_mes then 1 end) as fuera from m left join t using (_archivo_origen) group by 1)
select ruta, 'bronce/tienda=' || tienda || '/anio_mes=' || anio_mes || '/' || replace(string_split(ruta, '/')[-1], '.csv', '.parquet') as destino, 'cargar' as accion,
  array_to_string(list_filter([case when sin_header then 'SIN_HEADER' end, case when len(columnas_descartar) > 0 then 'DESCARTA:' || array_to_string(columnas_descartar, ',') end, case when copia_de is not null then 'SOSPECHA_COPIA' end,
    case when fuera > 0 then 'DESFASE_MES:' || fuera || case when mayor <> anio_mes then '->' || mayor else '' end end], lambda x: x is not null), ';') as marcas from p join archivo_declarado using (ruta)""")
def plan_de_carga(spark: SparkSession, folder: str) -> DataFrame:
    """What a load of all files with rows would do, with what is known of each."""
    profiles = files.file_profiles(read_table(spark, folder, "precios_ext"), "_archivo_origen", "anio_mes", "fecha_captura_raw").withColumnRenamed("_archivo_origen", "ruta")
    told = state.load_plan(profiles, read_table(spark, folder, "archivo_declarado"), "bronce")
    return told.select("ruta", "destino", "accion", F.array_join("marcas", ";").alias("marcas"))


# --- publishing ----------------------------------------------------------------------------------


@query("""
select _archivo_origen, _fila_num, cast(coalesce(precio_actual, precio_oferta) as double) as precio_lista, cast(case when precio_actual is not null and precio_oferta < precio_actual then precio_oferta end as double) as precio_oferta,
  round(1 - cast(case when precio_actual is not null and precio_oferta < precio_actual then precio_oferta end as double) / nullif(cast(coalesce(precio_actual, precio_oferta) as double), 0), 4) as descuento_pct,
  coalesce(url_imagen, 'SIN_IMAGEN') as url_imagen, coalesce(sku, case when tienda = 'colibri' then nullif(regexp_extract(url_producto, '-([A-Za-z]?\\d+)(?:[?#]|$)', 1), '') end) as sku from precios_ext""")
def precios_resueltos(spark: SparkSession, folder: str) -> DataFrame:
    """List and sale price of each captured row, with the discount; images marked and SKUs of one shop taken from the URL."""
    rows = read_table(spark, folder, "precios_ext")
    listed, sale = publish.resolved_prices("precio_actual", "precio_oferta")
    told = rows.select("_archivo_origen", "_fila_num", listed.cast("double").alias("precio_lista"), sale.cast("double").alias("precio_oferta"), publish.or_marked("url_imagen", "SIN_IMAGEN").alias("url_imagen"), publish.sku_or_from_url("sku", "url_producto", "tienda", {"colibri": "cola"}).alias("sku"))
    return told.withColumn("descuento_pct", publish.discount("precio_lista", "precio_oferta"))


_MONTHS_SQL = """select cast(date_trunc('month', fecha_captura) as date) as mes, count(distinct tienda) as lugares from precios_ext where fecha_captura is not null group by 1
  having count(distinct tienda) >= 4 and mes >= date '2025-02-01' and mes < date '2025-09-01'"""


@query(_MONTHS_SQL)
def meses_publicados(spark: SparkSession, folder: str) -> DataFrame:
    """Months with enough shops, from the panel's start to the one before the month that is open in Mexico."""
    return publish.publishable_months(read_table(spark, folder, "precios_ext").where("fecha_captura is not null"), "fecha_captura", "tienda", "2025-02-01", 4, "2025-09-30 12:00:00")


@query(f"""
with mp as ({_MONTHS_SQL}), f as (select p.ndf_id, t.tienda_key, cast(e.fecha_captura as date) as dia, cast(date_trunc('month', e.fecha_captura) as date) as mes, p.producto_key,
    coalesce(e.precio_actual, e.precio_oferta) as l, case when e.precio_actual is not null and e.precio_oferta < e.precio_actual then e.precio_oferta end as o
  from precios_ext e join dim_tienda t on t.tienda_slug = e.tienda join dim_producto p on p.tienda_key = t.tienda_key and p.sku = e.sku where p.ndf_id is not null and coalesce(e.precio_actual, e.precio_oferta) > 0),
r as (select *, row_number() over (partition by ndf_id, tienda_key, mes order by coalesce(o, l), l, dia desc, producto_key) as rn, count(*) over (partition by ndf_id, tienda_key, mes) as k from f semi join mp using (mes)),
c as (select ndf_id, tienda_key, mes, count(distinct producto_key) as listings_n from r group by 1, 2, 3)
select ndf_id, tienda_key, mes, cast(coalesce(o, l) as double) as precio, cast(l as double) as precio_regular, cast(o as double) as precio_oferta, round(1 - cast(o as double) / cast(l as double), 4) as descuento_pct, listings_n from r join c using (ndf_id, tienda_key, mes) where rn = 1""")
def panel_mensual(spark: SparkSession, folder: str) -> DataFrame:
    """The cheapest offer of each presentation and chain in the published months."""
    rows, shops, sold = (read_table(spark, folder, n) for n in ("precios_ext", "dim_tienda", "dim_producto"))
    months = publish.publishable_months(rows.where("fecha_captura is not null"), "fecha_captura", "tienda", "2025-02-01", 4, "2025-09-30 12:00:00")
    listed, sale = publish.resolved_prices("precio_actual", "precio_oferta")
    offers = rows.select("tienda", "sku", "fecha_captura", listed.alias("l"), sale.alias("o")).where("l > 0 and fecha_captura is not null")
    facts = offers.join(shops.select(F.col("tienda_slug").alias("tienda"), "tienda_key"), "tienda").join(sold.where("ndf_id is not null").select("tienda_key", "sku", "producto_key", "ndf_id"), ["tienda_key", "sku"])
    told = publish.monthly_panel(facts, months, ["ndf_id"], "tienda_key", "fecha_captura", "l", "o", "producto_key")
    return told.select("ndf_id", "tienda_key", "mes", *[F.col(c).cast("double").alias(c) for c in ("precio", "precio_regular", "precio_oferta")], "descuento_pct", "listings_n")


@query(r"""
select _archivo_origen, _fila_num, case when o > l then l else o end as oferta_topada, l as regular, case when l is null or l < o then coalesce(o, l) else l end as regular_subido
from (select _archivo_origen, _fila_num, cast(precio_actual as double) as l, cast(precio_oferta as double) as o from precios_ext)""")
def precios_corregidos(spark: SparkSession, folder: str) -> DataFrame:
    """Two shops' ways with a sale price above the regular one: lowered, or the regular one raised."""
    rows = read_table(spark, folder, "precios_ext").select("_archivo_origen", "_fila_num", F.col("precio_actual").cast("double").alias("l"), F.col("precio_oferta").cast("double").alias("o"))
    regular, lowered = stores.sale_capped(F.col("l"), F.col("o"))
    raised, _ = stores.regular_raised(F.col("l"), F.col("o"))
    return rows.select("_archivo_origen", "_fila_num", lowered.alias("oferta_topada"), regular.alias("regular"), raised.alias("regular_subido"))


@query(r"""
with t as (select ndf_id, molecula, 'F' || cve_ff as codigo, upper(trim(regexp_replace(replace(regexp_replace(regexp_replace(strip_accents(lower(trim(presentacion))), '(\d)\.(\d)', '\1~\2', 'g'), '[^\p{L}\p{N}\s~]', ' ', 'g'), '~', '.'), '\s+', ' ', 'g'))) as t from dim_ndf),
l as (select *, '(\d+(?:\.\d+)?)\s*MG\s+(\d+(?:\.\d+)?)?\s*ML\s+(\d+(?:\.\d+)?)\s*ML\b' as pat, coalesce(try_cast(regexp_extract(t, '(\d+(?:\.\d+)?)\s*MG\b', 1) as double), try_cast(regexp_extract(t, '(\d+(?:\.\d+)?)\s*MCG\b', 1) as double) / 1000, try_cast(regexp_extract(t, '(\d+(?:\.\d+)?)\s*G\b', 1) as double) * 1000) as dosis,
  coalesce(try_cast(regexp_extract_all(t, '(\d+(?:\.\d+)?)\s*ML\b', 1)[-1] as double), try_cast(regexp_extract_all(t, '(\d+(?:\.\d+)?)\s*L\b', 1)[-1] as double) * 1000) as vol from t),
m as (select *, try_cast(regexp_extract(t, pat, 1) as double) as mg, coalesce(try_cast(regexp_extract(t, pat, 2) as double), 1.0) as ml from l),
u as (select ndf_id, molecula, 'PARENTERAL' as via, round(case when mg is not null then mg / ml when vol is null then dosis end, 6) as q, case when mg is not null then 'MG/ML' when vol is null and dosis is not null then 'MG' end as unidad from m)
select ndf_id, via, case when molecula is not null and molecula <> 'SIN SAL' and q is not null then molecula || ' | ' || via || ' | ' || unidad end as grupo, q as mg_por_unidad from u""")
def grupo_competitivo(spark: SparkSession, folder: str) -> DataFrame:
    """Molecule, route and unit of catalogue entries that compete; none without molecule or dose."""
    rows = read_table(spark, folder, "dim_ndf").select("ndf_id", "molecula", magnitudes.route(F.concat(F.lit("F"), "cve_ff")).alias("via"), magnitudes.mg_per_pack(text.clean_text("presentacion")).alias("x"))
    key = magnitudes.group_key("molecula", "via", "x.unidad", none=("SIN SAL",))
    return rows.select("ndf_id", "via", F.when(F.col("x.mg_por_unidad").isNotNull(), key).alias("grupo"), F.round("x.mg_por_unidad", 6).alias("mg_por_unidad"))


@query("""
with g as (select p_type, count(*) as n, quantile_cont(p_retailprice, 0.5) as med from part where p_brand = 'Brand#1' group by 1 having count(*) >= 3)
select p_partkey, p_type, p_retailprice as precio, false as es_sintetica, null as referencias from part union all select null, p_type, med, true, n from g""")
def con_filas_sinteticas(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with one row a type for the median of a reference brand."""
    part = read_table(spark, folder, "part")
    detail = part.select("p_partkey", "p_type", F.col("p_retailprice").alias("precio"))
    median = part.where("p_brand = 'Brand#1'").groupBy("p_type").agg(F.expr("percentile(p_retailprice, 0.5)").alias("precio"), F.count("*").alias("referencias")).where("referencias >= 3")
    return publish.with_summary_rows(detail, median, "es_sintetica")


@query("""select ruta, strptime(anio_mes || '-01', '%Y-%m-%d')::date as mes, strptime(replace(anio_mes, '-', '') || '01', '%Y%m%d')::date as mes_compacto from archivo_declarado""")
def meses_leidos(spark: SparkSession, folder: str) -> DataFrame:
    """Months of declared files as dates, from either way to write them."""
    return read_table(spark, folder, "archivo_declarado").select("ruta", calendar.month_date("anio_mes").alias("mes"), calendar.month_date(F.translate("anio_mes", "-", "")).alias("mes_compacto"))


# --- matching ------------------------------------------------------------------------------------

_DECISION_SQL = _KNN_SQL + """, f as (select *, lead(d) over (partition by q order by d, cast(b as varchar)) - d as margen from k where lugar <= 2),
x as (select q, b, d, case when d > 0.75 then 'sin_match' when la = lb and margen >= 0.05 and la <> 3 then 'match' else 'cuarentena' end as decision,
  case when coalesce(margen >= 0.05, false) then case when la = lb then 'estrato_forzado' else 'guarda' end else 'margen' end as m from f where lugar = 1 and q % 10 <> 0)
"""


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    """First candidates of all vectors but every tenth, decided; label 3 is a stratum set aside whatever comes."""
    told = _first_candidates(spark, folder).where(F.col("q").cast("bigint") % 10 != 0)
    delta, guard = 0.05, F.col("acierto")
    ruled = matching.decision(F.col("distancia"), F.col("margen"), guard & ~matching.any_pair([{"la": "3"}]), F.lit(True), 0.75, 0.75, delta)
    return told.withColumn("decision", ruled).withColumn("motivo", matching.quarantine_reason(F.col("margen"), guard, delta))


@query(_DECISION_SQL + """
select cast(e.vec_id as varchar) as q, case when coalesce(x.decision, 'sin_match') <> 'sin_match' then cast(x.b as varchar) end as b, case when coalesce(x.decision, 'sin_match') <> 'sin_match' then round(x.d, 5) end as distancia, coalesce(x.decision, 'sin_match') as decision
from embeddings e left join x on x.q = e.vec_id""")
def decisiones(spark: SparkSession, folder: str) -> DataFrame:
    """The decision on every vector of the universe, its candidate where there is one."""
    universe = read_table(spark, folder, "embeddings").select(F.col("vec_id").cast("string").alias("q"))
    told = matching.decisions(universe, _judged(spark, folder), "q", ["b", "distancia"])
    return told.select("q", "b", F.round("distancia", 5).alias("distancia"), "decision")


@query(_DECISION_SQL + "select m as motivo, count(*) as n from x where decision = 'cuarentena' group by 1")
def motivos_cuarentena(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates set aside, by reason."""
    return _judged(spark, folder).where("decision = 'cuarentena'").groupBy("motivo").agg(F.count("*").alias("n"))


_SIGNALS_SQL = (
    _ATTR_SQL.replace("select ndf_id, upper(trim(", "select id as ndf_id, upper(trim(").replace("producto || ' ' || presentacion", "txt")
    .replace("from dim_ndf),", "from (select 'n' || ndf_id as id, any_value(producto || ' ' || presentacion) as txt from dim_ndf group by 1 union all select 'p' || producto_key, any_value(descripcion) from dim_producto group by 1)),", 1).rstrip()
    + """,
k as (select try_cast(ndf_id as bigint) % 97 as k, min(ndf_id) as ndf_id from dim_ndf group by 1), n as (select ndf_id, min(producto) as producto from dim_ndf group by 1),
c as (select p.producto_key, p.tienda_key, n.ndf_id, n.producto from dim_producto p join k on p.dias_observados % 97 = k.k join n on n.ndf_id = k.ndf_id)
select c.producto_key, c.ndf_id, coalesce(x.dosis_mg = y.dosis_mg, true) and coalesce(x.volumen_ml = y.volumen_ml, true) and coalesce(x.masa_g = y.masa_g, true) and coalesce(x.piezas = y.piezas, true) as guarda_ok,
  case when c.producto is not null then coalesce(len(list_filter(regexp_extract_all(upper(strip_accents(c.producto)), '[A-Z0-9]+'), lambda w: not list_contains(regexp_extract_all(x.t, '[A-Z0-9]+'), w))) = 0, false) end as marca_ok, c.tienda_key = 3 as es_forzada
from c join a x on x.ndf_id = 'p' || c.producto_key join a y on y.ndf_id = 'n' || c.ndf_id"""
)


@query(_SIGNALS_SQL)
def senales_candidato(spark: SparkSession, folder: str) -> DataFrame:
    """What speaks for a candidate of each listing, one taken from the catalogue by days observed modulo 97."""
    sold, known = read_table(spark, folder, "dim_producto"), read_table(spark, folder, "dim_ndf")
    entries = known.groupBy("ndf_id").agg(F.min("producto").alias("producto"), F.first(F.concat("producto", F.lit(" "), "presentacion")).alias("texto"))
    chosen = entries.groupBy((F.col("ndf_id").try_cast("bigint") % 97).alias("k")).agg(F.min("ndf_id").alias("ndf_id"))
    chosen = sold.select("producto_key", (F.col("dias_observados") % 97).alias("k")).join(chosen, "k").select("producto_key", "ndf_id")
    return matching.evaluated(chosen, sold, "producto_key", "descripcion", entries, "ndf_id", "texto", "producto", F.col("tienda_key") == 3)


@query("""
select producto_key, coalesce(a, b, c) as ndf_id, case when a is not null then 'aportadores' when b is not null then 'ean_cruzado' when c is not null then 'vectorial' end as metodo,
  coalesce((tienda_key = 1 and match_method = 'vectorial') or (tienda_key = 2 and match_method = 'aportadores'), false) as forzado
from (select producto_key, tienda_key, match_method, case when match_method = 'aportadores' then ndf_id end as a, case when match_method = 'ean_cruzado' then ndf_id end as b, case when dias_observados > 300 then 'V' || sku end as c from dim_producto)""")
def metodo_de_cruce(spark: SparkSession, folder: str) -> DataFrame:
    """The first of three methods that gives a listing a target (the last, the code of long-seen ones), and whether its stratum is forced aside."""
    own = lambda m: F.when(F.col("match_method") == m, F.col("ndf_id"))
    rows = read_table(spark, folder, "dim_producto").select("producto_key", F.col("tienda_key").cast("string").alias("tienda_key"), "match_method", own("aportadores").alias("a"), own("ean_cruzado").alias("b"), F.when(F.col("dias_observados") > 300, F.concat(F.lit("V"), "sku")).alias("c"))
    target, method = matching.first_method({"aportadores": "a", "ean_cruzado": "b", "vectorial": "c"})
    forced = matching.any_pair([{"tienda_key": "1", "match_method": "vectorial"}, {"tienda_key": "2", "match_method": "aportadores"}])
    return rows.select("producto_key", target.alias("ndf_id"), method.alias("metodo"), forced.alias("forzado"))


@query("""
with s as (select c_custkey as k, c_nationkey as tienda, 75000000000 + c_custkey as n from customer),
u as (select k, tienda, cast(n as varchar) as sku, case when k % 3 = 0 then 'N' || (k % 7) end as t from s union all select k + 1000000, tienda + 100, '00' || n, case when k % 2 = 0 then 'N' || (k % 7) end from s union all select k + 2000000, tienda + 200, n || '1', null from s),
c as (select k, tienda, regexp_replace(sku, '^0+', '') as c, t from u), q as (select * from c where t is null), l as (select distinct tienda as s, c as d, t from c where t is not null),
e as (select q.k, l.t, 1 as r from q join l on q.c = l.d and q.tienda <> l.s where length(q.c) >= 8
  union all select q.k, l.t, 2 from q join l on length(q.c) = 13 and length(l.d) = 12 and substr(q.c, 1, 12) = l.d and q.tienda <> l.s
  union all select q.k, l.t, 2 from q join l on length(q.c) = 12 and length(l.d) = 13 and q.c = substr(l.d, 1, 12) and q.tienda <> l.s),
w as (select k, min(r) as r from e group by 1)
select e.k, min(e.t) as t, e.r as regla from e join w on w.k = e.k and w.r = e.r group by e.k, e.r having min(e.t) = max(e.t)""")
def codigos_prestados(spark: SparkSession, folder: str) -> DataFrame:
    """Targets lent by equal long codes of other shops, over codes made from customers."""
    base = read_table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("bigint").alias("tienda"), (F.lit(75000000000) + F.col("c_custkey")).cast("string").alias("n"))
    target = lambda test: F.when(test, F.concat(F.lit("N"), (F.col("k") % 7).cast("string")))
    made = (
        base.select("k", "tienda", F.col("n").alias("sku"), target(F.col("k") % 3 == 0).alias("t"))
        .unionByName(base.select((F.col("k") + 1000000).alias("k"), (F.col("tienda") + 100).alias("tienda"), F.concat(F.lit("00"), "n").alias("sku"), target(F.col("k") % 2 == 0).alias("t")))
        .unionByName(base.select((F.col("k") + 2000000).alias("k"), (F.col("tienda") + 200).alias("tienda"), F.concat("n", F.lit("1")).alias("sku"), F.lit(None).cast("string").alias("t")))
    )
    return matching.cross_store(made, "k", "tienda", "sku", "t")


@query("""
with k as (select a.vec_id as q, b.vec_id as b, row_number() over (partition by a.vec_id order by round(list_cosine_distance(a.embedding::double[], b.embedding::double[]), 9), cast(b.vec_id as varchar)) as lugar from embeddings a join embeddings b on a.vec_id <> b.vec_id),
t as (select vec_id as q, label, (vec_id + 1) % (select count(*) from embeddings) as b from embeddings)
select label, count(*) as n, count(k.q) as hallados, round(count(k.q) / count(*), 6) as recall from t left join k on k.q = t.q and k.b = t.b and lugar <= 10 group by label""")
def recall_10(spark: SparkSession, folder: str) -> DataFrame:
    """Share of given targets among the ten nearest vectors, by label."""
    vectors = read_table(spark, folder, "embeddings")
    found = _neighbours(vectors, 10).select(F.col("q").cast("bigint").alias("q"), F.col("b").cast("bigint").alias("b"))
    truth = vectors.crossJoin(F.broadcast(vectors.agg(F.count("*").alias("_n")))).select(F.col("vec_id").cast("bigint").alias("q"), "label", ((F.col("vec_id") + 1) % F.col("_n")).cast("bigint").alias("b"))
    told = matching.recall_at(truth, found, "q", "b", ["label"])
    return told.select("label", "n", "hallados", F.round("recall", 6).alias("recall"))


@query("""
with t as (select distinct md5(descripcion) as h, descripcion from dim_producto where descripcion is not null), b as (select distinct md5(descripcion) as h from dim_producto where tienda_key <= 6 and descripcion is not null)
select h as texto_hash from t where h not in (select h from b) order by h limit 50""")
def lote_pendiente(spark: SparkSession, folder: str) -> DataFrame:
    """The next fifty texts without a vector in the bank, in order of hash: the batch is the feature."""
    texts = read_table(spark, folder, "dim_producto").where("descripcion is not null").select(F.md5("descripcion").alias("texto_hash"), "descripcion", "tienda_key")
    return state.next_batch(texts, texts.where("tienda_key <= 6"), "texto_hash", 50).select("texto_hash")


# --- aggregations and quality --------------------------------------------------------------------


@query("""select count(*) as filas, count(distinct (tienda_key, sku)) filter (tienda_key is not null and sku is not null) as llaves from dim_producto""")
def llaves_compuestas(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and distinct composite keys."""
    return relational.distinct_keys(read_table(spark, folder, "dim_producto"), ["tienda_key", "sku"])


@query("""select _archivo_origen, bool_and(fecha_parse_ok) as todas from precios_ext group by 1""")
def fechas_todas(spark: SparkSession, folder: str) -> DataFrame:
    """Files all of whose dates were read."""
    return relational.all_hold(read_table(spark, folder, "precios_ext"), ["_archivo_origen"], F.col("fecha_parse_ok"), "todas")


@query("""select descripcion, min(producto_key) as producto_key from dim_producto where descripcion is not null group by 1""")
def textos_unicos(spark: SparkSession, folder: str) -> DataFrame:
    """Each distinct listing text under its least key."""
    return relational.labelled_values(read_table(spark, folder, "dim_producto"), "descripcion", "producto_key")


@query("""
select 'traducidas' as que, count(*) as n from dim_producto p join dim_tienda t using (tienda_key)
union all select 'sin_traduccion', count(distinct e.tienda) from precios_ext e anti join dim_tienda t on t.tienda_slug = e.tienda""")
def traduccion_de_claves(spark: SparkSession, folder: str) -> DataFrame:
    """Keys put in another table's terms, and those that it lacks."""
    shops = read_table(spark, folder, "dim_tienda").withColumn("clave", F.col("tienda_key").cast("string"))
    done, _ = relational.translated(read_table(spark, folder, "dim_producto").select(F.col("tienda_key").cast("string").alias("k")), "k", shops, "clave", "tienda_slug")
    _, missing = relational.translated(read_table(spark, folder, "precios_ext").select("tienda"), "tienda", shops, "tienda_slug", "clave")
    return done.where("k is not null").agg(F.count("*").alias("n")).select(F.lit("traducidas").alias("que"), "n").unionByName(missing.agg(F.count("*").alias("n")).select(F.lit("sin_traduccion").alias("que"), "n"))


@query("""
with g as (select count(*) as n, count(distinct (ndf_id, tienda_key, mes)) as d, count(distinct ndf_id) * count(distinct tienda_key) * count(distinct mes) as w from mart_precio_cadena_mes),
r as (select tienda_key from (select tienda_key, rn from (select tienda_key, row_number() over (partition by tienda_key order by producto_key) as rn from dim_producto) where rn <= 3) group by 1 having count(*) <> 3)
select 'precision_acierto' as prueba, cast(coalesce((select avg(case when match_method = 'aportadores' then 1.0 else 0.0 end) from dim_producto where match_method is not null) < 0.97, false) as bigint) as fallas
union all select 'rangos_lugar', count(*) from r union all select 'cobertura_ndf_id', (select count(distinct ndf_id) from dim_ndf where ndf_id not in (select ndf_id from emb_ndf where ndf_id is not null)) union all select 'malla_ndf_id_tienda_key_mes', w - d + n - d from g""")
def dq_conciliacion(spark: SparkSession, folder: str) -> DataFrame:
    """Precision floor, complete ranks, coverage and complete grid, as failures."""
    sold = read_table(spark, folder, "dim_producto")
    judged = sold.where("match_method is not null").withColumn("acierto", F.col("match_method") == "aportadores")
    ranked = relational.top_k(sold.select("tienda_key", "producto_key"), ["tienda_key"], [F.col("producto_key")], 3)
    return quality.report(
        quality.least_precision(judged, "acierto", 0.97, "dim_producto"),
        quality.complete_ranks(ranked, ["tienda_key"], "lugar", 3, "dim_producto"),
        quality.covered(read_table(spark, folder, "dim_ndf"), read_table(spark, folder, "emb_ndf"), ["ndf_id"], "dim_ndf"),
        quality.complete_grid(read_table(spark, folder, "mart_precio_cadena_mes"), ["ndf_id", "tienda_key", "mes"], "mart_precio_cadena_mes"),
    ).select("prueba", "fallas")
