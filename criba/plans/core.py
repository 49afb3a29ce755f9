"""Queries of the general training-data problems over a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from criba.functions.text import single_spaced, squeeze
from criba.operators import badrows, drift
from criba.operators.history import attribute_versions
from criba.operators.spikes import flag_spikes
from criba.session import read_table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly prices that do not fit the course of their own chain and presentation."""
    prices = read_table(spark, folder, "mart_precio_cadena_mes")
    found = flag_spikes(prices, ["ndf_id", "tienda_key"], "mes", "precio")
    return found.select("ndf_id", "tienda_key", F.date_format("mes", "yyyy-MM-dd").alias("mes"))


def _capture_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return tuple(read_table(spark, folder, n) for n in ("archivo_declarado", "precios_ext", "captura_cruda", "dim_tienda"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every change of columns or kinds between a file and the serie's file before it."""
    return drift.changes(drift.file_schemas(*_capture_tables(spark, folder))).select("ruta", "cambio", "columna")


def p2_esquema_union(spark: SparkSession, folder: str) -> DataFrame:
    """The folded kind of each typed column over all files."""
    return drift.union_schema(drift.file_schemas(*_capture_tables(spark, folder)))


def p2_filas(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of all files under the canonical names and the union schema; what the data make of a typed column is written out."""
    rows = drift.consistent_rows(*_capture_tables(spark, folder))
    return rows.withColumns({c: F.col(c).cast("string") for c in drift.TYPED} | {f"{c}_leido": F.col(f"{c}_leido").cast("double") for c in ("precio_actual", "precio_oferta")})


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Rows set aside with their reasons."""
    return badrows.quarantined(badrows.checked_rows(*_capture_tables(spark, folder)))


def p3_validas(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without a reason to be set aside."""
    return badrows.valid_rows(badrows.checked_rows(*_capture_tables(spark, folder)))


def listing_content() -> dict[str, Column]:
    """What counts as content of a listing: no letter case, no kind or amount of white space, no URL query.

    Words that a blank parts are other words than one without it: ``5 MG`` is a new wording of ``5MG``.
    """
    no_query = lambda c: F.regexp_replace(F.lower(squeeze(c)), r"\?[^#]*", "")
    return {
        "descripcion": F.lower(single_spaced("descripcion")),
        "url_producto_actual": no_query("url_producto_actual"),
        "url_imagen_actual": no_query("url_imagen_actual"),
    }


def p5_versiones(spark: SparkSession, folder: str) -> DataFrame:
    """Every version of a listing's attributes with its period."""
    snapshots = read_table(spark, folder, "dim_producto_corte")
    return attribute_versions(snapshots, "producto_key", "fecha_corte", "cargado_en", listing_content())


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return p5_versiones(spark, folder).select("producto_key", day("valido_desde"), day("valido_hasta"))


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p2_esquema_union, p2_filas, p3_found, p3_validas, p5_found, p5_versiones)}

_DATE = r"""try_strptime(regexp_replace({}, '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g'), ['%d/%m/%y', '%Y-%m-%d %H:%M:%S', '%d/%m/%y %H:%M', '%d/%m/%Y %H:%M', '%Y-%m-%d'])"""

#: Captured lines cut into cells, joined to their file's columns, and the roles of these by known name.
_CELLS_SQL = r"""
with recursive_free as (select 1),
declared as (select ruta, serie, anio_mes, list_transform(case when not sin_header and coalesce(trim(primera_linea), '') <> '' then string_split(primera_linea, ',') else coalesce(columnas, []) end,
  lambda n: replace(strip_accents(lower(trim(n))), ' ', '_')) as nombres from archivo_declarado),
lines as (select _archivo_origen, _fila_num, linea, string_split(linea, '"') as p from captura_cruda where _fila_num > 0),
judged as (select *, len(p) > 1 and (len(p) % 2 = 0 or len(list_filter(range(1, len(p) + 1), lambda i: i % 2 = 1 and p[i] <> ''
    and ((i < len(p) and not suffix(p[i], ',')) or (i > 1 and not prefix(p[i], ','))))) > 0) as comillas from lines),
celled as (select *, list_transform(string_split(array_to_string(list_transform(range(1, len(p) + 1), lambda i: case when i % 2 = 0 then replace(p[i], ',', chr(57344))
    when p[i] = '' and i > 1 and i < len(p) then '"' else p[i] end), ''), ','), lambda c: replace(c, chr(57344), ',')) as celdas from judged),
laid as (select c._archivo_origen, _fila_num, comillas, celdas, nombres from celled c left join declared d on d.ruta = c._archivo_origen)
"""

_PRICE_NAMES = "['precio_actual', 'precio_normal', 'precio_regular', 'precio', 'precio_lista']"
_DATE_NAMES = "['fecha_captura', 'fecha', 'fecha_hora_captura', 'fecha_registro', 'capturado_en']"
_PRICE_BAD = r"""not (upper({t}) in ('', 'NO DISPONIBLE', 'N/A', 'NULL', '#N/D')) and not coalesce(regexp_full_match(
  case when not contains({x}, ',') or contains({x}, '.') then replace(replace({x}, ',', ''), '.', '') || case when contains(replace({x}, ',', ''), '.') and (suffix({x}, '.') or prefix({x}, '.')) then 'x' else '' end
       when len(string_split({x}, ',')[-1]) = 3 then replace({x}, ',', '') when len(string_split({x}, ',')[-1]) in (1, 2) and len(string_split({x}, ',')) = 2 then replace({x}, ',', '') end, '[0-9]+'), false)"""
_TRIM = r"regexp_replace(coalesce({}, ''), '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g')"
_BARE = r"regexp_replace(translate({}, '$ ' || chr(160), ''), '\.+$', '')"


def _bad_price(column: str) -> str:
    t = _TRIM.format(column)
    return _PRICE_BAD.format(t=t, x=_BARE.format(t))


_RAW_COLUMNS = ("sku_raw", "url_producto", "producto", "precio_actual_raw", "precio_oferta_raw", "url_imagen", "fecha_captura_raw", "tienda_raw")

_P3_SQL = (
    _CELLS_SQL
    + f""", cells as (select *, list_filter(range(1, len(nombres) + 1), lambda i: list_contains({_PRICE_NAMES}, nombres[i]))[1] as ip,
  list_filter(range(1, len(nombres) + 1), lambda i: list_contains({_DATE_NAMES}, nombres[i]))[1] as id from laid),
picked as (select _archivo_origen, _fila_num, comillas, celdas, nombres, celdas[ip] as precio, celdas[id] as fecha from cells),
loaded as (select _archivo_origen, _fila_num, precio_actual_raw as precio, fecha_captura_raw as fecha,
  {' and '.join(f"{_TRIM.format(c)} = ''" for c in _RAW_COLUMNS)} as vacia from precios_ext),
whole as (select _archivo_origen, _fila_num, precio, fecha, case when not comillas and len(list_filter(celdas, lambda c: regexp_replace(c, '[\\s\\x{{a0}}]+', '', 'g') <> '')) = 0 then 'fila_vacia'
  when comillas then 'comillas' when len(celdas) <> len(nombres) then 'columnas' end as m from picked
  union all select _archivo_origen, _fila_num, precio, fecha, case when vacia then 'fila_vacia' end from loaded)
select _archivo_origen, _fila_num, m as motivo from whole where m is not null
union all select _archivo_origen, _fila_num, 'precio_actual' from whole where m is null and {_bad_price('precio')}
union all select _archivo_origen, _fila_num, 'fecha_captura' from whole where m is null and {_DATE.format("coalesce(fecha, '')")} is null"""
).replace("with recursive_free as (select 1),\n", "with ")

_P5_SQL = r"""
with norm as (select producto_key, fecha_corte, cargado_en, trim(lower(regexp_replace(descripcion, '[\s\x{a0}]+', ' ', 'g'))) as d,
    regexp_replace(lower(regexp_replace(url_producto_actual, '[\s\x{a0}]+', '', 'g')), '\?[^#]*', '') as u, regexp_replace(lower(regexp_replace(url_imagen_actual, '[\s\x{a0}]+', '', 'g')), '\?[^#]*', '') as i from dim_producto_corte),
last as (select * from norm qualify row_number() over (partition by producto_key, fecha_corte order by cargado_en desc, d desc, u desc, i desc) = 1),
filled as (select producto_key, fecha_corte, last_value(d ignore nulls) over w as d, last_value(u ignore nulls) over w as u, last_value(i ignore nulls) over w as i from last
    window w as (partition by producto_key order by fecha_corte rows between unbounded preceding and current row)),
marked as (select *, lag(fecha_corte) over w is null or d is distinct from lag(d) over w or u is distinct from lag(u) over w or i is distinct from lag(i) over w as fresh from filled
    window w as (partition by producto_key order by fecha_corte))
select producto_key, strftime(fecha_corte, '%Y-%m-%d') as valido_desde, coalesce(strftime(lead(fecha_corte) over (partition by producto_key order by fecha_corte), '%Y-%m-%d'), '9999-12-31') as valido_hasta
from marked where fresh"""

_P5_VERSIONS_SQL = (
    _P5_SQL.replace("fecha_corte, cargado_en, trim(lower(", "fecha_corte, cargado_en, descripcion, url_producto_actual, url_imagen_actual, trim(lower(")
    .replace("order by cargado_en desc, d desc, u desc, i desc)", "order by cargado_en desc, d desc, u desc, i desc, descripcion desc, url_producto_actual desc, url_imagen_actual desc)")
    .replace("ignore nulls) over w as i from last", "ignore nulls) over w as i, last_value(descripcion ignore nulls) over w as descripcion, last_value(url_producto_actual ignore nulls) over w as url_producto_actual, last_value(url_imagen_actual ignore nulls) over w as url_imagen_actual from last")
    .replace("select producto_key, strftime(fecha_corte, '%Y-%m-%d') as valido_desde, coalesce(strftime(lead(fecha_corte) over (partition by producto_key order by fecha_corte), '%Y-%m-%d'), '9999-12-31') as valido_hasta",
             "select producto_key, fecha_corte as valido_desde, coalesce(lead(fecha_corte) over (partition by producto_key order by fecha_corte), date '9999-12-31') as valido_hasta, descripcion, url_producto_actual, url_imagen_actual")
)


#: Names of the test tables' columns, for the SQL only: the operator tells them by content.
_ROLE_NAMES_SQL = {
    "sku": ("sku", "cod_art", "clave"),
    "url_producto": ("url_producto", "enlace", "liga_producto"),
    "producto": ("producto", "nombre", "articulo"),
    "precio_actual": ("precio_actual", "precio_normal", "precio_regular", "precio", "precio_lista"),
    "precio_oferta": ("precio_oferta", "precio_promo", "rebaja"),
    "url_imagen": ("url_imagen", "imagen", "foto_url"),
    "fecha_captura": ("fecha_captura", "fecha", "fecha_hora_captura", "fecha_registro", "capturado_en"),
    "tienda": ("tienda", "sucursal", "cadena"),
}


def _role_sql(name: str) -> str:
    whens = " ".join(f"when {name} in ({', '.join(repr(n) for n in names)}) then '{role}'" for role, names in _ROLE_NAMES_SQL.items())
    return f"case {whens} end"


_DAY = r"([0-9]{1,2}/[0-9]{1,2}/([0-9]{2}|[0-9]{4})|[0-9]{4}-[0-9]{1,2}-[0-9]{1,2})"
_KIND_SQL = rf"""case when upper(t) in ('', 'NO DISPONIBLE', 'N/A', 'NULL', '#N/D', 'NONE', 'NAN', 'SIN FECHA') then 'vacio' when regexp_full_match(t, '[0-9]+(\.[0-9]+)?') then 'numero'
  when regexp_full_match(t, '{_DAY}') then 'fecha' when regexp_full_match(t, '{_DAY}[T\s]+[0-9]{{1,2}}:[0-9]{{1,2}}(:[0-9]{{1,2}})?Z?') then 'fecha_hora' else 'texto' end"""
_AT = "list_filter(range(1, len(nombres) + 1), lambda i: list_contains({}, nombres[i]))[1]"

_P2_KINDS_SQL = (
    _CELLS_SQL.replace("with recursive_free as (select 1),\n", "with ")
    + f""", vals as (select _archivo_origen as ruta, precio_actual_raw as pa, precio_oferta_raw as po, fecha_captura_raw as fe from precios_ext
  union all select _archivo_origen, celdas[{_AT.format(_PRICE_NAMES)}], celdas[{_AT.format("['precio_oferta', 'precio_promo', 'rebaja']")}], celdas[{_AT.format(_DATE_NAMES)}]
  from laid where not comillas and len(celdas) = len(nombres)),
long as (select ruta, 'precio_actual' as c, {_TRIM.format('pa')} as t from vals union all select ruta, 'precio_oferta', {_TRIM.format('po')} from vals union all select ruta, 'fecha_captura', {_TRIM.format('fe')} from vals),
kinds as (select ruta, c, {_KIND_SQL} as k, count(*) as n from long group by all),
most as (select ruta, c, first(k order by n desc, list_position(['numero', 'fecha', 'fecha_hora', 'texto'], k)) as k from kinds where k <> 'vacio' group by 1, 2)"""
)
_P2_SQL = _P2_KINDS_SQL + f""",
seq as (select ruta, nombres, lag(ruta) over (partition by serie order by anio_mes, ruta) as r0, lag(nombres) over (partition by serie order by anio_mes, ruta) as n0 from declared where serie is not null),
fresh as (select ruta, n, {_role_sql('n')} as rol from (select ruta, unnest(list_filter(nombres, lambda x: not list_contains(n0, x))) as n from seq where r0 is not null)),
gone as (select ruta, n, {_role_sql('n')} as rol from (select ruta, unnest(list_filter(n0, lambda x: not list_contains(nombres, x))) as n from seq where r0 is not null)),
named as (select ruta, n, {_role_sql('n')} as rol from (select ruta, unnest(nombres) as n from seq))
select f.ruta, case when g.n is null then 'agregada' else 'renombrada' end as cambio, f.n as columna from fresh f left join gone g on g.ruta = f.ruta and g.rol = f.rol
union all select g.ruta, 'eliminada', g.n from gone g left join fresh f on g.ruta = f.ruta and g.rol = f.rol where f.n is null
union all select s.ruta, 'tipo', n.n from seq s join most a on a.ruta = s.ruta join most b on b.ruta = s.r0 and b.c = a.c join named n on n.ruta = s.ruta and n.rol = a.c where a.k <> b.k"""

#: Kinds that meet in another than themselves: a date in a date with time, all else in text.
_P2_UNION_SQL = _P2_KINDS_SQL + """,
found as (select distinct c as columna, k from most)
select columna, case when count(*) = 1 then min(k) when max(case when k in ('fecha', 'fecha_hora') then 0 else 1 end) = 0 then 'fecha_hora' else 'texto' end as tipo, count(*) as variantes
from found group by columna"""


def _cell_sql(role: str) -> str:
    names = "[" + ", ".join(f"'{n}'" for n in _ROLE_NAMES_SQL[role]) + "]"
    return f"case when not comillas and len(celdas) = len(nombres) then celdas[{_AT.format(names)}] end"


def _number_sql(x: str) -> str:
    """A price text as a number, by splitting at commas and dots."""
    t = _BARE.format(_TRIM.format(x))
    points = f"case when not contains({t}, ',') then {t} when contains({t}, '.') then replace({t}, ',', '') when len(string_split({t}, ',')[-1]) = 3 then replace({t}, ',', '') when len(string_split({t}, ',')[-1]) in (1, 2) then replace({t}, ',', '.') end"
    one = f"case when len(string_split({points}, '.')) > 2 then array_to_string(string_split({points}, '.')[:-2], '') || '.' || string_split({points}, '.')[-1] else {points} end"
    return f"case when upper({_TRIM.format(x)}) not in ('', 'NO DISPONIBLE', 'N/A', 'NULL', '#N/D') and regexp_full_match({one}, '[0-9]+(\\.[0-9]+)?') then try_cast({one} as double) end"


def _joint_sql(c: str, read: str) -> str:
    return f"case (select tipo from joint where columna = '{c}') when 'texto' then case when {c} is not null then {_TRIM.format(c)} end when 'fecha' then {read}[:10] else {read} end as {c}"


_P2_ROWS_SQL = (
    _P2_UNION_SQL.replace("select columna, case when count(*)", "joint as (select columna, case when count(*)").replace("k from most)\njoint", "k from most),\njoint")
    + f"""), every as (select _archivo_origen, _fila_num, {", ".join(f"{raw} as {c}" for c, raw in zip(_ROLE_NAMES_SQL, _RAW_COLUMNS))} from precios_ext
  union all select _archivo_origen, _fila_num, {", ".join(_cell_sql(c) for c in _ROLE_NAMES_SQL)} from laid)
select _archivo_origen, _fila_num, sku, url_producto, producto, url_imagen, tienda,
  {", ".join(_joint_sql(c, f"cast(cast({_number_sql(c)} as decimal(38, 9)) as varchar)") for c in ("precio_actual", "precio_oferta"))},
  {_joint_sql("fecha_captura", f"strftime({_DATE.format("coalesce(fecha_captura, '')")}, '%Y-%m-%d %H:%M:%S')")},
  {", ".join(f"{_number_sql(c)} as {c}_leido" for c in ("precio_actual", "precio_oferta"))}, {_DATE.format("coalesce(fecha_captura, '')")} as fecha_captura_leido,
  precio_actual as precio_actual_raw, precio_oferta as precio_oferta_raw, fecha_captura as fecha_captura_raw from every"""
)

#: Rows of P3 without a reason.
_P3_VALID_SQL = (
    _P2_ROWS_SQL.split("\nselect _archivo_origen, _fila_num, sku,")[0]
    + f""", bad as ({_P3_SQL})
select _archivo_origen, _fila_num, {", ".join(_ROLE_NAMES_SQL)} from every anti join (select distinct _archivo_origen, _fila_num from bad) using (_archivo_origen, _fila_num)"""
)


_MIDDLE = "list_aggregate(list_filter([{}], lambda a: a is not null), 'median')"

#: The rules of the spikes by windows over each source's sound readings; sources are of less than twenty years.
_P1_SQL = f"""
with r as (select distinct ndf_id, tienda_key, mes, cast(precio as double) as v from mart_precio_cadena_mes where precio is not null and mes is not null),
m as (select *, median(case when v > 0.05 and v < 50000 then v end) over (partition by ndf_id, tienda_key) as med from r),
j as (select *, coalesce(v > 0.05 and v < 50000 and v / med < 20 and v / med > 1 / 20.0, false) as bueno from m),
q as (select *, ln(v) as x, row_number() over o as i, count(*) over (partition by ndf_id, tienda_key) as n, lag(v) over o as v0 from j where bueno window o as (partition by ndf_id, tienda_key order by mes, v)),
g as (select *, sum(case when v0 is distinct from v then 1 else 0 end) over (partition by ndf_id, tienda_key order by i) as racha from q where n >= 3),
h as (select *, count(*) over (partition by ndf_id, tienda_key, racha) as largo, row_number() over (partition by ndf_id, tienda_key, racha order by i) - 1 as lugar from g),
c as (select *, x - lag(x) over o as cambio, lag(largo) over o as largo0, lag(x, 1) over o as l1, lag(x, 2) over o as l2, lag(x, 3) over o as l3, lead(x, 1) over o as f1, lead(x, 2) over o as f2, lead(x, 3) over o as f3, lead(x, 4) over o as f4
  from h window o as (partition by ndf_id, tienda_key order by i)),
d as (select *, cambio is not null and not (largo >= 6 and lugar > 0) and cambio <> 0 as movio, cambio is not null and largo < 6 and largo0 < 6 as libre from c),
e as (select *, count(case when movio and libre then 1 end) over s >= greatest(5, 0.7 * count(case when libre then 1 end) over s) as mueve, median(case when movio then abs(cambio) end) over s as m1, median(abs(cambio)) over s as m2 from d window s as (partition by ndf_id, tienda_key)),
k as (select *, greatest(0.1, 6 * 1.4826 * (case when mueve then m1 else m2 end) / sqrt(2)) as menor, x - {_MIDDLE.format('l2, l1, f1, f2')} as lejos, {_MIDDLE.format('l3, l2, l1')} as antes from e),
t as (select *, 1 as cuantos, f1 as sigue, x as ultimo, {_MIDDLE.format('f1, f2, f3')} as luego from k where f1 is not null and abs(cambio) >= 0.5 * menor
  union all select *, 2, f2, f1, {_MIDDLE.format('f2, f3, f4')} from k where f2 is not null and abs(cambio) >= 0.5 * menor),
u as (select *, sign(x - antes) as lado, least(sign(x - antes) * (x - antes), sign(x - antes) * (x - luego), sign(x - antes) * (ultimo - antes), sign(x - antes) * (ultimo - luego)) as desvio from t),
w as (select * from u where desvio >= menor and lado * cambio >= 0.5 * desvio and lado * (ultimo - sigue) >= 0.5 * desvio
  and least(abs(luego - antes), abs(sigue - l1)) <= 0.5 * (abs(x - (antes + luego) / 2) + abs(ultimo - (antes + luego) / 2)) / 2),
y as (select a.ndf_id, a.tienda_key, a.i, p.p, count(case when b.lejos <= -0.4 * a.desvio then 1 end) as bajas, count(*) as todas from w a join k b on b.ndf_id is not distinct from a.ndf_id and b.tienda_key is not distinct from a.tienda_key
  join range(2, 13) p(p) on abs(date_diff('month', a.mes, b.mes)) % p.p = 0 where a.lado < 0 and a.cuantos = 1 group by all),
z as (select * from w where not (lado < 0 and cuantos = 1 and exists (select 1 from y where y.ndf_id is not distinct from w.ndf_id and y.tienda_key is not distinct from w.tienda_key and y.i = w.i and bajas >= 3 and bajas >= 0.75 * todas))),
malas as (select ndf_id, tienda_key, mes from j where not bueno
  union select k.ndf_id, k.tienda_key, k.mes from k join z on k.ndf_id is not distinct from z.ndf_id and k.tienda_key is not distinct from z.tienda_key and k.i between z.i and z.i + z.cuantos - 1
  union select ndf_id, tienda_key, mes from k where mueve and largo >= 6 and lugar > 0)
select ndf_id, tienda_key, strftime(mes, '%Y-%m-%d') as mes from malas"""

ORACLES = {"p1_found": _P1_SQL, "p2_found": _P2_SQL, "p2_esquema_union": _P2_UNION_SQL, "p2_filas": _P2_ROWS_SQL, "p3_found": _P3_SQL, "p3_validas": _P3_VALID_SQL, "p5_found": _P5_SQL, "p5_versiones": _P5_VERSIONS_SQL}
