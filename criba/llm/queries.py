"""Queries of the problems tagged llm over a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from criba.llm import bpe, forest, listings, packing, quantiles, topics
from criba.session import read_table


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """The five closest catalogue vectors of every listing vector."""
    found = forest.nearest(
        read_table(spark, folder, "emb_producto"), "producto_key", "embedding",
        read_table(spark, folder, "emb_ndf"), "ndf_id", "embedding", size=96, k=5,
    )
    return found.select("producto_key", "ndf_id")


def _products(spark: SparkSession, folder: str) -> DataFrame:
    sold, known = read_table(spark, folder, "dim_producto"), read_table(spark, folder, "dim_ndf")
    return listings.products(
        sold.select(F.col("producto_key").alias("clave"), F.coalesce("descripcion", "producto").alias("texto")),
        known.select(F.col("ndf_id").alias("clave"), F.concat_ws(" ", "producto", "presentacion").alias("texto"), F.col("producto").alias("marca"), "laboratorio", "molecula", F.col("cve_ff").alias("forma")),
    )


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of listings and catalogue entries of the same product."""
    return listings.pairs(_products(spark, folder))


def p6_grupos(spark: SparkSession, folder: str) -> DataFrame:
    """The product of every listing and catalogue entry, by the least key of its records."""
    return listings.groups(_products(spark, folder))


def p7_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Quartiles of chain prices by presentation, chain and month, and of market medians and first quartiles by month."""
    chains, market = read_table(spark, folder, "mart_precio_cadena_mes"), read_table(spark, folder, "mart_precio_ndf_mes")
    parts = quantiles.sketches(chains, "precio", {"precio/ndf_id": "ndf_id", "precio/tienda_key": "tienda_key", "precio/mes": "mes"})
    for column in ("precio_mediana", "precio_p25"):
        parts = parts.unionByName(quantiles.sketches(market, column, {f"{column}/mes": "mes"}))
    return quantiles.percentiles(parts, ["dimension", "grupo"])


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document."""
    return bpe.encode(read_table(spark, folder, "documents"), "doc_id", "text")


def p9_contenedores(spark: SparkSession, folder: str) -> DataFrame:
    """Container and place of every document in containers of 2,048 tokens."""
    sizes = bpe.token_counts(read_table(spark, folder, "documents"), "doc_id", "text")
    return packing.pack(sizes, "doc_id", "tokens", 2048)


def p8_resumen(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, and those without a token."""
    ids = p8_ids(spark, folder)
    return ids.agg(F.count("*").alias("documentos"), F.count_if(F.size("ids") == 0).alias("sin_fichas"), F.count_if(F.col("ids").isNull()).alias("nulos"))


def p9_resumen(spark: SparkSession, folder: str) -> DataFrame:
    """Documents placed; containers over their capacity, gaps or overlaps within them, and documents not whole: none."""
    sizes = bpe.token_counts(read_table(spark, folder, "documents"), "doc_id", "text")
    placed = packing.pack(sizes, "doc_id", "tokens", 2048)
    boxes = placed.groupBy("contenedor").agg(F.sum("largo").alias("lleno"), F.max(F.col("inicio") + F.col("largo")).alias("fin"))
    whole = placed.groupBy("doc_id").agg(F.sum("largo").alias("suma")).join(sizes.where("tokens > 0"), "doc_id", "full")
    counts = boxes.agg(F.count_if(F.col("lleno") > 2048).alias("excedidos"), F.count_if(F.col("lleno") != F.col("fin")).alias("con_huecos"))
    return whole.agg(F.count("suma").alias("documentos"), F.count_if(~F.col("suma").eqNullSafe(F.col("tokens"))).alias("incompletos")).crossJoin(counts)


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """The subject areas that each document deals with."""
    return _topics(spark, folder).select("doc_id", "tema")


def _topics(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels, subjects = (read_table(spark, folder, n) for n in ("documents", "doc_etiquetas", "temas"))
    return topics.assign_topics(documents, "doc_id", "text", labels, "tema", subjects)


def p10_composicion(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by subject area, and the text share given to it."""
    found = _topics(spark, folder).groupBy("tema")
    return found.agg(F.count("*").alias("documentos"), F.round(F.sum("parte"), 3).alias("partes"))


QUERIES = {f.__name__: f for f in (p4_found, p6_found, p6_grupos, p7_percentiles, p8_ids, p8_resumen, p9_contenedores, p9_resumen, p10_found, p10_composicion)}

_P4_SQL = """
with q as (select producto_key, embedding::double[] as v from emb_producto where len(embedding) = 96 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
b as (select ndf_id, embedding::double[] as v from emb_ndf where len(embedding) = 96 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
p as (select producto_key, ndf_id, row_number() over (partition by producto_key order by round(list_cosine_similarity(q.v, b.v), 9) desc, ndf_id) as lugar from q cross join b)
select producto_key, ndf_id from p where lugar <= 5"""

_P7_SQL = """
with v as (select 'precio/ndf_id' as dimension, ndf_id as grupo, cast(precio as double) as x from mart_precio_cadena_mes
  union all select 'precio/tienda_key', cast(tienda_key as varchar), cast(precio as double) from mart_precio_cadena_mes
  union all select 'precio/mes', cast(mes as varchar), cast(precio as double) from mart_precio_cadena_mes
  union all select 'precio_mediana/mes', cast(mes as varchar), cast(precio_mediana as double) from mart_precio_ndf_mes
  union all select 'precio_p25/mes', cast(mes as varchar), cast(precio_p25 as double) from mart_precio_ndf_mes),
g as (select dimension, grupo, count(*) as n, list_sort(list(x)) as s from v where x is not null group by 1, 2)
select dimension, grupo, n, cast(p as double) as p, s[cast(greatest(1, ceil(p * n - 1e-9)) as bigint)] as valor, cast(0.0 as double) as error_rango from g cross join (values (0.25), (0.5), (0.75)) t(p)"""

_NUMBER = r"([0-9]+(?:\.[0-9]+)?)"


#: Dosage forms of the test tables, for the SQL only: the operator learns them.
_FORM_SQL = """case when regexp_matches(r, '(^|[^A-Z])(GTS|GOTAS|SOL OFT)([^A-Z]|$)') then 'gotas'
  when regexp_matches(r, '(^|[^A-Z])(INY|INYECTABLE|AMP|AMPOLLETAS|AMPULAS)([^A-Z]|$)') then 'inyectable'
  when regexp_matches(r, '(^|[^A-Z])(CREM|CREMA|CRA)([^A-Z]|$)') then 'crema' when regexp_matches(r, '(^|[^A-Z])GEL([^A-Z]|$)') then 'gel'
  when regexp_matches(r, '(^|[^A-Z])(JBE|JARABE)([^A-Z]|$)') then 'jarabe' when regexp_matches(r, '(^|[^A-Z])(SUSP|SUSPENSION)([^A-Z]|$)') then 'suspension'
  when regexp_matches(r, '(^|[^A-Z])(TABL|TAB|TABS|TBS|TABLETA|TABLETAS)([^A-Z]|$)') then 'tableta'
  when regexp_matches(r, '(^|[^A-Z])(CAP|CAPS|CAPSULAS)([^A-Z]|$)') then 'capsula' when regexp_matches(r, '(^|[^A-Z])(GRAG|GRAGS|GRAGEAS)([^A-Z]|$)') then 'gragea' end"""

_P6_IDS_SQL = rf"""
with texts as (select producto_key as clave, null as marca, coalesce(descripcion, producto) as t from dim_producto where producto_key is not null
  union all select ndf_id, producto, producto || ' ' || coalesce(presentacion, '') from dim_ndf where ndf_id is not null),
plain as (select clave, regexp_extract(upper(strip_accents(marca)), '[A-Z]+') as marca, replace(upper(strip_accents(t)), ',', ' ') as t from texts where t is not null),
packed as (select *, regexp_replace(regexp_replace(t, 'PAQ\.? 2 PIEZAS|DUO 2 CAJAS|2X1 CAJA DOBLE|PAQUETE DOBLE|CAJA DOBLE|2 PACK', ' ', 'g'), '(^|[^A-Z0-9])X ?2($| )', ' ') as r from plain),
formed as (select *, case when r <> t then 2 else 1 end as envases, {_FORM_SQL} as forma from packed),
kinds as (select *, forma in ('tableta', 'capsula', 'gragea', 'inyectable') as solido, forma in ('crema', 'gel') as untable from formed),
doses as (select *, case when regexp_matches(r, '{_NUMBER} ?(MGS|MG|MCG) ?/ ?(ML|G)\b') then '{_NUMBER} ?(MGS|MG|MCG) ?/ ?(?:ML|G)\b'
    when not solido and not untable and regexp_matches(r, '{_NUMBER} ?(MGS|MG|MCG|GR|G) ?(/|EN)? ?5 ?ML\b') then '{_NUMBER} ?(MGS|MG|MCG|GR|G) ?(?:/|EN)? ?5 ?ML\b'
    when regexp_matches(r, '{_NUMBER} ?%') then '{_NUMBER} ?(%)' when solido then '{_NUMBER} ?(MGS|MG|MCG|GR|G)\b' end as pat from kinds),
strong as (select *, try_cast(regexp_extract(r, pat, 1) as double) * case regexp_extract(r, pat, 2) when 'MCG' then 0.001 when 'G' then 1000 when 'GR' then 1000 when '%' then 10 else 1 end
    / case when contains(pat, '5 ?ML') then 5 else 1 end as fuerza, regexp_replace(r, pat, ' ') as s from doses),
filled as (select *, round(fuerza, 6) as f, case when untable then try_cast(regexp_extract(s, '{_NUMBER} ?(KG|GRAMOS|GR|G)\b', 1) as double) * case regexp_extract(s, '{_NUMBER} ?(KG|GRAMOS|GR|G)\b', 2) when 'KG' then 1000 else 1 end
    when solido then try_cast(regexp_extract(s, '[0-9]+') as double)
    else try_cast(regexp_extract(s, '{_NUMBER} ?(ML|L)\b', 1) as double) * case regexp_extract(s, '{_NUMBER} ?(ML|L)\b', 2) when 'L' then 1000 else 1 end end as contenido from strong),
brands as (select distinct marca as b from filled where marca is not null),
words as (select clave, forma, f, contenido, unnest(list_distinct(regexp_extract_all(t, '[A-Z]+'))) as w from filled where marca is null),
hits as (select clave, b, 0 as d from words join brands on w = b),
near as (select clave, b, 1 as d, w.forma, w.f, w.contenido from words w join brands on length(w) >= 4 and length(b) >= 4 and damerau_levenshtein(w, b) = 1 where clave not in (select clave from hits)),
ranked as (select n.clave, b, row_number() over (partition by n.clave order by exists (select 1 from filled c where c.marca = n.b and c.forma = n.forma and c.f = n.f and c.contenido = n.contenido) desc, b) as k from near n),
named as (select clave, min(b) as b from hits group by 1 union all select clave, b from ranked where k = 1 union all select clave, marca from filled where marca is not null),
ids as (select distinct clave, concat_ws('|', b, coalesce(forma, '-'), coalesce(cast(f as varchar), '-'), coalesce(cast(round(contenido, 6) as varchar), '-'), envases) as p from filled join named using (clave))
"""
_P6_SQL = _P6_IDS_SQL + """select x.clave as clave_a, y.clave as clave_b from ids x join ids y on x.p = y.p and x.clave < y.clave"""
#: Records without a brand are a product of their own.
_P6_GROUPS_SQL = _P6_IDS_SQL + """select clave, min(clave) over (partition by p) as producto from ids
union all select distinct clave, clave from filled where clave not in (select clave from ids)"""

_P8_SUMMARY_SQL = "select count(*) as documentos, count(case when coalesce(text, '') = '' then 1 end) as sin_fichas, 0 as nulos from documents where doc_id is not null"
_P9_SUMMARY_SQL = "select count(*) as documentos, 0 as incompletos, 0 as excedidos, 0 as con_huecos from documents where text <> '' and doc_id is not null"

#: The percentiles equal the SQL's where no group has more values than a sketch holds exactly.
#: The products' SQL takes brands of one word, as the test tables have, and compares all words with all brands.
#: Tokens, containers and subjects have no SQL beyond summaries; tests hold them against other means.
ORACLES = {"p4_found": _P4_SQL, "p6_found": _P6_SQL, "p6_grupos": _P6_GROUPS_SQL, "p7_percentiles": _P7_SQL, "p8_resumen": _P8_SUMMARY_SQL, "p9_resumen": _P9_SUMMARY_SQL}
