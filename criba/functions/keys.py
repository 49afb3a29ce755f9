"""Keys: surrogate hashes, padded codes, SKUs, URLs, deterministic splits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from criba.functions.text import as_column, strip

# SKU texts that stand for none, in upper case; and what a null part of a surrogate key is written as.
NO_SKU = ("", "SEARCH", "N/A")
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column | str) -> Column:
    """md5 (hexadecimal) of the parts as text, joined by hyphens; nulls have a text of their own."""
    return F.md5(F.concat_ws("-", *[F.coalesce(as_column(p).cast("string"), F.lit(NULL_PART)) for p in parts]))


def text_hash(text: Column | str, model: str, dimensions: int, task: str) -> Column:
    """Identity of an embedding request: md5 of model, dimensions, task and text."""
    return F.md5(F.concat_ws("|", F.lit(model), F.lit(str(dimensions)), F.lit(task), as_column(text)))


def parse_sku(c: Column | str) -> Column:
    """The SKU without outer blanks; null for texts that stand for none."""
    text = strip(c)
    return F.when(~F.upper(text).isin(*NO_SKU), text)


def sku_is_sentinel(c: Column | str) -> Column:
    return F.coalesce(F.upper(strip(c)).isin(*NO_SKU), F.lit(True))


def padded(code: Column | str, width: int = 15) -> Column:
    """Left-padded with zeros, or cut, to the width."""
    return F.lpad(as_column(code), width, "0")


def unpadded(code: Column | str) -> Column:
    """Without leading zeros; null where nothing is left."""
    return F.nullif(F.regexp_replace(strip(code), "^0+", ""), F.lit(""))


# Where the SKU stands in product URLs of different shops, by name of the form.
URL_SKU = {
    "html": r"/(\d+)\.html",
    "detalle": r"detarticulo/(\d+)",
    "guion_p": r"-(\d+)/p",
    "p": r"/p/([^/?#]+)",
    "final": r"/(\d+)(?:\?|$)",
    "cola": r"-([A-Za-z]?\d+)(?:[?#]|$)",
}


def sku_from_url(url: Column | str, form: str) -> Column:
    """The SKU that a product URL ends in, by the shop's form; null where it doesn't have it."""
    return F.nullif(F.regexp_extract(as_column(url), URL_SKU[form], 1), F.lit(""))


def canonical_url(url: Column | str, site: str | None = None) -> Column:
    """Without query and fragment; a relative URL on ``site`` where one is given."""
    bare = F.regexp_replace(strip(url), r"[?#].*$", "")
    if site is None:
        return bare
    return F.when(bare.startswith("/"), F.concat(F.lit(site.rstrip("/")), bare)).otherwise(bare)


def split_half(key: Column | str) -> Column:
    """``calibracion`` or ``reserva``, by the parity of the key's md5: stable across runs and engines."""
    return F.when(F.conv(F.substring(F.md5(as_column(key).cast("string")), 1, 1), 16, 10).cast("int") % 2 == 0, "calibracion").otherwise("reserva")
