"""From captured rows to what is published: prices resolved, months complete, gaps filled by rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from criba.functions import keys
from criba.functions.text import as_column


def resolved_prices(listed: Column | str, sale: Column | str) -> tuple[Column, Column]:
    """List price and sale price of a row that may have either.

    A lone price is the list price. A sale price stands only beside a list price and below it.
    """
    a, b = as_column(listed), as_column(sale)
    return F.coalesce(a, b), F.when(a.isNotNull() & (b < a), b)


def discount(regular: Column | str, sale: Column | str) -> Column:
    """Share taken off the regular price, to four decimals; null without a sale price."""
    return F.round(1 - F.try_divide(as_column(sale).cast("double"), as_column(regular).cast("double")), 4)


def price_per(amount: Column | str, quantity: Column | str) -> Column:
    """An amount by unit of a quantity; null where that is null or zero."""
    return F.try_divide(as_column(amount).cast("double"), as_column(quantity).cast("double"))


def or_marked(c: Column | str, mark: str) -> Column:
    """The text, or a mark of the caller where it is null (``SIN_IMAGEN``)."""
    return F.coalesce(as_column(c), F.lit(mark))


def sku_or_from_url(sku: Column | str, url: Column | str, shop: Column | str, forms: dict[str, str]) -> Column:
    """The SKU, or for the shops named that of the URL by the shop's form (see ``keys.URL_SKU``); null for neither."""
    out = as_column(sku)
    for name, form in sorted(forms.items()):
        out = F.coalesce(out, F.when(as_column(shop) == name, keys.sku_from_url(url, form)))
    return out


def local_month(moment: str | None, zone: str) -> Column:
    """First day of the month that it is in a zone at a UTC moment (``yyyy-MM-dd HH:mm:ss``), by default now."""
    utc = F.current_timestamp() if moment is None else F.lit(moment).cast("timestamp")
    return F.trunc(F.from_utc_timestamp(utc, zone), "month")


def publishable_months(facts: DataFrame, day: str, place: str, first: str, least: int, moment: str | None = None, zone: str = "America/Mexico_City") -> DataFrame:
    """``mes, lugares``: months from ``first`` on with at least ``least`` places, before the month that is open in the zone."""
    counted = facts.select(F.trunc(F.col(day).cast("date"), "month").alias("mes"), place).groupBy("mes").agg(F.count_distinct(place).alias("lugares"))
    return counted.where((F.col("mes") >= F.lit(first).cast("date")) & (F.col("lugares") >= least) & (F.col("mes") < local_month(moment, zone)))


def with_summary_rows(detail: DataFrame, summary: DataFrame, mark: str) -> DataFrame:
    """Detail rows and synthetic ones under one schema: columns that either lacks are null, ``mark`` tells them apart."""
    return detail.withColumn(mark, F.lit(False)).unionByName(summary.withColumn(mark, F.lit(True)), allowMissingColumns=True)


def monthly_panel(facts: DataFrame, months: DataFrame, by: Sequence[str], place: str, day: str, listed: str, sale: str, listing: str) -> DataFrame:
    """The cheapest offer of each group and place in a published month, with its regular and sale price.

    ``by, place, mes, precio, precio_regular, precio_oferta, descuento_pct, listings_n``. Regular and sale price are of
    one listing and day; ties go to the lower regular price, the later day, the first listing.
    """
    effective = F.coalesce(F.col(sale), F.col(listed))
    rows = facts.withColumn("mes", F.trunc(F.col(day).cast("date"), "month")).withColumn("_p", effective)
    told = rows.join(months.select("mes"), "mes", "left_semi").groupBy(*by, place, "mes").agg(
        F.count_distinct(listing).alias("listings_n"),
        F.min_by(F.struct(F.col("_p").alias("precio"), F.col(listed).alias("precio_regular"), F.col(sale).alias("precio_oferta")), F.struct("_p", listed, -F.unix_date(F.col(day).cast("date")), listing)).alias("x"),
    )
    return told.select(*by, place, "mes", "x.*", discount("x.precio_regular", "x.precio_oferta").alias("descuento_pct"), "listings_n")
