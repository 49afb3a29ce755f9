"""Price texts: sentinels, separators, readable or not."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from criba.functions.text import as_column, bind, strip

# Texts that say there is no price, compared in upper case and without outer blanks.
NO_PRICE = ("", "NO DISPONIBLE", "N/A", "NULL", "#N/D")

PRICE_TYPE = "decimal(38,9)"


def is_no_price(c: Column | str) -> Column:
    """True where the text says that there is no price; a null text counts as blank."""
    return F.upper(F.coalesce(strip(c), F.lit(""))).isin(*NO_PRICE)


def price_digits(c: Column | str) -> Column:
    """The text as a plain number (``1787.00``) or null where its form is not one.

    Dollar signs, blanks and trailing dots go. With comma and dot the comma parts
    thousands; a lone comma does so before three digits and is the decimal sign
    before one or two. Of several dots the last is the decimal sign.
    """
    return bind(F.rtrim(F.translate(strip(c), "$ \u00a0", ""), F.lit(".")), _plain_number)


def _plain_number(bare: Column) -> Column:
    after_comma = F.length(F.substring_index(bare, ",", -1))
    lone_comma = (
        F.when(after_comma == 3, F.translate(bare, ",", ""))
        .when(after_comma.isin(1, 2), F.translate(bare, ",", "."))
    )
    points = (
        F.when(~bare.contains(","), bare)
        .when(bare.contains("."), F.translate(bare, ",", ""))
        .otherwise(lone_comma)
    )
    one_point = F.regexp_replace(points, r"\.(?=.*\.)", "")
    return F.nullif(F.regexp_extract(one_point, r"\A([0-9]+(?:\.[0-9]+)?)\z", 1), F.lit(""))


def parse_price(c: Column | str) -> Column:
    """The price as decimal(38,9); null for sentinels and unreadable texts."""
    return F.when(~is_no_price(c), price_digits(c).try_cast(PRICE_TYPE))


def price_unreadable(c: Column | str) -> Column:
    """True where a price text is given that cannot be read; texts without a price are fine."""
    return ~is_no_price(c) & price_digits(c).isNull()


def price_flags(c: Column | str) -> Column:
    """Quality flags of one price text, an array of at most one name."""
    zero = price_digits(c).try_cast(PRICE_TYPE) == 0
    return (
        F.when(is_no_price(c), F.array(F.lit("PRECIO_NO_DISPONIBLE")))
        .when(price_digits(c).isNull(), F.array(F.lit("PRECIO_NO_PARSEABLE")))
        .when(zero, F.array(F.lit("PRECIO_CERO")))
        .otherwise(F.array().cast("array<string>"))
    )


def positive(c: Column | str) -> Column:
    """The value where it is above zero, else null."""
    return F.when(as_column(c) > 0, as_column(c))
