"""Price texts as different shops' pages show them: one column expression a form.

The forms disagree on separators, on what stands for no price and on how a sale
price is told from the regular one; ``prices.parse_price`` reads what they give.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from criba.functions.text import as_column, strip


def first_amount(c: Column | str) -> Column:
    """The first number with up to two decimals once ``$`` and commas are gone; ``0.00`` for none."""
    found = F.regexp_extract(F.translate(as_column(c), "$,", ""), r"(\d+(?:\.\d{1,2})?)", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("0.00"))


def commas_to_dots(c: Column | str) -> Column:
    """Digits, commas and dots only, commas turned to dots (``$1,173.00`` gives ``1.173.00``)."""
    return F.translate(F.regexp_replace(as_column(c), r"[^\d,.]", ""), ",", ".")


def digits_and_dots(c: Column | str) -> Column:
    """Digits and dots only (``$31.67 c/u.`` gives ``31.67.``)."""
    return F.regexp_replace(as_column(c), r"[^0-9.]", "")


def two_decimals(c: Column | str) -> Column:
    """A number with thousands commas and two decimals (``1,234.50``); null where there is none."""
    return F.format_number(F.translate(as_column(c).cast("string"), "$, ", "").try_cast("double"), 2)


def fixed_point(c: Column | str) -> Column:
    """A number with two decimals and no thousands signs; ``0.00`` for none."""
    value = F.translate(as_column(c).cast("string"), "$, ", "").try_cast("double")
    return F.format_string("%.2f", F.coalesce(value, F.lit(0.0)))


def cents_amount(c: Column | str) -> Column:
    """``$x.xx`` from the first amount with two decimals; the states a page shows instead stay as they are."""
    text = F.upper(strip(c))
    amount = F.regexp_extract(as_column(c), r"([\d,]+\.\d{2})", 1)
    return (
        F.when(text.contains("COTIZACION REQUERIDA"), "COTIZACION REQUERIDA")
        .when(text.contains("NO DISPONIBLE"), "NO DISPONIBLE")
        .when(amount != "", F.concat(F.lit("$"), F.translate(amount, ",", "")))
        .otherwise("")
    )


def whole_and_fraction(c: Column | str) -> Column:
    """``x.xx`` of a text whose cents follow a dot, a comma or a blank; null for none."""
    shape = r"(\d[\d,]*)[.,\s](\d{2})(?!\d)"
    whole = F.translate(F.regexp_extract(as_column(c), shape, 1), ",", "")
    return F.when(whole != "", F.concat_ws(".", whole, F.regexp_extract(as_column(c), shape, 2)))


def or_unavailable(c: Column | str) -> Column:
    """The text, or ``No disponible`` where it is blank or null."""
    return F.coalesce(F.nullif(strip(c), F.lit("")), F.lit("No disponible"))


def backfilled(regular: Column, sale: Column) -> tuple[Column, Column]:
    """Regular and sale amounts that stand in for each other where one is null or zero."""
    some = lambda a, b: F.coalesce(F.nullif(a, F.lit(0).cast("double")), F.nullif(b, F.lit(0).cast("double")))
    return some(regular, sale), some(sale, regular)


def sale_capped(regular: Column, sale: Column) -> tuple[Column, Column]:
    """Amounts whose sale price is lowered to the regular one where it lies above: (3, 9) gives (3, 3)."""
    return regular, F.when(sale > regular, regular).otherwise(sale)


def regular_raised(regular: Column, sale: Column) -> tuple[Column, Column]:
    """Amounts whose regular price is raised to the final one where it lies below or is missing: (3, 9) gives (9, 9)."""
    return F.when(regular.isNull() | (regular < sale), F.coalesce(sale, regular)).otherwise(regular), sale


#: The text forms by name, for callers that pick one by shop.
FORMS: dict[str, Callable[[Column | str], Column]] = {
    f.__name__: f
    for f in (first_amount, commas_to_dots, digits_and_dots, two_decimals, fixed_point, cents_amount, whole_and_fraction, or_unavailable)
}


def by_shop(c: Column | str, shop: Column | str, forms: dict[str, str]) -> Column:
    """The text read by the form of its shop; shops without a form keep the text.

    forms: shop to the name of a form; a fixed table of the caller.
    """
    out = F.lit(None).cast("string")
    for name in sorted(set(forms.values())):
        shops = [s for s, f in forms.items() if f == name]
        out = F.when(as_column(shop).isin(*shops), FORMS[name](c)).otherwise(out)
    return F.when(as_column(shop).isin(*forms) if forms else F.lit(False), out).otherwise(as_column(c))


# Words that show a page was blocked rather than served.
BLOCKED = (r"captcha", r"verifica que (eres|no eres) (humano|un robot)", r"unusual traffic", r"acceso denegado", r"access denied", r"\b403 forbidden\b", r"robot check")


def is_blocked(page: Column | str) -> Column:
    """True where a page's text is that of a block; null for null."""
    return as_column(page).rlike("(?i)" + "|".join(BLOCKED))
