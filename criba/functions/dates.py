"""Capture dates: a fixed cascade of day-first and ISO forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from criba.functions.text import bind, strip

#: Day first, with two digits of the year and maybe a time, or four and a time; or year first, maybe with a time.
_DAY_FIRST = r"\A(\d{1,2})/(\d{1,2})/(?:(\d{2})|(\d{4})(?=\s+\d))(?:\s+(\d{1,2}:\d{1,2}))?\z"
_ISO = r"\A(\d{4}-\d{1,2}-\d{1,2})(?:\s+(\d{1,2}:\d{1,2}:\d{1,2}))?\z"


def _as_stamp(text: Column) -> Column:
    """A date text as year, month, day and time in this order, year of four digits; null for any other form."""
    # Of a two-digit year the century is missing yet, which the first sign of the rest tells.
    turned = F.regexp_replace(text, _DAY_FIRST, "$4~$3-$2-$1 $5")
    century = F.when(F.substring(turned, 2, 2) < "69", "20").otherwise("19")
    return (
        F.when(text.contains("~"), None)
        .when(turned.startswith("~"), F.concat(century, F.substring(turned, F.lit(2), F.length(turned))))
        .when(F.substring(turned, 5, 1) == "~", F.translate(turned, "~", ""))
        .when(text.rlike(_ISO), F.regexp_replace(text, r"\s+", " "))
    )


def parse_date(c: Column | str) -> Column:
    """Timestamp (wall clock, never shifted) of a capture date, or null.

    Read are ``d/m/yy [H:M]``, ``d/m/yyyy H:M`` and ``yyyy-m-d [H:M:S]``; the day
    stands first, two-digit years below 69 are of this century, and a date that
    the calendar lacks is null, as is the year 0.
    """
    stamp = lambda text: F.when(F.substring(text, 1, 4) > "0000", F.trim(text).try_cast("timestamp"))
    return bind(strip(c), lambda text: bind(_as_stamp(text), stamp))


def value_kind(c: Column | str) -> Column:
    """Kind of one cell: ``vacio``, ``numero``, ``fecha``, ``fecha_hora`` or ``texto``.

    Blank cells and texts that say "none" are ``vacio``. A plain number has digits
    and at most one decimal dot; every other form of a number is ``texto``.
    """
    text = strip(c)
    missing = ("", "NO DISPONIBLE", "N/A", "NULL", "#N/D", "NONE", "NAN", "SIN FECHA")
    day = r"(\d{1,2}/\d{1,2}/(\d{2}|\d{4})|\d{4}-\d{1,2}-\d{1,2})"
    return (
        F.when(F.upper(F.coalesce(text, F.lit(""))).isin(*missing), "vacio")
        .when(text.rlike(r"\A\d+(\.\d+)?\z"), "numero")
        .when(text.rlike(rf"\A{day}\z"), "fecha")
        .when(text.rlike(rf"\A{day}[T\s]+\d{{1,2}}:\d{{1,2}}(:\d{{1,2}})?Z?\z"), "fecha_hora")
        .otherwise("texto")
    )
