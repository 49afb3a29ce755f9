"""Calendar columns, Spanish names and date spines."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from criba.functions.text import as_column

# Names of months and weekdays.
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
WEEKDAYS = ("lunes", "martes", "miércoles", "jueves", "viernes", "sábado", "domingo")


def month_name(d: Column | str) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTHS)), F.month(as_column(d)))


def weekday_name(d: Column | str) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.weekday(as_column(d)) + 1)


def date_spine(bounds: DataFrame, first: str, last: str, name: str) -> DataFrame:
    """Every day from the least ``first`` to the largest ``last``, both included; none for an empty table."""
    ends = bounds.agg(F.min(first).cast("date").alias("a"), F.max(last).cast("date").alias("b")).where("a is not null and b is not null")
    return ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias(name))


def date_attributes(days: DataFrame, day: str) -> DataFrame:
    """A date dimension: year, quarter, month, ISO week and weekday (1 = Monday), names, month bounds."""
    d = F.col(day)
    return days.select(
        d,
        F.year(d).cast("bigint").alias("anio"),
        F.quarter(d).cast("bigint").alias("trimestre"),
        F.month(d).cast("bigint").alias("mes_num"),
        month_name(d).alias("mes_nombre"),
        F.trunc(d, "month").alias("mes"),
        F.last_day(d).alias("fin_mes"),
        F.weekofyear(d).cast("bigint").alias("semana_iso"),
        (F.weekday(d) + 1).cast("bigint").alias("dia_semana"),
        weekday_name(d).alias("dia_nombre"),
        F.dayofmonth(d).cast("bigint").alias("dia"),
    )


def month_of_path(path: Column | str) -> Column:
    """``yyyy-MM`` of a path such as ``2026/03_marzo/x.csv``; null where year, number and name disagree."""
    text = F.lower(as_column(path))
    shape = r"(?:\A|/)(\d{4})/(\d{2})_(\p{L}+)/"
    number = F.regexp_extract(text, shape, 2)
    named = F.element_at(F.array(*map(F.lit, MONTHS)), F.when(number.between("01", "12"), number.try_cast("int")))
    return F.when(named == F.regexp_extract(text, shape, 3), F.concat_ws("-", F.regexp_extract(text, shape, 1), number))


def valid_month(text: str) -> str:
    """The ``yyyy-MM`` text itself; anything else raises ValueError."""
    if not re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", text):
        raise ValueError(f"not a month: {text!r}")
    return text


def month_date(c: Column | str) -> Column:
    """First day of a month written ``yyyy-MM`` or ``yyyyMM``; null for anything else."""
    text = as_column(c)
    dashed = F.regexp_replace(text, r"\A(\d{4})(\d{2})\z", "$1-$2")
    return F.when(dashed.rlike(r"\A\d{4}-(0[1-9]|1[0-2])\z"), F.concat(dashed, F.lit("-01")).try_cast("date"))
