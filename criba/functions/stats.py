"""Ratios, guarded statistics, bands and intervals as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from criba.functions.text import as_column


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b in double precision; null where b is zero."""
    return F.try_divide(as_column(a).cast("double"), as_column(b).cast("double"))


def guarded(value: Column, n: Column | str, least: int) -> Column:
    """The statistic where it rests on at least so many values, else null."""
    return F.when(as_column(n) >= least, value)


def band(value: Column | str, cuts: Sequence[float], labels: Sequence[str], closed: Sequence[bool]) -> Column:
    """Label of the band a value falls in; null stays null.

    cuts ascend; ``closed[i]`` says whether a value equal to ``cuts[i]`` belongs to
    the band below. There is one label more than cuts.
    """
    v = as_column(value)
    out = None
    for cut, label, below in zip(cuts, labels, closed):
        test = v <= cut if below else v < cut
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.when(v.isNotNull(), labels[-1])


def wilson(hits: Column | str, n: Column | str, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of the Wilson score interval of a share; null for no trials."""
    k, m = as_column(hits).cast("double"), as_column(n).cast("double")
    share = F.try_divide(k, m)
    spread = 1 + F.try_divide(F.lit(z * z), m)
    centre = (share + F.try_divide(F.lit(z * z / 2), m)) / spread
    margin = z * F.sqrt(F.try_divide(share * (1 - share), m) + F.try_divide(F.lit(z * z / 4), m * m)) / spread
    return centre - margin, centre + margin


def plain_number(c: Column | str) -> Column:
    """Text of a number without trailing zeros or a bare dot (``400``, ``0.75``)."""
    text = as_column(c).cast("decimal(38,9)").cast("string")
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
