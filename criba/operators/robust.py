"""Robust statistics of groups: outlier scores, positions, summaries, mid-ranks.

Statistics of a group come from its distinct values and their numbers, counted
before anything meets by group, so that a large group is reduced before it
moves; all of them are taken over one partitioning, and rows are joined once to
one row a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from criba.functions.stats import guarded


def _with_groups(df: DataFrame, by: Sequence[str], groups: DataFrame) -> DataFrame:
    """Rows with what one row a group says; null keys are a group too."""
    named = groups.withColumnsRenamed({c: f"_g{i}" for i, c in enumerate(by)})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)])
    return df.join(named, same).drop(*[f"_g{i}" for i in range(len(by))])


def _score(x: Column, least: int) -> Column:
    d = x - F.col("_m")
    z = F.when(F.col("_mad") > 0, 0.6745 * d / F.col("_mad")).when(F.col("_mean") > 0, d / (1.2533 * F.col("_mean"))).otherwise(0.0)
    return guarded(z, "n", least)


def _statistics(df: DataFrame, by: Sequence[str], value: str, least: int, limit: float) -> DataFrame:
    """One row a group: ``n``, median, MAD and mean deviation of the logarithms, number and median of the values that are no outliers."""
    group = Window.partitionBy(*by)
    counts = df.where(F.col(value) > 0).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    told = counts.withColumn("_x", F.ln("_v"))
    told = told.withColumn("n", F.sum("_n").over(group)).withColumn("_m", F.expr("percentile(_x, 0.5, _n)").over(group))
    told = told.withColumn("_d", F.abs(F.col("_x") - F.col("_m")))
    told = told.withColumn("_mad", F.expr("percentile(_d, 0.5, _n)").over(group)).withColumn("_mean", F.sum(F.col("_d") * F.col("_n")).over(group) / F.col("n"))
    clean = ~F.coalesce(F.abs(_score(F.col("_x"), least)) > limit, F.lit(False))
    told = told.withColumn("_c", F.when(clean, F.col("_v"))).withColumn("_k", F.when(clean, F.col("_n")).otherwise(F.lit(0).cast("long")))
    first = lambda c: F.first(c).alias(c)
    return told.groupBy(*by).agg(first("n"), first("_m"), first("_mad"), first("_mean"), F.sum("_k").alias("_limpios"), F.expr("percentile(_c, 0.5, _k)").alias("_med"))


def robust_scores(df: DataFrame, by: Sequence[str], value: str, least: int = 4, limit: float = 3.5) -> DataFrame:
    """``n``, ``z`` and ``atipico`` of each positive value within its group, ``mediana`` without outliers and ``pct``.

    On logarithms: 0.6745 (x - median) / MAD; where the MAD is zero, (x - median) /
    (1.2533 mean absolute deviation); where that is zero too, 0. Groups of fewer
    than ``least`` values have null scores and no outliers. ``mediana`` is that of the group's values
    that are no outliers, ``pct`` the value's relative distance from it; both are null with
    fewer than ``least`` such values. Rows of null or non-positive value are left out.
    """
    joined = _with_groups(df.where(F.col(value) > 0), by, _statistics(df, by, value, least, limit))
    scored = joined.withColumn("z", _score(F.ln(F.col(value).cast("double")), least))
    told = scored.withColumn("atipico", F.coalesce(F.abs("z") > limit, F.lit(False))).withColumn("mediana", guarded(F.col("_med"), "_limpios", least))
    return told.withColumn("pct", F.col(value) / F.col("mediana") - 1).drop("_m", "_mad", "_mean", "_limpios", "_med")


def summary(df: DataFrame, by: Sequence[str], value: str, name: str, least: int = 4) -> DataFrame:
    """Distribution of a group: count, least, quartiles, largest, who has them, relative ranges.

    All statistics but the count and the median for ``tipico`` are null below
    ``least`` values. Of equal extremes the first name in the alphabet stands.
    """
    v = F.col(value).cast("double")
    stat = lambda c, alias: guarded(c, "n", least).alias(alias)
    told = df.where(v.isNotNull()).withColumn("_v", v)
    grouped = told.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.expr("percentile(_v, array(0.25, 0.5, 0.75))").alias("_q"),
        F.min_by(name, F.struct("_v", name)).alias("_low"),
        F.min_by(name, F.struct(-F.col("_v"), name)).alias("_high"),
    )
    q = F.col("_q")
    return grouped.select(
        *by,
        "n",
        stat(F.col("_min"), "minimo"),
        stat(q[0], "p25"),
        stat(q[1], "p50"),
        stat(q[2], "p75"),
        stat(F.col("_max"), "maximo"),
        stat(F.col("_low"), "quien_minimo"),
        stat(F.col("_high"), "quien_maximo"),
        stat(F.try_divide(F.col("_max"), F.col("_min")) - 1, "rango_rel"),
        stat(F.try_divide(q[2] - q[0], q[1]), "iqr_rel"),
        q[1].alias("tipico"),
    )


def mid_ranks(df: DataFrame, by: Sequence[str], value: str, least: int = 5) -> DataFrame:
    """``percentil``: 100 (lower + half the equal, itself included) / n; null below ``least`` values.

    Counts of lower values come from the distinct values of the group, not from its rows.
    """
    rows = df.where(F.col(value).isNotNull())
    tied = rows.groupBy(*by, value).agg(F.count("*").alias("_t"))
    whole = Window.partitionBy(*by)
    below = whole.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    told = tied.withColumn("_b", F.coalesce(F.sum("_t").over(below), F.lit(0))).withColumn("n", F.sum("_t").over(whole))
    share = guarded(100.0 * (F.col("_b") + 0.5 * F.col("_t")) / F.col("n"), "n", least)
    ranked = told.select(*by, value, "n", F.col("_b").alias("menores"), F.col("_t").alias("iguales"), share.alias("percentil"))
    return rows.join(ranked, [*by, value])


def premium_over(df: DataFrame, by: Sequence[str], value: str, is_reference: Column, least: int = 3) -> DataFrame:
    """``prima``: a value as a multiple of the median of the group's reference rows; null below ``least`` of them."""
    ref = F.when(is_reference, F.col(value).cast("double"))
    marked = df.withColumn("_r", ref)
    told = _with_groups(marked, by, marked.groupBy(*by).agg(F.count("_r").alias("referencias"), F.expr("percentile(_r, 0.5)").alias("_m")))
    return told.withColumn("prima", guarded(F.try_divide(F.col(value).cast("double"), F.col("_m")), "referencias", least)).drop("_r", "_m")
