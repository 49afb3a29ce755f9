"""Regression price indices: country-product-dummy by month, time-product-dummy over months.

Both fixed effects are absorbed in the plan by group means, so what reaches a
task is a matrix of the size of chains or months, never the panel itself.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Z95 = 1.959964


def _normal_equations(panel: DataFrame, by: Sequence[str], item: str, effect: str, y: str) -> DataFrame:
    """Cross products of the effects after the items are absorbed, as rows ``by, a, b, xx, xy, yy, n, items``.

    With items absorbed, X'X of the effect dummies is diag(n_e) - sum over items of
    counts n_ie n_if / n_i; X'y is sum y_e - sum n_ie mean_i. Items are reduced to
    their counts by effect first; an item meets at most all effects.
    """
    cells = panel.groupBy(*by, item, effect).agg(F.count("*").alias("n"), F.sum(y).alias("s"), F.sum(F.col(y) * F.col(y)).alias("q"))
    items = cells.groupBy(*by, item).agg(F.sum("n").alias("ni"), F.sum("s").alias("si"), F.sum("q").alias("qi"), F.collect_list(F.struct(F.col(effect).alias("e"), "n", "s")).alias("c"))
    pair = items.select(*by, "ni", "si", F.explode("c").alias("x"), "c").select(*by, "ni", "si", "x", F.explode("c").alias("z"))
    off = pair.groupBy(*by, F.col("x.e").alias("a"), F.col("z.e").alias("b")).agg(
        F.sum(F.when(F.col("x.e") == F.col("z.e"), F.col("x.n")).otherwise(0) - F.col("x.n") * F.col("z.n") / F.col("ni")).alias("xx"),
        F.sum(F.when(F.col("x.e") == F.col("z.e"), F.col("x.s") - F.col("x.n") * F.col("si") / F.col("ni")).otherwise(0.0)).alias("xy"),
        F.count_if(F.col("x.e") == F.col("z.e")).alias("items"),
    )
    whole = items.groupBy(*by).agg(F.sum(F.col("qi") - F.col("si") * F.col("si") / F.col("ni")).alias("yy"), F.sum("ni").alias("n"), F.count("*").alias("absorbidos"))
    return off.join(whole, list(by))


def _solve(group: pd.DataFrame) -> tuple[list, np.ndarray, np.ndarray, pd.DataFrame]:
    """Effects, normal matrix and right side of one regression, effects in order."""
    names = sorted(set(group["a"]))
    at = {e: i for i, e in enumerate(names)}
    xx, xy = np.zeros((len(names),) * 2), np.zeros(len(names))
    for row in group.itertuples():
        xx[at[row.a], at[row.b]] += row.xx
        xy[at[row.a]] += row.xy
    return names, xx, xy, group


def chain_effects(panel: DataFrame, month: str, item: str, chain: str, price: str, least_items: int = 30) -> DataFrame:
    """Relative price level of each chain in each month, items held equal.

    Per month a least-squares fit of log price on item and chain effects that sum
    to zero over chains. Only items in at least two chains count. Result: ``month,
    chain, beta, se, nivel`` (exp(beta) - 1), ``ic_bajo, ic_alto`` (95 %), ``items``
    (of the chain) and ``inestable`` (fewer than ``least_items``). A month whose
    chains fall into groups without a common item has null effects.
    """
    rows = panel.where(F.col(price) > 0).select(F.col(month).cast("date").alias("m"), F.col(item).cast("string").alias("i"), F.col(chain).cast("string").alias("c"), F.ln(F.col(price).cast("double")).alias("y"))
    spread = rows.groupBy("m", "i").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("m", "i")
    equations = _normal_equations(rows.join(spread, ["m", "i"], "left_semi"), ["m"], "i", "c", "y")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        names, xx, xy, _ = _solve(group)
        j, first = len(names), group.iloc[0]
        own = group[group["a"] == group["b"]].set_index("a")["items"]
        # Adding ones outside the range of xx picks the solution that sums to zero.
        full = xx + np.ones((j, j)) / j
        connected = np.linalg.matrix_rank(xx, tol=1e-8 * max(1.0, np.abs(xx).max())) == j - 1
        beta, cov = np.full(j, np.nan), np.full((j, j), np.nan)
        if connected:
            inverse = np.linalg.inv(full)
            beta = inverse @ xy
            free = first["n"] - first["absorbidos"] - (j - 1)
            rest = max(0.0, first["yy"] - beta @ xy)
            centre = np.eye(j) - 1 / j
            cov = centre @ inverse @ centre * (rest / free if free > 0 else np.nan)
        se = np.sqrt(np.maximum(np.diag(cov), 0))
        level = lambda b: np.exp(b) - 1
        return pd.DataFrame({"m": first["m"], "c": names, "beta": beta, "se": se, "nivel": level(beta), "ic_bajo": level(beta - Z95 * se), "ic_alto": level(beta + Z95 * se), "items": own.reindex(names).to_numpy(), "inestable": (own.reindex(names) < least_items).to_numpy()})

    found = equations.groupBy("m").applyInPandas(fit, "m date, c string, beta double, se double, nivel double, ic_bajo double, ic_alto double, items bigint, inestable boolean")
    return found.withColumnsRenamed({"m": month, "c": chain})


def month_index(panel: DataFrame, month: str, items: Sequence[str], price: str, base: str) -> DataFrame:
    """Price index over months, items held equal: 100 at the base month.

    A least-squares fit of log price on item effects (absorbed) and month effects,
    degrees of freedom less by the items. Result: ``month, delta, se, indice, ic_bajo,
    ic_alto, items`` (of the month) and ``variacion`` (change on the calendar month
    before, null where that is missing). Items seen in one month only inform nothing
    and do no harm. An unknown base month gives null indices.
    """
    key = F.concat_ws("|", *[F.coalesce(F.col(i).cast("string"), F.lit("")) for i in items])
    rows = panel.where(F.col(price) > 0).select(key.alias("i"), F.trunc(F.col(month).cast("date"), "month").alias("t"), F.ln(F.col(price).cast("double")).alias("y"), F.lit(0).alias("g"))
    equations = _normal_equations(rows, ["g"], "i", "t", "y")
    start = pd.Timestamp(base).date()

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        names, xx, xy, _ = _solve(group)
        own = group[group["a"] == group["b"]].set_index("a")["items"].reindex(names).to_numpy()
        delta, se = np.full(len(names), np.nan), np.full(len(names), np.nan)
        if start in names:
            rest = [i for i, t in enumerate(names) if t != start]
            inverse = np.linalg.pinv(xx[np.ix_(rest, rest)])
            b, first = inverse @ xy[rest], group.iloc[0]
            free = first["n"] - first["absorbidos"] - len(rest)
            sigma = max(0.0, first["yy"] - b @ xy[rest]) / free if free > 0 else np.nan
            delta[rest], se[rest] = b, np.sqrt(np.maximum(np.diag(inverse) * sigma, 0))
            at = names.index(start)
            delta[at], se[at] = 0.0, 0.0
        index = 100 * np.exp(delta)
        months = pd.PeriodIndex(pd.to_datetime(names), freq="M")
        before = pd.Series(index, months).reindex(months - 1).to_numpy()
        return pd.DataFrame({"t": names, "delta": delta, "se": se, "indice": index, "ic_bajo": index * np.exp(-Z95 * se), "ic_alto": index * np.exp(Z95 * se), "items": own, "variacion": index / before - 1})

    found = equations.groupBy("g").applyInPandas(fit, "t date, delta double, se double, indice double, ic_bajo double, ic_alto double, items bigint, variacion double")
    return found.withColumnRenamed("t", month)


def demeaned(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """``value`` less its group's mean, null-safe: the absorbed form of a fixed effect."""
    return df.withColumn(name, F.col(value) - F.avg(value).over(Window.partitionBy(*by)))
