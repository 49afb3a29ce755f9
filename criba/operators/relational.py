"""Deduplication, latest rows, argmin, top-k, grids and splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_row(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group in a total order; Spark limits every group before it shuffles."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def first_values(df: DataFrame, by: Sequence[str], values: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """``values`` of the first row of each group, by an aggregation with partial results (an argmin)."""
    return df.groupBy(*by).agg(F.min_by(F.struct(*values), F.struct(*order)).alias("_x")).select(*by, "_x.*")


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "lugar") -> DataFrame:
    """The first k rows of each group with their rank from 1."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def numbered_duplicates(df: DataFrame, by: Sequence[str], order: Sequence[str], number: str = "rn") -> DataFrame:
    """Rows numbered from 1 within groups of equal values, in ascending order; nulls are equal to each other.

    No group is one task's, however many rows it has (all blank rows are one): rows are numbered within the
    group's share of each value of all order columns but the last, say of a file, and the
    counts of the shares before are added. Groups are told by 128 bits of hash.
    """
    keyed = df.withColumn("_k", F.xxhash64(*by)).withColumn("_l", F.xxhash64(F.lit(1), *by))
    share = ["_k", "_l", *order[:-1]]
    inner = keyed.withColumn("_i", F.row_number().over(Window.partitionBy(*share).orderBy(order[-1])))
    if len(order) == 1:
        return inner.withColumnRenamed("_i", number).drop("_k", "_l")
    before = Window.partitionBy("_k", "_l").orderBy(*order[:-1]).rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy(*share).agg(F.count("*").alias("_n")).withColumn("_a", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # Only groups of several shares have anything before any of them.
    offsets = counts.where("_a > 0").select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(share)], "_a")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate(share)])
    return inner.join(offsets, same, "left").select(*df.columns, (F.col("_i") + F.coalesce("_a", F.lit(0))).alias(number))


def margin_to_next(df: DataFrame, by: Sequence[str], distance: str, tie: str) -> DataFrame:
    """``lugar`` by distance and ``margen``: how much farther the next one is; null for the last."""
    w = Window.partitionBy(*by).orderBy(F.col(distance), F.col(tie))
    return df.withColumn("lugar", F.row_number().over(w)).withColumn("margen", F.lead(distance).over(w) - F.col(distance))


def several_values(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """Flag of groups with more than one distinct non-null value, by their least and largest."""
    w = Window.partitionBy(*by)
    return df.withColumn(name, F.coalesce(F.min(value).over(w) != F.max(value).over(w), F.lit(False)))


def split_by_reason(df: DataFrame, reason: Column, name: str = "motivo_descarte") -> tuple[DataFrame, DataFrame]:
    """Rows without a reason and rows with one; together they are the input, row for row."""
    judged = df.withColumn(name, reason)
    return judged.where(F.col(name).isNull()).drop(name), judged.where(F.col(name).isNotNull())


def first_reason(*tests: tuple[str, Column]) -> Column:
    """Name of the first test that holds, else null."""
    return F.coalesce(*[F.when(test, F.lit(name)) for name, test in tests])


def pending(wanted: DataFrame, done: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``wanted`` whose key ``done`` lacks."""
    return wanted.join(done.select(*key).distinct(), list(key), "left_anti")


def flagged_presence(df: DataFrame, other: DataFrame, key: Sequence[str], flag: str) -> DataFrame:
    """``df`` with a flag: whether the other table has its key; rows are neither lost nor repeated."""
    keys = other.select(*key).where(reduce(Column.__and__, [F.col(k).isNotNull() for k in key])).distinct()
    return df.join(keys.withColumn(flag, F.lit(True)), list(key), "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


#: Most rows of a side that a grid repeats to every task, checked before it is.
SMALL_SIDE = 100_000


def grid(*sides: DataFrame) -> DataFrame:
    """Every combination of the rows of several small lists of distinct values.

    The result is the product by definition; each side after the first must have at
    most ``SMALL_SIDE`` rows, which is checked, and is sent to the tasks.
    """
    out = sides[0]
    for side in sides[1:]:
        if side.limit(SMALL_SIDE + 1).count() > SMALL_SIDE:
            raise ValueError(f"a side of the grid has over {SMALL_SIDE} rows")
        out = out.crossJoin(F.broadcast(side))
    return out


def presence_grid(seen: DataFrame, products: DataFrame, places: DataFrame, times: DataFrame, product: str, place: str, time: str) -> DataFrame:
    """State of every product, place and time: ``Detectado``, ``No detectado`` or ``Cadena sin captura``.

    seen: rows of product, place and time; a place without any row at a time was not captured.
    """
    found = seen.select(product, place, time).distinct().withColumn("_visto", F.lit(True))
    captured = seen.select(place, time).distinct().withColumn("_capturada", F.lit(True))
    cells = grid(products.select(product).distinct(), places.select(place).distinct(), times.select(time).distinct())
    joined = cells.join(found, [product, place, time], "left").join(captured, [place, time], "left")
    state = F.when(F.col("_visto"), "Detectado").when(F.col("_capturada"), "No detectado").otherwise("Cadena sin captura")
    return joined.select(
        product,
        place,
        time,
        state.alias("estado"),
        F.coalesce("_visto", F.lit(False)).cast("int").alias("detectado"),
        F.coalesce("_capturada", F.lit(False)).cast("int").alias("capturada"),
    )


def runs(df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column) -> DataFrame:
    """Unbroken runs of equal ``value`` in order: the group, ``valor``, ``inicio`` and ``fin`` (of the first order column) and ``largo``."""
    line = Window.partitionBy(*by).orderBy(*order)
    marked = df.select(*by, *order, value.alias("valor")).withColumn("_b", F.coalesce((~F.col("valor").eqNullSafe(F.lag("valor").over(line))).cast("int"), F.lit(1)))
    told = marked.withColumn("_r", F.sum("_b").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return told.groupBy(*by, "valor", "_r").agg(F.min(order[0]).alias("inicio"), F.max(order[0]).alias("fin"), F.count("*").alias("largo")).drop("_r")


def stratified_sample(df: DataFrame, stratum: Sequence[str], key: str, n: int, seed: int, least: int = 1) -> DataFrame:
    """n rows of each stratum, the same at every run: those of least md5 of seed and key.

    Strata of fewer than ``least`` rows are left out. A sampling operator: the limit is its purpose.
    """
    drawn = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    sizes = df.groupBy(*stratum).agg(F.count("*").alias("_m")).where(F.col("_m") >= least).drop("_m")
    kept = df.withColumn("_h", drawn).join(sizes, list(stratum), "left_semi")
    return top_k(kept, stratum, [F.col("_h"), F.col(key)], n, "_n").drop("_h", "_n")


def previous_month(df: DataFrame, by: Sequence[str], month: str, value: str, name: str) -> DataFrame:
    """``value`` of the calendar month before, null where that month is missing (a lag would skip gaps)."""
    before = df.select(*by, F.add_months(month, 1).alias(month), F.col(value).alias(name))
    return df.join(before, [*by, month], "left")


def all_hold(df: DataFrame, by: Sequence[str], test: Column, name: str) -> DataFrame:
    """Groups with whether a test holds in all of their rows where it can be told; null where it never can."""
    return df.groupBy(*by).agg(F.bool_and(test).alias(name))


def distinct_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``filas``, and ``llaves``, the distinct combinations of columns without nulls."""
    return df.agg(F.count("*").alias("filas"), F.count_distinct(*columns).alias("llaves"))


def labelled_values(df: DataFrame, value: str, label: str) -> DataFrame:
    """Each distinct value once, under its least label."""
    return df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(label).alias(label))


def translated(df: DataFrame, column: str, table: DataFrame, source: str, target: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``column`` put in the table's terms (null where it has none), and the values that the table lacks."""
    known = table.select(F.trim(source).alias("_de"), F.col(target).alias("_a")).where("_de is not null").dropDuplicates(["_de"])
    key = F.trim(column)
    done = df.join(known, key == F.col("_de"), "left").withColumn(column, F.col("_a")).select(*df.columns)
    missing = df.select(key.alias(column)).where(F.col(column).isNotNull()).distinct().join(known, F.col(column) == F.col("_de"), "left_anti")
    return done, missing
