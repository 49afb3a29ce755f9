"""Data-quality tests: each gives the number of failing rows, all of one table in one pass.

Row tests of a table are counted together by one aggregation; tests that group or
join have their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RowTest:
    """A named predicate that a row must not break; ``where`` limits the rows that it judges."""

    name: str
    broken: Column
    severity: str = "error"
    where: Column | None = None


def not_null(column: str, **more) -> RowTest:
    return RowTest(f"not_null_{column}", F.col(column).isNull(), **more)


def accepted_values(column: str, values: Sequence, **more) -> RowTest:
    """Null passes."""
    return RowTest(f"accepted_values_{column}", ~F.col(column).isin(*values), **more)


def accepted_range(column: str, low=None, high=None, **more) -> RowTest:
    """Null passes; an absent bound does not judge."""
    outside = [F.col(column) < low] if low is not None else []
    outside += [F.col(column) > high] if high is not None else []
    return RowTest(f"accepted_range_{column}", reduce(Column.__or__, outside, F.lit(False)), **more)


def expression_is_true(name: str, expression: Column, **more) -> RowTest:
    """Null passes."""
    return RowTest(f"expression_{name}", ~expression, **more)


def run_row_tests(df: DataFrame, table: str, tests: Sequence[RowTest]) -> DataFrame:
    """``tabla, prueba, severidad, fallas`` of all row tests of a table, in one scan."""
    judged = [F.count_if(F.coalesce(t.broken & (t.where if t.where is not None else F.lit(True)), F.lit(False))).alias(f"t{i}") for i, t in enumerate(tests)]
    rows = [F.struct(F.lit(t.name).alias("prueba"), F.lit(t.severity).alias("severidad"), F.col(f"t{i}").alias("fallas")) for i, t in enumerate(tests)]
    return df.agg(*judged).select(F.lit(table).alias("tabla"), F.explode(F.array(*rows)).alias("x")).select("tabla", "x.*")


def _result(failing: DataFrame, table: str, test: str, severity: str) -> DataFrame:
    return failing.agg(F.count("*").alias("fallas")).select(F.lit(table).alias("tabla"), F.lit(test).alias("prueba"), F.lit(severity).alias("severidad"), "fallas")


def unique(df: DataFrame, table: str, columns: Sequence[str], severity: str = "error") -> DataFrame:
    """Keys (without null parts) that more than one row has."""
    whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    return _result(df.where(whole).groupBy(*columns).count().where("count > 1"), table, "unique_" + "_".join(columns), severity)


def relationship(child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str, severity: str = "error") -> DataFrame:
    """Rows whose value the parent lacks; null values pass."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return _result(child.where(F.col(column).isNotNull()).join(keys, column, "left_anti"), table, f"relationship_{column}", severity)


def equal_row_count(a: DataFrame, b: DataFrame, table: str, severity: str = "error") -> DataFrame:
    """How far the numbers of rows differ, as failures."""
    one = a.agg(F.count("*").alias("a")).crossJoin(b.agg(F.count("*").alias("b")))
    return one.select(F.lit(table).alias("tabla"), F.lit("equal_rowcount").alias("prueba"), F.lit(severity).alias("severidad"), F.abs(F.col("a") - F.col("b")).alias("fallas"))


def conserved(whole: DataFrame, parts: Sequence[DataFrame], table: str) -> DataFrame:
    """No row lost or added: the parts' rows against the whole's, as failures."""
    return equal_row_count(whole.select(F.lit(1)), reduce(DataFrame.unionByName, [p.select(F.lit(1).alias("u")) for p in parts]), table)


def missing_days(days: DataFrame, column: str, table: str) -> DataFrame:
    """Days missing between the first and the last one, as failures."""
    told = days.agg((F.datediff(F.max(column), F.min(column)) + 1 - F.count_distinct(column)).alias("fallas"))
    return told.select(F.lit(table).alias("tabla"), F.lit(f"sin_huecos_{column}").alias("prueba"), F.lit("error").alias("severidad"), F.coalesce("fallas", F.lit(0)).cast("bigint").alias("fallas"))


def least_precision(judged: DataFrame, right: str, floor: float, table: str, severity: str = "error") -> DataFrame:
    """One failure where the share of right rows among the judged ones lies below the floor; none without judged rows."""
    told = judged.where(F.col(right).isNotNull()).agg(F.try_divide(F.count_if(F.col(right)).cast("double"), F.count("*")).alias("p"))
    return told.select(F.lit(table).alias("tabla"), F.lit(f"precision_{right}").alias("prueba"), F.lit(severity).alias("severidad"), F.coalesce(F.col("p") < floor, F.lit(False)).cast("bigint").alias("fallas"))


def complete_ranks(ranked: DataFrame, by: Sequence[str], rank: str, k: int, table: str, severity: str = "error") -> DataFrame:
    """Groups whose ranks are not exactly 1 to k."""
    told = ranked.groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct(rank).alias("d"), F.min(rank).alias("a"), F.max(rank).alias("b"))
    return _result(told.where(~((F.col("n") == k) & (F.col("d") == k) & (F.col("a") == 1) & (F.col("b") == k))), table, f"rangos_{rank}", severity)


def covered(wanted: DataFrame, held: DataFrame, key: Sequence[str], table: str, severity: str = "error") -> DataFrame:
    """Wanted keys that the other table lacks."""
    return _result(wanted.select(*key).distinct().join(held.select(*key).distinct(), list(key), "left_anti"), table, "cobertura_" + "_".join(key), severity)


def complete_grid(cells: DataFrame, columns: Sequence[str], table: str, severity: str = "error") -> DataFrame:
    """How many cells of the full grid of the columns' values are missing or repeated."""
    counts = cells.agg(F.count("*").alias("n"), F.count_distinct(*columns).alias("d"), *[F.count_distinct(c).alias(f"c{i}") for i, c in enumerate(columns)])
    whole = reduce(Column.__mul__, [F.col(f"c{i}") for i in range(len(columns))])
    return counts.select(F.lit(table).alias("tabla"), F.lit("malla_" + "_".join(columns)).alias("prueba"), F.lit(severity).alias("severidad"), ((whole - F.col("d")) + (F.col("n") - F.col("d"))).alias("fallas"))


def report(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def enforce(results: DataFrame) -> DataFrame:
    """The report itself; raises ValueError naming the tests of severity ``error`` that fail."""
    failing = [r["prueba"] for r in results.where("fallas > 0 and severidad = 'error'").collect()]
    if failing:
        raise ValueError("data-quality tests failed: " + ", ".join(sorted(failing)))
    return results
