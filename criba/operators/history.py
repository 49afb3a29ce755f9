"""History of changing attributes: every version of an entity with its period."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def attribute_versions(
    snapshots: DataFrame,
    key: str,
    time: str,
    loaded: str,
    content: dict[str, Column],
) -> DataFrame:
    """Closed and open versions of entities from periodic snapshots.

    content: attribute name to the expression of what counts as its content (for
    instance without letter case); the attribute itself is the column of that name.

    A version starts at the first snapshot whose content differs from the snapshot
    before and ends where the next one starts, or at 9999-12-31. Of several rows of
    one key and time the last loaded counts (of equal loads the largest content).
    A null attribute means not captured: the former value stays, as it does where
    a snapshot lacks the key. Rows without key or time are ignored.

    Result: ``key, valido_desde, valido_hasta`` (dates) and the attributes as they
    stood at the start. Repeated rows and an empty table are harmless; columns of
    other names are not read.

    Rows of one key and time are reduced before they meet by key, so a key holds
    at most one row a snapshot however often it was loaded. Each partition is
    then sorted by key and time, a merge of sorted runs, and passes by in a
    stream that remembers one open version.
    """
    names = list(content)
    fields = [F.col(n).alias(f"a{i}") for i, n in enumerate(names)] + [content[n].cast("string").alias(f"c{i}") for i, n in enumerate(names)]
    marks, values = [f"c{i}" for i in range(len(names))], [f"a{i}" for i in range(len(names))]
    last = (
        snapshots.select(F.col(key).alias("k"), F.col(time).cast("date").alias("t"), F.col(loaded).alias("l"), *fields)
        .where("k is not null and t is not null")
        .groupBy("k", "t")
        .agg(F.max_by(F.struct(*values, *marks), F.struct("l", *marks, *values)).alias("x"))
        .select("k", F.datediff("t", F.lit("1970-01-01").cast("date")).alias("t"), "x.*")
    )
    kind = {f.name: f.dataType.simpleString() for f in last.schema.fields}
    schema = f"k {kind['k']}, t int, u int, " + ", ".join(f"{v} {kind[v]}" for v in values)
    never = int(np.datetime64(OPEN_END, "D").astype(int))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry: pd.DataFrame | None = None
        for batch in batches:
            if batch.empty:
                continue
            # Plain objects: joined Arrow-backed texts come in chunks, which Spark does not take back.
            batch = batch.astype({c: object for c in ("k", *values, *marks)}).assign(t=batch["t"].astype("int64"))
            rows = batch if carry is None else pd.concat([carry, batch], ignore_index=True)
            group = rows["k"].ne(rows["k"].shift()).cumsum()
            filled = rows[[*values, *marks]].groupby(group, sort=False).ffill()
            now = filled[marks].astype(object).where(filled[marks].notna(), None)
            before = now.shift()
            same = (now.eq(before) | (now.isna() & before.isna())).all(axis=1) & group.eq(group.shift())
            start = np.flatnonzero(~same.to_numpy())
            opened = rows.iloc[start][["k", "t"]].assign(**{v: filled[v].iloc[start] for v in values}).reset_index(drop=True)
            follows = opened["k"].eq(opened["k"].shift(-1))
            opened["u"] = opened["t"].shift(-1).where(follows, never).astype("int64")
            yield _typed(opened.iloc[:-1], values)
            # The open version: its start, with the contents known by now.
            tail = filled.iloc[[-1]]
            carry = pd.DataFrame({"k": [rows["k"].iloc[-1]], "t": [opened["t"].iloc[-1]]})
            held_values = opened.iloc[-1]
            carry = carry.assign(**{v: [held_values[v] if pd.notna(held_values[v]) else tail[v].iloc[0]] for v in values}, **{m: [tail[m].iloc[0]] for m in marks})
        if carry is not None:
            yield _typed(carry.assign(u=never), values)

    def _typed(rows: pd.DataFrame, values: list[str]) -> pd.DataFrame:
        return rows[["k", "t", "u", *values]].astype({"t": "int32", "u": "int32", "k": object, **{v: object for v in values}})

    merged = last.repartition("k").sortWithinPartitions("k", "t").mapInPandas(merge, schema)
    day = lambda c: F.date_add(F.lit("1970-01-01").cast("date"), F.col(c))
    return merged.select(
        F.col("k").alias(key),
        day("t").alias("valido_desde"),
        day("u").alias("valido_hasta"),
        *[F.col(v).alias(n) for v, n in zip(values, names)],
    )


def as_of(versions: DataFrame, key: str, moments: DataFrame, time: str) -> DataFrame:
    """The version valid at each moment: ``moments`` (with ``key`` and ``time``) joined to its version."""
    v = versions.withColumnRenamed(key, "_k")
    hit = (F.col("_k") == F.col(key)) & (F.col(time) >= F.col("valido_desde")) & (F.col(time) < F.col("valido_hasta"))
    return moments.join(v, hit, "left").drop("_k")
