"""Implausible readings per source: physical bounds, Hampel spikes, stuck values."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SpikeRules:
    """Parameters of ``flag_spikes``; logarithms are natural.

    low, high       physical bounds of a value, both excluded from the plausible range
    absurd_ratio    times above or below the source's median that no reading can be
    side            readings on each side whose median is the course (Hampel window)
    max_run         longest excursion in readings
    min_dev         least distance in logarithms from the course on both sides
    z               the same in robust standard deviations of the source's movement
    stuck_run       least length of a run of equal readings
    moves_share     least share of changes among those between readings outside held runs, in a source that moves
    least_moves     least number of such changes
    season_hits     least number of like dips, one period apart, that make a dip regular
    block_days, halo_days   width of the time blocks a source is cut into, and of their overlap
    block_rows      readings of a source from which its blocks, and their overlap, get narrower in proportion
    """

    low: float = 0.05
    high: float = 50_000.0
    absurd_ratio: float = 20.0
    side: int = 3
    max_run: int = 2
    min_dev: float = 0.10
    z: float = 6.0
    stuck_run: int = 6
    moves_share: float = 0.7
    least_moves: int = 5
    season_hits: int = 3
    block_days: int = 7_305
    halo_days: int = 731
    block_rows: int = 1_000_000


def _equal_runs(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place within its run of equal values, and the run's length, of each reading."""
    starts = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
    lengths = np.diff(np.r_[starts, len(v)])
    return np.arange(len(v)) - np.repeat(starts, lengths), np.repeat(lengths, lengths)


def _distances(x: np.ndarray) -> np.ndarray:
    """How far each reading lies from the median of the two on either side of it, for a whole source at once."""
    padded = np.r_[np.nan, np.nan, x, np.nan, np.nan]
    around = np.stack([padded[i : i + len(x)] for i in (0, 1, 3, 4)])
    return x - np.nanmedian(around, axis=0)


def _is_regular(i: int, depth: float, distance: np.ndarray, month: np.ndarray, rules: SpikeRules) -> bool:
    """Whether a dip recurs: for some period nearly all readings that many months apart dip alike."""
    dips = distance <= -0.4 * depth
    apart = np.abs(month - month[i])
    for period in range(2, 13):
        same = apart % period == 0
        if dips[same].sum() >= rules.season_hits and dips[same].sum() >= 0.75 * same.sum():
            return True
    return False


def _spikes(x: np.ndarray, month: np.ndarray, scale: float, rules: SpikeRules) -> np.ndarray:
    n, found = len(x), np.zeros(len(x), bool)
    least = max(rules.min_dev, rules.z * scale)
    jumps = np.flatnonzero(np.abs(np.diff(x)) >= 0.5 * least) + 1
    distance = _distances(x) if len(jumps) else x
    for i in jumps:
        for run in range(1, rules.max_run + 1):
            end = i + run
            if end >= n:
                break
            inside = x[i:end]
            before, after = np.median(x[max(0, i - rules.side):i]), np.median(x[end:end + rules.side])
            side = np.sign(inside[0] - before)
            dev = np.minimum(side * (inside - before), side * (inside - after)).min()
            if dev < least:
                continue
            back = min(abs(after - before), abs(x[end] - x[i - 1]))
            alone = side * (inside[0] - x[i - 1]) >= 0.5 * dev and side * (inside[-1] - x[end]) >= 0.5 * dev
            if not alone or back > 0.5 * np.abs(inside - (before + after) / 2).mean():
                continue
            if side < 0 and run == 1 and _is_regular(i, dev, distance, month, rules):
                continue
            found[i:end] = True
    return found


def reasons(days: np.ndarray, values: np.ndarray, rules: SpikeRules) -> np.ndarray:
    """Reason of each reading of one source in order of time, or an empty text.

    days: days since 1970-01-01; values: positive or not, never null.
    """
    out = np.full(len(values), "", dtype=object)
    sound = (values > rules.low) & (values < rules.high)
    if sound.any():
        ratio = values / np.median(values[sound])
        sound &= (ratio < rules.absurd_ratio) & (ratio > 1 / rules.absurd_ratio)
    out[~sound] = "imposible"
    v = values[sound]
    if len(v) < 3:
        return out
    x, month = np.log(v), days[sound].astype("datetime64[D]").astype("datetime64[M]").astype(np.int64)
    place, length = _equal_runs(v)
    change = np.diff(x)
    held = (length[1:] >= rules.stuck_run) & (place[1:] > 0)
    moved = ~held & (change != 0)
    # Only readings outside held runs tell whether the source moves, however long the runs are.
    free = (length[1:] < rules.stuck_run) & (length[:-1] < rules.stuck_run)
    moves = (free & moved).sum() >= max(rules.least_moves, rules.moves_share * free.sum())
    used = change[moved] if moves else change
    # Differences of independent readings spread sqrt(2) times as wide as the readings.
    scale = 1.4826 * np.median(np.abs(used)) / np.sqrt(2)
    place_of = np.flatnonzero(sound)
    out[place_of[_spikes(x, month, scale, rules)]] = "pico"
    if moves:
        out[place_of[(length >= rules.stuck_run) & (place > 0)]] = "atascado"
    return out


def flag_spikes(df: DataFrame, source: list[str], time: str, value: str, rules: SpikeRules = SpikeRules()) -> DataFrame:
    """Readings that do not fit the normal course of their source, with the reason.

    Result: the source columns, ``time`` (date), ``value`` (double) and ``motivo``:
    ``imposible`` (outside the physical bounds or of absurd size for the source),
    ``pico`` (one or two readings in a row far from the course on both sides, which
    then goes on as before; dips that recur with a period are none) or ``atascado``
    (each reading after the first of a long run of equal ones, in a source that
    otherwise moves).

    Null values and null times are no readings. Null source columns form a source
    of their own. Repeated rows count once; different readings of one time stand
    in order of value. Other columns are ignored. An empty table gives no rows.

    A source is cut into blocks of time that overlap by ``halo_days``, so that one
    with very many readings spreads over many tasks; a group holds one block. Of a source
    with more than ``block_rows`` readings a block spans as many days as so many readings do, a day at
    least; its regular dips are told within that.
    """
    day = F.datediff(F.col(time).cast("date"), F.lit("1970-01-01").cast("date"))
    keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(source)]
    names = [f"k{i}" for i in range(len(source))]
    known = df.select(*keys, day.alias("d"), F.col(value).cast("double").alias("v")).where("d is not null and v is not null and not isnan(v)")
    sizes = known.groupBy(*names).agg(F.count("*").alias("n"), (F.max("d") - F.min("d") + 1).alias("dias")).where(F.col("n") > rules.block_rows)
    width = F.greatest(F.lit(1), F.least(F.lit(rules.block_days), F.floor(F.col("dias") * F.lit(rules.block_rows) / F.col("n")))).cast("int")
    # At most one of them for every ``block_rows`` readings, so it is small beside any table; else the plain block holds.
    dense = F.broadcast(sizes.select(*[F.col(c).alias(f"h{i}") for i, c in enumerate(names)], width.alias("ancho")))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"h{i}")) for i, c in enumerate(names)], F.lit(True))
    block = F.coalesce("ancho", F.lit(rules.block_days))
    halo = F.least(F.lit(rules.halo_days), block)
    readings = (
        known.join(dense, same, "left")
        .withColumn("own", F.floor(F.col("d") / block))
        .withColumn(
            "b",
            F.explode(
                F.array_compact(
                    F.array(
                        F.col("own"),
                        F.when(F.col("d") - F.col("own") * block < halo, F.col("own") - 1),
                        F.when((F.col("own") + 1) * block - F.col("d") <= halo, F.col("own") + 1),
                    )
                )
            ),
        )
    )
    blocks = (
        readings.groupBy(*names, "b")
        .agg(F.array_sort(F.collect_set(F.struct("d", "v", (F.col("own") == F.col("b")).alias("core")))).alias("r"))
        # Blocks that hold nothing but a neighbour's overlap have nothing to report.
        .where(F.exists("r", lambda x: x["core"]))
        .select(*names, F.col("r.d").alias("d"), F.col("r.v").alias("v"), F.col("r.core").alias("core"))
    )
    key_types = {f.name: f.dataType.simpleString() for f in blocks.schema.fields}
    schema = ", ".join(f"{k} {key_types[k]}" for k in names) + ", d int, v double, motivo string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                days, values = np.asarray(row.d, dtype=np.int64), np.asarray(row.v, dtype=float)
                why = reasons(days, values, rules)
                for i in np.flatnonzero((why != "") & np.asarray(row.core, dtype=bool)):
                    rows.append((*row[: len(names)], days[i], values[i], why[i]))
            yield pd.DataFrame(rows, columns=[*names, "d", "v", "motivo"])

    found = blocks.mapInPandas(run, schema)
    return found.select(
        *[F.col(n).alias(c) for n, c in zip(names, source)],
        F.date_add(F.lit("1970-01-01").cast("date"), F.col("d")).alias(time),
        F.col("v").alias(value),
        "motivo",
    )
