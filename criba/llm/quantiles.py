"""Percentiles with bounded error from mergeable sketches: randomized compactor hierarchies.

A sketch holds levels of values; a value on level h stands for 2^h input values.
A full level is sorted and every other value, from a random first or second,
moves up. Sketches merge level by level, so partial results of partitions, days
or months combine in any order.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Capacity of the top level. A group of at most this many values is answered exactly.
SIZE = 1024
#: Capacity of each level below, as a share of the level above.
SHRINK = 2 / 3
LEAST = 8


class Sketch:
    """A compactor hierarchy over float values."""

    def __init__(self, size: int = SIZE):
        self.size, self.n, self.levels = size, 0, [np.empty(0)]

    def _capacity(self, level: int) -> int:
        return max(LEAST, int(self.size * SHRINK ** (len(self.levels) - 1 - level)))

    def add(self, values: np.ndarray, rng: np.random.Generator) -> None:
        """Takes values in; infinities are values, not-a-numbers are none."""
        values = values[~np.isnan(values)]
        for part in np.array_split(values, len(values) // self.size + 1):
            self.levels[0] = np.concatenate([self.levels[0], part])
            self.n += len(part)
            self._compress(rng)

    def merge(self, other: Sketch, rng: np.random.Generator) -> None:
        while len(self.levels) < len(other.levels):
            self.levels.append(np.empty(0))
        for h, values in enumerate(other.levels):
            self.levels[h] = np.concatenate([self.levels[h], values])
        self.n += other.n
        self._compress(rng)

    def _compress(self, rng: np.random.Generator) -> None:
        """Compacts the lowest overfull level until the whole fits its total capacity."""
        while sum(map(len, self.levels)) > sum(self._capacity(h) for h in range(len(self.levels))):
            h = next(h for h in range(len(self.levels)) if len(self.levels[h]) > self._capacity(h))
            if h + 1 == len(self.levels):
                self.levels.append(np.empty(0))
            values = np.sort(self.levels[h])
            # Of an odd number one value stays, so that the weights always add up to n.
            stay = len(values) % 2
            moved = values[stay:][rng.integers(2) :: 2]
            self.levels[h] = values[:stay]
            self.levels[h + 1] = np.concatenate([self.levels[h + 1], moved])

    def quantiles(self, shares: np.ndarray) -> np.ndarray:
        """For each share p the value of rank ceil(p n), the first for p = 0."""
        values = np.concatenate(self.levels)
        if not len(values):
            return np.full(len(shares), np.nan)
        weights = np.repeat(2.0 ** np.arange(len(self.levels)), [len(v) for v in self.levels])
        order = np.argsort(values, kind="stable")
        reached = np.cumsum(weights[order])
        at = np.searchsorted(reached, np.maximum(1.0, np.ceil(shares * self.n - 1e-9)), side="left")
        return values[order][np.minimum(at, len(values) - 1)]

    def rank_error(self) -> float:
        """Bound on the rank error as a share of n, exceeded with a probability below 1 %.

        Each compaction of level h shifts a rank by 2^h or not at all, with mean
        zero; as level h is compacted at most n / (2^h k_h) times, the variance is at
        most n sum(2^h / k_h). 2.6 deviations hold 99 % of the cases.
        """
        top = len(self.levels) - 1
        if top == 0 or self.n == 0:
            return 0.0
        variance = self.n * sum(2.0**h / self._capacity(h) for h in range(top))
        return float(min(1.0, 2.6 * np.sqrt(variance) / self.n))

    def to_bytes(self) -> bytes:
        lengths = [len(v) for v in self.levels]
        return struct.pack(f"<qii{len(lengths)}i", self.n, self.size, len(lengths), *lengths) + np.concatenate(self.levels).astype("<f8").tobytes()

    @staticmethod
    def from_bytes(data: bytes) -> Sketch:
        n, size, count = struct.unpack_from("<qii", data)
        lengths = struct.unpack_from(f"<{count}i", data, 16)
        values = np.frombuffer(data, "<f8", offset=16 + 4 * count)
        out = Sketch(size)
        out.n = n
        out.levels = [np.array(v) for v in np.split(values, np.cumsum(lengths)[:-1])]
        return out


#: Groups whose sketches a task holds at once; at this number it hands them on and starts anew.
HELD = 20_000


def sketches(df: DataFrame, value: str, groupings: dict[str, str], size: int = SIZE, seed: int = 7) -> DataFrame:
    """Partial sketches of ``value`` for several groupings, one scan and no shuffle.

    groupings: name to the column that groups. Result: ``dimension`` (the name),
    ``grupo`` (the key as text, null for a null key) and ``sketch`` (binary), several
    rows a group. Null values and not-a-numbers do not count. Merge with
    ``merge_sketches``; the rows may also be kept, a day or month at a time.
    """
    keys = [F.col(c).cast("string").alias(f"g{i}") for i, c in enumerate(groupings.values())]
    names = list(groupings)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        held: dict[tuple[str, str | None], Sketch] = {}

        def out() -> pd.DataFrame:
            rows = [(d, g, s.to_bytes()) for (d, g), s in held.items()]
            held.clear()
            return pd.DataFrame(rows, columns=["dimension", "grupo", "sketch"])

        for batch in batches:
            values = batch["v"].to_numpy(float)
            for i, name in enumerate(names):
                codes, groups = pd.factorize(batch[f"g{i}"], use_na_sentinel=False)
                order = np.argsort(codes, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(codes[order])) + 1):
                    if len(part):
                        g = groups[codes[part[0]]]
                        held.setdefault((name, None if pd.isna(g) else g), Sketch(size)).add(values[part], rng)
                if len(held) >= HELD:
                    yield out()
        yield out()

    return df.select(F.col(value).cast("double").alias("v"), *keys).where("v is not null").mapInPandas(run, "dimension string, grupo string, sketch binary")


def _merged(parts: DataFrame, keys: list[str], schema: str, emit, seed: int) -> DataFrame:
    """Streams partial sketches in order of their group and hands each merged one to ``emit``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId(), 1])
        group, held = None, None
        for batch in batches:
            rows = []
            for *key, data in batch[[*keys, "sketch"]].itertuples(index=False):
                key = tuple(None if pd.isna(k) else k for k in key)
                one = Sketch.from_bytes(data)
                if held is not None and key == group:
                    held.merge(one, rng)
                    continue
                if held is not None:
                    rows += emit(group, held)
                group, held = key, one
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
        if held is not None:
            yield pd.DataFrame(emit(group, held), columns=[c.split()[0] for c in schema.split(", ")])

    # A group has at most one row a task that met it, each of bounded size; of many such rows, some are merged first.
    return parts.select(*keys, "sketch").repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


#: Partial sketches of one group that one task merges; beyond as many partitions there is a first round of merging.
FAN = 64


def _fanned(parts: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """Partial sketches of which a group has about the square root of the number of partitions, or ``FAN`` at most."""
    tasks = parts.rdd.getNumPartitions()
    if tasks <= FAN:
        return parts
    salt = F.pmod(F.spark_partition_id(), F.lit(int(np.sqrt(tasks)))).cast("string")
    first = parts.withColumn("_salt", salt)
    schema = ", ".join(f"{k} string" for k in [*keys, "_salt"]) + ", sketch binary"
    return _merged(first, [*keys, "_salt"], schema, lambda key, s: [(*key, s.to_bytes())], seed + 1).drop("_salt")


def merge_sketches(parts: DataFrame, keys: list[str], seed: int = 7) -> DataFrame:
    """One sketch a group from any number of partial ones; keys are text columns."""
    schema = ", ".join(f"{k} string" for k in keys) + ", sketch binary"
    return _merged(_fanned(parts, keys, seed), keys, schema, lambda key, s: [(*key, s.to_bytes())], seed)


def percentiles(parts: DataFrame, keys: list[str], shares: tuple[float, ...] = (0.25, 0.5, 0.75), seed: int = 7) -> DataFrame:
    """Percentiles of each group from partial sketches.

    Result: the keys, ``n`` (values), ``p``, ``valor`` (the value of rank ceil(p n)
    within the error) and ``error_rango`` (bound on the rank error as a share of n,
    0 where the answer is exact).
    """
    schema = ", ".join(f"{k} string" for k in keys) + ", n bigint, p double, valor double, error_rango double"

    def emit(key: tuple, s: Sketch) -> list[tuple]:
        if not s.n:
            return []
        values, error = s.quantiles(np.array(shares)), s.rank_error()
        return [(*key, s.n, p, float(v), error) for p, v in zip(shares, values)]

    return _merged(_fanned(parts, keys, seed), keys, schema, emit, seed)
