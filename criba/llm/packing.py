"""Fixed-capacity containers filled with items: linear grouping, configurations, best fit.

Only the histogram of item sizes, at most ``capacity`` numbers, reaches the
driver. The plan made there is a list of intervals: the items of one size with
ordinals [a, a + m) go, one each, to the containers [c, c + m) at one offset.
Items find their interval by size and ordinal, in parallel.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from criba.session import cut_lineage

#: Numbers of equal-cardinality groups tried for the large sizes; the plan of fewest containers stays.
#: More groups round up less, fewer leave fewer items over when uses are rounded down.
GROUPS = (12, 24, 64)
#: Sizes above this share of the capacity are large.
LARGE = 0.125


def _best_pattern(sizes: np.ndarray, worth: np.ndarray, counts: np.ndarray, capacity: int) -> np.ndarray:
    """Number of items of each size in the most worthy content of one container (dynamic programme)."""
    best = np.zeros(capacity + 1)
    used: list[tuple[int, np.ndarray]] = []
    for i in np.argsort(-worth / sizes, kind="stable"):
        size, most = int(sizes[i]), int(min(counts[i], capacity // sizes[i]))
        take = np.zeros(capacity + 1, np.int64)
        base = best.copy()
        for n in range(1, most + 1):
            gain = base[: capacity + 1 - n * size] + n * worth[i]
            better = gain > best[n * size :] + 1e-12
            best[n * size :][better] = gain[better]
            take[n * size :][better] = n
        used.append((int(i), take))
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    for i, take in reversed(used):
        pattern[i] = take[room]
        room -= int(take[room]) * int(sizes[i])
    return pattern


def configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Contents of containers and how often to use each, for few sizes.

    The fractional optimum by column generation (a simplex whose entering columns
    are best patterns), rounded down; what is left over stays unplaced.
    """
    m = len(sizes)
    basis = np.diag(np.minimum(capacity // sizes, np.maximum(counts, 1))).astype(float)
    need = counts.astype(float)
    for _ in range(50 * m + 50):
        worth = np.linalg.solve(basis.T, np.ones(m))
        pattern = _best_pattern(sizes, np.maximum(worth, 0), counts, capacity)
        if worth @ pattern <= 1 + 1e-7:
            break
        x, step = np.linalg.solve(basis, need), np.linalg.solve(basis, pattern.astype(float))
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(np.argmin(ratio))
        if not np.isfinite(ratio[leave]):
            break
        basis[:, leave] = pattern
    uses = np.floor(np.linalg.solve(basis, need) + 1e-6).astype(np.int64)
    return [(basis[:, j].astype(np.int64), int(uses[j])) for j in range(m) if uses[j] > 0]


@dataclass
class _Kind:
    """Containers [first, first + many) with equal contents that take ``filled`` of the capacity."""

    first: int
    many: int
    filled: int


@dataclass
class Plan:
    """Intervals (size, ordinal, containers, many, offset) and the number of containers."""

    capacity: int
    rows: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    containers: int = 0

    def arrays(self) -> np.ndarray:
        """The intervals in order of size and ordinal."""
        return np.array(sorted(self.rows), dtype=np.int64).reshape(-1, 5)


class _Stock:
    """Items of each size not placed yet: the next ordinal and the end."""

    def __init__(self, histogram: dict[int, int]):
        self.next = {s: 0 for s in histogram}
        self.end = dict(histogram)

    def left(self, size: int) -> int:
        return self.end[size] - self.next[size]


def _place(plan: Plan, stock: _Stock, kind: _Kind, size: int, many: int) -> tuple[_Kind, _Kind | None]:
    """One item of ``size`` in each of the first ``many`` containers of a kind; the rest is split off."""
    plan.rows.append((size, stock.next[size], kind.first, many, kind.filled))
    stock.next[size] += many
    rest = _Kind(kind.first + many, kind.many - many, kind.filled) if many < kind.many else None
    return _Kind(kind.first, many, kind.filled + size), rest


def _fill_group(plan: Plan, stock: _Stock, kinds: list[_Kind], group: list[int]) -> list[_Kind]:
    """One item of a group (sizes from large to small) in every container of the kinds."""
    done: list[_Kind] = []
    todo = list(kinds)
    while todo:
        kind = todo.pop()
        size = next((s for s in group if stock.left(s)), None)
        if size is None:
            done.append(kind)
            continue
        filled, rest = _place(plan, stock, kind, size, min(kind.many, stock.left(size)))
        done.append(filled)
        if rest:
            todo.append(rest)
    return done


def make_plan(histogram: dict[int, int], capacity: int, groups: tuple[int, ...] = GROUPS, large: float = LARGE) -> Plan:
    """The plan of fewest containers among those for several numbers of groups."""
    return min((grouped_plan(histogram, capacity, g, large) for g in groups), key=lambda p: p.containers)


def grouped_plan(histogram: dict[int, int], capacity: int, groups: int, large: float = LARGE) -> Plan:
    """Places all items of a histogram (size to count, sizes from 1 to the capacity).

    Large sizes are grouped in descending order into ``groups`` of equal
    cardinality and rounded up to the largest of their group; configurations of the
    rounded sizes are optimised, the actual items take the slots of their group,
    and all that remains, small items above all, goes from large to small to the
    fullest containers that have room.
    """
    plan, stock = Plan(capacity), _Stock(histogram)
    by_size = sorted(histogram, reverse=True)
    big = [s for s in by_size if s > large * capacity]
    total = sum(histogram[s] for s in big)
    grouped: list[list[int]] = []
    seen = 0
    for s in big:
        # A size opens a new group where the items so far fill the groups before.
        if not grouped or seen * groups >= total * len(grouped):
            grouped.append([])
        grouped[-1].append(s)
        seen += histogram[s]
    kinds: list[_Kind] = []
    if grouped:
        tops = np.array([g[0] for g in grouped], np.int64)
        counts = np.array([sum(histogram[s] for s in g) for g in grouped], np.int64)
        for pattern, uses in configurations(tops, counts, capacity):
            own = [_Kind(plan.containers, uses, 0)]
            plan.containers += uses
            for i, n in enumerate(pattern):
                for _ in range(int(n)):
                    own = _fill_group(plan, stock, own, grouped[i])
            kinds += own
    # Best fit: kinds in ascending order of room; a size takes the tightest first.
    open_kinds = sorted(((capacity - k.filled, k.first, k) for k in kinds), key=lambda x: x[:2])
    for size in by_size:
        while stock.left(size):
            at = bisect.bisect_left(open_kinds, (size, -1), key=lambda x: x[:2])
            if at == len(open_kinds):
                each = capacity // size
                many = max(1, stock.left(size) // each)
                kind = _Kind(plan.containers, many, 0)
                plan.containers += many
                for _ in range(min(each, stock.left(size))):
                    kind, rest = _place(plan, stock, kind, size, min(kind.many, stock.left(size)))
                    if rest:
                        bisect.insort(open_kinds, (capacity - rest.filled, rest.first, rest), key=lambda x: x[:2])
            else:
                _, _, kind = open_kinds.pop(at)
                kind, rest = _place(plan, stock, kind, size, min(kind.many, stock.left(size)))
                if rest:
                    bisect.insort(open_kinds, (capacity - rest.filled, rest.first, rest), key=lambda x: x[:2])
            if kind.filled < capacity:
                bisect.insort(open_kinds, (capacity - kind.filled, kind.first, kind), key=lambda x: x[:2])
    return plan


def pack(sized: DataFrame, key: str, size: str, capacity: int = 2048) -> DataFrame:
    """Container and place of every item.

    sized: rows of ``key`` and ``size`` (a whole number). An item is cut only where
    it alone exceeds the capacity, into full pieces and one remainder; sizes that
    are null or below 1 take no place. Repeated rows are items of their own.

    Result: ``key, pieza`` (0, 1, ...), ``contenedor`` (0, 1, ...), ``inicio``
    (offset in the container), ``largo`` and ``desde`` (offset in the item). Which
    of several items of one size stands where depends on their order.
    """
    pieces = (
        sized.select(F.col(key).alias("k"), F.col(size).cast("long").alias("n"))
        .where("n > 0")
        .select("k", "n", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / capacity).cast("int") - 1)).alias("pieza"))
        .select("k", "pieza", F.least(F.lit(capacity), F.col("n") - F.col("pieza").cast("long") * capacity).cast("int").alias("largo"))
    )
    kind = dict(pieces.dtypes)["k"]

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, met = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            sizes = batch["largo"].to_numpy()
            before = batch.groupby("largo").cumcount().to_numpy()
            yield batch.assign(parte=part, n=met[sizes] + before)
            met += np.bincount(sizes, minlength=capacity + 1)

    # Written once: ordinals must stay the same when a lost part is read again.
    numbered = cut_lineage(pieces.mapInPandas(number, f"k {kind}, pieza int, largo int, parte int, n bigint"))
    parts = numbered.groupBy("largo", "parte").agg(F.count("*").alias("m"))
    before = Window.partitionBy("largo").orderBy("parte").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("antes", F.coalesce(F.sum("m").over(before), F.lit(0)))
    histogram = {r["largo"]: r["m"] for r in parts.groupBy("largo").agg(F.sum("m").alias("m")).collect()}
    plan = make_plan(histogram, capacity).arrays()

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # One number for size and ordinal, so that a search finds the interval.
        wide = (int((plan[:, 1] + plan[:, 3]).max()) + 1) if len(plan) else 1
        starts = plan[:, 0] * wide + plan[:, 1]
        for batch in batches:
            at = np.searchsorted(starts, batch["largo"].to_numpy(np.int64) * wide + batch["n"].to_numpy(np.int64), side="right") - 1
            box = plan[at, 2] + batch["n"].to_numpy(np.int64) - plan[at, 1]
            yield pd.DataFrame({"k": batch["k"], "pieza": batch["pieza"], "contenedor": box, "inicio": plan[at, 4].astype("int32"), "largo": batch["largo"], "desde": batch["pieza"].to_numpy(np.int64) * capacity})

    ordinals = numbered.join(offsets.drop("m"), ["largo", "parte"]).select("k", "pieza", "largo", (F.col("n") + F.col("antes")).alias("n"))
    placed = ordinals.mapInPandas(assign, f"k {kind}, pieza int, contenedor bigint, inicio int, largo int, desde bigint")
    return placed.withColumnRenamed("k", key)
