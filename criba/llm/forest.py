"""Most similar vectors by a hash-prefix forest: sorted arrays of hash strings, one a tree.

Each tree hashes every vector to a string of sign bits of random projections and
keeps the base's strings in a sorted array. A query descends in every tree to the
longest prefix that it shares with a base string, by binary search; then all trees
ascend together, one bit at a time, until the stretches of strings that share a
prefix of that length with the query hold enough vectors in all. Those are its
candidates, all of them: a level is never cut, so many vectors of one string are
looked at as a whole. Exact cosines follow.

The base is cut into shards of bounded size by a hash, each with a forest of its
own, so that what a task holds does not grow with the base and a larger base
loses no accuracy. A base of one small shard goes to the tasks that read the queries, and no
vector of theirs moves; beyond that queries meet the shards by one shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Forest:
    """Parameters of the search.

    trees   independent hash strings of each vector
    bits    length of a hash string, at most 62
    least   base vectors, counted once a tree, at which the trees stop to ascend
    sent    base vectors at most, by count, that are sent to every task
    shard   base vectors of one shard, about, beyond that
    block   queries of one shard's task, about; also those searched at a time
    seed    of the projections
    """

    trees: int = 20
    bits: int = 62
    least: int = 4096
    sent: int = 65_536
    shard: int = 131_072
    block: int = 65_536
    seed: int = 11


def usable_vectors(df: DataFrame, key: str, vector: str, size: int) -> DataFrame:
    """``k`` (key as text) and ``v`` (array of float) of the rows that take part.

    Left out are rows without a key and vectors that are null, not of ``size``
    entries, all zero, or with a null or non-finite entry.
    """
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # Adding zero turns minus zero into zero.
    named = df.select(F.col(key).cast("string").alias("k"), F.transform(F.col(vector), lambda x: (x + F.lit(0.0)).cast("float")).alias("v"))
    return named.where(F.col("k").isNotNull() & (F.size(v) == size) & finite & F.exists(v, lambda x: x != 0))


def indexed_vectors(base: DataFrame, key: str, vector: str, size: int, k: int) -> DataFrame:
    """The base's vectors that can be among the k closest of any query: ``k, v``.

    Of vectors of one direction, scaled copies too, those of the k smallest keys stand
    for all; each partition drops the others before it shuffles. Repeated keys with equal
    vectors count once.
    """
    v, known = F.col("v"), usable_vectors(base, key, vector, size)
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    # To 13 decimals, far finer than the nine of a cosine: scaled copies share it, near copies do not.
    # The array of one entry binds the norm, which would else be worked out again for every entry.
    direction = F.transform(F.array(norm), lambda n: F.transform(v, lambda x: F.floor(x / n * F.lit(1e13) + F.lit(0.5))))[0]
    marked = known.withColumn("d", direction).select("k", "v", F.xxhash64("d").alias("h1"), F.xxhash64(F.lit(size), "d").alias("h2"))
    place = F.dense_rank().over(Window.partitionBy("h1", "h2").orderBy("k"))
    copy = F.row_number().over(Window.partitionBy("h1", "h2", "k").orderBy(F.lit(1)))
    return marked.withColumn("lugar", place).where(F.col("lugar") <= k).withColumn("copia", copy).where("copia = 1").select("k", "v")


def _unit(v: np.ndarray) -> np.ndarray:
    x = v.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Index:
    """The forest of one shard: unit vectors in order of key, and for each tree the sorted strings and whose they are."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray, forest: Forest):
        order = np.argsort(keys, kind="stable")
        self.forest, self.keys, self.raw = forest, keys[order], vectors[order]
        self.unit = _unit(self.raw).astype(np.float32)
        rng = np.random.default_rng(forest.seed)
        self.planes = rng.standard_normal((vectors.shape[1], forest.trees * forest.bits)).astype(np.float32)
        codes = self._codes(self.unit)
        self.places = [np.argsort(c, kind="stable") for c in codes]
        self.codes = [c[p] for c, p in zip(codes, self.places)]

    def _codes(self, x: np.ndarray) -> np.ndarray:
        """Hash strings as numbers, a row a tree."""
        f = self.forest
        powers = np.int64(1) << np.arange(f.bits - 1, -1, -1, dtype=np.int64)
        out = np.empty((f.trees, len(x)), np.int64)
        for at in range(0, len(x), 4096):
            signs = (x[at : at + 4096] @ self.planes > 0).reshape(-1, f.trees, f.bits)
            out[:, at : at + 4096] = (signs.astype(np.int64) @ powers).T
        return out

    def _stretch(self, tree: int, codes: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the base strings stand that share a prefix of ``depth`` bits with each string."""
        low = self.forest.bits - depth
        prefix = codes >> low
        held = self.codes[tree]
        return np.searchsorted(held, prefix << low), np.searchsorted(held, ((prefix + 1) << low) - 1, side="right")

    def _longest(self, tree: int, codes: np.ndarray) -> np.ndarray:
        """Bits of the longest prefix shared with any base string: that of a neighbour in the sorted array."""
        held, at = self.codes[tree], np.searchsorted(self.codes[tree], codes)
        apart = np.minimum(codes ^ held[np.maximum(at - 1, 0)], codes ^ held[np.minimum(at, len(held) - 1)])
        # The exponent of a number is the place of its first bit; beyond 53 bits rounding may add one.
        width = np.frexp(apart.astype(np.float64))[1].astype(np.int64)
        width -= (apart >> np.maximum(width - 1, 0) == 0) & (width > 0)
        return self.forest.bits - width

    def _depths(self, codes: np.ndarray) -> np.ndarray:
        """The level of each query at which its trees together hold ``least`` base vectors: the deepest such one.

        It lies between the longest prefix of any tree and the root, where all trees hold
        all vectors; what a level holds shrinks as it gets deeper, so it is found by halving.
        """
        f = self.forest
        high = np.max([self._longest(t, codes[t]) for t in range(f.trees)], axis=0)
        low = np.zeros_like(high)
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            held = np.zeros(len(high), np.int64)
            for t in range(f.trees):
                a, b = self._stretch(t, codes[t], middle)
                held += b - a
            enough = held >= f.least
            low, high = np.where(open_ & enough, middle, low), np.where(open_ & ~enough, middle - 1, high)
        return low

    def _exact(self, exact: np.ndarray, among: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and column of the k closest of some base vectors by cosine to nine decimals, then by key."""
        n = len(self.keys)
        # Cosine and base number in one number: the larger, the sooner.
        rank = np.rint((exact @ _unit(self.raw[among]).T + 1) * 1e9).astype(np.int64) * n + (n - 1 - among)
        best = np.argpartition(-rank, k - 1, axis=1)[:, :k]
        return np.repeat(np.arange(len(exact)), k), best.ravel()

    def _candidates(self, exact: np.ndarray, unit: np.ndarray, codes: np.ndarray, k: int, margin: np.float32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, base vector and single-precision cosine of the best of each tree; all of a tree's that may tie with the k-th."""
        depth, out = self._depths(codes), []
        for t in range(self.forest.trees):
            a, b = self._stretch(t, codes[t], depth)
            order = np.lexsort((b, a))
            starts = np.flatnonzero(np.r_[True, (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)])
            vectors, place = self.unit[self.places[t]], self.places[t]
            # Queries of one stretch are compared with it together.
            for s, e in zip(starts, np.r_[starts[1:], len(order)]):
                lo, hi = a[order[s]], b[order[s]]
                if lo == hi:
                    continue
                step = max(1, 8_000_000 // (hi - lo))
                for at in range(s, e, step):
                    asked = order[at : min(e, at + step)]
                    near = unit[asked] @ vectors[lo:hi].T
                    if hi - lo <= k:
                        row, col = (x.ravel() for x in np.indices(near.shape))
                    else:
                        kth = np.partition(near, hi - lo - k, axis=1)[:, hi - lo - k, None]
                        row, col = np.nonzero(near >= kth - margin)
                        if len(row) > 16 * k * len(asked):
                            # Near copies in number: the exact order decides at once.
                            row, col = self._exact(exact[asked], place[lo:hi], k)
                    out.append((asked[row], place[lo + col], near[row, col]))
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)
        return tuple(np.concatenate(x) for x in zip(*out))

    def search(self, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query number, base number and cosine (to nine decimals) of the k closest; equal cosines in order of the base key."""
        exact = _unit(vectors)
        unit = exact.astype(np.float32)
        # What single precision may misjudge between two dot products, and what rounding may level.
        margin = np.float32(2 * (unit.shape[1] + 4) * 2.0**-24 + 2e-9)
        q, b, near = self._candidates(exact, unit, self._codes(unit), k, margin)
        pair, first = np.unique(q * np.int64(len(self.keys)) + b, return_index=True)
        q, b, near = q[first], b[first], near[first]
        order = np.lexsort((-near, q))
        q, b, near = q[order], b[order], near[order]
        start = np.searchsorted(q, q)
        kth = np.minimum(start + k - 1, np.searchsorted(q, q, side="right") - 1)
        kept = near >= near[kth] - margin
        q, b = q[kept], b[kept]
        cos = np.empty(len(q))
        for at in range(0, len(q), 65_536):
            j = slice(at, at + 65_536)
            cos[j] = np.round((exact[q[j]] * _unit(self.raw[b[j]])).sum(-1), 9)
        # Base vectors stand in order of key, so that the lower number settles a tie.
        order = np.lexsort((b, -cos, q))
        q, b, cos = q[order], b[order], cos[order]
        best = np.arange(len(q)) - np.searchsorted(q, q) < k
        return q[best], b[best], cos[best]


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    values = [np.asarray(c.flatten()) for c in column.chunks] or [np.empty(0, np.float32)]
    return np.concatenate(values).astype(np.float32, copy=False).reshape(-1, size)


_SCHEMA = pa.schema([("q", pa.string()), ("b", pa.string()), ("cos", pa.float64()), ("lugar", pa.int32())])


def _answer(index: Index, keys: np.ndarray, vectors: np.ndarray, k: int) -> pa.Table:
    q, b, cos = index.search(vectors, k)
    place = (np.arange(len(q)) - np.searchsorted(q, q) + 1).astype(np.int32)
    return pa.table([pa.array(keys[q], pa.string()), pa.array(index.keys[b], pa.string()), pa.array(cos), pa.array(place)], schema=_SCHEMA)


def _keys(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(object)


def _search_sent(asked: DataFrame, known: DataFrame, size: int, k: int, forest: Forest) -> DataFrame:
    """Every task holds the whole base, which is of a checked size, and answers the queries that it reads."""
    held = known.toArrow()
    shared = asked.sparkSession.sparkContext.broadcast((_keys(held["k"]), _matrix(held["v"], size)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, waiting, rows = None, [], 0
        if not len(shared.value[0]):
            return

        def out() -> Iterator[pa.RecordBatch]:
            block = pa.Table.from_batches(waiting)
            yield from _answer(index, _keys(block["k"]), _matrix(block["v"], size), k).to_batches(max_chunksize=100_000)

        for batch in batches:
            if not batch.num_rows:
                continue
            index = index or Index(*shared.value, forest)
            waiting.append(batch)
            rows += batch.num_rows
            if rows >= forest.block // 4:
                yield from out()
                waiting, rows = [], 0
        if waiting:
            yield from out()

    return asked.mapInArrow(run, "q string, b string, cos double, lugar int")


def _search_shards(asked: DataFrame, known: DataFrame, shards: int, blocks: int, size: int, k: int, forest: Forest) -> DataFrame:
    """Every block of queries meets every shard; the best of all shards are chosen afterwards."""
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = known.withColumn("parte", F.pmod(F.xxhash64("k"), F.lit(shards)).cast("int")).withColumn("bloque", spread(blocks))
    # By key and vector: a key that many rows repeat still spreads.
    right = asked.withColumn("bloque", F.pmod(F.xxhash64("k", "v", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")).withColumn("parte", spread(shards))

    def run(base: pa.Table, queries: pa.Table) -> pa.Table:
        if not base.num_rows or not queries.num_rows:
            return _SCHEMA.empty_table()
        index = Index(_keys(base["k"]), _matrix(base["v"], size), forest)
        keys, vectors, step = _keys(queries["k"]), _matrix(queries["v"], size), forest.block // 4
        return pa.concat_tables([_answer(index, keys[at : at + step], vectors[at : at + step], k) for at in range(0, len(keys), step)])

    found = left.groupBy("parte", "bloque").cogroup(right.groupBy("parte", "bloque")).applyInArrow(run, "q string, b string, cos double, lugar int")
    return found.drop("lugar")


def _top(pairs: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; Spark limits each group before it shuffles."""
    return pairs.withColumn("lugar", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("lugar") <= k)


def write_index(base: DataFrame, key: str, vector: str, size: int, k: int, path: str) -> None:
    """Stores what the index is built from, so that later searches need no look at the base: ``k, v``.

    ``nearest`` takes the stored table as its base (key ``k``, vector ``v``).
    """
    indexed_vectors(base, key, vector, size, k).write.mode("overwrite").parquet(path)


def index_health(base: DataFrame, key: str, vector: str, size: int, k: int, stored: DataFrame) -> DataFrame:
    """How a stored index fits the base as it is now, one row: ``vigentes, faltan, sobran, cobertura``.

    Vectors that stand in both unchanged, those that the index lacks or holds in another state,
    those of the index that the base no longer has so; the share of the base that is up to date (null for an empty base).
    """
    now = indexed_vectors(base, key, vector, size, k).select("k", F.xxhash64("v").alias("h"), F.lit(True).alias("hay"))
    held = stored.select("k", F.xxhash64("v").alias("h"), F.lit(True).alias("guardado"))
    both = now.join(held, ["k", "h"], "full")
    counted = both.agg(F.count_if(F.col("hay") & F.col("guardado")).alias("vigentes"), F.count_if(F.col("hay") & F.col("guardado").isNull()).alias("faltan"), F.count_if(F.col("hay").isNull()).alias("sobran"))
    return counted.withColumn("cobertura", F.try_divide(F.col("vigentes").cast("double"), F.col("vigentes") + F.col("faltan")))


def nearest(
    queries: DataFrame,
    query_key: str,
    query_vector: str,
    base: DataFrame,
    base_key: str,
    base_vector: str,
    size: int,
    k: int = 5,
    forest: Forest = Forest(),
) -> DataFrame:
    """The k base keys of highest cosine for each query key.

    Result: ``query_key, base_key`` (as text), ``cos`` and ``lugar`` (1 to k); equal
    cosines stand in order of the base key. Unusable vectors neither have nor are
    neighbours (see ``usable_vectors``); fewer than k usable base vectors give
    fewer rows, none give none. Repeated query rows with equal vectors count once; one key
    with several vectors has the best over all of them.
    Candidates come from the forest, their cosines are exact; a neighbour is missed
    only if in every tree of its shard it leaves the query's prefix before the
    level at which the trees hold ``least`` vectors.
    """
    asked = usable_vectors(queries, query_key, query_vector, size)
    known = indexed_vectors(base, base_key, base_vector, size, k)
    rows = base.count()
    if rows <= forest.sent:
        found = _search_sent(asked, known, size, k, forest)
    else:
        blocks = max(1, -(-queries.count() // forest.block))
        shards = -(-rows // forest.shard)
        # At least a task a core, where fewer would do for memory.
        blocks = max(blocks, math.ceil(queries.sparkSession.sparkContext.defaultParallelism / shards))
        found = _search_shards(asked, known, shards, blocks, size, k, forest)
    # One row a pair, then the best of all shards and of all rows of a key.
    pairs = found.groupBy("q", "b").agg(F.max("cos").alias("cos"))
    best = _top(pairs, ["q"], [F.desc("cos"), F.col("b")], k)
    return best.select(F.col("q").alias(query_key), F.col("b").alias(base_key), "cos", "lugar")
