"""Entity resolution: crosswalks, cross-store codes, exact neighbours, decisions, calibration."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from criba.functions.magnitudes import extract_attributes, magnitudes_agree
from criba.functions.stats import ratio, wilson
from criba.functions.text import clean_text, ngrams, tokens
from criba.operators.relational import top_k


def unique_match(candidates: DataFrame, key: Sequence[str], target: str) -> DataFrame:
    """Keys with exactly one distinct candidate, and that candidate; ambiguous keys have none."""
    counted = candidates.where(F.col(target).isNotNull()).groupBy(*key).agg(F.min(target).alias(target), F.max(target).alias("_u"))
    return counted.where(F.col(target) == F.col("_u")).drop("_u")


def crosswalk(items: DataFrame, item: Sequence[str], code: str, table: DataFrame, table_code: str, target: str, valid: DataFrame) -> DataFrame:
    """Items matched by code to the one target that the crosswalk gives them and that ``valid`` has."""
    known = table.select(F.col(table_code).alias(code), target).distinct().join(valid.select(target).distinct(), target, "left_semi")
    return unique_match(items.join(known, code), item, target)


def cross_store(items: DataFrame, key: str, store: str, sku: str, target: str) -> DataFrame:
    """Targets lent between stores by equal long codes: ``key, target, regla``.

    Rule 1: equal codes of at least eight digits in another store. Rule 2: a code of
    twelve digits equals another store's one of thirteen without its last digit.
    Rule 1 goes before rule 2; within the rule the target must be unique. Items
    with a target of their own lend and do not borrow.
    """
    digits = F.regexp_replace(F.regexp_replace(sku, r"\D", ""), "^0+", "")
    coded = items.select(F.col(key).alias("k"), F.col(store).alias("s"), digits.alias("c"), F.col(target).alias("t"))
    lend = coded.where("t is not null").select(F.col("s").alias("s2"), F.col("c").alias("c2"), F.col("t").alias("t2")).distinct()
    ask = coded.where("t is null").drop("t")
    by_equal = ask.where("length(c) >= 8").join(lend, (F.col("c") == F.col("c2")) & (F.col("s") != F.col("s2"))).select("k", "t2", F.lit(1).alias("regla"))
    short, long = ask.where("length(c) = 12"), ask.where("length(c) = 13")
    cut = F.substring("c2", 1, 12)
    by_cut = short.join(lend.where("length(c2) = 13"), (F.col("c") == cut) & (F.col("s") != F.col("s2"))).select("k", "t2", F.lit(2).alias("regla"))
    by_added = long.join(lend.where("length(c2) = 12"), (F.substring("c", 1, 12) == F.col("c2")) & (F.col("s") != F.col("s2"))).select("k", "t2", F.lit(2).alias("regla"))
    every = by_equal.unionByName(by_cut).unionByName(by_added)
    per_rule = every.groupBy("k", "regla").agg(F.min("t2").alias("a"), F.max("t2").alias("b"))
    best = per_rule.groupBy("k").agg(F.min_by(F.struct("a", "b", "regla"), F.col("regla")).alias("x"))
    return best.select(F.col("k").alias(key), F.col("x.a").alias(target), F.col("x.regla").alias("regla"), (F.col("x.a") == F.col("x.b")).alias("_u")).where("_u").drop("_u")


#: Vectors of one block; a task compares one block of queries with one of the base.
BLOCK = 4096


def exact_neighbours(queries: DataFrame, query_key: str, base: DataFrame, base_key: str, vector: str, k: int, skip_self: bool = False) -> DataFrame:
    """The k base vectors of least cosine distance of each query, by comparing all blocks with all.

    ``query_key, base_key, distancia, lugar``; equal distances in order of the base
    key. Vectors that are null or all zero take no part. The plain search against
    which faster ones are measured; its work is the product of both sizes.
    """
    blocks = lambda df: max(1, -(-df.count() // BLOCK))
    n, m = blocks(queries), blocks(base)

    def part(df: DataFrame, key: str, own: str, parts: int, other: str, others: int) -> DataFrame:
        return (
            df.select(F.col(key).cast("string").alias("id"), F.col(vector).cast("array<double>").alias("v"))
            .where(F.exists("v", lambda x: x != 0))
            .withColumn(own, F.pmod(F.hash("id"), F.lit(parts)))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        )

    left = part(queries, query_key, "fila", n, "columna", m)
    right = part(base, base_key, "de_columna", m, "de_fila", n)

    def compare(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        columns = ["q", "b", "d"]
        if q.empty or b.empty:
            return pd.DataFrame(columns=columns)
        unit = lambda df: (x := np.stack(df["v"].to_numpy())) / np.linalg.norm(x, axis=1, keepdims=True)
        b = b.sort_values("id", ignore_index=True)
        distance = np.round(1 - unit(q) @ unit(b).T, 9)
        if skip_self:
            distance[q["id"].to_numpy()[:, None] == b["id"].to_numpy()] = np.inf
        best = np.argsort(distance, axis=1, kind="stable")[:, :k]
        d = np.take_along_axis(distance, best, 1)
        row, col = np.nonzero(np.isfinite(d))
        return pd.DataFrame({"q": q["id"].to_numpy()[row], "b": b["id"].to_numpy()[best[row, col]], "d": d[row, col]})

    pairs = left.groupBy("fila", "columna").cogroup(right.groupBy("de_fila", "de_columna")).applyInPandas(compare, "q string, b string, d double")
    best = top_k(pairs, ["q"], [F.col("d"), F.col("b")], k)
    return best.select(F.col("q").alias(query_key), F.col("b").alias(base_key), F.col("d").alias("distancia"), "lugar")


def decision(distance: Column, margin: Column, guard: Column, farma: Column, tau_farma: float, tau_other: float, delta: float) -> Column:
    """``match``, ``cuarentena`` or ``sin_match`` of a first candidate.

    Beyond the threshold of its division (null counts as other) there is no match;
    within, it takes a guard that holds and a margin of at least ``delta`` (a null
    margin does not pass) to match.
    """
    tau = F.when(F.coalesce(farma, F.lit(False)), tau_farma).otherwise(tau_other)
    sure = F.coalesce(guard, F.lit(False)) & F.coalesce(margin >= delta, F.lit(False))
    return F.when(distance.isNull() | (distance > tau), "sin_match").when(sure, "match").otherwise("cuarentena")


def evaluated(candidates: DataFrame, items: DataFrame, key: str, text: str, base: DataFrame, target: str, base_text: str, brand: str, forced: Column) -> DataFrame:
    """Candidates with what speaks for them: ``guarda_ok, marca_ok, es_forzada``.

    guarda_ok   the magnitudes of both texts contradict each other in nothing
    marca_ok    the item's text has all words of the catalogue entry's brand; null without a brand
    es_forzada  ``forced``, a test on the item's columns, holds

    A candidate of an unknown item or entry is left out; a null text says nothing and contradicts nothing.
    """
    own = items.select(key, clean_text(text).alias("_t"), F.coalesce(forced, F.lit(False)).alias("es_forzada")).dropDuplicates([key])
    known = base.select(target, clean_text(base_text).alias("_b"), F.col(brand).alias("_m")).dropDuplicates([target])
    joined = candidates.join(own, key).join(known, target)
    guard = magnitudes_agree(extract_attributes("_t"), extract_attributes("_b"))
    words = words_covered(tokens(clean_text("_m")), tokens("_t"))
    return joined.select(*candidates.columns, guard.alias("guarda_ok"), F.when(F.col("_m").isNotNull(), F.coalesce(words, F.lit(False))).alias("marca_ok"), "es_forzada")


def quarantine_reason(margin: Column, guard: Column, delta: float) -> Column:
    """Why a candidate within its threshold is set aside: ``margen``, else ``guarda``, else ``estrato_forzado``."""
    return F.when(~F.coalesce(margin >= delta, F.lit(False)), "margen").when(~F.coalesce(guard, F.lit(False)), "guarda").otherwise("estrato_forzado")


def any_pair(rules: Sequence[dict[str, str]]) -> Column:
    """True where a row equals any of the rules in all columns that the rule names; no rules, never."""
    out = F.lit(False)
    for rule in rules:
        same = F.lit(True)
        for column, value in rule.items():
            same = same & F.coalesce(F.col(column) == value, F.lit(False))
        out = out | same
    return out


def decisions(universe: DataFrame, decided: DataFrame, key: str, candidate: Sequence[str], name: str = "decision", none: str = "sin_match") -> DataFrame:
    """The decision on every row of the universe; without one, or with ``none``, the candidate's columns are null."""
    joined = universe.select(key).join(decided.select(key, *candidate, name), key, "left")
    told = F.coalesce(F.col(name), F.lit(none))
    return joined.select(key, *[F.when(told != none, F.col(c)).alias(c) for c in candidate], told.alias(name))


def first_method(methods: dict[str, str]) -> tuple[Column, Column]:
    """The first target that is not null among columns in order, and the name of its method (null for none)."""
    target, label = None, None
    for name, column in methods.items():
        target = F.col(column) if target is None else F.coalesce(target, F.col(column))
        label = F.when(F.col(column).isNotNull(), name) if label is None else label.when(F.col(column).isNotNull(), name)
    return target, label


def recall_at(truth: DataFrame, candidates: DataFrame, key: str, target: str, by: Sequence[str]) -> DataFrame:
    """``by, n, hallados, recall``: share of true targets that stand among a key's candidates, however they rank."""
    found = candidates.select(key, target).distinct().withColumn("_hay", F.lit(True))
    told = truth.join(found, [key, target], "left").groupBy(*by).agg(F.count("*").alias("n"), F.count("_hay").alias("hallados"))
    return told.withColumn("recall", ratio("hallados", "n"))


def words_covered(a: Column, b: Column) -> Column:
    """True where every word of array ``a`` is in ``b``; an empty ``a`` is covered."""
    return F.size(F.array_except(a, b)) == 0


def threshold_sweep(judged: DataFrame, by: Sequence[str], distance: str, right: str, steps: int = 41, width: float = 0.005) -> DataFrame:
    """Matches, right ones, precision and volume at each threshold ``i * width``.

    Rows are first reduced to one count for each step that they pass at, then summed
    over the steps below; the number of rows never meets the number of steps.
    """
    i = F.greatest(F.lit(0), F.ceil(F.round(F.col(distance) / width, 6))).cast("int")
    counts = judged.groupBy(*by, i.alias("i")).agg(F.count("*").alias("m"), F.count_if(F.col(right)).alias("r"))
    totals = counts.groupBy(*by).agg(F.sum("m").alias("total"))
    spread = counts.where(F.col("i") < steps).withColumn("paso", F.explode(F.sequence("i", F.lit(steps - 1))))
    swept = spread.groupBy(*by, "paso").agg(F.sum("m").alias("aceptados"), F.sum("r").alias("aciertos"))
    return swept.join(totals, list(by)).select(
        *by,
        F.round(F.col("paso") * width, 3).alias("tau"),
        "aceptados",
        "aciertos",
        ratio("aciertos", "aceptados").alias("precision"),
        ratio("aceptados", "total").alias("volumen"),
    )


def phrase_reach(phrases: DataFrame, phrase: str, texts: DataFrame, text: str) -> DataFrame:
    """For each phrase, whether and in how many texts its words stand in a row: ``phrase, textos, alcanzable``.

    An equality join on the vocabulary of word sequences instead of a search of
    every phrase in every text; sequences are counted before they are joined. They
    are of the lengths that the phrases have, which are looked up first.
    """
    wanted = phrases.select(phrase).distinct().withColumn("_p", F.array_join(tokens(phrase), " "))
    lengths = sorted(r[0] for r in wanted.select(F.size(tokens(phrase))).distinct().collect() if r[0] and r[0] > 0)
    words = tokens(text)
    rows = F.flatten(F.array(*[ngrams(words, n, n) for n in lengths])) if lengths else F.array().cast("array<string>")
    said = (
        texts.select(F.explode(F.array_distinct(rows)).alias("_p"))
        .groupBy("_p")
        .agg(F.count("*").alias("textos"))
    )
    return wanted.join(said, "_p", "left").select(phrase, F.coalesce("textos", F.lit(0)).alias("textos"), F.col("textos").isNotNull().alias("alcanzable"))


def audit(judged: DataFrame, by: Sequence[str], right: str, target: float, slack: float = 0.05) -> DataFrame:
    """Precision by group with its 95 % interval; flagged where even the upper bound misses the target by ``slack``."""
    told = judged.where(F.col(right).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col(right)).alias("aciertos"))
    low, high = wilson("aciertos", "n")
    return told.select(*by, "n", "aciertos", ratio("aciertos", "n").alias("precision"), low.alias("ic_bajo"), high.alias("ic_alto"), (high < target - slack).alias("alerta"))


def hashed_vectors(df: DataFrame, key: str, text: str, size: int = 96) -> DataFrame:
    """An embedder without a service: normalised counts of hashed character trigrams (``key, embedding``).

    Null and blank texts have a null vector. Stands where a remote model would be called.
    """
    import zlib

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for value in batch["t"]:
                v = np.zeros(size, np.float32)
                padded = f"  {value} " if value and value.strip() else ""
                for i in range(len(padded) - 2):
                    code = zlib.crc32(padded[i : i + 3].lower().encode("utf-8", "replace"))
                    v[code % size] += 1 if code & 1 << 30 else -1
                norm = np.linalg.norm(v)
                out.append(v / norm if norm else None)
            yield pd.DataFrame({"k": batch["k"], "embedding": out})

    kind = dict(df.dtypes)[key]
    found = df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, embedding array<float>")
    return found.withColumnRenamed("k", key)
