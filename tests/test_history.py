"""Attribute history on hand-written snapshots and against a plain loop."""

import datetime as dt
import random

from pyspark.sql import functions as F

from criba.operators.history import as_of, attribute_versions
from criba.plans.core import listing_content

D = [dt.date(2025, m, 28) for m in range(1, 13)]
SCHEMA = "k string, t date, l int, a string, b string, c0 string"


def _versions(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = attribute_versions(df, "k", "t", "l", {"a": F.lower("a"), "b": F.col("b")})
    return sorted((r.k, r.valido_desde, r.valido_hasta, r.a, r.b) for r in out.collect())


def test_changes_gaps_and_nulls(spark):
    end = dt.date(9999, 12, 31)
    rows = [
        ("p", D[0], 1, "X", "1", "z"), ("p", D[1], 1, "x", "1", "z"), ("p", D[3], 1, None, "1", "z"), ("p", D[4], 1, "Y", None, "z"),
        ("p", D[5], 1, "y", "2", "z"), ("q", D[2], 1, None, None, "z"), (None, D[2], 1, "n", "n", "z"), ("r", None, 1, "n", "n", "z"),
    ]
    assert _versions(spark, rows + rows) == [("p", D[0], D[4], "X", "1"), ("p", D[4], D[5], "Y", "1"), ("p", D[5], end, "y", "2"), ("q", D[2], end, None, None)]


def test_last_load_counts(spark):
    rows = [("p", D[0], 2, "new", "1", "z"), ("p", D[0], 1, "old", "1", "z"), ("p", D[1], 1, "new", "1", "z")]
    assert len(_versions(spark, rows)) == 1


def test_empty(spark):
    assert _versions(spark, []) == []


def test_against_a_loop(spark):
    rng = random.Random(4)
    rows = []
    for k in range(60):
        for t in D:
            for load in range(rng.choice((0, 1, 1, 2))):
                rows.append((f"k{k}", t, load, rng.choice(("A", "a", "B", None)), rng.choice(("1", "2", None)), "z"))
    rng.shuffle(rows)
    last = {}
    for k, t, load, a, b, _ in rows:
        if (k, t) not in last or load > last[k, t][0]:
            last[k, t] = (load, a, b)
    expected, held = [], {}
    for (k, t), (_, a, b) in sorted(last.items()):
        before = held.get(k)
        now = ((a.lower() if a else before and before[0]), (b if b else before and before[1]))
        if before != now or k not in held:
            expected.append((k, t))
        held[k] = now
    assert sorted((v[0], v[1]) for v in _versions(spark, rows)) == sorted(expected)


def test_listing_content(spark):
    rows = [("p", D[0], "Uno  5 MG", "https://x/a?q=1", "i"), ("p", D[1], "UNO 5mg ", "HTTPS://X/a?z", "i#f?"), ("p", D[2], "uno 5 mg", "https://x/b", "i#f")]
    df = spark.createDataFrame(rows, "k string, t date, descripcion string, url_producto_actual string, url_imagen_actual string")
    found = attribute_versions(df, "k", "t", "t", listing_content())
    assert [r.valido_desde for r in found.orderBy("valido_desde").collect()] == [D[0], D[1], D[2]]


def test_as_of(spark):
    versions = attribute_versions(spark.createDataFrame([("p", D[0], 1, "X", "1", ""), ("p", D[4], 1, "Y", "1", "")], SCHEMA), "k", "t", "l", {"a": F.col("a")})
    asked = spark.createDataFrame([("p", D[2]), ("p", D[4]), ("p", dt.date(2020, 1, 1)), ("q", D[2])], "k string, m date")
    assert {(r.k, r.m, r.a) for r in as_of(versions, "k", asked, "m").collect()} == {("p", D[2], "X"), ("p", D[4], "Y"), ("p", dt.date(2020, 1, 1), None), ("q", D[2], None)}
