"""Operators of the llm subpackage: exactness, recall, capacity, accuracy and edge cases."""

import collections
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from criba.llm import bpe, forest, listings, packing, quantiles, topics


# --- tokens ---


def _reference(texts):
    tiktoken = pytest.importorskip("tiktoken")
    coder = tiktoken.Encoding("t", pat_str=bpe.WORDS, mergeable_ranks=bpe.load_ranks(bpe.VOCABULARY), special_tokens={})
    return [coder.encode_ordinary(t or "") for t in texts]


TEXTS = [None, "", " ", "hola", "It's  don't'd", "ÁÉ ñandú—🙂👩‍⚕️", "<|endoftext|>", "x" * 5000, "ab" * 3000, "\n\n \t  fin", "12345 678", "薬局 ™ ", "a\u0000b", "é" * 700]


def test_encode(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(0, None, 1)], "k long, t string, ids int")
    got = bpe.encode(df, "k", "t").orderBy("k").collect()
    assert [r.ids for r in got] == [[], *_reference(TEXTS)]
    assert bpe.encode(df, "k", "t").schema["ids"].dataType.simpleString() == "array<int>"
    assert [r.tokens for r in bpe.token_counts(df, "k", "t").orderBy("k").collect()] == [0, *map(len, _reference(TEXTS))]
    assert bpe.encode(df.limit(0), "k", "t").count() == 0


def test_both_merges_agree():
    ranks, rng = bpe.load_ranks(bpe.VOCABULARY), np.random.default_rng(2)
    for n in (1, 2, 3, 20, 200, 900):
        for alphabet in (2, 30, 256):
            word = bytes(rng.integers(0, alphabet, n, dtype=np.uint8) + (97 if alphabet < 256 else 0))
            assert bpe.encode_short(word, ranks) == bpe.encode_long(word, ranks)


# --- containers ---


def _check_plan(histogram, capacity):
    plan, items, seen = packing.make_plan(dict(histogram), capacity), collections.Counter(), collections.defaultdict(list)
    for size, ordinal, first, many, offset in plan.rows:
        items[size] += many
        for i in range(many):
            seen[first + i].append((offset, size))
    assert items == histogram and len(seen) == plan.containers
    for content in seen.values():
        end = 0
        for offset, size in sorted(content):
            assert offset == end
            end += size
        assert end <= capacity
    return plan.containers


def test_plans_are_sound_and_tight():
    rng = np.random.default_rng(0)
    for n, low, high in ((1, 1, 2), (7, 1, 2048), (400, 1, 2048), (3000, 600, 1400), (5000, 1, 300)):
        h = collections.Counter(rng.integers(low, high + 1, n).tolist())
        used, least = _check_plan(h, 2048), -(-sum(s * c for s, c in h.items()) // 2048)
        assert used <= max(least * 1.1, least + 3)
    assert _check_plan(collections.Counter({1024: 100, 2048: 3}), 2048) == 53
    # Three items of just under a third fit, however many there are.
    assert _check_plan(collections.Counter({682: 3000}), 2048) == 1000
    assert packing.make_plan({}, 2048).containers == 0


def test_pack(spark):
    sizes = [(f"d{i}", n, i) for i, n in enumerate([0, None, 1, 2048, 2049, 5000, 700, 700, 700, -3, 1000])] + [("d6", 700, 0)]
    df = spark.createDataFrame(sizes, "k string, n int, contenedor int")
    got = packing.pack(df, "k", "n", 2048).collect()
    assert collections.Counter(r.k for r in got) == {"d2": 1, "d3": 1, "d4": 2, "d5": 3, "d6": 2, "d7": 1, "d8": 1, "d10": 1}
    inside = collections.defaultdict(list)
    for r in got:
        inside[r.contenedor].append((r.inicio, r.largo))
    for content in inside.values():
        end = 0
        for start, size in sorted(content):
            assert start == end
            end += size
        assert end <= 2048
    assert sorted((r.desde, r.largo) for r in got if r.k == "d5") == [(0, 2048), (2048, 2048), (4096, 904)]
    assert packing.pack(df.limit(0), "k", "n").count() == 0


# --- percentiles ---


def test_sketches_merge_within_their_bound(spark):
    rng = np.random.default_rng(1)
    values = rng.lognormal(0, 2, 60_000)
    df = spark.createDataFrame([(f"g{i % 2}", i % 7, float(v)) for i, v in enumerate(values)], "g string, d int, v double").repartition(9)
    daily = [quantiles.merge_sketches(quantiles.sketches(df.where(F.col("d") == d), "v", {"g": "g"}), ["dimension", "grupo"]) for d in range(7)]
    whole = daily[0]
    for d in daily[1:]:
        whole = whole.unionByName(d)
    for r in quantiles.percentiles(whole, ["dimension", "grupo"], (0.01, 0.5, 0.99)).collect():
        own = np.sort(values[int(r.grupo[1]) :: 2])
        rank = np.searchsorted(own, r.valor, side="right") / len(own)
        assert r.n == len(own) and 0 < r.error_rango < 0.02 and abs(rank - r.p) <= r.error_rango


def test_small_groups_are_exact(spark):
    rows = [("a", float(i)) for i in range(1, 11)] + [("b", None), ("b", float("nan")), (None, 5.0), ("c", 2.0), ("c", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.grupo, r.p): (r.n, r.valor, r.error_rango) for r in quantiles.percentiles(quantiles.sketches(df, "v", {"g": "g"}), ["dimension", "grupo"], (0.0, 0.25, 0.5, 1.0)).collect()}
    assert got["a", 0.0] == (10, 1.0, 0.0) and got["a", 0.25] == (10, 3.0, 0.0) and got["a", 0.5] == (10, 5.0, 0.0) and got["a", 1.0] == (10, 10.0, 0.0)
    assert got[None, 0.5] == (1, 5.0, 0.0) and got["c", 0.5] == (2, 2.0, 0.0) and ("b", 0.5) not in got
    assert quantiles.percentiles(quantiles.sketches(df.limit(0), "v", {"g": "g"}), ["dimension", "grupo"]).count() == 0


def test_many_partitions_merge_in_two_rounds(spark):
    df = spark.range(40_000, numPartitions=100).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    parts = quantiles.sketches(df, "v", {"g": "g"})
    rows = quantiles.percentiles(parts, ["dimension", "grupo"]).collect()
    assert [r.n for r in rows] == [40_000] * 3
    assert all(abs(r.valor / 40_000 - r.p) <= max(r.error_rango, 1e-3) for r in rows)
    one = quantiles.merge_sketches(parts, ["dimension", "grupo"]).collect()
    assert len(one) == 1 and quantiles.Sketch.from_bytes(bytes(one[0].sketch)).n == 40_000


# --- neighbours ---


def _vectors(n, seed):
    rng = np.random.default_rng(seed)
    centres = np.random.default_rng(99).normal(size=(60, 16))
    return (centres[rng.integers(0, 60, n)] + rng.normal(0, 0.35, (n, 16))).astype(np.float32)


@pytest.mark.parametrize("rules", [forest.Forest(trees=10, least=640), forest.Forest(trees=10, least=320, sent=0, shard=500, block=64)])
def test_recall(spark, rules):
    """The whole base sent to the tasks, and shards and blocks far smaller than the data."""
    base, asked = _vectors(3000, 1), _vectors(400, 2)
    left = spark.createDataFrame([(f"q{i:04}", v.tolist()) for i, v in enumerate(asked)], "q string, v array<float>")
    right = spark.createDataFrame([(f"b{i:04}", v.tolist()) for i, v in enumerate(base)], "b string, v array<float>")
    got = collections.defaultdict(set)
    for r in forest.nearest(left, "q", "v", right, "b", "v", 16, 5, rules).collect():
        got[r.q].add(r.b)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    top = np.argsort(-(unit(asked) @ unit(base).T), axis=1)[:, :5]
    hits = sum(len(got[f"q{i:04}"] & {f"b{j:04}" for j in row}) for i, row in enumerate(top))
    assert hits / top.size >= 0.95 and all(len(g) == 5 for g in got.values()) and len(got) == 400


def test_runs_of_one_string_are_searched_whole(spark):
    """A third of the base is one direction in many norms with little noise: most of it shares whole hash strings."""
    rng = np.random.default_rng(5)
    base, centre = rng.normal(size=(1500, 16)), rng.normal(size=16)
    base[:500] = (centre + rng.normal(0, 4e-3, (500, 16))) * rng.uniform(0.5, 3, (500, 1))
    base, asked = base.astype(np.float32), (centre + rng.normal(0, 4e-3, (80, 16))).astype(np.float32)
    left = spark.createDataFrame([(f"q{i:04}", v.tolist()) for i, v in enumerate(asked)], "q string, v array<float>")
    right = spark.createDataFrame([(f"b{i:04}", v.tolist()) for i, v in enumerate(base)], "b string, v array<float>")
    cos = (lambda a, b: a @ b.T / np.linalg.norm(a, axis=1)[:, None] / np.linalg.norm(b, axis=1))(asked.astype(np.float64), base.astype(np.float64))
    want = {(f"q{i:04}", f"b{j:04}") for i, row in enumerate(np.round(cos, 9)) for j in np.lexsort((np.arange(1500), -row))[:5]}
    for rules in (forest.Forest(trees=4, least=64), forest.Forest(trees=4, least=64, sent=0, shard=400, block=16)):
        found = forest.nearest(left, "q", "v", right, "b", "v", 16, 5, rules)
        got = {(r.q, r.b) for r in found.collect()}
        assert len(got) == len(want) and len(got & want) / len(want) >= 0.99


def test_ties_of_different_vectors_go_by_key(spark):
    """Many vectors that tie at nine decimals without being equal, scaled or nearly so: the smallest keys win."""
    rng = np.random.default_rng(8)
    scaled = [(f"s{i:03}", [float(3 * i), float(4 * i), 0.0]) for i in rng.permutation(np.arange(1, 60)).tolist()]
    near = [(f"n{i:03}", [float(i), float(i) * 1e-6, 5.0 * i]) for i in rng.permutation(np.arange(1, 60)).tolist()]
    near += [(f"m{i:03}", [1.0, 1e-6 * i, 5.0]) for i in rng.permutation(np.arange(60)).tolist()]
    right = spark.createDataFrame(scaled + near + [("z", [1.0, 1.0, 1.0])], "b string, v array<float>")
    left = spark.createDataFrame([("q1", [3.0, 4.0, 0.0]), ("q2", [1.0, 0.0, 5.0])], "q string, v array<float>")
    for rules in (forest.Forest(trees=4, least=64), forest.Forest(trees=4, least=64, sent=0, shard=40, block=8)):
        found = forest.nearest(left, "q", "v", right, "b", "v", 3, 5, rules).collect()
        got = {q: [r.b for r in sorted(found, key=lambda r: r.lugar) if r.q == q] for q in ("q1", "q2")}
        assert got["q1"] == [f"s{i:03}" for i in range(1, 6)]
        assert got["q2"] == [f"m{i:03}" for i in range(5)]


def test_levels_are_the_deepest_that_hold_enough():
    """Descent and ascent against prefixes compared one by one."""
    rng = np.random.default_rng(4)
    base, asked = rng.normal(size=(300, 8)).astype(np.float32), rng.normal(size=(40, 8)).astype(np.float32)
    asked[:5] = base[:5]
    rules = forest.Forest(trees=3, bits=62, least=25)
    index = forest.Index(np.array([f"{i:03}" for i in range(300)], object), base, rules)
    codes, own = index._codes(forest._unit(asked).astype(np.float32)), index._codes(index.unit)
    shared = lambda a, b: 62 - int(a ^ b).bit_length()
    for i, depth in enumerate(index._depths(codes)):
        held = lambda d: sum(shared(codes[t][i], c) >= d for t in range(3) for c in own[t])
        assert held(depth) >= 25 and (depth == 62 or held(depth + 1) < 25)
    for t in range(3):
        assert index._longest(t, codes[t]).tolist() == [max(shared(c, b) for b in own[t]) for c in codes[t]]


def test_stored_index_and_its_health(spark, tmp_path):
    rows = [(f"b{i}", [float(i), 1.0, 0.0]) for i in range(8)] + [("n", None)]
    base = spark.createDataFrame(rows, "b string, v array<float>")
    forest.write_index(base, "b", "v", 3, 5, str(tmp_path / "i"))
    health = lambda df: forest.index_health(df, "b", "v", 3, 5, spark.read.parquet(str(tmp_path / "i"))).first().asDict()
    assert health(base) == {"vigentes": 8, "faltan": 0, "sobran": 0, "cobertura": 1.0}
    changed = base.where("b <> 'b0'").unionByName(spark.createDataFrame([("b9", [0.0, 0.0, 1.0])], base.schema))
    assert health(changed) == {"vigentes": 7, "faltan": 1, "sobran": 1, "cobertura": 0.875}
    left = spark.createDataFrame([("q", [1.0, 1.0, 0.0])], "q string, v array<float>")
    found = forest.nearest(left, "q", "v", spark.read.parquet(str(tmp_path / "i")), "k", "v", 3, 1)
    assert [tuple(r)[:2] for r in found.collect()] == [("q", "b1")]


def test_unusable_vectors_copies_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    left = [("q1", [1.0, 0.0]), ("q2", [1.0, 0.0]), ("q3", None), ("q4", [0.0, 0.0]), ("q5", [1.0]), ("q6", [nan, 1.0]), ("q7", [inf, 1.0]), ("q8", [None, 1.0]), (None, [1.0, 1.0]), ("q1", [1.0, 0.0])]
    right = [(f"b{i}", [3.0, 0.0], 1) for i in (9, 8, 7, 1, 2, 3, 4)] + [("z", [1.0, 0.1], 1), ("n", None, 1), ("o", [0.0, -0.0], 1)]
    a, b = spark.createDataFrame(left, "q string, v array<float>"), spark.createDataFrame(right, "b string, v array<float>, k int")
    got = sorted((r.q, r.lugar, r.b) for r in forest.nearest(a, "q", "v", b, "b", "v", 2, 5).collect())
    assert got == [(q, i + 1, x) for q in ("q1", "q2") for i, x in enumerate(("b1", "b2", "b3", "b4", "b7"))]
    few = sorted(r.b for r in forest.nearest(a.where("q = 'q1'"), "q", "v", b.where("b in ('z', 'b1')"), "b", "v", 2, 5).collect())
    assert few == ["b1", "z"]
    assert forest.nearest(a, "q", "v", b.limit(0), "b", "v", 2).count() == 0
    assert forest.nearest(a.limit(0), "q", "v", b, "b", "v", 2).count() == 0


# --- listings ---


@pytest.mark.parametrize(
    "text,kind,expected",
    [
        ("BABACAIX JBE 125 MG /5ML 150 ML X 2", "mililitros", (25.0, 150.0, 2)),
        ("Babacaix 125Mg 5Ml Jbe. 0.15 L Paq. 2 Piezas", "mililitros", (25.0, 150.0, 2)),
        ("babacaix 25 mg/ml jarabe frasco 150 ml, duo 2 cajas", "mililitros", (25.0, 150.0, 2)),
        ("GTS 5 ML 2 MG /ML", "mililitros", (2.0, 5.0, 1)),
        ("0.2% sol oft fco. con 5 ml", "mililitros", (2.0, 5.0, 1)),
        ("CREM 0.5 % 20 G", "gramos", (5.0, 20.0, 1)),
        ("5 mg/g cra tubo con 20 gramos", "gramos", (5.0, 20.0, 1)),
        ("GRAG. 25 MG  21 ANT", "piezas", (25.0, 21.0, 1)),
        ("GRAG 21 0.025 g c/21", "piezas", (25.0, 21.0, 1)),
        ("5000 mcg con 28 grageas 2x1 caja doble", "piezas", (5.0, 28.0, 2)),
        ("S.INY AMP 6 2 MG", "piezas", (2.0, 6.0, 1)),
        ("Sol Iny C/6 Fco Amp 2 mg", "piezas", (2.0, 6.0, 1)),
        ("SUSP 500 MG 60 ML", "mililitros", (None, 60.0, 1)),
        ("", "piezas", (None, None, 1)),
        # Packs of any number, wherever they stand; the number of an open phrase is the content where no other is.
        ("3 PACK FOO 500 MG 20 TABLETAS", "piezas", (500.0, 20.0, 3)),
        ("FOO 500 MG 2 CAJAS CON 20 TABLETAS", "piezas", (500.0, 20.0, 2)),
        ("PAQUETE TRIPLE FOO 500 MG 20 TABLETAS", "piezas", (500.0, 20.0, 3)),
        ("FOO 500 MG 20 TABLETAS TRIPLE PACK", "piezas", (500.0, 20.0, 3)),
        ("FOO 500 MG X 20 TABLETAS", "piezas", (500.0, 20.0, 1)),
        ("FOO 500 MG PAQUETE CON 20 PIEZAS", "piezas", (500.0, 20.0, 1)),
        ("FOO DOBLE ACCION 500 MG 20 TABLETAS", "piezas", (500.0, 20.0, 1)),
        ("FOO 1 % GEL 40 G 12 CAJAS", "gramos", (10.0, 40.0, 12)),
        ("FOO COMPRIMIDOS 500 MG 20", "piezas", (500.0, 20.0, 1)),
        ("FOO OVULOS 500 MG 10", "piezas", (500.0, 10.0, 1)),
    ],
)
def test_attributes(text, kind, expected):
    assert listings.attributes(listings.plain(text), kind) == expected


@pytest.mark.parametrize("text,kind", [("JBE 50 MG /5ML 240 ML", "mililitros"), ("GEL 60 G 5 %", "gramos"), ("TABL 1 G 20", "piezas"), ("S.INY AMP 5 75 MG", "piezas"), ("", "piezas")])
def test_content_kind(text, kind):
    assert listings.content_kind(text) == kind


_CATALOGUE = "clave string, texto string, marca string, laboratorio string, molecula string, forma string"


def test_listings(spark):
    sold = [
        ("p1", "OFERTA Boponoin 0.5% crema 20 g"), ("p2", "boponoin al 5 mg/g crema tubo con 20 gramos (lumobufeno)"), ("p3", "BOONOIN crema 0.5 % 20 g oferta"),
        ("p4", "Boponoin 0.5% crema 40 g"), ("p5", "Nuevamarca 10 mg 20 crema"), ("p6", "oferta Nuevamarca 1 % crema 40 g"), ("p61", "Nuevamarca crema 40 g 10 mg/g oferta"), ("p7", "sin nada"), ("p8", None),
        (None, "Boponoin 0.5% crema 20 g"), ("p1", "OFERTA Boponoin 0.5% crema 20 g"), ("p9", "x" * 20000),
    ]
    known = [("1", "BOPONOIN TEP CREM 0.5 % 20 G", "BOPONOIN TEP", "TEPUIX", "LUMOBUFENO", "06"), ("2", "BOPONOIN. CREM. 0.5 %  20 G ANT", "BOPONOIN.", None, None, "06"), ("3", "BOPONOIN CREM 20 G 0.5 % X 2", "BOPONOIN", "TEPUIX", None, "06"), ("4", None, None, None, None, None)]
    a = spark.createDataFrame(sold, "clave string, texto string").withColumn("marca", F.lit("clash"))
    b = spark.createDataFrame(known, _CATALOGUE)
    found = listings.products(a, b)
    same = {"1", "2", "p1", "p2", "p3"}
    expected = {(x, y) for x in same for y in same if x < y} | {("p6", "p61")}
    assert {tuple(r) for r in listings.pairs(found).collect()} == expected
    # Records without a brand or with attributes unsaid stay, alone.
    assert {r.clave: r.producto for r in listings.groups(found).collect()} == {k: "1" for k in same} | {k: k for k in ("3", "p4", "p5", "p7", "p9")} | {"p6": "p6", "p61": "p6"}
    assert listings.pairs(listings.products(a.limit(0), b.limit(0))).count() == 0


def test_forms_are_learned_and_unknown_ones_merge_nothing(spark):
    known = [(f"c{i}", f"BR{w} TABL {100 + i} MG 20", f"BR{w}", None, None, "01") for i, w in enumerate(("ANDA", "ENDA", "INDA", "ONDA"))]
    # COMPRIMIDOS is no abbreviation of the catalogue's word; four brands show that it goes with its form.
    sold = [(f"k{i}", f"Br{w} comprimidos {100 + i} mg 20 piezas") for i, w in enumerate(("anda", "enda", "inda", "onda"))]
    sold += [("t1", "Branda tabletas 500 mg c/20"), ("t2", "Branda 20 tabs 500 mg"), ("o1", "Branda ovulos 500 mg 20"), ("o2", "BRANDA 20 OVULOS, 500 MG oferta"), ("o3", "oferta Branda 500 mg 20 óvulos"), ("u1", "Branda 500 mg"), ("u2", "Branda 500 mg lata")]
    a, b = spark.createDataFrame(sold, "clave string, texto string"), spark.createDataFrame(known, _CATALOGUE)
    group = {r.clave: r.producto for r in listings.groups(listings.products(a, b)).collect()}
    assert all(group[f"k{i}"] == group[f"c{i}"] for i in range(4))
    assert group["t1"] == group["t2"] != group["o1"]
    # Of an unknown form only records of the same words and numbers are one product.
    assert group["o2"] == group["o3"] != group["o1"] and len({group["o1"], group["u1"], group["u2"], group["t1"]}) == 4


def test_shards_find_the_same_phrases(spark):
    texts = spark.createDataFrame([(str(i), f"X{chr(65 + i)} UNO DOS") for i in range(20)] + [("n", "")], "clave string, texto string")
    phrases = spark.createDataFrame([(f"X{chr(65 + i)}",) for i in range(20)] + [("UNO DOS",), ("NO DOS",)], "frase string")
    rows = lambda rules: sorted(map(tuple, listings.find_phrases(texts, phrases, rules).collect()))
    assert rows(listings.ListingRules()) == rows(listings.ListingRules(shard=5, block=4))
    assert len(rows(listings.ListingRules())) == 40


def test_brands_mined_or_of_several_words_are_repaired(spark):
    sold = [
        ("p1", "Nuevamarca 10 mg 20 tabletas"), ("p2", "Nuevamarca 10 mg c/20 tab"), ("p3", "Nuevamrca 10 mg 20 tabs"),
        ("p4", "Gran Boponoin crema 0.5 % 20 g"), ("p5", "Gran Boponin crema 0.5 % 20 g"), ("p6", "Gran otro Boponin crema 0.5 % 20 g"),
    ]
    # One known text in ten or more names the brand of others.
    sold += [(f"r{i}", f"Raramarca {i} mg 30 tabletas") for i in range(10)] + [("r", "Gran Boponoin crema 0.5 % 40 g no Raramarca")]
    sold += [(f"t{i}", f"Gran Boponoin {i} mg 20 tabletas") for i in (1, 2)]
    a = spark.createDataFrame(sold, "clave string, texto string")
    b = spark.createDataFrame([("1", "GRAN BOPONOIN CREM 0.5 % 20 G", "GRAN BOPONOIN", None, None, "06")], _CATALOGUE)
    got = {r.clave: r.marca for r in listings.products(a, b).collect()}
    brands = {"1": "GRAN BOPONOIN", "r": "GRAN BOPONOIN", "p4": "GRAN BOPONOIN", "p5": "GRAN BOPONOIN"} | {f"p{i}": "NUEVAMARCA" for i in (1, 2, 3)} | {"t1": "GRAN BOPONOIN", "t2": "GRAN BOPONOIN", "p6": None}
    assert got == brands | {f"r{i}": "RARAMARCA" for i in range(10)}


# --- subjects ---

_WORDS = {"mar": "ola playa arena barco vela puerto marea faro".split(), "pan": "horno harina masa levadura corteza miga trigo horneado".split(), "sol": "rayo calor verano luz brillo sombra mediodia nube".split()}


def _documents(n, seed):
    rng = np.random.default_rng(seed)
    rows, truth = [], {}
    for i in range(n):
        subjects = list(rng.choice(list(_WORDS), rng.choice([0, 1, 1, 1, 2]), replace=False))
        parts = ["Gracias por escribir con gusto respondemos", "Este aviso sustituye al anterior"][: rng.integers(1, 3)]
        for s in subjects:
            parts += [f"Se habla de {a} y también de {b}" for a, b in (rng.choice(_WORDS[s], 2, replace=False) for _ in range(3))]
        rng.shuffle(parts)
        rows.append((i, ". ".join(parts) + "."))
        truth[i] = set(subjects)
    return rows, truth


def test_topics_on_held_out_documents(spark):
    rows, truth = _documents(900, 3)
    labels = [(i, s, "x") for i in range(150) for s in (truth[i] or {None})] + [(10**6, "mar", "x"), (5, "desconocido", "x")]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows] + [(-1, None, "k"), (-2, "", "k"), (-3, " 123 ", "k"), (None, "mar", "k")], "doc long, t string, k string")
    subjects = spark.createDataFrame([(s, f"Tema de {s}") for s in _WORDS], "tema string, nombre string")
    found = topics.assign_topics(docs, "doc", "t", spark.createDataFrame(labels, "doc long, tema string, n string"), "tema", subjects)
    got = collections.defaultdict(set)
    for r in found.collect():
        got[r.doc].add(r.tema)
    right = sum(got[i] == truth[i] for i in range(150, 900)) / 750
    assert right >= 0.95 and not set(got) & {-1, -2, -3, None}


def test_topics_without_labels_or_documents(spark):
    subjects = spark.createDataFrame([("mar", "playa y olas"), ("pan", "harina y horno")], "tema string, nombre string")
    docs = spark.createDataFrame([(1, "playa y olas de playa"), (2, "harina y horno con harina")], "doc long, t string")
    labels = spark.createDataFrame([], "doc long, tema string")
    assert {tuple(r) for r in topics.assign_topics(docs, "doc", "t", labels, "tema", subjects).select("doc", "tema").collect()} >= {(1, "mar"), (2, "pan")}
    assert topics.assign_topics(docs.limit(0), "doc", "t", labels, "tema", subjects).count() == 0
    assert topics.assign_topics(docs, "doc", "t", labels, "tema", subjects.limit(0)).count() == 0


def test_few_labels_calibrate_too():
    share, told = np.tile([0.05, 0.1, 0.15, 0.3], 10), np.tile([False, True, True, True], 10)
    w = topics._calibrate(share, np.full(40, 0.5), told)
    assert 1 / (1 + np.exp(-topics._evidence(np.array([0.15]), np.array([0.5])) @ w))[0] > 0.5
    start = topics.TopicRules.towards
    assert tuple(topics._calibrate(share[:0], share[:0], told[:0])) == start and tuple(topics._calibrate(share, share, told | True)) == start


def _plain_sentences(text):
    """Words of each sentence, character by character: what ``read_texts`` does in arrays."""
    text = topics.bare_text(text)
    text = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c))
    text = re.sub(r"(?<=[^\W\d])\d+(?=[^\W\d])", "", re.sub(r"[^\w\s.!?]|_", "", text))
    return [words for part in re.split(r"[.!?]+(?=\s|$)", text) if (words := re.findall(r"[^\W\d_]{2,}", part))]


def _shape(words):
    return len(dict.fromkeys(words)) + len(set(zip(words, words[1:])))


def test_texts_are_read_as_by_plain_means():
    texts = [
        "AtendiÃ³ bien. revi👩‍⚕️sado<br/>r <p>Hola</p> cabe000llo\\n.", "  . ! 12", "", "Uno dos. Uno dos uno! tres?? cuatro...cinco a b", "x" * 3000 + " fin", "ÑANDÚ niño. \u0000 tab\tlado\u00a0otro", "mg20 20mg a1b2c3 1a", "sin_guion &amp; más &lt;b&gt;",
        *[row[1] for row in _documents(40, 6)[0]],
    ]
    read = topics.read_texts(texts, 1 << 30)
    want = [_plain_sentences(t) for t in texts]
    assert want[0] == [["atendio", "bien"], ["revisador", "hola", "cabello"]]
    assert read.sentences.tolist() == [len(s) for s in want]
    assert read.lengths.tolist() == [_shape(words) for s in want for words in s]
    # The same words have the same features wherever they stand; other words others.
    one, two = topics.read_texts(["Hola mundo."], 1 << 30), topics.read_texts(["algo. HOLA mundo! x", "mundo hola"], 1 << 30)
    assert set(one.features) == set(two.features[1:4]) != set(two.features[4:])
    none = topics.read_texts([], 1 << 18)
    assert len(none.features) == len(none.sentences) == 0


def test_chunks_and_joined_labels_change_nothing(spark):
    rows, truth = _documents(200, 5)
    labels = spark.createDataFrame([(i, s) for i in range(100) for s in (truth[i] or {None})], "doc long, tema string")
    docs, subjects = spark.createDataFrame(rows, "doc long, t string"), spark.createDataFrame([(s, f"Tema de {s}") for s in _WORDS], "tema string, nombre string")
    run = lambda **more: {(r.doc, r.tema) for r in topics.assign_topics(docs, "doc", "t", labels, "tema", subjects, topics.TopicRules(features=1 << 14, **more)).collect()}
    assert run() == run(chunk=500) == run(sent=10)


def test_slips_of_annotators_do_not_move_the_threshold():
    rng = np.random.default_rng(2)
    share = np.r_[rng.uniform(0, 0.05, 1000), rng.uniform(0.3, 0.5, 300)]
    told = share > 0.2
    told[rng.choice(np.flatnonzero(told), 60, replace=False)] = False
    told[rng.choice(np.flatnonzero(share < 0.1), 20, replace=False)] = True
    w = topics._calibrate(share, np.ones(1300), told)
    at = lambda s: 1 / (1 + np.exp(-topics._evidence(np.array([s]), np.array([1.0])) @ w))[0]
    assert at(0.05) < 0.1 and at(0.32) > 0.6
