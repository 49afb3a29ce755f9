"""Relational, robust, matching, panel, state and quality operators against plain computations."""

import datetime as dt
import itertools
import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from criba.operators import matching, panel, quality, relational, robust, state

M = dt.date(2026, 1, 1)


def test_robust_goldens(spark):
    product_a = [210, 155, 181, 192, 185, 173.5, 199, 187]
    product_b = [217, 124, 115, 116.45, 113, 137, 119.90, 133, 128.5, 217]
    rows = [("a", i, float(v)) for i, v in enumerate(product_a)] + [("b", i, float(v)) for i, v in enumerate(product_b)] + [("c", 0, 5.0), ("c", 1, None), ("c", 2, -1.0)]
    df = spark.createDataFrame(rows, "p string, t int, v double")
    scored = robust.robust_scores(df, ["p"], "v").collect()
    got = {(r.p, r.t): r for r in scored}
    assert not any(got["a", i].atipico for i in range(8)) and got["a", 1].mediana == 186 and round(got["a", 1].pct, 4) == -0.1667
    assert [i for i in range(10) if got["b", i].atipico] == [0, 9] and got["b", 1].mediana == pytest.approx(121.95)
    assert (got["c", 0].z, got["c", 0].mediana) == (None, None) and len(scored) == 19


def test_robust_fallbacks(spark):
    df = spark.createDataFrame([("m", float(v)) for v in (10, 10, 10, 10, 20)] + [("s", 7.0)] * 5, "p string, v double")
    got = robust.robust_scores(df, ["p"], "v").collect()
    x = math.log(20) - math.log(10)
    assert max(r.z for r in got if r.p == "m") == pytest.approx(x / (1.2533 * x / 5)) and {r.z for r in got if r.p == "s"} == {0.0}


def test_summary(spark):
    v = [210, 155, 181, 192, 185, 173.5, 199, 187]
    df = spark.createDataFrame([("a", f"c{i}", float(x)) for i, x in enumerate(v)] + [("b", "c0", 330.0), ("b", "c1", 367.0), ("b", "c2", None)], "p string, c string, v double")
    got = {r.p: r for r in robust.summary(df, ["p"], "v", "c").collect()}
    a, b = got["a"], got["b"]
    assert (a.p25, a.p50, a.p75, a.quien_minimo, a.quien_maximo) == (179.125, 186, 193.75, "c1", "c0")
    assert round(a.rango_rel, 4) == 0.3548 and round(a.iqr_rel, 4) == 0.0786
    assert (b.n, b.p50, b.minimo, b.quien_minimo, b.tipico) == (2, None, None, None, 348.5)


def test_mid_ranks_and_premium(spark):
    v = [1, 2, 2, 3, 5, 8]
    df = spark.createDataFrame([("g", float(x), i < 3) for i, x in enumerate(v)] + [("h", 1.0, True), ("h", None, True)], "g string, v double, r boolean")
    got = robust.mid_ranks(df, ["g"], "v").where("g = 'g'").collect()
    for r in got:
        assert r.percentil == pytest.approx(100 * (sum(x < r.v for x in v) + 0.5 * sum(x == r.v for x in v)) / 6)
    assert {r.percentil for r in robust.mid_ranks(df, ["g"], "v").where("g = 'h'").collect()} == {None}
    premium = robust.premium_over(df, ["g"], "v", F.col("r")).where("g = 'g' and v = 8").first().prima
    assert premium == pytest.approx(8 / statistics.median(v[:3]))


def test_relational(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", 2, None), ("b", None, None), ("b", None, None)], "k string, n int, s string")
    assert sorted(r.rn for r in relational.numbered_duplicates(df, ["k", "n", "s"], ["k"]).collect()) == [1, 1, 1, 2, 2]
    assert relational.first_row(df, ["k"], [F.desc_nulls_last("n"), F.col("s")]).count() == 2
    assert {tuple(r) for r in relational.first_values(df, ["k"], ["n"], ["n", "s"]).collect()} == {("a", 1), ("b", None)}
    assert [r.varios for r in relational.several_values(df, ["k"], "n", "varios").orderBy("k").collect()] == [True, True, True, False, False]
    good, bad = relational.split_by_reason(df, relational.first_reason(("SIN_N", F.col("n").isNull()), ("SIN_S", F.col("s").isNull())))
    assert good.count() == 2 and sorted(r.motivo_descarte for r in bad.collect()) == ["SIN_N", "SIN_N", "SIN_S"]
    other = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert sorted(r.hay for r in relational.flagged_presence(df, other, ["k"], "hay").collect()) == [False, False, True, True, True]
    assert relational.pending(df, other, ["k"]).count() == 2
    assert relational.previous_month(spark.createDataFrame([("a", dt.date(2026, 1, 1), 1.0), ("a", dt.date(2026, 3, 1), 2.0), ("a", dt.date(2026, 4, 1), 3.0)], "k string, m date, v double"), ["k"], "m", "v", "antes").orderBy("m").select("antes").collect()[2][0] == 2.0
    d = spark.createDataFrame([("q", 0.1, "b"), ("q", 0.1, "a"), ("q", 0.4, "c")], "q string, d double, t string")
    assert [(r.lugar, r.margen and round(r.margen, 3)) for r in relational.margin_to_next(d, ["q"], "d", "t").orderBy("lugar").collect()] == [(1, 0.0), (2, 0.3), (3, None)]


def test_runs_and_grid(spark):
    df = spark.createDataFrame([("u", i, c) for i, c in enumerate("eeoeeeo")], "u string, t int, c string")
    got = relational.runs(df, ["u"], ["t"], F.col("c") == "e").where("valor").orderBy("inicio").collect()
    assert [(r.inicio, r.fin, r.largo) for r in got] == [(0, 1, 2), (3, 5, 3)]
    seen = spark.createDataFrame([("p", "A", 1), ("q", "A", 1), ("q", "B", 2)], "p string, s string, m int")
    states = {(r.p, r.s, r.m): r.estado for r in relational.presence_grid(seen, seen, spark.createDataFrame([("A",), ("B",), ("C",)], "s string"), seen, "p", "s", "m").collect()}
    assert len(states) == 12 and states["p", "A", 1] == "Detectado" and states["p", "B", 2] == "No detectado" and states["p", "C", 1] == "Cadena sin captura"


def test_sample_is_stable(spark):
    df = spark.createDataFrame([(i % 3, f"k{i}") for i in range(60)] + [(9, "solo")], "s int, k string")
    first = {tuple(r) for r in relational.stratified_sample(df, ["s"], "k", 4, 7, 2).collect()}
    assert first == {tuple(r) for r in relational.stratified_sample(df.repartition(5), ["s"], "k", 4, 7, 2).collect()} and len(first) == 12


def test_crosswalk_and_cross_store(spark):
    items = spark.createDataFrame([("p1", "c1"), ("p2", "c2"), ("p3", "c3")], "p string, c string")
    table = spark.createDataFrame([("c1", "n1"), ("c1", "n1"), ("c2", "n1"), ("c2", "n2"), ("c3", "n9")], "code string, n string")
    valid = spark.createDataFrame([("n1",), ("n2",)], "n string")
    assert [tuple(r) for r in matching.crosswalk(items, ["p"], "c", table, "code", "n", valid).collect()] == [("p1", "n1")]
    rows = [("a", 1, "7501234567890", "n1"), ("b", 2, "7501234567890", None), ("c", 1, "7501234567890", None), ("d", 3, "750123456789", None), ("e", 3, "12345", None), ("f", 2, "99999999", "n2"), ("g", 3, "99999999", None), ("h", 1, "99999999", "n3")]
    found = {r.p: (r.n, r.regla) for r in matching.cross_store(spark.createDataFrame(rows, "p string, s int, k string, n string"), "p", "s", "k", "n").collect()}
    assert found == {"b": ("n1", 1), "d": ("n1", 2)}


def test_exact_neighbours(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(40, 8))
    df = spark.createDataFrame([(str(i), x.tolist()) for i, x in enumerate(v)] + [("z", [0.0] * 8), ("n", None)], "id string, v array<double>")
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    expected = {(str(i), str(j)) for i, row in enumerate(1 - unit @ unit.T) for j in np.argsort(row)[1:4]}
    got = matching.exact_neighbours(df.withColumnRenamed("id", "q"), "q", df, "id", "v", 3, skip_self=True).collect()
    assert {(r.q, r.id) for r in got} == expected


def test_decision(spark):
    rows = [(0.05, 0.1, True, True, "match"), (0.05, None, True, True, "cuarentena"), (0.05, 0.1, False, True, "cuarentena"), (0.09, 0.1, True, None, "sin_match"), (0.2, 0.1, True, True, "sin_match"), (None, None, None, None, "sin_match")]
    df = spark.createDataFrame(rows, "d double, m double, g boolean, f boolean, e string")
    ruled = matching.decision(F.col("d"), F.col("m"), F.col("g"), F.col("f"), 0.1, 0.04, 0.02)
    assert all(r.x == r.e for r in df.select("e", ruled.alias("x")).collect())


def test_threshold_sweep(spark):
    rows = [(0.0, True), (0.004, True), (0.005, False), (0.0051, True), (0.19, True), (0.9, False)]
    swept = {r.tau: r for r in matching.threshold_sweep(spark.createDataFrame([("g", *r) for r in rows], "g string, d double, ok boolean"), ["g"], "d", "ok").collect()}
    for tau, r in swept.items():
        inside = [ok for d, ok in rows if d <= tau + 1e-9]
        assert (r.aceptados, r.aciertos, r.volumen) == (len(inside), sum(inside), len(inside) / 6)
    assert len(swept) == 41


def test_phrase_reach_of_long_phrases(spark):
    long = "UNO DOS TRES CUATRO CINCO SEIS SIETE OCHO NUEVE"
    phrases = spark.createDataFrame([(long,), (long.replace("NUEVE", "DIEZ"),), ("DOS",), ("",), (None,)], "f string")
    texts = spark.createDataFrame([(f"CERO {long} DIEZ",), (long,), ("DOS",)], "t string")
    got = {r.f: (r.textos, r.alcanzable) for r in matching.phrase_reach(phrases, "f", texts, "t").collect()}
    assert got[long] == (2, True) and got[long.replace("NUEVE", "DIEZ")] == (0, False) and got["DOS"] == (3, True)


def test_phrase_reach_words_vectors(spark):
    phrases = spark.createDataFrame([("UNO DOS",), ("DOS TRES CUATRO",), ("NADA",)], "f string")
    texts = spark.createDataFrame([("x uno, dos tres",), ("UNO DOS uno dos",)], "t string").select(F.upper("t").alias("t"))
    assert {(r.f, r.textos) for r in matching.phrase_reach(phrases, "f", texts, "t").collect()} == {("UNO DOS", 2), ("DOS TRES CUATRO", 0), ("NADA", 0)}
    df = spark.createDataFrame([(["a"], ["b", "a"]), (["a", "c"], ["a"]), ([], [])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(matching.words_covered(F.col("a"), F.col("b"))).collect()] == [True, False, True]
    v = {r.k: r.embedding for r in matching.hashed_vectors(spark.createDataFrame([("a", "uno"), ("b", "UNO"), ("c", " "), ("d", None)], "k string, t string"), "k", "t").collect()}
    assert v["a"] == v["b"] and v["c"] is None and v["d"] is None and np.linalg.norm(v["a"]) == pytest.approx(1)


def _simulated():
    rng = np.random.default_rng(9)
    chains, months = (0.10, -0.10, 0.05, -0.05, 0.02, -0.02), (-0.03, -0.01, 0.0, 0.04)
    rows = []
    for p, c, m in itertools.product(range(40), range(6), range(4)):
        if rng.random() > 0.2:
            rows.append((dt.date(2026, m + 1, 1), f"p{p}", f"c{c}", float(np.exp(3 + p / 20 + chains[c] + months[m] + rng.normal(0, 0.01)))))
    return rows, chains, months


def test_panel_recovers_effects(spark):
    rows, chains, months = _simulated()
    df = spark.createDataFrame(rows + [(dt.date(2026, 1, 1), "lonely", "c0", 5.0), (dt.date(2026, 1, 1), "p0", "c0", None)], "m date, p string, c string, v double")
    got = panel.chain_effects(df, "m", "p", "c", "v").collect()
    for m in range(4):
        found = {r.c: r for r in got if r.m.month == m + 1}
        assert abs(sum(r.beta for r in found.values())) < 1e-9
        for c, e in enumerate(chains):
            r = found[f"c{c}"]
            assert abs(r.beta - e) < 0.01 and r.ic_bajo < r.nivel < r.ic_alto and r.se < 0.005
    index = {r.m.month: r for r in panel.month_index(df, "m", ["p", "c"], "v", "2026-03-01").collect()}
    for m, e in enumerate(months):
        assert abs(index[m + 1].delta - e) < 0.01
    assert index[3].indice == 100 and index[1].variacion is None and index[4].variacion == pytest.approx(index[4].indice / 100 - 1)


def test_panel_matches_dense_least_squares(spark):
    rows, *_ = _simulated()
    first = [r for r in rows if r[0].month == 1]
    items, chains = sorted({r[1] for r in first}), sorted({r[2] for r in first})
    x = np.zeros((len(first), len(items) + len(chains) - 1))
    for i, (_, p, c, _) in enumerate(first):
        x[i, items.index(p)] = 1
        j = chains.index(c)
        if j < len(chains) - 1:
            x[i, len(items) + j] = 1
        else:
            x[i, len(items):] = -1
    y = np.log([r[3] for r in first])
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    sigma = ((y - x @ beta) ** 2).sum() / (len(y) - x.shape[1])
    se = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * sigma)[len(items):]
    got = {r.c: r for r in panel.chain_effects(spark.createDataFrame(first, "m date, p string, c string, v double"), "m", "p", "c", "v").collect()}
    for j, c in enumerate(chains[:-1]):
        assert got[c].beta == pytest.approx(beta[len(items) + j], abs=1e-9) and got[c].se == pytest.approx(se[j], rel=1e-6)


def test_disconnected_months_have_no_effects(spark):
    rows = [(M, p, c, 1.0 + i) for i, (p, c) in enumerate([("p", "a"), ("p", "b"), ("q", "x"), ("q", "y")])]
    assert all(r.beta is None for r in panel.chain_effects(spark.createDataFrame(rows, "m date, p string, c string, v double"), "m", "p", "c", "v").collect())


def test_upsert_and_versions(spark, tmp_path):
    held = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    changes = spark.createDataFrame([("b", 3, "x"), ("c", 4, "y")], "k string, v int, extra string")
    assert {tuple(r) for r in state.upsert(held, changes, ["k"]).collect()} == {("a", 1, None), ("b", 3, "x"), ("c", 4, "y")}
    assert {r.k for r in state.changed_rows(held, spark.createDataFrame([("a", 1), ("b", 9), ("d", None)], "k string, v int"), ["k"], "v").collect()} == {"b", "d"}
    assert state.without_orphans(held, changes, ["k"]).count() == 1
    table = state.VersionedTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    table.merge(held, ["k"])
    table.merge(changes, ["k"])
    table.merge(changes, ["k"])
    assert table.read().count() == 3
    versions = lambda: [p for p in (tmp_path / "t").iterdir() if p.name.startswith("v-")]
    assert len(versions()) == 2 and not list((tmp_path / "t").glob(".after-*"))
    # A writer that read a former version is refused and leaves the table as it is.
    seen = table._pointed()
    table.replace(held)
    with pytest.raises(state.StaleVersionError):
        table._publish(changes, (), seen)
    assert table.read().count() == 2 and len(versions()) == 2


def test_duplicates_are_numbered_across_shares(spark):
    rows = [("x", f, i) for f in ("a", "b", "c", None) for i in range(5)] + [(None, "a", 1), (None, "b", 1), ("y", "a", 9)]
    df = spark.createDataFrame(rows, "v string, f string, i int")
    got = {(r.v, r.f, r.i): r.rn for r in relational.numbered_duplicates(df, ["v"], ["f", "i"]).collect()}
    order = sorted((r for r in rows if r[0] == "x"), key=lambda r: (r[1] is not None, r[1] or "", r[2]))
    assert [got[r] for r in order] == list(range(1, 21))
    assert (got[(None, "a", 1)], got[(None, "b", 1)], got[("y", "a", 9)]) == (1, 2, 1)


def test_load_decisions(spark):
    manifest = spark.createDataFrame([("same", 1, "m", "OK", True, 5), ("diff", 2, "old", "OK", True, 5), ("err", 1, "m", "ERROR", False, 5), ("nob", 3, "m", "OK", False, 5), ("empty", 1, "m", "OK", False, 0), ("same", 0, "z", "ERROR", False, 1)], "ruta_origen string, version bigint, md5 string, estado string, con_bronce boolean, filas bigint")
    files = spark.createDataFrame([(f, "m", 0 if f == "empty" else 5) for f in ("new", "same", "diff", "err", "nob", "empty")], "ruta_origen string, md5 string, filas bigint")
    got = {r.ruta_origen: (r.accion, r.version) for r in state.load_decisions(files, manifest).collect()}
    assert got == {"new": ("cargar", 1), "same": ("omitir", 1), "diff": ("cargar", 3), "err": ("cargar", 2), "nob": ("cargar", 4), "empty": ("omitir", 1)}
    assert {(r.estado, r.archivos) for r in state.manifest_summary(manifest, []).collect()} == {("OK", 4), ("ERROR", 1)}


def test_quality(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 5, None), (None, None, "z")], "k string, n int, s string")
    parent = spark.createDataFrame([("a",)], "id string")
    rows = quality.run_row_tests(df, "t", [quality.not_null("k"), quality.accepted_values("s", ("x",)), quality.accepted_range("n", 2, 4), quality.expression_is_true("e", F.col("n") < 5), quality.not_null("s", where=F.col("k").isNotNull())])
    told = {(r.prueba, r.fallas) for r in quality.report(rows, quality.unique(df, "t", ["k"]), quality.relationship(df, "t", "s", parent, "id"), quality.equal_row_count(df, parent, "t")).collect()}
    assert told == {("not_null_k", 1), ("accepted_values_s", 1), ("accepted_range_n", 2), ("expression_e", 1), ("not_null_s", 1), ("unique_k", 1), ("relationship_s", 2), ("equal_rowcount", 2)}
    with pytest.raises(ValueError, match="not_null_k"):
        quality.enforce(rows)
    days = spark.createDataFrame([(dt.date(2026, 1, 1),), (dt.date(2026, 1, 3),)], "d date")
    assert quality.missing_days(days, "d", "t").first().fallas == 1
    assert quality.conserved(df, [df.where("k = 'a'"), df.where("k is null")], "t").first().fallas == 0
