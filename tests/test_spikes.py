"""Spikes, stuck values and impossible readings on cases written out by hand."""

import datetime as dt

import numpy as np
import pytest

from criba.operators.spikes import SpikeRules, flag_spikes, reasons

DAYS = np.array([(dt.date(2024 + m // 12, m % 12 + 1, 1) - dt.date(1970, 1, 1)).days for m in range(30)])


def _walk(seed=0, sigma=0.01, n=30, level=100.0):
    rng = np.random.default_rng(seed)
    return np.round(level * np.exp(rng.normal(0, sigma, n)), 2)


def _flags(values, **rules):
    return dict(enumerate(reasons(DAYS[: len(values)], np.asarray(values, float), SpikeRules(**rules))))


def _found(values):
    return {i: w for i, w in _flags(values).items() if w}


def test_quiet_source_has_no_cases():
    assert _found(_walk()) == {}


@pytest.mark.parametrize("value", [0, -12.5, 0.01, 99999, 1234567.89, 100 * 250])
def test_impossible(value):
    v = _walk()
    v[7] = value
    assert _found(v) == {7: "imposible"}


@pytest.mark.parametrize("factor", [0.6, 1.5, 3.0, 0.1])
def test_one_and_two_readings_that_return(factor):
    v = _walk()
    v[10] *= factor
    v[20:22] *= factor
    assert _found(v) == {10: "pico", 20: "pico", 21: "pico"}


def test_three_readings_and_lasting_levels_are_none():
    v = _walk()
    v[10:13] *= 1.6
    v[20:] *= 0.7
    assert _found(v) == {}


def test_noise_of_a_restless_source_is_none():
    for seed in range(20):
        assert _found(_walk(seed, 0.06)) == {}


def test_regular_dips_are_none_but_a_deeper_one_is():
    v = _walk()
    v[2::6] *= 0.85
    assert _found(v) == {}
    v[11] *= 0.4
    assert _found(v) == {11: "pico"}


def test_stuck_run_in_a_moving_source():
    v = _walk()
    v[8:15] = v[8]
    assert _found(v) == {i: "atascado" for i in range(9, 15)}
    v = _walk()
    v[8:13] = v[8]
    assert _found(v) == {}


def test_steps_of_a_standing_price_are_none_but_a_pulse_is():
    v = np.repeat([50.0, 55.0, 61.0], 10)
    assert _found(v) == {}
    v[14] = 20.0
    assert _found(v) == {14: "pico"}


def test_short_and_empty_sources():
    assert set(_flags([5.0]).values()) == {""}
    assert list(reasons(np.array([], int), np.array([]), SpikeRules())) == []


def test_operator_edge_cases(spark):
    v = _walk()
    v[10] *= 3
    day = lambda i: dt.date(1970, 1, 1) + dt.timedelta(days=int(DAYS[i]))
    rows = [("a", 1, day(i), float(x), "extra") for i, x in enumerate(v)]
    rows += rows[:5]  # repeated rows
    rows += [("a", 1, None, 5.0, "x"), ("a", 1, day(3), None, "x"), (None, None, day(4), -1.0, "x")]
    df = spark.createDataFrame(rows, "s string, d bigint, b date, v double, motivo string")
    found = {tuple(r) for r in flag_spikes(df, ["s", "d"], "b", "v").select("s", "d", "b", "motivo").collect()}
    assert found == {("a", 1, day(10), "pico"), (None, None, day(4), "imposible")}
    assert flag_spikes(df.limit(0), ["s", "d"], "b", "v").count() == 0


def test_blocks_of_time_give_the_same_cases(spark):
    """A long source cut into blocks is judged as in one piece, apart from its regular dips."""
    months = 360
    days = [dt.date(1990 + m // 12, m % 12 + 1, 1) for m in range(months)]
    v = np.round(100 * np.exp(np.random.default_rng(5).normal(0, 0.01, months)), 2)
    for i in (3, 119, 120, 121 + 60, 240, 241, 358):
        v[i] *= 2
    v[200:212] = v[200]
    df = spark.createDataFrame([("a", d, float(x)) for d, x in zip(days, v)], "s string, t date, v double")
    whole = {tuple(r) for r in flag_spikes(df, ["s"], "t", "v", SpikeRules(block_days=100_000)).collect()}
    cut = {tuple(r) for r in flag_spikes(df, ["s"], "t", "v", SpikeRules(block_days=1_500, halo_days=400)).collect()}
    assert whole == cut and len(whole) > 15
    # A source of many readings gets narrower blocks; others, a null one too, keep theirs.
    few = df.limit(0).unionByName(spark.createDataFrame([(s, d, x) for s in ("b", None) for d, x in zip(days[:12], [10.0] * 5 + [-1.0] + [10.0] * 6)], df.schema))
    dense = {tuple(r) for r in flag_spikes(df.unionByName(few), ["s"], "t", "v", SpikeRules(block_rows=100)).collect()}
    assert dense == whole | {(s, days[5], -1.0, "imposible") for s in ("b", None)}


def test_a_run_that_covers_most_of_a_series_is_stuck():
    moving = [10.0, 10.3, 9.9, 10.2, 10.1, 9.8, 10.4]
    for before in (3, 7):
        values = moving[:before] + [10.15] * 17 + moving[before:]
        found = reasons(np.arange(24) * 30, np.array(values), SpikeRules())
        assert list(np.flatnonzero(found == "atascado")) == list(range(before + 1, before + 17))
    # Steps alone, each held long, are no movement.
    steps = np.repeat([10.0, 10.3, 10.6, 11.0, 11.4, 11.8, 12.1], 7)
    assert not (reasons(np.arange(49) * 30, steps, SpikeRules()) == "atascado").any()
