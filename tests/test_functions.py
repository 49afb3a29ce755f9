"""Goldens of parsers and text functions."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from criba.functions import calendar, dates, keys, magnitudes, prices, stats, stores, text


def apply(spark, values, *columns, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_dates(spark):
    good = {
        "2025-12-09 18:37:43": "2025-12-09 18:37:43", "2026-02-05": "2026-02-05 00:00:00", "21/12/2025 21:45": "2025-12-21 21:45:00",
        "05/02/26 13:41": "2026-02-05 13:41:00", "06/03/26 2:32": "2026-03-06 02:32:00", "07/02/26": "2026-02-07 00:00:00",
        "08/03/26": "2026-03-08 00:00:00", " 8/3/26 ": "2026-03-08 00:00:00", "29/02/24": "2024-02-29 00:00:00", "01/01/75": "1975-01-01 00:00:00",
    }
    bad = ["", "  ", "sin fecha", "2026-13-45", "05-02-2026", "1738771200", "29/02/25", "31/12/2025", "2026-02-05 10:00", "2025-08-09T11:24:00Z", "0000-00-00 00:00:00", None]
    found = apply(spark, [*good, *bad], F.date_format(dates.parse_date("x"), "yyyy-MM-dd HH:mm:ss"))
    assert [f[0] for f in found] == [*good.values(), *[None] * len(bad)]


def test_prices(spark):
    cases = {
        "41.90": ("41.90", None), "$1787.00": ("1787.00", None), "$1,787.00": ("1787.00", None), "9,999.99": ("9999.99", None), "1.173.00": ("1173.00", None),
        "31.67..": ("31.67", None), "160.00.": ("160.00", None), "376": ("376", None), "1,118": ("1118", None), "1,118.00": ("1118.00", None), "9,99": ("9.99", None),
        "9,9": ("9.9", None), "0.00": ("0", "PRECIO_CERO"), "0": ("0", "PRECIO_CERO"), "$ 45.00 ": ("45.00", None), "1.234.567.89": ("1234567.89", None),
        **{s: (None, "PRECIO_NO_DISPONIBLE") for s in ("No disponible", "NO DISPONIBLE", "", " ", "#N/D", "N/A", "n/a ", "null")},
        **{s: (None, "PRECIO_NO_PARSEABLE") for s in ("abc", "1,2345", "$", "12.34.56.78x", "-5", "1e3", "NaN", "inf", "O12.50", "12 - 15", "978’882")},
    }
    found = apply(spark, list(cases), prices.parse_price("x"), F.try_element_at(prices.price_flags("x"), F.lit(1)), prices.price_unreadable("x"))
    for (value, flag), (text_value, expected_flag), unreadable in zip([f[:2] for f in found], cases.values(), [f[2] for f in found]):
        assert value == (None if text_value is None else Decimal(text_value)) and flag == expected_flag
        assert unreadable == (expected_flag == "PRECIO_NO_PARSEABLE")


def test_skus_urls_keys(spark):
    assert apply(spark, ["search", "SEARCH", "N/A", "n/a", "", None, "900437", " ABC-123 ", "0"], keys.parse_sku("x")) == [(None,)] * 6 + [("900437",), ("ABC-123",), ("0",)]
    assert apply(spark, ["12", None, "1" * 20], keys.padded("x")) == [("000000000000012",), (None,), ("1" * 15,)]
    assert apply(spark, ["00120", "000", "", None], keys.unpadded("x")) == [("120",), (None,), (None,), (None,)]
    urls = ["https://x/a/12345.html", "https://x/p/abc?z=1", "/rel/uno-998?q#f"]
    assert [r[0] for r in apply(spark, urls, keys.sku_from_url("x", "html"))] == ["12345", None, None]
    assert apply(spark, urls, keys.canonical_url("x", "https://s/")) == [("https://x/a/12345.html",), ("https://x/p/abc",), ("https://s/rel/uno-998",)]
    halves = {r[0] for r in apply(spark, [str(i) for i in range(50)], keys.split_half("x"))}
    assert halves == {"calibracion", "reserva"}


def test_clean_text(spark):
    cases = {"  ÁCIDO Fólico 0.5mg/5ML  ": "acido folico 0.5mg 5ml", "A.B. 1.2": "a b 1.2", "": "", "ñandú—x": "nandu x", None: None}
    assert [r[0] for r in apply(spark, list(cases), text.clean_text("x"))] == list(cases.values())


def test_tokens_ngrams_words(spark):
    assert apply(spark, ["uno dos-tres", ""], text.ngrams(text.tokens("x"), 1, 2)) == [(["UNO", "DOS", "TRES", "UNO DOS", "DOS TRES"],), ([],)]
    assert apply(spark, ["TAB. 5 MG/TAB", "", None], text.replace_words("x", {"TAB": "TABLETA"})) == [("TABLETA. 5 MG/TABLETA",), ("",), (None,)]


ATTRIBUTES = [
    ("KEFLEX 1 G ORAL 12 TABLETAS", (1000, None, 1, 12)),
    ("ELATEC 1000 MG ORAL 20 TABS", (1000, None, None, 20)),
    ("TRULICITY 0.75 MG 0.5 ML DULAGLUTIDA 4 UD JERINGAS PRELLENADAS", (0.75, 0.5, None, None)),
    ("AMAL TABS 8 MG C 10", (8, None, None, 10)),
    ("KIT PARA NEBULIZADOR", (None, None, None, None)),
    ("ENCEPHABOL 200 MG ORAL 24 GRAGEAS", (200, None, None, 24)),
    ("ENFAMIL 6 A 12 MESES F RMULA INFANTIL CAJA 1.1 KG", (None, None, 1100, None)),
    ("SIMILAC F RMULA INFANTIL ETAPA 3 350 GR", (None, None, 350, None)),
    ("DUODERM EXTRA THIN SPOTS INFANTIL 5PZAS", (None, None, None, 5)),
    ("RHINOCORT AQUA 32 MCG SUSPENSI N NASAL 120 DOSIS", (0.032, None, None, None)),
    ("JBE 250 MG 5ML 60 ML", (250, 60, None, None)),
]


def test_extract_attributes(spark):
    found = apply(spark, [t for t, _ in ATTRIBUTES], magnitudes.extract_attributes("x").alias("s"))
    assert [tuple(None if v is None else float(v) for v in r[0]) for r in found] == [e for _, e in ATTRIBUTES]


def test_mg_per_pack(spark):
    cases = {
        "BISOLVON LINCTUS 4 MG /5ML 120 ML + ACCE": (0.8, "MG/ML", 96), "TABALON TABL 400 MG 10": (400, "MG", 4000), "DORZOLAMINA G.I EX SOL OFTA 20 MG /ML 5 ML": (20, "MG/ML", 100),
        "AMOXICILINA G.I MA SUSP 500 MG 60 ML": (None,) * 3, "BISOLVON LINCTUS PED. 4 MG /5ML 2 100 ML": (None,) * 3, "MOTRIN GOTA PED FSA 50 MG 15ML CHAR 2 6": (None,) * 3,
    }
    found = apply(spark, list(cases), magnitudes.mg_per_pack(text.clean_text("x")).alias("s"))
    assert [tuple(round(v, 9) if isinstance(v, float) else v for v in r[0]) for r in found] == list(cases.values())


def test_magnitudes_agree(spark):
    pairs = [("5 MG 10 TABS", "5 MG", True), ("5 MG", "10 MG", False), ("", "5 MG", True), ("10 TABS", "20 TABS", False)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(pairs)], "i int, a string, b string")
    agree = magnitudes.magnitudes_agree(magnitudes.extract_attributes("a"), magnitudes.extract_attributes("b"))
    assert [r[0] for r in df.orderBy("i").select(agree).collect()] == [e for *_, e in pairs]


def test_calendar(spark):
    assert apply(spark, ["2026/03_marzo/x.csv", "a/2025/12_diciembre/y.csv", "2026/13_marzo/x", "2026/03_abril/x", "x"], calendar.month_of_path("x")) == [("2026-03",), ("2025-12",), (None,), (None,), (None,)]
    assert calendar.valid_month("2026-01") == "2026-01"
    with pytest.raises(ValueError):
        calendar.valid_month("2026-1")


def test_store_forms(spark):
    cases = {
        "first_amount": {"$1,234.50 c/u": "1234.50", "sin precio": "0.00"}, "commas_to_dots": {"$1,173.00": "1.173.00"}, "digits_and_dots": {"$31.67 c/u.": "31.67."},
        "two_decimals": {"1234.5": "1,234.50", "x": None}, "fixed_point": {"$1,234.5": "1234.50", "": "0.00"},
        "cents_amount": {"Total 1,234.50": "$1234.50", "Cotización requerida": "", "producto no disponible": "NO DISPONIBLE", "nada": ""},
        "whole_and_fraction": {"1,234 50": "1234.50", "99.90": "99.90", "x": None}, "or_unavailable": {" ": "No disponible", "5": "5"},
    }
    for name, expected in cases.items():
        assert [r[0] for r in apply(spark, list(expected), stores.FORMS[name]("x"))] == list(expected.values()), name
    df = spark.createDataFrame([(2.0, None), (0.0, 5.0), (3.0, 9.0)], "a double, b double")
    a, b = stores.backfilled(F.col("a"), F.col("b"))
    assert [tuple(r) for r in df.select(a, b).collect()] == [(2.0, 2.0), (5.0, 5.0), (3.0, 9.0)]
    a, b = stores.sale_capped(F.col("a"), F.col("b"))
    assert [tuple(r) for r in df.select(a, b).collect()] == [(2.0, None), (0.0, 0.0), (3.0, 3.0)]
    a, b = stores.regular_raised(F.col("a"), F.col("b"))
    assert [tuple(r) for r in df.select(a, b).collect()] == [(2.0, None), (5.0, 5.0), (9.0, 9.0)]
    only_sale = spark.createDataFrame([(None, 4.0)], "a double, b double")
    assert tuple(only_sale.select(a, b).first()) == (4.0, 4.0)
    shops = spark.createDataFrame([("a", "$1,5"), ("b", "$1,5"), ("c", "$1,5")], "s string, x string")
    assert [r[0] for r in shops.select(stores.by_shop("x", "s", {"a": "first_amount", "b": "commas_to_dots"})).collect()] == ["15", "1.5", "$1,5"]
    assert apply(spark, ["Access DENIED", "ok", None], stores.is_blocked("x")) == [(True,), (False,), (None,)]


def test_stats(spark):
    low, high = stats.wilson("k", "n")
    df = spark.createDataFrame([(9, 10), (0, 0)], "k int, n int")
    rows = [tuple(r) for r in df.select(low, high, stats.ratio("k", "n")).collect()]
    assert rows[0][0] == pytest.approx(0.5958, abs=1e-3) and rows[0][1] == pytest.approx(0.9821, abs=1e-3) and rows[1] == (None, None, None)
    assert apply(spark, [400.0, 0.75, 1200.0, None], stats.plain_number("x"), kind="double") == [("400",), ("0.75",), ("1200",), (None,)]
    bands = stats.band("x", (0.0, 1.0), ("bajo", "medio", "alto"), (True, False))
    assert apply(spark, [-1.0, 0.0, 0.5, 1.0, None], bands, kind="double") == [("bajo",), ("bajo",), ("medio",), ("alto",), (None,)]
