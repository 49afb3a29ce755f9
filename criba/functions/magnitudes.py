"""Magnitudes in product texts: dose, volume, mass, pieces, milligrams a pack."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from criba.functions.text import as_column

NUMERIC = "decimal(18,9)"
_N = r"(\d+(?:\.\d+)?)"
#: Ends a unit without looking at letters beyond ASCII, as ``\b`` does in some engines only.
_END = r"(?![A-Z0-9_])"


def _first(text: Column, pattern: str, kind: str = NUMERIC) -> Column:
    return F.regexp_extract(text, pattern, 1).try_cast(kind)


def _last(text: Column, unit: str) -> Column:
    return F.try_element_at(F.regexp_extract_all(text, F.lit(rf"{_N}\s*{unit}{_END}"), F.lit(1)), F.lit(-1)).try_cast(NUMERIC)


def extract_attributes(c: Column | str) -> Column:
    """Struct of ``dosis_mg``, ``volumen_ml``, ``masa_g`` and ``piezas``; null where not stated.

    The dose is the first number of milligrams, else micrograms, else grams. The
    volume is the last number of millilitres, else litres: the first tends to be
    the volume of a dose. Grams feed dose and mass alike. Pieces come before a
    word of form or piece, after a lone C, or at the end of the text.
    """
    text = F.upper(as_column(c))
    unit = lambda u: _first(text, rf"{_N}\s*{u}{_END}")
    pieces = lambda stem: _first(text, rf"(\d+)\s*{stem}[A-Z]*{_END}", "bigint")
    return F.struct(
        F.coalesce(unit("MG"), (unit("MCG") / 1000).cast(NUMERIC), (unit("G") * 1000).cast(NUMERIC)).alias("dosis_mg"),
        F.coalesce(_last(text, "ML"), (_last(text, "L") * 1000).cast(NUMERIC)).alias("volumen_ml"),
        F.coalesce(unit("G"), unit("GR"), (unit("KG") * 1000).cast(NUMERIC)).alias("masa_g"),
        F.coalesce(
            pieces("TAB"),
            pieces("CAP"),
            pieces("GRAG"),
            pieces("PZ"),
            _first(text, rf"(?<![A-Z0-9_])C\s+(\d+){_END}", "bigint"),
            _first(text, r"(\d+)\s*$", "bigint"),
        ).alias("piezas"),
    )


def mg_per_pack(c: Column | str) -> Column:
    """Struct of ``mg_por_unidad``, ``unidad`` (MG or MG/ML) and ``mg_por_envase``, all double.

    Liquids state ``X MG [n] ML V ML``: X / n milligrams a millilitre, times V.
    Solids state a dose and pieces. A text with a lone volume says neither.
    """
    text = F.upper(as_column(c))
    liquid = r"(\d+(?:\.\d+)?)\s*MG\s+(\d+(?:\.\d+)?)?\s*ML\s+(\d+(?:\.\d+)?)\s*ML" + _END
    number = lambda n: F.regexp_extract(text, liquid, n).try_cast("double")
    rate = number(1) / F.coalesce(number(2), F.lit(1.0))
    solid = extract_attributes(c)
    dose = F.when(solid["volumen_ml"].isNull(), solid["dosis_mg"].cast("double"))
    is_liquid = number(1).isNotNull()
    return F.struct(
        F.when(is_liquid, rate).otherwise(dose).alias("mg_por_unidad"),
        F.when(is_liquid, "MG/ML").when(dose.isNotNull(), "MG").alias("unidad"),
        F.when(is_liquid, rate * number(3)).otherwise(dose * solid["piezas"]).alias("mg_por_envase"),
    )


def magnitudes_agree(a: Column, b: Column) -> Column:
    """True where two attribute structs contradict each other in no stated field."""
    fields = ("dosis_mg", "volumen_ml", "masa_g", "piezas")
    agree = F.lit(True)
    for f in fields:
        agree = agree & F.coalesce(a[f] == b[f], F.lit(True))
    return agree


# Route of administration by the first letter of the code of the dosage form; other letters have none.
ROUTES = {
    "A": "ORAL",
    "B": "ORAL",
    "C": "ORAL",
    "D": "ORAL",
    "E": "ORAL",
    "F": "PARENTERAL",
    "G": "PARENTERAL",
    "H": "RECTAL",
    "I": "NASAL",
    "J": "OTRA",
    "K": "BUCAL",
    "M": "TOPICA",
    "N": "OFTALMICA",
    "P": "OTICA",
    "Q": "NASAL",
    "R": "INHALADA",
    "T": "VAGINAL",
}


def route(code: Column | str, table: dict[str, str] = ROUTES) -> Column:
    """Route of a dosage form's code; null for letters without one."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), F.substring(as_column(code), 1, 1))


def group_key(*parts: Column | str, none: tuple[str, ...] = ()) -> Column:
    """Parts joined by bars; null where any part is null or a text that stands for none."""
    known = F.lit(True)
    for p in parts:
        known = known & as_column(p).isNotNull() & ~as_column(p).cast("string").isin(*none)
    return F.when(known, F.concat_ws(" | ", *[as_column(p).cast("string") for p in parts]))
