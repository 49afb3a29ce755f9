"""Text expressions: trimming, accent folding, cleaning, tokens, names."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any kind: blanks and line breaks of Unicode, control separators, and the
#: zero-width marks that stand for no text.
WHITE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200E), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]))


def _accent_map() -> tuple[str, str]:
    """Precomposed Latin letters and their base letters, from Unicode's own decompositions."""
    letters, bases = [], []
    for point in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        whole = unicodedata.normalize("NFD", chr(point))
        base = "".join(c for c in whole if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(point):
            letters.append(chr(point))
            bases.append(base)
    return "".join(letters), "".join(bases)


_ACCENTED, _PLAIN = _accent_map()


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it.

    Nested conditions would otherwise repeat the expression of the value at every
    mention, in the plan and at run time.
    """
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def strip(c: Column | str) -> Column:
    """Without white space of any kind at either end; null stays null."""
    return F.btrim(as_column(c), F.lit(WHITE))


def squeeze(c: Column | str) -> Column:
    """Without any white space at all."""
    return F.translate(as_column(c), WHITE, "")


#: Marks of no width: they part no words.
_NO_WIDTH = "\u200b\u200c\u200d\u2060\ufeff"


def single_spaced(c: Column | str) -> Column:
    """White space of any kind between words as one blank, none at the ends; marks of no width go."""
    wide = "".join(w for w in WHITE if w not in _NO_WIDTH)
    # Characters beyond the replacement's length are removed.
    blank = F.translate(as_column(c), wide + _NO_WIDTH, " " * len(wide))
    return F.trim(F.regexp_replace(blank, " {2,}", " "))


def is_blank(c: Column | str) -> Column:
    """True for null, empty and all-white-space texts."""
    return F.coalesce(strip(c), F.lit("")) == ""


def fold_accents(c: Column | str) -> Column:
    """Latin letters without their accents: precomposed ones by table, loose marks removed.

    Stays inside the JVM: letters outside Latin keep their form, as their
    decomposition would be another letter.
    """
    return F.regexp_replace(F.translate(as_column(c), _ACCENTED, _PLAIN), r"\p{M}", "")


def clean_text(c: Column | str) -> Column:
    """Search form of a text: lower case, no accents, letters, digits and decimal dots only.

    A dot survives only between two digits; every other sign becomes a blank and
    blanks are squeezed. Empty stays empty, null stays null.
    """
    low = fold_accents(F.lower(strip(c)))
    kept = F.regexp_replace(low, r"(\d)\.(\d)", "$1\u0001$2")
    kept = F.regexp_replace(kept, r"[^\p{L}\p{N}\s\x{1}]", " ")
    kept = F.translate(kept, "\u0001", ".")
    return F.trim(F.regexp_replace(kept, r"\s+", " "))


def column_name(c: Column | str) -> Column:
    """Normal form of a column name: no BOM, lower case, no accents, blanks as ``_``."""
    bare = strip(F.regexp_replace(as_column(c), r"^\x{feff}", ""))
    return F.translate(fold_accents(F.lower(bare)), WHITE, "_" * len(WHITE))


def tokens(c: Column | str) -> Column:
    """Upper-case A-Z/0-9 tokens of a text as an array; no empty tokens."""
    parts = F.split(F.regexp_replace(F.upper(as_column(c)), r"[^A-Z0-9]+", " "), " ")
    return F.filter(parts, lambda t: t != "")


def ngrams(words: Column, low: int = 1, high: int = 7) -> Column:
    """All contiguous phrases of ``low`` to ``high`` words of an array, joined by blanks."""
    def of_length(n: int) -> Column:
        # sequence() counts down when the stop lies below the start, hence the guard.
        starts = F.sequence(F.lit(1), F.size(words) - n + 1)
        phrases = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.when(F.size(words) >= n, phrases).otherwise(F.array().cast("array<string>"))

    whole = [of_length(n) for n in range(low, high + 1)]
    return F.flatten(F.array(*whole))


def replace_words(c: Column | str, table: dict[str, str]) -> Column:
    """Letter runs that are keys of ``table`` replaced by its values; all else kept in place.

    ``table`` is a fixed dictionary of the caller (a seed), not data.
    """
    pieces = F.regexp_extract_all(as_column(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    if not table:
        return F.array_join(pieces, "")
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.array_join(F.transform(pieces, lambda p: F.coalesce(F.try_element_at(lookup, p), p)), "")
