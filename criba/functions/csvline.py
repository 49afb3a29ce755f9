"""One CSV record in a column: quoting check and cells, without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from criba.functions.text import as_column

#: Stands for a comma inside quotes while the record is split; a private-use code point.
_INNER_COMMA = "\ue000"


def quote_parts(line: Column | str) -> Column:
    """The record split at quotes: parts at even places lie outside, at odd ones inside."""
    return F.split(as_column(line), '"', -1)


def quoting_broken(line: Column | str) -> Column:
    """True where a quote stays open or text touches a quoted cell from outside.

    Outside parts must meet the quotes with commas; an empty outside part between
    two quoted ones is a doubled quote. A quote within an unquoted cell counts as
    broken. Records without quotes, null ones too, are never broken.
    """
    parts = quote_parts(line)
    last = F.size(parts) - 1

    def touches(part: Column, i: Column) -> Column:
        outside = (i % 2 == 0) & (part != "")
        return outside & (((i < last) & ~part.endswith(",")) | ((i > 0) & ~part.startswith(",")))

    loose = F.exists(F.transform(parts, touches), lambda x: x)
    return F.coalesce((F.size(parts) > 1) & ((F.size(parts) % 2 == 0) | loose), F.lit(False))


def cells(line: Column | str) -> Column:
    """Cells of a record with sound quoting, quotes removed; null for a null record.

    The empty record has one empty cell. Line breaks inside quotes are kept.
    """
    parts = quote_parts(line)
    last = F.size(parts) - 1
    plain = F.transform(
        parts,
        lambda p, i: F.when(i % 2 == 1, F.translate(p, ",", _INNER_COMMA))
        .when((p == "") & (i > 0) & (i < last), F.lit('"'))
        .otherwise(p),
    )
    return F.transform(F.split(F.array_join(plain, ""), ",", -1), lambda c: F.translate(c, _INNER_COMMA, ","))
