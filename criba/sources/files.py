"""Text sources: capture CSV files, code tables, seeds, workbooks; discovery and profiles."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator, Sequence
from io import BytesIO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from criba.functions.dates import parse_date


def relative_path(base: str) -> Column:
    """Path of the file a row came from, relative to the base folder, with single slashes."""
    return F.regexp_replace(F.col("_metadata.file_path"), "^.*?" + _quoted(base.rstrip("/")) + "/+", "")


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


def capture_lines(spark: SparkSession, base: str, pattern: str = "*.csv") -> DataFrame:
    """Records of all CSV files below a folder: ``_archivo_origen, _fila_num, linea``.

    Record 0 is the first line, whether a header or not. A record ends at a line
    break outside quotes, so quoted cells may hold breaks; a quote left open ends
    with its line where the next line looks sound by itself. Bytes that are not
    UTF-8 are read as Latin-1 where the whole file then has no control codes, else
    replaced. Hidden files are skipped, empty files have no records.

    A file is the unit of work: capture files are of one shop and month.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(base)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["ruta"], batch["content"]):
                records = split_records(decoded(content))
                yield pd.DataFrame({"_archivo_origen": path, "_fila_num": range(len(records)), "linea": records})

    return files.select(relative_path(base).alias("ruta"), "content").mapInPandas(run, "_archivo_origen string, _fila_num bigint, linea string")


def decoded(content: bytes) -> str:
    """UTF-8, else Latin-1 where that gives no control codes, else UTF-8 with replacements."""
    try:
        return content.decode("utf-8-sig")
    except UnicodeDecodeError:
        text = content.decode("latin-1")
        return text if not any("\x7f" <= c < "\xa0" for c in text) else content.decode("utf-8", "replace")


def split_records(text: str) -> list[str]:
    """CSV records of a text; line breaks inside quotes belong to their record."""
    out: list[str] = []
    held = ""
    for line in text.split("\n"):
        line = line.removesuffix("\r")
        whole = f"{held}\n{line}" if held else line
        # An odd number of quotes leaves a cell open; a sound line that follows ends it.
        if whole.count('"') % 2 and not (held and line.count('"') % 2 == 0 and line.count(",") >= held.count(",") > 0):
            held = whole
            continue
        if held and whole.count('"') % 2:
            out.append(held)
            whole = line
        out.append(whole)
        held = ""
    if held:
        out.append(held)
    return out[:-1] if out and out[-1] == "" else out


def code_table(spark: SparkSession, path: str, columns: Sequence[str], encoding: str = "ISO-8859-1") -> DataFrame:
    """Tab-separated text without header or quoting, every column text: stray quotes merge nothing."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).option("sep", "\t").option("encoding", encoding).option("quote", "").option("escape", "").csv(path)


def seed_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small CSV with header and forced types; cells that do not fit are null."""
    return spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE").csv(path)


def text_parquet(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Parquet files of a snapshot with every column as text, in the given order."""
    return spark.read.parquet(path).select(*[F.col(c).cast("string").alias(c) for c in columns])


def partitioned_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet folders ``a=x/b=y`` whose partition values stay text (``2026-01`` is no date)."""
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(setting, before)


_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def workbook_rows(content: bytes, sheet: str) -> list[list[str | None]]:
    """All cells of a sheet (by exact name) of an XLSX file as text, empty ones None."""
    with zipfile.ZipFile(BytesIO(content)) as book:
        part = lambda name: ElementTree.fromstring(book.read(name))
        ids = {s.get("name"): s.get(_REL) for s in part("xl/workbook.xml").iter(f"{_SHEET}sheet")}
        if sheet not in ids:
            raise ValueError(f"the workbook has no sheet {sheet!r}, only {sorted(ids)}")
        target = next(r.get("Target") for r in part("xl/_rels/workbook.xml.rels") if r.get("Id") == ids[sheet])
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{_SHEET}t")) for s in part("xl/sharedStrings.xml").iter(f"{_SHEET}si")]
        rows: list[list[str | None]] = []
        for row in part("xl/" + target.removeprefix("/xl/")).iter(f"{_SHEET}row"):
            cells: list[str | None] = []
            for cell in row.iter(f"{_SHEET}c"):
                letters = "".join(c for c in cell.get("r", "") if c.isalpha())
                at = 0
                for c in letters:
                    at = at * 26 + ord(c) - 64
                cells += [None] * (at - 1 - len(cells)) if letters else []
                value, inline = cell.find(f"{_SHEET}v"), cell.find(f"{_SHEET}is")
                if cell.get("t") == "s" and value is not None:
                    cells.append(shared[int(value.text)])
                elif inline is not None:
                    cells.append("".join(t.text or "" for t in inline.iter(f"{_SHEET}t")))
                else:
                    cells.append(None if value is None else value.text)
            rows.append(cells)
        return rows


def workbook_table(spark: SparkSession, path: str, sheet: str, names: dict[str, str]) -> DataFrame:
    """A sheet with a header as a text table, columns renamed and selected by ``names``.

    A missing column, or one of the sheet that ``names`` does not mention, raises
    ValueError. The file is a catalogue that one machine can open.
    """
    content = spark.read.format("binaryFile").load(path).select("content").first()[0]
    rows = workbook_rows(bytes(content), sheet)
    header = [c or "" for c in rows[0]] if rows else []
    missing, unknown = [n for n in names if n not in header], [n for n in header if n and n not in names]
    if missing or unknown:
        raise ValueError(f"columns missing: {missing}; not expected: {unknown}")
    at = {names[h]: i for i, h in enumerate(header) if h}
    table = [[r[i] if i < len(r) else None for i in at.values()] for r in rows[1:]]
    return spark.createDataFrame(table, ", ".join(f"`{c}` string" for c in at))


def reconcile_inventory(found: DataFrame, declared: DataFrame, until: str | None = None) -> DataFrame:
    """Files on disk against declared ones: ``ruta, anio_mes, estado``.

    ``declarado`` (both), ``sin_declarar`` (on disk only), ``faltante`` (declared
    only); files of months after ``until`` are ``fuera_de_corte`` whatever else.
    """
    a = found.select("ruta", F.lit(True).alias("_hay")).dropDuplicates(["ruta"])
    b = declared.select("ruta", "anio_mes", F.lit(True).alias("_dicho")).dropDuplicates(["ruta"])
    month = F.coalesce("anio_mes", F.concat_ws("-", F.regexp_extract("ruta", r"(\d{4})/(\d{2})_", 1), F.regexp_extract("ruta", r"(\d{4})/(\d{2})_", 2)))
    state = F.when(F.col("_hay") & F.col("_dicho"), "declarado").when(F.col("_hay"), "sin_declarar").otherwise("faltante")
    joined = a.join(b, "ruta", "full").withColumn("anio_mes", month)
    if until is not None:
        state = F.when(F.col("anio_mes") > until, "fuera_de_corte").otherwise(state)
    return joined.select("ruta", "anio_mes", state.alias("estado"))


class InventoryError(ValueError):
    """Files on disk that nobody declared."""


def sound_discovery(reconciled: DataFrame, shown: int = 20) -> DataFrame:
    """The reconciled inventory itself; raises InventoryError naming undeclared files within the cutoff, the first so many.

    Files beyond the cutoff and declared ones that are missing stay in the result for the caller to report.
    """
    bad = [r["ruta"] for r in reconciled.where("estado = 'sin_declarar'").orderBy("ruta").limit(shown).collect()]
    if bad:
        raise InventoryError("not declared: " + ", ".join(bad))
    return reconciled


def file_profiles(rows: DataFrame, file: str, declared_month: str, date_text: str) -> DataFrame:
    """Per file: rows, majority month of its dates, rows dated in another month than declared.

    ``file, filas, mes_mayoritario, fuera_de_mes``; of months equally frequent the
    earliest stands. Counts by file and month come first, so large files are reduced.
    """
    dated = rows.select(file, declared_month, F.date_format(parse_date(date_text), "yyyy-MM").alias("_m"))
    counts = dated.groupBy(file, declared_month, "_m").agg(F.count("*").alias("_n"))
    known = F.when(F.col("_m").isNotNull(), F.struct(-F.col("_n"), "_m"))
    return counts.groupBy(file).agg(
        F.sum("_n").alias("filas"),
        F.min_by("_m", known).alias("mes_mayoritario"),
        F.coalesce(F.sum(F.when(F.col("_m") != F.col(declared_month), F.col("_n"))), F.lit(0)).alias("fuera_de_mes"),
    )


def checksums(spark: SparkSession, base: str, pattern: str = "*") -> DataFrame:
    """``ruta, bytes, md5`` of all files below a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(base)
    return files.select(relative_path(base).alias("ruta"), F.col("length").alias("bytes"), F.md5("content").alias("md5"))
