"""Workbook files -> sheet cells."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import fixed_values as fv
from folioscope.contracts import CELLS
from folioscope.functions.urls import suffix_of
from folioscope.scale import with_group_totals

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
ROWS_PER_BATCH = 4000


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """binaryFile rows with amc, period and source_file taken from .../amc/YYYY-MM/file."""
    return with_place(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path))


def with_place(files: DataFrame) -> DataFrame:
    pattern = r"/([^/]+)/(\d{4}-\d{2})/([^/]+)$"
    return files.withColumns({
        "amc": F.regexp_extract("path", pattern, 1), "period": F.regexp_extract("path", pattern, 2),
        "source_file": F.regexp_extract("path", pattern, 3)})


def select_workbooks(files: DataFrame) -> DataFrame:
    """Workbooks of a month folder: no dotfiles; a roll-up goes when per-scheme files exist beside it."""
    books = files.filter(suffix_of(F.col("source_file")).isin(fv.WORKBOOK_SUFFIXES) & ~F.col("source_file").startswith("."))
    marked = books.withColumn("__rollup", F.col("source_file").rlike(fv.ROLLUP_FILE_PATTERN))
    counted = with_group_totals(marked, ["amc", "period"], {"__single": F.count_if(~F.col("__rollup"))},
                                rows=marked.select("amc", "period", "__rollup"))
    return counted.filter(~F.col("__rollup") | (F.col("__single") == 0)).drop("__rollup", "__single")


def select_monthly_file(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chosen, rejects): the one monthly workbook per house and month, by the period in its name."""
    books = files.filter(F.col("source_file").rlike("(?i)MONTHLY_PORTFOLIO") & suffix_of(F.col("source_file")).isin(fv.WORKBOOK_SUFFIXES))
    hint = r"(?i)(jan|feb|mar|apr|may|jun|jul|aug|sept|sep|oct|nov|dec)[a-z]*[\s_\-]?(\d{4}|\d{2})(?!\d)"
    months = F.create_map(*[F.lit(x) for kv in fv.MONTH_ABBREVIATIONS.items() for x in kv])
    month = F.try_element_at(months, F.lower(F.substring(F.regexp_extract("source_file", hint, 1), 1, 3)))
    digits = F.regexp_extract("source_file", hint, 2)
    year = F.when(F.length(digits) == 2, F.concat(F.lit("20"), digits)).otherwise(digits)
    named = F.when(digits != "", F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0")))
    work = books.withColumn("__fits", F.coalesce(named == F.col("period"), F.lit(False)))
    slim = work.select("amc", "period", "__fits")
    work = with_group_totals(work, ["amc", "period"], {
        "__files": F.count(F.lit(1)), "__fitting": F.count_if("__fits")}, rows=slim)
    ok = (F.col("__files") == 1) | (F.col("__fits") & (F.col("__fitting") == 1))
    rejects = work.filter((F.col("__files") > 1) & (F.col("__fitting") != 1)).withColumn(
        "reason", F.lit("ambiguous monthly-portfolio workbooks"))
    scratch = ("__fits", "__files", "__fitting")
    return work.filter(ok).drop(*scratch), rejects.drop(*scratch)


# --- OOXML -----------------------------------------------------------------------------

def _column(ref: str) -> int:
    number = 0
    for ch in re.match(r"[A-Z]*", ref).group():
        number = number * 26 + ord(ch) - 64
    return number - 1


def _strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in root.findall(f"{_MAIN}si")]


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    rels = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels}
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    out = []
    for sheet in root.iter(f"{_MAIN}sheet"):
        file = target.get(sheet.get(f"{_REL}id"), "")
        file = file.lstrip("/") if file.startswith("/") else posixpath.normpath(f"xl/{file}")
        out.append((sheet.get("name"), file))
    return out


def _value(cell, strings: list[str]) -> tuple[str | None, float | None]:
    """(text, number) of a cell; booleans and errors are text."""
    kind, raw = cell.get("t", "n"), cell.findtext(f"{_MAIN}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t")), None
    if raw is None:
        return None, None
    if kind == "s":
        return strings[int(raw)], None
    if kind == "b":
        return ("TRUE" if raw == "1" else "FALSE"), None
    if kind in ("str", "e", "d"):
        return raw, None
    return None, float(raw)


def _rows(book: zipfile.ZipFile, file: str, strings: list[str]) -> Iterator[tuple[int, list]]:
    with book.open(file) as stream:
        place = -1
        for _, element in ElementTree.iterparse(stream):
            if element.tag != f"{_MAIN}row":
                continue
            place = int(element.get("r", place + 2)) - 1
            cells: list = []
            for cell in element.findall(f"{_MAIN}c"):
                col = _column(cell.get("r", "")) if cell.get("r") else len(cells)
                cells.extend([None] * (col - len(cells)))
                text, number = _value(cell, strings)
                cells.append(None if text is None and number is None else {"s": text, "n": number})
            yield place, cells
            element.clear()


def workbook_rows(content: bytes) -> Iterator[tuple[str, int, int, list]]:
    """(sheet, sheet_idx, row_idx, cells) of one OOXML workbook, row by row."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings = _strings(book)
        for number, (name, file) in enumerate(_sheets(book)):
            for place, cells in _rows(book, file, strings):
                yield name, number, place, cells


READ = T.StructType([*CELLS.fields, T.StructField("error", T.StringType())])


def explode_workbooks(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells, rejects) of binary files, typed by their first bytes and not by their ending.

    Each task reads one file at a time and hands rows on in small batches. A file that cannot be
    read becomes one reject row; OLE2 workbooks are rejected by name.
    """
    magic = F.hex(F.substring("content", 1, 4))
    kind = F.when(magic.startswith("504B"), "ooxml").when(magic == "D0CF11E0", "ole2").otherwise("unknown")
    typed = files.withColumn("kind", kind)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.name for f in READ.fields]
        for batch in batches:
            for file in batch.itertuples(index=False):
                place, rows = (file.amc, file.period, file.source_file), []
                try:
                    for sheet, number, row, cells in workbook_rows(file.content):
                        rows.append((*place, sheet, number, row, cells, None))
                        if len(rows) == ROWS_PER_BATCH:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                except Exception as exc:  # one damaged workbook must not end the job
                    rows.append((*place, None, None, None, None, f"{type(exc).__name__}: {exc}"))
                yield pd.DataFrame(rows, columns=names)

    read = typed.filter("kind = 'ooxml'").select("amc", "period", "source_file", "content").mapInPandas(run, READ)
    cells = read.filter("error is null").drop("error")
    failed = read.filter("error is not null").select("amc", "period", "source_file", F.col("error").alias("reason"))
    other = typed.filter("kind <> 'ooxml'").select("amc", "period", "source_file", F.concat(
        F.lit("not an OOXML workbook: "), "kind").alias("reason"))
    bad = failed.select("amc", "period", "source_file").distinct()
    return cells.join(bad, ["amc", "period", "source_file"], "left_anti"), failed.unionByName(other)


def file_facts(files: DataFrame) -> DataFrame:
    """(amc, period, path, length, sha256, head) of binary files, for the completeness checks.

    The head begins behind leading blank space where a markup page follows it.
    """
    text = F.ltrim(F.decode("content", "ISO-8859-1"), F.lit(" \t\n\v\f\r"))
    head = F.when(text.startswith("<"), F.encode(F.substring(text, 1, 512), "ISO-8859-1")).otherwise(F.substring("content", 1, 512))
    return files.select("amc", "period", F.col("source_file").alias("path"), "length", F.sha2("content", 256).alias("sha256"),
                        head.alias("head"))


