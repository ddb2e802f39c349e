"""Which layout reads a house, and the three layouts that are not the generic one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.contracts import HOLDINGS_RAW
from folioscope.functions.text import cell_text
from folioscope.operators import sheets
from folioscope.operators.derivatives import derivative_holdings
from folioscope.operators.sheets import FILE, SHEET, SHEET_KEYS
from folioscope.scale import ordered_scan, settle


def scheme_index(cells: DataFrame) -> DataFrame:
    """(file, code, scheme) from each workbook's index sheet; the last entry of a code wins."""
    index = cells.filter(F.lower(F.trim("sheet")) == "index").withColumns({
        "code": F.trim(cell_text(F.get("cells", F.lit(1)))), "scheme": F.trim(cell_text(F.get("cells", F.lit(2))))})
    index = index.filter((F.col("code") != "") & (F.col("scheme") != "") & (F.upper("code") != "SCHEME CODE"))
    return index.groupBy(*FILE, "code").agg(F.max_by("scheme", F.struct("sheet_idx", "row_idx")).alias("scheme"))


def scheme_from_index(cells: DataFrame, holdings: DataFrame) -> DataFrame:
    """Scheme name from the index sheet; rows of sheets the index does not know are dropped."""
    known = scheme_index(cells).select(*FILE, F.col("code").alias("__code"), "scheme")
    kept = holdings.filter(~F.lower(F.trim("sheet")).isin(fv.INDEX_LAYOUT_NON_SCHEME_SHEETS))
    named = kept.withColumn("__code", F.trim("sheet")).join(known, [*FILE, "__code"], "inner")
    return named.withColumn("scheme_name_raw", F.col("scheme")).select(*holdings.columns)


def scheme_from_filename(file: Column) -> Column:
    """File name without its ending and without the month-year at the end."""
    stem = F.regexp_replace(file, r"\.[^.]*$", "")
    return F.trim(F.regexp_replace(stem, r"(?i)\s+(" + fv.MONTH_WORD_PATTERN + r")\s+\d{4}\s*$", ""))


def parse_fixed_layout(cells: DataFrame) -> DataFrame:
    """Columns B..G below a "Name of the Instrument" row within the first ten rows."""
    head = cells.filter((F.col("row_idx") < 10) & F.exists(
        "cells", lambda c: F.coalesce(F.trim(c["s"]) == "Name of the Instrument", F.lit(False))))
    heads = head.groupBy(*SHEET_KEYS).agg(F.min("row_idx").alias("head_row"))
    rows = cells.join(heads, SHEET_KEYS, "inner").filter(F.col("row_idx") > F.col("head_row"))

    def present(i: int) -> Column:
        cell = F.get("cells", F.lit(i))
        return F.when(cell["n"].isNotNull() | (F.coalesce(cell["s"], F.lit("")) != ""), cell)

    rows = rows.withColumns({
        "security_name": F.trim(cell_text(F.get("cells", F.lit(1)))), "isin": F.trim(cell_text(present(2))),
        "industry_raw": F.trim(cell_text(present(3))), "quantity": present(4), "market_value_raw": present(5),
        "pct_raw": present(6),
    }).filter(F.col("security_name") != "")
    low = F.lower("security_name")
    rows = rows.filter(~low.isin(fv.FIXED_LAYOUT_TOTALS) & ~F.col("security_name").startswith("(a)")
                       & ~F.col("security_name").startswith("(b)"))
    rows = sheets.cut_at_stop(rows.withColumn("is_stop", low == "notes:"))
    has_value = F.coalesce("quantity", "market_value_raw", "pct_raw").isNotNull()
    section = F.when(~has_value & low.isin(fv.FIXED_LAYOUT_SECTIONS), F.col("security_name"))
    sub = F.when(~has_value & low.isin(fv.FIXED_LAYOUT_SUBSECTIONS), F.col("security_name"))
    w = Window.partitionBy(*SHEET_KEYS).orderBy("row_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = F.struct(section.alias("section"), F.col("row_idx").alias("at"))
    rows = rows.withColumns({
        "top": F.last(F.when(section.isNotNull(), level), ignorenulls=True).over(w),
        "sub": F.last(F.when(sub.isNotNull(), F.struct(sub.alias("label"), F.col("row_idx").alias("at"))),
                      ignorenulls=True).over(w),
    })
    newer = F.col("sub.at") > F.coalesce("top.at", F.lit(-1))
    return rows.filter(has_value).select(
        *SHEET, F.lit(0).alias("part"), "row_idx", F.col("sheet").alias("scheme_name_raw"),
        F.when(newer, F.col("sub.label")).otherwise(F.col("top.section")).alias("section_header"),
        "security_name", F.when(F.col("isin") != "", F.col("isin")).alias("isin"),
        F.when(F.col("industry_raw") != "", F.col("industry_raw")).alias("industry_raw"),
        "quantity", "market_value_raw", "pct_raw")


def with_order(rows: DataFrame) -> DataFrame:
    """Dense ``ord`` per (amc, period) in file, sheet, row order, and the month-end date (settled)."""
    placed = ordered_scan(
        rows, ["amc", "period"], ["source_file", "sheet_idx", "part", "row_idx"],
        F.struct("source_file", "sheet_idx"), position="ord")
    month_end = F.last_day(F.concat("period", F.lit("-01")).try_cast("date"))
    return settle(placed.withColumn("port_date", month_end).select(*[f.name for f in HOLDINGS_RAW.fields]))


def house_layouts(spark: SparkSession) -> DataFrame:
    """(amc, layout) of the houses that are not generic."""
    return spark.createDataFrame(sorted(fv.HOUSE_LAYOUTS.items()), "amc string, layout string")


def parse_period(cells: DataFrame, layouts: DataFrame | None = None,
                 overrides: DataFrame | None = None) -> DataFrame:
    """Cells of many houses and months -> holdings_raw, each house in its own layout.

    ``layouts`` is (amc, layout) with layout in generic, fixed, index, filename; a house that is
    not listed is generic. The houses' own table is taken by default. It is settled: rows made on the driver have no
    known size, and a join with them would deal all cells by house.
    """
    layouts = settle(house_layouts(cells.sparkSession) if layouts is None else layouts)
    tagged = cells.join(layouts, "amc", "left").withColumn("layout", F.coalesce("layout", F.lit("generic")))

    def part(name: str) -> DataFrame:
        return tagged.filter(F.col("layout") == name).drop("layout")

    plain = tagged.filter(F.col("layout").isin("index", "filename"))
    held = settle(sheets.merge_receivables(sheets.parse_sheets(plain.drop("layout")), overrides))
    named = held.join(layouts.filter("layout = 'filename'").select("amc"), "amc", "left_semi")
    by_file = named.withColumn("scheme_name_raw", scheme_from_filename(F.col("source_file")))
    listed = held.join(layouts.filter("layout = 'index'").select("amc"), "amc", "left_semi")
    by_index = scheme_from_index(part("index"), listed)
    blocks_only = sheets.drop_duplicate_blocks(with_order(by_index.unionByName(by_file)))
    fixed = with_order(parse_fixed_layout(part("fixed")))
    generic = with_order_and_clean(_generic(part("generic"), overrides), overrides)
    return generic.unionByName(blocks_only).unionByName(fixed)


def _generic(cells: DataFrame, overrides: DataFrame | None) -> DataFrame:
    held = settle(sheets.merge_receivables(sheets.parse_sheets(cells), overrides))
    return held.unionByName(settle(derivative_holdings(cells, held)))  # the order reads both twice


def with_order_and_clean(rows: DataFrame, overrides: DataFrame | None) -> DataFrame:
    """Repeated labels go first: they would break the split into equal copies."""
    return sheets.drop_duplicate_blocks(settle(sheets.drop_repeated_labels(with_order(rows), overrides)))

