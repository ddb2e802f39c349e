"""Queries from sheet cells to holdings. Cells are printed from lineitem: one sheet per supplier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions.text import cell_number, typed_cell
from folioscope.operators import derivatives, identity, layouts, sheets
from folioscope.plans.driver_tables import LINE_ORDER, PART_CODE_SQL, coded_parts, line_block
from folioscope.plans.registry import query, table
from folioscope.scale import ordered_scan

LAST = 2_000_000_000
TYPE = "array<struct<s:string,n:double>>"


def row_of(*cells: Column | str | float | None) -> Column:
    """A sheet row from columns and plain values."""
    out = []
    for c in cells:
        if isinstance(c, Column):
            out.append(c)
        elif isinstance(c, (int, float)):
            out.append(typed_cell(number=F.lit(float(c))))
        else:
            out.append(typed_cell(text=F.lit(c)))
    return F.array(*out)


def sheet_frame(df: DataFrame, rows: Column) -> DataFrame:
    """(row_idx, cells) structs of each input row -> the cells table."""
    out = df.withColumn("r", F.explode(rows))
    return out.select(
        F.lit("house").alias("amc"), F.lit("2026-05").alias("period"),
        F.concat(F.lit("f"), F.col("l_suppkey") % 10, F.lit(".xlsx")).alias("source_file"),
        F.concat(F.lit("S"), "l_suppkey").alias("sheet"), F.col("l_suppkey").cast("int").alias("sheet_idx"),
        F.col("r.at").cast("int").alias("row_idx"), F.col("r.cells").cast(TYPE).alias("cells"))


def at(place: Column | int, cells: Column) -> Column:
    place = F.lit(place) if isinstance(place, int) else place
    return F.struct(place.cast("bigint").alias("at"), cells.cast(TYPE).alias("cells"))


def placed_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(*LINE_ORDER, "l_suppkey", "l_quantity", "l_returnflag")
    placed = ordered_scan(lines, ["l_suppkey"], LINE_ORDER, line_block(), position="pos")
    parts = coded_parts(spark, sf).select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type", "code")
    return placed.join(parts, "l_partkey")


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"))


def scheme_name() -> Column:
    return F.concat(F.lit("Scheme "), F.col("l_suppkey").cast("string"), F.lit(" Fund"))


def frame_rows() -> Column:
    """Title area, heading, section label, total, notes and what follows them."""
    k = F.col("l_suppkey") % 5
    banner = F.concat(F.lit("Portfolio Statement of "), scheme_name(), F.lit(" as on 31-May-2026"))
    label = F.concat(F.lit("SCHEME: "), scheme_name())

    def text(c: Column) -> Column:
        return typed_cell(text=c)

    title = (
        F.when(k == 0, row_of(text(banner))).when(k == 1, row_of(None, "Scheme Name :", None, text(scheme_name())))
        .when(k == 2, row_of(text(label))).when(k == 3, row_of(text(scheme_name()))).otherwise(row_of("short"))
    )
    return F.array(
        at(0, title), at(1, F.when(k == 4, row_of(None)).otherwise(row_of("(An open ended scheme investing in many things)"))),
        at(2, row_of("Name of the Instrument", "ISIN", "Industry / Rating", "Quantity", "Market/Fair Value (Rs. in Lacs)",
                     "% to Net Assets")),
        at(3, row_of("Equity & Equity related")),
        at(LAST, row_of("Sub Total", None, None, None, 123.0, 50.0)), at(LAST + 1, row_of("Broken", None, None, 1.0, 1.0, 4000.0)),
        at(LAST + 2, row_of("Notes: 1. read with care")), at(LAST + 3, row_of("After the notes", "INE040A01034", "x", 5.0, 6.0, 7.0)))


def printed_sheets(spark: SparkSession, sf: str) -> DataFrame:
    lines = placed_lines(spark, sf)
    name = F.concat("p_name", F.lit(" "), F.col("l_partkey").cast("string"), F.lit(" **"))
    body = row_of(typed_cell(text=name), typed_cell(text=F.col("code")), typed_cell(text=F.col("p_type")),
                  typed_cell(number=F.col("l_quantity")), typed_cell(text=F.col("l_extendedprice").cast("decimal(20,2)").cast("string")),
                  typed_cell(number=F.col("l_quantity") / 100))
    data = sheet_frame(lines, F.array(at(F.col("pos") + 4, body)))
    return sheet_frame(suppliers(spark, sf), frame_rows()).unionByName(data)


@query("sheet_holdings", """
SELECT l_suppkey::VARCHAR AS supplier, CASE WHEN l_suppkey % 5 = 4 THEN 'S' || l_suppkey ELSE 'Scheme ' || l_suppkey || ' Fund' END AS scheme,
       'Equity & Equity related' AS section, count(*) AS holdings, count(*) FILTER (l_partkey % 3 <> 0) AS coded,
       round(sum(l_extendedprice), 2) AS value_total, round(sum(l_quantity), 2) AS quantity_total, count(DISTINCT l_partkey) AS names
FROM lineitem GROUP BY 1, 2""")
def sheet_holdings(spark: SparkSession, sf: str) -> DataFrame:
    held = sheets.parse_sheets(printed_sheets(spark, sf))
    return held.groupBy(F.substring("sheet", 2, 20).alias("supplier"), F.col("scheme_name_raw").alias("scheme"),
                        F.col("section_header").alias("section")).agg(
        F.count(F.lit(1)).alias("holdings"), F.count("isin").alias("coded"),
        F.round(F.sum(cell_number(F.col("market_value_raw"))), 2).alias("value_total"),
        F.round(F.sum(cell_number(F.col("quantity"))), 2).alias("quantity_total"), F.count_distinct("security_name").alias("names"))


@query("harvest_names", f"""
WITH {PART_CODE_SQL}
SELECT 'f' || l_suppkey % 10 || '.xlsx' AS source_file, CASE WHEN p_partkey % 3 <> 0 THEN 'linked' ELSE 'contract' END AS kind, code,
       p_name || ' ' || l_partkey AS name, count(*) AS n
FROM lineitem JOIN coded ON p_partkey = l_partkey GROUP BY 1, 2, 3, 4
UNION ALL SELECT 'f' || s_suppkey % 10 || '.xlsx', 'linked', 'INE040A01034', 'After the notes', count(*) FROM supplier GROUP BY 1""")
def harvest_names(spark: SparkSession, sf: str) -> DataFrame:
    return identity.harvest_names(printed_sheets(spark, sf)).select("source_file", "kind", "code", "name", "n")


@query("locate_columns", f"""
WITH {PART_CODE_SQL},
c AS (
  SELECT p_brand, p_partkey, code, p_partkey % 3 <> 0 AS good, u.col, u.v FROM coded,
  LATERAL (SELECT unnest([0, 1, 3]) AS col, unnest([p_type, p_name || ' ' || p_partkey, p_name]) AS v) u),
d AS (SELECT p_brand, count(*) AS rows_ FROM coded WHERE p_partkey % 3 <> 0 GROUP BY 1),
s AS (
  SELECT p_brand, col, count(*) AS k, count(DISTINCT v) AS u, avg(length(v)) AS len FROM c WHERE good AND length(v) >= 4 GROUP BY 1, 2),
t AS (SELECT s.*, (u / k) * least(len, 40) / (1 + 0.15 * abs(col - 2)) AS score FROM s JOIN d USING (p_brand) WHERE k >= greatest(1, rows_ * 0.5))
SELECT p_brand, 2 AS isin_col, col AS name_col, round(score, 6) AS name_score FROM t
QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, col) = 1""")
def locate_columns(spark: SparkSession, sf: str) -> DataFrame:
    parts = coded_parts(spark, sf)
    cells = row_of(*[typed_cell(text=c) for c in (
        F.col("p_type"), F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")), F.col("code"), F.col("p_name"))])
    rows = parts.select("p_brand", F.col("p_partkey").alias("row_idx"), cells.alias("cells"))
    return sheets.locate_columns(rows, ["p_brand"]).withColumn("name_score", F.round("name_score", 6))


@query("header_columns", """
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 3 WHEN s_suppkey % 3 = 1 THEN 0 END AS qty_col,
       CASE WHEN s_suppkey % 3 = 2 THEN 1 ELSE 4 END AS mkt_col, CASE WHEN s_suppkey % 2 = 0 THEN 5 END AS pct_col, 2 AS industry_col FROM supplier""")
def header_columns(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")

    def t(c: Column | str) -> Column:
        return typed_cell(text=c if isinstance(c, Column) else F.lit(c))

    cells = F.array(
        t(F.when(k % 3 == 1, "Total QTY").otherwise("Name")), t(F.when(k % 3 == 2, "MARKET-VALUE").otherwise("ISIN Code")),
        t("Rating_Industry"), t(F.when(k % 3 == 0, "No. of  Shares").otherwise("-")), t(F.when(k % 3 == 2, "x").otherwise("Fair Value")),
        t(F.when(k % 2 == 0, "% of NAV").otherwise("weight")))
    rows = table(spark, sf, "supplier").select("s_suppkey", cells.alias("cells"))
    return rows.select("s_suppkey", *[c.alias(n) for n, c in sheets.header_columns().items()])


def document_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("row_idx", "line"))
    return lines.withColumn("n", F.length("line"))


LINES_SQL = """
l AS (SELECT doc_id, i AS row_idx, line, length(line) AS n FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents))"""


@query("table_blocks", f"""
WITH {LINES_SQL},
b AS (SELECT doc_id, n, sum((n % 7 = 0)::INT) OVER (PARTITION BY doc_id ORDER BY row_idx) AS block FROM l)
SELECT doc_id, block::BIGINT AS block, count(*) AS lines, sum(n)::BIGINT AS chars FROM b GROUP BY 1, 2""")
def table_blocks(spark: SparkSession, sf: str) -> DataFrame:
    rows = document_lines(spark, sf).withColumn("is_header", F.col("n") % 7 == 0)
    return sheets.assign_blocks(rows, ["doc_id"]).groupBy("doc_id", "block").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("n").alias("chars"))


@query("section_fill", f"""
WITH {LINES_SQL},
s AS (SELECT doc_id, n, last_value(CASE WHEN n < 60 THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY row_idx) AS section FROM l)
SELECT doc_id, md5(section) AS section, count(*) AS lines, sum(n)::BIGINT AS chars FROM s WHERE n >= 60 GROUP BY 1, 2""")
def section_fill(spark: SparkSession, sf: str) -> DataFrame:
    rows = document_lines(spark, sf)
    filled = sheets.carry_in_sheet(rows, ["doc_id"], "section", F.when(F.col("n") < 60, F.col("line")))
    return filled.filter("n >= 60").groupBy("doc_id", F.md5("section").alias("section")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("n").alias("chars"))


@query("stop_cut", f"""
WITH {LINES_SQL},
s AS (SELECT *, max((n % 23 = 5)::INT) OVER (PARTITION BY doc_id ORDER BY row_idx) AS stopped FROM l)
SELECT doc_id, count(*) AS lines, sum(n)::BIGINT AS chars FROM s WHERE stopped = 0 GROUP BY 1""")
def stop_cut(spark: SparkSession, sf: str) -> DataFrame:
    rows = document_lines(spark, sf).withColumn("is_stop", F.col("n") % 23 == 5)
    return sheets.cut_at_stop(rows, ["doc_id"]).groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"), F.sum("n").alias("chars"))


@query("merge_consecutive", """
WITH g AS (
  SELECT user_id, event_id, event_type, value, (event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id)) AS same FROM events),
r AS (SELECT *, sum(CASE WHEN same AND event_type IN ('view', 'click') THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM g)
SELECT user_id, min(event_id) AS event_id, min(event_type) AS event_type, round(sum(value), 2) AS value, count(*) AS run_rows FROM r GROUP BY user_id, run""")
def merge_consecutive(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of the same view or click of a user become one row with the summed value."""
    rows = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    same = (F.col("event_type") == F.col("prev.event_type")) & F.col("event_type").isin("view", "click")
    merged = sheets.merge_consecutive(rows, ["user_id"], ["event_id"], same, F.shiftright("event_id", 12), {"value": F.col("value")})
    return merged.select("user_id", "event_id", "event_type", F.round("sum_value", 2).alias("value"), "run_rows")


@query("receivables_merge", """
WITH h AS (
  SELECT l_suppkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS p,
         l_returnflag = 'R' AS net, l_extendedprice AS v FROM lineitem),
g AS (SELECT *, net AND lag(net) OVER (PARTITION BY l_suppkey ORDER BY p) AS joins FROM h),
r AS (SELECT *, sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY l_suppkey ORDER BY p) AS run FROM g)
SELECT l_suppkey::VARCHAR AS supplier, count(*) AS merged_rows, round(sum(v), 2) AS value_total, round(max(v), 2) AS largest FROM (
  SELECT l_suppkey, run, sum(v) AS v FROM r GROUP BY 1, 2) GROUP BY 1""")
def receivables_merge(spark: SparkSession, sf: str) -> DataFrame:
    lines = placed_lines(spark, sf)
    none = F.lit(None)
    net = F.col("l_returnflag") == "R"
    rows = lines.select(
        F.lit("house").alias("amc"), F.lit("2026-05").alias("period"), F.lit("f.xlsx").alias("source_file"),
        F.col("l_suppkey").cast("string").alias("sheet"), F.col("l_suppkey").cast("int").alias("sheet_idx"), F.lit(0).alias("part"),
        F.col("pos").alias("row_idx"), scheme_name().alias("scheme_name_raw"), F.lit("Others").alias("section_header"),
        F.when(net, "Net Receivables / (Payables)").otherwise(F.col("p_name")).alias("security_name"),
        F.when(~net, F.col("code")).alias("isin"), none.cast("string").alias("industry_raw"),
        typed_cell(number=F.col("l_quantity")).alias("quantity"), typed_cell(number=F.col("l_extendedprice")).alias("market_value_raw"),
        typed_cell(number=F.lit(0.5)).alias("pct_raw"))
    merged = sheets.merge_receivables(rows).withColumn("v", cell_number(F.col("market_value_raw")))
    return merged.groupBy(F.col("sheet").alias("supplier")).agg(
        F.count(F.lit(1)).alias("merged_rows"), F.round(F.sum("v"), 2).alias("value_total"), F.round(F.max("v"), 2).alias("largest"))


@query("fixed_layout", """
SELECT l_suppkey::VARCHAR AS supplier, CASE WHEN rn % 2 = 0 THEN 'Certificate of Deposit' ELSE 'Debt Instruments' END AS section,
       count(*) AS holdings, round(sum(l_extendedprice), 2) AS value_total
FROM (SELECT l_suppkey, l_extendedprice, CASE WHEN row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) <= 5
             THEN 1 ELSE 2 END AS rn FROM lineitem) GROUP BY 1, 2""")
def fixed_layout(spark: SparkSession, sf: str) -> DataFrame:
    lines = placed_lines(spark, sf)
    body = row_of("77", typed_cell(text=F.col("p_name")), typed_cell(text=F.col("code")), "AAA", typed_cell(number=F.col("l_quantity")),
                  typed_cell(number=F.col("l_extendedprice")), 0.1)
    place = F.when(F.col("pos") < 5, F.col("pos") + 10).otherwise(F.col("pos") + 20)
    data = sheet_frame(lines, F.array(at(place, body)))
    frame = F.array(
        at(0, row_of(None, "Some Fund")), at(4, row_of(None, "Name of the Instrument", "ISIN")), at(5, row_of(None, "Debt Instruments")),
        at(6, row_of(None, "(a) Listed")), at(16, row_of(None, "Certificate of Deposit")), at(17, row_of(None, "unknown label")),
        at(LAST, row_of(None, "Total", None, None, None, 5.0)), at(LAST + 1, row_of(None, "Notes:")), at(LAST + 2, row_of(None, "later", None, None, 1.0)))
    held = layouts.parse_fixed_layout(sheet_frame(suppliers(spark, sf), frame).unionByName(data))
    return held.groupBy(F.substring("scheme_name_raw", 2, 20).alias("supplier"), F.col("section_header").alias("section")).agg(
        F.count(F.lit(1)).alias("holdings"), F.round(F.sum("market_value_raw.n"), 2).alias("value_total"))


@query("derivative_rows", """
WITH f AS (SELECT l_suppkey, l_quantity AS q, l_extendedprice AS v, l_partkey % 50 = 0 AS seen, l_returnflag = 'R' AS fut FROM lineitem)
SELECT l_suppkey::VARCHAR AS supplier, 'Scheme ' || l_suppkey || ' Fund (An open ended scheme)' AS scheme, count(*) FILTER (NOT seen) AS legs,
       round(coalesce(sum(v) FILTER (NOT seen), 0), 2) AS leg_value, round(-sum(v), 2) AS adjustment
FROM f WHERE fut GROUP BY l_suppkey""")
def derivative_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A disclosure under each supplier's sheet; positions the holdings already show are left out."""
    lines = placed_lines(spark, sf)
    body = row_of(typed_cell(text=F.col("p_name")), "Jun 2026", typed_cell(number=F.col("l_quantity")),
                  typed_cell(number=F.col("l_extendedprice")))
    place = F.when(F.col("l_returnflag") == "R", F.col("pos") + 4).otherwise(F.col("pos") + 1_000_000_000)
    data = sheet_frame(lines, F.array(at(place, body)))
    frame = F.array(
        at(0, row_of(typed_cell(text=F.concat(F.lit("DERIVATIVE DISCLOSURE - "), scheme_name())))),
        at(1, row_of("A. Hedging Positions through Futures as on 31-May-2026 :")),
        at(2, row_of("Underlying", "Series", "Long / (Short)", "Market value (Rs. in Lakhs)")),
        at(3, row_of("text only", "x", "y", "z")), at(999_999_999, row_of("B. Other than Hedging Positions through Futures")))
    cells = sheet_frame(suppliers(spark, sf), frame).unionByName(data)
    none = F.lit(None)
    place_cols = [F.lit("house").alias("amc"), F.lit("2026-05").alias("period"),
                  F.concat(F.lit("f"), F.col("l_suppkey") % 10, F.lit(".xlsx")).alias("source_file"),
                  F.concat(F.lit("S"), "l_suppkey").alias("sheet"), F.col("l_suppkey").cast("int").alias("sheet_idx"), F.lit(0).alias("part")]
    long_name = F.concat(scheme_name(), F.lit(" (An open ended scheme)")).alias("scheme_name_raw")
    lead = suppliers(spark, sf).select(*place_cols, F.lit(0).cast("bigint").alias("row_idx"), long_name,
                                       typed_cell(number=none).alias("quantity"), typed_cell(number=none).alias("market_value_raw"))
    seen = lines.filter("l_partkey % 50 = 0").select(*place_cols, (F.col("pos") + 1).alias("row_idx"), long_name,
                                                     typed_cell(number=F.col("l_quantity")).alias("quantity"),
                                                     typed_cell(number=F.col("l_extendedprice")).alias("market_value_raw"))
    found = derivatives.derivative_holdings(cells, lead.unionByName(seen))
    leg = F.col("section_header").isNotNull()
    value = F.col("market_value_raw.n")
    return found.groupBy(F.substring("sheet", 2, 20).alias("supplier"), F.col("scheme_name_raw").alias("scheme")).agg(
        F.count_if(leg).alias("legs"), F.round(F.coalesce(F.sum(F.when(leg, value)), F.lit(0.0)), 2).alias("leg_value"),
        F.round(F.sum(F.when(~leg, value)), 2).alias("adjustment"))
