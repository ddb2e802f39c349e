"""Queries over landed files, lists and manifests, printed from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions.periods import with_months
from folioscope.operators import coverage as A
from folioscope.operators import ledger as L
from folioscope.plans.registry import query, table
from folioscope.sources import tables as S
from folioscope.sources import workbooks as W


@query("workbook_selection", """
WITH f AS (SELECT source AS amc, '2026-0' || (doc_id % 5 + 1) AS period, doc_id, doc_id % 7 = 0 AS rollup, doc_id % 11 <> 0 AND doc_id % 13 <> 0 AS book FROM documents),
s AS (SELECT amc, period, count(*) FILTER (book AND NOT rollup) AS single FROM f GROUP BY 1, 2)
SELECT f.amc, f.period, count(*) AS files, count(*) FILTER (rollup) AS rollups FROM f JOIN s USING (amc, period)
WHERE book AND (NOT rollup OR single = 0) GROUP BY 1, 2""")
def workbook_selection(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("doc_id")
    name = F.concat(F.when(d % 13 == 0, ".tmp").otherwise("fund "), F.when(d % 7 == 0, " All_Schemes ").otherwise(" "), d.cast("string"),
                    F.when(d % 11 == 0, ".pdf").when(d % 2 == 0, ".XLSX").otherwise(".xls"))
    files = table(spark, sf, "documents").select(
        F.col("source").alias("amc"), F.concat(F.lit("2026-0"), (d % 5 + 1).cast("string")).alias("period"), name.alias("source_file"))
    return W.select_workbooks(files).groupBy("amc", "period").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("source_file").contains("All_Schemes")).alias("rollups"))


@query("monthly_file", """
WITH f AS (SELECT c_nationkey::VARCHAR AS amc, (2020 + c_custkey % 6) || '-05' AS period, c_custkey, c_custkey % 5 = 1 AS fits FROM customer),
s AS (SELECT amc, period, count(*) AS n, count(*) FILTER (fits) AS m FROM f GROUP BY 1, 2)
SELECT amc, period, CASE WHEN n = 1 OR m = 1 THEN 'chosen' ELSE 'ambiguous' END AS outcome FROM s""")
def monthly_file(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    year = (2020 + k % 6).cast("string")
    month = F.when(k % 5 == 1, "May_").otherwise("April_")
    files = table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("amc"), F.concat(year, F.lit("-05")).alias("period"),
        F.concat(F.lit("x"), k.cast("string"), F.lit("_MONTHLY_PORTFOLIO_"), month, year, F.lit("_Final.xlsx")).alias("source_file"))
    chosen, rejects = W.select_monthly_file(files)
    both = chosen.select("amc", "period", F.lit("chosen").alias("outcome")).unionByName(
        rejects.select("amc", "period", F.lit("ambiguous").alias("outcome")))
    return both.distinct()


@query("house_list", """
SELECT n_name || ' Mutual Fund' AS house, c_custkey::VARCHAR AS code, c_name || ' - Growth' AS name FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def house_list(spark: SparkSession, sf: str) -> DataFrame:
    """A ragged list: a house line, a category line, then the schemes of the house."""
    nation = table(spark, sf, "nation")
    heads = nation.select(F.col("n_nationkey").cast("bigint").alias("at"), F.explode(F.array(
        F.struct(F.lit(-2).cast("bigint").alias("n"), F.concat("n_name", F.lit(" Mutual Fund")).alias("t")),
        F.struct(F.lit(-1).cast("bigint").alias("n"), F.lit("Open Ended Schemes(Equity)").alias("t")))).alias("l"))
    rows = table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("bigint").alias("at"), F.col("c_custkey").alias("n"),
        F.concat_ws(";", F.col("c_custkey").cast("string"), F.lit("INF1"), F.lit("-"), F.concat(F.lit(" "), "c_name", F.lit(" - Growth ")), F.lit("1")).alias("t"))
    lines = heads.select("at", "l.*").unionByName(rows).select(
        F.lit("list").alias("file"), "at", F.col("n").alias("line_no"), F.col("t").alias("line"))
    return S.parse_house_list(lines).select("house", "code", "name")


@query("manifest_members", """
SELECT o_custkey % 50 || '-h' AS amc, 'u' || o_orderkey AS url, l_orderkey || '/' || l_linenumber || '.xlsx' AS path, count(*) AS times
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""")
def manifest_members(spark: SparkSession, sf: str) -> DataFrame:
    """One manifest document per order, its lines as archive members; parsed from JSON text and unrolled."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", F.concat(F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string"), F.lit(".xlsx")).alias("path"))
    members = lines.groupBy("l_orderkey").agg(F.collect_list(F.struct("path")).alias("extracted"))  # an order has few lines
    orders = table(spark, sf, "orders").select("o_orderkey", F.concat((F.col("o_custkey") % 50).cast("string"), F.lit("-h")).alias("amc"))
    docs = orders.join(members, F.col("o_orderkey") == F.col("l_orderkey"))
    entry = F.struct(F.struct(F.lit("z.zip").alias("name")).alias("archive"), F.col("extracted"))
    text = F.to_json(F.struct(F.create_map(F.concat(F.lit("u"), F.col("o_orderkey").cast("string")), entry).alias("downloads")))
    parsed = docs.select("amc", F.lit("2026-05").alias("period"), F.from_json(text, S.MANIFEST).alias("m"))
    out = S.explode_manifest(parsed)["members"]
    return out.groupBy("amc", "url", "path").agg(F.count(F.lit(1)).alias("times"))


@query("reference_schemes", """
SELECT CASE WHEN l_suppkey % 10 = 0 THEN '' ELSE l_suppkey::VARCHAR END AS amfi_code, 'Fund ' || l_suppkey % 40 AS fund_name, count(*) AS rows
FROM lineitem GROUP BY 1, 2""")
def reference_schemes(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("l_suppkey")
    ref = table(spark, sf, "lineitem").select(
        F.when(k % 10 == 0, "--").otherwise(F.concat(k.cast("string"), F.lit(".0"))).alias("amfi_code"),
        F.concat(F.lit(" Fund  "), (k % 40).cast("string")).alias("fund_name"))
    return S.reference_schemes(ref)


@query("future_cells", """
SELECT c_nationkey::VARCHAR AS amc, count(*) AS cells FROM (SELECT DISTINCT c_nationkey FROM customer), range(1, 13) t(m) WHERE m > 6 GROUP BY 1""")
def future_cells(spark: SparkSession, sf: str) -> DataFrame:
    houses = table(spark, sf, "customer").select(F.col("c_nationkey").cast("string").alias("amc")).distinct()
    return L.future_cells(with_months(houses, 2025, 2026), "2026-06").groupBy("amc").agg(F.count(F.lit(1)).alias("cells"))


@query("code_list_match", """
SELECT c_custkey::VARCHAR AS unit_id, CASE WHEN c_custkey % 3 = 0 THEN 'unmatched' ELSE 'matched' END AS status,
       CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'amfi_navall_code' END AS method,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Renamed ' || c_custkey || ' Opportunities Fund' END AS fund_name FROM customer""")
def code_list_match(spark: SparkSession, sf: str) -> DataFrame:
    """Units carry an old name the reference does not know; the code list leads from it to the scheme."""
    key = F.col("c_custkey").cast("string")
    c = table(spark, sf, "customer").select("c_custkey", F.concat(F.initcap("c_mktsegment"), F.lit(" Old "), key, F.lit(" Scheme")).alias("old"),
                                            (F.col("c_custkey") + 100000).cast("string").alias("code"),
                                            F.concat(F.lit("Renamed "), key, F.lit(" Opportunities Fund")).alias("new"))
    portfolio = c.select(F.col("code").alias("amfi_code"), F.col("new").alias("fund_name"))
    universe = A.build_universe(portfolio, c.limit(0).select(
        F.col("code").alias("amfi_code"), F.col("old").alias("scheme_name"), F.lit("").alias("mf_name")))
    listed = F.when(F.col("c_custkey") % 3 != 0, F.col("old")).otherwise(F.concat(F.lit("Withdrawn Plan "), key, F.lit(" Papers")))
    codes = A.house_code_keys(c.select("code", listed.alias("name")))
    units = c.select(F.col("c_custkey").cast("string").alias("unit_id"), F.lit("").alias("scope"), F.lit(None).cast("string").alias("printed_code"))
    texts = c.select(F.col("c_custkey").cast("string").alias("unit_id"), F.col("old").alias("raw"), F.lit("sheet:s:row0").alias("source"),
                     F.lit(100).alias("ord"), F.lit(True).alias("need_word"))
    keys = A.build_candidates(texts).withColumn("scope", F.lit(""))
    return A.match_units(units, keys, universe, codes).select("unit_id", "status", "method", "fund_name")
