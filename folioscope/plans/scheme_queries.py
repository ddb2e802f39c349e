"""Queries over scheme names, mappings and their audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import names as N
from folioscope.operators import mapping_audit as M
from folioscope.operators import schemes as S
from folioscope.plans.registry import query, table


def pick(k: Column, *values) -> Column:
    """values[k] without an array: the columns may differ in shape."""
    out = F.lit(None)
    for i, v in enumerate(values):
        out = F.when(k == i, v).otherwise(out)
    return out


@query("scheme_key", """
WITH p AS (SELECT p_partkey, p_name || ' ' || p_partkey AS n, upper(p_name) || ' ' || p_partkey AS u FROM part)
SELECT p_partkey, CASE p_partkey % 6 WHEN 4 THEN 'BHARAT BOND ETF APRIL 2030' WHEN 5 THEN u || ' FUND B' ELSE u END AS key FROM p""")
def scheme_key(spark: SparkSession, sf: str) -> DataFrame:
    n = F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string"))
    name = pick(F.col("p_partkey") % 6, F.concat(F.lit("IB01-"), n), F.concat(n, F.lit(" FOR JULY 2026")),
                F.concat(n, F.lit(" as on May 31, 2026")), F.concat(F.lit("  "), F.regexp_replace(n, " ", " - ")),
                F.lit("Bharat Bond ETF – April 2030"), F.concat(n, F.lit(" fund (B)")))
    return table(spark, sf, "part").select("p_partkey", N.scheme_key(name).alias("key"))


@query("class_suffix", """
WITH p AS (SELECT p_partkey, p_name || ' Growth ' || p_partkey || ' Fund' AS b FROM part)
SELECT p_partkey, b AS base, ([ 'Regular Plan Growth Option', 'Direct Plan Growth', 'Regular Plan', 'IDCW payout', '', 'Growth' ])[p_partkey % 6 + 1] AS suffix,
       CASE WHEN p_partkey % 6 IN (0, 2, 5) THEN 1 ELSE 0 END AS regular_growth, CASE WHEN p_partkey % 6 = 4 THEN 1 ELSE 0 END AS single FROM p""")
def class_suffix(spark: SparkSession, sf: str) -> DataFrame:
    tail = pick(F.col("p_partkey") % 6, " - Regular Plan - Growth Option", " (x) - Direct Plan - Growth", "-Regular Plan", " - IDCW payout", " (old)", " Growth")
    name = F.concat("p_name", F.lit(" Growth "), F.col("p_partkey").cast("string"), F.lit(" Fund"), tail)
    rows = table(spark, sf, "part").select("p_partkey", name.alias("name"))
    return rows.select(
        "p_partkey", N.base_scheme_name(F.col("name")).alias("base"), N.class_suffix(F.col("name")).alias("suffix"),
        N.is_regular_growth(F.col("name")).cast("int").alias("regular_growth"), N.is_single_class(F.col("name")).cast("int").alias("single"))


@query("digit_gate", """
SELECT l_returnflag, count(*) AS pairs, count(*) FILTER (l_partkey % 50 = l_suppkey % 50 OR l_partkey % 50 = l_linenumber) AS compatible
FROM lineitem GROUP BY 1""")
def digit_gate(spark: SparkSession, sf: str) -> DataFrame:
    t = F.concat(F.lit("SERIES "), (F.col("l_partkey") % 50).cast("string"), F.lit(" X "), F.col("l_linenumber").cast("string"))
    c = F.concat(F.lit("SERIES "), (F.col("l_suppkey") % 50).cast("string"), F.lit(" PLAN "), F.col("l_linenumber").cast("string"))
    rows = table(spark, sf, "lineitem").select("l_returnflag", N.digits_compatible(t, c).alias("ok"))
    return rows.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("pairs"), F.count_if("ok").alias("compatible"))


@query("house_mapping", """
WITH f AS (SELECT DISTINCT lower(c_mktsegment) || CASE WHEN c_nationkey % 3 = 0 THEN '' WHEN c_nationkey % 3 = 1 THEN '_old' ELSE '_x' END AS folder,
                  lower(c_mktsegment) AS seg FROM customer)
SELECT folder, upper(seg) || ' Mutual Fund' AS house FROM f""")
def house_mapping(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    tail = pick(F.col("c_nationkey") % 3, "", "_old", "_x")
    return S.map_house(c.select(F.concat(F.lower("c_mktsegment"), tail).alias("folder")),
                       c.select(F.concat(F.upper("c_mktsegment"), F.lit(" Mutual Fund")).alias("house")))


@query("house_mapping_strict", """
WITH f AS (SELECT DISTINCT lower(c_mktsegment) || CASE WHEN c_nationkey % 3 = 0 THEN '' WHEN c_nationkey % 3 = 1 THEN '_old' ELSE '' END AS folder,
                  CASE WHEN c_nationkey % 3 = 2 THEN 'z' ELSE '' END AS pre, upper(c_mktsegment) AS seg FROM customer)
SELECT pre || folder AS folder, CASE WHEN pre = 'z' THEN '' ELSE seg || ' Mutual Fund' END AS house FROM f""")
def house_mapping_strict(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    tail = pick(F.col("c_nationkey") % 3, "", "_old", "")
    folder = F.concat(F.when(F.col("c_nationkey") % 3 == 2, "z").otherwise(""), F.lower("c_mktsegment"), tail)
    return S.map_house_strict(c.select(folder.alias("folder")), c.select(F.concat(F.upper("c_mktsegment"), F.lit(" Mutual Fund")).alias("house")))


def candidate_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A house's scheme list made of its customers: regular growth, direct and single-class rows."""
    c = table(spark, sf, "customer")
    base = F.concat("c_mktsegment", F.lit(" Opportunities "), F.col("c_custkey").cast("string"), F.lit(" Fund"))
    tail = pick(F.col("c_custkey") % 4, " - Regular Plan - Growth", " - Direct Plan - Growth", "", " - Growth")
    return c.select(F.col("c_nationkey").cast("string").alias("house"), F.col("c_custkey").cast("string").alias("code"),
                    F.concat(base, tail).alias("name"), F.col("c_custkey").alias("ordinal"))


@query("scheme_candidates", """
SELECT c_nationkey::VARCHAR AS house, c_custkey::VARCHAR AS amfi_code, upper(c_mktsegment) || ' OPPORTUNITIES ' || c_custkey || ' FUND' AS base_norm
FROM customer WHERE c_custkey % 4 <> 1""")
def scheme_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return S.build_candidates(candidate_rows(spark, sf)).select("house", "amfi_code", "base_norm")


@query("match_scheme", """
SELECT c_nationkey::VARCHAR AS house, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment || ' Opportunities ' || c_custkey || ' Fund'
         ELSE c_mktsegment || ' Oportunity ' || c_custkey || ' Fd' END AS scheme_name_raw,
       CASE WHEN c_custkey % 4 <> 1 THEN c_custkey::VARCHAR END AS amfi_code,
       CASE WHEN c_custkey % 4 = 1 THEN 'none' WHEN c_custkey % 3 = 0 THEN 'equal' ELSE 'near' END AS how FROM customer""")
def match_scheme(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    key = F.col("c_custkey").cast("string")
    name = F.when(F.col("c_custkey") % 3 == 0, F.concat("c_mktsegment", F.lit(" Opportunities "), key, F.lit(" Fund"))).otherwise(
        F.concat("c_mktsegment", F.lit(" Oportunity "), key, F.lit(" Fd")))
    names = c.select(F.col("c_nationkey").cast("string").alias("house"), name.alias("scheme_name_raw"))
    out = S.match_scheme(names, S.build_candidates(candidate_rows(spark, sf)))
    how = F.when(F.col("score") == 1.0, "equal").when(F.col("score") > 0, "near").otherwise("none")
    return out.select("house", "scheme_name_raw", "amfi_code", how.alias("how"))


@query("unique_name_index", """
WITH k AS (SELECT upper(p_name) || ' ' || p_size || ' FUND' AS key, p_partkey, p_name || ' ' || p_size || ' Fund - ' || CASE WHEN p_partkey % 2 = 0 THEN 'Growth' ELSE 'Direct Plan' END AS n FROM part)
SELECT key, min(p_partkey)::VARCHAR AS code, min(n) AS fund_name FROM k GROUP BY 1 HAVING count(*) = 1""")
def unique_name_index(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat("p_name", F.lit(" "), F.col("p_size").cast("string"), F.lit(" Fund - "), F.when(F.col("p_partkey") % 2 == 0, "Growth").otherwise("Direct Plan"))
    codes = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("code"), name.alias("fund_name"))
    return S.unique_name_index(codes)


@query("reference_codes", """
WITH r AS (SELECT upper(p_name) || ' ' || p_size || ' FUND' AS key, min(p_partkey)::VARCHAR AS code FROM part GROUP BY 1 HAVING count(*) = 1)
SELECT p_partkey, coalesce(code, 'A' || p_partkey) AS amfi_code FROM part LEFT JOIN r ON key = upper(p_name) || ' ' || p_size || ' FUND'""")
def reference_codes(spark: SparkSession, sf: str) -> DataFrame:
    base = F.concat("p_name", F.lit(" "), F.col("p_size").cast("string"), F.lit(" Fund"))
    parts = table(spark, sf, "part")
    codes = parts.select(F.col("p_partkey").cast("string").alias("code"), F.concat(base, F.lit(" - Direct Plan")).alias("fund_name"))
    matches = parts.select("p_partkey", F.concat(F.lit("A"), F.col("p_partkey").cast("string")).alias("amfi_code"),
                           F.concat(base, F.lit(" - Regular Plan - Growth")).alias("fund_name"))
    return S.to_reference_code(matches, codes).select("p_partkey", "amfi_code")


@query("resolved_mapping", """
WITH m AS (SELECT c_nationkey::VARCHAR AS house, c_mktsegment AS k, c_acctbal, round(abs(c_acctbal) / 10000, 4) AS score, c_custkey FROM customer),
b AS (SELECT * FROM m WHERE score >= 0.82 QUALIFY row_number() OVER (PARTITION BY house, k ORDER BY score DESC, CASE WHEN c_custkey % 2 = 0 THEN 'IB01-' || k ELSE k END) = 1)
SELECT house, upper(k) AS match_key, score AS match_score FROM b""")
def resolved_mapping(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("house"),
        F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("IB01-"), "c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("scheme_name_raw"),
        F.col("c_custkey").cast("string").alias("amfi_code"), F.col("c_name").alias("fund_name"),
        F.round(F.abs("c_acctbal") / 10000, 4).alias("score"))
    matched, _ = S.resolve_schemes(rows)
    return S.collapse_mapping(matched).select("house", "match_key", "match_score")


@query("match_stats", """
SELECT coalesce(c_nationkey::VARCHAR, 'TOTAL') AS house, count(*) AS schemes_seen, count(*) FILTER (round(abs(c_acctbal) / 10000, 4) >= 0.82) AS matched,
       count(*) FILTER (round(abs(c_acctbal) / 10000, 4) < 0.82) AS review FROM customer GROUP BY ROLLUP (c_nationkey)""")
def match_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("house"), F.lit("x").alias("amfi_code"), F.round(F.abs("c_acctbal") / 10000, 4).alias("score"))
    return S.match_stats(rows).withColumn("house", F.coalesce("house", F.lit("TOTAL")))


@query("recent_scheme_names", """
WITH h AS (SELECT 'h' || l_suppkey % 20 AS amc, strftime(l_shipdate, '%Y-%m') AS period, l_suppkey || '-' || l_returnflag || l_linenumber AS s FROM lineitem),
p AS (SELECT amc, period FROM (SELECT DISTINCT amc, period FROM h) QUALIFY row_number() OVER (PARTITION BY amc ORDER BY period DESC) <= 6)
SELECT DISTINCT h.amc, h.s AS scheme_name_raw FROM h JOIN p USING (amc, period)""")
def recent_scheme_names(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(
        F.concat(F.lit("h"), F.col("l_suppkey") % 20).alias("amc"), F.date_format("l_shipdate", "yyyy-MM").alias("period"),
        F.concat(F.col("l_suppkey").cast("string"), F.lit("-"), "l_returnflag", F.col("l_linenumber").cast("string")).alias("scheme_name_raw"))
    return S.recent_scheme_names(rows)


# --- audit -----------------------------------------------------------------------------------

@query("comparable_tokens", """
SELECT p_partkey, upper(p_name) || ' ' || p_size || ' AND ' || p_partkey AS comparable,
       array_to_string(list_sort(list_distinct(list_filter(string_split(upper(p_name) || ' ' || p_size || ' ' || p_partkey, ' '),
         lambda t: t NOT IN ('FUND', 'AND')))), ' ') AS tokens FROM part""")
def comparable_tokens(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat("p_name", F.lit("  "), F.col("p_size").cast("string"), F.lit("&"), F.col("p_partkey").cast("string"),
                    F.lit(" (AN OPEN ENDED SCHEME INVESTING IN 99 THINGS)"))
    return table(spark, sf, "part").select("p_partkey", N.comparable_name(name).alias("comparable"), M.token_key(name).alias("tokens"))


@query("token_index", """
WITH k AS (SELECT p_partkey, p_name, array_to_string(list_sort(list_distinct(string_split(upper(p_name) || ' ' || p_size, ' '))), ' ') AS t FROM part)
SELECT t AS token_key, min(p_partkey)::VARCHAR AS code FROM k GROUP BY 1 HAVING count(*) = 1""")
def token_index(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.col("p_size").cast("string"), F.lit(" "), "p_name", F.lit(" Fund - Growth"))
    codes = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("code"), name.alias("fund_name"))
    return M.token_index(codes).select("token_key", "code")


def mapping_rows(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A mapping with every kind of mistake and the reference code list, from part."""
    parts = table(spark, sf, "part")
    k = F.col("p_partkey")
    own = F.concat("p_name", F.lit(" series "), k.cast("string"), F.lit(" fund"))
    code = pick(k % 6, F.lit(""), F.concat(F.lit("X"), k.cast("string")), (k + 1).cast("string"), k.cast("string"), k.cast("string"), k.cast("string"))
    mapping = parts.select(
        F.col("p_brand").alias("amc"), F.upper(F.regexp_replace(own, " fund$", "")).alias("match_key"), F.lit("sheet").alias("sheet_name"),
        code.alias("amfi_code"), F.when(k % 6 == 4, "old name").otherwise(own).alias("fund_name"), F.lit(0.9).alias("match_score"))
    codes = parts.select(k.cast("string").alias("code"), own.alias("fund_name"))
    return mapping, codes


AUDIT_SQL = """
m AS (
  SELECT p_partkey AS k, p_brand AS amc, upper(p_name || ' series ' || p_partkey) AS match_key,
         CASE p_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'X' || p_partkey WHEN 2 THEN (p_partkey + 1)::VARCHAR ELSE p_partkey::VARCHAR END AS code FROM part),
i AS (
  SELECT m.*, CASE k % 6 WHEN 0 THEN 'missing_code' WHEN 1 THEN 'not_in_icra' WHEN 4 THEN 'stale_name'
                         WHEN 2 THEN CASE WHEN r.p_partkey IS NULL THEN 'not_in_icra' ELSE 'wrong_scheme' END END AS kind,
         CASE WHEN k % 6 < 3 THEN k::VARCHAR ELSE '' END AS suggested
  FROM m LEFT JOIN part r ON r.p_partkey::VARCHAR = m.code),
d AS (SELECT amc, code FROM m WHERE code <> '' GROUP BY 1, 2 HAVING count(DISTINCT match_key) > 1),
issues AS (
  SELECT amc, kind, match_key, code, suggested FROM i WHERE kind IS NOT NULL
  UNION ALL SELECT i.amc, 'duplicate_code', match_key, i.code, suggested FROM i JOIN d ON d.amc = i.amc AND d.code = i.code)"""


@query("mapping_issues", f"WITH {AUDIT_SQL} SELECT amc, kind, match_key, code AS amfi_code, suggested AS suggested_code FROM issues")
def mapping_issues(spark: SparkSession, sf: str) -> DataFrame:
    return M.audit_mapping(*mapping_rows(spark, sf)).select("amc", "kind", "match_key", "amfi_code", "suggested_code")


@query("issue_summary", f"""
WITH {AUDIT_SQL}
SELECT coalesce(kind, 'TOTAL') AS kind, count(*) AS issues, count(*) FILTER (kind = 'stale_name' OR suggested <> '') AS fixable
FROM issues GROUP BY ROLLUP (kind)""")
def issue_summary(spark: SparkSession, sf: str) -> DataFrame:
    return M.issue_summary(M.audit_mapping(*mapping_rows(spark, sf))).withColumn("kind", F.coalesce("kind", F.lit("TOTAL")))


@query("mapping_fixes", """
SELECT p_brand AS amc, upper(p_name || ' series ' || p_partkey) AS match_key, p_partkey::VARCHAR AS amfi_code,
       p_name || ' series ' || p_partkey || ' fund' AS fund_name FROM part""")
def mapping_fixes(spark: SparkSession, sf: str) -> DataFrame:
    """Every planted mistake has a safe fix, so the fixed mapping is the true one."""
    mapping, codes = mapping_rows(spark, sf)
    return M.apply_fixes(mapping, M.audit_mapping(mapping, codes)).select("amc", "match_key", "amfi_code", "fund_name")


@query("duplicate_codes", """
WITH r AS (SELECT c_nationkey::VARCHAR AS amc, (c_custkey % 50)::VARCHAR || CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment ELSE '' END AS code,
                  CASE WHEN c_custkey % 2 = 0 THEN upper(c_mktsegment) || ' ' || c_custkey % 7
                       ELSE upper(c_mktsegment) || CASE WHEN c_custkey % 3 = 0 THEN ' FUND' ELSE '' END END AS k FROM customer),
m AS (SELECT amc, code FROM r WHERE code NOT SIMILAR TO '.*[A-Z]' GROUP BY 1, 2 HAVING count(DISTINCT k) > 1)
SELECT DISTINCT r.amc, r.code AS amfi_code, r.k AS match_key FROM r JOIN m USING (amc, code)""")
def duplicate_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Odd codes carry one scheme in several spellings, even codes carry different schemes."""
    c, even = table(spark, sf, "customer"), F.col("c_custkey") % 2 == 0
    spelled = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.upper("c_mktsegment"), F.lit(" FUND"))).otherwise(F.upper("c_mktsegment"))
    key = F.when(even, F.concat(F.upper("c_mktsegment"), F.lit(" "), (F.col("c_custkey") % 7).cast("string"))).otherwise(spelled)
    code = F.concat((F.col("c_custkey") % 50).cast("string"), F.when(even, "").otherwise(F.col("c_mktsegment")))
    rows = c.select(F.col("c_nationkey").cast("string").alias("amc"), code.alias("amfi_code"), key.alias("match_key"))
    return M.duplicate_codes(rows).distinct()
