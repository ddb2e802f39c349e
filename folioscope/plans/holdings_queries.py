"""Queries over holdings: scale, net assets, restated totals, conversion, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions.names import match_key, scheme_key
from folioscope.operators import convert as conv
from folioscope.operators import reconcile as rec
from folioscope.operators import sheets
from folioscope.plans.driver_tables import (
    LINE_ORDER, PART_CODE_SQL, WEIGHTED_SQL, coded_parts, line_block, ordered_lines, raw_holdings, weighted_lines,
)
from folioscope.plans.registry import query, table
from folioscope.scale import settle, tasks_for

R6 = 6


@query("scheme_pct_scale", f"""
WITH {WEIGHTED_SQL}, s AS (SELECT l_suppkey, sum(pct_num) AS t FROM w GROUP BY 1)
SELECT l_suppkey, round(t, 6) AS pct_sum,
       (CASE WHEN abs(t - 100) <= 20 THEN 1 WHEN abs(t - 1) <= 0.2 THEN 100 ELSE 1 END)::DOUBLE AS pct_scale,
       CASE WHEN abs(t - 100) <= 20 OR abs(t - 1) <= 0.2 THEN 0 ELSE 1 END AS abstained
FROM s""")
def scheme_pct_scale(spark: SparkSession, sf: str) -> DataFrame:
    out = conv.detect_pct_scale(weighted_lines(spark, sf), ["l_suppkey"])
    return out.select("l_suppkey", F.round("pct_sum", R6).alias("pct_sum"), "pct_scale",
                      F.col("scale_abstained").cast("int").alias("abstained"))


@query("scheme_implied_nav", f"""
WITH {WEIGHTED_SQL},
p AS (SELECT *, CASE WHEN l_linenumber <> 7 THEN pct_num END AS pct FROM w),
s AS (SELECT l_suppkey, sum(pct) AS t, sum(value_num) FILTER (pct IS NOT NULL) AS v FROM p GROUP BY 1),
k AS (SELECT *, t * CASE WHEN abs(t - 100) <= 20 THEN 1.0 WHEN abs(t - 1) <= 0.2 THEN 100.0 ELSE 1.0 END AS share FROM s)
SELECT l_suppkey, round(v / (share / 100.0), 2) AS implied_nav FROM k WHERE share > 1.0 AND v <> 0""")
def scheme_implied_nav(spark: SparkSession, sf: str) -> DataFrame:
    lines = weighted_lines(spark, sf, "l_linenumber")
    lines = lines.withColumn("pct_num", F.when(F.col("l_linenumber") != 7, F.col("pct_num")))
    return conv.implied_nav(lines, ["l_suppkey"]).withColumn("implied_nav", F.round("implied_nav", 2))


@query("holdings_finalize", f"""
WITH {WEIGHTED_SQL},
p AS (SELECT *, CASE WHEN l_linenumber <> 7 THEN pct_num END AS pct FROM w),
s AS (SELECT l_suppkey, sum(pct) AS t, sum(value_num) FILTER (pct IS NOT NULL) AS v FROM p GROUP BY 1),
k AS (SELECT *, CASE WHEN abs(t - 100) <= 20 THEN 1.0 WHEN abs(t - 1) <= 0.2 THEN 100.0 ELSE 1.0 END AS scale FROM s),
n AS (SELECT l_suppkey, scale, CASE WHEN t * scale > 1.0 AND v <> 0 THEN v / (t * scale / 100.0) END AS nav FROM k)
SELECT l_orderkey, l_linenumber, l_partkey, 'A' || lpad(s_suppkey::VARCHAR, 6, '0') AS amfi_code,
       round(coalesce(pct * scale, value_num / nav * 100.0), 6) AS corpus_per,
       value_num / 100 AS mkt_value, l_quantity AS no_of_shares, s_name AS fund_name
FROM p JOIN n USING (l_suppkey) JOIN supplier ON s_suppkey = l_suppkey
WHERE s_acctbal >= 0""")
def holdings_finalize(spark: SparkSession, sf: str) -> DataFrame:
    lines = weighted_lines(spark, sf, "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    lines = lines.withColumn("pct_num", F.when(F.col("l_linenumber") != 7, F.col("pct_num")))
    figures = conv.scheme_figures(lines, ["l_suppkey"])
    supplier = table(spark, sf, "supplier")
    mapping = supplier.filter("s_acctbal >= 0").select(
        F.lit("house").alias("amc"), scheme_key(F.col("s_name")).alias("match_key"),
        F.concat(F.lit("A"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("amfi_code"),
        F.col("s_name").alias("fund_name"))
    schemes = supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.lit("house").alias("amc"),
                              F.col("s_name").alias("scheme_name_raw"))
    mapped = conv.map_schemes(schemes, mapping).filter("amfi_code is not null")
    rows = lines.join(figures, "l_suppkey").join(mapped, "l_suppkey")
    pct = conv.corpus_percent(F.col("value_num"), F.col("pct_num"), F.col("pct_scale"), F.col("implied_nav"))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "amfi_code", F.round(pct, R6).alias("corpus_per"),
        (F.col("value_num") / 100).alias("mkt_value"), F.col("l_quantity").alias("no_of_shares"), "fund_name")


@query("restated_totals", """
WITH l AS (
  SELECT l_suppkey, l_extendedprice AS v, row_number() OVER (
           PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS pos
  FROM lineitem),
cum AS (SELECT *, sum(v) OVER (PARTITION BY l_suppkey ORDER BY pos) AS p FROM l),
heads AS (
  SELECT h.l_suppkey, h.pos, h.p - h.v AS base,
         CASE WHEN h.l_suppkey % 3 = 0 THEN (t.p - h.p + h.v) * 2 ELSE t.p - h.p + h.v END AS own
  FROM cum h JOIN cum t ON t.l_suppkey = h.l_suppkey AND t.pos = h.pos + 6
  WHERE h.pos % 40 = 0),
stops AS (
  SELECT heads.l_suppkey, heads.pos, own, min(cum.pos) AS stop
  FROM heads LEFT JOIN cum ON cum.l_suppkey = heads.l_suppkey AND cum.pos >= heads.pos
       AND cum.p - base >= own * 0.995
  GROUP BY heads.l_suppkey, heads.pos, own, base)
SELECT s.l_suppkey, s.pos, round(s.own, 2) AS own,
       CASE WHEN stop IS NOT NULL AND abs((cum.p - base) - s.own) <= 0.005 * s.own THEN 1 ELSE 0 END AS is_restated
FROM stops s JOIN heads h ON h.l_suppkey = s.l_suppkey AND h.pos = s.pos
LEFT JOIN cum ON cum.l_suppkey = s.l_suppkey AND cum.pos = s.stop""")
def restated_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Every 40th row of a supplier gets a header that restates (or overstates) the seven rows below it."""
    lines = ordered_lines(spark, sf)
    block = F.shiftright("pos", 12)
    cum = conv.ordered_scan(lines.select("l_suppkey", "pos", F.col("l_extendedprice").alias("v")),
                            ["l_suppkey"], ["pos"], block, sums={"p": F.col("v")})
    start = cum.filter("pos % 40 = 0").select("l_suppkey", "pos", (F.col("p") - F.col("v")).alias("base"))
    end = cum.filter("pos % 40 = 6").select("l_suppkey", (F.col("pos") - 6).alias("pos"), "p")
    own = (F.col("p") - F.col("base")) * F.when(F.col("l_suppkey") % 3 == 0, 2.0).otherwise(1.0)
    heads = start.join(end, ["l_suppkey", "pos"]).select(
        "l_suppkey", (F.col("pos") * 2).alias("ord"), own.alias("value_num"), F.lit(False).alias("identifiable"))
    body = lines.select("l_suppkey", (F.col("pos") * 2 + 1).alias("ord"), F.col("l_extendedprice").alias("value_num"),
                        F.lit(True).alias("identifiable"))
    printed = settle(heads.unionByName(body))  # read by the search and by the marking
    marked = conv.mark_restated_totals(printed, ["l_suppkey"])
    return marked.filter("not identifiable").select(
        "l_suppkey", (F.col("ord") / 2).cast("bigint").alias("pos"), F.round("value_num", 2).alias("own"),
        F.col("is_restated").cast("int").alias("is_restated"))


def part_lookups(spark: SparkSession, sf: str) -> conv.Lookups:
    """Conversion lookups made from part and supplier."""
    parts = coded_parts(spark, sf)
    blank = [F.lit("").alias(c) for c in ("basic_industry", "industry", "sector_name", "macro_economic_sector")]
    supplier = table(spark, sf, "supplier")
    variants = parts.groupBy(F.col("code").alias("isin"), F.col("p_name").alias("name")).agg(
        F.lit(2).cast("bigint").alias("count"))
    return conv.Lookups(
        mapping=supplier.filter("s_suppkey % 5 <> 0").select(
            F.concat(F.lit("house_"), "s_nationkey").alias("amc"), scheme_key(F.col("s_name")).alias("match_key"),
            F.col("s_suppkey").cast("string").alias("amfi_code"), F.col("s_name").alias("fund_name")),
        classification=parts.filter("p_partkey % 3 <> 0").select(
            F.col("code").alias("isin"), F.col("p_type").alias("instrument_name"), F.col("p_brand").alias("nature_name"), *blank),
        aliases=parts.filter("p_partkey % 11 = 1").select(
            F.col("code").alias("isin_in_amc_file"), F.reverse("code").alias("isin_in_icra")),
        names=parts.filter("p_partkey % 4 <> 1").select(F.col("code").alias("isin"), F.col("p_name").alias("canonical_name")),
        variants=variants.withColumn("match_key", match_key(F.col("name"))).withColumn(
            "count", F.when(F.substring("isin", 9, 1).isin("1", "2", "3"), 2).otherwise(5).cast("bigint")),
    )


LOOKUP_SQL = f"""
WITH {PART_CODE_SQL},
lines AS (
  SELECT l.*, l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_suppkey)
         * CASE WHEN l_suppkey % 2 = 0 THEN 1.0 ELSE 100.0 END AS share FROM lineitem l),
h AS (
  SELECT 'house_' || s_nationkey AS amc, l_suppkey, s_name, p_name, p_partkey, l_extendedprice AS value_num,
         l_returnflag = 'R' AND l_linenumber = 1 AS future,
         CASE WHEN p_partkey % 10 <> 0 THEN code END AS isin,
         CASE WHEN NOT (l_returnflag = 'R' AND l_linenumber = 1) THEN share END AS pct_num
  FROM lines JOIN coded ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey),
seed AS (SELECT code, p_type AS i, p_brand AS n FROM coded WHERE p_partkey % 3 <> 0),
keys AS (
  SELECT k, i, n FROM (
    SELECT k, i, n, row_number() OVER (PARTITION BY k ORDER BY c DESC, i, n) AS r FROM (
      SELECT substr(code, 1, 3) || substr(code, 8, 2) AS k, i, n, count(*) AS c FROM seed GROUP BY 1, 2, 3))
  WHERE r = 1),
alias AS (SELECT code AS a, reverse(code) AS b FROM coded WHERE p_partkey % 11 = 1),
names AS (SELECT code, p_name AS nm FROM coded WHERE p_partkey % 4 <> 1),
byname AS (
  SELECT mk, code FROM (
    SELECT mk, code, n, row_number() OVER (PARTITION BY mk ORDER BY n DESC, code) AS r FROM (
      SELECT regexp_replace(upper(p_name), '[^A-Z0-9]+', '', 'g') AS mk, code,
             CASE WHEN substr(code, 9, 1) IN ('1', '2', '3') THEN 2 ELSE 5 END AS n FROM coded))
  WHERE r = 1 AND n >= 3),
c AS (
  SELECT h.*, byname.code AS name_isin, alias.b AS alias_isin,
         CASE WHEN h.isin IS NOT NULL AND NOT future THEN coalesce(alias.b, h.isin)
              WHEN NOT future THEN byname.code END AS out_isin
  FROM h LEFT JOIN byname ON byname.mk = regexp_replace(upper(p_name), '[^A-Z0-9]+', '', 'g')
  LEFT JOIN alias ON alias.a = h.isin),
o AS (
  SELECT c.*, c.isin IS NOT NULL AND NOT future AS printed, nm,
         coalesce(s1.i, k1.i) AS ti, CASE WHEN s1.i IS NOT NULL THEN s1.n ELSE k1.n END AS tn,
         coalesce(s2.i, k2.i) AS oi, CASE WHEN s2.i IS NOT NULL THEN s2.n ELSE k2.n END AS onn,
         l_suppkey % 5 <> 0 AS mapped
  FROM c LEFT JOIN seed s1 ON s1.code = out_isin
  LEFT JOIN keys k1 ON k1.k = substr(out_isin, 1, 3) || substr(out_isin, 8, 2)
  LEFT JOIN seed s2 ON s2.code = c.isin AND alias_isin IS NOT NULL
  LEFT JOIN keys k2 ON k2.k = substr(c.isin, 1, 3) || substr(c.isin, 8, 2) AND alias_isin IS NOT NULL
  LEFT JOIN names ON names.code = out_isin),
f AS (
  SELECT *, CASE WHEN future THEN 'Futures' WHEN printed THEN coalesce(ti, oi, 'Undisclosed - Others')
                 WHEN out_isin IS NOT NULL THEN coalesce(ti, 'Undisclosed - Others')
                 ELSE 'Undisclosed - Others' END AS instrument,
         CASE WHEN future THEN 'EQ' WHEN printed AND ti IS NOT NULL THEN tn WHEN printed AND oi IS NOT NULL THEN onn
              WHEN out_isin IS NOT NULL AND NOT printed AND ti IS NOT NULL THEN tn ELSE 'Others' END AS nature,
         (printed AND ti IS NULL AND oi IS NULL) OR (NOT printed AND NOT future AND out_isin IS NULL) AS tagged,
         printed AND nm IS NULL AS blank_name
  FROM o)"""


@query("convert_report", LOOKUP_SQL + """,
g AS (SELECT l_suppkey, sum(pct_num) AS t FROM h GROUP BY 1)
SELECT amc, count(*) AS total, count(*) FILTER (mapped) AS converted, count(*) FILTER (NOT mapped) AS unmapped_schemes,
       count(*) FILTER (mapped AND tagged) AS tagged_isin, count(*) FILTER (mapped AND blank_name) AS blank_security_name,
       0::BIGINT AS not_a_holding,
       count(DISTINCT CASE WHEN NOT (abs(t - 100) <= 20 OR abs(t - 1) <= 0.2) THEN l_suppkey END) AS pct_scale_abstained
FROM f JOIN g USING (l_suppkey) GROUP BY amc""")
def convert_report(spark: SparkSession, sf: str) -> DataFrame:
    tagged = conv.tag_holdings(raw_holdings(spark, sf), part_lookups(spark, sf))
    return conv.convert_report(tagged).drop("period")


@query("classify_cascade", LOOKUP_SQL + """
SELECT amc, instrument, nature, count(*) AS holdings, count(DISTINCT out_isin) AS codes,
       round(sum(value_num), 2) AS value_total,
       count(*) FILTER (future OR NOT (printed OR out_isin IS NOT NULL)) AS without_code
FROM f WHERE mapped GROUP BY amc, instrument, nature""")
def classify_cascade(spark: SparkSession, sf: str) -> DataFrame:
    look = part_lookups(spark, sf)
    rows = conv.with_identity(conv.with_numbers(raw_holdings(spark, sf)), look)
    done = conv.classify_holdings(conv.map_schemes(rows, look.mapping).filter("amfi_code is not null"), look)
    return done.groupBy("amc", "instrument", "nature").agg(
        F.count(F.lit(1)).alias("holdings"), F.count_distinct("out_isin").alias("codes"),
        F.round(F.sum("value_num"), 2).alias("value_total"),
        F.count_if(F.col("out_isin").isNull()).alias("without_code"))


# --- reconciliation ------------------------------------------------------------------------------

RECONCILE_SQL = """
WITH ours AS (
  SELECT l_suppkey AS amfi_code, 'P' || l_partkey AS isin,
         l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_suppkey) * 100
           * CASE WHEN l_suppkey % 9 = 0 THEN 0.9 ELSE 1 END AS corpus_per,
         l_extendedprice / 100 AS mkt_value, l_partkey % 13 = 0 AS tagged FROM lineitem),
ref AS (
  SELECT l_suppkey AS amfi_code, CASE WHEN l_suppkey % 4 = 0 AND l_partkey % 50 = 0 THEN 'Q' ELSE 'P' END || l_partkey AS isin,
         l_extendedprice / 100 AS mkt_value
  FROM lineitem WHERE NOT (l_suppkey % 3 = 0 AND l_linenumber = 7)),
d AS (
  SELECT amfi_code, count(*) FILTER (o = 1 AND r = 0) AS only_ours, count(*) FILTER (r = 1 AND o = 0) AS only_ref FROM (
    SELECT amfi_code, isin, max(o) AS o, max(r) AS r FROM (
      SELECT amfi_code, isin, 1 AS o, 0 AS r FROM ours UNION ALL
      SELECT amfi_code, isin, 0, 1 FROM ref) GROUP BY 1, 2) GROUP BY 1),
j AS (
  SELECT a.amfi_code, our_rows, ref_rows, our_corpus, our_value, ref_value, only_ours, only_ref, tagged
  FROM (SELECT amfi_code, count(*) AS our_rows, sum(corpus_per) AS our_corpus, sum(mkt_value) AS our_value,
               count(*) FILTER (tagged) AS tagged FROM ours GROUP BY 1) a
  JOIN (SELECT amfi_code, count(*) AS ref_rows, sum(mkt_value) AS ref_value FROM ref GROUP BY 1) b USING (amfi_code)
  JOIN d USING (amfi_code)),
k AS (
  SELECT *, (our_rows <> ref_rows)::INT AS f_rows, (abs(our_corpus - 100) >= 1)::INT AS f_corpus,
         (abs(our_value - ref_value) / greatest(abs(ref_value), 1e-9) >= 0.01)::INT AS f_value,
         (only_ours > 0 OR only_ref > 0)::INT AS f_isins FROM j)"""


def line_tasks(spark: SparkSession, sf: str) -> int:
    """Tasks for a shuffle of all lines; the count is read from the files' footers."""
    return tasks_for(table(spark, sf, "lineitem").count(), spark)


def reconcile_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_linenumber", "l_extendedprice")
    ours = conv.with_group_totals(lines, ["l_suppkey"], {"total": F.sum("l_extendedprice")})
    short = F.when(F.col("l_suppkey") % 9 == 0, 0.9).otherwise(1.0)
    ours = ours.select(
        F.col("l_suppkey").alias("amfi_code"), F.concat(F.lit("P"), "l_partkey").alias("isin"),
        (F.col("l_extendedprice") / F.col("total") * 100 * short).alias("corpus_per"),
        (F.col("l_extendedprice") / 100).alias("mkt_value"), F.lit("fund").alias("fund_name"),
        F.when(F.col("l_partkey") % 13 == 0, "Undisclosed - Others").otherwise("Equity").alias("instrument_name"))
    moved = (F.col("l_suppkey") % 4 == 0) & (F.col("l_partkey") % 50 == 0)
    ref = lines.filter("not (l_suppkey % 3 = 0 and l_linenumber = 7)").select(
        F.col("l_suppkey").alias("amfi_code"), F.concat(F.when(moved, "Q").otherwise("P"), "l_partkey").alias("isin"),
        F.lit(0.0).alias("corpus_per"), (F.col("l_extendedprice") / 100).alias("mkt_value"))
    return ours, ref


@query("reconcile_schemes", RECONCILE_SQL + """
SELECT amfi_code, our_rows, ref_rows, round(our_corpus, 6) AS our_corpus, round(our_value, 4) AS our_value,
       round(ref_value, 4) AS ref_value, only_ours, only_ref, tagged,
       concat_ws(',', CASE WHEN f_rows = 1 THEN 'row_count' END, CASE WHEN f_corpus = 1 THEN 'corpus_sum' END,
                 CASE WHEN f_value = 1 THEN 'market_value' END, CASE WHEN f_isins = 1 THEN 'isins' END) AS failed,
       CASE WHEN f_rows + f_corpus + f_value + f_isins = 0 THEN 1 ELSE 0 END AS ok
FROM k""")
def reconcile_schemes(spark: SparkSession, sf: str) -> DataFrame:
    out = rec.reconcile(*reconcile_inputs(spark, sf), tasks=line_tasks(spark, sf))
    return out.select(
        "amfi_code", "our_rows", "ref_rows", F.round("our_corpus", R6).alias("our_corpus"),
        F.round("our_value", 4).alias("our_value"), F.round("ref_value", 4).alias("ref_value"), "only_ours", "only_ref",
        "tagged", F.array_join(rec.failed_checks(), ",").alias("failed"), rec.scheme_ok().cast("int").alias("ok"))


@query("isin_differences", RECONCILE_SQL + """
SELECT amfi_code, isin, side FROM (
  SELECT amfi_code, isin, CASE WHEN max(o) = 1 THEN 'ours' ELSE 'reference' END AS side FROM (
    SELECT amfi_code, isin, 1 AS o, 0 AS r FROM ours UNION ALL SELECT amfi_code, isin, 0, 1 FROM ref)
  GROUP BY 1, 2 HAVING max(o) <> max(r))""")
def isin_differences(spark: SparkSession, sf: str) -> DataFrame:
    return rec.isin_differences(*reconcile_inputs(spark, sf), tasks=line_tasks(spark, sf))


@query("house_diagnosis", RECONCILE_SQL + """
SELECT coalesce(n_name, 'TOTAL') AS house, count(*) AS schemes_checked,
       count(*) FILTER (f_rows + f_corpus + f_value + f_isins = 0) AS schemes_passed,
       sum(f_rows)::BIGINT AS fail_row_count, sum(f_corpus)::BIGINT AS fail_corpus_sum,
       sum(f_value)::BIGINT AS fail_market_value, sum(f_isins)::BIGINT AS fail_isins,
       round(sum(our_value) / sum(ref_value), 6) AS value_ratio
FROM k JOIN supplier ON s_suppkey = amfi_code JOIN nation ON n_nationkey = s_nationkey
GROUP BY ROLLUP (n_name)""")
def house_diagnosis(spark: SparkSession, sf: str) -> DataFrame:
    houses = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(F.col("s_suppkey").alias("amfi_code"), F.col("n_name").alias("house"))
    checks = rec.reconcile(*reconcile_inputs(spark, sf), tasks=line_tasks(spark, sf)).join(houses, "amfi_code")
    out = rec.diagnose(checks, "house")
    return out.withColumns({"house": F.coalesce("house", F.lit("TOTAL")), "value_ratio": F.round("value_ratio", R6)})


@query("run_summary", """
WITH c AS (
  SELECT 'house_' || s_nationkey AS amc, strftime(l_shipdate, '%Y-%m') AS period, l_suppkey,
         count(*) AS rows_, count(*) FILTER (s_acctbal < 0) AS unmapped
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2, 3)
SELECT amc, period, 'house_month' AS row_kind, sum(rows_)::BIGINT AS total, sum(unmapped)::BIGINT AS unmapped, count(*) AS schemes
FROM c GROUP BY 1, 2
UNION ALL
SELECT NULL, NULL, 'total', sum(rows_)::BIGINT, sum(unmapped)::BIGINT, count(*) FROM c""")
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    supplier = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.concat(F.lit("house_"), "s_nationkey").alias("amc"), "s_acctbal")
    lines = table(spark, sf, "lineitem").select("l_suppkey", F.date_format("l_shipdate", "yyyy-MM").alias("period"))
    per_scheme = lines.groupBy("l_suppkey", "period").agg(F.count(F.lit(1)).alias("n")).join(supplier, "l_suppkey")
    reports = per_scheme.groupBy("amc", "period").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("s_acctbal") < 0, F.col("n")).otherwise(0)).alias("unmapped"),
        F.count(F.lit(1)).alias("schemes"))
    return rec.run_summary(reports)


ALIAS_SQL = """
WITH base AS (
  SELECT l_suppkey AS amfi_code, l_partkey, l_quantity AS quantity, l_extendedprice AS mkt_value,
         l_orderkey * 8 + l_linenumber AS oid FROM lineitem),
ours AS (SELECT amfi_code, 'P' || l_partkey AS isin, quantity, mkt_value, l_partkey, oid FROM base),
ref AS (
  SELECT amfi_code, CASE WHEN l_partkey % 20 = 0 THEN 'Q' ELSE 'P' END || l_partkey AS isin, quantity,
         CASE WHEN l_partkey % 40 = 0 THEN mkt_value * 1.002 ELSE mkt_value * 1.0005 END AS mkt_value FROM base),
oo AS (SELECT DISTINCT * FROM ours WHERE (amfi_code, isin) NOT IN (SELECT amfi_code, isin FROM ref)),
rr AS (SELECT DISTINCT * FROM ref WHERE (amfi_code, isin) NOT IN (SELECT amfi_code, isin FROM ours))"""


@query("alias_tolerance", ALIAS_SQL + """
SELECT oo.amfi_code, oo.isin, round(oo.quantity, 2) AS quantity, round(oo.mkt_value, 2) AS mkt_value, count(*) AS close_codes
FROM oo JOIN rr ON oo.amfi_code = rr.amfi_code
  AND abs(oo.quantity - rr.quantity) / greatest(abs(oo.quantity), abs(rr.quantity), 1e-9) <= 0.001
  AND abs(oo.mkt_value - rr.mkt_value) / greatest(abs(oo.mkt_value), abs(rr.mkt_value), 1e-9) <= 0.001
GROUP BY oo.amfi_code, oo.isin, oo.quantity, oo.mkt_value, oo.oid""")
def alias_tolerance(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of ours with at least one close code on the other side.

    Copies are folded into one point per chain and side first, so only different points meet.
    """
    ours, ref = alias_inputs(spark, sf)
    rows = rec.alias_pairs(ours, ref)
    point = ["amfi_code", "value_chain", "quantity_chain", "quantity", "mkt_value"]
    mine = rows.filter("side = 'ours'").drop("side")
    theirs = rows.filter("side = 'reference'").groupBy(*point).agg(F.count(F.lit(1)).alias("copies")).withColumnsRenamed(
        {"quantity": "r_quantity", "mkt_value": "r_value"})
    near = rec.close_to(F.col("quantity"), F.col("r_quantity")) & rec.close_to(F.col("mkt_value"), F.col("r_value"))
    close = mine.select(*point).distinct().join(theirs, point[:3]).filter(near).groupBy(*point).agg(
        F.sum("copies").alias("close_codes"))
    return mine.join(close, point).select("amfi_code", "isin", "quantity", "mkt_value", "close_codes")


def alias_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    base = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("amfi_code"), "l_partkey", F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("mkt_value"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"))
    ours = base.withColumn("isin", F.concat(F.lit("P"), "l_partkey")).drop("l_partkey").dropDuplicates()
    moved = F.when(F.col("l_partkey") % 20 == 0, "Q").otherwise("P")
    drift = F.when(F.col("l_partkey") % 40 == 0, 1.002).otherwise(1.0005)
    ref = base.withColumns({"isin": F.concat(moved, "l_partkey"), "mkt_value": F.col("mkt_value") * drift})
    return ours, ref.drop("l_partkey").dropDuplicates()


@query("alias_candidates", """
WITH RECURSIVE base AS (
  SELECT DISTINCT l_suppkey AS amfi_code, l_partkey, l_quantity AS quantity, l_extendedprice AS mkt_value, l_orderkey * 8 + l_linenumber AS row_id
  FROM lineitem),
ref AS (
  SELECT amfi_code, CASE WHEN l_partkey % 20 = 0 THEN 'Q' ELSE 'P' END || l_partkey AS isin, quantity, row_id,
         mkt_value * CASE WHEN l_partkey % 40 = 0 THEN 1.002 ELSE 1.0005 END AS mkt_value FROM base),
only_ref AS (SELECT * FROM ref WHERE isin LIKE 'Q%'),
only_ours AS (
  SELECT amfi_code, 'P' || l_partkey AS isin, quantity, mkt_value, row_id, row_number() OVER (PARTITION BY amfi_code ORDER BY row_id, l_partkey) AS n
  FROM base WHERE l_partkey % 20 = 0),
wishes AS (
  SELECT o.amfi_code, o.n, r.isin, min(r.row_id) AS spot, arg_min(r.mkt_value, r.row_id) AS ref_value
  FROM only_ours o JOIN only_ref r ON r.amfi_code = o.amfi_code
    AND (abs(o.quantity - r.quantity) / greatest(abs(o.quantity), abs(r.quantity), 1e-9) <= 0.001 OR (o.quantity = 0 AND r.quantity = 0))
    AND (abs(o.mkt_value - r.mkt_value) / greatest(abs(o.mkt_value), abs(r.mkt_value), 1e-9) <= 0.001 OR (o.mkt_value = 0 AND r.mkt_value = 0))
  GROUP BY ALL),
lists AS (SELECT amfi_code, n, list(isin ORDER BY spot, isin) AS wanted FROM wishes GROUP BY ALL),
walk AS (
  SELECT amfi_code, 0::BIGINT AS n, NULL::VARCHAR AS taken, []::VARCHAR[] AS used FROM (SELECT DISTINCT amfi_code FROM only_ours)
  UNION ALL
  SELECT w.amfi_code, o.n, list_filter(coalesce(l.wanted, []), lambda x: NOT list_contains(w.used, x))[1],
         w.used || list_filter(coalesce(l.wanted, []), lambda x: NOT list_contains(w.used, x))[:1]
  FROM walk w JOIN only_ours o ON o.amfi_code = w.amfi_code AND o.n = w.n + 1 LEFT JOIN lists l ON l.amfi_code = o.amfi_code AND l.n = o.n)
SELECT 'house ' || (o.amfi_code % 5) AS amc, o.amfi_code, 'fund ' || o.amfi_code AS fund_name, o.isin AS isin_in_amc_file, w.taken AS isin_in_icra,
       CASE WHEN o.row_id % 3 = 0 THEN 'fund ' || o.amfi_code ELSE 'paper ' || substr(o.isin, 2) END AS security_name,
       o.quantity, round(o.mkt_value, 2) AS mkt_value_ours, round(s.ref_value, 2) AS mkt_value_icra
FROM walk w JOIN only_ours o ON o.amfi_code = w.amfi_code AND o.n = w.n JOIN wishes s ON s.amfi_code = o.amfi_code AND s.n = o.n AND s.isin = w.taken""")
def alias_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Every third row of ours has no security name; the reference's fund stands in."""
    ours, ref = alias_inputs(spark, sf)
    fund = F.concat(F.lit("fund "), F.col("amfi_code").cast("string"))
    paper = F.when(F.col("row_id") % 3 == 0, "").otherwise(F.concat(F.lit("paper "), F.expr("substr(isin, 2)")))
    ours = ours.withColumns({"amc": F.concat(F.lit("house "), (F.col("amfi_code") % 5).cast("string")), "fund_name": fund, "security_name": paper})
    out = rec.alias_candidates(ours, ref.withColumn("fund_name", fund))
    return out.withColumns({c: F.round(c, 2) for c in ("mkt_value_ours", "mkt_value_icra")})


@query("self_checks", """
WITH t AS (
  SELECT l_suppkey, l_extendedprice AS v, sum(l_extendedprice) OVER (PARTITION BY l_suppkey) AS total,
         l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_suppkey) * 100
           + CASE WHEN l_linenumber = 7 THEN 0.5 ELSE 0 END AS pct FROM lineitem)
SELECT l_suppkey, count(*) AS holdings, round(max(total), 2) AS value_total,
       count(*) FILTER (abs(pct - v / total * 100) > 0.01) AS rows_off FROM t GROUP BY 1""")
def self_checks(spark: SparkSession, sf: str) -> DataFrame:
    lines = weighted_lines(spark, sf, "l_linenumber")
    off = F.when(F.col("l_linenumber") == 7, 0.5).otherwise(0.0)
    lines = lines.withColumns({"mkt_value": F.col("value_num"),
                               "corpus_per": F.col("value_num") / F.col("total") * 100 + off})
    out = rec.self_checks(lines.select("l_suppkey", "mkt_value", "corpus_per"), ["l_suppkey"])
    return out.withColumn("value_total", F.round("value_total", 2))


# --- clean-up of a scheme's rows ------------------------------------------------------------------------

@query("repeated_labels", """
WITH l AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, p_name, l_partkey % 10 <> 0 AS coded FROM lineitem
           JOIN part ON p_partkey = l_partkey),
r AS (SELECT l_suppkey, lower(p_name) AS k FROM l WHERE NOT coded GROUP BY 1, 2 HAVING count(*) > 1)
SELECT l.l_suppkey, count(*) AS kept, count(*) FILTER (NOT coded) AS kept_uncoded FROM l
LEFT JOIN r ON r.l_suppkey = l.l_suppkey AND r.k = lower(p_name) AND NOT coded
WHERE r.k IS NULL GROUP BY 1""")
def repeated_labels(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey").join(parts, "l_partkey")
    rows = lines.select(
        "l_suppkey", F.col("p_name").alias("security_name"), F.lit("").alias("section_header"),
        F.when(F.col("l_partkey") % 10 != 0, F.col("l_partkey").cast("string")).alias("isin"))
    kept = sheets.drop_repeated_labels(rows, None, ("l_suppkey",))
    return kept.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("kept"),
                                         F.count_if(F.col("isin").isNull()).alias("kept_uncoded"))


@query("duplicate_blocks", """
SELECT l_suppkey, count(*) AS kept, round(sum(l_extendedprice), 2) AS value_total,
       CASE WHEN l_suppkey % 3 = 0 THEN 3 WHEN l_suppkey % 2 = 0 THEN 2 ELSE 1 END AS copies
FROM lineitem GROUP BY 1""")
def duplicate_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Every third supplier is printed three times over, every second one twice."""
    lines = weighted_lines(spark, sf, *LINE_ORDER)
    copies = F.when(F.col("l_suppkey") % 3 == 0, 3).when(F.col("l_suppkey") % 2 == 0, 2).otherwise(1)
    printed = lines.withColumn("copies", copies).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    pct = F.col("l_extendedprice") / F.col("total") * F.when(F.col("l_suppkey") % 5 == 0, 1.0).otherwise(100.0)
    printed = printed.select("l_suppkey", "copies", "copy", *LINE_ORDER, pct.alias("pct"))
    kept = sheets.drop_duplicate_blocks(
        printed, ("l_suppkey",), ("copy", *LINE_ORDER), F.struct("copy", line_block()),
        (F.col("l_partkey"), F.col("l_extendedprice")), F.col("pct"))
    return kept.groupBy("l_suppkey", "copies").agg(
        F.count(F.lit(1)).alias("kept"), F.round(F.sum("l_extendedprice"), 2).alias("value_total"))


# --- flagship ------------------------------------------------------------------------------------------------

@query("scheme_month_report", """
WITH h AS (
  SELECT l_suppkey, strftime(l_shipdate, '%Y-%m') AS period, l_partkey, l_extendedprice AS v,
         l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_suppkey, strftime(l_shipdate, '%Y-%m'))
         * CASE WHEN l_suppkey % 2 = 0 THEN 1.0 ELSE 100.0 END AS pct
  FROM lineitem),
g AS (
  SELECT l_suppkey, period, count(*) AS holdings, sum(pct) AS t, sum(v) AS total FROM h GROUP BY 1, 2),
b AS (
  SELECT l_suppkey, period, l_partkey AS top_security FROM h
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, period ORDER BY v DESC, l_partkey) = 1)
SELECT l_suppkey, period, holdings, round(t * scale, 4) AS weight_total, round(total / (t * scale / 100), 2) AS implied_nav,
       top_security, CASE WHEN abs(t * scale - 100) < 1 THEN 1 ELSE 0 END AS reconciles
FROM (SELECT *, CASE WHEN abs(t - 100) <= 20 THEN 1.0 WHEN abs(t - 1) <= 0.2 THEN 100.0 ELSE 1.0 END AS scale FROM g)
JOIN b USING (l_suppkey, period)""")
def scheme_month_report(spark: SparkSession, sf: str) -> DataFrame:
    """For each scheme of a month: holdings, weight total, implied net assets, top holding, reconciled or not."""
    keys = ["l_suppkey", "period"]
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey", F.date_format("l_shipdate", "yyyy-MM").alias("period"), "l_partkey",
        F.col("l_extendedprice").alias("value_num"))
    totals = conv.with_group_totals(lines, keys, {"total": F.sum("value_num")})
    factor = F.when(F.col("l_suppkey") % 2 == 0, 1.0).otherwise(100.0)
    rows = totals.withColumn("pct_num", F.col("value_num") / F.col("total") * factor)
    top = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("holdings"),
        F.min_by("l_partkey", F.struct(-F.col("value_num"), F.col("l_partkey"))).alias("top_security"))
    out = conv.scheme_figures(rows, keys).join(top, keys)
    weight = F.col("pct_sum") * F.col("pct_scale")
    return out.select(
        *keys, "holdings", F.round(weight, 4).alias("weight_total"), F.round("implied_nav", 2).alias("implied_nav"),
        "top_security", F.when(F.abs(weight - 100) < 1, 1).otherwise(0).alias("reconciles"))
