"""Queries over attempts and the month ledger, from orders by customer group and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions.messages import classify_failure, looks_like_no_data
from folioscope.functions.periods import with_months
from folioscope.operators import ledger as L
from folioscope.plans.registry import query, table
from folioscope.scale import ordered_scan

TODAY = "2001-06-15"
MESSAGES = [
    "House listing has no workbook for 1999-04", "page no longer exposes option 51 for 1999-04",
    "requests.exceptions.ReadTimeout: read timed out", "KeyError: data", "something odd happened",
    "content looks like an HTML page, no file for 1999-04",
]
CODES = [0, 1, 2, 5, 7, 9, 10, 1]


def attempts(spark: SparkSession, sf: str) -> DataFrame:
    """One attempt per order: the cell is (customer group, month), the attempt number its place in the cell."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("house_"), F.col("o_custkey") % 40).alias("amc"),
        F.date_format("o_orderdate", "yyyy-MM").alias("period"))
    placed = ordered_scan(orders, ["amc", "period"], ["o_orderkey"], F.shiftright("o_orderkey", 12), position="at")
    silent = F.col("amc").endswith("7") & (F.col("period") < "1998")
    pick = F.when(silent, 2).otherwise(
        F.element_at(F.array(*map(F.lit, CODES)), (F.col("o_orderkey") % 8 + 1).cast("int")))
    text = F.element_at(F.array(*map(F.lit, MESSAGES)), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return placed.select(
        "amc", "period", (F.col("at") + 1).alias("attempt"), pick.alias("exit_code"), text.alias("message"),
        ((F.col("o_orderkey") % 29 == 0) & ~silent).alias("timed_out"))


ATTEMPTS_SQL = f"""
a AS (
  SELECT 'house_' || o_custkey % 40 AS amc, strftime(o_orderdate, '%Y-%m') AS period,
         row_number() OVER (PARTITION BY o_custkey % 40, strftime(o_orderdate, '%Y-%m') ORDER BY o_orderkey) AS attempt,
         o_custkey % 40 % 10 = 7 AND strftime(o_orderdate, '%Y-%m') < '1998' AS silent,
         CASE WHEN o_custkey % 40 % 10 = 7 AND strftime(o_orderdate, '%Y-%m') < '1998' THEN 2
              ELSE ({CODES})[o_orderkey % 8 + 1] END AS code,
         o_orderkey % 6 AS m, o_orderkey % 29 = 0 AND NOT silent AS late FROM orders),
s AS (
  SELECT *, CASE WHEN period >= '2001-03' THEN 'NOT_YET_PUBLISHED' ELSE 'NO_DATA' END AS una FROM a),
c AS (
  SELECT amc, period, attempt, CASE WHEN late THEN 'HTTP_ERROR' WHEN code = 0 THEN 'SUCCESS' WHEN code = 2 THEN una
         WHEN code = 5 THEN 'DOWNLOAD_FAILED' WHEN code = 7 THEN 'INVALID_FILE' WHEN code = 9 THEN 'SITE_CHANGED'
         WHEN code = 10 THEN 'UPSTREAM_GAP' WHEN m = 0 THEN una WHEN m = 1 THEN 'SITE_CHANGED' WHEN m = 2 THEN 'HTTP_ERROR'
         WHEN m = 3 THEN 'DISCOVERY_FAILED' WHEN m = 5 THEN 'INVALID_FILE' ELSE 'UNKNOWN_ERROR' END AS status FROM s),
f AS (
  SELECT amc, period, attempt, status FROM (
    SELECT *, status IN ('DOWNLOAD_FAILED', 'HTTP_ERROR', 'SITE_CHANGED', 'INVALID_FILE', 'DISCOVERY_FAILED', 'UNKNOWN_ERROR') AS again
    FROM c WHERE attempt <= 4)
  QUALIFY row_number() OVER (PARTITION BY amc, period ORDER BY again, CASE WHEN again THEN -attempt ELSE attempt END) = 1),
y AS (
  SELECT amc, substr(period, 1, 4) AS year, bool_or(status = 'SUCCESS') AS reach, bool_and(status = 'NO_DATA') AS empty
  FROM f GROUP BY 1, 2),
e AS (SELECT amc, min(year) FILTER (reach) AS earliest FROM y GROUP BY 1),
z AS (SELECT y.*, NOT reach AND empty AND (earliest IS NULL OR year < earliest) AS folds FROM y JOIN e USING (amc)),
r AS (
  SELECT f.amc, substr(period, 1, 4) AS year, substr(period, 6, 2) AS month,
         CASE WHEN reach AND status = 'NO_DATA' THEN 'MONTH_NOT_AVAILABLE' ELSE status END AS status
  FROM f JOIN z ON z.amc = f.amc AND z.year = substr(period, 1, 4) WHERE NOT folds
  UNION ALL SELECT amc, year, '--', 'YEAR_NOT_AVAILABLE' FROM z WHERE folds)"""


def month_ledger(spark: SparkSession, sf: str) -> DataFrame:
    today = F.lit(TODAY).cast("date")
    return L.final_attempt(L.classify_attempts(attempts(spark, sf), today, 3))


@query("attempt_status", f"WITH {ATTEMPTS_SQL} SELECT amc, period, attempt, status FROM c")
def attempt_status(spark: SparkSession, sf: str) -> DataFrame:
    return L.classify_attempts(attempts(spark, sf), F.lit(TODAY).cast("date"), 3).select("amc", "period", "attempt", "status")


@query("final_attempt", f"""
WITH {ATTEMPTS_SQL}
SELECT amc, period, attempt, status, CASE WHEN attempt > 1 THEN '[attempt ' || attempt || '/4]' ELSE '' END AS label FROM f""")
def final_attempt(spark: SparkSession, sf: str) -> DataFrame:
    label = F.regexp_extract("description", r"(\[attempt \d+/4\])$", 1)
    return month_ledger(spark, sf).select("amc", "period", "attempt", "status", label.alias("label"))


@query("year_rollup", f"WITH {ATTEMPTS_SQL} SELECT amc, year, month, status FROM r")
def year_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return L.rollup_year_status(month_ledger(spark, sf)).select("amc", "year", "month", "status")


@query("resume_plan", f"""
WITH {ATTEMPTS_SQL},
sp AS (SELECT 'house_' || h AS amc, y::VARCHAR AS year, lpad(m::VARCHAR, 2, '0') AS month
       FROM (SELECT DISTINCT o_custkey % 40 AS h FROM orders), range(1995, 2003) t(y), range(1, 13) u(m)),
files AS (SELECT 'house_' || o_custkey % 40 AS amc, strftime(o_orderdate, '%Y-%m') AS period,
                 count(*) FILTER (o_orderstatus = 'F') AS n FROM orders GROUP BY 1, 2),
j AS (
  SELECT sp.amc, sp.year, sp.month, sp.year || '-' || sp.month AS period, r.status AS st, q.amc IS NOT NULL AS folded, coalesce(n, 0) AS n
  FROM sp LEFT JOIN r ON r.amc = sp.amc AND r.year = sp.year AND r.month = sp.month
  LEFT JOIN (SELECT amc, year FROM r WHERE month = '--') q ON q.amc = sp.amc AND q.year = sp.year
  LEFT JOIN files ON files.amc = sp.amc AND files.period = sp.year || '-' || sp.month),
k AS (SELECT *, coalesce(st, CASE WHEN folded THEN 'NO_DATA' END) AS known FROM j)
SELECT amc, period,
       CASE WHEN period > '2001-06' THEN 'future' WHEN known = 'SUCCESS' AND n > 0 THEN 'reuse'
            WHEN known IN ('MONTH_NOT_AVAILABLE', 'NO_DATA', 'UPSTREAM_GAP') THEN 'reuse' ELSE 'run' END AS action,
       CASE WHEN period > '2001-06' THEN 'NOT_YET_PUBLISHED' WHEN known = 'SUCCESS' AND n > 0 THEN 'ALREADY_EXISTS'
            WHEN known IN ('MONTH_NOT_AVAILABLE', 'NO_DATA', 'UPSTREAM_GAP') THEN known END AS status
FROM k""")
def resume_plan(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    houses = orders.select(F.concat(F.lit("house_"), F.col("o_custkey") % 40).alias("amc")).distinct()
    spine = with_months(houses, 1995, 2002)
    files = orders.groupBy(F.concat(F.lit("house_"), F.col("o_custkey") % 40).alias("amc"),
                           F.date_format("o_orderdate", "yyyy-MM").alias("period")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("file_count"))
    ledger = L.rollup_year_status(month_ledger(spark, sf))
    return L.resume_plan(spine, ledger, files, "2001-06").select("amc", "period", "action", "status")


@query("status_totals", f"WITH {ATTEMPTS_SQL} SELECT status, count(*) AS cells FROM r GROUP BY status")
def status_totals(spark: SparkSession, sf: str) -> DataFrame:
    return L.status_totals(L.rollup_year_status(month_ledger(spark, sf)))


@query("open_items", f"""
WITH {ATTEMPTS_SQL}
SELECT amc, year, month, status FROM r
WHERE status NOT IN ('NOT_YET_PUBLISHED', 'YEAR_NOT_AVAILABLE', 'MONTH_NOT_AVAILABLE', 'ALREADY_EXISTS', 'SUCCESS')""")
def open_items(spark: SparkSession, sf: str) -> DataFrame:
    return L.open_items(L.rollup_year_status(month_ledger(spark, sf))).select("amc", "year", "month", "status")


@query("ledger_upsert", f"""
WITH {ATTEMPTS_SQL}
SELECT amc, year, month, CASE WHEN month = '03' THEN 'SUCCESS' ELSE status END AS status FROM r""")
def ledger_upsert(spark: SparkSession, sf: str) -> DataFrame:
    ledger = L.rollup_year_status(month_ledger(spark, sf))
    changes = ledger.filter("month = '03'").withColumn("status", F.lit("SUCCESS"))
    return L.upsert_ledger(ledger, changes).select("amc", "year", "month", "status")


@query("message_classes", """
SELECT o_orderpriority, count(*) AS messages,
       count(*) FILTER (o_orderkey % 4 = 0) AS no_data, count(*) FILTER (o_orderkey % 4 = 1) AS http_error,
       count(*) FILTER (o_orderkey % 4 = 2) AS site_changed, count(*) FILTER (o_orderkey % 4 = 3) AS unknown
FROM orders GROUP BY 1""")
def message_classes(spark: SparkSession, sf: str) -> DataFrame:
    period = F.concat(F.lit("20"), F.date_format("o_orderdate", "yy-MM"))
    k = F.col("o_orderkey") % 4
    text = (
        F.when(k == 0, F.concat(F.lit("listing has no workbook for "), period))
        .when(k == 1, F.concat(F.lit("page returned 503, no workbook for "), period))
        .when(k == 2, F.concat(F.lit("catalog no longer offers the section for "), period))
        .otherwise(F.concat(F.lit("unexpected order "), F.col("o_orderkey").cast("string"), F.lit(" in the tree")))
    )
    rows = table(spark, sf, "orders").select("o_orderpriority", text.alias("m"))
    rows = rows.select("o_orderpriority", looks_like_no_data(F.col("m")).alias("none"), classify_failure(F.col("m")).alias("cls"))
    cls = F.col("cls")
    return rows.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("messages"), F.count_if("none").alias("no_data"),
        F.count_if(~F.col("none") & (cls == "HTTP_ERROR")).alias("http_error"),
        F.count_if(~F.col("none") & (cls == "SITE_CHANGED")).alias("site_changed"),
        F.count_if(~F.col("none") & (cls == "UNKNOWN_ERROR")).alias("unknown"))
