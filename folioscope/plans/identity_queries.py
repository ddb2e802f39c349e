"""Queries over codes and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import isin as I
from folioscope.functions.names import clean_name, has_expiry_suffix, match_key
from folioscope.operators import classify, identity
from folioscope.plans.driver_tables import PART_CODE_SQL, coded_parts
from folioscope.plans.registry import query, table


@query("isin_check_digit", f"""
WITH {PART_CODE_SQL},
v AS (SELECT p_partkey, code AS c FROM coded UNION ALL
      SELECT p_partkey, upper(substr(p_name, 1, 4)) || lpad(p_partkey::VARCHAR, 8, '0') FROM part
      UNION ALL SELECT p_partkey, p_brand FROM part),
s AS (SELECT *, regexp_matches(c, '^[A-Z]{{2}}[A-Z0-9]{{9}}[0-9]$') AS shaped,
             regexp_matches(c, '^[A-Z]{{4,8}}[0-9]{{6,8}}$') AND NOT starts_with(c, 'IDIA') AS contract FROM v),
d AS (SELECT *, array_to_string(list_transform(string_split(CASE WHEN shaped THEN c ELSE '0' END, ''),
             lambda x: CASE WHEN x BETWEEN 'A' AND 'Z' THEN (ascii(x) - 55)::VARCHAR ELSE x END), '') AS dg FROM s),
l AS (SELECT *, list_sum(list_transform(range(1, length(dg) + 1),
        lambda i: CASE WHEN (length(dg) - i) % 2 = 0 THEN substr(dg, i, 1)::INT
             WHEN substr(dg, i, 1)::INT > 4 THEN substr(dg, i, 1)::INT * 2 - 9
             ELSE substr(dg, i, 1)::INT * 2 END)) % 10 AS rest FROM d)
SELECT p_partkey, c AS code, shaped::INT AS shaped, (shaped AND rest = 0)::INT AS valid, contract::INT AS contract FROM l""")
def isin_check_digit(spark: SparkSession, sf: str) -> DataFrame:
    parts = coded_parts(spark, sf)
    codes = parts.select("p_partkey", F.explode(F.array(
        "code", F.concat(F.upper(F.substring("p_name", 1, 4)), F.lpad(F.col("p_partkey").cast("string"), 8, "0")),
        "p_brand")).alias("code"))
    return codes.select("p_partkey", "code", I.has_isin_shape(F.col("code")).cast("int").alias("shaped"),
                        I.is_valid_isin(F.col("code")).cast("int").alias("valid"),
                        I.is_contract_code(F.col("code")).cast("int").alias("contract"))


@query("isin_type_key", f"""
WITH {PART_CODE_SQL},
seed AS (SELECT code, p_type AS i, p_brand AS n FROM coded WHERE p_partkey % 3 <> 0),
keys AS (
  SELECT k, i, n FROM (
    SELECT k, i, n, row_number() OVER (PARTITION BY k ORDER BY c DESC, i, n) AS r FROM (
      SELECT substr(code, 1, 3) || substr(code, 8, 2) AS k, i, n, count(*) AS c FROM seed GROUP BY 1, 2, 3)) WHERE r = 1)
SELECT p_partkey, coded.code AS isin, coalesce(seed.i, keys.i) AS instrument,
       CASE WHEN seed.code IS NOT NULL THEN seed.n ELSE keys.n END AS nature,
       CASE WHEN seed.code IS NOT NULL THEN 'exact' WHEN keys.k IS NOT NULL THEN 'key' ELSE 'none' END AS source
FROM coded LEFT JOIN seed ON seed.code = coded.code
LEFT JOIN keys ON keys.k = substr(coded.code, 1, 3) || substr(coded.code, 8, 2)""")
def isin_type_key(spark: SparkSession, sf: str) -> DataFrame:
    parts = coded_parts(spark, sf)
    seed = parts.filter("p_partkey % 3 <> 0").select(
        F.col("code").alias("isin"), F.col("p_type").alias("instrument_name"), F.col("p_brand").alias("nature_name"))
    out = classify.classify_isin(parts.select("p_partkey", F.col("code").alias("isin")), seed)
    return out.select("p_partkey", "isin", F.col("type_instrument").alias("instrument"),
                      F.col("type_nature").alias("nature"), F.col("type_source").alias("source"))


@query("non_isin_rules", """
WITH t AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         CASE l_partkey % 12 WHEN 0 THEN 'TREPS' WHEN 1 THEN 'Net Receivables / (Payables)' WHEN 2 THEN 'Cash Margin'
              WHEN 3 THEN 'Digital Gold' WHEN 4 THEN 'Silver' WHEN 5 THEN 'Fixed Deposit 7%' WHEN 6 THEN 'Repo'
              WHEN 7 THEN 'Margin Deposit' ELSE p_name END AS name,
         CASE l_linenumber WHEN 1 THEN 'Stock Futures' WHEN 2 THEN 'Money Market Instruments' WHEN 3 THEN 'Commodity Futures'
              WHEN 4 THEN 'Unlisted' ELSE p_type END AS section
  FROM lineitem JOIN part ON p_partkey = l_partkey),
r AS (
  SELECT *, CASE
    WHEN l_suppkey % 25 = 3 AND name = 'Silver' THEN 'House Silver'
    WHEN l_suppkey % 25 = 4 AND starts_with(name, 'TRE') THEN 'House Repo'
    WHEN section = 'Stock Futures' THEN 'Futures' WHEN section = 'Money Market Instruments' THEN 'Money Market'
    WHEN name LIKE 'Net Receivable%' THEN 'Net Receivables/(Payables)' WHEN name = 'Margin Deposit' THEN 'Margin Deposit'
    WHEN name = 'TREPS' THEN 'Reverse repo' WHEN name = 'Repo' THEN 'Repo' WHEN name = 'Cash Margin' THEN 'Cash'
    WHEN name = 'Digital Gold' THEN 'Gold' WHEN lower(name) LIKE '%gold%' THEN 'Gold' WHEN name = 'Silver' THEN 'Silver'
    WHEN section = 'Commodity Futures' THEN 'Commodity Futures' WHEN name LIKE 'Fixed Deposit%' THEN 'FD'
    WHEN section = 'Unlisted' THEN 'Equity' END AS instrument FROM t)
SELECT name, section, instrument, count(*) AS holdings,
       CASE WHEN instrument IN ('Futures', 'Options', 'Commodity Futures', 'Net Receivables/(Payables)', 'Reverse repo',
                                'Margin Deposit') THEN 1 ELSE 0 END AS overrules
FROM r GROUP BY 1, 2, 3""")
def non_isin_rules(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type")
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_linenumber", "l_suppkey").join(parts, "l_partkey")
    words = ["TREPS", "Net Receivables / (Payables)", "Cash Margin", "Digital Gold", "Silver", "Fixed Deposit 7%", "Repo",
             "Margin Deposit"]
    name, section = F.col("p_name"), F.col("p_type")
    for i, w in enumerate(words):
        name = F.when(F.col("l_partkey") % 12 == i, w).otherwise(name)
    for i, w in enumerate(["Stock Futures", "Money Market Instruments", "Commodity Futures", "Unlisted"], 1):
        section = F.when(F.col("l_linenumber") == i, w).otherwise(section)
    rows = lines.select(F.concat(F.lit("house_"), F.col("l_suppkey") % 25).alias("amc"), name.alias("security_name"),
                        section.alias("section_header"))
    houses = table(spark, sf, "supplier").select((F.col("s_suppkey") % 25).alias("h")).distinct()
    overrides = houses.filter("h in (3, 4)").select(
        F.concat(F.lit("house_"), "h").alias("amc"), F.lit(1).cast("bigint").alias("priority"),
        F.when(F.col("h") == 3, "exact").otherwise("prefix").alias("match_type"),
        F.when(F.col("h") == 3, "Silver").otherwise("TRE").alias("pattern"),
        F.when(F.col("h") == 3, "House Silver").otherwise("House Repo").alias("instrument"), F.lit("Others").alias("nature"))
    out = classify.recognize_non_isin(rows, overrides)
    return out.groupBy(F.col("security_name").alias("name"), F.col("section_header").alias("section"),
                       F.col("rec_instrument").alias("instrument")).agg(F.count(F.lit(1)).alias("holdings")).withColumn(
        "overrules", classify.override_safe(F.col("instrument")).cast("int"))


@query("name_to_code", """
WITH v AS (
  SELECT regexp_replace(regexp_replace(upper(p_name || CASE WHEN p_partkey % 2 = 0 THEN ' Ltd.' ELSE ' LIMITED' END),
           '\\b(LIMITED|LTD)\\b\\.?', 'LIMITED', 'g'), '[^A-Z0-9]+', '', 'g') AS mk, p_brand AS code, count(*) AS n
  FROM part GROUP BY 1, 2)
SELECT mk AS match_key, code AS isin, n AS observations FROM v
QUALIFY row_number() OVER (PARTITION BY mk ORDER BY n DESC, code) = 1 AND n >= 3""")
def name_to_code(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    name = F.concat("p_name", F.when(F.col("p_partkey") % 2 == 0, " Ltd.").otherwise(" LIMITED"))
    variants = parts.groupBy(match_key(name).alias("match_key"), F.col("p_brand").alias("isin"), name.alias("name")).agg(
        F.count(F.lit(1)).alias("count"))
    return classify.name_to_isin(variants)


@query("clean_names", """
WITH n AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, p_name,
         CASE l_linenumber WHEN 1 THEN 'EQ - ' WHEN 2 THEN 'fut -' ELSE '' END AS pre,
         CASE l_partkey % 5 WHEN 0 THEN ' - 28-Jun-2026' WHEN 1 THEN ' $$ ~~' WHEN 2 THEN '  **' ELSE '' END AS post
  FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT pre || p_name || post AS raw_name, p_name AS name, (post LIKE '%Jun%')::INT AS is_derivative, count(*) AS holdings
FROM n GROUP BY 1, 2, 3""")
def clean_names(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_linenumber").join(parts, "l_partkey")
    pre = F.when(F.col("l_linenumber") == 1, "EQ - ").when(F.col("l_linenumber") == 2, "fut -").otherwise("")
    k = F.col("l_partkey") % 5
    post = F.when(k == 0, " - 28-Jun-2026").when(k == 1, " $$ ~~").when(k == 2, "  **").otherwise("")
    raw = lines.groupBy(F.concat(pre, "p_name", post).alias("raw_name")).agg(F.count(F.lit(1)).alias("holdings"))
    return raw.select("raw_name", clean_name(F.col("raw_name")).alias("name"),
                      has_expiry_suffix(F.col("raw_name")).cast("int").alias("is_derivative"), "holdings")


OBSERVED_SQL = """
obs AS (
  SELECT 'U' || user_id AS isin, CASE WHEN event_type IN ('view', 'click') THEN event_type || ' ltd' ELSE event_type END
           || CASE WHEN event_id % 3 = 0 THEN '.' ELSE '' END AS name,
         strftime(ts, '%Y-%m-%d') AS period, 'h' || event_id % 7 AS amc, count(*) AS n
  FROM events GROUP BY ALL),
sp AS (
  SELECT isin, name, sum(n) AS n, max(period) AS lastp,
         regexp_replace(regexp_replace(upper(name), '\\b(LIMITED|LTD)\\b\\.?', 'LIMITED', 'g'), '[^A-Z0-9]+', '', 'g') AS mk
  FROM obs GROUP BY isin, name),
ks AS (SELECT isin, mk, max(lastp) AS kp, sum(n) AS kn FROM sp GROUP BY 1, 2),
bk AS (SELECT isin, mk FROM ks QUALIFY row_number() OVER (PARTITION BY isin ORDER BY kp DESC, kn DESC, mk) = 1),
canon AS (
  SELECT isin, name AS canonical_name FROM sp JOIN bk USING (isin, mk)
  QUALIFY row_number() OVER (PARTITION BY isin ORDER BY lastp DESC, n DESC, length(name) DESC, name) = 1)"""


def observed_names(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    name = F.when(F.col("event_type").isin("view", "click"), F.concat("event_type", F.lit(" ltd"))).otherwise(F.col("event_type"))
    name = F.concat(name, F.when(F.col("event_id") % 3 == 0, ".").otherwise(""))
    return events.groupBy(
        F.concat(F.lit("U"), "user_id").alias("isin"), name.alias("name"),
        F.date_format("ts", "yyyy-MM-dd").alias("period"), F.concat(F.lit("h"), F.col("event_id") % 7).alias("amc"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("canonical_name", f"WITH {OBSERVED_SQL} SELECT isin, canonical_name FROM canon")
def canonical_name(spark: SparkSession, sf: str) -> DataFrame:
    return identity.canonical_names(observed_names(spark, sf))


@query("name_variants", f"""
WITH {OBSERVED_SQL}
SELECT isin, name, mk AS match_key, n::BIGINT AS count, (name = canonical_name)::INT AS is_canonical FROM sp JOIN canon USING (isin)""")
def name_variants(spark: SparkSession, sf: str) -> DataFrame:
    return identity.name_variants(observed_names(spark, sf))


@query("name_stats", f"""
WITH {OBSERVED_SQL}
SELECT isin, sum(n)::BIGINT AS observations, count(DISTINCT name) AS variants,
       count(DISTINCT regexp_replace(regexp_replace(upper(name), '\\b(LIMITED|LTD)\\b\\.?', 'LIMITED', 'g'), '[^A-Z0-9]+', '', 'g')) AS entities,
       count(DISTINCT amc) AS amcs, min(period) AS first_period, max(period) AS last_period
FROM obs GROUP BY isin""")
def name_stats(spark: SparkSession, sf: str) -> DataFrame:
    return identity.name_stats(observed_names(spark, sf))


@query("unlinked_summary", """
WITH c AS (SELECT p_name AS name, p_type AS section, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
SELECT name, sum(n)::BIGINT AS count, arg_min(section, (-n, section)) AS top_section FROM c GROUP BY name""")
def unlinked_summary(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("name"),
                                            F.col("p_type").alias("section"))
    lines = table(spark, sf, "lineitem").select("l_partkey").join(parts, "l_partkey")
    rows = lines.groupBy("name", "section").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("unlinked"))
    return identity.unlinked_summary(rows)


@query("contract_summary", """
WITH c AS (SELECT p_brand AS code, p_name AS name, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
SELECT code AS contract_code, arg_min(name, (-n, name)) AS underlying_name, sum(n)::BIGINT AS observations, count(*) AS variants
FROM c GROUP BY code""")
def contract_summary(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("name"),
                                            F.col("p_brand").alias("code"))
    lines = table(spark, sf, "lineitem").select("l_partkey").join(parts, "l_partkey")
    rows = lines.groupBy("code", "name").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("contract"))
    return identity.contract_summary(rows)


@query("seed_modes", """
WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2)
SELECT c_nationkey, arg_min(c_mktsegment, (-n, c_mktsegment)) AS c_mktsegment, max(n) AS n, count(*) AS candidates
FROM c GROUP BY 1""")
def seed_modes(spark: SparkSession, sf: str) -> DataFrame:
    return identity.modal(table(spark, sf, "customer"), "c_nationkey", ["c_mktsegment"])


@query("seed_conflicts", """
SELECT 'amfi_code' AS kind, l_partkey::VARCHAR AS key, l_returnflag AS candidate, count(*) AS n,
FROM lineitem GROUP BY l_partkey, l_returnflag
QUALIFY count(*) OVER (PARTITION BY l_partkey) > 1""")
def seed_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return identity.conflicts(table(spark, sf, "lineitem"), "l_partkey", ["l_returnflag"], "amfi_code")


@query("priority_union", """
WITH a AS (
  SELECT c_custkey % 700 AS isin, c_name AS name, CASE WHEN c_acctbal > 5000 THEN 0 ELSE 3 END AS priority, c_custkey AS ord FROM customer
  UNION ALL SELECT s_suppkey % 700, s_name, 1, s_suppkey FROM supplier
  UNION ALL SELECT p_partkey % 700, p_name, 2, p_partkey FROM part)
SELECT isin, name, priority::BIGINT AS priority, ord FROM a QUALIFY row_number() OVER (PARTITION BY isin ORDER BY priority, ord) = 1""")
def priority_union(spark: SparkSession, sf: str) -> DataFrame:
    def source(name: str, key: str, label: str) -> DataFrame:
        df = table(spark, sf, name)
        return df.select((F.col(key) % 700).alias("isin"), F.col(label).alias("name"), F.col(key).alias("ord"))

    customers, large = source("customer", "c_custkey", "c_name"), table(spark, sf, "customer").select(
        F.col("c_custkey").alias("ord"), (F.col("c_acctbal") > 5000).alias("large"))
    customers = customers.join(large, "ord")
    first, last = (customers.filter(f).select("isin", "name", "ord") for f in ("large", "NOT large"))
    return identity.priority_union([first, source("supplier", "s_suppkey", "s_name"), source("part", "p_partkey", "p_name"), last])


FILL_SQL = f"""
WITH {PART_CODE_SQL},
m AS (SELECT CASE WHEN p_partkey % 4 = 1 THEN code ELSE 'X' || code END AS code, p_name FROM coded),
c AS (SELECT substr(code, 1, 7) AS prefix, p_name, count(*) AS n FROM m GROUP BY 1, 2),
i AS (SELECT prefix, arg_min(p_name, (-n, p_name)) AS issuer_name, max(n) AS n, count(*) AS candidates FROM c GROUP BY 1)"""


def master_names(parts: DataFrame) -> DataFrame:
    """All parts; three of four stand under a code that no line has."""
    isin = F.when(F.col("p_partkey") % 4 == 1, F.col("code")).otherwise(F.concat(F.lit("X"), "code"))
    return parts.select(isin.alias("isin"), F.col("p_name").alias("name"))


@query("issuer_prefix", FILL_SQL + " SELECT prefix, issuer_name, n, candidates FROM i")
def issuer_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return identity.issuer_names(master_names(coded_parts(spark, sf)))


@query("name_fill_rate", FILL_SQL + """,
f AS (SELECT p_type, CASE WHEN m.code IS NOT NULL THEN 'master' WHEN i.prefix IS NOT NULL THEN 'prefix' ELSE 'blank' END AS src
      FROM lineitem JOIN coded ON p_partkey = l_partkey LEFT JOIN m ON m.code = coded.code
      LEFT JOIN i ON i.prefix = substr(coded.code, 1, 7))
SELECT p_type, count(*) AS rows, count(*) FILTER (src = 'master') AS from_master, count(*) FILTER (src = 'prefix') AS from_prefix,
       count(*) FILTER (src = 'blank') AS from_blank, round(avg((src <> 'blank')::INT::DOUBLE), 6) AS fill_rate
FROM f GROUP BY 1""")
def name_fill_rate(spark: SparkSession, sf: str) -> DataFrame:
    parts = coded_parts(spark, sf)
    master = master_names(parts)
    rows = table(spark, sf, "lineitem").select("l_partkey").join(
        parts.select(F.col("p_partkey").alias("l_partkey"), F.col("code").alias("isin"), "p_type"), "l_partkey")
    out = identity.with_name_source(rows, master, identity.issuer_names(master))
    return identity.fill_rate(out, ["p_type"]).withColumn("fill_rate", F.round("fill_rate", 6))
