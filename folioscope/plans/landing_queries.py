"""Queries over documents, audited sheets, house layouts and the tables that sinks leave behind."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.contracts import FINAL_FIELDS, HOLDINGS_RAW, LEDGER_FIELDS, UNRESOLVED_FIELDS
from folioscope.functions.text import cell_number, typed_cell
from folioscope.operators import completeness as V
from folioscope.operators import coverage as A
from folioscope.operators import documents as D
from folioscope.operators import layouts
from folioscope.operators import listing as P
from folioscope.plans.registry import query, table
from folioscope.plans.sheet_queries import at, printed_sheets, row_of, scheme_name, sheet_frame, suppliers
from folioscope.scale import last_rows, settle, shared_folder
from folioscope.sources import tables as S

MONTHS = [f"2026-0{m}" for m in range(1, 8)]


@query("period_status", f"""
WITH d AS (SELECT source AS amc, '2026-0' || (doc_id % 5 + 1) AS period, doc_id FROM documents),
w AS (SELECT DISTINCT amc, unnest({MONTHS}) AS period FROM d)
SELECT amc, period, count(doc_id) AS documents, CASE WHEN count(doc_id) = 0 THEN 'no_documents' ELSE 'ok' END AS status,
       count(doc_id) FILTER (period = '2026-03') AS march
FROM w LEFT JOIN d USING (amc, period) GROUP BY 1, 2""")
def period_status(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(
        F.col("source").alias("amc"), F.concat(F.lit("2026-0"), (F.col("doc_id") % 5 + 1).cast("string")).alias("period"))
    wanted = docs.select("amc").distinct().select("amc", F.explode(F.array(*map(F.lit, MONTHS))).alias("period"))
    march = D.only_period(docs, "2026-03").groupBy("amc", "period").agg(F.count(F.lit(1)).alias("march"))
    return D.period_status(docs, wanted).join(march, ["amc", "period"], "left").withColumn("march", F.coalesce("march", F.lit(0)))


@query("open_gaps", """
SELECT 'h' || o_orderkey % 10 AS amc, '2026-0' || (o_orderkey % 5 + 1) AS period, 'u' || o_orderkey AS url FROM orders
WHERE o_orderstatus = 'O' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 4)""")
def open_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Open orders are addresses reported unavailable; those with a fourth line were downloaded later."""
    def place(key: str):
        return [F.concat(F.lit("h"), (F.col(key) % 10).cast("string")).alias("amc"),
                F.concat(F.lit("2026-0"), (F.col(key) % 5 + 1).cast("string")).alias("period"),
                F.concat(F.lit("u"), F.col(key).cast("string")).alias("url")]

    unavailable = table(spark, sf, "orders").filter("o_orderstatus = 'O'").select(*place("o_orderkey"))
    return V.upstream_gaps(unavailable, table(spark, sf, "lineitem").filter("l_linenumber = 4").select(*place("l_orderkey")))


@query("document_records", """
SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'https://h.example.org/files/' || doc_id || '/Report.xlsx' WHEN 1 THEN 'https://cdn.example.com/x' || doc_id || '.XLS?w=2'
         WHEN 4 THEN 'https://h.example.org/list/sub/' || doc_id || '.zip' WHEN 5 THEN 'https://h.example.org/dl/' || doc_id END AS url,
       CASE doc_id % 6 WHEN 0 THEN 'Report.xlsx' WHEN 1 THEN 'x' || doc_id || '.XLS' WHEN 4 THEN doc_id || '.zip' WHEN 5 THEN 'Given ' || doc_id || '.xlsx' END AS filename,
       CASE doc_id % 6 WHEN 0 THEN 'xlsx' WHEN 1 THEN 'xls' WHEN 4 THEN 'zip' WHEN 5 THEN 'xlsx' END AS file_type,
       CASE doc_id % 6 WHEN 5 THEN source WHEN 0 THEN '/files/' || doc_id || '/Report.xlsx' WHEN 1 THEN 'https://cdn.example.com/x' || doc_id || '.XLS?w=2'
         WHEN 4 THEN 'sub/' || doc_id || '.zip' END AS label,
       CASE WHEN doc_id % 6 IN (2, 3) THEN 'not a document address' END AS reason
FROM documents""")
def document_records(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("doc_id").cast("string")
    kind = F.col("doc_id") % 6
    href = (F.when(kind == 0, F.concat(F.lit("/files/"), i, F.lit("/Report.xlsx"))).when(kind == 1, F.concat(F.lit("https://cdn.example.com/x"), i, F.lit(".XLS?w=2")))
            .when(kind == 2, F.concat(F.lit("/a{b}"), i)).when(kind == 3, F.concat(F.lit("/"), F.repeat(F.lit("d"), 2100), i))
            .when(kind == 4, F.concat(F.lit("sub/"), i, F.lit(".zip"))).otherwise(F.concat(F.lit("/dl/"), i)))
    rows = table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("amc"), F.lit("2026-05").alias("period"), F.lit("https://h.example.org/list/page.html").alias("source_page_url"),
        href.alias("href"), F.when(kind == 5, F.concat(F.lit("Given "), i, F.lit(".xlsx"))).alias("filename"), F.when(kind == 5, F.col("source")).alias("label"))
    good, bad = P.to_document(rows)
    cols = ["doc_id", "url", "filename", "file_type", "label"]
    none = F.lit(None).cast("string")
    return good.select(*cols, none.alias("reason")).unionByName(
        bad.select("doc_id", *[none.alias(c) for c in cols[1:]], "reason"))


def audited_cells(spark: SparkSession, sf: str) -> DataFrame:
    """A sheet per supplier: a dated title, printed codes, a heading and a code; some stack two schemes; one index per file."""
    k = F.col("l_suppkey")

    def text(*parts):
        return typed_cell(text=F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts]))

    date = F.when(k % 3 == 0, "April 30, 2026").otherwise("May 31, 2026")
    code = (k + 100000).cast("string")
    rows = F.array(
        at(0, row_of(text("Portfolio as on ", date))), at(1, F.when(k % 2 == 0, row_of(text("AMFI Code: ", code))).otherwise(row_of("x"))),
        at(2, F.when(k % 4 == 0, row_of(text("AMFI Scheme Code - 9", F.substring(code, 2, 5)))).otherwise(row_of("y"))),
        at(3, F.when(k % 7 != 1, row_of("Name of the Instrument", "ISIN", "% to Net Assets")).otherwise(row_of("nothing", "here", "at all"))),
        at(20, row_of("Portfolio as on June 30, 2026")),
        at(30, F.when(k % 5 == 1, row_of(text("SCHEME: Alpha ", code))).otherwise(row_of("z"))),
        at(40, F.when(k % 5 == 1, row_of(text("SCHEME: Beta ", code))).otherwise(row_of("z"))))
    index = table(spark, sf, "supplier").select((F.col("s_suppkey") % 10).alias("l_suppkey"), F.col("s_suppkey").alias("of")).select(
        F.lit("house").alias("amc"), F.lit("2026-05").alias("period"), F.concat(F.lit("f"), F.col("l_suppkey"), F.lit(".xlsx")).alias("source_file"),
        F.lit("Index").alias("sheet"), F.lit(1_000_000).alias("sheet_idx"), F.col("of").cast("int").alias("row_idx"),
        row_of(typed_cell(text=F.concat(F.lit("S"), "of")), typed_cell(text=F.concat(F.lit("Listed Fund "), "of"))).cast(
            "array<struct<s:string,n:double>>").alias("cells"))
    return sheet_frame(suppliers(spark, sf), rows).unionByName(index)


AUDITED_SQL = """
s AS (SELECT s_suppkey AS k, s_suppkey % 3 = 0 AS stale, s_suppkey % 7 <> 1 AS headed, s_suppkey % 5 = 1 AS stacked FROM supplier)"""


@query("stale_sheets", f"""
WITH {AUDITED_SQL}
SELECT 'S' || k AS sheet, stale::INT AS stale, headed::INT AS headed, CASE WHEN stacked THEN 2 ELSE 0 END AS markers,
       CASE WHEN k % 2 = 0 THEN (k + 100000)::VARCHAR END AS first_code, (k % 2 = 0)::INT + (k % 4 = 0)::INT AS codes FROM s""")
def stale_sheets(spark: SparkSession, sf: str) -> DataFrame:
    out = A.scan_sheets(audited_cells(spark, sf)).filter("sheet <> 'Index'")
    return out.select("sheet", F.col("is_stale").cast("int").alias("stale"), F.col("has_header").cast("int").alias("headed"),
                      F.col("markers").cast("int").alias("markers"), F.col("printed_code").alias("first_code"), F.size("printed_codes").alias("codes"))


@query("audit_units", f"""
WITH {AUDITED_SQL},
u AS (
  SELECT 'S' || k AS label, k, 'unit' AS kind FROM s WHERE NOT stale AND headed AND NOT stacked
  UNION ALL SELECT 'S' || k || ' @row31', k, 'unit' FROM s WHERE NOT stale AND stacked
  UNION ALL SELECT 'S' || k || ' @row41', k, 'unit' FROM s WHERE NOT stale AND stacked
  UNION ALL SELECT 'S' || k, k, 'as-of outside audited period' FROM s WHERE stale
  UNION ALL SELECT 'S' || k, k, 'not a portfolio sheet' FROM s WHERE NOT stale AND NOT headed AND NOT stacked)
SELECT label, kind, CASE WHEN kind = 'unit' THEN 'Listed Fund ' || k END AS listed FROM u""")
def audit_units(spark: SparkSession, sf: str) -> DataFrame:
    units, texts, skipped = A.build_units(audited_cells(spark, sf))
    listed = texts.filter("source = 'index_sheet'").select("unit_id", F.col("raw").alias("listed"))
    kept = units.filter("sheet IS NOT NULL").join(listed, "unit_id", "left").select("label", F.lit("unit").alias("kind"), "listed")
    return kept.unionByName(skipped.filter("sheet <> 'Index'").select(
        F.col("sheet").alias("label"), F.col("reason").alias("kind"), F.lit(None).cast("string").alias("listed")))


@query("parsed_month", """
SELECT CASE l_suppkey % 3 WHEN 0 THEN 'any_house' WHEN 1 THEN 'pgim' ELSE 'tata' END AS amc, CASE l_suppkey % 3
         WHEN 0 THEN CASE WHEN l_suppkey % 5 = 4 THEN 'S' || l_suppkey ELSE 'Scheme ' || l_suppkey || ' Fund' END
         WHEN 1 THEN 'Filed Fund ' || l_suppkey ELSE 'Indexed Fund ' || l_suppkey END AS scheme,
       count(*) AS holdings, round(sum(l_extendedprice), 2) AS value_total, 0 AS first_place
FROM lineitem WHERE l_partkey % 3 <> 0 AND (l_suppkey % 3 <> 2 OR l_suppkey % 4 <> 0) GROUP BY 1, 2, l_suppkey""")
def parsed_month(spark: SparkSession, sf: str) -> DataFrame:
    """Three houses in the layouts shipped for them: titles in the sheet, in the file name, in an index sheet that omits some.

    Holdings with a code are compared; repeated labels without one go in the first layout only.
    """
    k = F.regexp_extract("sheet", r"^S(\d+)$", 1).cast("int")
    cells = printed_sheets(spark, sf).withColumn("k", k)
    cells = cells.withColumns({
        "amc": F.when(F.col("k") % 3 == 0, "any_house").when(F.col("k") % 3 == 1, "pgim").otherwise("tata"),
        "source_file": F.when(F.col("k") % 3 == 1, F.concat(F.lit("Filed Fund "), "k", F.lit(" May 2026.xlsx"))).otherwise(
            F.concat(F.lit("book "), "k", F.lit(".xlsx")))}).drop("k")
    index = suppliers(spark, sf).filter("l_suppkey % 3 = 2 AND l_suppkey % 4 <> 0").select(
        F.lit("tata").alias("amc"), F.lit("2026-05").alias("period"), F.concat(F.lit("book "), "l_suppkey", F.lit(".xlsx")).alias("source_file"),
        F.lit("Index").alias("sheet"), F.lit(-1).alias("sheet_idx"), F.lit(0).alias("row_idx"),
        row_of(1.0, typed_cell(text=F.concat(F.lit("S"), "l_suppkey")), typed_cell(text=F.concat(F.lit("Indexed Fund "), "l_suppkey"))).cast(
            "array<struct<s:string,n:double>>").alias("cells"))
    held = layouts.parse_period(settle(cells.unionByName(index)))  # each layout and step reads the cells
    first = held.groupBy("amc").agg(F.min("ord").alias("lowest"))
    out = held.filter("isin IS NOT NULL").groupBy("amc", "scheme_name_raw", "source_file", "sheet").agg(
        F.count(F.lit(1)).alias("holdings"), F.round(F.sum(cell_number(F.col("market_value_raw"))), 2).alias("value_total"))
    return out.join(first, "amc").select("amc", F.col("scheme_name_raw").alias("scheme"), "holdings", "value_total", F.col("lowest").cast("int").alias("first_place"))


@query("sink_round_trips", """
WITH c AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer)
SELECT 'mapping' AS sink, count(*) AS rows_, sum(c_custkey)::BIGINT AS keys FROM c WHERE c_custkey % 3 <> 0
UNION ALL SELECT 'review', count(*), sum(c_custkey)::BIGINT FROM c WHERE c_custkey % 3 = 0
UNION ALL SELECT 'expected', count(*), sum(c_custkey)::BIGINT FROM c
UNION ALL SELECT 'report', count(*), sum(c_custkey)::BIGINT FROM c
UNION ALL SELECT 'coverage', count(*), sum(c_custkey)::BIGINT FROM c WHERE c_acctbal > 0
UNION ALL SELECT 'missing', count(*), sum(c_custkey)::BIGINT FROM c WHERE c_acctbal <= 0
UNION ALL SELECT 'discovery', count(*), sum(c_custkey)::BIGINT FROM c
UNION ALL SELECT 'summary', count(*), sum(c_custkey)::BIGINT FROM c
UNION ALL SELECT 'aliases', count(*), sum(c_custkey)::BIGINT FROM c
UNION ALL SELECT 'names', count(*), sum(c_custkey)::BIGINT FROM c
UNION ALL SELECT 'lookup', count(DISTINCT c_custkey // 2), sum(CASE WHEN c_custkey % 2 = 1 OR c_custkey = (SELECT max(c_custkey) FROM c) THEN c_custkey END)::BIGINT FROM c
UNION ALL SELECT 'ledger', count(*), sum(c_custkey)::BIGINT FROM c
UNION ALL SELECT 'pages', count(*), sum(page_id)::BIGINT FROM pages""")
def sink_round_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Each sink written once and read back; the lookup holds two lines per key, of which the last counts."""
    folder = f"{shared_folder(spark)}/sinks-{uuid.uuid4().hex}"
    c = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_acctbal", F.concat(F.lit("h"), F.col("c_nationkey").cast("string")).alias("amc"), F.lit("2026-05").alias("period"))
    third = F.col("c_custkey") % 3 == 0
    S.write_mapping(c.filter(~third).drop("period"), c.filter(third).drop("period"), f"{folder}/map")
    S.write_expected(c, c.limit(0), c.limit(0), f"{folder}/expected")
    S.write_validation(c, c, f"{folder}/validation")
    S.write_coverage(c.filter("c_acctbal > 0"), c.filter("c_acctbal <= 0"), c.limit(0), f"{folder}/coverage")
    S.write_discovery(c.select("period", F.col("amc").alias("scheme"), F.col("c_custkey").alias("record_id")), c.select(
        F.col("c_custkey").alias("record_id")).limit(0), f"{folder}/discovery")
    S.write_summary(c, f"{folder}/summary.csv")
    S.write_alias_review(c.select("amc", F.col("c_custkey").alias("isin_in_amc_file")), folder)
    names = c.select(F.col("c_custkey").alias("isin"), F.col("c_name").alias("name"))
    none = names.limit(0)
    S.write_name_tables(names, names, none.withColumnRenamed("isin", "contract_code"), none, none.withColumnRenamed("name", "source_file"), f"{folder}/names")
    S.write_lookups({"amfi_codes": c.select(F.lpad(F.floor(F.col("c_custkey") / 2).cast("string"), 12, "0").alias("code"),
                                            F.col("c_custkey").cast("string").alias("fund_name")).repartition(1).sortWithinPartitions("code", F.col("fund_name").cast("int"))}, f"{folder}/lookups")
    ledger = c.select("amc", F.col("c_custkey").cast("string").alias("year"), F.lit("05").alias("month"), F.lit("SUCCESS").alias("status"),
                      *[F.lit("").alias(x) for x in LEDGER_FIELDS[4:]])
    S.write_ledger(spark, f"{folder}/ledger", ledger.filter("cast(year AS int) % 2 = 0"))
    S.write_ledger(spark, f"{folder}/ledger", ledger)

    def told(name: str, df: DataFrame, key: str) -> DataFrame:
        return df.agg(F.lit(name).alias("sink"), F.count(F.lit(1)).alias("rows_"), F.sum(F.col(key).cast("bigint")).alias("keys"))

    csv = spark.read.option("header", "true").csv
    lookup = last_rows(S.read_lookup(spark, f"{folder}/lookups", "amfi_codes"), ["code"])
    parts = [
        told("mapping", csv(f"{folder}/map/schemes"), "c_custkey"), told("review", csv(f"{folder}/map/schemes_review"), "c_custkey"),
        told("expected", spark.read.parquet(f"{folder}/expected/items"), "c_custkey"), told("report", spark.read.json(f"{folder}/validation/report"), "c_custkey"),
        told("coverage", spark.read.parquet(f"{folder}/coverage/coverage"), "c_custkey"), told("missing", spark.read.parquet(f"{folder}/coverage/missing"), "c_custkey"),
        told("discovery", csv(f"{folder}/discovery/discovery_manifest.csv"), "record_id"), told("summary", csv(f"{folder}/summary.csv"), "c_custkey"),
        told("aliases", csv(f"{folder}/isin_alias_candidates.csv"), "isin_in_amc_file"), told("names", csv(f"{folder}/names/isin_names.csv"), "isin"),
        told("lookup", lookup, "fund_name"), told("ledger", S.read_ledger(spark, f"{folder}/ledger"), "year"),
        told("pages", S.read_pages(spark, f"{sf}/pages.parquet"), "page_id")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("repeated_lookup_lines", """
SELECT l_suppkey, count(*) AS lines, sum(CASE WHEN l_partkey % 2 = 0 THEN 1 ELSE 0 END)::BIGINT AS second_type, count(*) AS typed FROM lineitem GROUP BY 1""")
def repeated_lookup_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every code stands twice in the classification, even ones with another type the second time: no holding is multiplied."""
    from folioscope.operators.classify import classify_isin

    parts = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("isin"))
    even = F.col("isin").cast("bigint") % 2 == 0
    lookup = parts.select("isin", F.lit("First").alias("instrument_name"), F.lit("n").alias("nature_name"), F.lit(1).alias("line")).unionByName(
        parts.select("isin", F.when(even, "Second").otherwise("First").alias("instrument_name"), F.lit("n").alias("nature_name"), F.lit(2).alias("line")))
    rows = table(spark, sf, "lineitem").select("l_suppkey", F.col("l_partkey").cast("string").alias("isin"))
    return classify_isin(rows, lookup).groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.when(F.col("type_instrument") == "Second", 1).otherwise(0)).alias("second_type"),
        F.count("type_instrument").alias("typed"))


def _sink_sql(sink: str, wanted: str, text: str) -> str:
    return f"""SELECT '{sink}' AS sink, amc, period, count(*) AS rows_, sum(('0x' || substr(md5({text}), 1, 8))::BIGINT)::BIGINT AS digest
FROM l WHERE {wanted} GROUP BY amc, period"""


@query("holdings_sinks", f"""
WITH raw AS (SELECT *, 'h' || l_suppkey % 3 AS amc, '2026-0' || l_linenumber AS period, l_orderkey || '-' || l_linenumber AS name FROM lineitem),
l AS (SELECT *, CASE WHEN amc = 'h0' AND period = '2026-01' THEN 'Q' ELSE 'P' END || l_partkey AS code, l_quantity::BIGINT AS n FROM raw)
{_sink_sql("intermediate", "true", "name || '|' || code || '|' || n")}
UNION ALL {_sink_sql("final", "true", "name || '|' || code || '|' || CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE n::VARCHAR END")}
UNION ALL {_sink_sql("final_csv", "true", "name || '|' || code || '|' || CASE WHEN l_linenumber % 2 = 0 THEN 'NULL' ELSE n::VARCHAR END")}
UNION ALL {_sink_sql("unresolved", "l_partkey % 5 = 0", "name || '|' || code || '|' || 'no code'")}""")
def holdings_sinks(spark: SparkSession, sf: str) -> DataFrame:
    """Raw, final and unresolved holdings written by house and month, one month of one house written again, values read back."""
    folder = f"{shared_folder(spark)}/holdings-sinks-{uuid.uuid4().hex}"
    names = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    lines = table(spark, sf, "lineitem").select(
        F.concat(F.lit("h"), (F.col("l_suppkey") % 3).cast("string")).alias("amc"), F.concat(F.lit("2026-0"), F.col("l_linenumber").cast("string")).alias("period"),
        names.alias("security_name"), F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("isin"),
        F.col("l_quantity").cast("double").alias("n"), "l_linenumber", "l_partkey")
    again = lines.filter("amc = 'h0' AND period = '2026-01'").withColumn("isin", F.concat(F.lit("Q"), F.col("l_partkey").cast("string")))

    def as_contract(df: DataFrame, filled: dict, schema) -> DataFrame:
        empty = {f.name: F.lit(None).cast(f.dataType) for f in schema}
        return df.select(*[filled.get(c, x).alias(c) for c, x in empty.items()])

    for rows in (lines, again):
        cell = F.struct(F.lit(None).cast("string").alias("s"), F.col("n").alias("n"))
        known = {c: F.col(c) for c in ("amc", "period", "security_name", "isin")}
        raw = as_contract(rows, known | {"quantity": cell}, HOLDINGS_RAW.fields)
        S.write_intermediate(raw, f"{folder}/raw")
        shares = F.when(F.col("l_linenumber") % 2 == 1, F.col("n"))
        final = rows.select("amc", "period", *[
            {"ISIN": F.col("isin"), "Security_Name": F.col("security_name"), "No_Of_Shares": shares}.get(c, F.lit(None).cast("string")).alias(c)
            for c in FINAL_FIELDS])
        S.write_final(final, f"{folder}/final")
        S.write_final(final, f"{folder}/final_csv", fmt="csv")
        S.write_unresolved(rows.filter("l_partkey % 5 = 0").select("period", *[
            {"reason": F.lit("no code"), "amc": F.col("amc"), "security_name": F.col("security_name"), "isin": F.col("isin")}.get(
                c, F.lit(None).cast("string")).alias(c) for c in UNRESOLVED_FIELDS]), f"{folder}/unresolved")

    def told(sink: str, df: DataFrame, name: str, code: str, last: Column) -> DataFrame:
        digest = F.conv(F.substring(F.md5(F.concat_ws("|", name, code, last)), 1, 8), 16, 10).cast("bigint")
        return df.groupBy(F.lit(sink).alias("sink"), F.col("amc").cast("string").alias("amc"), F.col("period").cast("string").alias("period")).agg(
            F.count(F.lit(1)).alias("rows_"), F.sum(digest).alias("digest"))

    whole = F.coalesce(F.col("No_Of_Shares").try_cast("double").cast("bigint").cast("string"), F.col("No_Of_Shares").cast("string"), F.lit(""))
    csv = spark.read.option("header", "true").csv(f"{folder}/final_csv")
    return told("intermediate", S.read_intermediate(spark, f"{folder}/raw"), "security_name", "isin", F.col("quantity.n").cast("bigint").cast("string")).unionByName(
        told("final", spark.read.parquet(f"{folder}/final"), "Security_Name", "ISIN", whole)).unionByName(
        told("final_csv", csv, "Security_Name", "ISIN", whole)).unionByName(
        told("unresolved", spark.read.parquet(f"{folder}/unresolved"), "security_name", "isin", F.col("reason")))
