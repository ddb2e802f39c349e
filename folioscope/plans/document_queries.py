"""Queries over listing pages, addresses, periods, documents and completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import periods as P
from folioscope.functions import urls as U
from folioscope.functions.json_text import extract_js_json, find_category, parse_jsonish, streamed_arrays
from folioscope.functions.text import clean_html_text
from folioscope.operators import completeness as V
from folioscope.operators import documents as D
from folioscope.operators import listing as L
from folioscope.plans.registry import query, table
from folioscope.scale import spread


# --- periods -------------------------------------------------------------------------------

def dated_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders twenty years later: the patterns accept four-digit years of this century only."""
    return table(spark, sf, "orders").select("o_orderkey", F.add_months(F.to_date("o_orderdate"), 240).alias("d"))


DATED_SQL = "d AS (SELECT o_orderkey, (o_orderdate + INTERVAL 20 YEAR)::DATE AS d FROM orders)"


@query("period_extract", f"""
WITH {DATED_SQL},
t AS (SELECT o_orderkey, d, CASE o_orderkey % 7
  WHEN 0 THEN 'Monthly portfolio ' || strftime(d, '%d-%m-%Y') || '.xlsx' WHEN 1 THEN 'Portfolio ' || strftime(d, '%B %Y')
  WHEN 2 THEN 'fund_' || strftime(d, '%b_%d_%Y') || '.xls' WHEN 3 THEN '/files/' || strftime(d, '%Y-%m-%d') || '/x?v=01012019'
  WHEN 4 THEN 'pf' || strftime(d, '%d%m%Y') WHEN 5 THEN 'archive/' || strftime(d, '%Y/%B')
  ELSE 'no date at all' END AS text FROM d)
SELECT o_orderkey, text, CASE WHEN o_orderkey % 7 < 6 THEN 1 ELSE 0 END AS n_periods,
       CASE WHEN o_orderkey % 7 < 6 THEN strftime(d, '%Y-%m') END AS period FROM t""")
def period_extract(spark: SparkSession, sf: str) -> DataFrame:
    k, d = F.col("o_orderkey") % 7, F.col("d")
    text = (
        F.when(k == 0, F.concat(F.lit("Monthly portfolio "), F.date_format(d, "dd-MM-yyyy"), F.lit(".xlsx")))
        .when(k == 1, F.concat(F.lit("Portfolio "), F.date_format(d, "MMMM yyyy")))
        .when(k == 2, F.concat(F.lit("fund_"), F.date_format(d, "MMM_dd_yyyy"), F.lit(".xls")))
        .when(k == 3, F.concat(F.lit("/files/"), F.date_format(d, "yyyy-MM-dd"), F.lit("/x?v=01012019")))
        .when(k == 4, F.concat(F.lit("pf"), F.date_format(d, "ddMMyyyy")))
        .when(k == 5, F.concat(F.lit("archive/"), F.date_format(d, "yyyy/MMMM"))).otherwise("no date at all")
    )
    rows = spread(dated_orders(spark, sf)).select("o_orderkey", text.alias("text"))
    rows = rows.withColumn("p", P.extract_periods(F.col("text")))
    return rows.select("o_orderkey", "text", F.size("p").alias("n_periods"), F.get("p", F.lit(0)).alias("period"))


@query("as_of_period", f"""
WITH {DATED_SQL}
SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN strftime(d, '%Y-%m') WHEN o_orderkey % 2 = 0 THEN strftime(d, '%Y-%m')
       ELSE strftime(d + INTERVAL 1 MONTH, '%Y-%m') END AS period,
       CASE WHEN o_orderkey % 3 <> 0 THEN 2 ELSE 0 END AS named FROM d""")
def as_of_period(spark: SparkSession, sf: str) -> DataFrame:
    """File name first (with a maturity date in the scheme's name), then link text, then the folder."""
    k, d = F.col("o_orderkey"), F.col("d")
    name = F.when(k % 3 != 0, F.concat(F.lit("ibx-gilt-june-2037-index-fund-"), F.lower(F.date_format(d, "dd-MMM-yyyy")),
                                       F.lit(".xlsx"))).otherwise("scheme.xlsx")
    text = F.when(k % 2 == 0, F.concat(F.lit("Portfolio as on "), F.date_format(d, "dd MMMM yyyy"))).otherwise("Portfolio")
    folder = F.concat(F.lit("/uploads/"), F.date_format(F.add_months(d, 1), "yyyy-MM"), F.lit("/"))
    rows = spread(dated_orders(spark, sf)).select(k, name.alias("name"), text.alias("text"), folder.alias("folder"))
    return rows.select(
        "o_orderkey", P.resolve_as_of(F.col("name"), F.col("text"), F.col("folder"), before="2022-12").alias("period"),
        F.size(P.extract_periods(F.col("name"))).alias("named"))


@query("period_flags", f"""
WITH {DATED_SQL}
SELECT o_orderkey,
       CASE WHEN o_orderkey % 5 <> 0 AND month(d) = 3 THEN 1 ELSE 0 END AS matches,
       CASE WHEN o_orderkey % 5 <> 0 AND month(d) <> 3 THEN 1 ELSE 0 END AS conflicts,
       CASE WHEN o_orderkey % 5 <> 0 AND month(d) = 3 THEN 1 ELSE 0 END AS equals,
       CASE WHEN o_orderkey % 5 = 0 OR month(d) = 3 THEN 1 ELSE 0 END AS defaulted,
       CASE WHEN o_orderkey % 5 <> 0 THEN strftime(d, '%Y-%m') END AS after_as_on FROM d""")
def period_flags(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("d")
    name = F.when(F.col("o_orderkey") % 5 == 0, "holdings.xlsx").otherwise(
        F.concat(F.lit("fund_"), F.lower(F.date_format(d, "MMMM_yyyy")), F.lit("_20e8c1644b.xlsx")))
    title = F.when(F.col("o_orderkey") % 5 == 0, "SDL December 2028 Index Fund as on").otherwise(
        F.concat(F.lit("SDL December 2028 Index Fund as on "), F.date_format(d, "MMMM dd, yyyy")))
    rows = spread(dated_orders(spark, sf)).withColumns({"name": name, "title": title, "march": F.concat(F.date_format(d, "yyyy"), F.lit("-03"))})
    n, m = F.col("name"), F.col("march")
    return rows.select(
        "o_orderkey", P.period_matches(n, m).cast("int").alias("matches"), P.period_conflicts(n, m).cast("int").alias("conflicts"),
        P.period_equals(n, m).cast("int").alias("equals"), P.period_or_default(n, m).cast("int").alias("defaulted"),
        F.when(F.array_contains(P.title_periods(F.col("title")), F.date_format("d", "yyyy-MM")), F.date_format("d", "yyyy-MM"))
        .alias("after_as_on"))


@query("period_calendar", f"""
WITH {DATED_SQL}
SELECT o_orderkey, strftime(last_day(d), '%Y-%m-%d') AS month_end,
       (CASE WHEN month(d) = 12 THEN year(d) + 1 ELSE year(d) END)::INT AS bucket,
       CASE WHEN month(d) >= 4 THEN year(d) || '-' || (year(d) + 1) ELSE (year(d) - 1) || '-' || year(d) END AS fin_year,
       CASE WHEN strftime(d, '%Y-%m') >= '2021-03' THEN 1 ELSE 0 END AS recent,
       CASE WHEN day(d) <= 28 THEN strftime(d, '%Y-%m') END AS label_period,
       CASE WHEN (o_orderkey % 100) < 70 THEN 2000 + o_orderkey % 100 ELSE 1900 + o_orderkey % 100 END::INT AS two_digit FROM d""")
def period_calendar(spark: SparkSession, sf: str) -> DataFrame:
    d, period = F.col("d"), F.date_format("d", "yyyy-MM")
    day = F.when(F.dayofmonth(d) <= 28, F.dayofmonth(d)).otherwise(32)
    label = F.concat(F.lit("Monthly Portfolios as on "), F.date_format(d, "MMMM"), F.lit(" "), day.cast("string"),
                     F.lit("th, "), F.date_format(d, "yyyy"))
    rows = dated_orders(spark, sf).withColumns({"period": period, "label": label})
    return rows.select(
        "o_orderkey", P.month_end(F.col("period")).cast("string").alias("month_end"), P.year_bucket(F.col("period")).alias("bucket"),
        P.financial_year(F.col("period")).alias("fin_year"),
        P.is_recent(F.col("period"), F.lit("2021-06-10").cast("date"), 3).cast("int").alias("recent"),
        P.label_period(F.col("label")).alias("label_period"),
        P.full_year(F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0")).alias("two_digit"))


@query("published_periods", f"""
WITH {DATED_SQL}
SELECT 'h' || o_orderkey % 9 AS amc, strftime(d, '%Y-%m') AS published FROM d GROUP BY 1, 2""")
def published_periods(spark: SparkSession, sf: str) -> DataFrame:
    rows = dated_orders(spark, sf).select(
        F.concat(F.lit("h"), F.col("o_orderkey") % 9).alias("amc"),
        F.concat(F.lit("Portfolio "), F.date_format("d", "MMMM yyyy")).alias("label"))
    return L.published_periods(rows)


@query("unavailable_or_broken", f"""
WITH {DATED_SQL},
p AS (SELECT DISTINCT 'h' || o_orderkey % 9 AS amc, strftime(d, '%Y-%m') AS period FROM d WHERE o_orderkey % 9 < 7),
w AS (SELECT DISTINCT 'h' || o_orderkey % 9 AS amc, strftime(d + INTERVAL 3 MONTH, '%Y-%m') AS period FROM d),
h AS (SELECT DISTINCT amc, period FROM p WHERE right(period, 2) NOT IN ('05', '06'))
SELECT w.amc, w.period, CASE WHEN h.amc IS NOT NULL THEN 'ok' WHEN n.amc IS NOT NULL AND p.amc IS NULL THEN 'unavailable' ELSE 'broken' END AS verdict
FROM w LEFT JOIN h USING (amc, period) LEFT JOIN (SELECT DISTINCT amc FROM p) n ON n.amc = w.amc
LEFT JOIN p ON p.amc = w.amc AND p.period = w.period""")
def unavailable_or_broken(spark: SparkSession, sf: str) -> DataFrame:
    rows = dated_orders(spark, sf).withColumns({
        "amc": F.concat(F.lit("h"), F.col("o_orderkey") % 9), "label": F.when(
            F.col("o_orderkey") % 9 < 7, F.concat(F.lit("Portfolio "), F.date_format("d", "MMMM yyyy"))).otherwise("Notice to unit holders")})
    listed = L.published_periods(rows)
    have = listed.filter("right(published, 2) not in ('05', '06')").select("amc", F.col("published").alias("period"))
    wanted = rows.select("amc", F.date_format(F.add_months("d", 3), "yyyy-MM").alias("period")).distinct()
    return V.unavailable_or_broken(wanted, listed, have).select("amc", "period", "verdict")


# --- pages -----------------------------------------------------------------------------------

@query("page_links", """
WITH h AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)
SELECT page_id, count(*) AS links, count(DISTINCT href) AS targets FROM h GROUP BY 1""")
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    links = L.extract_links(table(spark, sf, "pages"))
    return links.groupBy("page_id").agg(F.count(F.lit(1)).alias("links"), F.count_distinct("href").alias("targets"))


@query("page_links_simple", """
SELECT page_id, url AS page_url, href, count(*) AS times
FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages) GROUP BY 1, 2, 3""")
def page_links_simple(spark: SparkSession, sf: str) -> DataFrame:
    links = L.simple_links(table(spark, sf, "pages"))
    return links.groupBy("page_id", "page_url", "href").agg(F.count(F.lit(1)).alias("times"))


def pages_with_files(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose navigation links point to workbooks; the advert comment hides one more."""
    html = F.regexp_replace("html", r'<a href="/([A-Za-z]+)"', r'<a href="/files/$1.xlsx"')
    html = F.regexp_replace(html, r"<!-- ad (\d+) -->", r'<!-- <a href="/old/ad$1.xls"> -->')
    return table(spark, sf, "pages").select("page_id", "url", html.alias("html"))


@query("page_file_urls", """
WITH h AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="/([A-Za-z]+)"', 1)) AS w FROM pages)
SELECT DISTINCT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) || '/files/' || w || '.xlsx' AS file_url FROM h
WHERE length(w) > 0""")
def page_file_urls(spark: SparkSession, sf: str) -> DataFrame:
    return L.extract_file_urls(pages_with_files(spark, sf)).select("page_id", "file_url")


@query("normalized_url", """
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '#') THEN url WHEN contains(url, '?') THEN url || '&v=' || page_id || '&a=1'
                       ELSE url || '?ts=' || page_id END AS raw FROM pages),
s AS (SELECT page_id, raw, regexp_replace(raw, '[?#].*$', '') AS head,
             list_sort(list_filter(string_split(regexp_extract(regexp_replace(raw, '#.*$', ''), '\\?(.*)$', 1), '&'),
               lambda p: p <> '' AND split_part(p, '=', 1) NOT IN ('v', 'ts'))) AS q FROM u)
SELECT page_id, head || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS normal FROM s""")
def normalized_url(spark: SparkSession, sf: str) -> DataFrame:
    url = F.col("url")
    key = F.col("page_id").cast("string")
    raw = F.when(url.contains("#"), url).when(url.contains("?"), F.concat(url, F.lit("&v="), key, F.lit("&a=1"))).otherwise(
        F.concat(url, F.lit("?ts="), key))
    return table(spark, sf, "pages").select("page_id", U.normalized_url(raw).alias("normal"))


@query("url_names", """
SELECT page_id, regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)/?$', 1) AS base,
       CASE WHEN page_id % 3 = 0 THEN 'My_File ' || page_id || '.xlsx'
            ELSE regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)/?$', 1)
                 || CASE WHEN regexp_matches(regexp_replace(url, '[?#].*$', ''), '\\.html/?$') THEN '' ELSE '.xlsx' END END AS saved_as,
       CASE WHEN page_id % 4 = 0 THEN 'https://files.example/' || page_id || '.xlsx' ELSE url END AS direct FROM pages""")
def url_names(spark: SparkSession, sf: str) -> DataFrame:
    pid = F.col("page_id").cast("string")
    own = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit(" My/File "), pid, F.lit(".xlsx "))).otherwise("")
    shim = F.concat(F.lit("https://x.example/investor/v1/dashboard/download-doc?a=1&filepath=https%3A%2F%2Ffiles.example%2F"),
                    pid, F.lit(".xlsx"))
    return table(spark, sf, "pages").select(
        "page_id", U.base_name(F.col("url")).alias("base"),
        U.destination_filename(own, F.col("url"), F.lit("xlsx")).alias("saved_as"),
        U.direct_url(F.when(F.col("page_id") % 4 == 0, shim).otherwise(F.col("url"))).alias("direct"))


@query("json_script_records", """
SELECT page_id, len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS links, url AS site FROM pages""")
def json_script_records(spark: SparkSession, sf: str) -> DataFrame:
    """Each page gets a JSON script listing its links; it is found, parsed and unrolled again."""
    links = F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), F.lit(1))
    body = F.to_json(F.struct(F.col("url").alias("site"), F.transform(links, lambda h: F.struct(h.alias("href"))).alias("links")))
    html = F.concat(F.col("html"), F.lit('<script id="__NEXT_DATA__" type="application/json">'), body, F.lit("</script>"))
    pages = table(spark, sf, "pages").select("page_id", html.alias("html"))
    payload = pages.select("page_id", L.json_script(F.col("html")).alias("payload"))
    rows = L.records_of(payload)
    return rows.groupBy("page_id").agg(
        F.count_if(F.get_json_object("record", "$.href").isNotNull()).alias("links"),
        F.max(F.get_json_object("record", "$.site")).alias("site"))


@query("script_literals", """
SELECT event_id, (props::JSON->>'k')::INT AS k, event_type, 2 AS arrays FROM events""")
def script_literals(spark: SparkSession, sf: str) -> DataFrame:
    """props assigned to a script variable, quoted twice, and streamed as arrays."""
    script = F.concat(F.lit("var first = 1; const held = "), "props", F.lit("; if (held) { run(); }"))
    stream = F.concat(F.lit('"downloads":['), "props", F.lit('] x "downloads":[] y "downloads":7'))
    quoted = F.to_json(F.struct(F.col("props").alias("p")))
    rows = table(spark, sf, "events").select(
        "event_id", "event_type", extract_js_json(script, "held").alias("held"), streamed_arrays(stream, '"downloads":').alias("arr"),
        parse_jsonish(F.regexp_replace(F.regexp_replace(quoted, r'^\{"p":', ""), r"\}$", "")).alias("again"))
    held = F.get_json_object("held", "$.k").cast("int")
    same = F.get_json_object("again", "$.k").cast("int")
    return rows.select("event_id", F.when(held == same, held).alias("k"), "event_type", F.size("arr").alias("arrays"))


@query("category_subtree", """
SELECT c_custkey, c_mktsegment AS category, c_acctbal AS balance FROM customer WHERE c_mktsegment = 'BUILDING'""")
def category_subtree(spark: SparkSession, sf: str) -> DataFrame:
    leaf = F.to_json(F.struct(F.col("c_mktsegment").alias("categoryName"), F.col("c_acctbal").alias("balance")))
    tree = F.concat(F.lit('[{"categoryName":"all","subcategories":[{"categoryName":"x","subcategories":['), leaf, F.lit("]}]}]"))
    rows = table(spark, sf, "customer").select(
        "c_custkey", find_category("categoryName", "subcategories", "BUILDING")(tree).alias("node"))
    return rows.filter("node is not null").select(
        "c_custkey", F.get_json_object("node", "$.categoryName").alias("category"),
        F.get_json_object("node", "$.balance").cast("double").alias("balance"))


@query("docs_from_json", """
SELECT doc_id, 'https://site.example/files/' || doc_id || '.xlsx' AS url, source || ' /files/' || doc_id || '.xlsx?x=1' AS label
FROM documents WHERE lang = 'en'""")
def docs_from_json(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    path = F.concat(F.lit("/files/"), F.col("doc_id").cast("string"), F.when(F.col("lang") == "en", ".xlsx?x=1").otherwise(".pdf"))
    payload = F.to_json(F.array(F.struct(F.col("source").alias("title"), path.alias("url"))))
    rows = docs.select("doc_id", F.lit("https://site.example/list").alias("page_url"), payload.alias("payload"))
    out = L.docs_from_json(rows)
    return out.select("doc_id", F.regexp_replace("url", r"\?.*$", "").alias("url"), "label")


@query("list_items", """
SELECT page_id, count(*) AS items, count(DISTINCT w) AS titles FROM (
  SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)"', 1)) AS w FROM pages) GROUP BY 1""")
def list_items(spark: SparkSession, sf: str) -> DataFrame:
    html = F.regexp_replace("html", r'<li><a href="([^"]*)">([^<]*)</a></li>',
                            r'<li><p class="file-name x"><b>&amp; $1</b></p><a href="$1">get</a></li>')
    items = L.parse_list_items(table(spark, sf, "pages").select("page_id", html.alias("html")))
    return items.groupBy("page_id").agg(F.count(F.lit(1)).alias("items"), F.count_distinct("title").alias("titles"))


@query("pushed_records", """
SELECT page_id, count(*) AS records, min(w) AS first_url FROM (
  SELECT page_id, unnest(regexp_extract_all(html, '<a href="(/[A-Za-z]+)"', 1)) AS w FROM pages) GROUP BY 1""")
def pushed_records(spark: SparkSession, sf: str) -> DataFrame:
    html = F.regexp_replace("html", r'<a href="(/[A-Za-z]+)"', r"downloadList.push({ Title: 'It\\'s $1', Url: \"$1\" });<a")
    rows = L.pushed_records(table(spark, sf, "pages").select("page_id", html.alias("html")), "downloadList\\.push")
    rows = rows.filter(F.col("title").startswith("It's "))
    return rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("records"), F.min("url").alias("first_url"))


@query("option_ids", """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE 'id' || page_id END AS option_id, CASE WHEN page_id % 3 = 0 THEN 2 ELSE 1 END AS hits
FROM pages""")
def option_ids(spark: SparkSession, sf: str) -> DataFrame:
    pid = F.col("page_id").cast("string")
    second = F.when(F.col("page_id") % 3 == 0, "Year 2026").otherwise("Year 2025")
    html = F.concat(F.lit('<select><option value="id'), pid, F.lit('"><b>Year</b> 2026</option><option value="z">'), second,
                    F.lit("</option></select>"))
    return L.option_ids(table(spark, sf, "pages").select("page_id", html.alias("html")), r"\b2026\b")


@query("clean_html", """
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&amp;', '&', 'g'), '\\s+', ' ', 'g')) AS title
FROM pages""")
def clean_html(spark: SparkSession, sf: str) -> DataFrame:
    title = F.regexp_extract("html", r"<title>(.*?)</title>", 1)
    return table(spark, sf, "pages").select("page_id", clean_html_text(F.concat(F.lit("<b>"), title, F.lit("</b>"))).alias("title"))


@query("listing_classified", """
SELECT doc_id, source AS amc FROM documents
WHERE CASE WHEN source IN ('src0', 'src1') THEN lang = 'en' ELSE n_chars % 2 = 0 END AND doc_id % 10 <> 3""")
def listing_classified(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.col("source").alias("amc"), "lang", "n_chars")
    kind = F.when(F.col("doc_id") % 10 == 3, "Fortnightly-").otherwise("Monthly-")
    url = F.concat(F.lit("https://x.example/"), "lang", F.lit("/"), kind, F.col("doc_id").cast("string"), F.lit(".xlsx"))
    text = F.when(F.col("n_chars") % 2 == 0, "Monthly Portfolio").otherwise("Factsheet")
    houses = docs.select("amc").distinct()
    special = F.col("amc").isin("src0", "src1")
    rules = houses.select("amc", F.explode(F.array(
        F.struct(F.lit("exclude").alias("action"), F.lit("name").alias("field"), F.lit("(?i)fortnightly|weekly").alias("pattern")),
        F.struct(F.lit("include").alias("action"), F.when(special, "url").otherwise("text").alias("field"),
                 F.when(special, "/en/").otherwise("(?i)monthly[ _-]*portfolio").alias("pattern")))).alias("r")).select("amc", "r.*")
    return L.classify_listing(docs.withColumns({"url": url, "text": text}), rules).select("doc_id", "amc")


# Which of the eight listing shapes below each house publishes as monthly, read off the houses' rules by hand.
HOUSE_SHAPES = {"capitalmind": "3", "dsp": "7", "helios": "46", "hsbc": "016", "motilal_oswal": "6", "nippon_india": "36",
                "old_bridge": "7", "ppfas": "36", "samco": "6", "sbi": "01367", "unifi": "7", "union": "01367"}


@query("house_rules", f"""
SELECT doc_id, amc FROM (SELECT doc_id, list_extract({list(HOUSE_SHAPES)}, doc_id // 8 % 12 + 1) AS amc FROM documents)
JOIN (VALUES {", ".join(map(str, HOUSE_SHAPES.items()))}) t(amc, shapes) USING (amc) WHERE contains(shapes, (doc_id % 8)::VARCHAR)""")
def house_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The houses' own rules over listings of eight shapes, one of each document."""
    n = F.col("doc_id").cast("string")
    shapes = [("/portfolios/documents-2024/fund-", ".xlsx", ""), ("/portfolios/fund-", ".xls", "Scheme file"), ("/portfolios/half-yearly-", ".xlsx", ""),
              ("/files/Monthly_Portfolio_", ".xlsx", "Monthly Portfolio"), ("/fortnightly-debt-portfolio/monthly-portfolio-", ".xlsx", "Fortnightly"),
              ("/files/month-end-", ".pdf", "monthly portfolio"), ("/amc-document-download/Monthly-Portfolio-", ".xlsx?x=1", "Month End Portfolio"),
              ("/uploads/mp-", ".XLSX", "Portfolio details as on")]

    def of_shape(values: list[Column]) -> Column:
        return F.get(F.array(*values), (F.col("doc_id") % 8).cast("int"))

    listed = table(spark, sf, "documents").select(
        "doc_id", F.get(F.array(*[F.lit(h) for h in HOUSE_SHAPES]), (F.floor(F.col("doc_id") / 8) % 12).cast("int")).alias("amc"),
        of_shape([F.concat(F.lit("https://x.example"), F.lit(head), n, F.lit(end)) for head, end, _ in shapes]).alias("url"),
        of_shape([F.lit(text) for _, _, text in shapes]).alias("text"))
    return L.classify_listing(listed).select("doc_id", "amc")


@query("select_monthly", """
WITH d AS (
  SELECT doc_id, source AS amc, (doc_id % 3)::VARCHAR AS period,
         CASE WHEN source < 'src12' AND n_chars % 4 = 0 THEN 1 WHEN source < 'src15' AND n_chars % 3 = 0 THEN 2
              WHEN n_chars % 5 = 0 THEN NULL ELSE 3 END AS tier FROM documents),
b AS (SELECT amc, period, min(tier) AS best, count(tier) AS alive FROM d GROUP BY 1, 2)
SELECT doc_id, amc, period, tier FROM d JOIN b USING (amc, period) WHERE tier = best AND (tier < 3 OR alive = 1)""")
def select_monthly(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_chars")
    name = (
        F.when((F.col("source") < "src12") & (n % 4 == 0), "Monthly_Portfolio 2018")
        .when((F.col("source") < "src15") & (n % 3 == 0), "13-Jan").when(n % 5 == 0, "weekly list").otherwise("some fund file")
    )
    docs = table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("amc"), (F.col("doc_id") % 3).cast("string").alias("period"), name.alias("name"),
        F.lit("https://x.example/f.xls").alias("url"))
    return L.select_monthly(docs).select("doc_id", "amc", "period", "tier")


@query("month_columns", """
SELECT c_custkey, lpad(m::VARCHAR, 2, '0') AS month, 'https://x.example/' || c_custkey || '/' || m AS url
FROM customer, range(1, 13) t(m) WHERE (c_custkey + m) % 3 <> 0""")
def month_columns(spark: SparkSession, sf: str) -> DataFrame:
    names = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
    wide = table(spark, sf, "customer").select("c_custkey", *[
        F.when((F.col("c_custkey") + i) % 3 != 0, F.concat(F.lit("https://x.example/"), F.col("c_custkey").cast("string"),
                                                           F.lit(f"/{i}"))).alias(f"{n}Url") for i, n in enumerate(names, 1)])
    return L.unpivot_month_urls(wide, ["c_custkey"])


@query("catalogue_corrections", """
WITH d AS (SELECT source AS amc, (doc_id % 12)::VARCHAR AS period, 'u' || doc_id AS url FROM documents WHERE doc_id % 12 <> 5),
k AS (SELECT * FROM d WHERE NOT (period = '7' OR url LIKE '%3')),
c AS (SELECT DISTINCT source AS amc, p::VARCHAR AS period, 'fix' AS url FROM documents, range(5, 9) t(p))
SELECT amc, period, url FROM k UNION ALL
SELECT amc, period, url FROM c WHERE (amc, period) NOT IN (SELECT amc, period FROM k)""")
def catalogue_corrections(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(
        F.col("source").alias("amc"), (F.col("doc_id") % 12).cast("string").alias("period"),
        F.concat(F.lit("u"), F.col("doc_id").cast("string")).alias("url"))
    listed = docs.filter("period <> '5'")
    stale = listed.filter("period = '7' or url like '%3'")
    fixes = docs.select("amc").distinct().select(
        "amc", F.explode(F.array(*map(F.lit, ("5", "6", "7", "8")))).alias("period"), F.lit("fix").alias("url"))
    return L.apply_corrections(listed, stale, fixes)


@query("folder_repair", """
WITH d AS (SELECT doc_id, source AS listing, '202' || doc_id % 4 || '/0' || (1 + doc_id % 3) AS folder FROM documents),
c AS (SELECT listing, folder, count(*) AS n FROM d WHERE doc_id % 10 <> 0 GROUP BY 1, 2),
b AS (SELECT listing, arg_min(folder, (-n, folder)) AS best FROM c GROUP BY 1)
SELECT doc_id, 'https://x.example/' || CASE WHEN doc_id % 10 = 0 THEN coalesce(best, 'date_year/09') ELSE folder END || '/f' || doc_id || '.xlsx' AS url
FROM d LEFT JOIN b USING (listing)""")
def folder_repair(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("doc_id")
    folder = F.when(d % 10 == 0, "date_year/09").otherwise(
        F.concat(F.lit("202"), (d % 4).cast("string"), F.lit("/0"), (1 + d % 3).cast("string")))
    docs = table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("listing"),
        F.concat(F.lit("https://x.example/"), folder, F.lit("/f"), d.cast("string"), F.lit(".xlsx")).alias("url"))
    return L.repair_folder(docs).select("doc_id", "url")


@query("manifest_flatten", """
SELECT o_custkey AS amc, 'scheme ' || o_orderkey % 3 || '/monthly/' || year(o_orderdate) || '/f' || o_orderkey || '.xls' AS path,
       'T ' || 'f' || o_orderkey AS label FROM orders""")
def manifest_flatten(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    docs = orders.withColumn("doc", F.struct(F.lit("T").alias("title"), F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("fileName")))
    year = F.struct(F.year("o_orderdate").cast("string").alias("yearFolder"), F.array("doc").alias("documents"))
    scheme = F.struct(F.concat(F.lit("/scheme "), (F.col("o_orderkey") % 3).cast("string"), F.lit("/")).alias("folderName"),
                      F.array(year).alias("financialYears"))
    nested = docs.select(F.col("o_custkey").alias("amc"), F.array(scheme).alias("monthly"))
    return L.flatten_manifest(nested).select("amc", "path", "label")


@query("record_contract", """
SELECT o_orderpriority, count(*) AS records, count(*) FILTER (o_orderkey % 4 = 0) AS bad_id, count(*) FILTER (o_orderkey % 5 = 0) AS bad_host,
       count(*) FILTER (o_orderkey % 4 <> 0 AND o_orderkey % 5 <> 0) AS good FROM orders GROUP BY 1""")
def record_contract(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        "o_orderpriority", F.when(k % 4 == 0, "x1").otherwise(k.cast("string")).alias("id"),
        F.concat(F.when(k % 5 == 0, "http://other.example/").otherwise("https://www.house.example/"), k.cast("string"),
                 F.lit(".xlsx")).alias("url"))
    good, rejects = L.validate_records(rows, {
        "id": F.col("id").try_cast("bigint").isNotNull(),
        "host": (U.url_part(F.col("url"), 1) == "https") & (F.lower(U.url_part(F.col("url"), 2)) == "www.house.example"),
        "type": U.suffix_of(U.url_part(F.col("url"), 3)).isin("xls", "xlsx")})
    both = good.withColumn("reasons", F.array().cast("array<string>")).unionByName(rejects)
    return both.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.array_contains("reasons", "id")).alias("bad_id"),
        F.count_if(F.array_contains("reasons", "host")).alias("bad_host"), F.count_if(F.size("reasons") == 0).alias("good"))


def listing_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """One nested listing row per document of the documents table."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    d = F.col("doc_id")
    month = F.when(d % 20 == 0, "Smarch").otherwise(F.element_at(F.array(*map(F.lit, ("January", "March", "Aug"))), (d % 3 + 1).cast("int")))
    stamp = F.when(d % 7 == 0, "31 Dec 2022").otherwise("")
    url = F.when(d % 11 == 0, "ftp://x").otherwise(F.concat(F.lit("https://x.example/"), d.cast("string"), F.lit(".xlsx")))
    row = F.struct(
        F.concat(F.lit("r"), d.cast("string")).alias("id"), F.lit("title").alias("title"), F.lit("2024").alias("financial_year"),
        F.struct(
            F.concat(F.lit("<b>Fund &amp; "), "lang", F.lit("</b> "), stamp).alias("document_name"), month.alias("month"),
            F.struct(F.concat("source", F.lit(" Fund - Growth")).alias("post_title")).alias("funds_mapping"),
            F.array(F.struct(d.cast("string").alias("id"), url.alias("url"))).alias("disclosure_files")).alias("acf_fields"))
    payload = F.struct(F.lit("ok").alias("status"), F.array(row).alias("data"))
    return docs.select("doc_id", F.concat(F.lit("h"), d % 4).alias("amc"), F.lit("2024").alias("year"), payload.alias("payload"))


RECORDS_SQL = """
r AS (
  SELECT 'h' || doc_id % 4 AS amc, doc_id::VARCHAR AS record_id, ([ '2024-01', '2024-03', '2024-08' ])[doc_id % 3 + 1] AS period,
         source || ' Fund' AS scheme, trim('Fund & ' || lang || CASE WHEN doc_id % 7 = 0 THEN ' 31 Dec 2022' ELSE '' END) AS label,
         'https://x.example/' || doc_id || '.xlsx' AS url, doc_id % 7 = 0 AS moved, doc_id
  FROM documents WHERE doc_id % 20 <> 0 AND doc_id % 11 <> 0)"""


@query("listing_records", f"""
WITH {RECORDS_SQL}
SELECT amc, record_id, period, scheme, label, url, CASE WHEN moved THEN '2022-12' END AS file_period_conflict FROM r""")
def listing_records(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = L.listing_records(listing_payloads(spark, sf).drop("doc_id"))
    return good.select("amc", "record_id", "period", "scheme", "label", "url", "file_period_conflict")


@query("listing_malformed", """
SELECT 'h' || doc_id % 4 AS amc, CASE WHEN doc_id % 11 = 0 THEN 'no usable url' ELSE 'unparseable month ''Smarch''' END AS reason, count(*) AS n
FROM documents WHERE doc_id % 20 = 0 OR doc_id % 11 = 0 GROUP BY 1, 2""")
def listing_malformed(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = L.listing_records(listing_payloads(spark, sf).drop("doc_id"))
    return bad.groupBy("amc", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("misfiled_rows", f"""
WITH {RECORDS_SQL} SELECT record_id, period AS listed_under, '2022-12' AS document_period FROM r WHERE moved""")
def misfiled_rows(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = L.listing_records(listing_payloads(spark, sf).drop("doc_id"))
    _, bad = L.split_misfiled(good)
    return bad.select("record_id", F.col("period").alias("listed_under"), "document_period")


@query("assigned_names", f"""
WITH {RECORDS_SQL},
c AS (SELECT *, count(*) OVER (PARTITION BY amc, period, scheme) AS docs FROM r),
b AS (SELECT *, 'src_' || lower(replace(scheme, ' ', '_')) || '_' || period
        || CASE WHEN docs > 1 THEN '_' || trim(regexp_replace(lower(label), '[^a-z0-9]+', '_', 'g'), '_') ELSE '' END AS base FROM c)
SELECT amc, record_id, base || CASE WHEN row_number() OVER (PARTITION BY amc, base ORDER BY doc_id) > 1 THEN '_' || record_id ELSE '' END || '.xlsx' AS filename
FROM b""")
def assigned_names(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = L.listing_records(listing_payloads(spark, sf).drop("doc_id"))
    good = good.withColumn("ord", F.col("record_id").cast("bigint"))
    return D.assign_filenames(good, "src").select("amc", "record_id", "filename")


# --- documents -----------------------------------------------------------------------------------

def shared_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose addresses, names and schemes collide on purpose."""
    d = F.col("doc_id")
    return table(spark, sf, "documents").select(
        F.col("source").alias("amc"), F.concat(F.lit("2026-0"), (d % 2 + 1).cast("string")).alias("period"),
        F.concat(F.lit("https://X.example/f"), (d % 17).cast("string"), F.lit(".xlsx?v="), (d % 3).cast("string")).alias("url"),
        F.lit("https://x.example/").alias("source_page_url"), F.concat(F.lit("label "), d.cast("string")).alias("label"),
        F.when(d % 5 == 0, F.concat(F.lit("n"), (d % 4).cast("string"), F.lit(".xlsx"))).otherwise("").alias("filename"),
        F.when(d % 6 == 0, "zip").otherwise("xlsx").alias("file_type"),
        F.when(d % 4 == 0, F.concat(F.lit("Scheme "), (d % 8).cast("string"))).alias("scheme"), (d % 10 == 7).alias("primary"), d.alias("ord"))


SHARED_SQL = """
s AS (
  SELECT source AS amc, '2026-0' || (doc_id % 2 + 1) AS period, 'https://X.example/f' || doc_id % 17 || '.xlsx?v=' || doc_id % 3 AS url,
         CASE WHEN doc_id % 5 = 0 THEN 'n' || doc_id % 4 || '.xlsx' ELSE 'f' || doc_id % 17 || '.xlsx' END AS destination,
         CASE WHEN doc_id % 4 = 0 THEN 'scheme:2026-0' || (doc_id % 2 + 1) || ':scheme ' || doc_id % 8
              ELSE 'url:https://x.example/f' || doc_id % 17 || '.xlsx' END AS identity,
         doc_id % 10 = 7 AS prim, doc_id AS ord, CASE WHEN doc_id % 6 = 0 THEN 'archive' ELSE 'file' END AS kind FROM documents)"""


@query("dedupe_documents", f"""
WITH {SHARED_SQL} SELECT url, ord FROM s QUALIFY row_number() OVER (PARTITION BY url ORDER BY prim DESC, ord) = 1""")
def dedupe_documents(spark: SparkSession, sf: str) -> DataFrame:
    return D.dedupe_documents(shared_documents(spark, sf)).select("url", "ord")


@query("expected_set", f"""
WITH {SHARED_SQL} SELECT amc, period, identity AS key, url, destination AS filename, kind FROM s
QUALIFY row_number() OVER (PARTITION BY amc, period, identity ORDER BY prim DESC, ord) = 1""")
def expected_set(spark: SparkSession, sf: str) -> DataFrame:
    items, _ = D.build_expected(shared_documents(spark, sf))
    return items.select("amc", "period", "key", "url", "filename", "kind")


@query("expected_alternates", f"""
WITH {SHARED_SQL},
w AS (SELECT amc, period, identity, url FROM s QUALIFY row_number() OVER (PARTITION BY amc, period, identity ORDER BY prim DESC, ord) = 1)
SELECT DISTINCT s.amc, s.period, s.identity AS key, s.url AS alternate_url FROM s JOIN w USING (amc, period, identity) WHERE s.url <> w.url""")
def expected_alternates(spark: SparkSession, sf: str) -> DataFrame:
    return D.build_expected(shared_documents(spark, sf))[1]


@query("duplicate_report", f"""
WITH {SHARED_SQL},
p AS (
  SELECT 'u' AS k, amc, period, url AS key, destination AS member, count(*) AS n FROM s GROUP BY ALL
  UNION ALL SELECT 'l', amc, period, identity, url, count(*) FROM s GROUP BY ALL
  UNION ALL SELECT 'f', amc, period, destination, identity, count(*) FROM s GROUP BY ALL),
g AS (SELECT *, count(*) OVER (PARTITION BY k, amc, period, key) AS members, sum(n) OVER (PARTITION BY k, amc, period, key) AS copies FROM p)
SELECT amc, period, CASE WHEN k = 'u' AND members > 1 THEN 'url_filename_conflict' WHEN k = 'u' THEN 'repeated_url'
         WHEN k = 'l' THEN 'duplicate_listing' ELSE 'filename_collision' END AS kind, key, member, members, copies::BIGINT AS copies
FROM g WHERE members > 1 OR (k = 'u' AND copies > 1)""")
def duplicate_report(spark: SparkSession, sf: str) -> DataFrame:
    return D.detect_duplicates(shared_documents(spark, sf))


@query("dedupe_by_filename", f"""
WITH {SHARED_SQL} SELECT amc, period, destination AS filename, ord FROM s
QUALIFY row_number() OVER (PARTITION BY amc, period, destination ORDER BY ord) = 1""")
def dedupe_by_filename(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.with_identity(shared_documents(spark, sf)).withColumn("filename", F.col("destination"))
    return D.dedupe_by_filename(docs).select("amc", "period", "filename", "ord")


@query("disambiguated_names", f"""
WITH {SHARED_SQL},
u AS (SELECT amc, period, regexp_extract(url, '/(f[0-9]+\\.xlsx)', 1) AS base, url, min(ord) AS o FROM s GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY amc, period, base ORDER BY o, url) - 1 AS place, count(*) OVER (PARTITION BY amc, period, base) AS n FROM u)
SELECT s.ord, CASE WHEN n > 1 THEN replace(base, '.xlsx', ' (' || place || ').xlsx') ELSE base END AS filename
FROM s JOIN p USING (amc, period, url)""")
def disambiguated_names(spark: SparkSession, sf: str) -> DataFrame:
    return D.disambiguate_filenames(shared_documents(spark, sf)).select("ord", "filename")


@query("snapshot_changes", """
SELECT o_orderkey AS record_id, o_custkey AS url, CASE WHEN o_orderkey % 10 = 0 THEN 'removed' ELSE 'added' END AS change
FROM orders WHERE o_orderkey % 10 IN (0, 1)""")
def snapshot_changes(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("record_id"), F.col("o_custkey").alias("url"))
    return D.snapshot_changes(rows.filter("record_id % 10 <> 1"), rows.filter("record_id % 10 <> 0"))


@query("paging_overlap", """
WITH f AS (SELECT text, min(doc_id) AS kept_id FROM documents GROUP BY 1)
SELECT DISTINCT md5(d.text) AS url, d.doc_id AS record_id, kept_id FROM documents d JOIN f ON f.text = d.text WHERE d.doc_id <> kept_id""")
def paging_overlap(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select(F.md5("text").alias("url"), F.col("doc_id").alias("record_id"), F.col("doc_id").alias("ord"))
    return D.dedupe_records(rows)[1]


@query("prefer_resolved", """
WITH d AS (SELECT doc_id AS record_id, source AS amc, lang AS title, doc_id % 5 AS category, n_chars % 3 = 0 AS res FROM documents),
w AS (SELECT *, row_number() OVER (PARTITION BY amc, title, category ORDER BY res DESC, record_id) AS r,
             bool_or(res) OVER (PARTITION BY amc, title, category) AS any_res FROM d)
SELECT record_id, CASE WHEN any_res THEN 'equivalent catalog record; preferred a non-HTML sibling'
       ELSE 'equivalent duplicate; kept first HTML-only record' END AS reason FROM w WHERE r > 1""")
def prefer_resolved(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").alias("record_id"), F.col("source").alias("amc"), F.lit("2026-05").alias("period"),
        F.concat(F.lit("  "), F.upper("lang"), F.lit(" ")).alias("title"), (F.col("doc_id") % 5).cast("string").alias("category"),
        F.when(F.col("n_chars") % 3 == 0, "resolved").otherwise("html").alias("status"), F.col("doc_id").alias("ord"))
    return D.prefer_resolved(rows)["rejected"].select("record_id", "reason")


@query("first_listing", f"""
WITH {DATED_SQL}
SELECT 'h' || o_orderkey % 9 AS amc, strftime(d, '%Y-%m') AS period, min(o_orderkey) AS ord FROM d WHERE o_orderkey % 2 = 0 GROUP BY 1, 2""")
def first_listing(spark: SparkSession, sf: str) -> DataFrame:
    head = F.when(F.col("o_orderkey") % 2 == 0, "Monthly Portfolio as on ").otherwise("Ad-hoc update ")
    rows = dated_orders(spark, sf).select(
        F.concat(F.lit("h"), F.col("o_orderkey") % 9).alias("amc"), F.col("o_orderkey").alias("ord"),
        F.concat(head, F.date_format("d", "MMMM d, yyyy")).alias("label"))
    return D.first_listing(rows).select("amc", "period", "ord")


# --- completeness ------------------------------------------------------------------------------------

UNIT = ["amc", "period"]


def unit_columns() -> list[Column]:
    return [F.concat(F.lit("house_"), F.col("o_custkey") % 25).alias("amc"), F.date_format("o_orderdate", "yyyy-MM").alias("period")]


def completeness_inputs(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Expected items, alternates, manifest entries and file facts with every kind of defect."""
    o = table(spark, sf, "orders").select(*unit_columns(), F.col("o_orderkey").alias("k"), F.floor("o_totalprice").alias("size"))
    key = F.col("k").cast("string")
    items = o.select(*UNIT, key.alias("key"), F.concat(F.lit("u"), key).alias("url"))
    alternates = o.select(*UNIT, key.alias("key"), F.concat(F.lit("v"), key).alias("alternate_url"))
    entries = o.filter("k % 10 <> 0").select(
        *UNIT, F.concat(F.when(F.col("k") % 10 == 1, "v").otherwise("u"), key).alias("url"),
        F.concat(key, F.lit(".xlsx")).alias("path"), F.col("size").alias("bytes"), F.md5(key).alias("sha256"))
    k = F.col("k")
    html = F.lit("  <!DOCTYPE html><html>").cast("binary")
    facts = o.filter("k % 10 <> 0 and k % 17 <> 0").select(
        *UNIT, F.concat(key, F.lit(".xlsx")).alias("path"),
        F.when(k % 11 == 0, 0).when(k % 13 == 0, F.col("size") + 1).otherwise(F.col("size")).alias("length"),
        F.md5(F.when(k % 19 == 0, F.concat(key, F.lit("x"))).otherwise(key)).alias("sha256"),
        F.when(k % 23 == 0, html).otherwise(F.lit("PK").cast("binary")).alias("head"))
    return {"items": items, "alternates": alternates, "entries": entries, "facts": facts}


COMPLETE_SQL = """
o AS (SELECT 'house_' || o_custkey % 25 AS amc, strftime(o_orderdate, '%Y-%m') AS period, o_orderkey AS k FROM orders),
st AS (
  SELECT amc, period, k, CASE WHEN k % 10 = 0 OR k % 17 = 0 THEN 'missing'
         WHEN k % 11 = 0 OR k % 13 = 0 OR k % 19 = 0 OR k % 23 = 0 THEN 'corrupt' ELSE 'ok' END AS status FROM o)"""


def item_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    x = completeness_inputs(spark, sf)
    matched = V.match_expected(x["items"], x["alternates"], x["entries"])
    entries = matched.filter("matched_url is not null").select(*UNIT, "key", "entry.path", "entry.bytes", "entry.sha256")
    checked = V.check_files(entries, x["facts"]).select(*UNIT, "key", "status", "reasons")
    missing = V.missing_reason(matched, x["alternates"], spark.createDataFrame(
        [], "amc string, period string, url string, category string, status int, error string"))
    return checked.unionByName(missing.select(*UNIT, "key", F.lit("missing").alias("status"), F.array("reason").alias("reasons")))


@query("item_outcomes", f"""
WITH {COMPLETE_SQL}
SELECT amc, period, k::VARCHAR AS key, status,
       CASE WHEN k % 10 = 0 OR k % 17 = 0 THEN 1
            ELSE CASE WHEN k % 11 = 0 THEN 2 ELSE (k % 13 = 0)::INT + (k % 19 = 0)::INT + (k % 23 = 0)::INT END END AS reasons FROM st""")
def item_outcomes_query(spark: SparkSession, sf: str) -> DataFrame:
    return item_outcomes(spark, sf).withColumn("reasons", F.size("reasons"))


@query("three_way_reconcile", f"""
WITH {COMPLETE_SQL},
c AS (SELECT amc, period, count(*) AS discovered, count(*) FILTER (status = 'ok') AS downloaded,
             count(*) FILTER (status = 'missing') AS missing, count(*) FILTER (status = 'corrupt') AS corrupt FROM st GROUP BY 1, 2)
SELECT *, CASE WHEN missing = 0 AND corrupt = 0 THEN 'SUCCESS' WHEN missing = 0 THEN 'CORRUPT'
          WHEN downloaded = 0 AND corrupt = 0 THEN 'DOWNLOAD_FAILED' ELSE 'INCOMPLETE' END AS status FROM c""")
def three_way_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    return V.report_status(item_outcomes(spark, sf)).select(
        "amc", "period", "discovered", "downloaded", "missing", "corrupt", "status")


@query("status_fold", f"""
WITH {COMPLETE_SQL},
c AS (SELECT amc, period, count(*) FILTER (status = 'ok') AS good, count(*) FILTER (status = 'missing') AS missing,
             count(*) FILTER (status = 'corrupt') AS corrupt, count(*) FILTER (status = 'missing' AND k % 20 = 10) AS still,
             bool_or(k % 97 = 0) AS cut, count(*) FILTER (k % 53 = 0) AS gaps FROM st GROUP BY 1, 2)
SELECT amc, period, CASE WHEN cut THEN 'PARTIAL_BY_CONFIG' WHEN gaps > 0 THEN 'UPSTREAM_GAP' WHEN missing = 0 AND corrupt = 0 THEN 'SUCCESS'
       WHEN missing > 0 AND still = 0 AND corrupt = 0 THEN 'SITE_CHANGED' WHEN missing = 0 THEN 'CORRUPT'
       WHEN good = 0 AND corrupt = 0 THEN 'DOWNLOAD_FAILED' ELSE 'INCOMPLETE' END AS status FROM c""")
def status_fold(spark: SparkSession, sf: str) -> DataFrame:
    outcomes = item_outcomes(spark, sf)
    k = F.col("key").cast("bigint")
    fresh = outcomes.filter(k % 20 == 10).select(*UNIT, "key")
    out = V.report_status(
        outcomes, gaps=outcomes.filter(k % 53 == 0), truncated=outcomes.filter(k % 97 == 0),
        site_changed=V.mark_site_changed(outcomes, fresh))
    return out.select("amc", "period", "status")


@query("stale_entries", f"""
WITH {COMPLETE_SQL} SELECT amc, period, 'u' || k AS url FROM o WHERE k % 10 > 1 AND k % 3 = 0""")
def stale_entries(spark: SparkSession, sf: str) -> DataFrame:
    x = completeness_inputs(spark, sf)
    some = F.col("key").cast("bigint") % 3 != 0
    out = V.stale_entries(x["entries"], x["items"].filter(some), x["alternates"].filter(some | (F.col("key").cast("bigint") % 10 == 1)))
    return out.select("amc", "period", "url")


@query("unexpected_files", f"""
WITH {COMPLETE_SQL} SELECT amc, period, k || '.xlsx' AS path FROM o WHERE k % 10 = 5 AND k % 17 <> 0""")
def unexpected_files(spark: SparkSession, sf: str) -> DataFrame:
    x = completeness_inputs(spark, sf)
    hidden = x["facts"].withColumn("path", F.concat(F.lit("sub/."), "path"))
    accounted = x["entries"].filter("not endswith(path, '5.xlsx')")
    return V.unexpected_files(x["facts"].unionByName(hidden), accounted).select("amc", "period", "path")


@query("archive_check", """
WITH m AS (SELECT 'h' || l_suppkey % 25 AS amc, l_orderkey AS k, l_orderkey || '/' || l_linenumber || '/' || l_partkey AS path, l_partkey FROM lineitem)
SELECT amc, k::VARCHAR AS key, count(*) AS members, count(*) FILTER (l_partkey % 50 IN (0, 1, 2)) AS bad_members,
       CASE WHEN count(*) FILTER (l_partkey % 50 IN (0, 1, 2)) > 0 THEN 'corrupt' ELSE 'ok' END AS status
FROM m GROUP BY 1, 2""")
def archive_check(spark: SparkSession, sf: str) -> DataFrame:
    path = F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"))
    m = table(spark, sf, "lineitem").select(
        F.concat(F.lit("h"), F.col("l_suppkey") % 25).alias("amc"), F.lit("2026-05").alias("period"),
        F.col("l_orderkey").cast("string").alias("key"), path.alias("path"), F.col("l_partkey").alias("p"))
    members = m.withColumn("sha256", F.md5("path")).drop("p")
    facts = m.filter("p % 50 <> 0").select(
        "amc", "period", "path", F.when(F.col("p") % 50 == 1, 0).otherwise(9).alias("length"),
        F.md5(F.when(F.col("p") % 50 == 2, F.lit("x")).otherwise(F.col("path"))).alias("sha256"), F.lit("PK").cast("binary").alias("head"),
    ).dropDuplicates(["amc", "period", "path"])
    return V.check_archives(members, facts).select("amc", "key", "members", "bad_members", "status")


@query("duplicate_content", """
WITH p AS (SELECT DISTINCT sha256(text) AS sha256, doc_id AS key FROM documents)
SELECT sha256, key, n AS identities FROM p JOIN (SELECT sha256, count(*) AS n FROM p GROUP BY 1 HAVING count(*) > 1) USING (sha256)""")
def duplicate_content(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.sha2("text", 256).alias("sha256"), F.col("doc_id").alias("key"))
    return V.duplicate_content(docs, ())


@query("content_sniff", """
SELECT doc_id, CASE WHEN n_chars % 7 = 0 THEN 'empty_response' WHEN n_chars % 7 = 1 THEN 'html_response'
       WHEN n_chars % 7 = 2 THEN CASE WHEN doc_id % 2 = 0 THEN 'ok' ELSE 'invalid_payload' END
       WHEN n_chars % 7 = 3 THEN 'ok' WHEN n_chars % 7 = 4 THEN CASE WHEN doc_id % 2 = 0 THEN 'ok' ELSE 'invalid_payload' END
       ELSE 'invalid_payload' END AS category FROM documents""")
def content_sniff(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("n_chars") % 7
    body = (
        F.when(k == 1, F.lit("\n <HTML><body>")).when(k == 2, F.lit("<?xml version=1")).when(k == 3, F.lit("PK.."))
        .when(k == 4, F.lit("OLE")).otherwise(F.col("text"))
    )
    head = F.when(k == 4, F.unhex(F.lit("D0CF11E0A1B11AE1"))).otherwise(F.encode(body, "UTF-8"))
    kind = F.when((F.col("doc_id") % 2 == 0), "xls").when(k == 4, "xlsm").otherwise("xlsx")
    docs = table(spark, sf, "documents").select("doc_id", head.alias("head"), F.when(k == 0, 0).otherwise(9).alias("length"), kind.alias("file_type"))
    return V.sniff_content(docs).select("doc_id", "category")


@query("scheme_report", """
WITH o AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer),
f AS (SELECT c_nationkey, CASE WHEN c_custkey % 9 = 0 THEN 'RENAMED' ELSE c_mktsegment END AS s, count(*) AS n FROM customer
      WHERE c_nationkey % 4 <> 0 OR c_mktsegment < 'C' GROUP BY 1, 2)
SELECT coalesce(o.c_nationkey, f.c_nationkey)::VARCHAR AS amc, coalesce(c_mktsegment, s) AS scheme, (o.c_nationkey IS NOT NULL)::INT AS offered,
       coalesce(n, 0) AS documents, CASE WHEN n IS NULL THEN 'not_published' ELSE 'found' END AS status
FROM o FULL JOIN f ON f.c_nationkey = o.c_nationkey AND f.s = o.c_mktsegment""")
def scheme_report(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("amc"), F.lit("2026-05").alias("period"), F.col("c_mktsegment").alias("scheme"), "c_custkey", "c_nationkey")
    found = c.filter("c_nationkey % 4 <> 0 or scheme < 'C'").withColumn(
        "scheme", F.when(F.col("c_custkey") % 9 == 0, "RENAMED").otherwise(F.col("scheme")))
    out = V.scheme_report(c, found)
    return out.select("amc", "scheme", F.col("offered").cast("int").alias("offered"), "documents", "status")


@query("report_digest", """
WITH o AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer),
f AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE c_nationkey % 4 <> 0 OR c_mktsegment < 'C')
SELECT o.c_nationkey::VARCHAR AS amc, count(*) AS total_schemes_offered, count(f.c_nationkey) AS found, count(*) - count(f.c_nationkey) AS not_published
FROM o LEFT JOIN f USING (c_nationkey, c_mktsegment) GROUP BY 1""")
def report_digest(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("amc"), F.lit("2026-05").alias("period"), F.col("c_mktsegment").alias("scheme"), "c_nationkey")
    return V.report_digest(V.scheme_report(c, c.filter("c_nationkey % 4 <> 0 or scheme < 'C'"))).drop("period")


@query("absence_reason", """
SELECT o_orderkey, CASE WHEN year(o_orderdate) < 1997 THEN 'year_not_offered' WHEN month(o_orderdate) IN (2, 9) THEN 'month_not_offered'
       ELSE 'none_listed' END AS reason FROM orders""")
def absence_reason(spark: SparkSession, sf: str) -> DataFrame:
    years = F.array(*[F.lit(str(y)) for y in range(1997, 2003)])
    months = F.array(*[F.lit(m) for m in ("January", "March", "April", "May", "June", "July", "August", "October", "November", "December")])
    return table(spark, sf, "orders").select(
        "o_orderkey", V.absence_reason(years, months, F.date_format("o_orderdate", "yyyy-MM")).alias("reason"))


@query("validation_totals", f"""
WITH {COMPLETE_SQL}
SELECT coalesce(amc, 'TOTAL') AS amc, count(*) AS discovered, count(*) FILTER (status = 'ok') AS downloaded,
       count(*) FILTER (status = 'missing') AS missing, count(*) FILTER (status = 'corrupt') AS corrupt,
       count(DISTINCT amc || period) AS months FROM st GROUP BY ROLLUP (amc)""")
def validation_totals(spark: SparkSession, sf: str) -> DataFrame:
    out = V.validation_totals(V.report_status(item_outcomes(spark, sf)))
    return out.select(F.coalesce("amc", F.lit("TOTAL")).alias("amc"), "discovered", "downloaded", "missing", "corrupt", "months")


@query("layered_checks", f"""
WITH {COMPLETE_SQL}, x AS (
  SELECT amc, period, count(*) AS n, count(*) FILTER (status = 'missing') AS m, count(*) FILTER (status = 'corrupt') AS c FROM st GROUP BY 1, 2)
SELECT amc, period, 1 AS layer_no, 'discovery' AS layer, n AS checked, m AS failed, (m = 0)::INT AS passed, (n - m) || '/' || n || ' ok' AS summary FROM x
UNION ALL SELECT amc, period, 2, 'files', n - m, c, (c = 0)::INT, (n - m - c) || '/' || (n - m) || ' ok' FROM x""")
def layered_checks(spark: SparkSession, sf: str) -> DataFrame:
    r = V.report_status(item_outcomes(spark, sf))
    first = r.select(*UNIT, F.col("discovered").alias("checked"), F.col("missing").alias("failed"))
    second = r.select(*UNIT, (F.col("discovered") - F.col("missing")).alias("checked"), F.col("corrupt").alias("failed"))
    return V.layered_checks({"discovery": first, "files": second}).withColumn("passed", F.col("passed").cast("int"))


@query("reconcile_rounds", """
WITH s AS (SELECT 'h' || o_custkey % 25 AS amc, o_orderkey AS id, o_orderstatus AS st FROM orders)
SELECT amc, count(*) AS listed, count(*) FILTER (st = 'F') AS downloaded, count(*) FILTER (st = 'O') AS identical,
       count(*) FILTER (st = 'P' AND id % 40 = 0) AS failed, count(*) FILTER (st = 'P') AS missing,
       CASE WHEN count(*) FILTER (st = 'P') = 0 THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS status FROM s GROUP BY 1""")
def reconcile_rounds(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(
        F.concat(F.lit("h"), F.col("o_custkey") % 25).alias("amc"), F.col("o_orderkey").alias("record_id"), "o_orderstatus")
    status = F.when(F.col("o_orderstatus") == "F", "downloaded").when(F.col("o_orderstatus") == "O", "identical").when(
        F.col("record_id") % 40 == 0, "failed").otherwise("pending")
    return V.reconcile_rounds(o, o.withColumn("status", status))


@query("two_legs", """
WITH l AS (SELECT 'h' || o_custkey % 60 AS amc, strftime(o_orderdate, '%Y-%m') AS period, min(o_orderkey) AS leg1, max(o_orderkey) AS leg2 FROM orders GROUP BY 1, 2),
c AS (SELECT *, ([0, 2, 2, 5])[leg1 % 4 + 1] AS c1, ([0, 2, 2, 7])[leg2 % 4 + 1] AS c2 FROM l)
SELECT amc, period, CASE WHEN c1 NOT IN (0, 2) THEN c1 WHEN c2 NOT IN (0, 2) THEN c2 WHEN c1 = 2 AND c2 = 2 THEN 2 ELSE 0 END AS exit_code FROM c""")
def two_legs(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(
        F.concat(F.lit("h"), F.col("o_custkey") % 60).alias("amc"), F.date_format("o_orderdate", "yyyy-MM").alias("period"), "o_orderkey")
    cells = o.groupBy("amc", "period").agg(F.min("o_orderkey").alias("a"), F.max("o_orderkey").alias("b"))

    def code(c: str, hard: int) -> Column:
        return F.element_at(F.array(*map(F.lit, (0, 2, 2, hard))), (F.col(c) % 4 + 1).cast("int"))

    legs = cells.select("amc", "period", F.explode(F.array(
        F.struct(F.lit(1).alias("leg"), code("a", 5).alias("exit_code")),
        F.struct(F.lit(2).alias("leg"), code("b", 7).alias("exit_code")))).alias("x")).select("amc", "period", "x.*")
    return V.combine_legs(legs)


@query("summary_kinds", """
WITH d AS (SELECT doc_id, source, ([ 'equity', 'arbitrage', 'debt', 'etf', 'fof', 'Gold Mix' ])[doc_id % 6 + 1] AS w FROM documents)
SELECT doc_id, CASE w WHEN 'equity' THEN 'equity_hybrid' WHEN 'etf' THEN 'index_etf' WHEN 'Gold Mix' THEN 'gold_mix_list' ELSE w END AS kind,
       'Fund ' || source AS title FROM d""")
def summary_kinds(spark: SparkSession, sf: str) -> DataFrame:
    w = F.element_at(F.array(*map(F.lit, ("equity", "arbitrage", "debt", "etf", "fof", "Gold Mix"))), (F.col("doc_id") % 6 + 1).cast("int"))
    url = F.when(F.col("doc_id") % 12 < 6, F.concat(F.lit("https://x.example/ab12cd34-"), F.regexp_replace(w, " ", "%20"), F.lit("-list.xlsx"))
                 ).otherwise("https://x.example/")
    return table(spark, sf, "documents").select(
        "doc_id", U.summary_kind(url, F.concat(w, F.lit("-list"))).alias("kind"),
        U.workbook_title(F.concat(F.lit("Fund "), "source", F.lit(" as on 31st May 2026"))).alias("title"))


@query("url_spellings", """
SELECT doc_id, 'https://x.example/2018/f' || doc_id || '.xls' AS swapped, 'https://x.example/2018/f' || doc_id || '.xlsx' AS repaired FROM documents""")
def url_spellings(spark: SparkSession, sf: str) -> DataFrame:
    url = F.concat(F.lit("https://x.example/20188/f"), F.col("doc_id").cast("string"), F.lit(".xlsx"))
    docs = table(spark, sf, "documents").select("doc_id", U.fix_repeated_year_digit(url).alias("repaired"), U.url_candidates(url).alias("c"))
    inside = F.array_contains("c", F.col("repaired"))
    return docs.select("doc_id", U.swap_extension(F.col("repaired")).alias("swapped"), F.when(inside, F.col("repaired")).alias("repaired"))
