"""Landed listing pages and payloads -> documents."""

from __future__ import annotations

import html
from collections.abc import Iterable, Iterator, Mapping
from functools import reduce
from operator import and_, or_
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import fixed_values as fv
from folioscope.functions.json_text import json_records, json_strings
from folioscope.functions.markup import link_table
from folioscope.functions.periods import extract_periods, last_period, period_conflicts
from folioscope.functions.text import clean_html_text, unescape_entities
from folioscope.functions.urls import (
    absolute_url, base_name, direct_url, growth_free, is_workbook_url, safe_name, suffix_of, url_part,
)
from folioscope.scale import exploded, first_rows, with_group_totals

LINKS = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("page_url", T.StringType()),
    T.StructField("pos", T.IntegerType()), T.StructField("href", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("searchable", T.StringType()),
])


# --- links -----------------------------------------------------------------------------

def extract_links(pages: DataFrame) -> DataFrame:
    """Anchors of (page_id, url, html): absolute address, collapsed text, text + address + titles."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            links = link_table(html.unescape(h or "") for h in batch["html"])
            page_id, url = (batch[c].iloc[links["page"]].tolist() for c in ("page_id", "url"))
            address = [urljoin(u, h) if u else h for u, h in zip(url, links["href"], strict=True)]
            yield pd.DataFrame(dict(zip([f.name for f in LINKS.fields],
                                        (page_id, url, links["pos"], address, links["text"], links["searchable"]), strict=True)))

    return pages.select("page_id", "url", "html").mapInPandas(run, LINKS)


def simple_links(pages: DataFrame) -> DataFrame:
    """Quoted href values, JVM-side."""
    found = F.regexp_extract_all("html", F.lit(r"""(?i)<a\s[^>]*?href=["']([^"']*)["']"""), F.lit(1))
    return pages.select("page_id", F.col("url").alias("page_url"), F.posexplode(found).alias("pos", "href"))


def extract_file_urls(pages: DataFrame) -> DataFrame:
    """Quoted file addresses, comments removed, one row per page and address in page order."""
    text = F.regexp_replace("html", r"(?s)<!--.*?-->", "")
    text = F.regexp_replace(F.regexp_replace(unescape_entities(text), r"\\/", "/"), r"\\u002F", "/")
    found = F.regexp_extract_all(text, F.lit(fv.FILE_URL_PATTERN_FLAGS + fv.FILE_URL_PATTERN), F.lit(2))
    rows = pages.select("page_id", F.col("url").alias("page_url"), F.posexplode(found).alias("pos", "raw"))
    rows = rows.withColumn("file_url", absolute_url(F.col("page_url"), F.trim("raw")))
    return rows.groupBy("page_id", "page_url", "file_url").agg(F.min("pos").alias("pos"))


# --- JSON ---------------------------------------------------------------------------------

def json_script(markup: Column, script_id: str = "__NEXT_DATA__") -> Column:
    """Text of a JSON script; for the default id the streamed push chunks are the fallback."""
    body = F.trim(F.regexp_extract(
        markup, rf"""(?is)<script[^>]*\bid=["']{script_id}["'][^>]*>(.*?)</script>""", 1))
    body = unescape_entities(body)
    if script_id == "__NEXT_DATA__":
        chunks = F.regexp_extract_all(
            markup, F.lit(r'(?s)self\.__next_f\.push\(\[\s*\d+\s*,\s*("(?:\\.|[^"\\])*")\s*\]\)'), F.lit(1))
        decoded = F.transform(chunks, lambda c: F.get_json_object(F.concat(F.lit('{"v":'), c, F.lit("}")), "$.v"))
        body = F.when(body != "", body).otherwise(F.array_join(decoded, ""))
    return first_json(body)


def first_json(text: Column) -> Column:
    """The text if it is JSON, else its part between the outermost brackets, else null."""
    def valid(t: Column) -> Column:
        return F.when(F.try_parse_json(t).isNotNull(), t)

    braces = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    brackets = F.regexp_extract(text, r"(?s)(\[.*\])", 1)
    return F.coalesce(valid(text), valid(braces), valid(brackets))


def records_of(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per nested object: record (JSON text) and its leaf strings."""
    rows = df.withColumn("record", F.explode(json_records(F.col(payload)))).drop(payload)
    return rows.withColumn("strings", json_strings(F.col("record")))


def docs_from_json(df: DataFrame, page_url: str = "page_url", payload: str = "payload",
                   predicate=None) -> DataFrame:
    """Each object with a file address becomes a document labelled with its strings."""
    rows = records_of(df, payload)
    files = F.array_distinct(F.filter("strings", lambda s: F.regexp_replace(F.lower(s), r"\?.*$", "").rlike(
        r"\.(xls|xlsx|xlsm|zip)$")))
    rows = rows.withColumn("label", F.array_join("strings", " "))
    rows = rows.withColumn("raw_url", F.explode(files)).drop("strings")
    rows = rows.withColumn("url", absolute_url(F.col(page_url), F.col("raw_url"))).drop("raw_url")
    return rows if predicate is None else rows.filter(predicate)


def parse_list_items(pages: DataFrame, markup: str = "html") -> DataFrame:
    """Title and address paired per list item."""
    items = F.regexp_extract_all(markup, F.lit(r"(?is)(<li\b.*?</li>)"), F.lit(1))
    rows = pages.select("page_id", F.posexplode(items).alias("pos", "item"))
    title = F.regexp_extract("item", r"""(?is)<p[^>]*class=["'][^"']*file-name[^"']*["'][^>]*>(.*?)</p>""", 1)
    href = F.regexp_extract("item", r"""(?is)href=(["'])(.*?)\1""", 2)
    out = rows.select("page_id", "pos", clean_html_text(title).alias("title"), unescape_entities(href).alias("href"))
    return out.filter("title <> '' and href <> ''")


def embedded_records(pages: DataFrame, pattern: str, groups: dict[str, int], markup: str = "html") -> DataFrame:
    """Records a pattern finds in scripts or streams; each named group becomes a column."""
    arrays = [F.regexp_extract_all(markup, F.lit(pattern), F.lit(g)).alias(n) for n, g in groups.items()]
    zipped = F.arrays_zip(*arrays)
    rows = pages.select("page_id", F.posexplode(zipped).alias("pos", "r"))
    return rows.select("page_id", "pos", "r.*")


def pushed_records(pages: DataFrame, call: str, markup: str = "html") -> DataFrame:
    """title / url of ``call({...})`` blocks."""
    blocks = F.regexp_extract_all(markup, F.lit(rf"(?is){call}\(\s*\{{(.*?)\}}\s*\)"), F.lit(1))
    rows = pages.select("page_id", F.posexplode(blocks).alias("pos", "block"))

    def field(name: str) -> Column:
        raw = F.regexp_extract("block", rf"""(?is)\b{name}\s*:\s*(['"])((?:\\.|(?!\1).)*)\1""", 2)
        return F.regexp_replace(raw, r"""\\(['"])""", "$1").alias(name)

    return rows.select("page_id", "pos", field("title"), field("url")).filter("url <> ''")


def stream_lines(pages: DataFrame, markup: str = "html") -> DataFrame:
    """index:json lines of a component stream that parse as JSON."""
    rows = pages.select("page_id", F.posexplode(F.split(markup, "\n")).alias("pos", "line"))
    body = F.regexp_extract("line", r"^[^:]*:(.*)$", 1)
    return rows.select("page_id", "pos", body.alias("payload")).filter(F.try_parse_json("payload").isNotNull())


def option_ids(pages: DataFrame, label_pattern: str, markup: str = "html") -> DataFrame:
    """value of the option whose label matches; pages with none or several hits are rejected."""
    options = embedded_records(
        pages, r"""(?is)<option[^>]*value=["']([^"']+)["'][^>]*>(.*?)</option>""", {"value": 1, "label": 2}, markup)
    hits = options.filter(clean_html_text(F.col("label")).rlike(label_pattern))
    counted = hits.groupBy("page_id").agg(F.count(F.lit(1)).alias("hits"), F.min("value").alias("value"))
    return pages.select("page_id").join(counted, "page_id", "left").select(
        "page_id", F.when(F.col("hits") == 1, F.col("value")).alias("option_id"), F.coalesce("hits", F.lit(0)).alias("hits"))


# --- documents -------------------------------------------------------------------------------

def to_document(df: DataFrame, max_url_length: int | None = fv.MAX_URL_LENGTH) -> tuple[DataFrame, DataFrame]:
    """(documents, rejects): absolute address, name, type; text that cannot be an address is rejected.

    Input: amc, period, source_page_url, href, optional label / filename / file_type. Addresses
    beyond ``max_url_length`` are rejects as well; None takes any length.
    """
    for c in ("label", "filename", "file_type"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    url = absolute_url(F.col("source_page_url"), F.col("href"))
    work = df.withColumn("url", url)
    bad = F.col("url").rlike(r"[{}\r\n]")
    if max_url_length is not None:
        bad = bad | (F.length("url") > max_url_length)
    derived = safe_name(base_name(F.col("url")))
    name = F.when(F.coalesce("filename", F.lit("")) != "", F.col("filename")).when(
        derived != "", derived).otherwise("portfolio")
    kind = F.coalesce(F.when(F.col("file_type") != "", F.col("file_type")), F.when(suffix_of(name) != "", suffix_of(name)),
                      suffix_of(url_part(F.col("url"), 3)))
    good = work.filter(~bad).withColumns({
        "filename": name, "file_type": F.lower(kind),
        "label": F.trim(F.coalesce(F.when(F.col("label") != "", F.col("label")), F.col("href"))),
    }).drop("href")
    return good, work.filter(bad).withColumn("reason", F.lit("not a document address"))


def rules_of(rules: DataFrame) -> dict[str, list[list[tuple[str, str, str]]]]:
    """Clauses per house from rows (amc, action, field, pattern[, clause]); a row without clause stands alone.

    Rules are settings, a handful of rows a house, and are read to the driver.
    """
    clauses: dict[tuple, list] = {}
    for at, r in enumerate(rules.collect()):
        name = r["clause"] if "clause" in rules.columns else None
        clauses.setdefault((r["amc"], ("row", at) if name is None else ("clause", name)), []).append((r["action"], r["field"], r["pattern"]))
    out: dict[str, list] = {}
    for (house, _), conditions in clauses.items():
        out.setdefault(house, []).append(sorted(conditions))
    return out


def classify_listing(df: DataFrame, rules: DataFrame | Mapping[str, Iterable] | None = None) -> DataFrame:
    """Keep rows that meet every clause of their house; houses without rules keep none.

    ``rules``: house -> clauses, each a list of conditions (action, field, pattern) of which one must hold, or rows for
    ``rules_of``; the rules of ``fixed_values.HOUSE_RULES`` by default. An include condition holds if the field shows
    the pattern, an exclude condition if it does not; a null field shows nothing. All rules become one predicate whose
    patterns are compiled once per task, so a listing is read once and never shuffled.
    """
    if rules is None:
        rules = fv.HOUSE_RULES
    elif isinstance(rules, DataFrame):
        rules = rules_of(rules)
    path = url_part(F.col("url"), 3)
    subjects = F.struct("amc", "url", "text", base_name(F.col("url")).alias("name"), F.regexp_extract(path, r"([^/]*)/[^/]*$", 1).alias("folder"),
                        F.concat_ws(" ", "text", "url").alias("evidence"))
    houses: dict[tuple, list[str]] = {}
    for house, clauses in rules.items():
        houses.setdefault(tuple(sorted({tuple(clause) for clause in clauses})), []).append(house)

    def verdict(row: Column) -> Column:
        def holds(action: str, field: str, pattern: str) -> Column:
            shown = F.coalesce(F.rlike(row[field], F.lit(pattern)), F.lit(False))
            return shown if action == "include" else ~shown

        keep = F.lit(False)
        for clauses, named in houses.items():
            every = reduce(and_, [reduce(or_, [holds(*c) for c in clause]) for clause in clauses])
            keep = F.when(row["amc"].isin(named), every).otherwise(keep)
        return keep

    # through one-element arrays, so that the fields are made once a row and not once a condition
    return df.filter(F.exists(F.array(subjects), verdict))


def select_monthly(df: DataFrame, keys: tuple[str, ...] = ("amc", "period")) -> DataFrame:
    """Keyword documents, else bare-month documents, else the only survivor of the noise filter."""
    def norm(c: Column) -> Column:
        return F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")

    months = fv.MONTHLY_MONTH_PATTERN
    name = F.coalesce("name", F.lit(""))
    keyword = norm(name).contains(fv.MONTHLY_KEYWORD) | norm(F.regexp_extract("url", r"([^/]*)$", 1)).contains(fv.MONTHLY_KEYWORD)
    noise = name.rlike(fv.MONTHLY_NOISE_PATTERN) | name.rlike(
        rf"(?i)\bfor\s+\d{{1,2}}(?:st|nd|rd|th)?\s+{months}\b")
    bare = F.trim(name).rlike(rf"(?i)^(?:\d{{2}}[\s\-_]?{months}|{months}|portfolio)$")
    tier = F.when(keyword, 1).when(~noise & bare, 2).when(~noise, 3)
    work = df.withColumn("tier", tier)
    work = with_group_totals(work, keys, {
        "best": F.min("tier"), "survivors": F.count_if(F.col("tier").isNotNull())})
    chosen = (F.col("tier") == F.col("best")) & ((F.col("tier") < 3) | (F.col("survivors") == 1))
    return work.filter(chosen).drop("best", "survivors")


def unpivot_month_urls(df: DataFrame, ids: list[str]) -> DataFrame:
    """JanUrl..DecUrl columns -> (ids, month, url) for the filled ones."""
    names = {F"{m}Url": f"{i + 1:02d}" for i, m in enumerate(
        ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"))}
    present = [c for c in df.columns if c in names]
    long = df.unpivot(ids, present, "month_field", "url")
    number = F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col("month_field"))
    return long.filter("url is not null and url <> ''").select(*ids, number.alias("month"), "url")


def apply_corrections(df: DataFrame, stale: DataFrame, corrections: DataFrame) -> DataFrame:
    """Drop known stale rows; add a correction only where its period has no row left."""
    kept = df.join(stale, ["amc", "period", "url"], "left_anti")
    missing = corrections.join(kept.select("amc", "period").distinct(), ["amc", "period"], "left_anti")
    return kept.unionByName(missing, allowMissingColumns=True)


def repair_folder(df: DataFrame, keys: tuple[str, ...] = ("listing",), url: str = "url") -> DataFrame:
    """An unfilled date_ folder gives way to the listing's most frequent folder (ties: lower name)."""
    pattern = r"^(https?://.*/)([^/]+/[^/]+)(/[^/]+)$"
    work = df.withColumn("__folder", F.regexp_extract(url, pattern, 2))
    real = work.filter((F.col("__folder") != "") & ~F.col("__folder").startswith("date_"))
    counted = real.groupBy(*keys, F.col("__folder").alias("__best")).agg(F.count(F.lit(1)).alias("__n"))
    best = first_rows(counted, keys, [F.desc("__n"), "__best"]).drop("__n")
    fixed = F.concat(F.regexp_extract(url, pattern, 1), F.col("__best"), F.regexp_extract(url, pattern, 3))
    broken = F.col("__folder").startswith("date_") & F.col("__best").isNotNull()
    return work.join(best, list(keys), "left").withColumn(url, F.when(broken, fixed).otherwise(F.col(url))).drop(
        "__folder", "__best")


def flatten_manifest(df: DataFrame, column: str = "monthly", default_ending: str = ".xls") -> DataFrame:
    """scheme -> year -> document arrays as flat rows with the joined path."""
    rows = df.withColumn("__s", F.explode(column)).withColumn("__y", F.explode("__s.financialYears")).withColumn(
        "__d", F.explode("__y.documents"))
    name = F.trim(F.coalesce("__d.fileName", F.lit("")))
    ended = F.when(F.lower(name).rlike(r"\.(xls|xlsx|xlsm)$"), name).otherwise(F.concat(name, F.lit(default_ending)))

    def part(c: str) -> Column:
        bare = F.regexp_replace(F.coalesce(F.col(c), F.lit("")), "^/+|/+$", "")
        return F.when(bare != "", bare)

    path = F.concat_ws("/", part("__s.folderName"), F.lit("monthly"), part("__y.yearFolder"), ended)
    label = F.concat_ws(" ", F.coalesce("__d.title", F.lit("")), F.coalesce("__d.fileName", F.lit("")))
    kept = [c for c in df.columns if c != column]
    return rows.filter(name != "").select(*kept, label.alias("label"), ended.alias("filename"), path.alias("path"))


def validate_records(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): each check is a Column that is true when the record is fine."""
    reasons = F.array_compact(F.array(*[
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))
    work = df.withColumn("reasons", reasons)
    return work.filter(F.size("reasons") == 0).drop("reasons"), work.filter(F.size("reasons") > 0)


# --- nested listing payload ---------------------------------------------------------------------

LISTING = T.StructType([
    T.StructField("status", T.StringType()), T.StructField("max_pages", T.IntegerType()),
    T.StructField("financial_years", T.ArrayType(T.StringType())), T.StructField("months", T.ArrayType(T.StringType())),
    T.StructField("scheme_titles", T.ArrayType(T.StringType())),
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()), T.StructField("title", T.StringType()),
        T.StructField("financial_year", T.StringType()),
        T.StructField("acf_fields", T.StructType([
            T.StructField("document_name", T.StringType()), T.StructField("month", T.StringType()),
            T.StructField("funds_mapping", T.StructType([T.StructField("post_title", T.StringType())])),
            T.StructField("disclosure_files", T.ArrayType(T.StructType([
                T.StructField("id", T.StringType()), T.StructField("url", T.StringType())]))),
        ])),
    ]))),
])


def listing_records(payloads: DataFrame, fallback_scheme: str = "house") -> tuple[DataFrame, DataFrame]:
    """(records, malformed) of listing payloads (amc, year, payload struct of LISTING)."""
    row = payloads.select("amc", "year", F.posexplode("payload.data").alias("row_pos", "row"))
    acf = F.col("row.acf_fields")
    label = clean_html_text(F.coalesce(F.when(acf["document_name"] != "", acf["document_name"]), F.col("row.title"), F.lit("")))
    row = row.withColumns({"label": label, "post": clean_html_text(F.coalesce(acf["funds_mapping"]["post_title"], F.lit("")))})
    scheme = growth_free(F.col("post"))
    files = row.select(
        "amc", "year", "row_pos", "label", F.col("row.id").alias("row_id"), F.trim(acf["month"]).alias("month"),
        F.coalesce(F.when(F.col("row.financial_year") != "", F.col("row.financial_year")), F.col("year")).alias("row_year"),
        F.when(scheme != "", scheme).when(F.col("label") != "", F.col("label")).otherwise(fallback_scheme).alias("scheme"),
        F.posexplode(acf["disclosure_files"]).alias("file_pos", "file"))
    files = files.withColumn("url", direct_url(F.col("file.url")))
    numbers = F.create_map(*[F.lit(x) for kv in fv.MONTH_NUMBERS.items() for x in kv])
    number = F.try_element_at(numbers, F.lower("month"))
    reason = F.when(~F.col("url").rlike("^https?://"), "no usable url").when(
        number.isNull(), F.concat(F.lit("unparseable month '"), F.coalesce("month", F.lit("")), F.lit("'")))
    files = files.withColumns({
        "reason": reason, "period": F.concat(F.col("row_year"), F.lit("-"), F.lpad(number.cast("string"), 2, "0"))})
    named = last_period(F.concat_ws(" ", "label", base_name(F.col("url"))))
    good = files.filter("reason is null").withColumns({
        "record_id": F.coalesce(F.when(F.col("file.id") != "", F.col("file.id")), F.concat_ws(":", "row_id", "url")),
        "named_period": named,
    }).withColumn("file_period_conflict", F.when(F.col("named_period") != F.col("period"), F.col("named_period")))
    records = good.select("amc", F.col("row_year").alias("year"), "month", "period", "scheme", "label", "url", "record_id",
                          "row_id", "file_period_conflict", F.struct("row_pos", "file_pos").alias("ord"))
    return records, files.filter("reason is not null").select("amc", "year", "scheme", "label", "url", "reason")


def split_misfiled(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, misfiled): rows whose label or file name names another month than the listed one."""
    evidence = F.concat_ws(" ", "label", base_name(F.col("url")))
    conflict = F.coalesce(period_conflicts(evidence, F.col("period")), F.lit(False))
    work = records.withColumns({"__conflict": conflict})
    named = F.coalesce(last_period(F.col("label")), last_period(evidence), F.lit("unknown"))
    bad = work.filter("__conflict").drop("__conflict").withColumn("document_period", named)
    return work.filter("not __conflict").drop("__conflict"), bad


def published_periods(df: DataFrame, keys: tuple[str, ...] = ("amc",), label: str = "label") -> DataFrame:
    """(keys, period): every period some label of the listing names."""
    return exploded(df, extract_periods(F.col(label)), "published").select(*keys, "published").distinct()


def workbook_rows(df: DataFrame, url: str = "url") -> DataFrame:
    return df.filter(is_workbook_url(F.col(url)))
