"""Readers and writers for lookups, reference data, manifests, holdings, reports and the ledger."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.contracts import (
    AUDIT_FIELDS, FINAL_FIELDS, HOLDINGS_RAW, LEDGER, LEDGER_FIELDS, LOOKUPS, MANIFEST, REFERENCE_PORTFOLIO,
    UNRESOLVED_FIELDS,
)
from folioscope.functions import canonical as K
from folioscope.functions.urls import base_name
from folioscope.operators.ledger import upsert_ledger
from folioscope.operators.listing import LISTING
from folioscope.scale import ordered_scan, settle


def _optional(load, spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table where the path does not exist."""
    try:
        return load()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed listing pages: page_id, url, html."""
    return spark.read.format(fmt).load(path).select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")


def read_listing(spark: SparkSession, path: str, amc: str) -> DataFrame:
    """Nested listing payloads with an explicit schema: amc, year, payload."""
    raw = spark.read.schema(LISTING).option("multiLine", "true").json(path)
    year = F.element_at(F.array_sort("financial_years"), -1)
    return raw.select(F.lit(amc).alias("amc"), F.coalesce(F.when(F.size("financial_years") > 0, year), F.lit("")).alias("year"),
                      F.struct(*raw.columns).alias("payload"))


def read_lookup(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A lookup CSV with its fixed schema and ``line``, its place in the file; a missing file is an empty table."""
    schema = LOOKUPS[name]
    rows = _optional(lambda: spark.read.schema(schema).option("header", "true").csv(f"{folder}/{name}.csv"), spark, schema)
    return rows.withColumn("line", F.monotonically_increasing_id())


def repeated_lines(lookup: DataFrame, keys: list[str]) -> DataFrame:
    """Lines of a lookup that a later line with the same key replaces."""
    later = Window.partitionBy(*keys).orderBy("line").rowsBetween(1, Window.unboundedFollowing)
    return lookup.withColumn("replaced_by", F.max("line").over(later)).filter("replaced_by IS NOT NULL")


def read_reference(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The thirteen-column reference portfolio; rows without code and fund name are blank lines."""
    reader = spark.read.schema(REFERENCE_PORTFOLIO)
    df = reader.option("header", "true").csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    return df.filter("amfi_code is not null or fund_name is not null")


def reference_schemes(reference: DataFrame) -> DataFrame:
    """Distinct (amfi_code, fund_name) with row counts; the null vocabulary of codes becomes ''."""
    named = reference.filter(F.trim("fund_name") != "")
    return named.groupBy(K.clean_code(F.col("amfi_code").cast("string")).alias("amfi_code"),
                         K.folded(F.col("fund_name")).alias("fund_name")).agg(F.count(F.lit(1)).alias("rows"))


# --- ragged house list ------------------------------------------------------------------

WINDOWS_ONLY = {chr(b): bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def read_house_list(spark: SparkSession, path: str) -> DataFrame:
    """(house, code, isin_growth, isin_div, name, ordinal) of a ';' list with bare house lines.

    The list is Windows-1252, which the readers do not know: it is read as Latin-1 and the bytes
    that differ are translated. The house is carried down in file order: split offset, then line.
    """
    line = F.translate("line", "".join(WINDOWS_ONLY), "".join(WINDOWS_ONLY.values()))
    lines = spark.read.option("encoding", "iso-8859-1").option("sep", "\u0001").option("quote", "").schema(
        "line string").csv(path).select(line.alias("line"), F.col("_metadata.file_path").alias("file"),
                                        F.col("_metadata.file_block_start").alias("at"))
    return parse_house_list(lines.withColumn("line_no", F.monotonically_increasing_id()))


def parse_house_list(lines: DataFrame) -> DataFrame:
    """Lines (file, at, line_no, line) -> scheme rows with their house."""
    text = F.trim("line")
    df = lines.withColumn("line", text).filter("line <> ''")
    scheme = F.col("line").contains(";")
    category = F.col("line").rlike(r"(?i)schemes\(|^(open|close|interval)\s+ended")
    house = F.when(~scheme & ~category, F.col("line"))
    df = ordered_scan(df, ["file"], ["at", "line_no"], F.col("at"), lasts={"house": house}, position="ordinal")
    parts = F.split("line", ";")
    rows = df.filter(scheme & F.col("house").isNotNull()).withColumn("p", parts).filter(
        (F.size("p") >= 4) & (F.lower(F.trim(F.get("p", F.lit(0)))) != "scheme code"))
    names = ("code", "isin_growth", "isin_div", "name")
    return rows.select("house", *[F.trim(F.get("p", F.lit(i))).alias(n) for i, n in enumerate(names)], "ordinal")


# --- manifests --------------------------------------------------------------------------------

def read_manifest(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """entries, members, failures and file -> scheme of manifest.json files under amc/YYYY-MM/."""
    text = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "manifest.json").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    place = r"/([^/]+)/(\d{4}-\d{2})/[^/]+$"
    parsed = text.select(F.regexp_extract("file", place, 1).alias("amc"), F.regexp_extract("file", place, 2).alias("period"),
                         F.from_json("value", MANIFEST).alias("m"))
    return explode_manifest(parsed)


def explode_manifest(parsed: DataFrame) -> dict[str, DataFrame]:
    entries = parsed.select("amc", "period", F.explode("m.downloads").alias("url", "e")).select(
        "amc", "period", "url", "e.scheme", "e.path", "e.bytes", "e.sha256", "e.archive", "e.extracted")
    members = entries.filter("archive is not null").select(
        "amc", "period", "url", F.explode_outer("extracted").alias("x")).select("amc", "period", "url", "x.path", "x.bytes", "x.sha256")
    failures = parsed.select("amc", "period", F.explode("m.failures").alias("url", "f")).select(
        "amc", "period", "url", "f.category", "f.status", "f.error", "f.attempts")
    inner = entries.select("amc", "period", "scheme", F.explode("extracted").alias("x")).select("amc", "period", "scheme", "x.path")
    schemes = entries.select("amc", "period", "scheme", "path").unionByName(inner).filter("path is not null").select(
        "amc", "period", base_name(F.col("path")).alias("source_file"), F.coalesce("scheme", F.lit("")).alias("scheme"))
    return {"entries": entries, "members": members, "failures": failures, "schemes": schemes.distinct()}


# --- holdings ------------------------------------------------------------------------------------

def _replace_partitions(df: DataFrame, path: str, keys: list[str], fmt: str = "parquet") -> None:
    """Overwrite only the partitions the table carries."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).format(fmt)
    (writer.option("header", "true") if fmt == "csv" else writer).save(path)


def write_intermediate(df: DataFrame, path: str) -> None:
    _replace_partitions(df, path, ["amc", "period"])


def read_intermediate(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HOLDINGS_RAW).parquet(path)


def write_final(df: DataFrame, path: str, with_audit: bool = False, fmt: str = "parquet") -> None:
    """The fourteen columns (plus Name_Source) per house and month; CSV prints empty shares as NULL."""
    cols = FINAL_FIELDS + (AUDIT_FIELDS if with_audit else [])
    out = df.select("amc", "period", *cols)
    if fmt == "csv":
        out = out.withColumn("No_Of_Shares", F.coalesce(F.col("No_Of_Shares").cast("string"), F.lit("NULL")))
    _replace_partitions(out, path, ["amc", "period"], fmt)


def write_unresolved(df: DataFrame, path: str) -> None:
    _replace_partitions(df.select("period", *UNRESOLVED_FIELDS), path, ["amc", "period"])


def write_sorted(df: DataFrame, path: str, order: list[str], fmt: str = "csv") -> None:
    """A report or lookup, range-sorted by key."""
    writer = df.orderBy(*order).write.mode("overwrite").format(fmt)
    (writer.option("header", "true") if fmt == "csv" else writer).save(path)


def write_lookups(tables: dict[str, DataFrame], folder: str) -> None:
    """Seed lookups, each sorted by its first column."""
    for name, df in tables.items():
        write_sorted(df, f"{folder}/{name}.csv", [df.columns[0]])


def write_name_tables(names: DataFrame, variants: DataFrame, contracts: DataFrame, unlinked: DataFrame,
                      errors: DataFrame, folder: str) -> None:
    write_sorted(names, f"{folder}/isin_names.csv", ["isin"])
    write_sorted(variants, f"{folder}/isin_name_variants.csv", ["isin", "name"])
    write_sorted(contracts, f"{folder}/contract_codes.csv", ["contract_code"])
    write_sorted(unlinked, f"{folder}/unlinked_names.csv", ["name"])
    write_sorted(errors, f"{folder}/isin_names_errors.csv", ["source_file"])


def write_mapping(mapping: DataFrame, review: DataFrame, folder: str, house: str = "amc") -> None:
    """Accepted mappings and the names a person has to decide, one partition per house."""
    _replace_partitions(mapping, f"{folder}/schemes", [house], "csv")
    _replace_partitions(review, f"{folder}/schemes_review", [house], "csv")


def write_alias_review(candidates: DataFrame, folder: str) -> None:
    write_sorted(candidates, f"{folder}/isin_alias_candidates.csv", [candidates.columns[0], "isin_in_amc_file"])


def write_expected(items: DataFrame, alternates: DataFrame, duplicates: DataFrame, folder: str) -> None:
    for name, df in (("items", items), ("alternates", alternates), ("duplicates", duplicates)):
        _replace_partitions(df, f"{folder}/{name}", ["amc", "period"])


def write_validation(report: DataFrame, outcomes: DataFrame, folder: str) -> None:
    _replace_partitions(report, f"{folder}/report", ["amc", "period"], "json")
    _replace_partitions(outcomes, f"{folder}/outcomes", ["amc", "period"])


def write_coverage(covered: DataFrame, missing: DataFrame, unresolved: DataFrame, folder: str) -> None:
    for name, df in (("coverage", covered), ("missing", missing), ("unresolved_downloads", unresolved)):
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def write_discovery(records: DataFrame, conflicts: DataFrame, folder: str) -> None:
    """Discovery records in (period, scheme, record) order and the rows that name another month."""
    write_sorted(records, f"{folder}/discovery_manifest.csv", ["period", "scheme", "record_id"])
    write_sorted(conflicts, f"{folder}/period_conflicts.csv", ["record_id"])


def write_summary(df: DataFrame, path: str) -> None:
    write_sorted(df, path, ["amc", "period"])


# --- ledger -------------------------------------------------------------------------------------------

def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return _optional(lambda: spark.read.schema(LEDGER).parquet(path).select(*LEDGER_FIELDS), spark, LEDGER)


def write_ledger(spark: SparkSession, path: str, changes: DataFrame) -> None:
    """Upsert: only the partitions of changed houses are rewritten.

    The merged rows are settled first, because they replace files they were read from.
    """
    houses = changes.select("amc").distinct()
    stored = read_ledger(spark, path).join(houses, "amc", "left_semi")
    _replace_partitions(settle(upsert_ledger(stored, changes)), path, ["amc"])
