"""Identity tables: harvested names per code, seed lookups, priority union, issuer prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions.isin import has_isin_shape, is_valid_isin, issuer_prefix
from folioscope.functions.names import clean_name, has_expiry_suffix, match_key
from folioscope.operators.sheets import carry_in_sheet, coded_rows, dealt_sheets, locate_in_sheets
from folioscope.scale import first_rows

SHEET = ["amc", "period", "source_file", "sheet_idx"]


def harvest_rows(cells: DataFrame) -> DataFrame:
    """Every named row of a located sheet as linked / contract / unlinked / section.

    Rows move once: a sheet's columns are found where its rows have been dealt.
    """
    dealt = dealt_sheets(cells)
    located = locate_in_sheets(coded_rows(dealt), SHEET).filter("name_col is not null")
    rows = dealt.join(located.hint("shuffle_hash"), SHEET, "inner")  # one row a sheet
    raw = F.get("cells", F.col("name_col"))["s"]
    code = F.upper(F.trim(F.get("cells", F.col("isin_col"))["s"]))
    rows = rows.withColumns({"raw_name": raw, "code": F.coalesce(code, F.lit(""))})
    header = F.col("raw_name").rlike(fv.NAME_HEADER_PATTERN) | F.trim("raw_name").rlike(fv.ISIN_HEADER_PATTERN)
    rows = rows.filter(
        (F.trim("raw_name") != "") & ~F.col("raw_name").rlike(fv.STRUCTURE_ROW_PATTERN) & ~header)
    figures = F.size(F.filter("cells", lambda c: c["n"].isNotNull() & ~c["n"].isin(0.0, 1.0)))
    rows = rows.withColumns({
        "name": clean_name(F.col("raw_name")), "is_derivative": has_expiry_suffix(F.col("raw_name")),
    }).filter(F.length("name") >= 3)
    kind = (
        F.when(is_valid_isin(F.col("code")), "linked").when(has_isin_shape(F.col("code")), "contract")
        .when(figures >= 2, "unlinked").otherwise("section")
    )
    rows = rows.withColumn("kind", kind)
    label = F.when(F.col("kind") == "section", F.col("name"))
    return carry_in_sheet(rows, SHEET, "section", label).withColumn("section", F.coalesce("section", F.lit("")))


def harvest_names(cells: DataFrame) -> DataFrame:
    """Counts per file: (kind, code, name, section, is_derivative, n)."""
    rows = harvest_rows(cells).filter(F.col("kind") != "section")
    section = F.when(F.col("kind") == "unlinked", F.col("section"))
    return rows.groupBy(
        "amc", "period", "source_file", "kind", "code", "name", section.alias("section"), "is_derivative"
    ).agg(F.count(F.lit(1)).alias("n"))


# --- canonical names ---------------------------------------------------------------------

def spellings(observed: DataFrame) -> DataFrame:
    """(isin, name, match_key, n, last_period) from rows (isin, name, period, n)."""
    return observed.groupBy("isin", "name").agg(
        F.sum("n").alias("n"), F.max("period").alias("last_period")
    ).withColumn("match_key", match_key(F.col("name")))


def canonical_names(observed: DataFrame) -> DataFrame:
    """The current spelling per code.

    The winning company is the match key seen most recently (then most often); inside it the
    latest spelling wins, then the most frequent, then the longest. Remaining ties go to the
    lower text.
    """
    names = spellings(observed)
    keys = names.groupBy("isin", "match_key").agg(
        F.max("last_period").alias("key_period"), F.sum("n").alias("key_n"))
    best = first_rows(keys, ["isin"], [F.desc("key_period"), F.desc("key_n"), "match_key"]).select("isin", "match_key")
    inside = names.join(best, ["isin", "match_key"], "left_semi")
    order = [F.desc("last_period"), F.desc("n"), F.desc(F.length("name")), "name"]
    return first_rows(inside, ["isin"], order).select("isin", F.col("name").alias("canonical_name"))


def name_stats(observed: DataFrame) -> DataFrame:
    """Observations, variants, entities, houses, first and last period per code.

    Distinct members are counted through grouped tables, so no group is held in one task.
    """
    names = spellings(observed)
    per_name = names.groupBy("isin").agg(
        F.sum("n").alias("observations"), F.count(F.lit(1)).alias("variants"),
        F.count_distinct("match_key").alias("entities"))
    seen = observed.groupBy("isin").agg(
        F.count_distinct("amc").alias("amcs"), F.min("period").alias("first_period"),
        F.max("period").alias("last_period"))
    return per_name.join(seen, "isin")


def name_variants(observed: DataFrame) -> DataFrame:
    """Every spelling with its count and whether it is the canonical one."""
    return spellings(observed).join(canonical_names(observed), "isin").select(
        "isin", "name", "match_key", F.col("n").alias("count"),
        (F.col("name") == F.col("canonical_name")).cast("int").alias("is_canonical"))


def top_member(df: DataFrame, key: str, member: str, n: str = "n") -> DataFrame:
    """Most frequent member per key with totals; ties go to the lower member."""
    counted = df.groupBy(key, member).agg(F.sum(n).alias("__n"))
    best = first_rows(counted, [key], [F.desc("__n"), member]).select(key, F.col(member).alias("top"))
    totals = counted.groupBy(key).agg(F.sum("__n").alias("observations"), F.count(F.lit(1)).alias("variants"))
    return totals.join(best, key)


def contract_summary(harvest: DataFrame) -> DataFrame:
    found = top_member(harvest.filter(F.col("kind") == "contract"), "code", "name")
    return found.select(F.col("code").alias("contract_code"), F.col("top").alias("underlying_name"),
                        "observations", "variants")


def unlinked_summary(harvest: DataFrame) -> DataFrame:
    found = top_member(harvest.filter(F.col("kind") == "unlinked"), "name", "section")
    return found.select("name", F.col("observations").alias("count"), F.col("top").alias("top_section"))


# --- seeds -----------------------------------------------------------------------------------

def modal(df: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Most frequent value tuple per key (ties: lower tuple) plus the number of distinct tuples."""
    counted = df.filter(F.col(key).isNotNull()).groupBy(key, *values).agg(F.count(F.lit(1)).alias("n"))
    candidates = counted.groupBy(key).agg(F.count(F.lit(1)).alias("candidates"))
    return first_rows(counted, [key], [F.desc("n"), *values]).join(candidates, key)


def conflicts(df: DataFrame, key: str, values: list[str], kind: str) -> DataFrame:
    """Every candidate of a key that has more than one."""
    counted = df.filter(F.col(key).isNotNull()).groupBy(key, *values).agg(F.count(F.lit(1)).alias("n"))
    many = counted.groupBy(key).agg(F.count(F.lit(1)).alias("candidates")).filter(F.col("candidates") > 1)
    return counted.join(many, key).select(
        F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"),
        F.concat_ws("|", *[F.col(v).cast("string") for v in values]).alias("candidate"), "n")


def seed_lookups(ref: DataFrame) -> dict[str, DataFrame]:
    """Code names, code types, instrument types and the conflict list, from the reference sheet."""
    tiers = ["basic_industry", "industry", "sector_name", "macro_economic_sector"]
    named = ref.filter(F.col("amfi_code").isNotNull() & (F.col("fund_name") != ""))
    coded = ref.filter(F.col("isin") != "")
    return {
        "amfi_codes": modal(named, "amfi_code", ["fund_name"]),
        "isin_classification": modal(coded, "isin", ["instrument_name", "nature_name", *tiers]),
        "instrument_types": modal(ref, "instrument_name", ["nature_name", *tiers]),
        "conflicts": conflicts(named, "amfi_code", ["fund_name"], "amfi_code")
        .unionByName(conflicts(coded, "isin", ["instrument_name", "nature_name", *tiers], "isin"))
        .unionByName(conflicts(ref, "instrument_name", ["nature_name", *tiers], "instrument_name")),
    }


# --- security master --------------------------------------------------------------------------

def priority_union(sources: list[DataFrame], key: str = "isin", order: str = "ord") -> DataFrame:
    """One row per key: the earliest source wins, inside a source the first row."""
    merged = None
    for rank, df in enumerate(sources):
        part = df.withColumn("priority", F.lit(rank).cast("bigint"))
        merged = part if merged is None else merged.unionByName(part)
    return first_rows(merged, [key], ["priority", order])


def issuer_names(names: DataFrame, code: str = "isin", name: str = "name") -> DataFrame:
    """Modal name per seven-character issuer prefix."""
    keyed = names.withColumn("prefix", issuer_prefix(F.col(code)))
    return modal(keyed, "prefix", [name]).select("prefix", F.col(name).alias("issuer_name"), "n", "candidates")


def with_name_source(df: DataFrame, master: DataFrame, issuers: DataFrame, code: str = "isin") -> DataFrame:
    """security_name and name_source: master, issuer prefix or blank."""
    exact = master.select(F.col("isin").alias(code), F.col("name").alias("__exact"))
    stem = issuers.select(F.col("prefix").alias("__prefix"), F.col("issuer_name").alias("__stem"))
    joined = df.join(exact, code, "left").withColumn("__prefix", issuer_prefix(F.col(code))).join(stem, "__prefix", "left")
    source = F.when(F.col("__exact").isNotNull(), "master").when(F.col("__stem").isNotNull(), "prefix").otherwise("blank")
    return joined.withColumns({
        "security_name": F.coalesce("__exact", "__stem"), "name_source": source,
    }).drop("__exact", "__stem", "__prefix")


def fill_rate(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Share of rows per name source."""
    filled = F.avg((F.col("name_source") != "blank").cast("double")).alias("fill_rate")
    counts = [F.count_if(F.col("name_source") == s).alias(f"from_{s}") for s in ("master", "prefix", "blank")]
    return df.groupBy(*(keys or [])).agg(F.count(F.lit(1)).alias("rows"), *counts, filled)

