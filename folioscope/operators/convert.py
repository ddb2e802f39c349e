"""Intermediate holdings -> the final fourteen columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.contracts import FINAL_FIELDS, UNRESOLVED_FIELDS
from folioscope.functions.names import scheme_key
from folioscope.functions.text import cell_number
from folioscope.operators import classify
from folioscope.scale import (
    first_reaching, last_rows, levels_for, null_safe_join, ordered_scan, settle, with_group_totals,
)

SCHEME = ["amc", "period", "scheme_name_raw"]


@dataclass(frozen=True)
class Lookups:
    """The lookup tables of a conversion; all are ordinary DataFrames."""

    mapping: DataFrame
    classification: DataFrame
    aliases: DataFrame
    names: DataFrame
    variants: DataFrame
    overrides: DataFrame | None = None


def with_numbers(df: DataFrame) -> DataFrame:
    """value_num, pct_num, qty_num beside the raw cells."""
    return df.withColumns({
        "value_num": cell_number(F.col("market_value_raw")),
        "pct_num": cell_number(F.col("pct_raw")),
        "qty_num": cell_number(F.col("quantity")),
    })


# --- C1: restated totals ------------------------------------------------------------

def restated_totals(
    df: DataFrame, keys: list[str] = SCHEME, order: tuple[str, ...] = ("ord",),
    block: Column | None = None, value: str = "value_num", identifiable: str = "identifiable",
) -> DataFrame:
    """(keys, order) of the unidentifiable rows whose value a run of later identifiable rows adds up to.

    The running sum after a row is the difference of two prefix sums, so the first point where
    it matches or overshoots is the first later prefix that reaches value x (1 - tolerance).
    Only the order, value and flag columns travel; the prefix sums are settled once because the
    search reads them several times.
    """
    block = F.shiftright("ord", 12) if block is None else block
    amount = F.when(F.col("known_"), F.col("own_"))
    narrow = df.select(*keys, *order, F.col(value).alias("own_"), F.col(identifiable).alias("known_"))
    scanned = settle(ordered_scan(narrow, keys, order, block, sums={"prefix_": amount}, position="pos_"))
    candidate = ~F.col("known_") & (F.col("own_") > 0)
    seen = scanned.agg(F.count_if(candidate).alias("n"), F.max("pos_").alias("last")).first()
    if not seen.n:
        return scanned.select(*keys, *order).limit(0)
    low = F.col("own_") * (1 - fv.RESTATED_TOTAL_TOLERANCE)
    headers = scanned.filter(candidate).withColumn("need_", F.col("prefix_") + low)
    points = scanned.filter(F.col("known_") & F.col("own_").isNotNull()).select(*keys, "pos_", "prefix_")
    met = first_reaching(points, headers, keys, position="pos_", level="prefix_", threshold="need_",
                         out="stop_", levels=levels_for(seen.last))
    run = F.col("stop__level") - F.col("prefix_")
    return met.filter(
        F.col("stop_").isNotNull() & (run <= F.col("own_") * (1 + fv.RESTATED_TOTAL_TOLERANCE))
    ).select(*keys, *order)


def mark_restated_totals(df: DataFrame, keys: list[str] = SCHEME, order: tuple[str, ...] = ("ord",),
                         **options) -> DataFrame:
    """Adds is_restated."""
    hits = restated_totals(df, keys, order, **options).withColumn("hit_", F.lit(True))
    marked = null_safe_join(df, hits, [*keys, *order], "left")
    return marked.withColumn("is_restated", F.coalesce("hit_", F.lit(False))).drop("hit_")


# --- C2, C3: percent scale and net assets ----------------------------------------------

def pct_scale(total: Column) -> Column:
    """1 for percent, 100 for fractions, 1 when the sum fits neither."""
    fraction = (F.abs(total - fv.FRACTION_SUM_TARGET) <= fv.FRACTION_SUM_SLACK) & ~_looks_percent(total)
    return F.when(F.coalesce(fraction, F.lit(False)), F.lit(100.0)).otherwise(F.lit(1.0))


def _looks_percent(total: Column) -> Column:
    return F.abs(total - fv.PERCENT_SUM_TARGET) <= fv.PERCENT_SUM_SLACK


def scale_abstained(total: Column) -> Column:
    fits = _looks_percent(total) | (F.abs(total - fv.FRACTION_SUM_TARGET) <= fv.FRACTION_SUM_SLACK)
    return F.coalesce(~fits, F.lit(False))


def scheme_figures(df: DataFrame, keys: list[str] = SCHEME) -> DataFrame:
    """One row per scheme: pct_sum, scale, abstained and implied net assets."""
    both = F.col("value_num").isNotNull() & F.col("pct_num").isNotNull()
    sums = df.groupBy(*keys).agg(
        F.sum("pct_num").alias("pct_sum"),
        F.sum(F.when(both, F.col("value_num"))).alias("__value"),
        F.sum(F.when(both, F.col("pct_num"))).alias("__pct"),
    )
    scale = pct_scale(F.col("pct_sum"))
    share = F.col("__pct") * F.col("pct_scale")
    usable = (share > fv.MIN_PERCENT_FOR_NAV) & (F.col("__value") != 0)
    return sums.withColumns({
        "pct_scale": scale, "scale_abstained": scale_abstained(F.col("pct_sum")),
    }).withColumn("implied_nav", F.when(usable, F.col("__value") / (share / 100.0))).drop("__value", "__pct")


def detect_pct_scale(df: DataFrame, keys: list[str] = SCHEME) -> DataFrame:
    return scheme_figures(df, keys).select(*keys, "pct_sum", "pct_scale", "scale_abstained")


def implied_nav(df: DataFrame, keys: list[str] = SCHEME) -> DataFrame:
    return scheme_figures(df, keys).select(*keys, "implied_nav").filter(F.col("implied_nav").isNotNull())


def corpus_percent(value: Column, pct: Column, scale: Column, nav: Column) -> Column:
    """Printed percent on the 0-100 scale, else the value's share of the net assets."""
    return F.coalesce(pct * scale, F.try_divide(value, nav) * 100.0)


# --- C4, C5: scheme mapping and classification --------------------------------------------

def map_schemes(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Adds amfi_code and fund_name; unmapped rows keep nulls. The last line of a repeated key counts."""
    table = last_rows(mapping, ["amc", "match_key"]).select("amc", F.col("match_key").alias("__key"), "amfi_code", "fund_name")
    keyed = df.withColumn("__key", scheme_key(F.col("scheme_name_raw")))
    return keyed.join(table, ["amc", "__key"], "left").drop("__key")


def with_identity(df: DataFrame, lookups: Lookups) -> DataFrame:
    """rec_instrument, rec_nature, name_isin and identifiable."""
    own = F.when(F.trim("isin") != "", F.col("isin"))
    work = classify.recognize_non_isin(df.withColumn("isin", own), lookups.overrides)
    work = classify.resolve_by_name(work, lookups.variants)
    known = F.col("isin").isNotNull() | F.col("rec_instrument").isNotNull() | F.col("name_isin").isNotNull()
    return work.withColumn("identifiable", known)


def classify_holdings(df: DataFrame, lookups: Lookups) -> DataFrame:
    """The classification cascade; expects the columns of with_identity."""
    aliases = classify.classify_isin(
        last_rows(lookups.aliases, ["isin_in_amc_file"]).withColumnRenamed("isin_in_amc_file", "isin"), lookups.classification, "isin", "own"
    ).select("isin", F.col("isin_in_icra").alias("alias_isin"), "own_instrument", "own_nature")
    work = df.join(aliases, "isin", "left")

    printed = F.col("isin").isNotNull() & ~classify.override_safe(F.col("rec_instrument"))
    instrument = F.coalesce("rec_instrument", F.lit(fv.FALLBACK_INSTRUMENT))
    by_name = ~printed & (instrument == fv.FALLBACK_INSTRUMENT) & F.col("name_isin").isNotNull()
    out_isin = F.when(printed, F.coalesce("alias_isin", "isin")).when(by_name, F.col("name_isin"))
    work = work.withColumns({"printed": printed, "by_name": by_name}).withColumn("out_isin", out_isin)

    work = classify.classify_isin(work, lookups.classification, "out_isin", "type")
    names = last_rows(lookups.names, ["isin"]).select(F.col("isin").alias("out_isin"), F.col("canonical_name").alias("harvested_name"))
    work = work.join(names, "out_isin", "left")

    coded = F.col("printed") | F.col("by_name")
    typed_i = F.when(F.col("printed"), F.coalesce("type_instrument", "own_instrument")).otherwise(F.col("type_instrument"))
    typed_n = F.when(F.col("type_instrument").isNotNull(), F.col("type_nature")).when(
        F.col("printed"), F.col("own_nature"))
    tagged = F.when(F.col("printed"), typed_i.isNull()).otherwise(
        ~F.col("by_name") & (instrument == fv.FALLBACK_INSTRUMENT))
    name = F.when(F.col("printed"), F.col("harvested_name")).when(
        F.col("by_name"), F.coalesce("harvested_name", "security_name")).otherwise(F.col("security_name"))
    source = (
        F.when(F.col("printed") & F.col("harvested_name").isNull(), "blank")
        .when(F.col("printed"), "harvest").when(F.col("by_name"), "variant").otherwise("printed")
    )
    return work.withColumns({
        "instrument": F.when(coded, F.coalesce(typed_i, F.lit(fv.FALLBACK_INSTRUMENT))).otherwise(instrument),
        "nature": F.when(coded, F.when(typed_i.isNotNull(), typed_n).otherwise(F.lit(fv.FALLBACK_NATURE)))
        .otherwise(F.when(F.col("rec_instrument").isNotNull(), F.col("rec_nature"))
                   .otherwise(F.lit(fv.FALLBACK_NATURE))),
        "tagged_isin": tagged,
        "blank_security_name": F.col("printed") & F.col("harvested_name").isNull(),
        "final_name": F.coalesce(name, F.lit("")),
        "name_source": source,
    }).drop("type_instrument", "type_nature", "type_source", "own_instrument", "own_nature", "alias_isin",
            "harvested_name", "printed", "by_name")


# --- the whole conversion ----------------------------------------------------------------------

def tag_holdings(rows: DataFrame, lookups: Lookups, block: Column | None = None) -> DataFrame:
    """Every input row with its outcome, classification and scheme figures.

    Restated totals go before the percent scale is judged: a header repeats the share of its
    whole category and would push the sum past the threshold. The identified rows are settled:
    the search for totals, the scheme figures and the cascade all read them.
    """
    known = settle(with_identity(with_numbers(rows), lookups))
    work = mark_restated_totals(known, block=block)
    figures = scheme_figures(work.filter(~F.col("is_restated")))
    work = classify_holdings(map_schemes(work, lookups.mapping), lookups)
    work = null_safe_join(work, figures, SCHEME, "left")
    outcome = F.when(F.col("is_restated"), "not_a_holding").when(
        F.col("amfi_code").isNull(), "unmapped_scheme").otherwise("converted")
    return work.withColumn("outcome", outcome)


def finalize(tagged: DataFrame) -> DataFrame:
    """The fourteen columns plus Name_Source, one row per converted holding."""
    pct = corpus_percent(F.col("value_num"), F.col("pct_num"), F.col("pct_scale"), F.col("implied_nav"))
    blank = F.lit("")
    return tagged.filter(F.col("outcome") == "converted").select(
        "amc", "period",
        F.col("amfi_code").alias("AMFI Code"), F.col("port_date").alias("Port_Date"),
        F.coalesce("out_isin", blank).alias("ISIN"),
        F.col("instrument").alias("Instrument_Name"), F.col("nature").alias("Nature_Name"),
        blank.alias("Basic_Industry"), blank.alias("Industry"), blank.alias("Sector_Name"),
        blank.alias("Macro_Economic_Sector"),
        pct.alias("Corpus_Per"), (F.col("value_num") / 100).alias("Mkt_Value"),
        F.col("qty_num").alias("No_Of_Shares"), F.col("fund_name").alias("Fund_Name"),
        F.col("final_name").alias("Security_Name"), F.col("name_source").alias("Name_Source"),
    )


def convert(rows: DataFrame, lookups: Lookups) -> DataFrame:
    return finalize(tag_holdings(rows, lookups)).select("amc", "period", *FINAL_FIELDS, "Name_Source")


def convert_report(tagged: DataFrame, keys: tuple[str, ...] = ("amc", "period")) -> DataFrame:
    """Counters per house and month."""
    done = F.col("outcome") == "converted"
    schemes = tagged.groupBy(*keys, "scheme_name_raw").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(done).alias("converted"),
        F.count_if(F.col("outcome") == "unmapped_scheme").alias("unmapped_schemes"),
        F.count_if(done & F.col("tagged_isin")).alias("tagged_isin"),
        F.count_if(done & F.col("blank_security_name")).alias("blank_security_name"),
        F.count_if(F.col("outcome") == "not_a_holding").alias("not_a_holding"),
        F.max(F.coalesce("scale_abstained", F.lit(False)).cast("bigint")).alias("pct_scale_abstained"),
    )
    counters = ["total", "converted", "unmapped_schemes", "tagged_isin", "blank_security_name",
                "not_a_holding", "pct_scale_abstained"]
    return schemes.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counters])


def unresolved(tagged: DataFrame) -> DataFrame:
    """Rows a person should look at, one per reason."""
    reasons = F.array_compact(F.array(
        F.when(F.col("outcome") == "unmapped_scheme", F.lit("unmapped_scheme")),
        F.when(F.col("outcome") == "not_a_holding", F.lit("not_a_holding")),
        F.when((F.col("outcome") == "converted") & F.col("tagged_isin"), F.lit("tagged_isin")),
        F.when((F.col("outcome") == "converted") & F.col("blank_security_name"), F.lit("blank_security_name")),
    ))
    return tagged.withColumn("reason", F.explode(reasons)).select("period", *UNRESOLVED_FIELDS)
