"""What a holding is: code -> type, printed words -> instrument, name -> code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions.isin import type_key
from folioscope.functions.names import match_key
from folioscope.functions.text import contains_any
from folioscope.scale import first_rows, last_rows


def type_seed(classification: DataFrame) -> DataFrame:
    """One (instrument, nature) per code: that of its last line."""
    return last_rows(classification, ["isin"]).select("isin", F.col("instrument_name").alias("instrument"),
                                 F.col("nature_name").alias("nature"))


def type_keys(classification: DataFrame) -> DataFrame:
    """Most frequent type per five-character key; ties go to the lower name."""
    counted = (
        type_seed(classification)
        .select(type_key(F.col("isin")).alias("key"), "instrument", "nature")
        .filter(F.col("key").isNotNull())
        .groupBy("key", "instrument", "nature").agg(F.count(F.lit(1)).alias("n"))
    )
    return first_rows(counted, ["key"], [F.desc("n"), "instrument", "nature"]).drop("n")


def classify_isin(df: DataFrame, classification: DataFrame, code: str = "isin",
                  prefix: str = "type") -> DataFrame:
    """Adds <prefix>_instrument, <prefix>_nature and <prefix>_source (exact / key / none)."""
    exact = type_seed(classification).select(
        F.col("isin").alias(code), F.col("instrument").alias("__i1"), F.col("nature").alias("__n1"))
    keyed = type_keys(classification).select(
        F.col("key").alias("__key"), F.col("instrument").alias("__i2"), F.col("nature").alias("__n2"))
    joined = df.join(exact, code, "left").withColumn("__key", type_key(F.col(code))).join(keyed, "__key", "left")
    source = F.when(F.col("__i1").isNotNull(), "exact").when(F.col("__i2").isNotNull(), "key").otherwise("none")
    return joined.withColumns({
        f"{prefix}_source": source,
        f"{prefix}_nature": F.when(source == "exact", F.col("__n1")).otherwise(F.col("__n2")),
        f"{prefix}_instrument": F.coalesce("__i1", "__i2"),
    }).drop("__key", "__i1", "__n1", "__i2", "__n2")


def central_rule(name: Column, section: Column) -> Column:
    """struct(instrument, nature) of the first matching rule, null when none matches."""
    name_l = F.coalesce(F.lower(name), F.lit(""))
    section_l = F.coalesce(F.lower(section), F.lit(""))
    out = None
    for _, instrument, nature, name_words, section_words, excluded in fv.NON_ISIN_RULES:
        hit = contains_any(name_l, name_words) | contains_any(section_l, section_words)
        if excluded:
            hit = hit & ~contains_any(section_l, excluded)
        value = F.struct(F.lit(instrument).alias("instrument"), F.lit(nature).alias("nature"))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def house_rules(overrides: DataFrame) -> DataFrame:
    """Each house's own rules as one array in file order (a hand-written list per house)."""
    rule = F.struct("priority", "match_type", "pattern", "instrument", "nature")
    return overrides.groupBy("amc").agg(F.array_sort(F.collect_list(rule)).alias("__rules"))


def recognize_non_isin(df: DataFrame, overrides: DataFrame | None = None, name: str = "security_name",
                       section: str = "section_header") -> DataFrame:
    """Adds rec_instrument / rec_nature: house override first, then the central rules."""
    found = central_rule(F.col(name), F.col(section))
    if overrides is None:
        work = df.withColumn("__rec", found)
    else:
        def matches(rule: Column) -> Column:
            return ((rule["match_type"] == "exact") & (F.col(name) == rule["pattern"])) | (
                (rule["match_type"] == "prefix") & F.col(name).startswith(rule["pattern"]))

        work = df.join(house_rules(overrides), "amc", "left")
        own = F.get(F.filter("__rules", matches), F.lit(0))
        own = F.when(own.isNotNull(), F.struct(own["instrument"].alias("instrument"),
                                               own["nature"].alias("nature")))
        work = work.withColumn("__rec", F.coalesce(own, found)).drop("__rules")
    return work.withColumns({
        "rec_instrument": F.col("__rec")["instrument"], "rec_nature": F.col("__rec")["nature"],
    }).drop("__rec")


def override_safe(instrument: Column) -> Column:
    """Instruments that overrule a printed code."""
    return F.coalesce(instrument.isin(fv.OVERRULES_PRINTED_ISIN), F.lit(False))


def name_to_isin(variants: DataFrame, min_observations: int = fv.MIN_NAME_OBSERVATIONS) -> DataFrame:
    """match_key -> the code it was seen with most often, given enough observations."""
    counted = variants.groupBy("match_key", "isin").agg(F.sum("count").alias("observations"))
    return first_rows(counted, ["match_key"], [F.desc("observations"), "isin"]).filter(
        F.col("observations") >= min_observations)


def resolve_by_name(df: DataFrame, variants: DataFrame, name: str = "security_name") -> DataFrame:
    """Adds name_isin: the code a printed name stands for."""
    table = name_to_isin(variants).select(F.col("match_key").alias("__mk"), F.col("isin").alias("name_isin"))
    return df.withColumn("__mk", match_key(F.col(name))).join(table, "__mk", "left").drop("__mk")
