"""Scheme names of the files -> codes of the scheme list."""

from __future__ import annotations

import re
from collections import defaultdict
from difflib import SequenceMatcher
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import fixed_values as fv
from folioscope.functions.names import base_scheme_name, house_key, is_regular_growth, is_single_class, scheme_key
from folioscope.functions.similarity import Bounds
from folioscope.scale import contained_pairs, exploded, first_rows, grid, settle, spread


# --- houses ------------------------------------------------------------------------------

def map_house(folders: DataFrame, houses: DataFrame) -> DataFrame:
    """(folder, house): equal normal form, else the longest house name that contains or is contained."""
    f = folders.select("folder").distinct().withColumn("f_key", house_key(F.col("folder")))
    h = houses.select("house").distinct().withColumn("h_key", house_key(F.col("house")))
    exact = f.join(h.withColumnRenamed("h_key", "f_key"), "f_key").select("folder", "house")
    exact = first_rows(exact, ["folder"], [F.desc(F.length("house")), "house"])
    rest = f.join(exact, "folder", "left_anti")
    near = first_rows(contained_pairs(rest, h, "f_key", "h_key"), ["folder"], [F.desc(F.length("house")), "house"])
    found = exact.unionByName(near.select("folder", "house"))
    return f.select("folder").join(found, "folder", "left")


def map_house_strict(folders: DataFrame, houses: DataFrame, known: dict[str, str] | None = None) -> DataFrame:
    """(folder, house): fixed names, equal normal form, else the only house with a shared beginning; '' otherwise."""
    def slug(c: str):
        return F.regexp_replace(F.replace(F.lower(c), F.lit("mutual fund"), F.lit("")), "[^a-z0-9]", "")

    f = folders.select("folder").distinct().withColumn("f_key", slug("folder"))
    h = houses.select("house").distinct().withColumn("h_key", slug("house"))
    exact = f.join(h.withColumnRenamed("h_key", "f_key"), "f_key").groupBy("folder").agg(F.max("house").alias("exact"))
    near = contained_pairs(f, h, "f_key", "h_key", prefix_only=True).groupBy("folder").agg(
        F.count(F.lit(1)).alias("n"), F.min("house").alias("near")).filter("n = 1").drop("n")
    fixed = F.lit(None).cast("string")
    for folder, house in (fv.HOUSE_FOLDER_NAMES if known is None else known).items():
        fixed = F.when(F.col("folder") == folder, house).otherwise(fixed)
    joined = f.select("folder").join(exact, "folder", "left").join(near, "folder", "left")
    return joined.select("folder", F.coalesce(fixed, "exact", "near", F.lit("")).alias("house"))


# --- candidates and matching -----------------------------------------------------------------

def build_candidates(house_schemes: DataFrame) -> DataFrame:
    """Regular-growth or single-class rows of (house, code, name, ordinal) with their base key."""
    kept = spread(house_schemes).filter(is_regular_growth(F.col("name")) | is_single_class(F.col("name")))
    return kept.select("house", F.col("code").alias("amfi_code"), F.col("name").alias("fund_name"), "ordinal",
                       scheme_key(base_scheme_name(F.col("name"))).alias("base_norm")).filter("base_norm <> ''")


BEST = T.StructType([
    T.StructField("house", T.StringType()), T.StructField("target", T.StringType()),
    T.StructField("amfi_code", T.StringType()), T.StructField("fund_name", T.StringType()),
    T.StructField("ordinal", T.LongType()), T.StructField("score", T.DoubleType()),
])


GROUPS = 1024  # of numbers, whose names meet in one task
FEW = 8


def _tile_best(names: pd.DataFrame, cands: pd.DataFrame) -> pd.DataFrame:
    """Best candidate per name among those with its house and number."""
    rows: list[tuple] = []
    sides: dict = defaultdict(list)
    for cand in cands.sort_values("ordinal", kind="stable").itertuples(index=False):
        sides[cand.house, cand.number].append(cand)
    wanted: dict = defaultdict(list)
    for house, number, target in zip(names["house"], names["number"], names["target"]):
        wanted[house, number].append(target)
    for key, targets in wanted.items():
        if key in sides:
            rows += _best_of(key[0], targets, sides[key])
    return pd.DataFrame(rows, columns=[f.name for f in BEST.fields])


def _best_of(house: str, targets: list[str], cands: list) -> list[tuple]:
    """(house, target, code, name, ordinal, score) of the highest score, the earlier ordinal first; upper bounds, greatest first, end the search."""
    rows, matcher = [], SequenceMatcher(None)
    numbers = [set(re.findall(r"\d+", c.base_norm)) for c in cands]
    few = len(cands) <= FEW  # not worth a bound: a pair's score is at most 1
    bounds = repeat(np.ones(len(cands))) if few else Bounds([c.base_norm for c in cands]).of(targets)
    for target, bound in zip(targets, bounds):
        wanted = set(re.findall(r"\d+", target))
        inside = np.array([target in c.base_norm or c.base_norm in target for c in cands])
        bound = np.where(inside, np.maximum(bound, fv.CONTAINMENT_SCORE), bound)
        top, best = 0.0, None
        for i in np.argsort(-bound, kind="stable").tolist():
            if bound[i] < top:
                break
            if not wanted <= numbers[i]:
                continue
            matcher.set_seqs(target, cands[i].base_norm)
            score = max(matcher.ratio(), fv.CONTAINMENT_SCORE if inside[i] else 0.0)
            if score > top or best is not None and score == top and i < best:
                top, best = score, i
        if best is not None:
            c = cands[best]
            rows.append((house, target, c.amfi_code, c.fund_name, c.ordinal, top))
    return rows


def match_scheme(names: DataFrame, candidates: DataFrame) -> DataFrame:
    """(house, scheme_name_raw) with its best candidate and score.

    Equal keys are settled by an equi-join; only the rest is compared, and only with candidates
    whose numbers include all numbers of the name: a name meets the candidates that hold its rarest number, a name
    without numbers all of its house. Ties go to the earlier ordinal.
    """
    keyed = spread(names).withColumn("target", scheme_key(F.col("scheme_name_raw")))
    candidates = settle(candidates)
    first = first_rows(candidates, ["house", "base_norm"], ["ordinal"])
    exact = keyed.join(first.withColumnRenamed("base_norm", "target"), ["house", "target"], "left").withColumn(
        "score", F.when(F.col("amfi_code").isNotNull() & (F.col("target") != ""), F.lit(1.0)))
    exact = settle(exact)
    open_names = exact.filter("score is null and target <> ''").select("house", "target").distinct()

    def numbered(df: DataFrame, key: str) -> DataFrame:
        return exploded(df, F.array_distinct(F.regexp_extract_all(key, F.lit(r"(\d+)"), F.lit(1))), "number")

    plain = candidates.select("house", "amfi_code", "fund_name", "ordinal", "base_norm")
    listed = settle(numbered(plain, "base_norm"))
    held = listed.groupBy("house", "number").agg(F.count(F.lit(1)).alias("n"))
    told = numbered(open_names, "target").join(held, ["house", "number"], "left").groupBy("house", "target").agg(
        F.min_by("number", F.struct("n", "number")).alias("number"), F.bool_and(F.col("n").isNotNull()).alias("all_held"))
    digits = F.col("target").rlike(r"\d")
    left = told.filter("all_held").drop("all_held").unionByName(open_names.filter(~digits).withColumn("number", F.lit("")))
    tiles = grid(left, listed.unionByName(plain.withColumn("number", F.lit(""))), ["house", "number"], "target", "ordinal", packed=GROUPS)
    near = first_rows(tiles.applyInPandas(_tile_best, BEST), ["house", "target"], [F.desc("score"), "ordinal"])
    near = near.select("house", "target", F.col("amfi_code").alias("n_code"), F.col("fund_name").alias("n_name"),
                       F.col("score").alias("n_score"))
    joined = exact.join(near, ["house", "target"], "left")
    return joined.select("house", "scheme_name_raw", "target", F.coalesce("amfi_code", "n_code").alias("amfi_code"),
                         F.coalesce("fund_name", "n_name").alias("fund_name"),
                         F.coalesce("score", "n_score", F.lit(0.0)).alias("score"))


def unique_name_index(codes: DataFrame) -> DataFrame:
    """(key, code, fund_name) of reference names whose base key belongs to one code only."""
    named = codes.filter((F.trim("code") != "") & (F.trim("code") != "--") & (F.trim("fund_name") != ""))
    keyed = named.withColumn("key", scheme_key(base_scheme_name(F.col("fund_name"))))
    return keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("code").alias("code"), F.min("fund_name").alias("fund_name")
    ).filter("n = 1").drop("n")


def to_reference_code(matches: DataFrame, codes: DataFrame) -> DataFrame:
    """The reference's own code and name where its base name is unique."""
    index = unique_name_index(codes).select(
        F.col("key").alias("__key"), F.col("code").alias("__code"), F.col("fund_name").alias("__name"))
    keyed = matches.withColumn("__key", scheme_key(base_scheme_name(F.col("fund_name"))))
    return keyed.join(index, "__key", "left").withColumns({
        "amfi_code": F.coalesce("__code", "amfi_code"), "fund_name": F.coalesce("__name", "fund_name"),
    }).drop("__key", "__code", "__name")


def resolve_schemes(matches: DataFrame, threshold: float = fv.MATCH_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(matched, review)."""
    ok = F.col("amfi_code").isNotNull() & (F.col("score") >= threshold)
    return matches.filter(ok), matches.filter(~F.coalesce(ok, F.lit(False)))


def collapse_mapping(matched: DataFrame, house: str = "house") -> DataFrame:
    """One mapping row per (house, key): the highest score, then the lower name."""
    keyed = matched.withColumn("match_key", scheme_key(F.col("scheme_name_raw")))
    best = first_rows(keyed, [house, "match_key"], [F.desc("score"), "scheme_name_raw"])
    return best.select(house, "match_key", F.col("scheme_name_raw").alias("sheet_name"), "amfi_code", "fund_name",
                       F.col("score").alias("match_score"))


def recent_scheme_names(holdings: DataFrame, periods: int = fv.RECENT_PERIODS) -> DataFrame:
    """Distinct (amc, scheme_name_raw) over the latest periods of each house."""
    latest = first_rows(holdings.select("amc", "period").distinct(), ["amc"], [F.desc("period")], periods)
    return holdings.join(latest, ["amc", "period"], "left_semi").select("amc", "scheme_name_raw").distinct()


def match_stats(matches: DataFrame, house: str = "house", threshold: float = fv.MATCH_THRESHOLD) -> DataFrame:
    """Names seen, matched and left for review per house and in total (null house)."""
    ok = F.coalesce(F.col("amfi_code").isNotNull() & (F.col("score") >= threshold), F.lit(False))
    return matches.rollup(house).agg(
        F.count(F.lit(1)).alias("schemes_seen"), F.count_if(ok).alias("matched"), F.count_if(~ok).alias("review"))
