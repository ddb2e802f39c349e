"""Our holdings against the reference month."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import fixed_values as fv
from folioscope.scale import null_safe_join, ordered_scan, settle

CHECKS = ["row_count", "corpus_sum", "market_value", "isins"]


def isin_differences(ours: DataFrame, ref: DataFrame, code: str = "amfi_code", tasks: int | None = None) -> DataFrame:
    """One row per (scheme, isin) present on one side only; side is 'ours' or 'reference'.

    Schemes we do not have are left out at the end, among the few codes that differ. ``tasks`` deals the codes over so
    many tasks (see ``tasks_for``) before they are grouped.
    """
    def side(df: DataFrame, ours_flag: int) -> DataFrame:
        return df.filter(F.col("isin").isNotNull() & (F.col("isin") != "")).select(
            code, "isin", F.lit(ours_flag).alias("__o"), F.lit(1 - ours_flag).alias("__r"))

    both = side(ours, 1).unionByName(side(ref.filter(F.col(code).isNotNull()), 0))
    both = both.repartition(tasks, code, "isin") if tasks else both
    flags = both.groupBy(code, "isin").agg(F.max("__o").alias("o"), F.max("__r").alias("r")).filter(F.col("o") != F.col("r"))
    known = ours.select(code).distinct().withColumn("__known", F.lit(True))
    return flags.join(known, code, "left").filter((F.col("o") == 1) | F.col("__known")).select(
        code, "isin", F.when(F.col("o") == 1, "ours").otherwise("reference").alias("side"))


def reconcile(ours: DataFrame, ref: DataFrame, code: str = "amfi_code", tasks: int | None = None) -> DataFrame:
    """One row per scheme of ours: both row counts, weight and value sums, code differences."""
    def totals(df: DataFrame, who: str, *more: Column) -> DataFrame:
        return df.groupBy(code).agg(
            F.count(F.lit(1)).alias(f"{who}_rows"),
            F.coalesce(F.sum("corpus_per"), F.lit(0.0)).alias(f"{who}_corpus"),
            F.coalesce(F.sum("mkt_value"), F.lit(0.0)).alias(f"{who}_value"), *more)

    tagged = F.count_if(F.col("instrument_name") == fv.FALLBACK_INSTRUMENT).alias("tagged")
    mine = totals(ours, "our", F.min("fund_name").alias("fund_name"), tagged)
    theirs = totals(ref, "ref")
    differing = isin_differences(ours, ref, code, tasks).groupBy(code).agg(
        F.count_if(F.col("side") == "ours").alias("only_ours"),
        F.count_if(F.col("side") == "reference").alias("only_ref"))
    joined = mine.join(theirs, code, "left").join(differing, code, "left")
    zero = ["ref_rows", "ref_corpus", "ref_value", "only_ours", "only_ref"]
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero})


def value_gap(ours: Column, ref: Column, signed: bool = False) -> Column:
    """Relative value difference. ``signed=True`` divides by the plain total, so a negative
    reference total always fails; the default divides by its size."""
    base = ref if signed else F.abs(ref)
    return F.abs(ours - ref) / F.greatest(base, F.lit(1e-9))


def failed_checks(signed: bool = False) -> Column:
    """Names of the failed checks of a reconcile row, in order."""
    gap = value_gap(F.col("our_value"), F.col("ref_value"), signed)
    fails = [
        F.col("our_rows") != F.col("ref_rows"),
        F.abs(F.col("our_corpus") - 100) >= fv.WEIGHT_TOLERANCE,
        gap >= fv.VALUE_TOLERANCE,
        (F.col("only_ours") > 0) | (F.col("only_ref") > 0),
    ]
    return F.array_compact(F.array(*[F.when(f, F.lit(n)) for f, n in zip(fails, CHECKS)]))


def scheme_ok(signed: bool = False) -> Column:
    return F.size(failed_checks(signed)) == 0


def diagnose(checks: DataFrame, house: str = "amc", signed: bool = False) -> DataFrame:
    """Per house and in total (null house): schemes checked and passed, failures per check, value ratio."""
    failed = checks.withColumn("__failed", failed_checks(signed))
    counts = [F.count_if(F.array_contains("__failed", c)).alias(f"fail_{c}") for c in CHECKS]
    return failed.rollup(house).agg(
        F.count(F.lit(1)).alias("schemes_checked"),
        F.count_if(F.size("__failed") == 0).alias("schemes_passed"), *counts,
        F.try_divide(F.sum("our_value"), F.sum("ref_value")).alias("value_ratio"))


def run_summary(reports: DataFrame, checks: DataFrame | None = None,
                reference_period: str | None = None) -> DataFrame:
    """One row per (house, month) and one total row; only the reference month is validated."""
    work = reports
    if checks is not None:
        passed = checks.withColumn("__ok", scheme_ok()).groupBy("amc").agg(
            F.count(F.lit(1)).alias("schemes_checked"), F.count_if("__ok").alias("schemes_passed")
        ).withColumn("period", F.lit(reference_period))
        work = work.join(passed, ["amc", "period"], "left")
    sums = [c for c in work.columns if c not in ("amc", "period")]
    total = F.when(F.grouping_id() == 0, "house_month").otherwise("total")
    return (
        work.withColumns({c: F.coalesce(c, F.lit(0)) for c in sums})
        .rollup(F.struct("amc", "period").alias("__cell"))
        .agg(*[F.sum(c).alias(c) for c in sums], total.alias("row_kind"))
        .select(F.col("__cell.amc").alias("amc"), F.col("__cell.period").alias("period"), "row_kind", *sums)
    )


# --- aliases ----------------------------------------------------------------------------

def close_to(a: Column, b: Column, tolerance: float = fv.ALIAS_TOLERANCE) -> Column:
    """Relative closeness; two zeros are close, a null never is."""
    scale = F.greatest(F.abs(a), F.abs(b), F.lit(1e-9))
    return F.coalesce(((a == 0) & (b == 0)) | (F.abs(a - b) / scale <= tolerance), F.lit(False))


def _clusters(df: DataFrame, keys: list[str], measure: str, name: str) -> DataFrame:
    """Chains of neighbouring values that are close; rows of different chains can never be close."""
    bits = F.floor(F.log2(F.greatest(F.abs(F.col(measure)), F.lit(1e-9))) * 64)
    block = F.when(F.col(measure) < 0, -bits - 100_000).when(F.col(measure) > 0, bits + 100_000).otherwise(0)
    stepped = ordered_scan(df, keys, [measure, "isin", "row_id"], block,
                           previous={"before_": F.struct(F.col(measure).alias("m"))})
    stepped = settle(stepped)
    linked = F.col("before_").isNotNull() & close_to(F.col("before_")["m"], F.col(measure))
    return ordered_scan(stepped.withColumn("__start", F.when(linked, 0).otherwise(1)), keys,
                        [measure, "isin", "row_id"], block, sums={name: F.col("__start")}).drop("before_", "__start")


def alias_pairs(ours: DataFrame, ref: DataFrame, code: str = "amfi_code") -> DataFrame:
    """Codes found on one side only, grouped into chains of close quantity and close value.

    Input rows: (code, isin, quantity, mkt_value, row_id). The result keeps both sides in one
    table with a ``chain`` per scheme; a pair that matches always shares a chain.
    """
    only = settle(isin_differences(ours, ref, code))
    parts = []
    for df, who in ((ours, "ours"), (ref, "reference")):
        kept = df.join(only.filter(F.col("side") == who).select(code, "isin"), [code, "isin"], "left_semi")
        parts.append(kept.select(code, "isin", "quantity", "mkt_value", "row_id", F.lit(who).alias("side")))
    rows = parts[0].unionByName(parts[1]).filter(F.col("quantity").isNotNull() & F.col("mkt_value").isNotNull())
    by_value = settle(_clusters(settle(rows), [code], "mkt_value", "value_chain"))
    return settle(_clusters(by_value, [code, "value_chain"], "quantity", "quantity_chain"))


CLASS = ["quantity", "mkt_value"]  # rows of a scheme that agree in both want the same codes in the same order
STEP = 0.002  # buckets of the logarithm; close values stand in the same or the next one


def _bucket(value: str) -> Column:
    """Place on a signed logarithmic scale on which close values differ by less than one step."""
    size = F.log(F.greatest(F.abs(F.col(value)), F.lit(1e-9)) / 1e-9)
    return F.floor(F.signum(F.col(value)) * size / STEP)


def _wishes(mine: DataFrame, theirs: DataFrame, code: str) -> DataFrame:
    """(scheme, class, wanted code): where its first close row stands and that row's value.

    Classes meet reference points by equal buckets, not row by row: copies are folded on both sides first.
    """
    around = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    ours = mine.select(code, *CLASS).distinct().withColumn("bv", F.explode(F.transform(around, lambda d: _bucket("mkt_value") + d)))
    ours = ours.withColumn("bq", F.explode(F.transform(around, lambda d: _bucket("quantity") + d)))
    points = theirs.groupBy(code, "isin", *CLASS).agg(F.min("row_id").alias("at")).withColumns({"bv": _bucket("mkt_value"), "bq": _bucket("quantity")})
    points = points.withColumnsRenamed({"isin": "wanted", "quantity": "r_quantity", "mkt_value": "r_value"})
    met = ours.join(points, [code, "bv", "bq"]).filter(
        close_to(F.col("quantity"), F.col("r_quantity")) & close_to(F.col("mkt_value"), F.col("r_value")))
    return met.groupBy(code, *CLASS, "wanted").agg(F.min(F.struct("at", "r_value")).alias("first")).select(
        code, *CLASS, "wanted", "first.at", "first.r_value")


def _serial_choice(mine: DataFrame, wishes: DataFrame, code: str) -> DataFrame:
    """(scheme, wanted, row_id, isin, class): every row takes its first close code that no earlier row takes.

    Rows propose in rounds, a code keeps its earliest proposer and drops it only for an earlier one; as all codes prefer
    earlier rows, this ends where a walk in row order ends. The n-th open row of a class proposes to the n-th code that
    the class can still get, since the rows before it take a better one each: copies settle together in one round.
    """
    group, place = [code, *CLASS], F.struct("row_id", "isin")
    if mine.isEmpty():
        return mine.withColumn("wanted", F.lit(""))
    held = mine.limit(0).select(code, F.lit("").alias("wanted"), "row_id", "isin", *CLASS)
    block = F.shiftright("row_id", 12)
    while True:
        waiting = mine.join(held.select(code, "row_id", "isin"), [code, "row_id", "isin"], "left_anti")
        earliest = waiting.groupBy(*group).agg(F.min(place).alias("earliest"))
        holders = held.select(code, "wanted", F.struct("row_id", "isin").alias("holder"))
        free = wishes.join(earliest, group).join(holders, [code, "wanted"], "left").filter(
            F.col("holder").isNull() | (F.col("holder") > F.col("earliest")))
        free = ordered_scan(free.select(*group, "wanted", "at"), group, ["at", "wanted"], F.shiftright("at", 12), position="nth")
        asking = ordered_scan(waiting.select(*group, "row_id", "isin"), group, ["row_id", "isin"], block, position="nth")
        proposals = settle(asking.join(free.drop("at"), [*group, "nth"]).select(code, "wanted", "row_id", "isin", *CLASS))
        if proposals.isEmpty():
            return held
        kept = held.unionByName(proposals).groupBy(code, "wanted").agg(F.min(F.struct("row_id", "isin", *CLASS)).alias("k"))
        held = settle(kept.select(code, "wanted", "k.*"))


def _families(rows: DataFrame, code: str) -> DataFrame:
    """Rows with the ``family`` of their chain: chains of a scheme that share a reference code, directly or by way of others.

    Only chains with such a code take part in the rounds; each hands its smallest label on, until none changes.
    """
    chain = [code, "value_chain", "quantity_chain"]
    label = F.struct("value_chain", "quantity_chain")
    used = rows.filter(F.col("side") == "reference").select(*chain, "isin").distinct()
    twice = used.groupBy(code, "isin").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    links = settle(used.join(twice, [code, "isin"], "left_semi").withColumn("family", label))
    while True:
        by_code = links.groupBy(code, "isin").agg(F.min("family").alias("low"))
        by_chain = links.join(by_code, [code, "isin"]).groupBy(*chain).agg(F.min("low").alias("low"))
        moved = settle(links.join(by_chain, chain))
        links = moved.select(*chain, "isin", F.col("low").alias("family"))
        if moved.filter(F.col("low") < F.col("family")).isEmpty():
            break
    shared = links.select(*chain, "family").distinct().withColumn("shared", F.lit(True))
    return rows.join(shared, chain, "left").withColumns(
        {"family": F.coalesce("family", label), "shared": F.coalesce("shared", F.lit(False))})


def _walk(pdf: pd.DataFrame) -> pd.DataFrame:
    """One family: rows of ours in order take the first unused code that is close in both measures."""
    mine = pdf[pdf["side"] == "ours"].sort_values(["row_id", "isin"])
    points = pdf[pdf["side"] == "reference"].sort_values(["row_id", "isin"])
    wanted, measures = points["isin"].to_numpy(), points[CLASS].to_numpy()
    free, out = np.ones(len(points), dtype=bool), []
    for row in mine.itertuples(index=False):
        own = np.array([row.quantity, row.mkt_value])
        gap = np.abs(measures - own) / np.maximum(np.maximum(np.abs(measures), np.abs(own)), 1e-9)
        hits = np.flatnonzero(free & (gap <= fv.ALIAS_TOLERANCE).all(axis=1))
        if len(hits):
            out.append((row.isin, row.row_id, wanted[hits[0]], row.quantity, row.mkt_value, measures[hits[0], 1]))
            free &= wanted != wanted[hits[0]]
    return pd.DataFrame(out, columns=["isin", "row_id", "wanted", *CLASS, "mkt_value_icra"])


WALK_ROWS = 4096  # rows of a family that one task walks; larger families go by rounds


def alias_candidates(ours: DataFrame, ref: DataFrame, code: str = "amfi_code", walk_rows: int = WALK_ROWS) -> DataFrame:
    """Same holding, different code on each side: one to one, the earlier row first.

    Chains of close values with rows of one side only are dropped. In a tight chain (all values mutually close, such
    as any number of copies) the n-th row of ours gets the n-th code of the reference. Other chains, joined to a family
    where they share a code, are walked in one task up to ``walk_rows`` rows; larger families are settled by
    rounds of proposals over all schemes at once, with the same result. House, fund and security name of our row
    are added where ``ours`` has them; a blank security name falls back on the reference's fund.
    """
    chain = [code, "value_chain", "quantity_chain"]
    mine, theirs = F.col("side") == "ours", F.col("side") == "reference"
    rows = settle(_families(alias_pairs(ours, ref, code), code))
    sized = rows.groupBy(code, "family").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(mine).alias("n_ours"), F.count_if(theirs).alias("n_ref"), F.min("quantity").alias("q0"),
        F.max("quantity").alias("q1"), F.min("mkt_value").alias("v0"), F.max("mkt_value").alias("v1"), F.bool_or("shared").alias("shared"),
    ).filter("n_ours > 0 and n_ref > 0")
    tight = ~F.col("shared") & close_to(F.col("q0"), F.col("q1")) & close_to(F.col("v0"), F.col("v1"))
    way = F.when(tight, "tight").when(F.col("n") <= walk_rows, "walk").otherwise("rounds")
    rows = settle(rows.join(sized.select(code, "family", way.alias("way")), [code, "family"]))

    even = rows.filter("way = 'tight'")
    block = F.shiftright("row_id", 12)
    left = ordered_scan(even.filter(mine), chain, ["row_id", "isin"], block, position="place")
    first = even.filter(theirs).groupBy(*chain, "isin").agg(
        F.min("row_id").alias("row_id"), F.min_by("mkt_value", "row_id").alias("mkt_value_icra"))
    right = ordered_scan(first, chain, ["row_id", "isin"], block, position="place").select(
        *chain, "place", F.col("isin").alias("wanted"), "mkt_value_icra")
    out = [code, "isin", "row_id", "wanted", *CLASS, "mkt_value_icra"]
    simple = left.join(right, [*chain, "place"]).select(*out)

    def walk(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found = _walk(pdf)
        found.insert(0, code, key[0])
        return found[out]

    schema = T.StructType([T.StructField(n, T.StringType() if n in ("isin", "wanted") else T.LongType() if n == "row_id" else
                                         rows.schema[code].dataType if n == code else T.DoubleType()) for n in out])
    small = rows.filter("way = 'walk'").select(code, "family", "isin", "row_id", *CLASS, "side")
    walked = small.groupBy(code, "family").applyInPandas(walk, schema)

    large = rows.filter("way = 'rounds'")
    claims = large.filter(mine).select(code, "isin", "row_id", *CLASS)
    wishes = settle(_wishes(large.filter(mine), large.filter(theirs), code))
    chosen = _serial_choice(claims, wishes, code).join(wishes, [code, *CLASS, "wanted"]).withColumnRenamed("r_value", "mkt_value_icra")
    both = simple.unionByName(walked).unionByName(chosen.select(*out)).withColumnsRenamed(
        {"isin": "isin_in_amc_file", "wanted": "isin_in_icra", "mkt_value": "mkt_value_ours"})
    return _with_names(both, ours, ref, code)


def _with_names(found: DataFrame, ours: DataFrame, ref: DataFrame, code: str) -> DataFrame:
    """Names of the row our code stands in, as far as the inputs have them."""
    have = [c for c in ("amc", "fund_name", "security_name") if c in ours.columns]
    named = found
    if have:
        names = ours.select(code, F.col("isin").alias("isin_in_amc_file"), "row_id", *have)
        named = found.join(names, [code, "isin_in_amc_file", "row_id"], "left")
    if "security_name" in have:
        spare = F.lit(None).cast("string")
        if "fund_name" in ref.columns:
            funds = ref.groupBy(code, F.col("isin").alias("isin_in_icra")).agg(F.min_by("fund_name", "row_id").alias("__fund"))
            named, spare = named.join(funds, [code, "isin_in_icra"], "left"), F.col("__fund")
        named = named.withColumn("security_name", F.coalesce(F.nullif("security_name", F.lit("")), spare, F.lit(""))).drop("__fund")
    return named.select(*[c for c in ("amc", code, "fund_name") if c in named.columns], "isin_in_amc_file", "isin_in_icra",
                        *[c for c in ("security_name",) if c in named.columns], "quantity", "mkt_value_ours", "mkt_value_icra")


# --- self checks ---------------------------------------------------------------------------

def self_checks(df: DataFrame, keys: list[str], value: str = "mkt_value", pct: str = "corpus_per",
                grand_total: DataFrame | None = None, tolerance: float = 0.01) -> DataFrame:
    """Per scheme: rows whose percent is not value / total x 100, and the total against the file's own."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias("value_total"))
    share = F.try_divide(F.col(value), F.col("value_total")) * 100
    off = F.abs(F.col(pct) - share) > tolerance
    out = null_safe_join(df, totals, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("holdings"), F.max("value_total").alias("value_total"),
        F.count_if(off).alias("rows_off"))
    if grand_total is None:
        return out
    printed = out.join(grand_total, keys, "left")
    return printed.withColumn("total_gap", F.col("value_total") - F.col("grand_total"))
