"""The (house, year, month) status ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.contracts import LEDGER_FIELDS
from folioscope.functions.messages import classify_failure, classify_unavailable, looks_like_no_data
from folioscope.scale import first_rows

CELL = ["amc", "year", "month"]


def _blank_fields(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.lit("") for c in LEDGER_FIELDS if c not in df.columns})


def classify_attempts(attempts: DataFrame, today: Column, lag_months: int) -> DataFrame:
    """Attempt facts (amc, period, attempt, exit_code, message, timed_out) -> status and description."""
    reason = F.regexp_replace(F.coalesce("message", F.lit("")), "^unavailable: ", "")
    code = F.col("exit_code")
    unavailable = classify_unavailable(F.col("period"), today, lag_months)
    status = (
        F.when(F.coalesce("timed_out", F.lit(False)), "HTTP_ERROR").when(code.isin(0, 8), "SUCCESS").when(code == 2, unavailable)
        .when(code.isin(5, 6), "DOWNLOAD_FAILED").when(code == 7, "INVALID_FILE").when(code == 9, "SITE_CHANGED")
        .when(code == 10, "UPSTREAM_GAP").when(looks_like_no_data(reason), unavailable).otherwise(classify_failure(reason))
    )
    work = attempts.withColumns({"status": status, "reason": reason})
    r, s = F.col("reason"), F.col("status")
    description = (
        F.when(F.coalesce("timed_out", F.lit(False)), F.lit("AMC site/download timed out"))
        .when(code == 0, F.lit("Downloaded and validated successfully"))
        .when(code == 8, F.concat(F.lit("Downloaded successfully (cut off at the configured number of files): "), r))
        .when(s == "NOT_YET_PUBLISHED", F.concat(
            F.lit("Recent period, not yet published by the AMC (checked "), today.cast("string"), F.lit("): "), r))
        .when(s == "NO_DATA", F.concat(F.lit("AMC reported no portfolio disclosure for this period: "), r))
        .when(s == "DOWNLOAD_FAILED", F.concat(
            F.lit("File(s) discovered but download/validation did not complete: "), r))
        .when(code == 7, F.concat(F.lit("Downloaded file failed integrity/content checks: "), r))
        .when(code == 9, F.concat(
            F.lit("Re-discovery confirmed the site no longer lists file(s) it originally listed: "), r))
        .when(s == "UPSTREAM_GAP", F.concat(
            F.lit("AMC catalog lists document(s) whose approved source URLs are unavailable: "), r))
        .when(s == "SITE_CHANGED", F.concat(F.lit("AMC page/API structure appears to have changed: "), r))
        .when(s == "INVALID_FILE", F.concat(F.lit("Response was not a valid portfolio file: "), r))
        .when(s == "HTTP_ERROR", F.concat(F.lit("Network/HTTP failure reaching the AMC's site or file host: "), r))
        .when(s == "DISCOVERY_FAILED", F.concat(F.lit("AMC page/API could not be parsed or queried: "), r))
        .otherwise(F.concat(F.lit("Unexpected failure (exit "), code.cast("string"), F.lit("): "), r))
    )
    failed = ~s.isin("SUCCESS", "NOT_YET_PUBLISHED", "NO_DATA")
    work = work.withColumns({
        "description": description, "error": F.when(failed, r).otherwise(""),
        "year": F.substring("period", 1, 4), "month": F.substring("period", 6, 2)})
    return work.drop("reason")


def final_attempt(classified: DataFrame, retries: int = 3) -> DataFrame:
    """The attempt that ended each cell: the first one whose status is not worth a retry, else the last allowed.

    Attempts after the first and its ``retries`` are not looked at; ``late_attempts`` lists them.
    """
    allowed = classified.filter(F.col("attempt") <= retries + 1)
    settled = F.when(F.col("status").isin(fv.RETRYABLE_STATUSES), 1).otherwise(0)
    order = [settled, F.when(settled == 0, F.col("attempt")).otherwise(-F.col("attempt"))]
    chosen = first_rows(allowed, ["amc", "period"], order)
    label = F.concat(F.lit(" [attempt "), F.col("attempt").cast("string"), F.lit(f"/{retries + 1}]"))
    return chosen.withColumn("description", F.when(
        F.col("attempt") > 1, F.concat("description", label)).otherwise(F.col("description")))


def late_attempts(classified: DataFrame, retries: int = 3) -> DataFrame:
    """Attempts that ``final_attempt`` does not look at, with the reason."""
    return classified.filter(F.col("attempt") > retries + 1).withColumn("reason", F.lit(f"after {retries} retries"))


def rollup_year_status(ledger: DataFrame) -> DataFrame:
    """Refine NO_DATA by year.

    In a year with any success it becomes MONTH_NOT_AVAILABLE. A year without success, all of
    whose months are unavailable and which is older than the earliest reachable year (or any such
    year when none is reachable), collapses to one "--" row. A stored "--" row goes when its year
    has month rows again and stays otherwise, so a second run changes nothing.
    """
    ledger = _blank_fields(ledger)
    months = ledger.filter(F.col("month") != "--")
    success = F.col("status").isin(fv.SUCCESS_STATUSES)
    years = months.groupBy("amc", "year").agg(
        F.bool_or(success).alias("reachable"),
        F.bool_and(F.col("status").isin("NO_DATA", "MONTH_NOT_AVAILABLE")).alias("empty"),
        F.min_by(F.when(F.col("error") != "", F.col("error")).otherwise(F.col("description")), "month").alias("sample"))
    earliest = years.filter("reachable").groupBy("amc").agg(F.min("year").alias("earliest"))
    years = years.join(earliest, "amc", "left")
    collapses = ~F.col("reachable") & F.col("empty") & (F.col("earliest").isNull() | (F.col("year") < F.col("earliest")))
    years = years.withColumn("collapses", collapses)

    flagged = months.join(years.select("amc", "year", "reachable", "collapses"), ["amc", "year"])
    refined = F.col("reachable") & (F.col("status") == "NO_DATA")
    kept = flagged.filter(~F.col("collapses")).withColumns({
        "description": F.when(refined, F.concat(
            F.lit("Year "), F.col("year"), F.lit(" has confirmed downloads elsewhere on this AMC's site, but not this month. "),
            F.col("description"))).otherwise(F.col("description")),
        "status": F.when(refined, "MONTH_NOT_AVAILABLE").otherwise(F.col("status")),
    })
    collapsed = _blank_fields(years.filter("collapses").select(
        "amc", "year", F.lit("--").alias("month"), F.lit("YEAR_NOT_AVAILABLE").alias("status"),
        F.concat(F.lit("No month in "), F.col("year"), F.lit(" produced a result on the AMC website (earliest confirmed year: "),
                 F.coalesce("earliest", F.lit("none found in range")), F.lit("): "), F.col("sample")).alias("description")))
    stored = ledger.filter(F.col("month") == "--").join(years.select("amc", "year"), ["amc", "year"], "left_anti")
    return (
        kept.select(*LEDGER_FIELDS).unionByName(collapsed.select(*LEDGER_FIELDS)).unionByName(stored.select(*LEDGER_FIELDS))
    )


def resume_plan(spine: DataFrame, ledger: DataFrame, files: DataFrame, today_period: str) -> DataFrame:
    """Per (house, month) of the spine: reuse an answer or run again.

    ``files`` is (amc, period, file_count). action is future / reuse / run; the status column holds
    the reused answer. A collapsed "--" row stands for each of its months again.
    """
    months = ledger.filter(F.col("month") != "--").select(*CELL, "status", "description")
    folded = ledger.filter(F.col("month") == "--").select("amc", "year", F.lit("NO_DATA").alias("folded_status"),
                                                          F.col("description").alias("folded_description"))
    joined = spine.join(months, CELL, "left").join(folded, ["amc", "year"], "left").join(files, ["amc", "period"], "left")
    known = F.coalesce("status", "folded_status")
    words = F.coalesce("description", "folded_description")
    future = F.col("period") > today_period
    success = known.isin(fv.SUCCESS_STATUSES) & (F.coalesce("file_count", F.lit(0)) > 0)
    settled = known.isin(fv.UNAVAILABLE_STATUSES)
    action = F.when(future, "future").when(F.coalesce(success | settled, F.lit(False)), "reuse").otherwise("run")
    status = F.when(future, "NOT_YET_PUBLISHED").when(F.coalesce(success, F.lit(False)), "ALREADY_EXISTS").when(
        F.coalesce(settled, F.lit(False)), known)
    text = F.when(future, "Month is in the future").when(
        status == "ALREADY_EXISTS", "Valid file(s) already downloaded by a previous run").when(settled, words)
    return joined.select("amc", "period", "year", "month", action.alias("action"), status.alias("status"),
                         text.alias("description"))


def future_cells(spine: DataFrame, today_period: str) -> DataFrame:
    return spine.filter(F.col("period") > today_period)


def upsert_ledger(ledger: DataFrame, changes: DataFrame) -> DataFrame:
    """Changed cells replace stored ones."""
    kept = ledger.join(changes.select(*CELL), CELL, "left_anti")
    return kept.select(*LEDGER_FIELDS).unionByName(_blank_fields(changes).select(*LEDGER_FIELDS))


def status_totals(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(F.count(F.lit(1)).alias("cells"))


def open_items(ledger: DataFrame) -> DataFrame:
    """Everything that is not settled."""
    return ledger.filter(~F.col("status").isin(fv.SETTLED_STATUSES))
