import datetime as dt

from pyspark.sql import functions as F

from folioscope.operators import ledger as L


def table(spark, rows):
    return spark.createDataFrame(
        [(a, y, m, s, f"{s} text", "", "", "", "") for a, y, m, s in rows], ", ".join(f"{c} string" for c in L.LEDGER_FIELDS))


def cells(df):
    return sorted((r.amc, r.year, r.month, r.status) for r in df.collect())


def test_year_rollup_is_stable(spark):
    rows = [("a", "2017", "01", "NO_DATA"), ("a", "2017", "02", "NO_DATA"), ("a", "2018", "01", "SUCCESS"), ("a", "2018", "02", "NO_DATA"),
            ("a", "2019", "01", "NO_DATA"), ("a", "2016", "--", "YEAR_NOT_AVAILABLE"), ("a", "2018", "--", "YEAR_NOT_AVAILABLE"),
            ("b", "2020", "01", "NO_DATA"), ("c", "2020", "01", "HTTP_ERROR")]
    once = L.rollup_year_status(table(spark, rows))
    assert cells(once) == [
        ("a", "2016", "--", "YEAR_NOT_AVAILABLE"), ("a", "2017", "--", "YEAR_NOT_AVAILABLE"), ("a", "2018", "01", "SUCCESS"),
        ("a", "2018", "02", "MONTH_NOT_AVAILABLE"), ("a", "2019", "01", "NO_DATA"), ("b", "2020", "--", "YEAR_NOT_AVAILABLE"),
        ("c", "2020", "01", "HTTP_ERROR")]
    again = L.rollup_year_status(once)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def test_attempts(spark):
    today = F.lit(dt.date(2026, 8, 10))
    rows = [("a", "2026-07", 1, 2, "unavailable: nothing", False), ("a", "2020-01", 1, 2, "unavailable: nothing", False),
            ("a", "2020-02", 1, 1, "timed out", False), ("a", "2020-02", 2, 0, "", False), ("a", "2020-03", 1, None, "", True),
            ("a", "2020-04", 1, 1, "listing has no workbook for 2020-04", False), ("a", "2020-05", 1, 8, "cut", False)]
    df = spark.createDataFrame(rows, "amc string, period string, attempt long, exit_code int, message string, timed_out boolean")
    done = L.final_attempt(L.classify_attempts(df, today, 3)).collect()
    assert {r.period: r.status for r in done} == {
        "2026-07": "NOT_YET_PUBLISHED", "2020-01": "NO_DATA", "2020-02": "SUCCESS", "2020-03": "HTTP_ERROR", "2020-04": "NO_DATA", "2020-05": "SUCCESS"}
    assert [r.description for r in done if r.period == "2020-02"][0].endswith("[attempt 2/4]")


def test_resume_expands_collapsed_years(spark):
    ledger = table(spark, [("a", "2017", "--", "YEAR_NOT_AVAILABLE"), ("a", "2018", "01", "SUCCESS"), ("a", "2018", "02", "SUCCESS"),
                           ("a", "2018", "03", "NOT_YET_PUBLISHED")])
    spine = spark.createDataFrame(
        [("a", y, m, f"{y}-{m}") for y, m in (("2017", "05"), ("2018", "01"), ("2018", "02"), ("2018", "03"), ("2099", "01"))],
        "amc string, year string, month string, period string")
    files = spark.createDataFrame([("a", "2018-01", 3)], "amc string, period string, file_count long")
    got = {r.period: (r.action, r.status) for r in L.resume_plan(spine, ledger, files, "2026-08").collect()}
    assert got == {"2017-05": ("reuse", "NO_DATA"), "2018-01": ("reuse", "ALREADY_EXISTS"), "2018-02": ("run", None), "2018-03": ("run", None),
                   "2099-01": ("future", "NOT_YET_PUBLISHED")}
