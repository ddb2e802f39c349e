"""Long texts, deep brackets and repeated lookup lines: nothing is cut and nothing is multiplied."""

import pytest
from pyspark.sql import functions as F

from folioscope.functions import canonical as K
from folioscope.functions.urls import summary_kind
from folioscope.operators import classify, coverage, listing
from folioscope.operators.completeness import looks_like_html
from folioscope.operators.ledger import classify_attempts, final_attempt, late_attempts
from folioscope.scale import last_rows
from folioscope.sources.tables import read_lookup, repeated_lines


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize("text,want", [
    ("Demo (a (b (c (d (e) f) g) h) i) Fund", "Demo Fund"), ("Demo [a (b [c] d) e] Fund", "Demo Fund"), ("Demo (a Fund", "Demo (a Fund"), ("plain", "plain")])
def test_brackets_of_any_depth(spark, text, want):
    assert one(spark, K.drop_brackets, text) == want


@pytest.mark.parametrize("text,want", [
    ("\U0001d400xis Mid Cap Fund", "axis mid cap fund"), ("Ａxis Fund September 2027", "axis fund sep 2027"), ("FMP Series XLIII", "fixed maturity plan series 43"),
    ("Plan MCMXCIV fund", "plan 1994 fund"), ("ﬁrst Fund", "first fund")])
def test_keys_fold_all_of_unicode(spark, text, want):
    assert one(spark, K.canonical, text) == want


def test_every_plan_word_is_taken_off(spark):
    words = ["direct", "plan", "growth", "option", "idcw", "payout", "monthly", "quarterly", "regular", "reinvestment", "plan", "growth"]
    chain = one(spark, K.plan_reductions, "demo large cap " + " ".join(words))
    assert chain[-1] == "demo large cap"


def test_long_texts_give_candidates(spark):
    banner = "Demo Large Cap Fund " + "very " * 150
    key = "demo " + "large " * 40 + "cap fund"
    rows = spark.createDataFrame([("a", banner, "s", 1, False), ("b", key, "s", 1, False)], "unit_id string, raw string, source string, ord int, need_word boolean")
    got = {r.unit_id: r.key for r in coverage.build_candidates(rows).filter("seq = 0").collect()}
    assert len(got["a"]) > 600 and len(got["b"]) > 200


def test_every_printed_code_is_tried(spark, cell):
    rows = [("h", "2026-05", "f.xlsx", "S", 0, i, [cell(t)]) for i, t in enumerate(
        ["Demo Fund", "AMFI Code: 999999", "AMFI Code: 100001", "Name of the Instrument"])]
    cells = spark.createDataFrame(rows, "amc string, period string, source_file string, sheet string, sheet_idx int, row_idx int, cells array<struct<s:string,n:double>>")
    sheet = coverage.scan_sheets(cells).first()
    assert sheet.printed_codes == ["999999", "100001"] and sheet.printed_code == "999999"


def test_labels_addresses_and_errors_are_whole(spark):
    page = spark.createDataFrame([("http://h/p", '{"a": "%s", "u": "/f/x.xlsx"}' % ("word " * 200))], "page_url string, payload string")
    assert len(listing.docs_from_json(page).first()["label"]) > 900
    address = "/" + "d" * 400 + "/x.xlsx"
    html = spark.createDataFrame([(1, "http://h/", f'<a href="{address}">x</a>')], "page_id long, url string, html string")
    assert any(address in str(r) for r in listing.extract_file_urls(html).collect())
    rows = spark.createDataFrame([("a", "2026-05", "http://h/", "/" + "d" * 3000 + "/x.xlsx")], "amc string, period string, source_page_url string, href string")
    good, bad = listing.to_document(rows, max_url_length=None)
    assert (good.count(), bad.count()) == (1, 0)
    good, bad = listing.to_document(rows)
    assert (good.count(), bad.first()["reason"]) == (0, "not a document address")
    attempts = spark.createDataFrame([("a", "2020-01", n, 1, "KeyError: " + "x" * 900, False) for n in range(1, 7)],
                                     "amc string, period string, attempt int, exit_code int, message string, timed_out boolean")
    told = classify_attempts(attempts, F.lit("2026-01-01").cast("date"), 2)
    assert len(told.first()["error"]) > 900
    assert final_attempt(told, retries=3).first()["attempt"] <= 4 and late_attempts(told, retries=3).count() == 2


def test_kinds_and_heads_are_whole(spark):
    a, b = ("http://h/" + "k" * 50 + x + ".xlsx" for x in "ab")
    frame = spark.createDataFrame([(a,), (b,)], "u string")
    assert frame.select(summary_kind(F.col("u"), F.lit("x")).alias("k")).distinct().count() == 2
    page = spark.createDataFrame([(bytearray(b" " * 2000 + b"<HTML>"),)], "head binary")
    assert page.select(looks_like_html(F.col("head")).alias("x")).first()["x"]


def test_the_last_line_of_a_key_counts(spark, tmp_path):
    (tmp_path / "isin_classification.csv").write_text(
        "isin,instrument_name,nature_name\nA,First,x\nB,Only,y\nA,Second,z\n")
    lookup = read_lookup(spark, str(tmp_path), "isin_classification")
    assert {r.isin: r.instrument_name for r in last_rows(lookup, ["isin"]).collect()} == {"A": "Second", "B": "Only"}
    assert [r.instrument_name for r in repeated_lines(lookup, ["isin"]).collect()] == ["First"]
    rows = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "isin string, n int")
    got = {r.n: r.type_instrument for r in classify.classify_isin(rows, lookup).collect()}
    assert got[1] == "Second" and len(got) == 3 and classify.classify_isin(rows, lookup).count() == 3
