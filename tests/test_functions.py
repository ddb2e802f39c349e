from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from folioscope.functions import canonical as K
from folioscope.functions import isin as I
from folioscope.functions import messages as G
from folioscope.functions import names as N
from folioscope.functions import periods as P
from folioscope.functions import urls as U
from folioscope.functions.similarity import name_similarity, scheme_score, text_ratio
from folioscope.functions.text import clean_html_text, null_blanks, try_number


@pytest.fixture()
def each(spark):
    """Apply a column function to a list of texts and return the results in order."""

    def run(fn, values, *more):
        rows = [(i, v, *[m[i] for m in more]) for i, v in enumerate(values)]
        names = ["i", "v"] + [f"m{k}" for k in range(len(more))]
        df = spark.createDataFrame(rows, ", ".join(["i int"] + [f"{n} string" for n in names[1:]]))
        out = df.select("i", fn(*[F.col(n) for n in names[1:]]).alias("x")).collect()
        return [r.x for r in sorted(out)]

    return run


def test_security_codes(each):
    codes = ["INE040A01034", "US5949181045", "AUBANK300626", "BHEL29052025", "ABCDE1234567", " ine040a01034 ", None, "INE040A0103"]
    assert each(I.is_valid_isin, codes) == [True, True, False, False, False, True, False, False]
    assert each(I.is_contract_code, ["MARUTI300626", "IDIA00500002", "INE040A01034"]) == [True, False, False]
    assert each(I.type_key, ["INE040A01034", "SHORT"]) == ["INE01", None]


def test_numbers_and_blanks(each):
    assert each(try_number, ["4.74", " 12 ", "-.5", "1e3", "1d", "1,000", "NIL", "nan", ""]) == [
        4.74, 12.0, -0.5, 1000.0, None, None, None, None, None]
    assert each(null_blanks, ["N.A.", " - ", "x", "Nil"]) == [None, None, "x", None]
    assert each(clean_html_text, ["<b>A &amp; B</b> – x"]) == ["A & B - x"]


def test_security_names(each):
    raw = ["EQ - Reliance Industries Ltd $$ ~~", "Infosys Ltd. - 28-Jun-2026", "  HDFC  Bank Ltd. ** "]
    assert each(N.clean_name, raw) == ["Reliance Industries Ltd", "Infosys Ltd.", "HDFC Bank Ltd."]
    assert each(N.has_expiry_suffix, raw) == [False, True, False]
    assert each(N.match_key, ["HDFC Bank Ltd.", "HDFC BANK LIMITED"]) == ["HDFCBANKLIMITED"] * 2


def test_class_suffix(each):
    names = ["Nippon India Growth Mid Cap Fund-Growth Plan-Growth Option", "DSP Regular Savings Fund - Direct Plan - Growth",
             "X Dividend Yield Fund - Regular Plan - Growth", "360 ONE Gold ETF", "Samco Mid Cap Fund - Regular Plan", "Growth Plan"]
    assert each(N.base_scheme_name, names) == [
        "Nippon India Growth Mid Cap Fund", "DSP Regular Savings Fund", "X Dividend Yield Fund", "360 ONE Gold ETF", "Samco Mid Cap Fund",
        "Growth Plan"]
    assert each(N.is_regular_growth, names) == [True, False, True, False, True, False]
    assert each(N.is_single_class, names)[3] is True


def test_scheme_key(each):
    assert each(N.scheme_key, [
        "IB01-Groww Large Cap Fund", "Zerodha Nifty Fund FOR JULY 2026", "Bharat Bond ETF – April 2030", "A & B (C) Fund"]) == [
        "GROWW LARGE CAP FUND", "ZERODHA NIFTY FUND", "BHARAT BOND ETF APRIL 2030", "A B C FUND"]


def test_periods(each):
    texts = ["hsbc-crisil-ibx-gilt-june-2027-index-fund-31-jul-2026.xlsx", "old_bridge_may_26_20e8c1644b.xlsx", "July_31_2026", "31-July-2026",
             "July2026", "2026/July/x", "a?d=01012020", "Jan-13Monthly-portfolio", "pf 31.05.2026", "31052026", "2026-5-31", "June%202025",
             "Febuary 2021"]
    got = each(P.last_period, texts)
    assert got == ["2026-07", "2026-05", "2026-07", "2026-07", "2026-07", "2026-07", None, None, "2026-05", "2026-05", "2026-05", "2025-06",
                   "2021-02"]
    assert each(P.extract_periods, texts[:1]) == [["2026-07", "2027-06"]]
    assert list(dict.fromkeys(each(P.periods_in_order, texts[:1])[0])) == ["2027-06", "2026-07"]
    assert each(lambda c: P.last_period(c, before="2026-08"), ["gilt-june-2027"]) == [None]
    named = each(P.title_periods, ["NIFTY SDL December 2028 Index Fund as on May 31, 2026"])[0]
    assert "2026-05" in named and "2028-12" not in named
    assert each(P.label_period, ["Monthly Portfolio as on Janaury 31, 2024", "Monthly Portfolio February 30, 2024", "Update April 3, 2020"]) == [
        "2024-01", None, None]
    assert [str(d) for d in each(P.month_end, ["2024-02", "2026-12"])] == ["2024-02-29", "2026-12-31"]


def test_addresses(each):
    assert each(U.normalized_url, ["HTTPS://X.com/a.xlsx?b=2&v=9&a=1#top", "https://x.com/f.php?file=Scheme A.xlsx", "https://x.com/a"]) == [
        "https://x.com/a.xlsx?a=1&b=2", "https://x.com/f.php?file=Scheme+A.xlsx", "https://x.com/a"]
    assert each(U.destination_filename, ["", "a/b.xls", "report"], ["https://x/y%20z.xlsx?q", "u", "u"], ["xlsx", "xls", "zip"]) == [
        "y z.xlsx", "a_b.xls", "report.zip"]
    assert each(U.fix_repeated_year_digit, ["a 20188 b", "a 20187 b"]) == ["a 2018 b", "a 20187 b"]
    found = each(U.url_candidates, ["https://h/p/banking-&-psu Aug 2021.xlsb"])[0]
    assert found[0] == "https://h/p/banking-&-psu Aug 2021.xlsb"
    assert "https://h/p/banking-psu%20aug%202021.xlsb" in found and len(found) == len(set(found))


def test_messages(each):
    texts = ["HDFC listing has no current monthly workbook for 2019-04", "page returned 403 for 2019-04, no data", "no longer exposes option 51",
             "KeyError: 'x'", "hm"]
    assert each(G.looks_like_no_data, texts) == [True, False, False, False, False]
    assert each(G.classify_failure, texts[1:]) == ["HTTP_ERROR", "SITE_CHANGED", "DISCOVERY_FAILED", "UNKNOWN_ERROR"]


def test_canonical(each):
    texts = ["Axis Children’s Fund", "MONTHLY PORTFOLIO STATEMENT OF X Fund AS ON 31 May", "Series XLIII - Fund of Funds", "IBX50:50 September 2027",
             "Large & Mid+ FMP", "Scheme Name: A Fund (An open ended scheme)"]
    assert each(K.canonical, texts) == [
        "axis childrens fund", "x fund", "series 43 fof", "ibx 50 50 sep 2027", "large and mid plus fixed maturity plan", "a fund"]
    assert each(K.plan_reductions, ["x fund direct plan growth option"]) == [["x fund direct plan growth", "x fund direct plan", "x fund direct", "x fund"]]
    assert each(K.suffix_reductions, ["infrastructure fund"]) == [["infrastructure"]]
    assert each(K.strip_tenor, ["x fixed maturity plan 3668 days"]) == ["x fixed maturity plan"]


def test_similarity(each):
    a, b = ["NIFTY 50 INDEX", "SILVER ETF", "ALPHA GROWTH"], ["NIFTY 500 INDEX", "SILVER ETF FUND OF FUND", "OMEGA INCOME"]
    plain = [SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)]
    assert each(text_ratio, a, b) == pytest.approx(plain)
    got = each(name_similarity, a, b)
    assert got[0] <= 0.5 and got[1] == 1.0 and got[2] < 0.72
    assert each(scheme_score, ["A B", "A B"], ["A B", "A B C D E F G"]) == [1.0, 0.9]
