import hashlib

from pyspark.sql import functions as F

from folioscope.contracts import DOCUMENTS
from folioscope.operators import completeness as V
from folioscope.operators import documents as D
from folioscope.operators import listing as L

UNIT = ("axis", "2026-05")


def docs(spark, rows):
    out = []
    for i, r in enumerate(rows):
        out.append((*UNIT, r["url"], "https://x/", r.get("label", ""), r.get("filename", ""), r.get("type", "xlsx"), r.get("scheme"),
                    r.get("primary", False), {}, i))
    return spark.createDataFrame(out, DOCUMENTS).repartition(3)


def test_expected_set_and_duplicates(spark):
    d = docs(spark, [
        {"url": "https://x/a.xlsx", "scheme": "Alpha"}, {"url": "https://x/a2.xlsx", "scheme": " alpha", "primary": True},
        {"url": "https://x/b.xlsx?v=1"}, {"url": "https://x/b.xlsx?v=2"}, {"url": "https://x/c.zip", "type": "zip"},
        {"url": "https://x/c.zip", "type": "zip"}, {"url": "https://y/d", "filename": "c.zip", "type": "zip"}])
    items, alternates = D.build_expected(d)
    got = {r.key: (r.url, r.kind) for r in items.collect()}
    assert got["scheme:2026-05:alpha"] == ("https://x/a2.xlsx", "file")
    assert got["url:https://x/b.xlsx"][0] == "https://x/b.xlsx?v=1" and got["url:https://x/c.zip"][1] == "archive"
    assert {(r.key, r.alternate_url) for r in alternates.collect()} == {
        ("scheme:2026-05:alpha", "https://x/a.xlsx"), ("url:https://x/b.xlsx", "https://x/b.xlsx?v=2")}
    kinds = {(r.kind, r.key) for r in D.detect_duplicates(d).collect()}
    assert ("repeated_url", "https://x/c.zip") in kinds and ("filename_collision", "c.zip") in kinds
    assert ("duplicate_listing", "scheme:2026-05:alpha") in kinds


def test_statuses(spark):
    def outcome(month, *statuses):
        return [("axis", month, f"k{i}", s) for i, s in enumerate(statuses)]

    rows = outcome("2026-01", "ok") + outcome("2026-02", "ok", "missing") + outcome("2026-03", "missing") + outcome("2026-04", "corrupt", "ok") + \
        outcome("2026-05", "missing", "corrupt") + outcome("2026-06", "ok", "missing") + outcome("2026-07", "missing")
    df = spark.createDataFrame(rows, "amc string, period string, key string, status string")
    gaps = spark.createDataFrame([("axis", "2026-06", "u"), ("axis", "2026-08", "u")], "amc string, period string, url string")
    fresh = spark.createDataFrame([("axis", "2026-03", "k0")], "amc string, period string, key string")
    changed = V.mark_site_changed(df.filter("period in ('2026-03', '2026-07')"), fresh)
    got = {r.period: r.status for r in V.report_status(df, gaps=gaps, site_changed=changed).collect()}
    assert got == {"2026-01": "SUCCESS", "2026-02": "INCOMPLETE", "2026-03": "DOWNLOAD_FAILED", "2026-04": "CORRUPT", "2026-05": "INCOMPLETE",
                   "2026-06": "UPSTREAM_GAP", "2026-07": "SITE_CHANGED", "2026-08": "UPSTREAM_GAP"}


def test_file_checks(spark):
    def sha(b):
        return hashlib.sha256(b).hexdigest()

    good = b"PK\x03\x04data"
    entries = spark.createDataFrame([
        (*UNIT, "a", "a.xlsx", len(good), sha(good)), (*UNIT, "b", "b.xlsx", 3, sha(good)), (*UNIT, "c", "gone.xlsx", 3, "x"),
        (*UNIT, "d", "page.xlsx", None, None), (*UNIT, "e", None, None, None), (*UNIT, "z", "zero.xlsx", None, None)],
        "amc string, period string, key string, path string, bytes long, sha256 string")
    page = b" <!DOCTYPE HTML><html>"
    facts = spark.createDataFrame([
        (*UNIT, "a.xlsx", len(good), sha(good), good), (*UNIT, "b.xlsx", 3, sha(b"zzz"), b"zzz"), (*UNIT, "page.xlsx", len(page), sha(page), page),
        (*UNIT, "zero.xlsx", 0, sha(b""), b""), (*UNIT, ".secret.json", 1, "s", b"1"), (*UNIT, "extra.xlsx", 1, "s", b"1")],
        "amc string, period string, path string, length long, sha256 string, head binary")
    got = {r.key: (r.status, len(r.reasons)) for r in V.check_files(entries, facts).collect()}
    assert got == {"a": ("ok", 0), "b": ("corrupt", 1), "c": ("missing", 1), "d": ("corrupt", 1), "e": ("corrupt", 1), "z": ("corrupt", 1)}
    assert [r.path for r in V.unexpected_files(facts, entries.filter("path is not null")).collect()] == ["extra.xlsx"]
    kinds = V.sniff_content(facts.withColumn("file_type", F.lit("xlsx"))).select("path", "category").collect()
    assert {r.path: r.category for r in kinds}["page.xlsx"] == "html_response"


def test_listing_pages(spark):
    html = """<a href="/x/Apr.xls" title="April"> Monthly <b>list</b></a><!-- <a href='/old.xls'>old</a> --><i data-u="it's a fund.xlsx?x=1"></i>"""
    pages = spark.createDataFrame([(1, "https://h.example/p/list", html)], "page_id long, url string, html string")
    links = L.extract_links(pages).collect()
    assert [(r.href, r.text, r.searchable) for r in links] == [
        ("https://h.example/x/Apr.xls", "Monthly list", "Monthly list /x/Apr.xls April")]
    files = {r.file_url for r in L.extract_file_urls(pages).collect()}
    assert files == {"https://h.example/x/Apr.xls", "https://h.example/p/it's a fund.xlsx?x=1"}
    good, bad = L.to_document(spark.createDataFrame(
        [(*UNIT, "https://h/", "a b.xlsx"), (*UNIT, "https://h/", '{"x": 1}')], "amc string, period string, source_page_url string, href string"))
    assert good.first().filename == "a b.xlsx" and good.first().file_type == "xlsx" and bad.count() == 1


def test_prefer_resolved_drops_settled_gaps(spark):
    rows = spark.createDataFrame([
        ("jm", "2026-05", "Liquid  Fund", "Monthly", "html", 1, 1), ("jm", "2026-05", "liquid fund", "monthly", "resolved", 2, 2),
        ("jm", "2026-05", "Other", "Monthly", "html", 3, 3)],
        "amc string, period string, title string, category string, status string, record_id long, ord long")
    out = D.prefer_resolved(rows, spark.createDataFrame([(1,), (3,)], "record_id long"))
    assert sorted(r.record_id for r in out["winners"].collect()) == [2, 3]
    assert [r.record_id for r in out["gaps"].collect()] == [3]


def test_house_rules_need_every_clause_and_any_condition(spark):
    from folioscope.operators.listing import classify_listing

    rows = [("hsbc", "https://x/portfolios/a-fund.xlsx", None), ("hsbc", "https://x/portfolios/weekly-a.xlsx", None),
            ("hsbc", "https://x/documents-1/weekly-a.xls", ""), ("hsbc", "https://x/other/a.xlsx", "Monthly-Portfolio"),
            ("hsbc", "https://x/half-yearly-portfolios/monthly-portfolio.xlsx", ""), ("hsbc", None, "monthly-portfolio"),
            ("unifi", "https://x/MP-1.xlsx?a", None), ("unifi", "https://x/1.xlsx", "monthly-portfolio-disclosure"), ("unifi", "https://x/mp-1.xlsx", "Notice"),
            ("unknown", "https://x/1.xlsx", "monthly portfolio"), (None, "https://x/1.xlsx", "monthly portfolio")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, amc string, url string, text string")
    assert sorted(r.i for r in classify_listing(df).collect()) == [0, 2, 3, 6, 7]
    rules = spark.createDataFrame([("unknown", "include", "text", "never", 1), ("unknown", "exclude", "name", "^2", 1), ("unknown", "include", "url", "x", None)],
                                  "amc string, action string, field string, pattern string, clause int")
    assert [r.i for r in classify_listing(df, rules).collect()] == [9]
    assert "Exchange" not in classify_listing(df)._jdf.queryExecution().toString()
