import io
import json
import os
import zipfile

from pyspark.sql import functions as F

from folioscope.contracts import FINAL_FIELDS
from folioscope.sources import tables as S
from folioscope.sources import workbooks as W
from folioscope.streaming import arrivals

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def workbook(sheets):
    """Smallest OOXML workbook: sheet name -> rows of (cell reference, type, value)."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        names = list(sheets)
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>' + "".join(
            f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(
            f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i, _ in enumerate(names, 1)) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}"><si><t>shared</t></si><si><r><t>rich </t></r><r><t>text</t></r></si></sst>')
        for i, name in enumerate(names, 1):
            rows = ""
            for number, cells in sheets[name]:
                body = "".join(
                    f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>' if kind == "inlineStr" else f'<c r="{ref}" t="{kind}"><v>{v}</v></c>'
                    for ref, kind, v in cells)
                rows += f'<row r="{number}">{body}</row>'
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{rows}</sheetData></worksheet>')
    return out.getvalue()


BOOK = {"One": [(1, [("A1", "s", 0), ("C1", "n", "2.5")]), (3, [("B3", "b", 1), ("AA3", "inlineStr", "far")])], "Two": [(1, [("A1", "s", 1)])]}


def land(root, name, content, amc="axis", period="2026-05"):
    folder = os.path.join(root, amc, period)
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as f:
        f.write(content)


def test_workbooks(spark, tmp_path):
    root = str(tmp_path / "raw")
    land(root, "good.xls", workbook(BOOK))
    land(root, "All Schemes.xlsx", workbook(BOOK))
    land(root, "broken.xlsx", b"PK\x03\x04nope")
    land(root, "old.xls", b"\xd0\xcf\x11\xe0rest")
    files = W.select_workbooks(W.read_files(spark, root))
    assert sorted(r.source_file for r in files.select("source_file").collect()) == ["broken.xlsx", "good.xls", "old.xls"]
    cells, rejects = W.explode_workbooks(files)
    rows = {(r.sheet, r.row_idx): [tuple(c) if c else None for c in r.cells] for r in cells.collect()}
    assert rows[("One", 0)] == [("shared", None), None, (None, 2.5)] and rows[("Two", 0)] == [("rich text", None)]
    assert rows[("One", 2)][1] == ("TRUE", None) and rows[("One", 2)][26] == ("far", None) and len(rows) == 3
    assert {r.source_file for r in rejects.collect()} == {"broken.xlsx", "old.xls"}


def test_monthly_file(spark):
    rows = [("a", "2026-05", "X_MONTHLY_PORTFOLIO_May2026.xlsx"), ("a", "2026-05", "X_MONTHLY_PORTFOLIO_April_2026.xlsx"),
            ("b", "2026-05", "MONTHLY_PORTFOLIO.xlsx"), ("c", "2026-05", "MONTHLY_PORTFOLIO_1.xlsx"), ("c", "2026-05", "MONTHLY_PORTFOLIO_2.xlsx")]
    chosen, rejects = W.select_monthly_file(spark.createDataFrame(rows, "amc string, period string, source_file string"))
    assert sorted((r.amc, r.source_file) for r in chosen.collect()) == [
        ("a", "X_MONTHLY_PORTFOLIO_May2026.xlsx"), ("b", "MONTHLY_PORTFOLIO.xlsx")]
    assert {r.amc for r in rejects.collect()} == {"c"}


def test_house_list_and_lookups(spark, tmp_path):
    lines = ["Scheme Code;ISIN;ISIN2;Scheme Name;NAV;Date", "", "Open Ended Schemes(Equity)", "", "Axis Mutual Fund", "", "101;INF1;-;Axis One - Growth;1;d",
             "Close Ended Schemes(Debt)", "HDFC Mutual Fund", "102;INF2;-;HDFC Two;1;d"]
    path = tmp_path / "list.txt"
    path.write_text("\n".join(lines), encoding="cp1252")
    rows = S.read_house_list(spark, str(path)).orderBy("ordinal").collect()
    assert [(r.house, r.code, r.name) for r in rows] == [("Axis Mutual Fund", "101", "Axis One - Growth"), ("HDFC Mutual Fund", "102", "HDFC Two")]
    assert S.read_lookup(spark, str(tmp_path), "isin_aliases").count() == 0
    (tmp_path / "isin_names.csv").write_text("isin,canonical_name\nINE040A01034,HDFC Bank\n")
    assert S.read_lookup(spark, str(tmp_path), "isin_names").first().canonical_name == "HDFC Bank"


def test_manifest(spark, tmp_path):
    manifest = {"downloads": {
        "u1": {"scheme": "Alpha", "path": "d/a.xlsx", "bytes": 3, "sha256": "x"},
        "u2": {"scheme": "Zip", "archive": {"name": "z.zip"}, "extracted": [{"path": "z/m.xlsx", "sha256": "y"}]},
        "u3": {"archive": {"name": "e.zip"}, "extracted": []}}, "failures": {"u9": {"category": "html_response", "status": 404, "error": "no"}}}
    land(str(tmp_path), "manifest.json", json.dumps(manifest).encode())
    out = S.read_manifest(spark, str(tmp_path))
    assert {r.source_file: r.scheme for r in out["schemes"].collect()} == {"a.xlsx": "Alpha", "m.xlsx": "Zip"}
    assert {(r.url, r.path) for r in out["members"].collect()} == {("u2", "z/m.xlsx"), ("u3", None)}
    assert out["failures"].first().status == 404 and out["entries"].count() == 3


def test_final_sink_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "final")

    def rows(amc, value):
        base = spark.createDataFrame([(amc, "2026-05")], "amc string, period string")
        return base.select("*", *[F.lit(value if c == "Mkt_Value" else None).cast("double" if c in (
            "Corpus_Per", "Mkt_Value", "No_Of_Shares") else "string").alias(c) for c in FINAL_FIELDS])

    for amc, value in (("a", 1.0), ("b", 2.0), ("a", 3.0)):
        S.write_final(rows(amc, value), path, fmt="csv")
    got = spark.read.option("header", "true").csv(path).collect()
    assert {(r.amc, r.Mkt_Value, r.No_Of_Shares) for r in got} == {("a", "3.0", "NULL"), ("b", "2.0", "NULL")}


def test_streams(spark, tmp_path):
    landing, cells, rejects = (str(tmp_path / n) for n in ("landing", "cells", "rejects"))
    land(landing, "one.xlsx", workbook(BOOK))
    land(landing, "bad.xlsx", b"hello")

    def run():
        query = arrivals.stream_workbooks(spark, landing, cells, rejects, str(tmp_path / "ckpt"))
        query.awaitTermination(120)

    run()
    land(landing, "two.xlsx", workbook(BOOK), "hdfc")
    run()
    def state():
        got = arrivals.read_cells(spark, cells).groupBy("amc", "source_file").count().collect()
        return {(r.amc, r.source_file, r["count"]) for r in got}, {r.source_file for r in arrivals.read_rejects(spark, rejects).collect()}

    assert state() == ({("axis", "one.xlsx", 3), ("hdfc", "two.xlsx", 3)}, {"bad.xlsx"})
    land(os.path.join(landing, "again"), "one.xlsx", b"PK\x03\x04damaged")  # sent again: now damaged, and the other one mended
    land(os.path.join(landing, "again"), "bad.xlsx", workbook({"Only": [(1, [("A1", "s", 0)])]}))
    run()
    assert state() == ({("axis", "bad.xlsx", 1), ("hdfc", "two.xlsx", 3)}, {"one.xlsx"})

    attempts, ledger = tmp_path / "attempts", str(tmp_path / "ledger")
    attempts.mkdir()
    for number, code in ((2, 0), (1, 9)):  # the later attempt arrives first
        (attempts / f"{number}.json").write_text(json.dumps(
            {"amc": "axis", "period": "2026-05", "attempt": number, "exit_code": code, "message": "m", "timed_out": False}) + "\n")
        arrivals.stream_ledger(spark, str(attempts), ledger, str(tmp_path / "ckpt2"), "2026-08-01").awaitTermination(120)
    assert [(r.amc, r.month, r.status) for r in S.read_ledger(spark, ledger).collect()] == [("axis", "05", "SUCCESS")]
