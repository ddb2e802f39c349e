import json

from folioscope.operators.documents import snapshot_stable
from folioscope.operators.identity import seed_lookups
from folioscope.operators.listing import stream_lines
from folioscope.sources.tables import read_listing, read_reference


def test_stream_lines(spark):
    pages = spark.createDataFrame([(1, '1:{"a":1}\nno json here\n2:[1,2]\n3:not json\n')], "page_id long, html string")
    assert [(r.pos, r.payload) for r in stream_lines(pages).orderBy("pos").collect()] == [(0, '{"a":1}'), (2, "[1,2]")]


def test_snapshots(spark):
    a = spark.createDataFrame([("1", "u"), ("2", "v")], "record_id string, url string")
    assert snapshot_stable(a, a.unionByName(a)) and not snapshot_stable(a, a.limit(1))


def test_reference_and_seeds(spark, tmp_path):
    head = "amfi_code,port_date,isin,instrument_name,nature_name,basic_industry,industry,sector_name,macro_economic_sector,corpus_per,mkt_value,no_of_shares,fund_name"
    rows = ["100001,2026-05-31,A,Equity,Stock,b,i,s,m,1.0,2.0,3,Demo One", "100001,2026-05-31,A,Equity,Stock,b,i,s,m,1.0,2.0,3,Demo One",
            "100001,2026-05-31,A,Debt,Bond,b,i,s,m,1.0,2.0,3,Demo Uno", ",,,,,,,,,,,,"]
    path = tmp_path / "reference.csv"
    path.write_text("\n".join([head, *rows]) + "\n")
    ref = read_reference(spark, str(path))
    assert ref.count() == 3
    out = seed_lookups(ref)
    name, kind = out["amfi_codes"].first(), out["isin_classification"].first()
    assert (name.amfi_code, name.fund_name, name.candidates) == ("100001", "Demo One", 2)
    assert (kind.isin, kind.instrument_name, kind.candidates) == ("A", "Equity", 2)
    assert {r.kind for r in out["conflicts"].collect()} == {"amfi_code", "isin"}


def test_listing(spark, tmp_path):
    path = tmp_path / "listing.json"
    path.write_text(json.dumps({"status": "ok", "max_pages": 1, "financial_years": ["2024-25", "2025-26"], "months": [], "scheme_titles": [], "data": []}))
    row = read_listing(spark, str(path), "demo").first()
    assert (row.amc, row.year, row.payload.status) == ("demo", "2025-26", "ok")
