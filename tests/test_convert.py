import re

from pyspark.sql import functions as F

from folioscope.contracts import FINAL_FIELDS, LOOKUPS
from folioscope.operators import convert as C


def lookups(spark, **tables):
    def table(name):
        return spark.createDataFrame(tables.get(name, []), LOOKUPS[name])

    return C.Lookups(
        mapping=table("schemes") if "schemes" in tables else spark.createDataFrame(
            [("test_amc", "TEST FUND", "Test Fund", "100001", "Test Fund - Growth", 1.0)], LOOKUPS["schemes"]),
        classification=table("isin_classification"), aliases=table("isin_aliases"),
        names=table("isin_names"), variants=table("isin_name_variants"), overrides=table("non_isin_overrides"),
    )


KNOWN = [("INE040A01034", "Equity", "EQ", "", "", "", "")]


def final(df):
    return [r.asDict() for r in df.collect()]


def test_columns_in_order(spark, holdings):
    out = C.convert(holdings([{"isin": "INE040A01034"}]), lookups(spark, isin_classification=KNOWN))
    assert out.columns == ["amc", "period", *FINAL_FIELDS, "Name_Source"]


def test_known_unknown_and_aliased_codes(spark, holdings):
    look = lookups(
        spark, isin_classification=KNOWN, isin_names=[("INE040A01034", "HDFC Bank Limited")],
        isin_aliases=[("INE999X01011", "INE040A01034")])
    rows = final(C.convert(holdings([
        {"isin": "INE040A01034", "pct": 60.0}, {"isin": "INE999X01011", "pct": 20.0},
        {"isin": "US5949181045", "pct": 20.0}]), look))
    by = {}
    for r in rows:
        by.setdefault((r["ISIN"], r["Instrument_Name"]), []).append(r)
    assert len(by[("INE040A01034", "Equity")]) == 2
    tagged = by[("US5949181045", "Undisclosed - Others")][0]
    assert tagged["Nature_Name"] == "Others" and tagged["Security_Name"] == ""
    assert by[("INE040A01034", "Equity")][0]["Security_Name"] == "HDFC Bank Limited"


def test_unseen_code_uses_the_key_table(spark, holdings):
    rows = final(C.convert(holdings([{"isin": "INE002A01018"}]), lookups(spark, isin_classification=KNOWN)))
    assert rows[0]["Instrument_Name"] == "Equity"


def test_blank_code_resolved_by_name(spark, holdings):
    look = lookups(spark, isin_classification=KNOWN, isin_name_variants=[
        ("INE040A01034", "HDFC Bank Ltd", "HDFCBANKLIMITED", 5, 1)])
    rows = final(C.convert(holdings([{"name": "HDFC Bank Ltd."}]), look))
    assert rows[0]["ISIN"] == "INE040A01034" and rows[0]["Instrument_Name"] == "Equity"
    assert rows[0]["Name_Source"] == "variant"


def test_house_override_beats_central_rule(spark, holdings):
    look = lookups(spark, non_isin_overrides=[("test_amc", 1, "prefix", "TREPS", "Money Market", "Others")])
    rows = final(C.convert(holdings([{"name": "TREPS 01-Jun"}]), look))
    assert rows[0]["Instrument_Name"] == "Money Market"


def test_header_restating_its_rows_is_dropped(spark, holdings):
    look = lookups(spark, isin_classification=KNOWN)
    tagged = C.tag_holdings(holdings([
        {"name": "Equity & Equity Related", "value": 90.0, "pct": 90.0},
        {"name": "Listed", "value": 90.0, "pct": 90.0},
        {"isin": "INE040A01034", "value": 60.0, "pct": 60.0},
        {"isin": "INE002A01018", "value": 30.0, "pct": 30.0},
        {"name": "Accrued Interest", "value": 7.0, "pct": 10.0},
    ]), look)
    got = {r.security_name: r.outcome for r in tagged.filter("isin is null").collect()}
    assert got == {"Equity & Equity Related": "not_a_holding", "Listed": "not_a_holding",
                   "Accrued Interest": "converted"}
    assert {r.pct_scale for r in tagged.collect()} == {1.0}
    report = C.convert_report(tagged).first()
    assert (report.total, report.converted, report.not_a_holding) == (5, 3, 2)
    assert {r.reason for r in C.unresolved(tagged).collect()} >= {"not_a_holding", "tagged_isin"}


def test_first_stop_not_any_later_match(spark, holdings):
    """A negative row brings the sum back to the header's value after it overshot: the header stays."""
    look = lookups(spark, isin_classification=KNOWN)
    rows = holdings([
        {"name": "Heading", "value": 100.0},
        {"isin": "INE040A01034", "value": 150.0}, {"isin": "INE002A01018", "value": -50.0}])
    tagged = C.tag_holdings(rows, look)
    assert tagged.filter("security_name = 'Heading'").first().outcome == "converted"


def test_futures_row_loses_the_underlyings_code(spark, holdings):
    rows = final(C.convert(holdings([
        {"isin": "INE040A01034", "value": 120.0, "pct": 120.0},
        {"isin": "INE040A01034", "name": "HDFC Bank-JUN2026", "section": "Stock Futures", "value": -20.0,
         "pct": None}]), lookups(spark, isin_classification=KNOWN)))
    future = [r for r in rows if r["Instrument_Name"] == "Futures"][0]
    assert future["ISIN"] == "" and abs(future["Corpus_Per"] + 20.0) < 1e-9


def test_fraction_scale_and_numeric_text(spark, holdings):
    rows = final(C.convert(holdings([
        {"isin": "INE040A01034", "pct": "0.6", "value": "60"},
        {"isin": "INE002A01018", "pct": 0.4, "value": 40, "quantity": "NIL"}]),
        lookups(spark, isin_classification=KNOWN)))
    assert sorted(round(r["Corpus_Per"], 6) for r in rows) == [40.0, 60.0]
    assert None in {r["No_Of_Shares"] for r in rows}


def test_unmapped_scheme_is_reported_not_written(spark, holdings):
    look = lookups(spark, isin_classification=KNOWN)
    tagged = C.tag_holdings(holdings([{"scheme": "Other Fund", "isin": "INE040A01034"}]), look)
    assert C.finalize(tagged).count() == 0
    assert C.unresolved(tagged).first().reason == "unmapped_scheme"


def test_restated_totals_against_brute_force(spark):
    """Random values with negatives, small blocks forced through every level of the search."""
    import random

    from folioscope.scale import first_reaching

    rnd = random.Random(7)
    rows, expected = [], {}
    for key in ("a", "b", "c"):
        values = [rnd.choice([-3.0, 1.0, 2.0, 5.0, 8.0]) for _ in range(400)]
        prefix, total = [], 0.0
        for v in values:
            total += v
            prefix.append(total)
        rows += [(key, i, p) for i, p in enumerate(prefix)]
        for i in rnd.sample(range(400), 60):
            need = prefix[i] + rnd.uniform(1, 700)
            hit = next((j for j in range(i + 1, 400) if prefix[j] >= need), None)
            expected[(key, i, need)] = hit
    points = spark.createDataFrame(rows, "k string, pos long, level double")
    queries = spark.createDataFrame(list(expected), "k string, pos long, need double")
    got = first_reaching(points, queries, ["k"], position="pos", level="level", threshold="need", out="hit",
                         block_bits=3, fan_bits=3)
    assert {(r.k, r.pos, r.need): r.hit for r in got.collect()} == expected


def test_ordered_scan_matches_plain_loops(spark):
    import random

    from folioscope.scale import ordered_scan

    rnd = random.Random(3)
    rows = [(k, i * 3 + 1, rnd.choice([None, "x", "y"]), rnd.randint(-5, 9)) for k in "ab" for i in range(300)]
    df = spark.createDataFrame(rows, "k string, ord long, tag string, v long").repartition(4)
    state = {}
    expected = {}
    for k, o, tag, v in rows:
        run, seen, before, pos = state.get(k, (0, None, None, -1))
        run, seen, pos = run + v, tag or seen, pos + 1
        expected[(k, o)] = (run, seen, before, pos)
        state[k] = (run, seen, v, pos)
    for levels in (0, 1, 3):  # blocks of 6 rows, bundles of 4 blocks: with three levels no window sees more than a few summaries
        got = ordered_scan(df, ["k"], ["ord"], F.shiftright("ord", 4), sums={"run": F.col("v")}, lasts={"seen": F.col("tag")},
                           previous={"before": F.col("v")}, position="pos", bundle_bits=2, levels=levels)
        assert {(r.k, r.ord): (r.run, r.seen, r.before, r.pos) for r in got.collect()} == expected


def test_ordered_scan_of_negative_blocks_null_values_and_null_keys(spark):
    """A previous value may be null at the end of a block or bundle; a null key is a key."""
    from folioscope.scale import ordered_scan

    rows = [(k, i, None if i % 3 == 0 else i) for k in ("a", None) for i in range(-70, 70)]
    df = spark.createDataFrame(rows, "k string, ord long, v long").repartition(3)
    got = ordered_scan(df, ["k"], ["ord"], F.shiftright("ord", 1), sums={"run": F.col("v")}, previous={"before": F.col("v")},
                       bundle_bits=1, levels=4).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.before == (None if r.ord == -70 or (r.ord - 1) % 3 == 0 else r.ord - 1)
        assert r.run == sum(i for i in range(-70, r.ord + 1) if i % 3)


def test_no_window_of_ordered_scan_sees_all_blocks_of_a_hot_key(spark):
    """A thousand blocks in bundles of eight, these in bundles of eight: the one window by key alone is over 16 rows."""
    from folioscope.scale import _carried_in

    blocks = spark.range(1000).selectExpr("concat('hot', id % 1) AS k", "id AS b", "1L AS __scan_s_n")
    seen = _carried_in(blocks, ["k"], "b", ["n"], [], [], 3, 2)
    assert {r.b: r["__scan_c_s_n"] for r in seen.collect()} == {b: b for b in range(1000)}
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    by = re.findall(r"Window \[.*\], \[([^\[\]]*)\], \[(b_*)#", plan)
    assert sorted((keys.count("#"), place) for keys, place in by) == [(1, "b__"), (2, "b"), (2, "b_")]
