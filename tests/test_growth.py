"""What keeps figures in step with the input: honest sizes, work in many tasks, fewer comparisons."""

import datetime as dt
import json
import random
import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F

from folioscope.contracts import CELLS
from folioscope.functions import canonical as K
from folioscope import fixed_values as fv
from folioscope.functions.isin import has_isin_shape, is_valid_isin
from folioscope.functions.names import clean_name
from folioscope.functions.periods import extract_periods
from folioscope.functions.similarity import Bounds
from folioscope.functions.text import collapse, unescape_entities
from folioscope.operators import coverage as A
from folioscope.operators import reconcile
from folioscope.operators import schemes as S
from folioscope.operators import convert, derivatives, identity, layouts, sheets
from folioscope.plans import holdings_queries, landing_queries
from folioscope.plans.document_queries import as_of_period
from folioscope.scale import ordered_scan, settle, spread, tasks_for


def test_settled_rows_have_their_true_size(spark):
    """Rows made by an explode: a checkpoint kept the small size of the rows before it, and joins broadcast them."""
    few = spark.range(10).withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(100_000)))).withColumn("t", F.md5(F.col("x").cast("string")))
    assert int(str(settle(few)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > 5_000_000


def test_settle_keeps_any_columns(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n long, `odd name, x` string").withColumn("empty", F.lit(None))
    twice = df.select("n", F.col("n").alias("m"), "*").toDF("a", "b", "n", "odd name, x", "empty")
    got = settle(twice)
    assert got.columns == twice.columns and got.schema["empty"].dataType == twice.schema["empty"].dataType
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)
    assert settle(twice.limit(0)).count() == 0


def test_candidates_of_one_split_are_made_in_many_tasks(spark):
    texts = spark.createDataFrame([(str(i), f"Demo {i} Large Fund", "s", 1, True) for i in range(64)],
                                  "unit_id string, raw string, source string, ord int, need_word boolean").coalesce(1)
    assert A.build_candidates(texts).select(F.spark_partition_id()).distinct().count() > 1
    assert spread(texts).count() == 64


def test_decompositions_are_looked_up_in_short_pages(spark):
    pages = json.loads(K.DECOMPOSITIONS)
    assert max(len(p) for p in pages if p) <= K.PAGE
    blocks = (range(0x21, 0xAC00), range(0xE000, 0x110000))
    chars = [chr(c) for b in blocks for c in b if c < 0x180 or unicodedata.normalize("NFKD", chr(c)) != chr(c)]
    texts = ["".join(chars[i : i + 40]) + "€" for i in range(0, len(chars), 40)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", K.compatibility_form(F.col("t")).alias("d")).collect()
    assert all(r.d == "".join(unicodedata.normalize("NFKD", c) for c in r.t) for r in got)


def test_bounds_hold_the_ratio():
    rnd = random.Random(3)
    texts = ["".join(rnd.choices("abcd 12", k=rnd.randrange(0, 40))) for _ in range(60)] + ["é" * 70, ""]
    for text, bound in zip(texts, (bounds := Bounds(texts[:50] + texts[-2:])).of(texts)):
        ratios = [SequenceMatcher(None, text, t).ratio() for t in texts[:50] + texts[-2:]]
        quick = [SequenceMatcher(None, text, t).quick_ratio() for t in texts[:50] + texts[-2:]]
        assert bound.tolist() == quick
        closer = bounds.tighter(text, pd.RangeIndex(52).to_numpy())
        assert closer is None or all(r <= c <= q for r, c, q in zip(ratios, closer, quick))


def _names(rnd, n):
    words = "large ring hot bolt blue old plate cold fund quality".split()
    return [" ".join(rnd.choices(words, k=2)) + f" no {rnd.randrange(300)} fund" for _ in range(n)]


def test_near_tile_equals_all_pairs(monkeypatch):
    """The three best of all pairs, while few pairs are scored: all pairs of a house took more than the time limit."""
    rnd = random.Random(1)
    left = pd.DataFrame([(f"u{i // 2}", t.replace(" ", ""), t) for i, t in enumerate(_names(rnd, 60))], columns=["unit_id", "form", "raw"])
    right = pd.DataFrame([(i, t, t.replace(" ", "")) for i, t in enumerate(_names(rnd, 400))], columns=["scheme_id", "fund_name", "target"])
    want = []
    for unit, forms in left.groupby("unit_id"):
        scored = [(max(SequenceMatcher(None, f, r.target).ratio() for f in forms["form"]), r.fund_name) for r in right.itertuples()]
        want += [(unit, round(s, 12), n) for s, n in sorted(((s, n) for s, n in scored if s >= 0.7), key=lambda x: (-x[0], x[1]))[:3]]
    calls = []

    class Counted(SequenceMatcher):
        def ratio(self):
            calls.append(1)
            return super().ratio()

    monkeypatch.setattr(A, "SequenceMatcher", Counted)
    got = [(r.unit_id, round(r.score, 12), r.fund_name) for r in A._tile_near(left, right).itertuples()]
    assert sorted(got) == sorted(want) and len(calls) < 60 * 400 / 10


def test_match_scheme_meets_candidates_of_its_numbers_only(spark, monkeypatch):
    """Equal to all pairs of a house, with names without, with shared and with several numbers, in packed and own tiles."""
    rnd = random.Random(4)
    words = "LARGE RING HOT BOLT OLD PLATE".split()

    def name():
        return " ".join([*rnd.choices(words, k=2), *[str(rnd.randrange(6)) for _ in range(rnd.randrange(3))]])

    cands = [("h" + str(i % 2), str(i), f"n{i}", i, name() + " FUND") for i in range(150)]
    names = [("h" + str(i % 2), t) for i, t in enumerate({name() + rnd.choice(["", " FND", " X 9"]) for _ in range(80)})]
    import re

    want = {}
    for house, target in names:
        best = (0.0, 0, None)
        for h, code, _, ordinal, base in cands:
            if h == house and set(re.findall(r"\d+", target)) <= set(re.findall(r"\d+", base)):
                score = SequenceMatcher(None, target, base).ratio()
                score = 1.0 if target == base else max(score, 0.9) if target in base or base in target else score
                best = max(best, (score, -ordinal, code))
        want[house, target] = (best[2], round(best[0], 9))
    sent = spark.createDataFrame(names, "house string, scheme_name_raw string"), spark.createDataFrame(
        cands, "house string, amfi_code string, fund_name string, ordinal long, base_norm string")
    got = {(r.house, r.target): (r.amfi_code, round(r.score, 9)) for r in S.match_scheme(*sent).collect()}
    assert got == want
    tiles = []
    grid = S.grid
    monkeypatch.setattr(S, "grid", lambda *a, **k: tiles.append(a) or grid(*a, **k, left_rows=8, right_rows=8))
    assert {(r.house, r.target): (r.amfi_code, round(r.score, 9)) for r in S.match_scheme(*sent).collect()} == want
    assert tiles[0][2] == ["house", "number"]


def test_codes_are_dealt_by_their_number(spark):
    schema = "amfi_code string, isin string"
    ours = spark.createDataFrame([("1", "A"), ("1", "B"), ("1", "B"), (None, "N"), ("2", ""), ("3", "C")], schema)
    ref = spark.createDataFrame([("1", "B"), ("1", "D"), (None, "N"), (None, "M"), ("2", "E"), ("9", "F"), ("3", "C"), ("3", None)], schema)
    want = {("1", "A", "ours"), ("1", "D", "reference"), (None, "N", "ours"), ("2", "E", "reference")}
    for tasks in (None, 7):
        assert {tuple(r) for r in reconcile.isin_differences(ours, ref, tasks=tasks).collect()} == want
    assert tasks_for(10, spark) == 4 and tasks_for(100, spark, per_task=9) == 12


def test_periods_of_one_split_are_read_in_many_tasks(spark, tmp_path):
    rows = [(i, dt.datetime(1996, 1 + i % 12, 28)) for i in range(64)]
    spark.createDataFrame(rows, "o_orderkey long, o_orderdate timestamp").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    out = as_of_period(spark, str(tmp_path))
    assert out.select(F.spark_partition_id()).distinct().count() > 1
    assert {r.named for r in out.collect()} == {0, 2} and out.filter("period IS NULL").count() == 0


def test_texts_without_digits_name_no_period(spark):
    texts = spark.createDataFrame([("Portfolio of May",), ("May 2026",), ("May%2026",), ("",), (None,), ("5/6",), ("Jun 25",)], "t string")
    got = [r.p for r in texts.select(extract_periods(F.col("t")).alias("p")).collect()]
    assert got[0] == [] and got[1] == ["2026-05"] and got[3:] == [[], [], [], ["2025-06"]]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scanned_rows_move_once(spark):
    """The join with what earlier blocks hand on leaves rows where their window has put them; null keys, values and orders count as well."""
    kept = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    rows = [(k, t, i if i % 7 else None, float(i)) for k, t in ((1, "a"), (None, "a"), (1, None), (2, "")) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, t string, o long, v double")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        scanned = ordered_scan(df, ["k", "t"], ["o", "v"], F.shiftright("o", 3), sums={"s": F.col("v")}, previous={"p": F.struct("k", "v")},
                               position="at")
        moves = [line for line in _plan(scanned).splitlines() if "Exchange hashpartitioning" in line]
        assert not any("coalesce(k#" in line or "coalesce(t#" in line for line in moves)
        assert scanned.columns == ["k", "t", "o", "v", "s", "at", "p"]
        got = scanned.collect()
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert len(got) == len(rows)
    for key in {r[:2] for r in rows}:
        own = sorted((r for r in rows if r[:2] == key), key=lambda r: (r[2] is not None, r[2] or 0, r[3]))
        found = sorted((r for r in got if (r.k, r.t) == key), key=lambda r: r["at"])
        assert [(r.o, r.v) for r in found] == [r[2:] for r in own]
        assert [r.s for r in found] == [sum(x[3] for x in own[:i + 1]) for i in range(len(own))]
        handed = [(tuple(r.p), (key[0], before[3])) for r, before in zip(found[1:], own) if before[2] is not None]
        assert all(got == wanted for got, wanted in handed) and found[0].p is None


class _Seen(Exception):
    pass


def _input_of(monkeypatch, module, name, run):
    """The first argument with which a query calls an operator."""
    def stop(df, *_, **__):
        raise _Seen(df)

    monkeypatch.setattr(module, name, stop)
    try:
        run()
    except _Seen as seen:
        return seen.args[0]


def _tables(spark, folder):
    spark.range(40).selectExpr("id div 4 l_orderkey", "cast(id % 4 as int) l_linenumber", "id % 5 l_partkey", "id % 3 l_suppkey",
                               "cast(id as double) l_extendedprice", "1.0D l_quantity", "'N' l_returnflag").write.parquet(f"{folder}/lineitem.parquet")
    spark.range(5).selectExpr("id p_partkey", "'bolt' p_name", "'STEEL' p_type", "cast(id as int) p_size", "'Brand#1' p_brand").write.parquet(
        f"{folder}/part.parquet")
    spark.range(3).selectExpr("id s_suppkey").write.parquet(f"{folder}/supplier.parquet")
    return str(folder)


def test_printed_rows_are_made_once(spark, monkeypatch, tmp_path):
    """Operators that read their input several times get settled rows, not the scans these come from."""
    sf = _tables(spark, tmp_path)
    marked = _input_of(monkeypatch, convert, "mark_restated_totals", lambda: holdings_queries.restated_totals(spark, sf))
    cells = _input_of(monkeypatch, layouts, "parse_period", lambda: landing_queries.parsed_month(spark, sf))
    assert "Window" not in _plan(marked) and "Window" not in _plan(cells)
    assert marked.filter("identifiable").count() == 40


def test_differing_codes_are_found_once(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "a", 1.0, 1.0, 1)], "amfi_code long, isin string, quantity double, mkt_value double, row_id long")
    first = _input_of(monkeypatch, reconcile, "settle", lambda: reconcile.alias_pairs(rows, rows))
    assert first.columns == ["amfi_code", "isin", "side"]


def test_pages_go_to_python_one_by_one(spark):
    """An Arrow batch holds up to 10,000 whole pages."""
    df = spark.createDataFrame([("a &amp; b",), (None,), ("&lt;",)], "t string").select(unescape_entities("t").alias("u"))
    assert "ArrowEvalPython" not in _plan(df) and "BatchEvalPython" in _plan(df)
    assert [r.u for r in df.collect()] == ["a & b", None, "<"]


def _moves(df):
    """Shuffles a plan writes (with joins that do not broadcast), without those it reads once more."""
    spark = df.sparkSession
    kept = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = _plan(df.select("*"))
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    return [line for line in plan.splitlines() if " Exchange hashpartitioning" in line and "ReusedExchange" not in line]


def _pages(spark, cell, sheets_of=3):
    head = ["Name of the Instrument", "ISIN", "Industry", "Quantity", "Market Value", "% to Net Assets"]
    a, b = "INE040A01034", "INE002A01018"
    lines = [["Alpha Fund"], head, ["Equity"], ["HDFC Bank", a, "Banks", 10, 50.5, 60], ["Reliance Ltd", b, "Oil", 10, 50.5, 40],
             ["Beta Fund"], head, ["Infosys future", None, None, 5, -2, -1], ["Notes"], ["After", a, "x", 1, 1, 1]]
    rows = [("h", "2026-05", f"f{k % 2}", f"S{k}", k, i, [cell(v) for v in line]) for k in range(sheets_of) for i, line in enumerate(lines)]
    rows += [("h", None, "f0", "S9", 9, i, [cell(v) for v in line]) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, CELLS)


def test_cells_of_a_sheet_move_once(spark, cell):
    """Marking, content columns, titles and body each dealt all cells again, and the marked cells were written as well."""
    held = sheets.parse_sheets(_pages(spark, cell))
    assert len(_moves(held)) == 1 and len(_moves(sheets.merge_receivables(held))) == 1
    got = {(r.sheet, r.scheme_name_raw, r.section_header, r.security_name, r.isin) for r in held.collect()}
    assert got == {(f"S{k}", *x) for k in range(3) for x in (
        ("Alpha Fund", "Equity", "HDFC Bank", "INE040A01034"), ("Alpha Fund", "Equity", "Reliance Ltd", "INE002A01018"),
        ("Beta Fund", None, "Infosys future", None))}


def test_harvested_cells_move_once(spark, cell):
    rows = identity.harvest_rows(_pages(spark, cell))
    assert len(_moves(rows)) == 1
    got = {(r.sheet, r.name, r.kind, r.section) for r in rows.filter("kind <> 'section'").collect()}
    assert got == {(f"S{k}", *x) for k in range(3) for x in (
        ("HDFC Bank", "linked", "Equity"), ("Reliance Ltd", "linked", "Equity"), ("Infosys future", "unlinked", "Beta Fund"), ("After", "linked", "Notes"))}


def test_columns_in_a_sheet_are_those_of_any_table(spark, cell):
    rnd = random.Random(5)
    codes = ["INE040A01034", "INE002A01018", "US5949181045"]
    rows = [("h", "2026-05", "f", f"S{k}", k, i, [cell(rnd.choice([*codes, "Some Bank", f"Name {i}", "x", None, 5])) for _ in range(5)])
            for k in range(12) for i in range(rnd.randrange(1, 9))]
    cells = spark.createDataFrame(rows, CELLS)
    found = sheets.locate_in_sheets(sheets.coded_rows(cells), sheets.SHEET_KEYS).filter("name_col is not null")
    want = sheets.locate_columns(cells, sheets.SHEET_KEYS)
    assert found.columns == want.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect())) != []


def test_copies_of_a_scheme_are_looked_for_in_place(spark):
    """Rows move to their position and to their place in the copy; the scheme's size and verdict come to them."""
    rows = [(k, c, i, float(i % 7), 100.0 / n) for k, n, copies in ((1, 10, 2), (2, 9, 3), (3, 8, 1), (None, 4, 2)) for c in range(copies) for i in range(n)]
    rows += [(4, 0, i, float(i), 50.0) for i in range(4)] + [(1, 9, None, 1.0, 0.0)] * 2  # 4: twice by its total, but rows differ
    df = spark.createDataFrame(rows, "k long, c int, o int, v double, p double")
    kept = sheets.drop_duplicate_blocks(df, ("k",), ("c", "o"), F.struct("c", F.shiftright("o", 2)), (F.col("v"),), F.col("p"))
    assert kept.columns == df.columns
    assert len([m for m in _moves(kept) if "REPARTITION_BY_COL" in m]) == 1 and "LeftAnti" not in _plan(kept)
    counts = {r.k: r["count"] for r in kept.groupBy("k").count().collect()}
    assert counts == {1: 22, 2: 9, 3: 8, None: 8, 4: 4}
    kept = sheets.drop_duplicate_blocks(df.filter("o is not null"), ("k",), ("c", "o"), F.struct("c", F.shiftright("o", 2)), (F.col("v"),), F.col("p"))
    assert {r.k: r["count"] for r in kept.groupBy("k").count().collect()} == {1: 10, 2: 9, 3: 8, None: 8, 4: 4}


def test_layouts_have_a_known_size(spark, cell, monkeypatch):
    """Rows made on the driver have none, so that the join with them dealt all cells by house, five times."""
    parsed = []
    monkeypatch.setattr(layouts.sheets, "parse_sheets", lambda cells: parsed.append(cells) or _stop())
    try:
        layouts.parse_period(_pages(spark, cell))
    except _Seen:
        pass
    assert "BroadcastHashJoin" in _plan(parsed[0]) and "SortMergeJoin" not in _plan(parsed[0])


def _stop():
    raise _Seen()


def test_disclosures_are_looked_for_where_the_words_stand(spark, cell):
    lines = [["Derivative  Disclosure - Alpha Fund"], ["DERIVATIVE DISCLOSURE for the period"], ["a) Hedging position through futures"],
             [None, 5, "plain"], ["hedge"], ["2) derivative\tdisclosure"]]
    rows = [("h", "2026-05", "f", f"S{i}", i, 0, [cell(v) for v in line]) for i, line in enumerate(lines)]
    found = derivatives.derivative_titles(spark.createDataFrame(rows, CELLS)).collect()
    assert {(r.sheet, r.title) for r in found} == {("S0", "Alpha Fund"), ("S1", None), ("S2", None), ("S5", None)}


def test_names_and_codes_without_patterns_are_as_with_them(spark):
    """Prechecks leave out patterns that cannot match."""
    texts = [" EQ - A  Bank **", "FUT–X 12-Jan-2026", "A B", "a\tb", "", None, "x - 5-May-26 ", "Plain^", "Instrument Name", "PARTICULARS", "company / issuer",
             "ISIN", "total", "INE040A01034", "ine040a01034", " INE002A01018 ", "INE040A01035", "INE040A01034\n", "US5949181045", "INE040A0103"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    one = F.trim(F.regexp_replace(t, r"\s+", " "))
    plain = F.regexp_replace(F.regexp_replace(one, fv.INSTRUMENT_PREFIX_PATTERN, ""), fv.EXPIRY_SUFFIX_PATTERN, "")
    rows = F.coalesce(t.rlike(fv.STRUCTURE_ROW_PATTERN) | t.rlike(fv.NAME_HEADER_PATTERN) | t.rlike(fv.ISIN_HEADER_PATTERN), F.lit(False))
    shape = F.coalesce(F.upper(F.trim(t)).rlike(fv.ISIN_PATTERN), F.lit(False))
    pairs = [(collapse(t), one), (clean_name(t), F.trim(F.regexp_replace(plain, fv.FOOTNOTE_TAIL_PATTERN, ""))),
             (sheets.is_structure_row(t), rows), (has_isin_shape(t), shape)]
    got = df.select(*[c.alias(f"c{i}") for i, p in enumerate(pairs) for c in [F.struct(p[0].alias("a"), p[1].alias("b"))]]).collect()
    assert all(x["a"] == x["b"] for r in got for x in r)
    valid = {r.t for r in df.filter(is_valid_isin(t)).collect()}
    assert valid == {"INE040A01034", "ine040a01034", " INE002A01018 ", "INE040A01034\n", "US5949181045"} or valid == {
        "INE040A01034", "ine040a01034", " INE002A01018 ", "US5949181045"}


def test_bounds_that_reach_the_floor():
    """Only these bounds are made; tables are made for all texts at once, also of characters outside the basic plane."""
    rnd = random.Random(6)
    texts = ["".join(rnd.choices("aabcd 12é\U0001d400", k=rnd.randrange(0, 30))) for _ in range(80)] + [""]
    asked = texts[:20] + ["zzz", "a" * 90, "", "\U0001d401b"]
    bounds = Bounds(texts)
    assert len(Bounds([]).table) == 0 and A.NEAR_FORMS >= 4096
    for text, whole, common in zip(asked, bounds.of(asked), bounds.common(asked), strict=True):
        at, bound = bounds.reaching(text, common, 0.7)
        assert whole.tolist() == [SequenceMatcher(None, text, t).quick_ratio() for t in texts]
        assert at.tolist() == [i for i, b in enumerate(whole) if b >= 0.7] and bound.tolist() == [b for b in whole if b >= 0.7]
