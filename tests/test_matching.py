from folioscope.contracts import LOOKUPS
from folioscope.operators import coverage as A
from folioscope.operators import mapping_audit as M
from folioscope.operators import reconcile as R
from folioscope.operators import schemes as S


def test_match_scheme_gates_on_numbers_and_scores(spark):
    cands = S.build_candidates(spark.createDataFrame([
        ("h", "1", "Alpha FMP Series 194 - Regular Plan - Growth", 0), ("h", "2", "Alpha FMP Series 294 - Regular Plan - Growth", 1),
        ("h", "3", "Beta Savings Fund - Direct Plan - Growth", 2), ("h", "4", "Beta Savings Fund - Regular Plan - Growth", 3),
        ("h", "5", "Beta Savings Fund - Growth", 4)], "house string, code string, name string, ordinal long"))
    names = spark.createDataFrame([("h", "Alpha FMP - Series 294"), ("h", "Beta Saving Fund"), ("h", "Beta Savings Fund"), ("h", "Gamma 7 Fund")],
                                  "house string, scheme_name_raw string")
    got = {r.scheme_name_raw: r for r in S.match_scheme(names, cands).collect()}
    assert got["Alpha FMP - Series 294"].amfi_code == "2" and got["Alpha FMP - Series 294"].score == 1.0
    assert got["Beta Saving Fund"].amfi_code == "4" and 0.9 < got["Beta Saving Fund"].score < 1
    assert got["Beta Savings Fund"].amfi_code == "4" and got["Gamma 7 Fund"].score == 0.0


def test_mapping_audit(spark):
    mapping = spark.createDataFrame([
        ("a", "NIFTY 50 INDEX", "s", "1", "Nifty 50 Index Fund", 1.0), ("a", "NIFTY 500 INDEX", "s", "1", "Nifty 50 Index Fund", 1.0),
        ("a", "LIQUID", "s", "", "", 1.0), ("a", "OLD", "s", "9", "x", 1.0), ("a", "OVERNIGHT", "s", "2", "was", 1.0),
        ("a", "OVERNIGHT FUND", "s", "2", "Overnight Fund", 1.0)], LOOKUPS["schemes"])
    codes = spark.createDataFrame([("1", "Nifty 50 Index Fund"), ("2", "Overnight Fund"), ("3", "Liquid Fund"), ("5", "Nifty 500 Index Fund")],
                                  LOOKUPS["amfi_codes"])
    issues = M.audit_mapping(mapping, codes).cache()
    got = {(r.kind, r.match_key) for r in issues.collect()}
    assert got == {("wrong_scheme", "NIFTY 500 INDEX"), ("missing_code", "LIQUID"), ("not_in_icra", "OLD"), ("stale_name", "OVERNIGHT"),
                   ("duplicate_code", "NIFTY 50 INDEX"), ("duplicate_code", "NIFTY 500 INDEX")}
    fixed = {r.match_key: (r.amfi_code, r.fund_name) for r in M.apply_fixes(mapping, issues).collect()}
    assert fixed["NIFTY 500 INDEX"] == ("5", "Nifty 500 Index Fund") and fixed["LIQUID"][0] == "3"
    assert fixed["OVERNIGHT"] == ("2", "Overnight Fund") and fixed["NIFTY 50 INDEX"][0] == "1"


def test_duplicate_codes_equal_all_pairs(spark):
    """Codes whose names are all near the shortest one are compared in tiles; numbers that contradict each other decide."""
    import itertools
    import random

    from pyspark.sql import functions as F

    from folioscope.functions.similarity import name_similarity

    rnd = random.Random(2)
    words = ["NIFTY", "50", "500", "INDEX", "FUND", "NEXT", "LIQUID", "SERIES", "194", "294"]
    rows = [("h", str(c), " ".join(rnd.sample(words[: 5 + c % 6], rnd.randrange(1, 5)))) for c in range(40) for _ in range(2 + c % 4)]
    df = spark.createDataFrame(rows, "amc string, amfi_code string, match_key string")
    pairs = {(c, *p) for c in {r[1] for r in rows} for p in itertools.permutations(sorted({r[2] for r in rows if r[1] == c}), 2)}
    scored = spark.createDataFrame(list(pairs), "code string, a string, b string").select("code", name_similarity(F.col("a"), F.col("b")).alias("s"))
    bad = {r.code for r in scored.groupBy("code").agg(F.min("s").alias("s")).collect() if r.s < 0.9}
    assert {r.amfi_code for r in M.duplicate_codes(df).collect()} == bad and 5 < len(bad) < 40


def test_tiered_match(spark):
    portfolio = spark.createDataFrame([("100001", "Demo Large Cap Fund"), ("100002", "Demo Small Cap Fund"), ("", "Demo Twin Fund"),
                                       ("100004", "Demo Twin (Fund)")], "amfi_code string, fund_name string")
    master = spark.createDataFrame([
        ("100001", "Demo Large Cap Fund - Direct - Growth", "Demo Mutual Fund"), ("100002", "Demo Small Cap Fund - Direct - Growth", "Demo Mutual Fund"),
        ("", "Demo Twin Fund - Growth", "Demo Mutual Fund")], "amfi_code string, scheme_name string, mf_name string")
    universe = A.build_universe(portfolio, master)
    texts = [("u1", "Demo Large Cap Fund (An open ended scheme)"), ("u2", "Fund Demo Cap Small"), ("u3", "Demo Twin Fund"), ("u4", "nothing like it"),
             ("u5", "Something else Fund"), ("u6", "Large Cap Fund")]
    units = spark.createDataFrame([(u, "Demo Mutual Fund", "100002" if u == "u5" else None) for u, _ in texts],
                                  "unit_id string, scope string, printed_code string")
    rows = spark.createDataFrame([(u, t, "sheet:x:row0", 100, False) for u, t in texts],
                                 "unit_id string, raw string, source string, ord int, need_word boolean")
    keys = A.build_candidates(rows).join(units.select("unit_id", "scope"), "unit_id")
    got = {r.unit_id: (r.status, r.method, r.fund_name) for r in A.match_units(units, keys, universe).collect()}
    assert got["u1"] == ("matched", "icra_name_exact", "Demo Large Cap Fund") or got["u1"][1] == "icra_name_reduced"
    assert got["u2"] == ("matched", "token_set_equal", "Demo Small Cap Fund")
    assert got["u3"][0] == "ambiguous" and got["u4"][0] == "unmatched"
    assert got["u5"] == ("matched", "amfi_code", "Demo Small Cap Fund")
    assert got["u6"] == ("matched", "amc_prefix_alias", "Demo Large Cap Fund")


def test_alias_candidates_are_greedy_one_to_one(spark):
    schema = "amfi_code string, isin string, quantity double, mkt_value double, row_id long"
    ours = spark.createDataFrame([("s", "A1", 10.0, 100.0, 1), ("s", "A2", 10.0, 100.05, 2), ("s", "B", 5.0, 9.0, 3), ("s", "SAME", 1.0, 1.0, 4)], schema)
    ref = spark.createDataFrame([("s", "R1", 10.0, 100.02, 1), ("s", "R2", 10.0, 100.0, 2), ("s", "R3", 5.0, 9.5, 3), ("s", "SAME", 1.0, 1.0, 4)], schema)
    got = {(r.isin_in_amc_file, r.isin_in_icra) for r in R.alias_candidates(ours, ref).collect()}
    assert got == {("A1", "R1"), ("A2", "R2")}


def plain_walk(ours, ref):
    """Rows of one scheme in order take the first unused close code."""
    def close(a, b):
        return (a == 0 and b == 0) or abs(a - b) / max(abs(a), abs(b), 1e-9) <= 0.001

    used, out = set(), set()
    for _, isin, q, v, _ in sorted(ours, key=lambda r: (r[4], r[1])):
        for _, other, rq, rv, _ in sorted(ref, key=lambda r: (r[4], r[1])):
            if other not in used and close(q, rq) and close(v, rv):
                used.add(other)
                out.add((isin, other, rv))
                break
    return out


ALIAS = "amfi_code string, isin string, quantity double, mkt_value double, row_id long"


def found_aliases(spark, ours, ref, **options):
    got = R.alias_candidates(spark.createDataFrame(ours, ALIAS), spark.createDataFrame(ref, ALIAS), **options).collect()
    return {s: {(r.isin_in_amc_file, r.isin_in_icra, r.mkt_value_icra) for r in got if r.amfi_code == s} for s in {r[0] for r in ours}}


def test_alias_candidates_against_one_plain_walk(spark):
    """Copies, long chains, shared codes and negative values in a hot scheme and small ones: rounds equal one walk per scheme."""
    import random

    rnd = random.Random(5)
    ours, ref = [], []
    for i in range(420):
        scheme = "hot" if i < 300 else f"s{i % 5}"
        q, v = rnd.choice([5.0, 7.0, 0.0]), rnd.choice([100.0, 100.05, 100.12, 100.2, -40.0, -40.02, 900.0])
        ours.append((scheme, f"O{i}", q, v, i))
        if rnd.random() < 0.8:
            ref.append((scheme, f"R{i if rnd.random() < 0.9 else i // 20}", q, v * rnd.choice([1.0, 1.0004, 0.9993]), i))
    got = found_aliases(spark, ours, ref)
    for scheme in got:
        assert got[scheme] == plain_walk([r for r in ours if r[0] == scheme], [r for r in ref if r[0] == scheme])


def test_later_rows_give_way(spark):
    """Families above the bound: copies settle by place, and codes wanted by an earlier row of another value are given up."""
    ours = [("s", f"O{i}", 1.0, 100.0 + 0.09 * (5 - i % 6), i) for i in range(18)]
    ref = [("s", f"R{i}", 1.0, 100.0 + 0.09 * (i % 6), i) for i in range(14)]
    assert found_aliases(spark, ours, ref, walk_rows=0)["s"] == plain_walk(ours, ref)


def test_alias_candidates_carry_names(spark):
    schema = ALIAS + ", amc string, fund_name string, security_name string"
    ours = spark.createDataFrame([("s", "A", 1.0, 5.0, 1, "h", "Our Fund", "Paper"), ("s", "B", 2.0, 6.0, 2, "h", "Our Fund", "")], schema)
    ref = spark.createDataFrame([("s", "X", 1.0, 5.0, 1, "h", "Ref Fund", "x"), ("s", "Y", 2.0, 6.0, 2, "h", "Ref Fund", "y")], schema)
    got = {tuple(r) for r in R.alias_candidates(ours, ref).collect()}
    assert got == {("h", "s", "Our Fund", "A", "X", "Paper", 1.0, 5.0, 5.0), ("h", "s", "Our Fund", "B", "Y", "Ref Fund", 2.0, 6.0, 6.0)}


def test_near_misses_against_all_pairs(spark):
    from difflib import SequenceMatcher

    names = ["Demo Banking and Financial Services Fund", "Demo Banking and PSU Fund", "Demo Quality Index Fund", "Demo Quality Fund",
             "Demo Midcap Opportunities Fund", "Demo Smallcap Opportunities Fund"]
    portfolio = spark.createDataFrame([("", n) for n in names], "amfi_code string, fund_name string")
    master = spark.createDataFrame([("", n, "Demo Mutual Fund") for n in names], "amfi_code string, scheme_name string, mf_name string")
    universe = A.build_universe(portfolio, master)
    texts = [("u1", "Demo Banking & Fin Serv Scheme"), ("u2", "Demo Qlty Indx Fund"), ("u3", "Demo Mid Cap Oportunity Fund"), ("u4", "Entirely other words")]
    units = spark.createDataFrame([(u, "Demo Mutual Fund") for u, _ in texts], "unit_id string, scope string")
    rows = spark.createDataFrame([(u, t, "s", 100, False) for u, t in texts], "unit_id string, raw string, source string, ord int, need_word boolean")
    keys = A.build_candidates(rows).join(units, "unit_id")
    spell = {"fin serv": "financial services", "qlty": "quality", "indx": "index"}
    want = {}
    for r in keys.collect():
        if len(r.key) < 10 or len(r.key.split()) < 2:
            continue
        form = r.key
        for short, long in spell.items():
            form = form.replace(short, long)
        for n in names:
            score = SequenceMatcher(None, form.replace(" ", ""), n.lower().replace(" ", "")).ratio()
            if score >= 0.70:
                want[(r.unit_id, n)] = max(score, want.get((r.unit_id, n), 0.0))
    top = set()
    for unit in {u for u, _ in want}:
        mine = sorted(((-s, n) for (u, n), s in want.items() if u == unit))[:3]
        top |= {(unit, n, round(-s, 9)) for s, n in mine}
    got = {(r.unit_id, r.fund_name, round(r.score, 9)) for r in A.near_misses(units, keys, universe).collect()}
    assert got == top and {u for u, _, _ in got} == {"u1", "u2", "u3"}


def test_plans_have_no_cross_join_and_prune(spark):
    from folioscope.plans import holdings_queries as Q

    plan = Q.scheme_month_report(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    read = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert read and all("l_comment" not in line and "l_tax" not in line for line in read)
    first = Q.table(spark, "/root/testdata/sf0.001", "lineitem")
    from folioscope.scale import first_rows

    ranked = first_rows(first, ["l_suppkey"], ["l_orderkey"])._jdf.queryExecution().executedPlan().toString()
    assert ranked.count("WindowGroupLimit") == 2
