import random
import re

from pyspark.sql import functions as F

from folioscope.operators import derivatives as D

TITLES = "amc string, period string, source_file string, sheet string, sheet_idx int, title string"
NAMES = "amc string, period string, source_file string, sheet_idx int, part int, row_idx bigint, scheme_name_raw string"


def form(name):
    return re.sub("[^A-Z0-9]+", " ", name.upper()).strip(" ")


def by_rule(title, names):
    """The rule of ``resolve_scheme_alias`` over all names of a workbook: sheets are (file, sheet, sheet_idx, title)."""
    file, _, idx, text = title
    book = [n for n in names if n[0] == file]
    heard = [n for n in book if n[1] is None or (idx is not None and n[1] <= idx)]
    if book and not heard:
        return None
    place = lambda n: (-1 if n[1] is None else n[1], 0, n[2])
    if text is None:
        return max(heard, key=place)[3] if heard else None
    fits = [n for n in heard if form(n[3]) and (form(n[3]) in form(text) or form(text) in form(n[3]))]
    return min(fits, key=lambda n: (n[1] != idx or idx is None, place(n)))[3] if fits else text


def test_aliases_equal_the_rule_over_all_names(spark):
    rnd = random.Random(5)
    words = ["Scheme", "Large", "Cap", "Mid", "Fund", "Debt", "(An open ended scheme)"]
    text = lambda: " ".join(rnd.choices(words, k=rnd.randrange(1, 4)) + [str(rnd.randrange(12))][: rnd.randrange(2)])
    titles, names, at = [], [], 0
    for file in "abc":
        titles += [(file, f"S{i}", i, rnd.choice([None, "***", "A", text(), text(), text()])) for i in range(40)] + [(file, "T", None, text())]
        for i in [*range(3, 40), *([None] * 4 if file == "b" else [])]:
            names += [(file, i, (at := at + 1), rnd.choice(["--", "ap", text(), text()])) for _ in range(rnd.randrange(3))]
    titles.append(("d", "S0", 0, "Alone"))
    got = D.resolve_scheme_alias(
        spark.createDataFrame([("h", "2026-05", *t) for t in titles], TITLES),
        spark.createDataFrame([("h", "2026-05", f, i, 0, at, n) for f, i, at, n in names], NAMES)).collect()
    wanted = {(t[0], t[1]): by_rule(t, names) for t in titles}
    assert len(got) == len({(r.source_file, r.sheet) for r in got})
    assert {(r.source_file, r.sheet): r.scheme_name_raw for r in got} == {k: v for k, v in wanted.items() if v is not None}


def test_names_of_a_workbook_do_not_meet_all_its_titles(spark, monkeypatch):
    """One workbook of many sheets whose names differ in a number: pairs that are compared grow with the sheets, not their square."""
    n = 300
    titles = spark.range(n).select(F.lit("h").alias("amc"), F.concat(F.lit("SCHEME "), F.col("id") + 1000, F.lit(" FUND")).alias("t"))
    names = spark.range(n).select(F.lit("h").alias("amc"), F.concat(F.lit("SCHEME "), F.col("id") + 1000, F.lit(" FUND OPEN ENDED")).alias("k"))
    met = spark.sparkContext.accumulator(0)
    compared = F.udf(lambda a, b: met.add(1) or b in a, "boolean")
    monkeypatch.setattr(D, "holds", lambda big, small: compared(F.col(big), F.col(small)))
    assert D.contained_names(titles, names, ["amc"]).count() == n
    assert n <= met.value <= 8 * n
