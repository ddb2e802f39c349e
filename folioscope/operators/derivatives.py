"""Futures positions from the derivative disclosure, which has no code column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions.text import cell_number, cell_text, collapse, contains_any
from folioscope.operators.sheets import FILE, SHEET, SHEET_KEYS, first_match, first_where, texts, usable_cell
from folioscope.scale import exploded, null_safe_join, ordered_scan, settle

GRAM = 8  # characters of the grams that names of a workbook are compared by
NO_SHEET = -(1 << 40)  # place of rows without a sheet number: before all sheets


def derivative_titles(cells: DataFrame) -> DataFrame:
    """Sheets with a disclosure and its printed title (null when the heading names no scheme)."""
    def title(t: Column) -> Column:
        hit = F.trim(F.regexp_extract(t, fv.DERIVATIVE_TITLE_PATTERN, 1))
        return F.when(hit != "", hit)

    t = texts()
    named = first_where(F.transform(t, title), lambda x: x.isNotNull())
    unnamed = F.exists(t, lambda x: x.rlike(fv.DERIVATIVE_UNTITLED_PATTERN) | x.rlike(fv.FUTURES_HEADING_PATTERN))
    said = F.exists("cells", lambda c: F.coalesce(contains_any(F.lower(c["s"]), fv.DISCLOSURE_WORDS), F.lit(False)))
    rows = cells.filter(said).select(*SHEET, "row_idx", named.alias("named"), unnamed.alias("unnamed"))
    first = F.min(F.when(F.col("named").isNotNull(), F.struct("row_idx", "named")))["named"]
    return rows.filter("named is not null or unnamed").groupBy(*SHEET).agg(first.alias("title"))


def name_form(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.upper(name), "[^A-Z0-9]+", " "))


def resolve_scheme_alias(titles: DataFrame, holdings: DataFrame) -> DataFrame:
    """The workbook's own wording for a disclosure's scheme.

    Schemes of the same sheet come first, then those of earlier sheets, each in row order; the
    first one equal to the title or containing it (or contained) wins. Without a title the last
    scheme seen is taken; a sheet with neither yields nothing. Each distinct title of a workbook meets
    only the names that may contain it or be contained: both share the smaller text's rarest gram.
    """
    place, own = F.struct("sheet_idx", "part", "row_idx"), [*SHEET, "title"]
    known = settle(holdings.groupBy(*FILE, F.col("sheet_idx").alias("k_sheet"), "scheme_name_raw").agg(
        F.min(place).alias("k_first"), F.max(place).alias("k_last")))
    number = F.coalesce("k_sheet", F.lit(NO_SHEET))
    books = known.groupBy(*FILE).agg(F.min(number).alias("k_from"))
    heard = F.col("k_from").isNull() | (F.col("k_from") == NO_SHEET) | (F.col("k_from") <= F.col("sheet_idx"))
    wanted = settle(titles.join(books, FILE, "left").filter(heard).select(*own, name_form(F.col("title")).alias("t")))
    names = known.withColumn("k", name_form(F.col("scheme_name_raw"))).filter("k <> ''")

    t, k = F.col("t"), F.col("k")
    here = names.withColumnRenamed("k_sheet", "sheet_idx").join(wanted, [*FILE, "sheet_idx"]).filter(t.contains(k) | k.contains(t))
    here = here.groupBy(*own).agg(F.min_by("scheme_name_raw", "k_first").alias("here"))
    asked = null_safe_join(wanted.filter("t is not null"), here, own, "left_anti")
    first = names.groupBy(*FILE, "k").agg(F.min_by(F.struct("scheme_name_raw", "k_first", "k_sheet"), "k_first").alias("f"))
    blank = first.groupBy(*FILE).agg(F.min_by("k", "f.k_first").alias("k")).withColumn("t", F.lit(""))  # any name contains it
    fits = contained_names(asked.select(*FILE, "t"), first.select(*FILE, "k"), FILE).unionByName(blank.select(*FILE, "t", "k"))
    before = asked.join(fits, [*FILE, "t"]).join(first, [*FILE, "k"]).filter(
        F.col("f.k_sheet").isNull() | (F.col("f.k_sheet") <= F.col("sheet_idx")))
    before = before.groupBy(*own).agg(F.min_by("f.scheme_name_raw", "f.k_first").alias("before"))
    named = null_safe_join(null_safe_join(wanted.filter("title is not null").select(*own), here, own), before, own).select(
        *SHEET, F.coalesce("here", "before", "title").alias("scheme_name_raw"))

    sheets = known.groupBy(*FILE, number.alias("at")).agg(F.max_by(F.struct("scheme_name_raw"), "k_last").alias("latest"))
    untitled = wanted.filter("title is null").select(*SHEET, F.coalesce("sheet_idx", F.lit(NO_SHEET)).alias("at"), F.lit(1).alias("asks"))
    line = untitled.unionByName(sheets.withColumn("asks", F.lit(0)), allowMissingColumns=True)
    line = ordered_scan(line, FILE, ["at", "asks", "sheet"], F.shiftright("at", 12), lasts={"seen": F.col("latest")})
    last = line.filter("asks = 1").select(*SHEET, F.col("seen.scheme_name_raw").alias("scheme_name_raw"))
    return named.unionByName(last).filter("scheme_name_raw is not null")


def holds(big: str, small: str) -> Column:
    return F.col(big).contains(F.col(small))


def contained_names(titles: DataFrame, names: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, t, k): distinct pairs of a title and a name of one key of which one contains the other.

    A text that another one contains hands over all its grams, also the one that the fewest texts of the key have.
    The smaller text is looked up under that gram alone, so names that differ in a number meet few others; texts
    shorter than a gram are grams of their length.
    """
    titles = titles.distinct()
    names = names.join(titles.select(*keys).distinct(), keys, "left_semi").distinct()
    texts = titles.select(*keys, F.col("t").alias("x")).unionByName(names.select(*keys, F.col("k").alias("x"))).distinct()
    short = texts.filter(F.length("x").between(1, GRAM - 1))
    lengths = short.groupBy(*keys).agg(F.collect_set(F.length("x")).alias("sizes"))  # at most GRAM - 1 numbers
    grams = exploded(texts.join(lengths, keys, "left"), F.array_distinct(F.concat(
        _grams("x", F.lit(GRAM)), F.flatten(F.transform(F.coalesce("sizes", F.array().cast("array<int>")), lambda n: _grams("x", n))))), "g")
    grams = grams.select(*keys, "x", "g")
    shared = grams.groupBy(*keys, "g").agg(F.count(F.lit(1)).alias("n"))
    own = grams.filter((F.length("g") == GRAM) | (F.length("x") == F.length("g"))).join(shared, [*keys, "g"])
    rarest = own.groupBy(*keys, F.col("x").alias("small")).agg(F.min_by("g", F.struct("n", "g")).alias("g"))

    def inside(small: DataFrame, s: str, big: DataFrame, b: str) -> DataFrame:
        looked = rarest.join(small.withColumnRenamed(s, "small"), [*keys, "small"], "left_semi")
        around = grams.join(big.withColumnRenamed(b, "x"), [*keys, "x"], "left_semi")
        return looked.join(around, [*keys, "g"]).filter(holds("x", "small")).select(
            *keys, F.col("small").alias(s), F.col("x").alias(b))

    return inside(names, "k", titles, "t").unionByName(inside(titles, "t", names, "k")).select(*keys, "t", "k").distinct()


def _grams(text: str, size: Column) -> Column:
    """Every run of ``size`` characters of a text; none if it is shorter."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    return F.when(F.length(text) >= size, F.transform(starts, lambda i: F.substring(F.col(text), i, size))).otherwise(
        F.array().cast("array<string>"))


def futures_rows(cells: DataFrame) -> DataFrame:
    """Typed positions inside the "hedging through futures" sections (H21, H22, H23)."""
    rows = cells.withColumn("texts", texts())
    joined = F.array_join(F.filter("texts", lambda t: t != ""), " ")
    futures = joined.rlike(fv.FUTURES_HEADING_PATTERN)
    event = F.when(futures, 1).when(joined.rlike(fv.LETTERED_HEADING_PATTERN), 0)
    upto = Window.partitionBy(*SHEET_KEYS).orderBy("row_idx").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"event": event, "opens": F.coalesce(futures, F.lit(False)).cast("int")})
    rows = rows.withColumns({
        "open": F.last("event", ignorenulls=True).over(upto), "section_no": F.sum("opens").over(upto),
    }).filter("open = 1 and event is null")

    def at(test, *taken: Column) -> Column:
        def free(i: Column) -> Column:
            ok = i.isNotNull()
            for t in taken:
                ok = ok & ~i.eqNullSafe(t)
            return ok

        return first_where(F.transform("texts", lambda t, i: F.when(test(t), i)), free)

    underlying = first_match(F.col("texts"), lambda t: t.rlike(fv.UNDERLYING_HEADER_PATTERN))
    quantity = first_match(F.col("texts"), lambda t: t.rlike(fv.DERIVATIVE_QUANTITY_PATTERN))
    sided = first_match(F.col("texts"), lambda t: t.rlike(fv.LONG_SHORT_PATTERN))
    is_head = underlying.isNotNull() & (quantity.isNotNull() | sided.isNotNull())
    value = at(lambda t: t.rlike(fv.DERIVATIVE_VALUE_PATTERN), underlying, quantity, sided)
    pct = at(lambda t: t.rlike(fv.DERIVATIVE_PERCENT_PATTERN), underlying, quantity, sided, value)
    industry = at(lambda t: F.lower(t).startswith("industry"))
    columns = F.struct(
        underlying.alias("name_col"), F.coalesce(quantity, sided).alias("qty_col"), value.alias("mkt_col"),
        pct.alias("pct_col"), industry.alias("industry_col"), F.col("row_idx").alias("head_row"))
    in_section = Window.partitionBy(*SHEET_KEYS, "section_no").orderBy("row_idx").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("head", F.when(is_head, columns))
    rows = rows.withColumn("head", F.first("head", ignorenulls=True).over(in_section))
    rows = rows.filter(F.col("row_idx") > F.col("head.head_row")).select("*", "head.*")
    rows = rows.withColumns({
        "security_name": collapse(cell_text(usable_cell("name_col"))), "quantity": usable_cell("qty_col"),
        "market_value_raw": usable_cell("mkt_col"), "pct_raw": usable_cell("pct_col"),
        "industry_raw": collapse(cell_text(usable_cell("industry_col"))),
    })
    return rows.filter(
        (F.col("security_name") != "") & F.col("quantity.n").isNotNull() & F.col("market_value_raw.n").isNotNull()
    ).select(*SHEET, "row_idx", "security_name", "industry_raw", "quantity", "market_value_raw", "pct_raw")


def derivative_holdings(cells: DataFrame, holdings: DataFrame) -> DataFrame:
    """Futures rows plus one offset row per sheet, without positions the workbook already has.

    Titles' schemes and the rows found are settled: legs, offsets and the positions seen read them.
    """
    schemes = settle(resolve_scheme_alias(derivative_titles(cells), holdings))
    disclosed = cells.join(schemes.select(*SHEET_KEYS).distinct(), SHEET_KEYS, "left_semi")
    found = settle(futures_rows(disclosed).join(schemes, SHEET, "inner"))
    none = F.lit(None)
    cell_type = "struct<s:string,n:double>"
    legs = found.select(
        *SHEET, F.lit(1).alias("part"), "row_idx", "scheme_name_raw", F.lit("Futures").alias("section_header"),
        "security_name", none.cast("string").alias("isin"), "industry_raw", "quantity", "market_value_raw", "pct_raw")
    offsets = found.groupBy(*SHEET, "scheme_name_raw").agg((-F.sum("market_value_raw.n")).alias("v")).select(
        *SHEET, F.lit(2).alias("part"), F.lit(0).alias("row_idx"), "scheme_name_raw",
        none.cast("string").alias("section_header"), F.lit(fv.EXPOSURE_ADJUSTMENT_NAME).alias("security_name"),
        none.cast("string").alias("isin"), none.cast("string").alias("industry_raw"),
        none.cast(cell_type).alias("quantity"),
        F.struct(none.cast("string").alias("s"), F.col("v").alias("n")).alias("market_value_raw"),
        none.cast(cell_type).alias("pct_raw"))
    return drop_seen_positions(legs.unionByName(offsets), holdings)


def drop_seen_positions(derivatives: DataFrame, holdings: DataFrame) -> DataFrame:
    """Leave out positions whose (scheme, quantity, value) came earlier in the same workbook."""
    def key(df: DataFrame) -> DataFrame:
        return df.withColumns({"q_": cell_number(F.col("quantity")), "v_": cell_number(F.col("market_value_raw"))})

    spot = [*FILE, "scheme_name_raw", "q_", "v_"]
    mine = key(derivatives)
    first_seen = (
        key(holdings).select(*spot, (F.col("sheet_idx") * 2).alias("at"))
        .unionByName(mine.select(*spot, (F.col("sheet_idx") * 2 + 1).alias("at")))
        .groupBy(*spot).agg(F.min("at").alias("first_at"))
    )
    right = first_seen.select(*[F.col(c).alias(f"r_{c}") for c in spot], "first_at")
    same = None
    for c in spot:
        part = mine[c].eqNullSafe(right[f"r_{c}"])
        same = part if same is None else same & part
    joined = mine.join(right, same & (right["first_at"] < mine["sheet_idx"] * 2 + 1), "left_anti")
    return joined.select(*derivatives.columns)
