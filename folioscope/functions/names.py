"""Security names and scheme names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions.text import collapse, contains_any


# --- securities -----------------------------------------------------------------

def has_expiry_suffix(raw: Column) -> Column:
    bare = F.regexp_replace(collapse(raw), fv.INSTRUMENT_PREFIX_PATTERN, "")
    return bare.rlike(fv.EXPIRY_SUFFIX_PATTERN)


def clean_name(raw: Column) -> Column:
    """Prefix, expiry stamp and trailing footnote marks removed. The first two have a dash."""
    text = collapse(raw)
    bare = F.regexp_replace(F.regexp_replace(text, fv.INSTRUMENT_PREFIX_PATTERN, ""), fv.EXPIRY_SUFFIX_PATTERN, "")
    bare = F.when(contains_any(text, ["-", "–"]), bare).otherwise(text)
    return F.trim(F.regexp_replace(bare, fv.FOOTNOTE_TAIL_PATTERN, ""))


def match_key(name: Column) -> Column:
    """Spellings of one company fold together."""
    folded = F.regexp_replace(F.upper(name), fv.COMPANY_SUFFIX_PATTERN, "LIMITED")
    return F.regexp_replace(folded, "[^A-Z0-9]+", "")


# --- schemes ----------------------------------------------------------------------

def words_of(name: Column) -> Column:
    bare = F.regexp_replace(name, r"\([^)]*\)", "")
    return F.filter(F.split(bare, "[^A-Za-z0-9&]+"), lambda w: w != "")


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split_class_suffix(name: Column) -> Column:
    """struct(base, suffix): the suffix is the longest trailing run of share-class words."""
    vocabulary = F.array(*[F.lit(w) for w in fv.SHARE_CLASS_WORDS])

    def own_words(words: Column) -> Column:
        """Number of words up to the last one that belongs to the fund's own name."""
        places = F.transform(words, lambda w, i: F.when(~F.array_contains(vocabulary, F.lower(w)), i + 1))
        return F.coalesce(F.array_max(places), F.lit(0))

    def parts(words: Column) -> Column:
        def cut(keep: Column) -> Column:
            base = F.when(keep == 0, words).otherwise(F.slice(words, F.lit(1), keep))
            suffix = F.when(keep == 0, F.slice(words, F.lit(1), F.lit(0))).otherwise(
                F.slice(words, keep + 1, F.size(words) - keep))
            return F.struct(F.array_join(base, " ").alias("base"), F.array_join(suffix, " ").alias("suffix"))

        return _let(own_words(words), cut)

    return _let(words_of(name), parts)


def base_scheme_name(name: Column) -> Column:
    return split_class_suffix(name)["base"]


def class_suffix(name: Column) -> Column:
    return split_class_suffix(name)["suffix"]


def is_single_class(name: Column) -> Column:
    """No share-class word at the end at all."""
    return class_suffix(name) == ""


def is_regular_growth(name: Column) -> Column:
    """Regular plan and growth option, judged on the suffix only."""
    def test(suffix: Column) -> Column:
        other_option = ~suffix.rlike(r"(?i)\bgrowth\b") & suffix.rlike(fv.ANY_OPTION_PATTERN)
        regular = suffix.rlike(r"(?i)\bregular\b")
        other_plan = suffix.rlike(r"(?i)\bdirect\b") | suffix.rlike(fv.OTHER_PLAN_PATTERN)
        return (suffix != "") & ~suffix.rlike(fv.EXCLUDED_OPTION_PATTERN) & ~other_option & (regular | ~other_plan)

    return _let(class_suffix(name), test)


REPORT_PERIOD = (
    r"(?i)\s+((for\s+the\s+period\s+ended|for|as\s+on|as\s+of)\s+)?("
    + fv.MONTH_WORD_PATTERN
    + r")\s*[\-,]?\s*(\d{1,2}\s*,\s*)?\d{4}\s*$"
)


def scheme_key(name: Column) -> Column:
    """Join key of a scheme name: internal code and report stamp off, upper case, words only."""
    bare = F.regexp_replace(name, fv.LEADING_CODE_PATTERN, "")
    dated_for_good = contains_any(F.lower(bare), fv.FIXED_MATURITY_SERIES)
    bare = F.when(dated_for_good, bare).otherwise(F.regexp_replace(bare, REPORT_PERIOD, ""))
    return F.trim(F.regexp_replace(F.upper(bare), "[^A-Z0-9]+", " "))


def house_key(name: Column) -> Column:
    """Comparable form of a house or folder name."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]", ""), "mutualfund", "")


def digit_runs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1))


def digits_compatible(target: Column, candidate: Column) -> Column:
    """Every number of the target occurs in the candidate."""
    return F.size(F.array_except(digit_runs(target), digit_runs(candidate))) == 0


# --- mapping audit ----------------------------------------------------------------------

def comparable_name(name: Column) -> Column:
    """Blurb cut, letters and digits apart, words only."""
    s = F.regexp_replace(F.upper(name), "&", " AND ")
    s = F.regexp_replace(s, fv.BLURB_PATTERN, "")
    s = F.regexp_replace(s, r"(?<=[A-Z])(?=\d)|(?<=\d)(?=[A-Z])", " ")
    return F.trim(F.regexp_replace(s, "[^A-Z0-9]+", " "))


def name_tokens(name: Column) -> Column:
    """Sorted distinct significant words."""
    filler = F.array(*[F.lit(w) for w in fv.COMPARE_FILLER_WORDS], F.lit(""))
    return F.array_sort(F.array_except(F.split(comparable_name(name), " "), filler))
