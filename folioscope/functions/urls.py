"""Document addresses and file names."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from folioscope import fixed_values as fv
from folioscope.functions.text import collapse

URL = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


@F.pandas_udf(StringType())
def absolute_url(base: pd.Series, href: pd.Series) -> pd.Series:
    """RFC 3986 resolution; no built-in resolves dot segments."""
    return pd.Series([h if h is None or not b else urljoin(b, h) for b, h in zip(base, href)], dtype="object")


def url_part(url: Column, group: int) -> Column:
    """1 scheme, 2 host, 3 path, 4 query, 5 fragment."""
    return F.regexp_extract(url, URL, group)


def decode(text: Column, plus_is_space: bool = False) -> Column:
    """Percent escapes to text; malformed text stays as it is."""
    safe = text if plus_is_space else F.regexp_replace(text, r"\+", "%2B")
    return F.coalesce(F.call_function("try_url_decode", safe), text)


def _encode(text: Column) -> Column:
    """Form encoding: only letters, digits and _.-~ stay."""
    return F.regexp_replace(F.regexp_replace(F.url_encode(text), "%7E", "~"), r"\*", "%2A")


def normalized_url(url: Column) -> Column:
    """Lower-case scheme and host, no fragment, noise parameters out, the rest sorted."""
    pairs = F.filter(F.split(url_part(url, 4), "&"), lambda p: p != "")

    def pair(p: Column) -> Column:
        key = decode(F.regexp_extract(p, r"^([^=]*)", 1), True)
        value = decode(F.regexp_extract(p, r"^[^=]*=(.*)$", 1), True)
        return F.struct(key.alias("k"), value.alias("v"))

    kept = F.array_sort(F.filter(F.transform(pairs, pair), lambda p: ~F.lower(p["k"]).isin(fv.NOISE_QUERY_KEYS)))
    query = F.array_join(F.transform(kept, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")
    scheme, host = F.lower(url_part(url, 1)), F.lower(url_part(url, 2))
    head = F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
                    F.when(host != "", F.concat(F.lit("//"), host)).otherwise(""))
    return F.concat(head, url_part(url, 3), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def base_name(url: Column) -> Column:
    """Decoded last path segment."""
    return decode(F.regexp_extract(url_part(url, 3), r"([^/]*)/?$", 1))


def safe_name(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(name, fv.UNSAFE_NAME_PATTERN, "_"), r"^[ .]+|[ .]+$", "")


def suffix_of(name: Column) -> Column:
    """Lower-case ending without the dot, '' when there is none."""
    return F.lower(F.regexp_extract(name, r".\.([^./]+)$", 1))


def destination_filename(filename: Column, url: Column, file_type: Column) -> Column:
    """Name a document is saved under: its own name, else the address's, made safe, with an ending."""
    own = F.when(F.coalesce(filename, F.lit("")) != "", filename)
    name = safe_name(F.coalesce(own, F.when(base_name(url) != "", base_name(url)), F.lit("portfolio")))
    kind = F.coalesce(file_type, F.lit(""))
    name = F.when((suffix_of(name) == "") & (kind != ""), F.concat(name, F.lit("."), kind)).otherwise(name)
    return F.when(name == "", F.lit("portfolio")).otherwise(name)


def identity_key(scheme: Column, period: Column, url: Column) -> Column:
    """Scheme and period when a scheme is known, else the normal form of the address."""
    named = F.concat(F.lit("scheme:"), period, F.lit(":"), F.lower(F.trim(scheme)))
    return F.when(F.coalesce(scheme, F.lit("")) != "", named).otherwise(
        F.concat(F.lit("url:"), normalized_url(url)))


def direct_url(url: Column) -> Column:
    """A download shim gives way to the address in its filepath parameter."""
    bare = F.trim(F.coalesce(url, F.lit("")))
    target = F.trim(decode(F.regexp_extract(bare, r"[?&]filepath=([^&#]*)", 1), True))
    shim = bare.contains("/investor/v1/dashboard/download-doc")
    return F.when(shim & target.rlike("^https?://"), target).otherwise(bare)


def is_workbook_url(url: Column, endings: str = "xls|xlsx") -> Column:
    return url.rlike(rf"(?i)\.(?:{endings})(?:[?#]|$)")


# --- spelling candidates ---------------------------------------------------------------

def fix_repeated_year_digit(url: Column) -> Column:
    """20188 -> 2018."""
    return F.regexp_replace(url, r"\b(20\d(\d))\2\b", "$1")


def swap_extension(url: Column) -> Column:
    """.xlsx <-> .xls, null for other endings."""
    return F.when(F.lower(url).endswith(".xlsx"), F.regexp_replace(url, r"(?i)\.xlsx$", ".xls")).when(
        F.lower(url).endswith(".xls"), F.regexp_replace(url, r"(?i)\.xls$", ".xlsx"))


def _months_as(form, name: Column) -> Column:
    for word in sorted((w for w in fv.MONTH_NUMBERS if w not in ("janaury", "febuary", "apirl")), key=len, reverse=True):
        name = F.regexp_replace(name, rf"(?i)(?<![A-Za-z]){word}(?![A-Za-z])", form(word))
    return name


def _respelled(name: Column, acronyms: tuple[str, ...]) -> Column:
    """Month case, acronym case and sep/sept spellings of one base name."""
    upper, title = name, name
    for word in acronyms:
        pattern = rf"(?i)(?<![A-Za-z]){word}(?![A-Za-z])"
        upper, title = F.regexp_replace(upper, pattern, word.upper()), F.regexp_replace(title, pattern, word.title())
    longer = F.regexp_replace(name, r"(?i)(?<![A-Za-z])(sep)(?![A-Za-z])", "$1t")
    shorter = F.regexp_replace(name, r"(?i)(?<![A-Za-z])(sep)t(?![A-Za-z])", "$1")
    return F.array(name, title, upper, _months_as(str.lower, name), _months_as(str.title, name),
                   _months_as(str.upper, name), longer, shorter)


def url_candidates(url: Column, endings: tuple[str, ...] = ("xlsb", "xlsx", "xls"),
                   acronyms: tuple[str, ...] = ("PSU", "ETF", "FOF", "ELSS")) -> Column:
    """Ordered distinct spellings of an address: as given, repaired year, case, '&' and ending variants."""
    name = base_name(url)
    folder = F.regexp_extract(url, r"^([^?#]*/)[^/?#]*", 1)
    stem, ending = F.regexp_extract(name, r"^(.*)\.[^.]*$", 1), F.regexp_extract(name, r"\.([^.]*)$", 1)
    bases = F.array(stem, F.lower(stem), F.initcap(stem))
    bases = F.concat(bases, F.transform(bases, lambda b: F.regexp_replace(b, "-&-", "-")))
    names = F.array_distinct(F.flatten(F.transform(F.array_distinct(bases), lambda b: _respelled(b, acronyms))))
    all_endings = F.array_distinct(F.concat(F.array(ending), F.array(*[F.lit(e) for e in endings])))

    def spelled(n: Column) -> Column:
        quoted = F.regexp_replace(_encode(n), r"\+", "%20")
        return F.transform(all_endings, lambda e: F.concat(folder, quoted, F.lit("."), e))

    return F.array_distinct(F.array_compact(F.concat(
        F.array(url, fix_repeated_year_digit(url), swap_extension(url)), F.flatten(F.transform(names, spelled)))))


def summary_kind(url: Column, label: Column) -> Column:
    """Kind of a consolidated workbook from its file name, else from its label."""
    name = F.lower(F.regexp_replace(base_name(url), r"(?i)\.[a-z0-9]+$", ""))
    name = F.regexp_replace(name, r"^[0-9a-f]{6,}-", "")
    text = F.when(name != "", name).otherwise(F.lower(label))
    slug = F.regexp_replace(F.regexp_replace(text, "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return (
        F.when(text.contains("equity") | text.contains("hybrid"), "equity_hybrid").when(text.contains("arbitrage"), "arbitrage")
        .when(text.contains("debt"), "debt").when(text.contains("index") | text.contains("etf"), "index_etf")
        .when(text.contains("fof") | text.contains("fundoffund"), "fof").when(slug != "", slug).otherwise("portfolio")
    )


def workbook_title(label: Column) -> Column:
    """Label without the date at its end."""
    dated = r"(?i)\s*[-,]?\s*(?:as\s+on\s+)?(?:\d{1,2}(?:st|nd|rd|th)?\s+)?" \
            r"(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s+\d{4}\s*$"
    bare = F.trim(F.regexp_replace(F.coalesce(label, F.lit("")), dated, ""))
    return F.when(bare != "", bare).when(F.trim(label) != "", F.trim(label)).otherwise("portfolio summary")


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def growth_free(name: Column) -> Column:
    """Scheme name without a trailing "- Growth"."""
    return collapse(F.regexp_replace(name, r"(?i)\s*-\s*growth\s*$", ""))
