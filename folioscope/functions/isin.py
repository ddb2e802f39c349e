"""Security codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope import fixed_values as fv


def _bare(code: Column) -> Column:
    return F.upper(F.trim(code))


def has_isin_shape(code: Column) -> Column:
    """Two letters, nine letters or digits, one digit; a line end may follow."""
    return F.coalesce(F.length(F.trim(code)).between(12, 14) & _bare(code).rlike(fv.ISIN_PATTERN), F.lit(False))


def check_digits(code: Column) -> Column:
    """The digit string the check runs over: letters count 10..35."""
    letters = F.transform(
        F.split(_bare(code), ""),
        lambda c: F.when(c.between("A", "Z"), (F.ascii(c) - 55).cast("string")).otherwise(c),
    )
    return F.array_join(letters, "")


def is_valid_isin(code: Column) -> Column:
    """Shape plus ISO 6166 check digit."""
    checked = F.when(has_isin_shape(code), F.call_function("luhn_check", check_digits(code)))
    return F.coalesce(checked, F.lit(False))


def is_contract_code(code: Column) -> Column:
    """Ticker followed by an expiry date; such codes can pass the check digit by chance."""
    bare = _bare(code)
    hit = bare.rlike(fv.CONTRACT_CODE_PATTERN) & ~bare.startswith(fv.CONTRACT_CODE_EXCLUDED_PREFIX)
    return F.coalesce(hit, F.lit(False))


def type_key(code: Column) -> Column:
    """Country and type prefix plus the two digits at offset 7."""
    return F.when(F.length(code) >= 9, F.concat(F.substring(code, 1, 3), F.substring(code, 8, 2)))


def issuer_prefix(code: Column) -> Column:
    """First seven characters: the issuer."""
    return F.when(F.length(code) >= 7, F.substring(code, 1, 7))
