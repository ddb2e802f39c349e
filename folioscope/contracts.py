"""Table contracts: the StructTypes every operator reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

CELL = T.StructType([T.StructField("s", T.StringType()), T.StructField("n", T.DoubleType())])


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


S, L, D, I, B = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType(), T.BooleanType()

CELLS = _struct(
    ("amc", S), ("period", S), ("source_file", S), ("sheet", S), ("sheet_idx", I), ("row_idx", I),
    ("cells", T.ArrayType(CELL)),
)
HOLDINGS_RAW = _struct(
    ("amc", S), ("period", S), ("source_file", S), ("sheet", S), ("scheme_name_raw", S),
    ("section_header", S), ("security_name", S), ("isin", S), ("industry_raw", S),
    ("quantity", CELL), ("market_value_raw", CELL), ("pct_raw", CELL), ("port_date", T.DateType()),
    ("ord", L),
)
INTERMEDIATE_FIELDS = [
    "amc", "source_file", "sheet", "scheme_name_raw", "section_header", "security_name", "isin",
    "industry_raw", "quantity", "market_value_raw", "pct_raw", "port_date",
]
FINAL_FIELDS = [
    "AMFI Code", "Port_Date", "ISIN", "Instrument_Name", "Nature_Name", "Basic_Industry", "Industry",
    "Sector_Name", "Macro_Economic_Sector", "Corpus_Per", "Mkt_Value", "No_Of_Shares", "Fund_Name",
    "Security_Name",
]
AUDIT_FIELDS = ["Name_Source"]
UNRESOLVED_FIELDS = [
    "reason", "amc", "scheme_name_raw", "sheet", "security_name", "isin", "quantity",
    "market_value_raw", "pct_raw",
]
LEDGER_FIELDS = [
    "amc", "year", "month", "status", "description", "source_page", "download_url", "file_path", "error",
]

LOOKUPS = {
    "amfi_codes": _struct(("code", S), ("fund_name", S)),
    "isin_aliases": _struct(("isin_in_amc_file", S), ("isin_in_icra", S)),
    "isin_classification": _struct(
        ("isin", S), ("instrument_name", S), ("nature_name", S), ("basic_industry", S),
        ("industry", S), ("sector_name", S), ("macro_economic_sector", S),
    ),
    "isin_names": _struct(("isin", S), ("canonical_name", S)),
    "isin_name_variants": _struct(
        ("isin", S), ("name", S), ("match_key", S), ("count", L), ("is_canonical", I)
    ),
    "schemes": _struct(
        ("amc", S), ("match_key", S), ("sheet_name", S), ("amfi_code", S), ("fund_name", S),
        ("match_score", D),
    ),
    "non_isin_overrides": _struct(
        ("amc", S), ("priority", L), ("match_type", S), ("pattern", S), ("instrument", S), ("nature", S)
    ),
}

DOCUMENTS = _struct(
    ("amc", S), ("period", S), ("url", S), ("source_page_url", S), ("label", S), ("filename", S),
    ("file_type", S), ("scheme", S), ("primary", B), ("metadata", T.MapType(S, S)), ("ord", L),
)
LEDGER = _struct(*[(name, S) for name in LEDGER_FIELDS])
REFERENCE_PORTFOLIO = _struct(
    ("amfi_code", S), ("port_date", T.DateType()), ("isin", S), ("instrument_name", S),
    ("nature_name", S), ("basic_industry", S), ("industry", S), ("sector_name", S),
    ("macro_economic_sector", S), ("corpus_per", D), ("mkt_value", D), ("no_of_shares", D),
    ("fund_name", S),
)
EXTRACTED = _struct(("path", S), ("bytes", L), ("sha256", S))
MANIFEST_ENTRY = _struct(
    ("amc", S), ("period", S), ("scheme", S), ("source_page_url", S), ("path", S), ("bytes", L),
    ("sha256", S), ("content_type", S), ("downloaded_at", S),
    ("archive", _struct(("name", S), ("bytes", L), ("sha256", S))),
    ("extracted", T.ArrayType(EXTRACTED)),
)
FAILURE_ENTRY = _struct(("category", S), ("status", I), ("error", S), ("attempts", I))
MANIFEST = T.StructType([
    T.StructField("downloads", T.MapType(S, MANIFEST_ENTRY)),
    T.StructField("failures", T.MapType(S, FAILURE_ENTRY)),
])
