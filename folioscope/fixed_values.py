"""Fixed values.

Word lists, thresholds, lookup tables and patterns that decide results. They are
stated here as plain text so that they can be read, checked and tightened in one
place; all logic lives elsewhere.
"""

# --- Fixed values: identifiers -------------------------------------------------
ISIN_PATTERN = r"^[A-Z]{2}[A-Z0-9]{9}[0-9]$"
CONTRACT_CODE_PATTERN = r"^[A-Z]{4,8}[0-9]{6,8}$"
CONTRACT_CODE_EXCLUDED_PREFIX = "IDIA"
MIN_NAME_OBSERVATIONS = 3

# --- Fixed values: names of securities -------------------------------------------
BLANK_WORDS = ["", "nil", "n.a.", "na", "n/a", "-", "--", "none"]
INSTRUMENT_PREFIX_PATTERN = r"(?i)^\s*(EQ|FUT|OPT|CASH)\s*[-–]\s*"
EXPIRY_SUFFIX_PATTERN = r"\s*[-–]\s*\d{1,2}[-/][A-Za-z]{3}[-/]\d{2,4}\s*$"
FOOTNOTE_TAIL_PATTERN = r"[*^£$#~!@%&+°·• ]+$"
COMPANY_SUFFIX_PATTERN = r"\b(LIMITED|LTD)\b\.?"

# --- Fixed values: sheet layout -----------------------------------------------------
ISIN_HEADER_PATTERN = r"(?i)^isin(\s*(code|number|no\.?))?$"
NAME_HEADER_PATTERN = (
    r"(?i)name\s*of\s*(the\s*)?instrument|instrument\s*name|company\s*/\s*issuer"
    r"|name\s*of\s*(the\s*)?security|particulars"
)
NAME_HEADER_WORDS = ["name", "company", "particulars"]  # one of them stands in every text that the pattern matches
QUANTITY_HEADER_WORDS = ["quantity", "qty", "no. of shares", "no of shares", "no. of units", "units"]
VALUE_HEADER_WORDS = ["market value", "market/fair value", "fair value", "value (rs", "amount",
                      "mkt value", "mkt val"]
PERCENT_HEADER_WORDS = ["% to", "% of", "percentage"]
INDUSTRY_HEADER_WORDS = ["industry", "rating", "sector"]
STRUCTURE_ROW_PATTERN = (
    r"(?i)^\s*(sub\s*total|total|grand\s*total|net\s*assets?"
    r"|\(?[a-d]\)?\s*(listed|unlisted|privately|foreign)|notes?\s*:|nil)\s*$"
)
TOTAL_WORDS = ["total", "sub total", "subtotal", "grand total", "net total"]
TOTAL_ROW_PATTERN = (
    r"(?i)^(sub\s*[-_]?\s*total|grand[\s_]*total|net[\s_]*total|total)\b|\btotal\s*$"
)
STOP_PREFIXES = ["notes", "notes:", "note:", "disclaimer"]
NET_ASSETS_WORDS = ["net assets", "net asset value"]
MAX_PLAUSIBLE_PERCENT = 1000
TITLE_OF_PATTERN = (
    r"(?i)portfolio\s+(?:statement\s+)?of\s+(.+?)(?:\s+as\s+on\b|\s+as\s+at\b|$)"
)
TITLE_LABEL_PATTERN = r"(?i)^scheme\s*:\s*(.+)$"
TITLE_BOILERPLATE_PATTERN = (
    r"(?i)portfolio statement|monthly portfolio|statement of portfolio|as on|scheme name"
)
TITLE_EXCLUDED_PATTERN = (
    r"(?i)^\(.*\)$|^an?\s+open|^an?\s+close|^[•\-]"
    r"|registered office|investment manager|^cin[:\s]|^email|^visit us"
    r"|^(?:[a-z0-9]+[).]\s*)?(units?\s*of\b|mutual\s*fund\s*units?\b|exchange\s*traded\s*funds?\b)"
    r"|^details\s+of\b"
)
TITLE_FUND_WORD_PATTERN = r"(?i)\bfund\b|\betf\b|\bplan\b|\bscheme\b|\bfof\b"
ROLLUP_FILE_PATTERN = r"(?i)all[\s_-]*scheme|all[\s_-]*fund|consolidated|master\s*sheet"

# --- Fixed values: derivative disclosure ----------------------------------------------
DERIVATIVE_TITLE_PATTERN = r"(?i)derivative\s+disclosure\s*[-:]\s*(.+)$"
DERIVATIVE_UNTITLED_PATTERN = (
    r"(?i)derivative\s+disclosure\s+for\s+the\s+period|^\(?\d+\)?\s*derivative\s+disclosure"
)
DISCLOSURE_WORDS = ["derivative", "hedging"]  # one of them stands in every text that the patterns around them match
FUTURES_HEADING_PATTERN = r"(?i)^[a-z][).]\s*.*hedging\s+positions?\s+through\s+futures"
LETTERED_HEADING_PATTERN = r"(?i)^[a-z][).]\s+\S"
UNDERLYING_HEADER_PATTERN = r"(?i)^underlying\b"
DERIVATIVE_QUANTITY_PATTERN = r"(?i)^quantity\b"
LONG_SHORT_PATTERN = r"(?i)long\s*/?\s*\(?\s*short"
DERIVATIVE_VALUE_PATTERN = r"(?i)market\s*/?\s*(fair\s*)?value|fair\s*value"
DERIVATIVE_PERCENT_PATTERN = r"(?i)%\s*to\b|%\s*of\b"
EXPOSURE_ADJUSTMENT_NAME = "Derivative Exposure Adjustment"

# --- Fixed values: fixed-layout house ------------------------------------------------
FIXED_LAYOUT_SECTIONS = [
    "equity & equity related", "debt instruments", "money market instruments",
    "treps / reverse repo", "gold", "reit/invit instruments", "others",
]
FIXED_LAYOUT_SUBSECTIONS = [
    "certificate of deposit", "commercial paper", "treasury bill",
    "corporate debt market development fund", "exchange traded funds", "commodity future",
]
FIXED_LAYOUT_TOTALS = ["sub total", "total", "grand total"]
INDEX_LAYOUT_NON_SCHEME_SHEETS = [
    "index", "dividend history", "tata scheme risk-o-meter", "debt index replication factor",
]

# --- Fixed values: instruments without a security code ---------------------------------
# (priority, instrument, nature, name words, section words, section exclusions)
NON_ISIN_RULES = [
    (1, "Futures", "EQ", [], ["future"], ["commodity"]),
    (2, "Money Market", "Others", [], ["money market"], []),
    (3, "Net Receivables/(Payables)", "Others",
     ["net receivable", "net payable", "net current asset"], [], []),
    (4, "IRS", "Debt", [], ["irs", "interest rate swap"], []),
    (5, "Margin Deposit", "Debt", ["margin deposit"], [], []),
    (6, "Reverse repo", "Others",
     ["reverse repo", "treps", "tri-party", "triparty", "clearing corporation of india", "ccil"],
     [], []),
    (7, "Options", "EQ", [], ["option"], []),
    (8, "Repo", "Others", ["repo"], [], []),
    (9, "Current Assets", "Others", ["current asset"], [], []),
    (10, "Cash", "Others", ["cash"], [], []),
    (11, "Gold", "Others", ["gold"], [], []),
    (12, "Silver", "Others", ["silver"], [], []),
    (13, "Commodity Futures", "Others", [], ["commodity future"], []),
    (14, "MFEquity", "EQ", ["mutual fund unit", "mf unit"], [], []),
    (15, "FD", "Debt", ["fixed deposit"], [], []),
    (16, "Preference Shares", "EQ", ["preference share"], ["preference share"], []),
    (17, "Equity", "EQ", [], ["unlisted", "awaiting listing"], []),
]
OVERRULES_PRINTED_ISIN = [
    "Futures", "Options", "Commodity Futures", "Net Receivables/(Payables)", "Reverse repo",
    "Margin Deposit",
]
FALLBACK_INSTRUMENT = "Undisclosed - Others"
FALLBACK_NATURE = "Others"

# --- Fixed values: conversion and reconciliation tolerances ------------------------------
RESTATED_TOTAL_TOLERANCE = 0.005
PERCENT_SUM_TARGET, PERCENT_SUM_SLACK = 100.0, 20.0
FRACTION_SUM_TARGET, FRACTION_SUM_SLACK = 1.0, 0.2
MIN_PERCENT_FOR_NAV = 1.0
VALUE_TOLERANCE = 0.01
WEIGHT_TOLERANCE = 1.0
ALIAS_TOLERANCE = 0.001

# --- Fixed values: scheme names -------------------------------------------------------------
SHARE_CLASS_WORDS = [
    "regular", "direct", "retail", "institutional", "segregated", "seg",
    "growth", "idcw", "dividend", "bonus", "plan", "option", "options",
    "payout", "payment", "reinvest", "reinvestment", "income",
    "distribution", "cum", "capital", "withdrawal", "unclaimed",
    "redemption", "monthly", "quarterly", "annual", "and", "of", "the", "paln",
]
EXCLUDED_OPTION_PATTERN = r"(?i)idcw|dividend|bonus|payout|reinvest"
ANY_OPTION_PATTERN = r"(?i)\bgrowth\b|\bidcw\b|\bdividend\b|\bbonus\b|\bpayout\b|\breinvest"
OTHER_PLAN_PATTERN = r"(?i)\bretail\b|\binstitutional\b|\bsegregated\b"
FIXED_MATURITY_SERIES = ["bharat bond"]
MONTH_WORD_PATTERN = (
    r"jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?|may|jun(e)?|jul(y)?|aug(ust)?"
    r"|sep(t|tember)?|oct(ober)?|nov(ember)?|dec(ember)?"
)
LEADING_CODE_PATTERN = r"(?i)^[A-Z]{1,4}\d{1,4}[\-\s]+"
MATCH_THRESHOLD = 0.82
CONTAINMENT_SCORE = 0.9
RECENT_PERIODS = 6
COMPARE_FILLER_WORDS = ["FUND", "SCHEME", "PLAN", "OPTION", "REGULAR", "GROWTH", "THE", "OF",
                        "AN", "A", "AND"]
BLURB_PATTERN = (
    r"\b(AN?\s+OPEN\s+ENDED|AN?\s+CLOSE[D]?\s+ENDED|ERSTWHILE|FORMERLY|SCHEME\s+HAS"
    r"|THE\s+SCHEME)\b.*$"
)
WRONG_SCHEME_FLOOR = 0.72
SAME_SCHEME_FLOOR = 0.9
SUBSET_SCORE = 0.95
NUMBER_CONFLICT_CAP = 0.5

# --- Fixed values: months -------------------------------------------------------------------
MONTH_NUMBERS = {
    "jan": 1, "janaury": 1, "january": 1, "feb": 2, "febuary": 2, "february": 2,
    "mar": 3, "march": 3, "apr": 4, "apirl": 4, "april": 4, "may": 5, "jun": 6, "june": 6,
    "jul": 7, "july": 7, "aug": 8, "august": 8, "sep": 9, "sept": 9, "september": 9,
    "oct": 10, "october": 10, "nov": 11, "november": 11, "dec": 12, "december": 12,
}
MONTH_ABBREVIATIONS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6,
    "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
}
AUDIT_MONTH_FORMS = {
    "january": "jan", "february": "feb", "march": "mar", "april": "apr", "june": "jun", "july": "jul",
    "august": "aug", "sept": "sep", "september": "sep", "october": "oct", "november": "nov", "december": "dec",
}
MONTHLY_MONTH_PATTERN = (
    r"(?:january|february|march|april|may|june|july|august|september|october|november|december"
    r"|jan|feb|mar|apr|jun|jul|aug|sep|oct|nov|dec|sept)"
)
MONTHLY_NOISE_PATTERN = r"(?i)\b(?:weekly|daily|adhoc|quants|select|axistaa|fortnightly)\b"
MONTHLY_KEYWORD = "monthly portfolio"
DAY_PATTERN = r"(?:0?[1-9]|[12]\d|3[01])(?:st|nd|rd|th)?"
TWO_DIGIT_YEAR_PIVOT = 70

# --- Fixed values: documents and files ----------------------------------------------------
NOISE_QUERY_KEYS = ["sfvrsn", "v", "ver", "version", "cb", "cache", "_", "t", "ts", "timestamp",
                    "rand", "nocache"]
MAX_URL_LENGTH = 2000
UNSAFE_NAME_PATTERN = r'[\x00-\x1f<>:"/\\|?*]+'
FILE_URL_PATTERN = (
    r"""(["'])((?:(?!\1)[^<>]){4,}?\.(?:xlsx|xls|xlsm|csv|zip)(?:\?(?:(?!\1)[^<>])*)?)(?=\1|[<>]|$)"""
)
FILE_URL_PATTERN_FLAGS = "(?i)"
NON_HTML_SUFFIXES = ["xlsx", "xls", "xlsm", "xlsb", "zip"]
RESERVED_FILE_NAMES = ["manifest.json", ".expected.json", ".validation.json"]
WORKBOOK_SUFFIXES = ["xlsx", "xls"]

# --- Fixed values: ledger ---------------------------------------------------------------------
SUCCESS_STATUSES = ["SUCCESS", "ALREADY_EXISTS"]
UNAVAILABLE_STATUSES = ["YEAR_NOT_AVAILABLE", "MONTH_NOT_AVAILABLE", "NO_DATA", "UPSTREAM_GAP"]
RETRYABLE_STATUSES = ["DOWNLOAD_FAILED", "HTTP_ERROR", "SITE_CHANGED", "INVALID_FILE",
                      "DISCOVERY_FAILED", "UNKNOWN_ERROR"]
SETTLED_STATUSES = ["NOT_YET_PUBLISHED", "YEAR_NOT_AVAILABLE", "MONTH_NOT_AVAILABLE",
                    "ALREADY_EXISTS", "SUCCESS"]
PERIOD_IN_MESSAGE_PATTERN = r"\b20\d{2}-(?:0[1-9]|1[0-2])\b"
NO_DATA_PATTERN = r"(?i)\b(no|not list|not available|not published|no longer offers)\b"
SITE_CHANGED_PATTERN = (
    r"(?i)no longer (has|exposes|references|offers)|did not expose|is missing or is not a list"
    r"|not an object, not a|page structure changed|encryption scheme has changed"
    r"|dropdown never opened|AccordionList is missing"
)
HTTP_ERROR_PATTERN = (
    r"(?i)\btimeout\b|\btimed out\b|connectionerror|sslerror|httperror|read timed out"
    r"|failed to establish|max retries exceeded|connection refused|name or service not known"
    r"|\breturned\s+[45]\d{2}\b"
    r"|\b(?:http|https|status|code|response|responded)\W{0,12}[45]\d{2}\b"
    r"|\baccess denied\b|\bforbidden\b|\btoo many requests\b|\bbot wall\b"
    r"|never finished loading|\b[45]\d{2}\b.*(status|error)|status.*\b[45]\d{2}\b"
)
INVALID_FILE_PATTERN = (
    r"(?i)did not return a (zip/xlsx|xls/xlsx) payload|returned an empty payload"
    r"|content looks like an html page"
)
DISCOVERY_FAILED_PATTERN = (
    r"(?i)returned zero documents|discovery returned no documents|filename collision"
    r"|jsondecodeerror|keyerror|attributeerror|indexerror|typeerror|valueerror"
)

# --- Fixed values: coverage audit ---------------------------------------------------------------
NULL_CODE_WORDS = ["", "--", "-", "n.a.", "na", "nan", "none", "null"]
AUDIT_TAIL_PATTERN = (
    r"(?i)(\b(an?|the)\s+(open|close|closed)[\s-]*ended\b"
    r"|\b(open|close|closed)[\s-]*ended\s+(scheme|fund|equity|debt|hybrid|index|solution)"
    r"|\bmonthly\s+portfolio\b|\bportfolio\s+(statement|disclosure|as\s+on|as\s+at)\b"
    r"|\bas\s+(on|at)\b|\bfor\s+the\s+period\b|\bfor\s+the\s+month\b"
    r"|\bfor\s+(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s*\d{2,4}\b"
    r"|\bprovisional\s+and\s+unaudited\b|\bhalf[\s-]*yearly\s+portfolio\b).*$"
)
AUDIT_LEAD_PATTERN = (
    r"(?i)^\s*(?:(?:scheme\s*name|scheme|fund\s*name|fund|name\s+of\s+the\s+scheme"
    r"|name\s+of\s+scheme|portfolio\s+of|monthly\s+portfolio\s+of|portfolio)\s*[:\-–]\s*"
    r"|(?:provisional\s+and\s+unaudited\s+)?(?:monthly\s+|half[\s-]*yearly\s+)?"
    r"portfolio\s+(?:statement|disclosure|details)?\s*(?:of|for)\s+(?:the\s+)?(?:scheme\s+)?)"
)
AUDIT_CODE_PREFIX_PATTERN = r"^[A-Z0-9][A-Z0-9&]{1,9}\s*[-:]\s*(?=[A-Za-z])"
SCHEME_MARKER_PATTERN = r"(?i)^\s*scheme\s*(name)?\s*[:\-]"
SERIES_MARKER_PATTERN = r"(?i)^\s*(?:IL\s*&\s*FS\s+)?IDF\s+Series\s+\d+\s*[- ]?\s*[A-Z]\s*$"
AUDIT_TRAILING_TERM_PATTERN = (
    r"\s+(plan|option"
    r"|direct|regular|institutional|instl|retail|super\s+institutional|discontinued"
    r"|unclaimed|segregated"
    r"|growth|idcw|income\s+distribution\s+cum\s+capital\s+withdrawal|dividend|div"
    r"|bonus|payout|pay\s*out|reinvestment|re\s*investment|reinv|appreciation"
    r"|dap|drp|adjusted\s*nav|cumulative"
    r"|daily|dly|weekly|wkly|fortnightly|fortnight|ftly|monthly|mthly|mnthly"
    r"|quarterly|qtly|qly|half\s*yearly|half\s*yly|hly|yearly|yly|annual|annually"
    r"|adhoc|ad\s*hoc)$"
)
AUDIT_GENERIC_TAIL_PATTERN = r"\s+(fund|scheme)$"
AUDIT_TENOR_PATTERN = r"(\s+\d{1,5}\s*(days?|d|months?|mths?|m|years?|yrs?|y))+$"
AUDIT_FUND_WORD_PATTERN = (
    r"(?i)\b(fund|etf|fof|scheme|plan|index|yojana|yojna|elss|tax\s*saver|savings"
    r"|bees|series|advantage|nivesh|sip)\b"
)
AUDIT_SECTION_NOISE_PATTERN = (
    r"(?i)^(\(?[a-z]\)?\s+)?(listed|unlisted|privately\s+placed|awaiting\s+listing|sub\s*total"
    r"|total|grand\s+total|equity|debt|money\s+market|government|treasury|corporate"
    r"|net\s|cash|others?|margin|reverse\s+repo|triparty|clearing|units?\s+of"
    r"|derivat|hedg|name\s+of|company|instrument|isin|rating|quantity|market"
    r"|yield|maturity|coupon|industry|portfolio|scheme\s+riskometer|back\s+to"
    r"|aggregate|notes?|disclaimer|mutual\s+fund\s+investments)\b"
)
AUDIT_FILE_NOISE_PATTERN = (
    r"(?i)\b(monthly|month\s*end|portfolio|portfolios|disclosure|disclosures|statement"
    r"|report|isin|as\s+on|as\s+at|final|holdings?|mf|scheme|schemes|details)\b"
)
AUDIT_SKIP_SHEET_PATTERN = (
    r"(?i)^\s*(index|contents?|notes?|disclaimer|disclosure|cover|legend|glossary"
    r"|risk[\s-]*o[\s-]*meter.*|dividend\s+history|.*performance|.*risk-?o-?meter"
    r"|expense\s+ratio|scheme'?s?\s+aum|investment\s+objective|abbreviation.*"
    r"|derivatives?.*|.*\s+notes|common\s+notes.*|notes\s+to\s+.*"
    r"|.*derivative\s+disclosure.*)\s*$"
)
AUDIT_DATA_HEADER_PATTERN = (
    r"(?i)(name\s+of\s+the\s+instrument|company/?issuer|instrument\s+name|isin"
    r"|%\s*to\s*(net\s*)?(asset|nav)|market\s*/?\s*fair\s*value|net\s+assets)"
)
AUDIT_INDEX_SHEET_PATTERN = r"(?i)^\s*(index|contents?)\s*$"
AUDIT_FILE_DROP_PATTERNS = [r"\b[0-9a-f]{8,}\b", r"\b\d{1,2}[./]\d{1,2}[./]\d{2,4}\b", r"\b\d{6,}\b"]
AUDIT_FILE_MONTH_PATTERN = (
    r"(?i)\b(january|february|march|april|may|june|july|august|september|october|november|december"
    r"|jan|feb|mar|apr|jun|jul|aug|sept|sep|oct|nov|dec)\b"
)
AUDIT_FILE_YEAR_PATTERN = r"\b(19|20)\d{2}\b"
AUDIT_FILE_DAY_PATTERN = r"(?i)\b\d{1,2}(st|nd|rd|th)?\b\s*$"
AUDIT_ROMAN_PATTERN = r"^m{0,3}(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})$"
AUDIT_ROMAN_TRIGGERS = ["series", "plan", "fmp", "no"]
AUDIT_ROMAN_DIGITS = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
AUDIT_ISIN_PATTERN = r"^IN[EFD][0-9A-Z]{9}$"
AUDIT_LABELLED_CODE_PATTERN = r"(?i)\bamfi\s*(?:scheme\s*)?code\s*[:\-]?\s*(\d{5,6})\b"
AUDIT_AS_OF_PATTERN = (
    r"(?i)\bportfolio\s+as\s+(?:on|at)\b.*?\b"
    r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|jun(?:e)?|jul(?:y)?|"
    r"aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
    r"\b.*?\b((?:19|20)\d{2})\b"
)
AUDIT_TOP_ROWS = 15
AUDIT_TITLE_CELLS = 4
AUDIT_GENERIC_MANIFEST_SCHEMES = ["consolidated", "combined", "all funds portfolio"]
TIER_RANKS = {"exact": 6, "reduced": 5, "tokenset": 4, "alias": 3, "amc_prefix": 2, "plan": 1,
              "suffix": 0}
RANK_METHODS = {
    6: ("icra_name_exact", 0.98), 5: ("icra_name_reduced", 0.93), 4: ("token_set_equal", 0.91),
    3: ("scheme_master_alias", 0.90), 2: ("amc_prefix_alias", 0.86),
    1: ("plan_option_reduced", 0.80), 0: ("generic_suffix_reduced", 0.78),
}
PRINTED_CODE_METHOD = ("amfi_code", 1.00)
CODE_LIST_METHOD = ("amfi_navall_code", 0.75)
GLOBAL_SCOPE_PENALTY = 0.05
NEAR_MISS_REPORT_FLOOR = 0.70
NEAR_MISS_AMBIGUOUS_FLOOR = 0.86
NEAR_MISS_LIMIT = 3
ORDER_MANIFEST, ORDER_SHEET_TITLE, ORDER_SHEET_NAME, ORDER_FILE_NAME = 0, 100, 1000, 2000
ADVISORY_EXPANSIONS = [
    (r"\bidf\b", "infrastructure debt fund"), (r"\bqlty\b", "quality"), (r"\bindx\b", "index"),
    (r"\bfin\s+servs?\b", "financial services"), (r"\bsec\b", "securities"),
    (r"\badvt\b", "advantage"), (r"\balloc\b", "allocation"), (r"\beq\b", "equity"),
]
HOUSE_PREFIXES = {
    "Aditya Birla Sun Life Mutual Fund": ["ABSL", "Birla Sun Life", "Aditya Birla"],
    "Baroda BNP Paribas Mutual Fund": ["Baroda BNP", "BNP Paribas", "BOBBNP", "BBP"],
    "Bank of India Mutual Fund": ["BOI", "BOI AXA"],
    "Canara Robeco Mutual Fund": ["Canara"],
    "DSP Mutual Fund": ["DSP BlackRock"],
    "Franklin Templeton Mutual Fund": ["Franklin India", "Franklin", "Templeton India"],
    "HSBC Mutual Fund": ["HSBC India"],
    "ICICI Prudential Mutual Fund": ["ICICI Pru", "ICICI"],
    "IL & FS Mutual Fund": ["IL&FS", "ILFS"],
    "JM Financial Mutual Fund": ["JM"],
    "Jio BlackRock Mutual Fund": ["JioBlackRock", "Jio Black Rock"],
    "Kotak Mahindra Mutual Fund": ["Kotak"],
    "LIC Mutual Fund": ["LIC MF", "LICMF"],
    "Mahindra Manulife Mutual Fund": ["Mahindra"],
    "Mirae Asset Mutual Fund": ["Mirae"],
    "Motilal Oswal Mutual Fund": ["Motilal"],
    "Nippon India Mutual Fund": ["Nippon", "Reliance"],
    "PGIM India Mutual Fund": ["PGIM"],
    "PPFAS Mutual Fund": ["Parag Parikh", "PPFAS"],
    "SBI Mutual Fund": ["SBI Magnum"],
    "The Wealth Company Mutual Fund": ["Wealth Company", "The Wealth Company"],
    "Trust Mutual Fund": ["TRUSTMF", "Trust MF"],
    "UTI Mutual Fund": ["UTI"],
    "WhiteOak Capital Mutual Fund": ["WhiteOak", "WOC", "White Oak"],
    "360 ONE Mutual Fund": ["360 ONE", "IIFL"],
    "Quantum Mutual Fund": ["Quantum"],
    "Angel One Mutual Fund": ["Angel One"],
}
HOUSE_FOLDER_NAMES = {
    "wealth_company": "The Wealth Company Mutual Fund",
    "bandhan/monthly-half-yearly": "Bandhan Mutual Fund",
    "bandhan/monthly": "Bandhan Mutual Fund",
}

# --- Fixed values: which layout reads a house; all others are generic ---------------------
HOUSE_LAYOUTS = {"360_one": "fixed", "pgim": "filename", "tata": "index"}

# --- Fixed values: what a house's listing must and must not show ----------------------------
# Per house a list of clauses, all of which must hold. A clause holds if one of its conditions
# (action, field, pattern) does; fields are url, name, folder, text and evidence (text and url).
WORKBOOK_ADDRESS = ("include", "url", r"(?i)\.(?:xls|xlsx)(?:[?#]|$)")
WORKBOOK_OR_ARCHIVE_ADDRESS = ("include", "url", r"(?i)\.(?:zip|xls|xlsx)(?:[?#]|$)")
HOUSE_RULES = {
    "capitalmind": [[WORKBOOK_ADDRESS], [("include", "url", r"(?i)monthly_portfolio")]],
    "dsp": [[WORKBOOK_OR_ARCHIVE_ADDRESS], [("include", "text", r"(?i)portfolio\s+details\s+as\s+on")]],
    "franklin_templeton": [[WORKBOOK_ADDRESS], [("include", "url", r"(?i)monthly-portfolio-dsclr")]],
    "helios": [[WORKBOOK_ADDRESS], [("include", "url", r"(?i)monthly-portfolio")]],
    "hsbc": [
        [WORKBOOK_ADDRESS],
        [("exclude", "url", r"(?i)fortnightly-debt-portfolio|weekly-fund-portfolios|half-yearly-portfolios")],
        [("include", "url", r"(?i)documents?-"), ("include", "evidence", r"(?i)monthly-portfolio"), ("include", "folder", r"(?i)^portfolios$")],
        [("include", "url", r"(?i)documents?-"), ("include", "evidence", r"(?i)monthly-portfolio"), ("exclude", "name", r"(?i)half-yearly|fortnightly|weekly")],
    ],
    "motilal_oswal": [
        [WORKBOOK_ADDRESS], [("include", "text", r"(?i)month\s*end\s*portfolio")], [("exclude", "name", r"(?i)forth?nightly|weekly|half[- ]?year")]],
    "nippon_india": [
        [WORKBOOK_ADDRESS], [("include", "evidence", r"(?i)monthly[\s_-]*portfolio|portfolio[\s_-]*monthly")], [("exclude", "evidence", r"(?i)fortnightly")]],
    "old_bridge": [
        [WORKBOOK_ADDRESS], [("include", "url", r"(?i)/uploads/")], [("include", "evidence", r"(?i)portfolio")],
        [("exclude", "evidence", r"(?i)fortnightly|weekly|half[- ]?year|scheme[_ -]?dashboard|performance|proxy|sebi|ir[_ -]")]],
    "ppfas": [
        [WORKBOOK_ADDRESS], [("include", "evidence", r"(?i)monthly[\s_-]*portfolio|portfolio[\s_-]*report")],
        [("exclude", "evidence", r"(?i)fortnightly|weekly")]],
    "samco": [
        [WORKBOOK_ADDRESS], [("include", "url", r"(?i)/amc-document-download/")], [("include", "url", r"(?i)monthly[_ -]?portfolio")],
        [("exclude", "evidence", r"(?i)fortnightly|weekly|half[- ]?year")]],
    "sbi": [[WORKBOOK_ADDRESS], [("exclude", "evidence", r"(?i)fortnightly|half[- ]?year")]],
    "sundaram": [[WORKBOOK_ADDRESS], [("exclude", "evidence", r"(?i)fortnightly|adhoc")]],
    "unifi": [
        [WORKBOOK_ADDRESS], [("include", "name", r"(?i)^mp-"), ("include", "text", r"(?i)monthly-portfolio-disclosure")],
        [("exclude", "evidence", r"(?i)notice|fortnightly|weekly|\.pdf(?:[?#]|$)")]],
    "union": [[WORKBOOK_ADDRESS], [("exclude", "evidence", r"(?i)fortnightly|weekly|half[- ]?year")]],
}
