"""Words, codes, formats and column names that results depend on.

Everything here is data, stated once. Changing an entry changes results.
"""

# --- fixed values: snapshot table -------------------------------------------------

HISTORY_COLUMNS = [
    "as_of_date", "etf_ticker", "constituent_ticker", "constituent_name", "isin",
    "sedol", "shares_held", "market_value", "weight_pct", "currency", "sector",
    "country", "asset_class", "instrument_type", "source",
]

RAW_FIELDS = [
    "constituent_ticker", "constituent_name", "isin", "sedol", "shares_held",
    "market_value", "weight_pct", "currency", "sector", "country", "asset_class",
    "as_of_date",
]

DEFAULT_SOURCE = "web_csv"
CASH_ISIN = "CASH"

# --- fixed values: cleaning -------------------------------------------------------

TEXT_PLACEHOLDERS = ["", "-", "--", "n/a", "na", "nan", "none", "null"]
NUMBER_PLACEHOLDERS = ["", "-", "--", "N/A", "n/a", "NA"]
ISIN_PATTERN = "^[A-Z]{2}[A-Z0-9]{9}[0-9]$"
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()

# --- fixed values: instrument classification ----------------------------------------

EQUITY = "equity"
CASH = "cash"
FX = "fx"
DERIVATIVE = "derivative"
FIXED_INCOME = "fixed_income"
RESIDUAL = "residual"
TRACKED_TYPES = [EQUITY]

# Provider label rules: the first contained text wins.
LABEL_RULES = [
    ("money market", CASH),
    ("cash", CASH),
    ("foreign exchange", FX),
    ("currency", FX),
    ("forward", DERIVATIVE),
    ("future", DERIVATIVE),
    ("swap", DERIVATIVE),
    ("option", DERIVATIVE),
    ("warrant", DERIVATIVE),
    ("derivative", DERIVATIVE),
    ("fixed income", FIXED_INCOME),
    ("treasury", FIXED_INCOME),
    ("bond", FIXED_INCOME),
    ("equit", EQUITY),
    ("common stock", EQUITY),
    ("ordinary share", EQUITY),
    ("stock", EQUITY),
    ("share", EQUITY),
    ("depositary", EQUITY),
    ("reit", EQUITY),
]

CASH_WORDS = [
    "cash", "money market", "money mkt", "net other asset", "other net asset",
    "net current asset", "liquidity fund", "margin", "collateral", "repurchase",
    "repo ", "payable", "receivable", "accrued", "net assets", "subscription",
    "redemption", "dividend pending",
]

DERIVATIVE_WORDS = [
    "future", " fut ", "fut.", "fwd", "forward", "swap", "option", " call ",
    " put ", "p-note", "p note", "participat", "warrant", "tba", "to be announced",
    "contract for diff", " cfd", "index fut", "hedge",
]

CURRENCY_WORDS = [
    "dollar", "euro", "yen", "sterling", "pound", "franc", "rand", "yuan",
    "renminbi", "riyal", "won", "krona", "krone", "kroner", "peso", "rupee",
    "ringgit", "baht", "real", "ruble", "rouble", "zloty", "lira", "dirham",
    "shekel", "koruna", "forint", "rupiah", "dinar",
]

# Currency codes known to the classifier.
CURRENCY_CODES = (
    "AUD CAD GBP HKD JPY ZAR USD EUR CHF NZD SGD SEK NOK DKK CNY CNH KRW BRL MXN IDR "
    "INR PLN TRY PHP THB MYR TWD SAR AED ILS CLP PEN COP HUF CZK RUB"
).split()
# The test on rows stored without a type knows seven more.
UNTYPED_ROW_CURRENCY_CODES = CURRENCY_CODES + "QAR KWD BHD OMR RON BGN ISK".split()

CURRENCY_PAIR_PATTERN = "^[A-Z]{3}/[A-Z]{3}$"

# --- fixed values: identifier resolution --------------------------------------------

COMPANY_FORM_WORDS = (
    "LTD LIMITED INC INCORPORATED CORP CORPORATION COMPANY CO PLC AG SA NV SE ASA AB "
    "OYJ SAB CV CLASS"
).split()

# --- fixed values: thresholds -------------------------------------------------------

WEIGHT_NOISE = 0.001

DEFAULT_CONFIG = {
    "defaults": {
        "min_weight_delta_bps": 25,
        "min_share_pct_change": 5.0,
        "min_value_delta_usd": 1000000,
    },
    "overrides_by_vertical": {},
    "cross_etf": {"min_converging_etfs": 2},
}

# --- fixed values: digest -----------------------------------------------------------

DIGEST_LIMITS = {"additions": 10, "removals": 10, "major_moves": 10, "signals": 5}

# --- fixed values: provider documents -----------------------------------------------

MIN_FULL_HOLDINGS = 11

AS_OF_PATTERN = (
    r"(?i)as of[\s,:]*"
    r"([A-Za-z]{3,9}\s+\d{1,2},?\s+\d{4}"
    r"|\d{1,2}[/-][A-Za-z]{3}[/-]\d{4}"
    r"|\d{1,2}/\d{1,2}/\d{4}"
    r"|\d{4}-\d{2}-\d{2})"
)
DATE_LINE_PATTERN = r"(?im)^\s*date\s*,\s*([0-9]{4}-[0-9]{2}-[0-9]{2})"
HOLDINGS_AS_OF_PATTERN = r"(?i)Holdings\s+As of\s+(\d{1,2}/\d{1,2}/\d{4})"
PAGE_AS_OF_PATTERN = r"(?i)As of\s+(\d{1,2}/\d{1,2}/\d{4})"

# Delimited-text layouts. ``header``: words the header line must hold; ``columns``: for
# each target field the provider's column names, best first; ``fixed``: values the
# provider does not state; ``loose``: whether a name may also match inside a header.
CSV_LAYOUTS = {
    "ishares": {
        "header": ["ticker", "name", "weight"],
        "columns": {
            "constituent_ticker": ["Ticker"],
            "constituent_name": ["Name"],
            "isin": ["ISIN"],
            "sedol": ["SEDOL"],
            "shares_held": ["Shares"],
            "market_value": ["Market Value"],
            "weight_pct": ["Weight (%)", "Weight"],
            "currency": ["Market Currency", "Currency"],
            "sector": ["Sector"],
            "country": ["Location", "Country"],
            "asset_class": ["Asset Class"],
        },
        "date": "text",
    },
    "globalx": {
        "header": ["ticker", "name", "weight"],
        "header_without_weight": ["ticker", "name", "net"],
        "columns": {
            "constituent_ticker": ["Ticker", "TICKER"],
            "constituent_name": ["Name", "NAME"],
            "isin": ["ISIN"],
            "sedol": ["SEDOL"],
            "shares_held": ["Shares Held", "SHARES_HELD", "Shares"],
            "market_value": ["Market Value ($)", "MARKET_VALUE", "Market Value"],
            "weight_pct": ["% of Net Assets", "NET_ASSETS", "Weight (%)", "Weight"],
            "sector": ["Sector"],
            "country": ["Country", "COUNTRY"],
            "asset_class": ["Asset Class", "SecurityType", "Security Type"],
        },
        "fixed": {"currency": "USD"},
        "date": "text",
        "needs_rows": True,
    },
    "globalx_eu": {
        "header": ["ticker", "name", "isin"],
        "columns": {
            "constituent_ticker": ["Ticker", "TICKER"],
            "constituent_name": ["Name", "NAME"],
            "isin": ["ISIN"],
            "sedol": ["SEDOL"],
            "shares_held": ["Shares Held", "SHARES_HELD", "Shares"],
            "market_value": ["Market Value ($)", "MARKET_VALUE", "Market Value"],
            "weight_pct": ["% of Net Assets", "NET_ASSETS", "Weight (%)", "Weight"],
            "sector": ["Sector"],
            "country": ["Country", "COUNTRY"],
            "asset_class": ["Asset Class", "SecurityType", "Security Type"],
            "as_of_date": ["AS_OF_DATE"],
        },
        "fixed": {"currency": "USD"},
        "date": "column_then_text",
        "needs_rows": True,
    },
    "vaneck": {
        "header": ["ticker", "name"],
        "columns": {
            "constituent_ticker": ["Ticker", "Holding Ticker"],
            "constituent_name": ["Name", "Holding Name", "Security"],
            "isin": ["ISIN"],
            "sedol": ["SEDOL"],
            "shares_held": ["Shares", "Shares Held"],
            "market_value": ["Market Value", "Market Value (USD)"],
            "weight_pct": ["% of Net Assets", "Weighting", "Weight (%)", "Weight"],
            "currency": ["Currency", "Local Currency"],
            "sector": ["Sector"],
            "country": ["Country"],
            "asset_class": ["Asset Class", "SecurityType", "Security Type"],
        },
        "date": "text",
    },
    "betashares": {
        "header": ["ticker", "name", "weight"],
        "columns": {
            "constituent_ticker": ["Ticker", "Code"],
            "constituent_name": ["Name", "Security"],
            "isin": ["ISIN"],
            "sedol": ["SEDOL"],
            "shares_held": ["Shares/Units (#)", "Shares", "Units"],
            "market_value": ["Market Value (AUD)", "Market Value", "Value"],
            "weight_pct": ["Weight (%)", "Weight", "% of Net Assets"],
            "sector": ["Sector"],
            "country": ["Country"],
            "asset_class": ["Asset Class", "Security Type"],
        },
        "fixed": {"currency": "AUD"},
        "date": "date_line_then_text",
    },
    "amplify": {
        "header": ["account", "stockticker", "securityname"],
        "account": ["Account"],
        "columns": {
            "constituent_ticker": ["StockTicker", "Ticker"],
            "constituent_name": ["SecurityName", "Name"],
            "isin": ["ISIN"],
            "sedol": ["SEDOL"],
            "shares_held": ["Shares"],
            "market_value": ["MarketValue", "Market Value"],
            "weight_pct": ["Weightings", "Weight"],
            "sector": ["Sector"],
            "country": ["Country"],
            "asset_class": ["SecurityType", "Asset Class", "Security Type"],
            "as_of_date": ["Date"],
        },
        "fixed": {"currency": "USD"},
        "date": "column",
        "needs_rows": True,
    },
    "sprott": {
        "header": [],
        "columns": {
            "constituent_ticker": ["Symbol", "Ticker"],
            "constituent_name": ["Security", "Name"],
            "sedol": ["SEDOL"],
            "shares_held": ["Quantity", "Shares"],
            "market_value": ["Market Value", "MarketValue"],
            "weight_pct": ["Weight", "Weight (%)"],
        },
        "fixed": {"currency": "USD"},
        "date": "given",
        "loose": False,
        "needs_name_or_ticker": True,
    },
}

# Sheet exported as delimited text; the header row holds a cell ``ticker`` and a cell
# with ``weight`` in it.
SHEET_COLUMNS = {
    "constituent_ticker": ["Ticker"],
    "constituent_name": ["Name"],
    "isin": ["ISIN"],
    "sedol": ["SEDOL"],
    "shares_held": ["Shares Held", "Shares"],
    "market_value": ["Market Value"],
    "weight_pct": ["Weight"],
    "currency": ["Local Currency", "Currency"],
    "sector": ["Sector"],
    "country": ["Country"],
    "asset_class": ["Asset Class"],
}

HTML_TABLE_COLUMNS = {
    "constituent_ticker": ["Ticker", "Code", "ASX Code"],
    "constituent_name": ["Name", "Security", "Holding"],
    "isin": ["ISIN"],
    "sedol": ["SEDOL"],
    "shares_held": ["Shares", "Units", "Shares Held"],
    "market_value": ["Market Value", "Value"],
    "weight_pct": ["Weight", "Weight (%)", "% Weight", "% of Net Assets"],
    "currency": ["Currency"],
    "sector": ["Sector"],
    "country": ["Country"],
    "asset_class": ["Asset Class", "Security Type"],
}
# Columns of a rendered holdings table by place, and the words its header must hold.
PLACED_TABLE_COLUMNS = [
    "constituent_name", "market_value", "constituent_ticker", "sedol", "shares_held", "weight_pct"]
PLACED_TABLE_WORDS = ["security", "market value", "symbol", "sedol", "quantity", "weight"]

# Tabular text inside an address: up to the quote it was opened with, else to white space.
DATA_ADDRESS_PATTERN = (
    r'''(?i)"data:application/csv[^"]*"|'data:application/csv[^']*'|data:application/csv\S+''')
DATA_ADDRESS_BODY = r"(?is)data:application/csv[^,]*,(.+)"

# How a web page begins, or what its first characters hold.
PAGE_STARTS = ["<!doctype html", "<html"]
PAGE_MARKERS = ["<head>"]

HTML_NAME_WORDS = ["name", "ticker", "security"]
HTML_WEIGHT_WORDS = ["weight", "%"]

# Column-wise JSON: path to the data points, and data point -> field.
COLUMNAR_JSON_PATH = [
    "componentsByNameMap", "holdings", "containersByNameMap", "all", "dataPointsByNameMap",
]
COLUMNAR_JSON_FIELDS = {
    "ticker": "constituent_ticker",
    "issueName": "constituent_name",
    "isin": "isin",
    "sedol": "sedol",
    "unitsHeld": "shares_held",
    "marketValue": "market_value",
    "holdingPercent": "weight_pct",
    "currencyCode": "currency",
    "sectorName": "sector",
    "countryOfRisk": "country",
    "assetClass": "asset_class",
}

# Row-wise JSON: field -> properties, the first that is not empty wins.
ROW_JSON_FIELDS = {
    "constituent_ticker": ["Label", "HoldingTicker"],
    "constituent_name": ["HoldingName"],
    "isin": ["ISIN"],
    "sedol": ["SEDOL"],
    "shares_held": ["Shares"],
    "market_value": ["MV"],
    "weight_pct": ["Weight"],
    "currency": ["CurrencyCode"],
    "sector": ["Sector"],
    "country": ["Country"],
    "asset_class": ["SecurityType", "AssetClass", "AssetClassName"],
}
