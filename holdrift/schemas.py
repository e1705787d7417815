"""Table schemas."""

from pyspark.sql import types as T

from holdrift.fixed_values import HISTORY_COLUMNS, RAW_FIELDS

_NUMBERS = {"shares_held", "market_value", "weight_pct"}


def _stored_type(name):
    if name == "as_of_date":
        return T.DateType()
    return T.DoubleType() if name in _NUMBERS else T.StringType()


# One row per listed position, as a provider states it: text only.
RAW_HOLDINGS = T.StructType(
    [T.StructField("etf_ticker", T.StringType())]
    + [T.StructField(name, T.StringType()) for name in RAW_FIELDS]
)

# The stored snapshot history.
HISTORY = T.StructType([T.StructField(name, _stored_type(name)) for name in HISTORY_COLUMNS])

# Fund dimension.
UNIVERSE = T.StructType([
    T.StructField("etf_ticker", T.StringType()),
    T.StructField("issuer", T.StringType()),
    T.StructField("commodity_vertical", T.StringType()),
    T.StructField("fund_page_url", T.StringType()),
    T.StructField("external", T.BooleanType()),
    T.StructField("enabled", T.BooleanType()),
])

# One landed provider document per row.
DOCUMENTS = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("etf_ticker", T.StringType()),
    T.StructField("layout", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("given_date", T.StringType()),
])
