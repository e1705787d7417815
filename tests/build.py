"""Small tables for tests."""

from datetime import date

from holdrift.operators.consensus import DETAIL_COLUMNS
from holdrift.schemas import DOCUMENTS, HISTORY, UNIVERSE

DAY = {n: date(2026, 6, n) for n in range(1, 31)}


def history(spark, rows):
    """Rows as dicts; what is left out is NULL, the source is the usual one."""
    names = HISTORY.fieldNames()
    full = [{"source": "web_csv", **row} for row in rows]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], HISTORY)


def position(fund, day, ticker, shares, value=100.0, weight=1.0, isin=None, kind="equity", **more):
    return {"etf_ticker": fund, "as_of_date": DAY[day], "constituent_ticker": ticker,
            "constituent_name": more.pop("name", f"{ticker} Corp"), "isin": isin,
            "shares_held": float(shares) if shares is not None else None, "market_value": value,
            "weight_pct": weight, "instrument_type": kind, **more}


def universe(spark, rows):
    """(fund, vertical[, enabled[, external]])."""
    full = [(r[0], "issuer", r[1], None, r[3] if len(r) > 3 else None,
             r[2] if len(r) > 2 else None) for r in rows]
    return spark.createDataFrame(full, UNIVERSE)


def documents(spark, rows):
    return spark.createDataFrame([tuple(r) + (None,) * (5 - len(r)) for r in rows], DOCUMENTS)


_DELTA = ("etf_ticker string, isin string, constituent_ticker string, constituent_name string, "
          "delta_type string, delta_weight_pct double, delta_shares double, "
          "delta_market_value double")


def delta(fund, isin, weight=0.0, kind="change", name="Harbour Mills", value=250.0, shares=40.0,
          ticker="HBM"):
    return (fund, isin, ticker, name, kind, weight, shares, value)


def deltas(spark, rows):
    return spark.createDataFrame(rows, _DELTA)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    columns = columns or df.columns
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


__all__ = ["DAY", "DETAIL_COLUMNS", "delta", "deltas", "documents", "history", "position", "rows",
           "universe"]
