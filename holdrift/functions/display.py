"""Column functions that write numbers and names for readers.

Two rounding rules exist for a value exactly between two neighbours: the digest takes
the even one, the tables the one away from zero. All other values round alike.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

DASH = "—"
MINUS = "−"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed(c, digits) -> Column:
    """Text with a fixed number of decimals; exact halves go to the even digit."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", _col(c).cast("double"), F.lit(pattern))


def fixed_away(c, digits) -> Column:
    """As ``fixed``, but exact halves go away from zero."""
    value = _col(c).cast("double")
    # A half at this digit is an odd multiple of 2^-(digits+1), and scaling by a power of
    # two is exact. A nudge much smaller than the last digit then settles the direction.
    scaled = value * float(2 ** (digits + 1))
    on_half = (scaled == F.floor(scaled)) & (F.abs(F.pmod(scaled, F.lit(2.0))) == 1)
    nudged = value + F.signum(value) * 2.0 ** -(4 * digits + 4)
    return fixed(F.when(on_half, nudged).otherwise(value), digits)


def _plus(value) -> Column:
    return F.when(value >= 0, F.lit("+")).otherwise("")


def signed_percent(c, digits=3) -> Column:
    """``+1.250%``; for weight moves, and with one digit for share moves."""
    value = _col(c).cast("double")
    return F.when(value.isNull(), DASH).otherwise(
        F.concat(_plus(value), fixed_away(value, digits), F.lit("%")))


def weight(c) -> Column:
    value = _col(c).cast("double")
    return F.when(value.isNull(), DASH).otherwise(F.concat(fixed_away(value, 2), F.lit("%")))


def money(c) -> Column:
    """``+$1.25M``."""
    value = _col(c).cast("double")
    size = F.abs(value)
    sign = F.when(value >= 0, F.lit("+$")).otherwise(f"{MINUS}$")
    amount = (
        F.when(size >= 1e9, F.concat(fixed_away(size / 1e9, 2), F.lit("B")))
        .when(size >= 1e6, F.concat(fixed_away(size / 1e6, 2), F.lit("M")))
        .when(size >= 1e3, F.concat(fixed_away(size / 1e3, 1), F.lit("k")))
        .otherwise(fixed_away(size, 0))
    )
    return F.when(value.isNull(), DASH).otherwise(F.concat(sign, amount))


def sign_class(c) -> Column:
    value = _col(c)
    return F.when(value.isNull() | (value == 0), "dim").when(value > 0, "pos").otherwise("neg")


def short_shares(c) -> Column:
    """``+1.2M`` shares."""
    value = _col(c).cast("double")
    size = F.abs(value)
    amount = (
        F.when(size >= 1e9, F.concat(fixed(size / 1e9, 1), F.lit("B")))
        .when(size >= 1e7, F.concat(fixed(size / 1e6, 0), F.lit("M")))
        .when(size >= 1e6, F.concat(fixed(size / 1e6, 1), F.lit("M")))
        .when(size >= 1e3, F.concat(fixed(size / 1e3, 0), F.lit("K")))
        .otherwise(fixed(size, 0))
    )
    sign = F.when(value >= 0, F.lit("+")).otherwise("-")
    return F.when(value.isNull(), DASH).otherwise(F.concat(sign, amount))


def label(name, ticker) -> Column:
    """``Name (TICKER)``."""
    shown = F.trim(F.coalesce(_col(name), F.lit("")))
    code = F.nullif(_col(ticker), F.lit(""))
    return F.when(code.isNotNull(), F.concat(shown, F.lit(" ("), code, F.lit(")"))).otherwise(
        F.coalesce(F.nullif(shown, F.lit("")), F.lit(DASH)))


def clip(c, length=38) -> Column:
    """At most ``length`` characters, with an ellipsis where text was cut."""
    text = F.coalesce(_col(c), F.lit(""))
    return F.when(F.length(text) > length,
                  F.concat(F.substring(text, 1, length - 1), F.lit("…"))).otherwise(text)


def day(c) -> Column:
    """``5 Jun 2026``."""
    return F.coalesce(F.date_format(_col(c), "d MMM yyyy"), F.lit(DASH))
