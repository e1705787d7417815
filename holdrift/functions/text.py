"""Column functions that clean provider text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from holdrift.fixed_values import (
    CASH_ISIN, COMPANY_FORM_WORDS, ISIN_PATTERN, MONTHS, NUMBER_PLACEHOLDERS,
    TEXT_PLACEHOLDERS,
)

# Every character that counts as white space, not only the ASCII ones.
SPACES = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
          "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
ASCII_SPACES = "".join(space for space in SPACES if space.isascii())

_NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value, body) -> Column:
    """``body`` applied to ``value``, which is computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c) -> Column:
    """Text without white space at both ends."""
    return F.btrim(_col(c), F.lit(SPACES))


def strip_plain(text) -> Column:
    """``strip`` of a text that is at hand, such as a column.

    Trimming takes time per kind of white space: it is left out where both ends are plain letters or
    signs, and only looks for the ASCII kinds in ASCII text.
    """
    last = F.substring(text, -1, 1)
    plain = (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(plain, text).when(ascii_only, F.btrim(text, F.lit(ASCII_SPACES))).otherwise(strip(text))


def blank_to_null(c) -> Column:
    return F.nullif(_col(c), F.lit(""))


def known_text(text) -> Column:
    """Stripped text unless it is a placeholder."""
    return F.when(~F.lower(text).isin(TEXT_PLACEHOLDERS), text)


def clean_text(c) -> Column:
    """Stripped text; placeholders such as ``-`` or ``n/a`` become NULL."""
    return known_text(strip(c))


def without_signs(text) -> Column:
    """Stripped text of a number without brackets, thousands separators and signs of unit."""
    bare = F.when(F.contains(text, F.lit("(")) | F.contains(text, F.lit(")")), F.btrim(text, F.lit("()"))).otherwise(text)
    for sign in ",%$":
        bare = F.replace(bare, F.lit(sign), F.lit(""))
    return bare


def joined_digits(bare) -> Column:
    """Text of a number without underscores between digits."""
    return F.when(F.contains(bare, F.lit("_")), F.regexp_replace(bare, r"(?<=\d)_(?=\d)", "")).otherwise(bare)


def signed_number(text, digits) -> Column:
    """The number that ``digits`` of a stripped text state."""
    value = F.when(digits.rlike(_NUMBER), digits.try_cast("double"))
    in_brackets = text.startswith("(") & text.endswith(")")
    return F.when(~text.isin(NUMBER_PLACEHOLDERS) & (F.lower(text) != "nan"),
                  F.when(in_brackets, -value).otherwise(value))


def _number_of(text) -> Column:
    return bound(strip(without_signs(text)), lambda bare: bound(
        joined_digits(bare), lambda digits: signed_number(text, digits)))


def parse_number(c) -> Column:
    """Number in provider notation: ``$1,234.5``, ``12%``, ``(3.5)`` for minus 3.5."""
    return bound(strip(c), _number_of)


_MONTH_NO = r"(1[0-2]|0[1-9]|[1-9])"
_DAY_NO = r"(3[0-1]|[1-2]\d|0[1-9]|[1-9])"
_MONTH_NAME = "(" + "|".join(MONTHS) + ")"

# In order of trial: pattern, then which group holds year, month and day.
_DATE_SHAPES = [
    (rf"^(\d{{4}})-{_MONTH_NO}-{_DAY_NO}$", 1, 2, 3),
    (rf"^{_MONTH_NO}/{_DAY_NO}/(\d{{4}})$", 3, 1, 2),
    (rf"^{_DAY_NO}/{_MONTH_NO}/(\d{{4}})$", 3, 2, 1),
    (rf"(?i)^{_DAY_NO}-{_MONTH_NAME}-(\d{{4}})$", 3, 2, 1),
    (rf"(?i)^{_DAY_NO}-{_MONTH_NAME}-(\d{{2}})$", 3, 2, 1),
    (rf"(?i)^{_DAY_NO}\s+{_MONTH_NAME}\s+(\d{{4}})$", 3, 2, 1),
    (rf"(?i)^{_MONTH_NAME}\s+{_DAY_NO},\s+(\d{{4}})$", 3, 1, 2),
    (rf"^(\d{{4}}){_MONTH_NO}{_DAY_NO}$", 1, 2, 3),
]
_US_DATE_SHAPES = [_DATE_SHAPES[1], _DATE_SHAPES[0], _DATE_SHAPES[2]]


def _date_by_shape(text, pattern, year, month, day):
    if _MONTH_NAME in pattern:
        y, m, d = (F.regexp_extract(text, pattern, g) for g in (year, month, day))
        m = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(m)).cast("string")
        if r"(\d{2})" in pattern:  # two-digit years run from 1969 to 2068
            y = F.concat(F.when(y >= "69", F.lit("19")).otherwise("20"), y)
        stated = F.concat_ws("-", y, m, d)
    else:
        stated = F.regexp_replace(text, pattern, f"${year}-${month}-${day}")
    return F.when(text.rlike(pattern), stated.try_cast("date"))


def _first_shape(shapes):
    return lambda text: F.coalesce(*[_date_by_shape(text, *shape) for shape in shapes])


def stated_date(text) -> Column:
    """Date told by stripped text."""
    return _first_shape(_DATE_SHAPES)(text)


def parse_date(c) -> Column:
    """Date in one of the providers' eight notations; month-first is tried before day-first."""
    return bound(strip(c), stated_date)


def parse_us_date(c) -> Column:
    """Date as m/d/Y, else ISO, else d/m/Y."""
    return bound(strip(c), _first_shape(_US_DATE_SHAPES))


def is_isin(c) -> Column:
    return F.coalesce(_col(c), F.lit("")).rlike(ISIN_PATTERN)


def known_isin(code) -> Column:
    """Upper-case code unless it is malformed."""
    return F.when((code == CASH_ISIN) | is_isin(code), code)


def clean_isin(c) -> Column:
    """Upper-case ISIN; malformed ones become NULL, the cash mark stays."""
    return known_isin(F.upper(clean_text(c)))


def normal_ticker(c) -> Column:
    return blank_to_null(F.upper(strip(c)))


def base_ticker(c) -> Column:
    """Ticker without exchange: ``FCX US`` and ``FCX.N`` give ``FCX``."""
    plain = F.translate(normal_ticker(c), SPACES, " " * len(SPACES))
    first_word = F.substring_index(plain, " ", 1)
    return blank_to_null(F.substring_index(first_word, ".", 1))


def normal_name(c) -> Column:
    """Upper-case words of a company name without company-form words."""
    words = F.split(F.regexp_replace(F.upper(_col(c)), "[^A-Z0-9]+", " "), " ")
    kept = F.filter(words, lambda w: (w != "") & ~w.isin(COMPANY_FORM_WORDS))
    return blank_to_null(F.array_join(kept, " "))


def normal_country(c) -> Column:
    return blank_to_null(F.upper(strip(c)))


def contains_any(text, words) -> Column:
    """Whether text holds any of the words.

    A loop over a constant array: a chain of tests would generate methods too long to compile.
    """
    return bound(text, lambda whole: F.exists(
        F.lit(list(words)), lambda word: F.contains(whole, word)))


def search(query, fields) -> Column:
    """Row filter: the query's text occurs in the joined fields, in any case."""
    wanted = query.strip().lower()
    joined = F.concat_ws(" ", *[F.coalesce(_col(f).cast("string"), F.lit("")) for f in fields])
    return F.lower(joined).contains(wanted) if wanted else F.lit(True)
