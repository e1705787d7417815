"""Delimited text of a whole document, taken apart with column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from holdrift.functions.text import bound, strip

# A field is quoted (doubled quotes inside, line breaks allowed), plain, or empty.
_FIELD = r'"[^"]*+(?:""[^"]*+)*+(?:"[^,\n]*+|\z)|[^",\n][^,\n]*+|'
_RECORD = f"(?:{_FIELD})(?:,(?:{_FIELD}))*+"
_QUOTED = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"?(.*)$'


def _all(text, pattern, group) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def plain_lines(text) -> Column:
    """Text with every kind of line end written as one line feed."""
    return F.regexp_replace(text, r"\r\n|[\r\x0b\f\x1c-\x1e\u0085\u2028\u2029]", "\n")


def header_line(lines, words) -> Column:
    """Number of the first line that holds all words in any case, from 1; 0 if none does."""
    found = F.transform(
        lines, lambda line: F.forall(words, lambda word: F.contains(F.lower(line), word)))
    return F.array_position(found, True)


def text_from_line(lines, number) -> Column:
    return F.array_join(F.slice(lines, number, F.size(lines)), "\n")


def _unquoted(field) -> Column:
    inner = F.replace(F.regexp_extract(field, _QUOTED, 1), F.lit('""'), F.lit('"'))
    return F.when(field.startswith('"'), F.concat(inner, F.regexp_extract(field, _QUOTED, 2))
                  ).otherwise(field)


def records(text) -> Column:
    """All records as arrays of fields; empty lines are no records."""
    found = F.filter(_all(text, _RECORD, 0), lambda record: record != "")
    return F.transform(found, lambda record: F.transform(
        _all(F.concat(F.lit(","), record), f",({_FIELD})", 1), _unquoted))


def header_names(header) -> Column:
    return F.transform(header, lambda name: F.lower(strip(name)))


def column_position(names, aliases, loose) -> Column:
    """Place (from 0) of the column that an alias names, NULL if none.

    Aliases are tried in order for an equal name, then, if ``loose``, for a name that
    holds them. Of columns with the same name the last one counts.
    """
    equal = F.get(F.filter(aliases, lambda a: F.array_contains(names, a)), F.lit(0))
    holding = F.get(F.flatten(F.transform(
        aliases, lambda a: F.filter(names, lambda n: F.contains(n, a)))), F.lit(0))
    return bound(F.coalesce(equal, F.when(loose, holding)), lambda name: F.when(
        name.isNotNull(), F.size(names) - F.array_position(F.reverse(names), name)).cast("int"))


def has_text(fields, width) -> Column:
    """Whether any of the named fields of a record holds text."""
    return F.exists(F.slice(fields, 1, width), lambda field: strip(field) != "")
