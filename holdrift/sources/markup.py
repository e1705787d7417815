"""Elements and texts of HTML, taken apart by column expressions."""

from html.entities import html5
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from holdrift.functions.text import bound, strip

_REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?"
_LARGEST = 0x10FFFF
_REPLACEMENT = "�"


def _named() -> Column:
    """All character names of HTML without their semicolon, as a map that is folded to a constant."""
    known = {name.rstrip(";"): value for name, value in html5.items()}
    return F.from_json(F.lit(json.dumps(known)), "map<string,string>")


def _windows_characters() -> Column:
    """What the numbers 0x80 to 0x9F stand for on web pages; undefined ones for themselves."""
    return F.array(*[F.lit(bytes([n]).decode("cp1252", "ignore") or chr(n)) for n in range(0x80, 0xA0)])


def _character(number) -> Column:
    """The character of a number; zero, surrogates and numbers that are too large have a stand-in."""
    wrong = (number <= 0) | (number > _LARGEST) | number.between(0xD800, 0xDFFF)
    return (
        F.when(wrong, _REPLACEMENT)
        .when(number.between(0x80, 0x9F), F.get(_windows_characters(), (number - 0x80).cast("int")))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
    )


def _resolved(reference) -> Column:
    """The text a character reference stands for; an unknown name stands for itself."""
    body = F.rtrim(F.substring(reference, 2, 1 << 30), F.lit(";"))
    digits = F.ltrim(F.regexp_replace(body, "^#[xX]?", ""), F.lit("0"))
    is_hex, is_number = F.lower(F.substring(body, 1, 2)) == "#x", body.startswith("#")
    number = F.when(F.length(digits) > 7, F.lit(_LARGEST + 1)).when(digits == "", F.lit(0)).when(
        is_hex, F.conv(digits, 16, 10).cast("long")).otherwise(F.try_to_number(digits, F.lit("9999999")))
    return F.when(is_number, bound(number.cast("long"), _character)).otherwise(
        F.coalesce(F.try_element_at(_named(), body), reference))


def unescaped(text) -> Column:
    """Text with all character references resolved in one pass, with or without a semicolon."""
    def joined(pieces):
        found = F.concat(F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)), _resolved),
                         F.array(F.lit("")))
        return F.array_join(F.zip_with(pieces, found, lambda piece, mark: F.concat(piece, mark)), "")

    return F.when(F.contains(text, F.lit("&")), bound(F.split(text, _REFERENCE), joined)).otherwise(text)


def element_text(markup) -> Column:
    """Text of an element: each piece between tags stripped, then joined."""
    pieces = F.split(F.regexp_replace(markup, "(?s)<!--.*?-->", ""), "<[^>]*>")
    return F.array_join(F.transform(pieces, lambda piece: strip(unescaped(piece))), "")


def page_text(page) -> Column:
    """Visible text of a page, pieces separated by spaces."""
    visible = F.regexp_replace(
        page, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "")
    return unescaped(F.regexp_replace(visible, "<[^>]*>", " "))


#: How many marks are gathered before they join those found so far; keeps appending cheap on long pages.
_CHUNK = 256


def _pattern(tag) -> str:
    return rf"(?is)<{tag}(?=[\s/>])[^>]*>|</{tag}\s*>"


def _opens(mark) -> Column:
    return ~mark.startswith("</")


def is_nested(marks) -> Column:
    """Whether two openings follow each other, or the last mark is one: then a pattern cannot pair them."""
    return F.exists(F.sequence(F.lit(0), F.size(marks)), lambda i: F.coalesce(
        _opens(F.get(marks, i)) & F.coalesce(_opens(F.get(marks, i + 1)), F.lit(True)), F.lit(False)))


def tags(markup, tag) -> Column:
    """All opening and closing marks of an element, in their order."""
    return F.regexp_extract_all(markup, F.lit(_pattern(tag)), F.lit(0))


def spans(markup, tag) -> Column:
    """Where the content of every ``tag`` element starts and ends, in characters, in the order of the starts.

    One pass over the marks tells how many elements are open at each. Among the marks of one depth
    openings and closings take turns, so after sorting by depth an opening's closing is the next mark. An
    element that is not closed reaches to the end; a closing without an opening counts for nothing.
    """
    def found(marks, pieces):
        items = F.transform(marks, lambda mark, i: F.struct(
            F.length(F.get(pieces, i)).alias("gap"), F.length(mark).alias("size"), _opens(mark).alias("opens")))
        none = F.filter(F.array(F.struct(
            F.lit(0).alias("depth"), F.lit(0).alias("start"), F.lit(0).alias("stop"), F.lit(True).alias("opens"))),
            lambda _: F.lit(False))

        def state(depth, at, marks_so_far):
            return F.struct(depth.alias("depth"), at.alias("at"), marks_so_far.alias("marks"))

        def step(before, item):
            start = before["at"] + item["gap"]
            depth = F.when(item["opens"], before["depth"] + 1).otherwise(F.greatest(before["depth"] - 1, F.lit(0)))
            mark = F.struct(F.greatest(depth, before["depth"]).alias("depth"), start.alias("start"),
                            (start + item["size"]).alias("stop"), item["opens"].alias("opens"))
            return state(depth, start + item["size"], F.array_append(before["marks"], mark))

        def chunk(all_items):
            return lambda before, first: bound(
                F.aggregate(F.slice(all_items, first, F.lit(_CHUNK)), state(before["depth"], before["at"], none), step),
                lambda after: state(after["depth"], after["at"], F.concat(before["marks"], after["marks"])))

        firsts = F.sequence(F.lit(1), F.greatest(F.size(marks), F.lit(1)), F.lit(_CHUNK))
        passed = bound(items, lambda known: F.aggregate(firsts, state(F.lit(0), F.lit(0), none), chunk(known)))
        return bound(F.sort_array(passed["marks"]), paired)

    def paired(marks):
        both = F.transform(marks, lambda mark, i: F.struct(
            mark["stop"].alias("start"), F.when(
                (F.get(marks, i + 1)["depth"] == mark["depth"]) & ~F.get(marks, i + 1)["opens"],
                F.get(marks, i + 1)["start"]).otherwise(F.length(markup)).alias("stop"),
            mark["opens"].alias("opens")))
        return F.sort_array(F.filter(both, lambda span: span["opens"]))

    return bound(tags(markup, tag), lambda marks: bound(
        F.split(markup, _pattern(tag)), lambda pieces: found(marks, pieces)))


def _content(markup, start, stop) -> Column:
    return F.substring(markup, start + 1, stop - start)


def elements(markup, tag) -> Column:
    """What stands inside every ``tag`` element, in the order of their start, nested ones too.

    An element that is not closed reaches to the end.
    """
    flat = F.regexp_extract_all(
        markup, F.lit(rf"(?is)<{tag}(?=[\s/>])[^>]*>(.*?)</{tag}\s*>"), F.lit(1))
    nested = F.transform(spans(markup, tag), lambda span: _content(markup, span["start"], span["stop"]))
    return F.when(bound(tags(markup, tag), is_nested), nested).otherwise(flat)


def _places_up_to(sorted_places, value) -> Column:
    """How many of some sorted places are not beyond a value, by halving."""
    def halved(s, _):
        middle = F.shiftright(s["low"] + s["high"], 1)
        return F.when(s["low"] >= s["high"], s).when(
            F.get(sorted_places, middle) <= value,
            F.struct((middle + 1).alias("low"), s["high"].alias("high"))).otherwise(
            F.struct(s["low"].alias("low"), middle.alias("high")))

    zero = F.struct(F.lit(0).alias("low"), F.size(sorted_places).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(32)), zero, halved)["low"]


def rows_of_cells(table, n_cells) -> Column:
    """Cell texts of a table's rows that have exactly ``n_cells`` cells; nested rows and cells count too.

    Where cells or rows are left open, cells are first counted by their places, so that only
    the texts of wanted rows are taken out: an open cell holds all the rest of its row.
    """
    flat = F.filter(F.transform(elements(table, "tr"), lambda row: F.transform(elements(row, "td"), element_text)),
                    lambda row: F.size(row) == n_cells)

    def picked(rows, cells):
        starts = F.transform(cells, lambda cell: cell["start"])
        placed = bound(starts, lambda known: F.transform(rows, lambda row: F.struct(
            row["stop"].alias("stop"), _places_up_to(known, row["start"]).alias("first"),
            _places_up_to(known, row["stop"]).alias("last"))))
        wanted = F.filter(placed, lambda row: row["last"] - row["first"] == n_cells)
        return F.transform(wanted, lambda row: F.transform(
            F.slice(cells, row["first"] + 1, row["last"] - row["first"]),
            lambda cell: element_text(_content(table, cell["start"], F.least(cell["stop"], row["stop"])))))

    open_ = bound(tags(table, "tr"), is_nested) | bound(tags(table, "td"), is_nested)
    by_place = bound(spans(table, "tr"), lambda rows: bound(spans(table, "td"), lambda cells: picked(rows, cells)))
    return F.when(open_, by_place).otherwise(flat)
