"""Quality rules on whole texts, and their divergence from the usual text of a language.

A word is a run of characters other than space and 0x09-0x0D. The base rules count words,
symbols, repeated lines and repeated windows of words. The divergence rule compares two
histograms of a document, over character classes and over the common words of its
language, with those of all documents of the language by the Jensen-Shannon distance.
Only DataFrame functions are used, and all counting happens within the row of a document.

Defined results: a null text has no words, so it fails the base rules. A null language has a
reference of its own. An empty table gives an empty result. Repeated rows are judged one by
one; other columns of the input are neither read nor returned.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdrift.llm.tables import small_side, stored

WHITE = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MARKS = r"[0-9.,;:!?'\"()\-]+"
CLASSES = ["capital", "mark", "symbol", "white", "beyond_ascii", "other"]


# The words whose shares are compared, by language: frequent function words.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as",
           "are", "be", "this", "by", "at", "from", "or", "an"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "est", "pour", "qui",
           "dans", "sur", "au", "par", "avec", "aux"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist",
           "im", "dem", "nicht", "ein", "eine", "als", "auch", "an", "aus"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no",
           "una", "su", "para", "es", "al", "lo", "como"],
}


@dataclass(frozen=True)
class Rules:
    """Thresholds of the rules.

    ``common_words``: the words of a language that form its word histogram, beside all others.
    ``class_distance``: the Jensen-Shannon distance (0 to 1) of characters above which a document is
    rejected. ``word_distance``: the same for words, as a share of the distance that a text without any
    common word has from its language. Both count only from a number of words on, since short
    texts diverge by chance. A language without common words is judged by characters only.
    """

    window: int = 8  # a power of two
    min_words: int = 20
    repeat_percent: int = 30
    common_words: dict = field(default_factory=lambda: COMMON_WORDS)
    min_words_for_distance: int = 50
    class_distance: float = 0.30
    min_words_for_word_distance: int = 100
    word_distance: float = 0.87


def _shorter_by(text: Column, pattern: str) -> Column:
    """How many characters of the text are in matches of the pattern."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def _repeated_words(hashes: Column, window: int) -> Column:
    """How many places are in a window whose hash occurs at least twice.

    The (hash, place) pairs are sorted, so equal windows are neighbours; the places of those,
    sorted again, each cover up to the next place or a whole window.
    """
    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def places(found):
        return F.sort_array(F.transform(
            F.filter(found, lambda p, i:
                     (F.get(found, i - 1)["h"] == p["h"]) | (F.get(found, i + 1)["h"] == p["h"])),
            lambda p: p["i"]))

    def covered(at):
        return F.aggregate(
            F.transform(at, lambda p, i: F.least(
                F.lit(window), F.coalesce(F.get(at, i + 1) - p, F.lit(window)))),
            F.lit(0), lambda total, x: total + x)

    # Each step is bound in a lambda, so that it is computed once and not per element.
    places_of = F.transform(F.array(F.sort_array(pairs)), places)
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes),
                  F.get(F.transform(places_of, covered), 0)).otherwise(0)


def _paired(hashes: Column, distance: int) -> Column:
    """Hashes of each element with the one ``distance`` places on: windows of twice the length."""
    n = F.size(hashes) - distance
    return F.transform(F.slice(hashes, F.lit(1), F.greatest(n, F.lit(0))),
                       lambda h, i: F.xxhash64(h, F.get(hashes, i + distance)))


def _common_counts(hashes: Column, lang: Column, rules: Rules) -> Column:
    """How often each common word of the language occurs; null without such words.

    The places of the words in the list are sorted behind one sentinel per place: where the
    sentinels stand tells how often each place occurs.
    """
    listed = F.lit(None).cast("array<bigint>")
    for name, words in rules.common_words.items():
        listed = F.when(lang == name, F.array(*[F.xxhash64(F.lit(w)) for w in words])).otherwise(listed)

    def counted(common):
        places = F.filter(F.transform(hashes, lambda h: F.array_position(common, h).cast("int")),
                          lambda place: place > 0)
        sentinels = F.sequence(F.lit(1), F.size(common) + 1)
        ends = F.transform(
            F.array(F.sort_array(F.concat(sentinels, places))),
            lambda codes: F.transform(sentinels, lambda c: F.array_position(codes, c)))
        return F.get(F.transform(ends, lambda e: F.transform(
            F.slice(e, F.lit(1), F.size(common)), lambda at, i: F.get(e, i + 1) - at - 1)), 0)

    return F.get(F.transform(F.array(listed), counted), 0)


def counts(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """All counts the rules need, one row per document, in one pass over the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = documents.select("doc_id", "lang", text.alias("text"), F.btrim(text, F.lit(WHITE)).alias("trimmed"))
    found = found.select(
        "doc_id", "lang", "text", F.when(F.col("trimmed") == "", F.array().cast("array<string>"))
        .otherwise(F.split("trimmed", GAP)).alias("words"))
    found = found.select(
        "doc_id", "lang", "text", F.split("text", "\n").alias("lines"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    # Windows of 2, 4 and 8 words: each hash combines two of the step before.
    done, length = [c for c in found.columns], 1
    found = found.withColumn("windows", F.col("hashes"))
    while length < rules.window:
        found = found.select(*done, _paired(F.col("windows"), length).alias("windows"))
        length *= 2
    n = F.size("hashes")
    repeated_lines = F.filter("lines", lambda l: l.rlike(r"[^\x20\x09-\x0D]"))
    lines = F.when(
        F.size(F.array_distinct("lines")) < F.size("lines"),
        F.get(F.transform(F.array(repeated_lines), lambda l: F.size(l) - F.size(F.array_distinct(l))), 0),
    ).otherwise(0)
    found = found.select(
        "doc_id", "lang", "word_chars", n.cast("long").alias("n_words"),
        _common_counts(F.col("hashes"), F.col("lang"), rules).alias("common_counts"),
        F.char_length("text").cast("long").alias("n_chars"),
        _shorter_by(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        lines.cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("windows"), rules.window).cast("long").alias("n_repeat_words"),
        _shorter_by(F.col("text"), "[A-Z]+").cast("long").alias("n_capital"),
        _shorter_by(F.col("text"), MARKS).cast("long").alias("n_mark"),
        _shorter_by(F.col("text"), r"[^\x00-\x7F]+").cast("long").alias("n_beyond_ascii"))
    white = F.col("n_chars") - F.col("word_chars")
    classes = [F.col("n_capital"), F.col("n_mark"), F.col("n_symbols"), white, F.col("n_beyond_ascii")]
    rest = F.col("n_chars") - sum(classes, F.lit(0))
    others = F.col("n_words") - F.aggregate("common_counts", F.lit(0).cast("long"), lambda a, x: a + x)
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))
    return found.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.array(*classes, rest).alias("class_counts"),
        F.concat("common_counts", F.array(others)).alias("word_counts"), failed.alias("base_failed"))


def language_references(counted: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per language: its shares of character classes and of common words, over all documents."""
    longest = 1 + max([len(words) for words in rules.common_words.values()], default=0)
    sizes = {"class_counts": len(CLASSES), "word_counts": longest}
    sums = counted.groupBy("lang").agg(*[
        F.array(*[F.coalesce(F.sum(F.get(name, F.lit(i))), F.lit(0)) for i in range(size)]).alias(name)
        for name, size in sizes.items()])
    return sums.select("lang", _shares(F.col("class_counts")).alias("class_shares"),
                       _shares(F.col("word_counts")).alias("word_shares"))


def jensen_shannon(p: Column, q: Column) -> Column:
    """The square root of the divergence in bits of two arrays of shares; 0 equal, 1 disjoint.

    Null if one of them is null.
    """
    def part(x, y):
        middle = (x + y) / 2
        return (F.when(x > 0, x * F.log2(x / middle)).otherwise(0.0)
                + F.when(y > 0, y * F.log2(y / middle)).otherwise(0.0))
    total = F.aggregate(F.zip_with(p, q, part), F.lit(0.0), lambda a, x: a + x)
    return F.when(total.isNotNull(), F.sqrt(F.greatest(total / 2, F.lit(0.0))))


def _shares(counts: Column) -> Column:
    """Shares of the total; null without any count."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.when(total > 0, F.transform(counts, lambda c: c.cast("double") / total))


def judged(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The counts, both distances, ``base_failed`` and ``kept`` of every document.

    A distance is null where the rule does not apply: no common words known, or no words.
    """
    counted = stored(counts(documents, rules))
    known = small_side(stored(language_references(counted, rules)))
    found = counted.join(known, counted["lang"].eqNullSafe(known["lang"]), "left").drop(known["lang"])
    usual = F.slice(F.col("word_shares"), F.lit(1), F.size("word_counts"))
    others = F.size("word_counts") - 1
    without = F.transform("word_counts", lambda _, i: F.when(i == others, 1.0).otherwise(0.0))
    found = found.select(
        "*",
        jensen_shannon(_shares(F.col("class_counts")), F.col("class_shares")).alias("class_distance"),
        jensen_shannon(_shares(F.col("word_counts")), usual).alias("word_distance"),
        jensen_shannon(without, usual).alias("distance_without"))
    far_classes = (F.col("n_words") >= rules.min_words_for_distance) & (
        F.coalesce("class_distance", F.lit(0.0)) > rules.class_distance)
    far_words = (F.col("n_words") >= rules.min_words_for_word_distance) & F.coalesce(
        F.col("word_distance") > rules.word_distance * F.col("distance_without"), F.lit(False))
    far = far_classes | far_words
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "class_distance", "word_distance",
        (~F.col("base_failed") & ~far).alias("kept"))
