"""Benchmark decontamination by a distributed positional inverted index.

The index holds one row (row, term, place) for every document word that occurs in some test phrase,
written once as Parquet, and one head row per document row with its id and number of words.
Phrases are found within a row, whatever ids repeat or are null.
A phrase is found by intersecting lists of places shifted by the offset of the term in the
phrase: the list of its rarest term gives candidate starts, the lists of the next rarest
thin them out, and the remaining terms confirm the survivors. Proximity matches use the
same lists with a distance in place of equality. Only DataFrame functions are used; no
group of postings, of a term or of an item, meets in one task.

Words are runs of ASCII letters (A-Z lower-cased), digits and characters beyond ASCII.

Defined results: a null or empty text has no words, an item without words has no phrases.
Ids are only passed on: rows with a repeated or null doc_id come back one by one, each with
its own words, hits and items. Repeated items and phrases count once. Empty tables give no hits. Only id and text columns are read.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdrift.llm.tables import small_side, stored

HEAD = -1  # the term of head rows; their place is the number of words
_NOT_WORD = [chr(c) for c in (*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))]
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Phrases:
    """Phrases of test items: their terms, the vocabulary, and the items they come from."""

    terms: DataFrame  # phrase, offset, term, n_terms
    vocabulary: DataFrame  # word, term
    items: DataFrame  # phrase, item_id


def words(text: Column) -> Column:
    """The words of a text in order."""
    text = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    trimmed = F.btrim(lowered, F.lit("".join(_NOT_WORD)))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _GAP))


def phrases_of(items: DataFrame, length: int = 10) -> Phrases:
    """Every run of ``length`` words of an item; an item of fewer words is one phrase."""
    split = items.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    runs = split.select("item_id", F.size("words").alias("n"), "words").select(
        "item_id", "words", F.explode(F.sequence(
            F.lit(1), F.greatest(F.col("n") - (length - 1), F.lit(1)))).alias("at"))
    runs = stored(runs.select("item_id", F.slice("words", F.col("at"), length).alias("run")).distinct())
    # Ids are given while the table is written, so they do not change when it is read again.
    distinct = stored(runs.select("run").distinct().withColumn("phrase", F.monotonically_increasing_id()))
    vocabulary = stored(
        distinct.select(F.explode("run").alias("word")).distinct()
        .withColumn("term", F.monotonically_increasing_id())
        .unionByName(items.sparkSession.createDataFrame([("", HEAD)], "word string, term long")))
    places = distinct.select("phrase", F.size("run").alias("n_terms"), F.posexplode("run").alias("offset", "word"))
    terms = places.join(vocabulary, "word").select("phrase", "offset", "term", "n_terms")
    return Phrases(stored(terms), vocabulary, stored(runs.join(distinct, "run").select("phrase", "item_id")))


def build_index(documents: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Postings (row, term, place) of all document words in the vocabulary, and the head rows, with doc_id.

    An empty word behind the last one carries the number of words, so the texts are read once.
    Rows are numbered while the index is written, so their numbers do not change when it is read again.
    """
    with_head = F.concat(words(F.col("text")), F.array(F.lit("")))
    rows = documents.select("doc_id", F.monotonically_increasing_id().alias("row"), with_head.alias("words"))
    places = rows.select("doc_id", "row", F.posexplode("words").alias("place", "word"))
    return stored(places.join(small_side(vocabulary), "word").select(
        F.when(F.col("term") == HEAD, F.col("doc_id")).alias("doc_id"), "row", "term", "place"))


def by_rarity(index: DataFrame, phrases: Phrases) -> DataFrame:
    """Terms of the phrases that can occur at all, with their rank from the rarest term on."""
    frequency = index.where(F.col("term") != HEAD).groupBy("term").agg(F.count("*").alias("frequency"))
    known = phrases.terms.join(frequency, "term")
    complete = Window.partitionBy("phrase")
    ranked = known.select(
        "phrase", "offset", "term", "n_terms", F.count("*").over(complete).alias("n_known"),
        F.row_number().over(complete.orderBy("frequency", "offset")).alias("rank"))
    return stored(ranked.where("n_known = n_terms").drop("n_known"))


def _same(left: DataFrame, right: DataFrame, *columns: str) -> Column:
    found = left["row"] == right["row"]
    for column in columns:
        found = found & (left[column] == right[column])
    return found


def _named(matches: DataFrame, index: DataFrame) -> DataFrame:
    """Adds the doc_id of the rows of ``matches``."""
    return matches.join(index.where(F.col("term") == HEAD).select("row", "doc_id"), "row")


def phrase_matches(index: DataFrame, phrases: Phrases, lists: int = 3) -> DataFrame:
    """Distinct (row, doc_id, phrase, start, n_terms) of all exact matches.

    ``lists`` terms of a phrase are intersected one after the other, the others at once.
    """
    terms = by_rarity(index, phrases)
    rarest = small_side(stored(terms.where("rank = 1")))
    found = index.join(rarest, "term").select(
        "row", "phrase", (F.col("place") - F.col("offset")).alias("start"), "n_terms")
    found = found.where("start >= 0").distinct()
    for rank in range(2, lists + 1):
        # A phrase of fewer terms has its last one looked up again.
        this = small_side(stored(terms.where(F.col("rank") == F.least(F.lit(rank), F.col("n_terms")))))
        wanted = found.join(this.drop("n_terms", "rank"), "phrase").withColumn(
            "place", F.col("start") + F.col("offset"))
        listed = index.join(small_side(stored(this.select("term").distinct())), "term", "left_semi")
        found = wanted.join(listed, _same(wanted, listed, "term", "place"), "left_semi")
        found = found.select("row", "phrase", "start", "n_terms")
    found = stored(found)
    others = small_side(stored(terms.where(F.col("rank") > lists).select("phrase", "offset", "term")))
    wanted = found.where(F.col("n_terms") > lists).join(others, "phrase").withColumn(
        "place", F.col("start") + F.col("offset"))
    ids = small_side(stored(found.where(F.col("n_terms") > lists).select("row").distinct()))
    listed = index.join(ids, "row", "left_semi")
    confirmed = wanted.join(listed, _same(wanted, listed, "term", "place"), "left_semi")
    confirmed = confirmed.groupBy("row", "phrase", "start", "n_terms").agg(F.count("*").alias("n"))
    return _named(found.where(F.col("n_terms") <= lists).unionByName(
        confirmed.where(F.col("n") == F.col("n_terms") - lists).drop("n")), index)


def proximity_matches(index: DataFrame, phrases: Phrases, distance: int) -> DataFrame:
    """(row, doc_id, phrase, place): every other term lies within ``distance`` words of the rarest.

    ``place`` is where the rarest term stands. Places are joined by blocks of ``distance`` words.
    """
    terms = by_rarity(index, phrases)
    rarest = small_side(stored(terms.where("rank = 1").select("phrase", "term", "n_terms")))
    anchors = stored(index.join(rarest, "term").select("row", "phrase", "place", "n_terms"))
    others = small_side(stored(terms.where("rank > 1").select("phrase", "offset", "term")))
    wanted = anchors.join(others, "phrase").select(
        "row", "phrase", F.col("place").alias("anchor"), "n_terms", "offset", "term",
        F.explode(F.array(*[F.floor(F.col("place") / distance) + k for k in (-1, 0, 1)])).alias("block"))
    listed = index.join(small_side(stored(others.select("term").distinct())), "term", "left_semi").withColumn(
        "block", F.floor(F.col("place") / distance))
    near = wanted.join(listed, _same(wanted, listed, "term", "block")
                       & (F.abs(wanted["anchor"] - listed["place"]) <= distance)
                       & (wanted["anchor"] != listed["place"]), "left_semi")
    complete = near.groupBy("row", "phrase", "anchor", "n_terms").agg(
        F.count_distinct("offset").alias("n")).where(F.col("n") == F.col("n_terms") - 1)
    alone = anchors.where("n_terms = 1").select("row", "phrase", "place")
    return _named(
        complete.select("row", "phrase", F.col("anchor").alias("place")).unionByName(alone).distinct(), index)


def words_hit(matches: DataFrame) -> DataFrame:
    """(row, n_hit): how many words of a document row lie inside some match."""
    spans = matches.select("row", "start", (F.col("start") + F.col("n_terms")).alias("end")).distinct()
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    new = spans.select("row", F.greatest(F.col("end") - F.greatest("start", reached), F.lit(0)).alias("new"))
    return new.groupBy("row").agg(F.sum("new").cast("long").alias("n_hit"))


def decontaminated(documents: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids (sorted strings) and contaminated of every document row.

    Hits are kept by row to the end, so no row answers for another of its id.
    """
    phrases = phrases_of(items, length)
    index = build_index(documents, phrases.vocabulary)
    matches = stored(phrase_matches(index, phrases))
    items_hit = matches.select("row", "phrase").distinct().join(phrases.items, "phrase").select(
        "row", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id")).distinct()
    listed = items_hit.groupBy("row").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    heads = index.where(F.col("term") == HEAD).select("row", "doc_id", F.col("place").cast("long").alias("n_words"))
    return heads.join(words_hit(matches).join(listed, "row"), "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def rows_of_clean_texts(documents: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """The rows of ``documents`` whose own text has no hit, with all their columns, whatever their ids."""
    key = F.unhex(F.sha2("text", 256))
    found = decontaminated(documents.select(key.alias("doc_id"), "text"), items, length)
    hit = small_side(stored(found.where("contaminated").select(F.col("doc_id").alias("hit_text")).distinct()))
    return documents.join(hit, key == hit["hit_text"], "left_anti")
