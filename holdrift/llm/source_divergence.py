"""Source divergence audit: how far the term distributions of sources are from each other.

Per language, the terms in enough documents are kept, and every group (language, source) and the
language itself give each kept term a smoothed share in fixed-point integers. The divergence of two groups
is the sum of the absolute differences of their shares over all kept terms, also those that neither has.

The sums are computed over a cube. A task owns a cell (group block, group block, term block) of one
language: it gets the slices (block of groups, block of terms) of both sides, lays them out as dense
matrices, where a term that a group lacks has the group's least share, and returns the partial
divergence of each pair of groups. Partial divergences are added up along the term axis. Each slice is copied
once per group block of its language; a cell holds about ``groups`` x 2 x ``terms`` shares, whatever the input.

Terms are counted in blocks of documents in the task that reads them, so that a frequent term or a hot source
reaches the shuffle as few rows; the shuffle key holds language, source and term, so no key is hot.

Defined results: null text, language or source are read as ''. Each row is one document, repeated or
not. A group without terms is a group like any other; a language without kept terms gives each pair 0. A
language of one source has no pairs. An empty table gives an empty result; other columns are ignored.
"""

import collections
import dataclasses
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdrift.llm.tables import small_side, stored

#: Everything but ASCII that is no letter; on UTF-8 bytes, whose bytes beyond ASCII are all in the class.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
BLOCK_ENTRIES = 200_000


@dataclasses.dataclass(frozen=True)
class Audit:
    least_documents: int = 30
    unit: int = 1_000_000_000
    smoothing: int = 5
    top: int = 50
    groups: int = 32
    terms: int = 4096


def term_counts(documents: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), n_docs; a row with a null term counts a group's documents."""
    def count(batches):
        counts = collections.defaultdict(lambda: (collections.Counter(), collections.Counter()))
        documents_of, seen = collections.Counter(), 0

        def rows():
            for (lang, source), n in documents_of.items():
                occurring, containing = counts[lang, source]
                yield pa.record_batch(
                    [pa.array([lang] * (len(occurring) + 1), pa.string()),
                     pa.array([source] * (len(occurring) + 1), pa.string()),
                     pa.array([None, *(t.decode() for t in occurring)], pa.string()),
                     pa.array([0, *occurring.values()], pa.int64()),
                     pa.array([n, *(containing[t] for t in occurring)], pa.int64())],
                    names=["lang", "source", "term", "n", "n_docs"])

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                found = TERM.findall((text.as_py() or "").encode().lower())
                occurring, containing = counts[lang, source]
                documents_of[lang, source] += 1
                before = len(occurring)
                occurring.update(found)
                containing.update(set(found))
                seen += len(occurring) - before
                if seen > BLOCK_ENTRIES:
                    yield from rows()
                    counts.clear()
                    documents_of.clear()
                    seen = 0
        yield from rows()

    named = documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    blocks = named.mapInArrow(count, "lang string, source string, term string, n long, n_docs long")
    return blocks.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def share(count, total, kept, audit: Audit):
    """The fixed-point share of a count among the kept terms; exact."""
    return F.expr(f"1 + (CAST({audit.unit} AS DECIMAL(38, 0)) * ({count} + {audit.smoothing})) "
                  f"div ({total} + {audit.smoothing} * {kept})")


def block_of(column, blocks):
    return F.pmod(F.xxhash64(column), blocks)


def numbered(df: DataFrame, keys, order, name) -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1)


@dataclasses.dataclass
class Shares:
    """Stored tables: kept terms per language, groups, and shares of what occurs."""

    terms: DataFrame
    groups: DataFrame
    occurring: DataFrame


def shares(documents: DataFrame, audit: Audit) -> Shares:
    counts = stored(term_counts(documents))
    kept = (counts.filter(F.col("term").isNotNull()).groupBy("lang", "term")
            .agg(F.sum("n").alias("n_lang"), F.sum("n_docs").alias("n_docs"))
            .filter(F.col("n_docs") >= audit.least_documents).drop("n_docs"))
    kept = stored(kept)
    totals = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n_lang").alias("total"))
    used = stored(counts.join(small_side(kept), ["lang", "term"]).drop("n_docs"))
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    groups = (counts.filter(F.col("term").isNull()).select("lang", "source")
              .join(sums, ["lang", "source"], "left").join(totals, "lang", "left")
              .select("lang", "source", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_group", "kept", "total"))))
    of_lang = groups.groupBy("lang").agg(F.count("*").alias("n_sources"))
    groups = groups.join(of_lang, "lang").select(
        "*", F.greatest(F.ceil(F.col("n_sources") / audit.groups), F.lit(1)).alias("group_blocks"),
        F.greatest(F.ceil(F.col("kept") / audit.terms), F.lit(1)).alias("term_blocks"))
    groups = groups.withColumn("group_block", block_of("source", F.col("group_blocks")))
    groups = numbered(groups, ["lang", "group_block"], "source", "group_no")
    # A language without kept terms has no share at all; 0 stands for it in cells of no width.
    groups = stored(groups.withColumn("least", F.when(F.col("kept") > 0, share("0", "n_group", "kept", audit)).otherwise(0)))
    terms = kept.join(small_side(stored(totals)), "lang").withColumn(
        "term_block", block_of("term", F.greatest(F.ceil(F.col("kept") / audit.terms), F.lit(1))))
    terms = stored(numbered(terms, ["lang", "term_block"], "term", "term_no")
                   .withColumn("q", share("n_lang", "total", "kept", audit)).drop("kept", "total"))
    occurring = (used.drop("n_lang").join(small_side(groups.select(
        "lang", "source", "n_group", "kept", "group_block", "group_blocks", "group_no")), ["lang", "source"])
        .join(small_side(terms.select("lang", "term", "q", "term_block", "term_no")), ["lang", "term"])
        .withColumn("p", share("n", "n_group", "kept", audit)))
    return Shares(terms, groups, stored(occurring.drop("n", "n_group", "kept")))


PARTS = "lang string, block_a long, block_b long, a int, b int, part long"


def partial_divergences(slices: DataFrame) -> DataFrame:
    """Per cell, the divergence of each pair of its groups over the cell's terms."""
    def cell(rows: pa.Table) -> pa.Table:
        column = {c: rows.column(c).to_numpy() for c in
                  ("block_a", "block_b", "block", "group_no", "term_no", "p")}
        sides = []
        for block in (column["block_a"][0], column["block_b"][0]):
            mine = column["block"] == block
            heads = mine & (column["term_no"] < 0)
            # The width of the cell stands in each head row, its least share in p.
            width = -1 - column["term_no"][heads][0]
            shares_of = np.empty((heads.sum(), width), np.int64)
            least = np.empty(heads.sum(), np.int64)
            least[column["group_no"][heads]] = column["p"][heads]
            shares_of[:] = least[:, None]
            body = mine & (column["term_no"] >= 0)
            shares_of[column["group_no"][body], column["term_no"][body]] = column["p"][body]
            sides.append(shares_of)
        first, second = sides
        same = column["block_a"][0] == column["block_b"][0]
        found = [(a, b, part) for a in range(len(first))
                 for b, part in enumerate(np.abs(second - first[a]).sum(axis=1).tolist()) if not same or a < b]
        a, b, part = zip(*found) if found else ((), (), ())
        n = len(found)
        return pa.table({
            "lang": pa.array([rows.column("lang")[0].as_py()] * n, pa.string()),
            "block_a": pa.array([column["block_a"][0]] * n, pa.int64()),
            "block_b": pa.array([column["block_b"][0]] * n, pa.int64()),
            "a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "part": pa.array(part, pa.int64())})

    return slices.groupBy("lang", "block_a", "block_b", "term_block").applyInArrow(cell, PARTS)


def divergences(found: Shares) -> DataFrame:
    """lang, source, other, value for both directions of every pair of sources of one language."""
    widths = found.terms.groupBy("lang", "term_block").agg(F.count("*").alias("width"))
    heads = (found.groups.select("lang", "group_block", "group_blocks", "group_no", F.col("least").alias("p"),
                                 F.explode(F.sequence(F.lit(0).cast("long"), F.col("term_blocks") - 1)).alias("term_block"))
             .join(widths, ["lang", "term_block"], "left")
             .withColumn("term_no", (-1 - F.coalesce("width", F.lit(0))).cast("int")))
    columns = ["lang", "group_block", "group_blocks", "term_block", "group_no", "term_no", "p"]
    slices = heads.select(*columns).unionByName(found.occurring.select(*columns)).select(
        "lang", "term_block", F.col("group_block").alias("block"), "group_no", "term_no", F.col("p").cast("long").alias("p"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("group_blocks") - 1)).alias("facing"))
    slices = slices.select(
        "lang", "term_block", "block", "group_no", "term_no", "p",
        F.least("block", "facing").alias("block_a"), F.greatest("block", "facing").alias("block_b"))
    # Where hashing left a block of groups empty, its cells have one side only and no pairs.
    taken = found.groups.select("lang", F.col("group_block")).distinct()
    for side in ("block_a", "block_b"):
        slices = slices.join(small_side(taken.withColumnRenamed("group_block", side)), ["lang", side], "left_semi")
    pairs = partial_divergences(slices).groupBy("lang", "block_a", "block_b", "a", "b").agg(F.sum("part").alias("value"))
    names = small_side(found.groups.select("lang", "group_block", "group_no", "source"))
    first = names.withColumnsRenamed({"group_block": "block_a", "group_no": "a", "source": "first"})
    second = names.withColumnsRenamed({"group_block": "block_b", "group_no": "b", "source": "second"})
    both = pairs.join(first, ["lang", "block_a", "a"]).join(second, ["lang", "block_b", "b"])
    sides = F.array(F.struct(F.col("first").alias("source"), F.col("second").alias("item")),
                    F.struct(F.col("second").alias("source"), F.col("first").alias("item")))
    return both.select("lang", "value", F.explode(sides).alias("side")).select("lang", "side.*", "value")


def ranked(df: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audited(documents: DataFrame, audit: Audit = Audit()) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: the divergence from every other source of the language. Part ``term``: the ``top`` terms
    whose share in the group exceeds that in the language the most.
    """
    found = shares(documents, audit)
    more = found.occurring.filter(F.col("p") > F.col("q")).select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).cast("long").alias("value"))
    return ranked(divergences(found), "pair").unionByName(
        ranked(more, "term").filter(F.col("rank") <= audit.top))
