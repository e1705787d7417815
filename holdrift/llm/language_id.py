"""Language identification by fusion of evidence.

A document has a text, perhaps a declared language (markup), and perhaps a host. The posterior of a
language is proportional to

    p(text | language) ** tempering  *  p(declared | language)  *  p(language | host)

- The text likelihood is that of hashed byte trigrams, from all documents that declare the language.
  One more class, ``und``, takes every bucket for equally likely: text of no known language.
- How far a declaration can be trusted is counted: which declarations go with which text.
- The prior of a host is smoothed towards its domain, that towards the address suffix, and that
  towards all documents; counts come from grouped aggregation, and a document's own text is
  left out of them, so that it does not count twice.

A document is kept if some known language reaches ``least_confidence``.

Defined results: a text without trigrams (null, empty, very short) has no evidence of its own; it is ``und``,
with confidence 0, and not kept. A null declaration or host is no evidence. Hosts without dots have no
suffix. Repeated rows are judged one by one, and a null id is only passed on. A blank declaration or host is
none. Every declared language is modelled, however many there are and however rarely it is declared. Without any declared
language every document is ``und``. An empty table gives an empty result. Extra columns
are kept by ``identified`` and otherwise ignored.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdrift.llm.memory import frugal
from holdrift.llm.tables import small_side, stored

BUCKETS = 1 << 15
UNKNOWN = "und"
LANGUAGES_AT_ONCE = 128  # whose likelihoods are looked up in one pass: 32 MB of logarithms
_COUNTED_LANGUAGES = 64  # that a task counts before it hands its counts on


@dataclass(frozen=True)
class Fusion:
    """``host_weight``: how many documents the prior of the next higher level counts for."""

    smoothing: float = 0.5
    tempering: float = 0.1
    host_weight: float = 20.0
    declared_smoothing: float = 1.0
    least_confidence: float = 0.5


@dataclass(frozen=True)
class Model:
    languages: tuple  # their names, ``und`` last
    counts: DataFrame  # language, bucket, n: a stored table
    smoothing: float

    def likelihoods(self, languages: tuple) -> np.ndarray:
        """log p(bucket | language) of some languages, a row per bucket."""
        place = {name: k for k, name in enumerate(languages)}
        table = self.counts.where(F.col("language").isin(list(languages))).toArrow()
        counts = np.zeros((BUCKETS, len(languages)))
        columns = [place[name] for name in table.column("language").to_pylist()]
        counts[table.column("bucket").to_numpy(), columns] = table.column("n").to_numpy()
        counts += self.smoothing
        return np.log(counts / counts.sum(axis=0))


def buckets_of(text) -> np.ndarray:
    """Buckets of the byte trigrams of a lower-cased text."""
    x = np.frombuffer((text or "").lower().encode(), np.uint8).astype(np.uint32)
    if len(x) < 3:
        return np.zeros(0, np.int64)
    grams = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return ((grams * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def fitted(evidence: DataFrame, fusion: Fusion = Fusion()) -> Model:
    """Trigram models of all declared languages, from all rows of ``evidence`` (text, declared).

    The counts stay a table; the driver learns the names of the languages only.
    """
    def handed_on(found):
        for language, counts in found.items():
            held = np.flatnonzero(counts)
            yield pa.record_batch([pa.array([language] * len(held), pa.string()), pa.array(held),
                                   pa.array(counts[held])], names=["language", "bucket", "n"])

    def count(batches):
        found = {}
        for batch in batches:
            for text, declared in zip(batch.column(0), batch.column(1).to_pylist()):
                if declared not in found and len(found) >= _COUNTED_LANGUAGES:
                    yield from handed_on(found)
                    found = {}
                counts = found.setdefault(declared, np.zeros(BUCKETS, np.int64))
                counts += np.bincount(buckets_of(text.as_py()), minlength=BUCKETS)
        yield from handed_on(found)

    declaring = evidence.select("text", given("declared").alias("declared")).where("declared IS NOT NULL")
    names = sorted(row[0] for row in declaring.select("declared").distinct().collect())
    counted = declaring.mapInArrow(frugal(count), "language string, bucket long, n long")
    counts = stored(counted.groupBy("language", "bucket").agg(F.sum("n").alias("n")))
    # A language called ``und`` is text of no known language.
    return Model((*[name for name in names if name != UNKNOWN], UNKNOWN),
                 counts.where(F.col("language") != UNKNOWN), fusion.smoothing)


def given(name: str) -> Column:
    """A column of names, null where blank."""
    return F.when(F.trim(F.col(name)) != "", F.col(name))


def with_likelihoods(rows: DataFrame, model: Model) -> DataFrame:
    """Adds ``likelihood``, log p(text | language) in the order of the model, to rows with a text; null
    without trigrams.

    More than ``LANGUAGES_AT_ONCE`` languages are looked up in several passes, each with its part of the model.
    """
    def looked_up(part):
        @F.pandas_udf("array<double>")
        def likelihood(texts: pd.Series) -> pd.Series:
            found = (buckets_of(text) for text in texts)
            return pd.Series([part.value[b].sum(axis=0) if len(b) else None for b in found], dtype="object")

        return likelihood(F.col("text"))

    context = rows.sparkSession.sparkContext
    rows = rows.withColumn("likelihood", F.array().cast("array<double>"))
    for start in range(0, len(model.languages), LANGUAGES_AT_ONCE):
        if start:
            rows = stored(rows)
        part = context.broadcast(model.likelihoods(model.languages[start:start + LANGUAGES_AT_ONCE]))
        rows = rows.withColumn("likelihood", F.concat("likelihood", looked_up(part)))
    return rows


def host_levels(host: Column) -> tuple:
    """Domain (last two labels) and address suffix (last label) of a host; no suffix without a dot."""
    labels = F.split(F.lower(host), r"\.")
    dotted = F.size(labels) > 1
    domain = F.when(dotted, F.concat_ws(".", F.element_at(labels, -2), F.element_at(labels, -1))).otherwise(
        F.lower(host))
    return domain, F.when(dotted, F.element_at(labels, -1))


def _best(scores: Column) -> Column:
    return F.array_position(scores, F.array_max(scores)).cast("int")


def _added(counts: DataFrame, size: int, *level: str) -> DataFrame:
    """Sums of ``n`` per best language, as the array ``counts``, for each group of ``level``.

    A group has a row per language at most before its array is made.
    """
    held = counts.groupBy(*level, "best").agg(F.sum("n").cast("double").alias("n")).groupBy(*level).agg(
        F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("held"))
    return held.select(*level, F.transform(
        F.sequence(F.lit(1), F.lit(size)), lambda k: F.coalesce(F.try_element_at("held", k), F.lit(0.0))).alias("counts"))


def evidence_counts(scored: DataFrame, model: Model) -> dict:
    """Counts of best languages by host level and by declaration, from all scored rows.

    Rows of a hot host combine before the shuffle; the higher levels add up the counts of hosts.
    """
    size = len(model.languages)
    domain, suffix = host_levels(F.col("host"))
    judged = scored.where("likelihood IS NOT NULL").select(
        F.lower("host").alias("host"), domain.alias("domain"), suffix.alias("suffix"), "declared",
        _best(F.col("likelihood")).alias("best"))
    per_host = stored(judged.groupBy("host", "domain", "suffix", "best").agg(F.count("*").alias("n")))
    per_declared = judged.groupBy("declared", "best").agg(F.count("*").alias("n"))
    found = {level: stored(_added(per_host.where(F.col(level).isNotNull()), size, level).withColumnRenamed(
        "counts", f"{level}_counts")) for level in ("host", "domain", "suffix")}
    found["declared"] = stored(_added(per_declared.where("declared IS NOT NULL"), size, "declared").withColumnRenamed(
        "counts", "declared_counts"))
    found["all"] = _added(per_host, size).first()["counts"]
    found["declarations"] = found["declared"].count()
    return found


def fused(scored: DataFrame, model: Model, counts: dict, fusion: Fusion = Fusion()) -> DataFrame:
    """Adds language, text_language, confidence and kept to rows with likelihood, host and declared."""
    size, columns = len(model.languages), scored.columns
    domain, suffix = host_levels(F.col("host"))
    rows = scored.withColumns({"domain": domain, "suffix": suffix, "host_key": F.lower("host"),
                               "best": F.coalesce(_best(F.col("likelihood")), F.lit(0))})
    for level in ("host", "domain", "suffix"):
        side = small_side(counts[level])
        key = rows["host_key"] if level == "host" else rows[level]
        rows = rows.join(side, key == side[level], "left").drop(side[level])
    side = small_side(counts["declared"])
    rows = rows.join(side, rows["declared"] == side["declared"], "left").drop(side["declared"])

    # A document's own text is taken out of every count.
    own = F.transform(F.sequence(F.lit(1), F.lit(size)), lambda k: F.when(F.col("best") == k, 1.0).otherwise(0.0))
    rows = rows.withColumn("own", own)

    def less_own(name):
        return F.zip_with(name, "own", lambda n, o: F.greatest(n - o, F.lit(0.0)))

    def total(values):
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    everything = F.array(*[F.lit(float(n)) for n in counts["all"]])
    rows = rows.withColumn("of_all", F.zip_with(everything, "own", lambda n, o: F.greatest(n - o, F.lit(0.0))))
    rows = rows.withColumn("prior", F.transform(
        "of_all", lambda n: (n + 1.0) / (total(F.col("of_all")) + size)))
    for level in ("suffix", "domain", "host"):
        rows = rows.withColumn("level", less_own(f"{level}_counts"))
        rows = rows.withColumn("prior", F.when(F.col("level").isNull(), F.col("prior")).otherwise(F.zip_with(
            "level", "prior", lambda n, p: (n + fusion.host_weight * p)
            / (total(F.col("level")) + fusion.host_weight))))
    b, kinds = fusion.declared_smoothing, max(counts["declarations"], 1)
    rows = rows.withColumn("trust", F.when(F.col("declared_counts").isNull(), F.array_repeat(F.lit(1.0), size))
                           .otherwise(F.zip_with(less_own("declared_counts"), "of_all",
                                                 lambda n, a: (n + b) / (a + b * kinds))))
    rows = rows.withColumn("score", F.zip_with(
        F.zip_with("likelihood", "prior", lambda x, p: x * fusion.tempering + F.log(p)), "trust",
        lambda x, t: x + F.log(t)))
    rows = rows.withColumn("weights", F.transform(
        "score", lambda x: F.exp(x - F.array_max("score"))))
    names = F.array(*[F.lit(name) for name in model.languages])
    none = F.col("likelihood").isNull()
    rows = rows.withColumns({
        "language": F.when(none, UNKNOWN).otherwise(F.get(names, _best(F.col("score")) - 1)),
        "text_language": F.when(none, UNKNOWN).otherwise(F.get(names, F.col("best") - 1)),
        "confidence": F.when(none, 0.0).otherwise(1.0 / total(F.col("weights"))),
    })
    kept = (F.col("language") != UNKNOWN) & (F.col("confidence") >= fusion.least_confidence)
    return rows.select(*columns, "language", "text_language", "confidence", kept.alias("kept"))


def judged(evidence: DataFrame, fusion: Fusion = Fusion()) -> DataFrame:
    """language, text_language, confidence and kept beside all columns of ``evidence`` but its text.

    ``evidence`` has text, declared and host; its texts are read once for the models and once to be scored.
    """
    evidence = evidence.withColumns({"declared": given("declared"), "host": given("host")})
    model = fitted(evidence, fusion)
    scored = stored(with_likelihoods(evidence, model).drop("text"))
    return fused(scored, model, evidence_counts(scored, model), fusion).drop("likelihood")


def identified(documents: DataFrame, fusion: Fusion = Fusion()) -> DataFrame:
    """The kept rows of ``documents`` with all their columns: lang is declared, source is the host."""
    rows = documents.select(F.struct("*").alias("row"), "text", given("lang").alias("declared"),
                            given("source").alias("host"))
    model = fitted(rows.select("text", "declared"), fusion)
    evidence = stored(with_likelihoods(rows.drop("row"), model).drop("text"))
    rows = with_likelihoods(rows, model).drop("text")
    return fused(rows, model, evidence_counts(evidence, model), fusion).where("kept").select("row.*")
