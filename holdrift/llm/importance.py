"""Quality classifier by importance resampling.

Two generative models over hashed byte n-grams, one of target texts and one of all (raw) texts, give
each document a log importance ratio; Gumbel top-k then samples documents by weight. A word
equal to the one before is written as ``=`` first, so that repetition shows in the n-grams.

The ratio is taken per n-gram, so that length does not decide, and sharpened. How many are sampled
follows from labelled documents: as many as lie above the ratio that parts good from bad
labels at the least cost. The noise of a document comes from a hash of its id and the seed, so a
repeated task gives the same sample.

Defined results: a text without n-grams (null, empty, very short) has ratio 0. A null id has a noise
of its own; repeated rows have equal keys, and ties at the last place are all sampled. Without labels
of both kinds every document is sampled. Labels given twice count with the higher quality.
An empty table gives an empty result. Extra columns are kept by ``sampled`` and otherwise ignored.
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
_BINS = 1024


@dataclass(frozen=True)
class Sampling:
    """``smoothing``: counts added to every bucket. ``sharpness``: how much a difference of one in the
    log ratio per n-gram weighs against the noise. ``good_cost``: cost of rejecting a good
    document, where keeping a bad one costs 1."""

    smoothing: float = 0.1
    sharpness: float = 100.0
    good_cost: float = 4.0
    seed: int = 7


def buckets_of(text) -> np.ndarray:
    """Buckets of the three-byte grams of a text."""
    words = text.split() if text else []
    line = " ".join(["=" if a == b else a for a, b in zip(words, [None] + words[:-1])]).encode()
    x = np.frombuffer(line, np.uint8).astype(np.uint32)
    if len(x) < 3:
        return np.zeros(0, np.int64)
    grams = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return ((grams * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def labelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """text and quality (null without label) of every document."""
    known = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = small_side(stored(known.where("doc_id IS NOT NULL AND quality IS NOT NULL")))
    return documents.select("doc_id", "text").join(known, "doc_id", "left")


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n_target, n_raw) over all texts; those with quality 1 are the target."""
    def count(batches):
        target, raw = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text, quality in zip(batch.column(0), batch.column(1).to_pylist()):
                found = np.bincount(buckets_of(text.as_py()), minlength=BUCKETS)
                raw += found
                if quality == 1:
                    target += found
        held = np.flatnonzero(raw)
        yield pa.record_batch([pa.array(held), pa.array(target[held]), pa.array(raw[held])],
                              names=["bucket", "n_target", "n_raw"])

    counted = texts.select("text", "quality").mapInArrow(frugal(count), "bucket long, n_target long, n_raw long")
    return counted.groupBy("bucket").agg(F.sum("n_target").alias("n_target"), F.sum("n_raw").alias("n_raw"))


def log_ratios(counts: DataFrame, sampling: Sampling = Sampling()) -> np.ndarray:
    """log p(bucket | target) - log p(bucket | raw), one number per bucket."""
    both = np.zeros((2, BUCKETS))
    for row in counts.collect():  # at most BUCKETS rows
        both[:, row["bucket"]] = row["n_target"], row["n_raw"]
    both += sampling.smoothing
    shares = np.log(both / both.sum(axis=1, keepdims=True))
    return shares[0] - shares[1]


def ratio_of(text: Column, model: np.ndarray, spark) -> Column:
    """Mean log ratio per n-gram of a text."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def ratio(texts: pd.Series) -> pd.Series:
        found = (buckets_of(text) for text in texts)
        return pd.Series([shared.value[b].mean() if len(b) else 0.0 for b in found], dtype="float64")

    return ratio(text)


def best_cut(scores: DataFrame, sampling: Sampling = Sampling()):
    """The ratio that parts quality 1 from 0 at the least cost; None without both kinds of label.

    The labelled ratios are counted in bins, and the middle of the cheapest range of bins is taken.
    """
    known = scores.where("quality IN (0, 1)")
    low, high, kinds = known.agg(F.min("ratio"), F.max("ratio"), F.count_distinct("quality")).first()
    if kinds < 2 or low == high:
        return None
    at = F.least(F.floor((F.col("ratio") - low) / (high - low) * _BINS), F.lit(_BINS - 1))
    counts = np.zeros((2, _BINS))
    for row in known.groupBy(at.alias("at"), "quality").count().collect():  # at most 2 * _BINS rows
        counts[int(row["quality"]), row["at"]] = row["count"]
    lost = np.concatenate([[0], np.cumsum(counts[1])]) * sampling.good_cost
    cost = lost + counts[0].sum() - np.concatenate([[0], np.cumsum(counts[0])])
    cheapest = np.flatnonzero(cost == cost.min())
    return low + (cheapest[0] + cheapest[-1]) / 2 / _BINS * (high - low)


def gumbel_key(ratio: Column, doc_id: Column, sampling: Sampling = Sampling()) -> Column:
    """Sharpened ratio plus Gumbel noise from the hash of the id."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(sampling.seed), doc_id), 11)
    uniform = (bits + 0.5) / float(1 << 53)
    return ratio * sampling.sharpness - F.log(-F.log(uniform))


def kth_largest(keys: DataFrame, k: int):
    """The k-th largest ``key``, by counting in ever finer bins; None if there are not as many."""
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k > n or k < 1:
        return None
    above = 0
    while low < high:
        width = (high - low) / _BINS
        at = F.least(F.floor((F.col("key") - low) / width), F.lit(_BINS - 1))
        bins = keys.where((F.col("key") >= low) & (F.col("key") <= high)).groupBy(at.alias("at")).agg(
            F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
        for row in sorted(bins, key=lambda row: -row["at"]):  # at most _BINS rows
            if above + row["n"] >= k:
                low, high = row["low"], row["high"]
                break
            above += row["n"]
    return low


def model_of(documents: DataFrame, labels: DataFrame, sampling: Sampling = Sampling()) -> tuple:
    """(log ratios, key of the last sampled document): both small, from all documents."""
    texts = labelled(documents, labels)
    model = log_ratios(bucket_counts(texts), sampling)
    scores = stored(texts.select(
        "doc_id", "quality", ratio_of(F.col("text"), model, documents.sparkSession).alias("ratio")))
    cut = best_cut(scores, sampling)
    if cut is None:
        return model, None
    k = scores.where(F.col("ratio") >= cut).count()
    keys = scores.select(gumbel_key(F.col("ratio"), F.col("doc_id"), sampling).alias("key"))
    return model, kth_largest(keys, k) if k else float("inf")


def judged(documents: DataFrame, labels: DataFrame, sampling: Sampling = Sampling()) -> DataFrame:
    """doc_id, ratio, key and kept (sampled) of every document."""
    model, last = model_of(documents, labels, sampling)
    found = documents.select(
        "doc_id", ratio_of(F.col("text"), model, documents.sparkSession).alias("ratio"))
    found = found.withColumn("key", gumbel_key(F.col("ratio"), F.col("doc_id"), sampling))
    return found.withColumn("kept", F.lit(True) if last is None else F.col("key") >= last)


def sampled(documents: DataFrame, labels: DataFrame, sampling: Sampling = Sampling()) -> DataFrame:
    """The sampled rows of ``documents`` with all their columns."""
    model, last = model_of(documents, labels, sampling)
    if last is None:
        return documents
    ratio = ratio_of(F.col("text"), model, documents.sparkSession)
    return documents.where(gumbel_key(ratio, F.col("doc_id"), sampling) >= last)
