"""Hard-negative mining with angular triangle filtering.

Every row stores its angles to a few reference directions. For two rows the angles to one reference
bound their own angle: it is at least the difference and at most the sum (or what the sum lacks to
a full turn). The tightest bounds of all references give an interval of cosines, and the norms make it an
interval of scores, widened by what rounding can lose. Integer inner products are computed only
for rows whose interval overlaps a window that is still wanted: first the scores that can be among
an anchor's best of its own label, then the windows of its positives, raised to the last
negative found so far. References only save work; any choice gives the same rows.

Anchors are compared with all rows in cells (block of anchors, group of rows). Each row is copied
once per block of ``anchors_per_block`` anchors and each anchor once per group of ``rows_per_group``
rows; a task streams the rows of a cell past its anchors and returns a bounded list per anchor. Cells are
dealt by row number, so labels or copies of any frequency are spread evenly.

References come from a bounded sample: of ``sample`` rows the ones farthest from each other.

Defined results: a row takes part if its label and vector are not null and all components finite;
a scaled vector longer than 2^31 takes no part either, as its scores would not fit a long. Rows
are told apart by their place, so repeated ids are rows of their own; "other rows" leaves out the
anchor's own row alone. Among equal scores a null id comes last. A null id is an anchor only if the
condition holds for it. Vectors of different lengths have no score. An anchor without positives, or a positive
without negatives in its window, gives no row. Other columns are ignored; an empty table gives an empty result.
"""

import dataclasses
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdrift.llm.tables import small_side, stored

CHUNK = 2048
LAST = np.iinfo(np.int64).max  # stands for a null id, which comes last
EXACT = 2.0 ** 53  # below it, sums of doubles that hold integers are exact


@dataclasses.dataclass(frozen=True)
class Mining:
    scale: int = 256
    positives: int = 5
    negatives: int = 10
    least_percent: int = 30
    most_percent: int = 90
    references: int = 32
    sample: int = 2048
    anchors_per_block: int = 8192
    rows_per_group: int = 32_768


def _scaled(column, scale):
    """Rows of one length each, as one matrix per length: (places, integer vectors as doubles)."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False))
    ends = np.concatenate([[0], np.cumsum(lengths)])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield at, values[(ends[at][:, None] + np.arange(length)).astype(np.int64)]


def _angles(vectors, norms, references):
    """Angles to the references; right angles for zero vectors and for another length."""
    if not len(references) or vectors.shape[1] != references.shape[1]:
        return np.full((len(vectors), len(references)), np.pi / 2, np.float32)
    cosines = (vectors @ references.T) / np.maximum(norms, 1)[:, None]
    return np.arccos(np.clip(cosines, -1, 1)).astype(np.float32)


def slack(length: int) -> float:
    """What a difference or sum of two stored angles can be wrong by, from rounding."""
    return 2 * (math.pi * 2.0 ** -23 + math.sqrt(8 * (length + 4) * 2.0 ** -53))


def reference_directions(rows: DataFrame, mining: Mining) -> np.ndarray:
    """Unit vectors: of a bounded sample, the rows that are farthest from each other."""
    sample = [np.array(r[0]) for r in rows.select("embedding").orderBy(F.xxhash64("embedding", "row_no"))
              .limit(mining.sample).collect()]
    sample = [np.floor(mining.scale * v) for v in sample]
    sample = [v / np.linalg.norm(v) for v in sample if np.isfinite(v).all() and 0 < np.linalg.norm(v) < 2.0 ** 31]
    if not sample:
        return np.zeros((0, 0))
    length = len(sample[0])
    vectors = np.stack([v for v in sample if len(v) == length])
    chosen = [0]
    nearest = vectors @ vectors[0]
    while len(chosen) < min(mining.references, len(vectors)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    return vectors[chosen]


def prepared(vectors: DataFrame, anchor: Column, mining: Mining) -> DataFrame:
    """Rows that take part: row_no, vec_id, label, anchor, packed integers, norm and angles; written once."""
    value = F.col("embedding").cast("array<double>")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), value.alias("embedding"),
                           F.coalesce(anchor, F.lit(False)).alias("anchor"))
            .filter(F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(finite)
            .withColumn("row_no", F.monotonically_increasing_id()))
    references = reference_directions(rows, mining)

    def describe(batches):
        for batch in batches:
            for at, scaled in _scaled(batch.column("embedding"), mining.scale):
                with np.errstate(over="ignore"):
                    norms = np.sqrt((scaled * scaled).sum(axis=1))
                kept = np.flatnonzero(norms < 2.0 ** 31)
                at, scaled, norms = at[kept], scaled[kept], norms[kept]
                angles = _angles(scaled, norms, references)
                near = angles.argmin(axis=1) if angles.size else np.zeros(len(at), np.int64)
                nearest = angles.min(axis=1) if angles.size else np.zeros(len(at), np.float32)
                index = pa.array(at, pa.int64())
                yield pa.record_batch(
                    [batch.column(name).take(index) for name in ("row_no", "vec_id", "label", "anchor")]
                    + [pa.array(near, pa.int64()), pa.array(nearest, pa.float32()), pa.array(norms, pa.float64()),
                       pa.array([v.tobytes() for v in scaled.astype("<i4")], pa.binary()),
                       pa.array([v.tobytes() for v in angles.astype("<f4")], pa.binary())],
                    names=["row_no", "vec_id", "label", "anchor", "near", "nearest", "norm", "vector", "angles"])

    return stored(rows.mapInArrow(
        describe, "row_no long, vec_id long, label long, anchor boolean, near long, nearest float, norm double, "
                  "vector binary, angles binary"))


def cells(rows: DataFrame, anchors: DataFrame, mining: Mining) -> DataFrame:
    """All rows and the anchors of each cell, cell after cell, anchors before rows.

    ``anchors`` has the columns of ``rows`` and ``wanted``, the scores of its positives.
    """
    counts = rows.agg(F.count("*"), F.count_if("anchor")).first()
    blocks = max(1, math.ceil(counts[1] / mining.anchors_per_block))
    groups = max(1, math.ceil(counts[0] / mining.rows_per_group))
    number = F.xxhash64("row_no")
    block, group = F.pmod(number, F.lit(blocks)), F.pmod(number, F.lit(groups))
    columns = ["row_no", "vec_id", "label", "near", "nearest", "norm", "vector", "angles", "wanted"]
    asked = anchors.select(
        block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
        F.lit(0).alias("kind"), *columns)
    other = rows.withColumn("wanted", F.lit(None).cast("array<long>")).select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), group.alias("group"),
        F.lit(1).alias("kind"), *columns)
    cell = (F.col("block") * groups + F.col("group")).cast("long").alias("cell")
    return (asked.select(cell, "kind", *columns).unionByName(other.select(cell, "kind", *columns))
            .repartition(blocks * groups, "cell")
            .sortWithinPartitions("cell", "kind", "label", "near", "nearest", "row_no"))


class _Rows:
    """Some rows of one cell with vectors of one length."""

    def __init__(self, batch, at, length):
        index = pa.array(at, pa.int64())
        take = lambda name: batch.column(name).take(index)
        self.numbers = take("row_no").to_numpy(zero_copy_only=False)
        self.ids = take("vec_id").fill_null(LAST).to_numpy(zero_copy_only=False)
        self.known = take("vec_id").is_valid().to_numpy(zero_copy_only=False)
        self.labels = take("label").to_numpy(zero_copy_only=False)
        self.norms = take("norm").to_numpy(zero_copy_only=False)
        data = b"".join(take("vector").to_pylist())
        self.vectors = np.frombuffer(data, "<i4").reshape(len(at), length).astype(np.float64)
        data = b"".join(take("angles").to_pylist())
        self.angles = np.frombuffer(data, "<f4").reshape(len(at), -1).astype(np.float64)
        self.wanted = take("wanted").to_pylist()
        self.length, self.slack = length, slack(length)
        self.longest = self.norms.max()

    def bounds(self, anchor, at):
        """Least and greatest score of the anchor with the rows, safe against rounding."""
        scale = anchor.norm * self.norms[at]
        spare = scale * 1e-9 + 1
        if not self.angles.shape[1]:
            return -scale - spare, scale + spare
        mine, theirs = anchor.angles, self.angles[at]
        nearest = np.abs(theirs - mine).max(axis=1) - self.slack
        sums = theirs + mine
        farthest = np.minimum(sums, 2 * np.pi - sums).min(axis=1) + self.slack
        return (scale * np.cos(np.minimum(farthest, np.pi)) - spare,
                scale * np.cos(np.maximum(nearest, 0)) + spare)

    def scores(self, anchor, at):
        vectors = self.vectors[at]
        if anchor.norm * self.longest < EXACT:
            return (vectors @ anchor.vector).astype(np.int64)
        return vectors.astype(np.int64) @ anchor.vector.astype(np.int64)


class _Best:
    """The best ``size`` rows so far: higher score, smaller id, smaller row number."""

    def __init__(self, size):
        self.size = size
        self.found = np.zeros((4, 0), np.int64)

    @property
    def least(self):
        """The score a further row has to reach; None while there is room."""
        return int(self.found[0, -1]) if self.found.shape[1] == self.size else None

    def add(self, scores, rows, at):
        if len(scores):
            joined = np.concatenate(
                [self.found, np.stack([scores, rows.ids[at], rows.numbers[at], rows.known[at]])], axis=1)
            order = np.lexsort((joined[2], joined[1], 1 - joined[3], -joined[0]))[:self.size]
            self.found = joined[:, order]


class _Anchor:
    def __init__(self, rows, k):
        self.number, self.label, self.length = int(rows.numbers[k]), rows.labels[k], rows.length
        self.norm, self.vector, self.angles = rows.norms[k], rows.vectors[k], rows.angles[k]
        self.wanted = rows.wanted[k]


class _Positives:
    """The best rows of the anchor's own label."""

    def __init__(self, anchor, mining):
        self.anchor, self.best = anchor, _Best(mining.positives)

    def see(self, rows):
        anchor = self.anchor
        first, last = np.searchsorted(rows.labels, [anchor.label, anchor.label + 1])
        at = np.arange(first, last)
        at = at[rows.numbers[at] != anchor.number]
        least = self.best.least
        if least is not None and len(at):
            at = at[rows.bounds(anchor, at)[1] >= least]
        if len(at):
            self.best.add(rows.scores(anchor, at), rows, at)

    def results(self):
        for score, vec_id, number, known in self.best.found.T.tolist():
            yield self.anchor.number, None, score, vec_id if known else None, number


class _Negatives:
    """The best rows of other labels in the window of each positive score."""

    def __init__(self, anchor, mining):
        self.anchor, self.windows = anchor, []
        for score in anchor.wanted:
            low, high = -(-mining.least_percent * score // 100), mining.most_percent * score // 100
            if low <= high:
                self.windows.append((score, low, high, _Best(mining.negatives)))

    def see(self, rows):
        anchor = self.anchor
        at = np.flatnonzero(rows.labels != anchor.label)
        if not self.windows or not len(at):
            return
        least, greatest = rows.bounds(anchor, at)
        lows = [low if best.least is None else max(low, best.least) for _, low, _, best in self.windows]
        open_ = np.zeros(len(at), bool)
        for (_, _, high, _), low in zip(self.windows, lows):
            open_ |= (greatest >= low) & (least <= high)
        at = at[open_]
        if len(at):
            scores = rows.scores(anchor, at)
            for (_, _, high, best), low in zip(self.windows, lows):
                inside = np.flatnonzero((scores >= low) & (scores <= high))
                best.add(scores[inside], rows, at[inside])

    def results(self):
        for wanted, _, _, best in self.windows:
            for score, vec_id, number, known in best.found.T.tolist():
                yield self.anchor.number, wanted, score, vec_id if known else None, number


FOUND = "anchor_no long, wanted long, score long, vec_id long, row_no long"


def _compared(dealt: DataFrame, kind, mining: Mining) -> DataFrame:
    """What ``kind`` finds in each cell for each of its anchors."""
    names = [field.split()[0] for field in FOUND.split(", ")]

    def batch_of(seekers):
        rows = [result for seeker in seekers for result in seeker.results()]
        columns = list(zip(*rows)) or [[]] * len(names)
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

    def compare(batches):
        cell, seekers = None, []
        for batch in batches:
            numbers = batch.column("cell").to_numpy(zero_copy_only=False)
            kinds = batch.column("kind").to_numpy(zero_copy_only=False)
            lengths = np.array([len(v) // 4 for v in batch.column("vector").to_pylist()], np.int64)
            changed = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1
            for start, end in zip([0, *changed], [*changed, len(numbers)]):
                if numbers[start] != cell:
                    if seekers:
                        yield batch_of(seekers)
                    cell, seekers = numbers[start], []
                for length in np.unique(lengths[start:end]):
                    same = start + np.flatnonzero(lengths[start:end] == length)
                    for k in range(0, len(same), CHUNK):
                        rows = _Rows(batch, same[k:k + CHUNK], int(length))
                        if kinds[start] == 0:
                            seekers += [kind(_Anchor(rows, i), mining) for i in range(len(rows.numbers))]
                        else:
                            for seeker in seekers:
                                if seeker.anchor.length == length:
                                    seeker.see(rows)
        if seekers:
            yield batch_of(seekers)

    return dealt.mapInArrow(compare, FOUND)


def _first(found: DataFrame, keys, size) -> DataFrame:
    """The best rows over all cells, numbered from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row_no")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def mined(vectors: DataFrame, anchor: Column, mining: Mining = Mining()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``vectors``: vec_id, embedding and label (a whole number). ``anchor``: a condition on their columns.
    """
    rows = prepared(vectors, anchor, mining)
    anchors = rows.filter("anchor")
    asked = anchors.withColumn("wanted", F.lit(None).cast("array<long>"))
    positives = stored(_first(_compared(cells(rows, asked, mining), _Positives, mining), ["anchor_no"],
                              mining.positives).drop("rank", "wanted"))
    wanted = positives.groupBy(F.col("anchor_no").alias("row_no")).agg(F.collect_set("score").alias("wanted"))
    asked = anchors.join(wanted, "row_no")
    negatives = _first(_compared(cells(rows, asked, mining), _Negatives, mining), ["anchor_no", "wanted"],
                       mining.negatives)
    names = small_side(anchors.select(F.col("row_no").alias("anchor_no"), F.col("vec_id").alias("anchor_id")))
    return (positives.select("anchor_no", F.col("score").alias("wanted"), F.col("vec_id").alias("positive_id"))
            .join(negatives.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}),
                  ["anchor_no", "wanted"])
            .join(names, "anchor_no")
            .select("anchor_id", "positive_id", "rank", "negative_id",
                    F.col("wanted").alias("positive_score"), "negative_score"))
