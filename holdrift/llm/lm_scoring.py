"""Cross-entropy difference of matched n-gram models.

A target model (chosen documents) and a background model (all documents) share one vocabulary and one
smoothing, so that their losses differ by the text alone. The score of
a document is its mean loss per word under the target less that under the background: the lower,
the more the document resembles the target.

Both are word bigram models over all words and all word pairs of all documents, without a bound:
p(word | previous) is the share of the pair among the pairs of the previous word, smoothed towards
the frequency of the word. What a document has itself is taken out of all counts before it is scored, so that
a document of the target is judged like one that is not; only the vocabulary keeps its words.

The counts never reach the driver. Documents are held in blocks. A block counts its
words and pairs by key; the counts of blocks are added up in even ranges of the keys, as many as the input needs; and what
the other blocks have of its keys goes back to the block, which then scores its documents.

Words are runs other than space and 0x09-0x0D, A-Z lower-cased; words and pairs are held by 64-bit hashes.

Defined results: a text without words (null, empty, white) has no loss and no score (null). Without
target documents the target model is its smoothing alone. Rows are scored one by one, repeated ones
too; a null id is passed on. An empty table gives an empty result. Extra columns are ignored.
"""

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdrift.llm.shingles import WordHashes, pair_hashes, word_hashes
from holdrift.llm.tables import small_side, stored

SMOOTHING = 100.0  # how many words the word frequencies count for after each word
_SCORED_WORDS = 1_000_000  # of a block that is scored at once
_SCORED_TEXTS = 200_000
_RANGE_KEYS = 1_000_000  # of all blocks that are added up at once
_START, _WORD, _AFTER = (np.uint64(k) for k in (1, 2, 3))  # stand before a word like the hash of a word


def with_target(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """doc_id, text, and whether the id is among ``chosen`` (doc_id)."""
    ids = small_side(stored(chosen.where("doc_id IS NOT NULL").select("doc_id").distinct().withColumn(
        "target", F.lit(True))))
    return documents.select("doc_id", "text").join(ids, "doc_id", "left").select(
        "doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, all first bytes first."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(planes.tobytes(order="C"), "zstd", asbytes=True) if len(values) else b""


def unpacked(data: bytes, n: int, kind) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, n * size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind)[:, 0]


def blocks_of(texts: DataFrame) -> DataFrame:
    """Texts in stored blocks: ids, sizes and target flags of the documents, the distinct words from the most
    frequent on, and all words as places among those."""
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def gathered(batches):
        cache = WordHashes()
        ids, flags, parts, size = [], [], [], 0

        def block():
            words, codes, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            sizes = np.array([len(p) for p in parts])
            row = {"block": uuid.uuid4().int >> 65, "n_words": size, "n_target": int(sizes[np.array(flags)].sum()),
                   "n_distinct": len(words), "ids": ids, "sizes": sizes.tolist(), "flags": flags,
                   "words": packed(words[order]), "codes": packed(rank[codes])}
            kinds = [pa.int64()] * 4 + [pa.list_(id_kind), pa.list_(pa.int32()), pa.list_(pa.bool_()),
                                        pa.binary(), pa.binary()]
            return pa.record_batch([pa.array([v], kind) for v, kind in zip(row.values(), kinds)], names=list(row))

        for batch in batches:
            id_kind = batch.column(0).type
            for doc_id, text, target in zip(batch.column(0).to_pylist(), batch.column(1),
                                            batch.column(2).to_pylist()):
                ids.append(doc_id)
                flags.append(target)
                parts.append(word_hashes(text.as_py(), cache))
                size += len(parts[-1])
                if size >= _SCORED_WORDS or len(ids) >= _SCORED_TEXTS:
                    yield block()
                    ids, flags, parts, size = [], [], [], 0
        if ids:
            yield block()

    return stored(texts.select("doc_id", "text", "target").mapInArrow(
        gathered, f"block long, n_words long, n_target long, n_distinct long, ids array<{id_type}>, "
                  "sizes array<int>, flags array<boolean>, words binary, codes binary"))


@dataclass(frozen=True)
class Counted:
    """What a block counts: its words, what comes after each of them and after a start, and its pairs."""

    keys: np.ndarray
    counts: np.ndarray  # a row each for target and background
    sizes: np.ndarray
    n_distinct: int
    before: np.ndarray  # of each pair, as a place among the words; their number for a start
    word: np.ndarray  # of each pair
    pairs: np.ndarray  # of each word of the block, as a place among the pairs


def counted_block(row: dict) -> Counted:
    n, sizes = row["n_distinct"], np.array(row["sizes"], np.int64)
    words = unpacked(row["words"], n, np.uint64)
    codes = unpacked(row["codes"], row["n_words"], np.int32).astype(np.int64)
    before = np.append(n, codes[:-1])[:len(codes)]
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = n
    target = np.repeat(np.array(row["flags"], np.float64), sizes)
    distinct, pairs = np.unique(before * max(n, 1) + codes, return_inverse=True)
    first, second = np.divmod(distinct, max(n, 1))
    named = np.append(words, _START)
    keys = np.concatenate([pair_hashes(np.full(n, _WORD), words), pair_hashes(np.full(n + 1, _AFTER), named),
                           pair_hashes(named[first], words[second])])
    counts = np.array([np.concatenate([
        np.bincount(codes, weights, n), np.bincount(before, weights, n + 1), np.bincount(pairs, weights, len(distinct)),
    ]) for weights in (target, None)])
    return Counted(keys, counts, sizes, n, first, second, pairs)


def own_counts(owner: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each word, how often its document has what stands at its place."""
    if not len(place):
        return np.zeros(0)
    _, at, n = np.unique(owner * (int(place.max()) + 1) + place, return_inverse=True, return_counts=True)
    return n[at].astype(np.float64)


def counts_elsewhere(blocks: DataFrame, n_ranges: int) -> DataFrame:
    """(block, range, n, n_target, n_background, n_distinct): what the other blocks have of each key of a block.

    The numbers of a block stand in the order of its keys. ``n_distinct`` adds up to the number of distinct words.
    """
    def dealt(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = counted_block(row)
                order = np.argsort(found.keys)
                keys, counts = found.keys[order], found.counts[:, order].astype(np.int64)
                is_word = (order < found.n_distinct).view(np.uint8)
                at = ((keys >> np.uint64(32)) * np.uint64(n_ranges) >> np.uint64(32)).astype(np.int64)
                held, starts = np.unique(at, return_index=True)
                for k, start, stop in zip(held.tolist(), starts, np.append(starts[1:], len(at))):
                    part = slice(start, stop)
                    yield pa.record_batch(
                        [pa.array([k], pa.int32()), pa.array([row["block"]], pa.int64()),
                         pa.array([stop - start], pa.int32()),
                         *[pa.array([packed(x)], pa.binary()) for x in (
                             np.diff(keys[part], prepend=np.uint64(0)), is_word[part], *counts[:, part])]],
                        names=["range", "block", "n", "keys", "is_word", "n_target", "n_background"])

    def added(table):
        rows = table.to_pylist()

        def column(name, kind):
            return [unpacked(row[name], row["n"], kind) for row in rows]

        keys, place = np.unique(np.concatenate([np.cumsum(x) for x in column("keys", np.uint64)]),
                                return_inverse=True)
        n_distinct = len(np.unique(place[np.concatenate(column("is_word", np.uint8)) == 1]))
        ends = np.cumsum([row["n"] for row in rows])[:-1]
        others = []
        for name in ("n_target", "n_background"):
            own = np.concatenate(column(name, np.int64))
            every = np.bincount(place, own, len(keys)).astype(np.int64)
            others.append(pa.array([packed(x) for x in np.split(every[place] - own, ends)], pa.binary()))
        return pa.table([table.column("block"), table.column("range"), table.column("n"), *others,
                         pa.array([n_distinct] + [0] * (len(rows) - 1), pa.int64())],
                        names=["block", "range", "n", "n_target", "n_background", "n_distinct"])

    counted = blocks.select("block", "n_words", "n_distinct", "sizes", "flags", "words", "codes").mapInArrow(
        dealt, "range int, block long, n int, keys binary, is_word binary, n_target binary, n_background binary")
    return stored(counted.groupBy("range").applyInArrow(
        added, "block long, range int, n int, n_target binary, n_background binary, n_distinct long"))


def scored_by_all_pairs(texts: DataFrame, smoothing: float) -> DataFrame:
    """doc_id, n_words, loss_target, loss_background and their difference, from all words and pairs."""
    blocks = blocks_of(texts)
    totals = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_target", "n_words", "n_distinct")]).first()
    elsewhere = counts_elsewhere(blocks, (totals[1] + 2 * totals[2]) // _RANGE_KEYS + 1)
    n_distinct = elsewhere.agg(F.coalesce(F.sum("n_distinct"), F.lit(0))).first()[0]
    n_words = np.array(totals[:2], np.float64)

    def score(block, known):
        row = block.to_pylist()[0]
        found = counted_block(row)
        counts, n, order = found.counts, found.n_distinct, np.argsort(found.keys)
        parts = sorted(known.to_pylist(), key=lambda part: part["range"])
        for k, name in enumerate(("n_target", "n_background")):
            counts[k, order] += np.concatenate([unpacked(part[name], part["n"], np.int64) for part in parts])
        words, after, pairs = counts[:, :n], counts[:, n:2 * n + 1], counts[:, 2 * n + 1:]
        owner = np.repeat(np.arange(len(found.sizes)), found.sizes)
        before, word = found.before[found.pairs], found.word[found.pairs]
        own_word, own_after, own_pair = (own_counts(owner, place) for place in (word, before, found.pairs))
        own_words = found.sizes[owner].astype(np.float64)
        losses = np.zeros((2, len(owner)))
        for k, takes_part in enumerate((np.array(row["flags"], np.float64)[owner], 1.0)):
            frequency = (words[k, word] - takes_part * own_word + 1) / (
                n_words[k] - takes_part * own_words + n_distinct + 1)
            losses[k] = -np.log((pairs[k, found.pairs] - takes_part * own_pair + smoothing * frequency) / (
                after[k, before] - takes_part * own_after + smoothing))
        held = found.sizes > 0
        starts = (np.cumsum(found.sizes) - found.sizes)[held]
        means = np.zeros((2, len(held)))
        if len(starts):
            means[:, held] = np.add.reduceat(losses, starts, axis=1) / found.sizes[held]
        return pa.table(
            [pa.array(row["ids"], block.schema.field("ids").type.value_type), pa.array(found.sizes),
             pa.array(means[0], mask=~held), pa.array(means[1], mask=~held)],
            names=["doc_id", "n_words", "loss_target", "loss_background"])

    id_type = texts.schema["doc_id"].dataType.simpleString()
    found = blocks.select("block", "n_words", "n_distinct", "ids", "sizes", "flags", "words", "codes").groupBy(
        "block").cogroup(elsewhere.drop("n_distinct").groupBy("block")).applyInArrow(
            score, f"doc_id {id_type}, n_words long, loss_target double, loss_background double")
    return found.withColumn("difference", F.col("loss_target") - F.col("loss_background"))


def cross_entropy_difference(documents: DataFrame, chosen: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """Scores of all documents; the target model is trained on those with an id in ``chosen``."""
    return scored_by_all_pairs(with_target(documents, chosen), smoothing)
