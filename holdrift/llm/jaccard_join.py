"""N-gram Jaccard join by a token-group matrix.

Documents are sets of word shingles; two are linked when their Jaccard similarity reaches a
percentage. Equal sets are one class from the start, so copies never meet each other.

- Tokens have one order for all: cold before hot, then by hash. The prefix of a set holds so many of
  its first tokens that two similar sets share a twentieth of the smaller one in their prefixes.
  A passage that unrelated documents share seldom reaches that.
- Similar classes form groups: those whose most held prefix token is the same, so that a family falls into few
  groups, of at most about ``GROUP_SIZE`` each; a larger group is dealt out, and all parts get the class that shares most as a guest.
- Within a group all links are found in one task, from a matrix of members and tokens. The guest connects the
  parts of a large group of near copies without comparing them with each other.
- The token-group matrix holds the union of the prefix tokens of each group. The overlap of a class with that
  union bounds its overlap with every member. Only groups that hold a class not connected yet, and whose bound
  is high enough, are opened and compared in full. Of two components the smaller one asks.

So every link between different sets is either found or lies inside a component already; the
components are exact. Which tokens are hot changes the work, not the result.

Defined results: a document without words (null, empty, white) has no shingles, is linked with
nothing and is its own component. Rows with a null doc_id are compared like others; a
component of such rows only has no id. Repeated rows and ids are separate rows of one class or of
several. An empty table gives an empty result. Extra columns are ignored.
Shingles are compared by 64-bit hashes.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdrift.llm import shingles
from holdrift.llm.components import components
from holdrift.llm.memory import frugal
from holdrift.llm.tables import small_side, stored

LEAST_SHARED = 3
SHARED_PART = 20  # linked sets have a twentieth of the smaller set in common in their prefixes
GROUP_SIZE = 512
HOT_TOKENS = 1 << 18  # how many of the most frequent tokens are ordered last
HOT_FROM = 10  # documents
_BLOCK_TOKENS = 2_000_000
_BATCH = 500  # rows of one Arrow batch with sets
_MATRIX_CELLS = 8_000_000


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``length`` words; linked from ``percent`` hundredths of the union on."""

    length: int = 5
    percent: int = 80

    def prefix_size(self, n: int) -> int:
        """Prefix of a set of n tokens; 0 if no different set can be similar to it."""
        if n * (100 - self.percent) < self.percent:
            return 0
        return min(n, n - -(-self.percent * n // 100) + max(LEAST_SHARED, n // SHARED_PART))


def _shared(n: Column) -> Column:
    """How many prefix tokens a set of n tokens shares with a linked set that is not smaller."""
    return F.greatest(F.floor(n / SHARED_PART), F.lit(LEAST_SHARED))


def _int64(tokens: np.ndarray) -> np.ndarray:
    return tokens.view(np.int64)


def _lists(parts: list) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(_int64(values)))


def token_counts(documents: DataFrame, like: Similarity) -> DataFrame:
    """(token, n): in how many documents the tokens stand that can come early in the order.

    Prefixes hold the smallest hashes of a set, so only hashes below a bound of the hash range count.
    """
    share = min(1.0, 1.3 * ((100 - like.percent) / 100 + 1 / SHARED_PART))
    bound = np.uint64(min(int(share * 2 ** 64), 2 ** 64 - 1))

    def count(batches):
        cache, parts, size = shingles.WordHashes(), [], 0

        def counted():
            tokens, n = np.unique(np.concatenate(parts), return_counts=True)
            for k in range(0, len(tokens), 500_000):
                yield pa.record_batch([pa.array(_int64(tokens[k:k + 500_000])), pa.array(n[k:k + 500_000])],
                                      names=["token", "n"])

        for batch in batches:
            for text in batch.column(0):
                tokens = shingles.shingle_set(shingles.word_hashes(text.as_py(), cache), like.length)
                parts.append(tokens[:np.searchsorted(tokens, bound)].copy())
                size += len(parts[-1])
                if size >= _BLOCK_TOKENS:
                    yield from counted()
                    parts, size = [], 0
        if size:
            yield from counted()

    counted = documents.select("text").mapInArrow(frugal(count), "token long, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def hot_tokens(documents: DataFrame, like: Similarity) -> np.ndarray:
    """The most frequent tokens, at most ``HOT_TOKENS``, in rising order.

    The least number of documents is chosen from a histogram of at most some hundred bins.
    """
    counts = stored(token_counts(documents, like).where(F.col("n") > HOT_FROM).withColumn(
        "bin", F.floor(F.log2("n") * 8)))
    least, held = None, 0
    for row in sorted(counts.groupBy("bin").count().collect(), key=lambda row: -row["bin"]):
        held += row["count"]
        if held > HOT_TOKENS:
            break
        least = row["bin"]
    if least is None:
        return np.zeros(0, np.uint64)
    rows = counts.where(F.col("bin") >= least).select("token").toArrow()
    return np.sort(rows.column("token").to_numpy().view(np.uint64))


def _among(tokens: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which tokens stand in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(tokens), bool)
    return known[np.minimum(np.searchsorted(known, tokens), len(known) - 1)] == tokens


def described(documents: DataFrame, like: Similarity, hot: np.ndarray) -> DataFrame:
    """doc_id, n_shingles, digest of the set (null without words) and its prefix."""
    shared = documents.sparkSession.sparkContext.broadcast(hot)

    def describe(batches):
        cache, hot = shingles.WordHashes(), shared.value
        for batch in batches:
            ns, digests, prefixes = [], [], []
            for text in batch.column(1):
                tokens = shingles.shingle_set(shingles.word_hashes(text.as_py(), cache), like.length)
                size = like.prefix_size(len(tokens))
                if size:
                    is_hot = _among(tokens, hot)
                    prefixes.append(np.concatenate([tokens[~is_hot][:size], tokens[is_hot]])[:size].copy())
                else:
                    prefixes.append(np.zeros(0, np.uint64))
                ns.append(len(tokens))
                digests.append(shingles.digest(tokens) if len(tokens) else None)
            yield pa.record_batch([batch.column(0), pa.array(ns, pa.int64()), pa.array(digests, pa.binary()),
                                   _lists(prefixes)], names=["doc_id", "n_shingles", "digest", "prefix"])

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        frugal(describe), f"doc_id {id_type}, n_shingles long, digest binary, prefix array<long>")


def token_sets(documents: DataFrame, wanted: DataFrame, like: Similarity) -> DataFrame:
    """(node, tokens) of the classes ``wanted`` (node, digest, min_id).

    One document of a class is found by its smallest id; its digest tells that it is of the class.
    Rows that repeat the id give the set once per task, and more than once does no harm.
    """
    ids = small_side(wanted.select("min_id").distinct())
    texts = documents.select("doc_id", "text").join(
        ids, F.col("doc_id").eqNullSafe(F.col("min_id")), "left_semi")

    def sets(batches):
        cache, given = shingles.WordHashes(), set()
        for batch in batches:
            for k in range(0, batch.num_rows, _BATCH):
                found = {}
                for text in batch.column(1).slice(k, _BATCH):
                    tokens = shingles.shingle_set(shingles.word_hashes(text.as_py(), cache), like.length)
                    found[shingles.digest(tokens)] = tokens
                found = {digest: tokens for digest, tokens in found.items() if digest not in given}
                given.update(found)
                yield pa.record_batch([pa.array(list(found), pa.binary()), _lists(list(found.values()))],
                                      names=["digest", "tokens"])

    found = texts.mapInArrow(frugal(sets), "digest binary, tokens array<long>")
    return stored(found.join(small_side(wanted.select("node", "digest")), "digest").select("node", "tokens"))


def intersections(left: list, right: list) -> np.ndarray:
    """Sizes of the intersections of each set on the left with each on the right."""
    sets = left + right
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    useful = n[place] > 1
    owners, place = owners[useful], place[useful]
    _, place = np.unique(place, return_inverse=True)
    order = np.argsort(place, kind="stable")
    owners, place = owners[order], place[order]
    found = np.zeros((len(left), len(right)), np.float64)
    width = max(1, _MATRIX_CELLS // len(sets))
    last = int(place[-1]) + 1 if len(place) else 0
    for start in range(0, last, width):
        a, b = np.searchsorted(place, [start, start + width])
        matrix = np.zeros((len(sets), min(width, last - start)), np.float32)
        matrix[owners[a:b], place[a:b] - start] = 1
        found += matrix[:len(left)] @ matrix[len(left):].T
    return found.astype(np.int64)


def similar(left: list, right: list, like: Similarity) -> np.ndarray:
    """Which sets on the left are linked with which on the right."""
    common = intersections(left, right)
    sizes = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :]
    return 100 * common >= like.percent * (sizes - common)


def _first_reachable(linked: np.ndarray) -> np.ndarray:
    """For each place of a symmetric matrix, the first place reachable by links."""
    first = np.full(len(linked), -1)
    for start in range(len(linked)):
        if first[start] >= 0:
            continue
        edge = np.zeros(len(linked), bool)
        edge[start] = True
        reached = edge.copy()
        while edge.any():
            edge = linked[edge].any(axis=0) & ~reached
            reached |= edge
        first[reached] = start
    return first


def _node_sets(table: pa.Table) -> tuple:
    lists = table.column("tokens").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    ends = np.cumsum(np.concatenate([[0], lists.value_lengths().to_numpy(zero_copy_only=False)])).astype(np.int64)
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def group_links(members: DataFrame, like: Similarity) -> DataFrame:
    """Links (a, b) within the groups of ``members`` (key, part, node, tokens): a tree per component."""
    def links(table):
        table = table.sort_by("node")
        nodes = table.column("node").to_numpy()
        sets = _node_sets(table)
        first = _first_reachable(similar(sets, sets, like))
        moved = first != np.arange(len(nodes))
        return pa.table([pa.array(nodes[moved]), pa.array(nodes[first[moved]])], schema=_LINKS)

    return members.groupBy("key", "part").applyInArrow(links, "a long, b long")


def opened_links(rows: DataFrame, like: Similarity) -> DataFrame:
    """Links (a, b) of queries to components of opened groups (key, part, block, asks, node, comp, tokens).

    A query is linked once with each component of which some member is similar: b is its label.
    """
    def links(table):
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        nodes = table.column("node").to_numpy()
        sets = _node_sets(table)
        queries = [s for s, q in zip(sets, asks) if q]
        members = [s for s, q in zip(sets, asks) if not q]
        if not queries or not members:
            return _LINKS.empty_table()
        found = similar(queries, members, like)
        comps = table.column("comp").to_numpy()[~asks]
        order = np.argsort(comps, kind="stable")
        labels, starts = np.unique(comps[order], return_index=True)
        query, label = np.nonzero(np.logical_or.reduceat(found[:, order], starts, axis=1))
        return pa.table([pa.array(nodes[asks][query]), pa.array(labels[label])], schema=_LINKS)

    return rows.groupBy("key", "part", "block").applyInArrow(links, "a long, b long")


def _parts(keyed: DataFrame, *keys: str) -> DataFrame:
    """Adds ``parts``: into how many parts of about GROUP_SIZE rows the rows of a key are dealt."""
    counts = stored(keyed.groupBy(*keys).agg(
        F.count("*").alias("size"), F.max_by("node", F.struct("common", "node")).alias("first"),
        F.ceil(F.count("*") / GROUP_SIZE).cast("int").alias("parts")))
    return keyed.join(counts, list(keys))


def joined(documents: DataFrame, like: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    component_id is the smallest doc_id reachable by links, the row's own included.
    """
    hot = hot_tokens(documents, like)
    described_rows = stored(described(documents, like, hot))
    rows = described_rows.select("doc_id", "n_shingles", "digest")
    classes = stored(
        described_rows.where("digest IS NOT NULL").groupBy("digest").agg(
            F.min("doc_id").alias("min_id"), F.first("n_shingles").alias("n"))
        .withColumn("node", F.monotonically_increasing_id()))

    # One document of a class stands for it.
    named = small_side(classes.select("digest", "min_id", "node"))
    tokens = described_rows.join(named, "digest").where(F.col("doc_id").eqNullSafe(F.col("min_id"))).select(
        "node", F.explode("prefix").alias("token"))
    common = tokens.groupBy("token").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("holders")).where(
        "low != high").select("token", "holders")
    tokens = stored(tokens.join(common, "token"))
    sizes = classes.select("node", "n")
    most_held = F.max(F.struct("holders", "token"))["token"]
    active = stored(tokens.groupBy("node").agg(F.count("*").alias("common"), most_held.alias("key")).join(
        sizes, "node").where(F.col("common") >= _shared(F.ceil(F.col("n") * like.percent / 100))))
    tokens = tokens.drop("holders").join(active.select("node", "n"), "node")
    keyed = _parts(active.select("node", "key", "common"), "key")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    groups = stored(keyed.select("node", "key", part.alias("part"), "size", "parts", "first"))
    sets = token_sets(documents, stored(groups.select("node").join(
        classes.select("node", "digest", "min_id"), "node")), like)

    own = groups.where("size > 1").select("node", "key", "part")
    dealt = groups.where("parts > 1").groupBy("key").agg(
        F.first("first").alias("node"), F.first("parts").alias("parts"))
    guests = dealt.select("node", "key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    members = sets.join(small_side(stored(own.unionByName(guests).distinct())), "node")
    links = stored(group_links(members, like))

    found = components(links)
    comps = stored(groups.join(found, "node", "left").select(
        "node", "key", "part", F.coalesce("component", "node").alias("comp")))
    more = stored(_links_between(tokens, comps, sets, like))
    all_links = links.unionByName(more)
    found = stored(components(all_links))
    known = classes.select("node", "digest", "min_id").join(found, "node", "left").select(
        "digest", "min_id", F.coalesce("component", "node").alias("component"))
    known = stored(known)
    smallest = known.groupBy("component").agg(F.min("min_id").alias("component_id"))
    known = known.join(smallest, "component").select("digest", "component_id")
    return rows.where("digest IS NOT NULL").join(known, "digest").select(
        "doc_id", "n_shingles", "component_id").unionByName(
        rows.where("digest IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def _links_between(tokens: DataFrame, comps: DataFrame, sets: DataFrame, like: Similarity) -> DataFrame:
    """Links (a, b) between classes of different components.

    The token-group matrix has a row for each prefix token and group, with the largest component (by
    size, then label) among its holders. A class asks a group if that is larger than its own, so that
    every pair of components is asked about from one side. Its own group has been compared already.
    """
    held = tokens.join(comps, "node")
    apart = held.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where(
        "low != high").select("token")
    sizes = comps.groupBy("comp").agg(F.count("*").alias("weight"))
    held = held.join(apart, "token").join(sizes, "comp")
    held = stored(held.select("token", "node", "n", "key", "part", F.struct("weight", "comp").alias("rank")))
    matrix = held.groupBy("token", "key", "part").agg(
        F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.max("rank").alias("rank")).alias("m")
    asking = held.alias("q")
    elsewhere = (F.col("m.key") != F.col("q.key")) | (F.col("m.part") != F.col("q.part"))
    fits = (100 * F.col("q.n") >= like.percent * F.col("m.least_n")) & (
        100 * F.col("m.most_n") >= like.percent * F.col("q.n"))
    bounds = asking.join(
        matrix, (F.col("q.token") == F.col("m.token")) & elsewhere & (F.col("m.rank") > F.col("q.rank")) & fits)
    bounds = bounds.groupBy(
        F.col("q.node").alias("node"), F.col("m.key").alias("key"), F.col("m.part").alias("part")).agg(
            F.count("*").alias("common"), F.least(F.first("q.n"), F.min("m.least_n")).alias("least_n"))
    opened = stored(bounds.where(F.col("common") >= _shared(F.col("least_n"))).drop("least_n"))
    opened = _parts(opened, "key", "part")
    opened = stored(opened.withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")))
    blocks = opened.select("key", "part", "parts").distinct().select(
        "key", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("block"))
    members = comps.join(blocks, ["key", "part"]).select(
        "key", "part", "block", F.lit(False).alias("asks"), "node", "comp")
    queries = opened.select("key", "part", "block", F.lit(True).alias("asks"), "node", F.col("node").alias("comp"))
    return opened_links(sets.join(small_side(stored(members.unionByName(queries))), "node"), like)


def one_of_each(documents: DataFrame, like: Similarity = Similarity()) -> DataFrame:
    """``documents`` with one row of each component, that of the smallest doc_id, and all columns.

    Rows are told apart by id and text, so that a row goes only for its own text, whatever ids repeat; rows
    without an id come last. Repeated rows are reduced to one, but for those without id and words.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"),
                   F.unhex(F.sha2("text", 256)).alias("text"))
    rows = stored(joined(documents.select(key.alias("doc_id"), "text"), like))
    dropped = small_side(stored(rows.where("doc_id != component_id").select(F.col("doc_id").alias("row")).distinct()))
    kept = documents.join(dropped, key == dropped["row"], "left_anti").select(*documents.columns)
    twice = stored(rows.where("n_shingles > 0 OR NOT doc_id.no_id").groupBy(F.col("doc_id").alias("row")).count().where(
        "count > 1").select("row"))
    if twice.isEmpty():
        return kept
    twice = small_side(twice)
    return kept.join(twice, key == twice["row"], "left_anti").unionByName(
        kept.join(twice, key == twice["row"], "left_semi").dropDuplicates(["doc_id", "text"])).select(
            *documents.columns)
