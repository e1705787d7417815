"""Merkle fixity audit of WARC replicas.

A replica is a table of records with archive, offset, length and digest. Records are hashed into
nodes by ranges of offsets, nodes into their parents by ranges of positions, up to one root
per archive. Two replicas are compared from the roots down, and only the branches below
nodes that differ are opened, until the faulty records are found. Every node is made of at
most ``RANGE_BYTES`` bytes of records or ``FANOUT`` children, so no archive is a large group.

Defined results: records without archive or offset are ignored; a null digest or length counts as empty.
Repeated records count once; different records at one offset count together. A replica without
records lacks all of the other. Extra columns are ignored.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdrift.llm.tables import stored

RANGE_BYTES = 1 << 16
FANOUT = 16
RECORD_END = "\r\n\r\n"


def record_text(record_id: Column, url: Column, payload: Column) -> Column:
    """A WARC response record without the two line ends that close it."""
    payload, end = F.coalesce(payload, F.lit("")), F.lit("\r\n")
    return F.concat(
        F.lit("WARC/1.1"), end, F.lit("WARC-Type: response"), end,
        F.lit("WARC-Record-ID: <urn:record:"), F.coalesce(record_id.cast("string"), F.lit("")), F.lit(">"), end,
        F.lit("WARC-Target-URI: "), F.coalesce(url, F.lit("")), end,
        F.lit("Content-Length: "), F.octet_length(payload).cast("string"), end, end, payload)


def write_warc(records: DataFrame, path: str) -> None:
    """Writes records (archive, offset, record) as one WARC file per archive, in order of offsets."""
    records.repartition("archive").sortWithinPartitions("archive", "offset").select(
        F.col("record").alias("value"), "archive").write.partitionBy("archive").option(
        "lineSep", RECORD_END).text(path)


def parsed_records(content: bytes):
    """(offset, length, digest of the record) of each record of an uncompressed WARC file."""
    end, at = RECORD_END.encode(), 0
    while at < len(content):
        body = content.find(end, at)
        if body < 0:
            return
        size = 0
        for line in content[at:body].split(b"\r\n"):
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length" and value.strip().isdigit():
                size = int(value)
        stop = body + len(end) + size
        yield at, stop + len(end) - at, hashlib.sha256(content[at:stop]).hexdigest()
        at = stop + len(end)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """archive (file name), offset, length and digest of all records of WARC files."""
    def parse(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = list(parsed_records(content.as_py()))
                yield pa.record_batch(
                    [pa.array([name] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())],
                    names=["archive", "offset", "length", "digest"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(
        parse, "archive string, offset long, length long, digest string")


def leaves_of(records: DataFrame) -> DataFrame:
    """One row (archive, offset, length, digest) per offset of an archive."""
    known = records.where("archive IS NOT NULL AND offset IS NOT NULL").select(
        "archive", "offset", F.coalesce("length", F.lit(0)).cast("long").alias("length"),
        F.coalesce("digest", F.lit("")).alias("digest")).distinct()
    return stored(known.groupBy("archive", "offset").agg(
        F.max("length").alias("length"),
        F.array_join(F.sort_array(F.collect_list("digest")), ",").alias("digest")))


def _parents(children: DataFrame, parent: Column, text: Column) -> DataFrame:
    """Nodes (archive, place, hash): the hash of their children's texts in order."""
    return children.groupBy("archive", parent.alias("place")).agg(
        F.sort_array(F.collect_list(F.struct("child", text.alias("text")))).alias("children")).select(
        "archive", "place",
        F.sha2(F.array_join(F.transform("children", lambda c: c["text"]), "\n"), 256).alias("hash"))


def tree(leaves: DataFrame, levels: int) -> list:
    """Nodes of each level: offset ranges first, roots last."""
    shown = F.concat_ws(":", F.col("child").cast("string"), F.col("length").cast("string"), F.col("digest"))
    nodes = [stored(_parents(leaves.withColumnRenamed("offset", "child"),
                             F.floor(F.col("child") / RANGE_BYTES), shown))]
    for _ in range(levels - 1):
        below = nodes[-1].withColumnRenamed("place", "child").withColumnRenamed("hash", "digest")
        shown = F.concat_ws(":", F.col("child").cast("string"), F.col("digest"))
        nodes.append(stored(_parents(below, F.floor(F.col("child") / FANOUT), shown)))
    return nodes


def levels_for(*replicas: DataFrame) -> int:
    """How many levels give every archive a single root."""
    largest = max((replica.agg(F.max("offset")).first()[0] or 0) // RANGE_BYTES for replica in replicas)
    levels = 1
    while largest > 0:
        largest //= FANOUT
        levels += 1
    return levels


def differing(first: DataFrame, second: DataFrame) -> DataFrame:
    """(archive, place) of nodes that differ or stand in one replica only."""
    a, b = first.alias("a"), second.alias("b")
    same = (F.col("a.archive") == F.col("b.archive")) & (F.col("a.place") == F.col("b.place"))
    return a.join(b, same, "full").where(~F.col("a.hash").eqNullSafe(F.col("b.hash"))).select(
        F.coalesce("a.archive", "b.archive").alias("archive"), F.coalesce("a.place", "b.place").alias("place"))


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Faulty records (archive, offset, length, fault) of the second replica.

    ``fault``: changed, missing (in the second) or extra (only there).
    """
    first, second = leaves_of(first), leaves_of(second)
    levels = levels_for(first, second)
    trees = tree(first, levels), tree(second, levels)
    open_nodes = stored(differing(trees[0][-1], trees[1][-1]))
    for level in range(levels - 2, -1, -1):
        branches = [nodes[level].join(
            open_nodes.withColumnRenamed("place", "parent"),
            (nodes[level]["archive"] == open_nodes["archive"])
            & (F.floor(nodes[level]["place"] / FANOUT) == F.col("parent")), "left_semi") for nodes in trees]
        open_nodes = stored(differing(*branches))
    records = []
    for leaves in (first, second):
        place = F.floor(leaves["offset"] / RANGE_BYTES)
        records.append(leaves.join(
            open_nodes, (leaves["archive"] == open_nodes["archive"]) & (place == open_nodes["place"]), "left_semi"))
    a, b = records[0].alias("a"), records[1].alias("b")
    found = a.join(b, (F.col("a.archive") == F.col("b.archive")) & (F.col("a.offset") == F.col("b.offset")), "full")
    differs = ~(F.col("a.digest").eqNullSafe(F.col("b.digest")) & F.col("a.length").eqNullSafe(F.col("b.length")))
    fault = F.when(F.col("b.offset").isNull(), "missing").when(F.col("a.offset").isNull(), "extra").otherwise(
        "changed")
    return found.where(differs).select(
        F.coalesce("a.archive", "b.archive").alias("archive"), F.coalesce("a.offset", "b.offset").alias("offset"),
        F.coalesce("a.length", "b.length").alias("length"), fault.alias("fault"))
