"""A training corpus from raw documents, in five stages.

Each stage takes the documents its predecessor kept and returns those it keeps, with all their
columns; the last one returns token ids. Between stages the documents are written as Parquet to the
shared folder and read again, so each stage can be repeated on its own.

1. Quality classifier: documents outside the importance sample go.
2. Language ID: documents of no known language, or without enough confidence, go.
3. N-gram Jaccard join (five words, 0.8): one document of each group of near copies stays.
4. Benchmark decontamination: documents that share ten words in a row with a test item go.
5. Byte-level BPE: the remaining texts as token ids, and digests of the ids and of the decoded bytes.

Null or empty texts leave in stage 2, having no language. Extra columns pass through all
stages but the last. An empty table gives an empty result.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdrift.llm import byte_bpe, decontaminate, importance, jaccard_join, language_id, op2_query
from holdrift.llm.tables import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return importance.sampled(docs, table(spark, sf_dir, "labels"))


def language_identification(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs, jaccard_join.Similarity(5, 80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.rows_of_clean_texts(docs, table(spark, sf_dir, "benchmark"))


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tokens = byte_bpe.encoded(docs, op2_query.RANK_FILE, op2_query.public_tokenizers.PATTERN)
    return byte_bpe.decoded(tokens, op2_query.RANK_FILE).select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
        F.sha2(F.array_join("token_ids", ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("language id", language_identification),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level bpe", tokenization),
]

#: SQL cannot express the stages with trained models; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
