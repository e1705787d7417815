"""Query of the byte-level BPE: all documents encoded and decoded again."""

import public_tokenizers
from pyspark.sql import functions as F

from holdrift.llm import byte_bpe
from holdrift.llm.registry import query
from holdrift.llm.tables import table

RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def digests(documents, rank_file=RANK_FILE, pattern=public_tokenizers.PATTERN):
    tokens = byte_bpe.encoded(documents, rank_file, pattern)
    return byte_bpe.decoded(tokens, rank_file).select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


@query("op2_byte_bpe")
def op2_byte_bpe(spark, folder):
    return digests(table(spark, folder, "documents"))
