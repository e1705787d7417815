"""Query of the token counts over all documents."""

import public_tokenizers

from holdrift.llm import token_counts
from holdrift.llm.registry import query
from holdrift.llm.tables import table

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 512


@query("op11_token_counts")
def op11_token_counts(spark, folder):
    return token_counts.counted(table(spark, folder, "documents"), FILE, public_tokenizers.PATTERN, LIMIT)
