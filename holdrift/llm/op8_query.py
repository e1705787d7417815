"""Query of the Jaccard join over all documents: three-word shingles, from 90 hundredths on."""

from holdrift.llm import jaccard_join
from holdrift.llm.registry import query
from holdrift.llm.tables import table


@query("op8_jaccard_join")
def op8_jaccard_join(spark, folder):
    return jaccard_join.joined(table(spark, folder, "documents"), jaccard_join.Similarity(3, 90))
