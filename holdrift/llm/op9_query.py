"""Query of the LM scoring over all documents; good, harmless documents are the target."""

from holdrift.llm import lm_scoring
from holdrift.llm.registry import query
from holdrift.llm.tables import table


@query("op9_lm_scoring")
def op9_lm_scoring(spark, folder):
    chosen = table(spark, folder, "labels").where("quality = 1 AND toxic = 0")
    return lm_scoring.cross_entropy_difference(table(spark, folder, "documents"), chosen)
