"""Query of the quality classifier over all documents."""

from holdrift.llm import importance
from holdrift.llm.registry import query
from holdrift.llm.tables import table


@query("op10_quality_classifier")
def op10_quality_classifier(spark, folder):
    return importance.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))
