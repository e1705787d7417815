"""Imports every module that registers queries of this package, and registers the pipeline."""

import corpus_pipeline
from holdrift.llm import (  # noqa: F401
    op1_query, op2_query, op3_query, op4_query, op5_query, op6_query, op7_query, op8_query, op9_query,
    op10_query, op11_query, op12_query, op13_query,
)
from holdrift.llm.registry import ORACLES, QUERIES, query  # noqa: F401

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
