"""Queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from valuemark.llm.chat import op3_chat
from valuemark.llm.fingerprints import op7_fingerprints
from valuemark.llm.importance import OP11_SQL, op11_importance
from valuemark.llm.inner_products import OP2_SQL, op2_inner_products
from valuemark.llm.jaccard_join import op4_jaccard
from valuemark.llm.lexical import OP12_SQL, op12_lexical
from valuemark.llm.line_dedup import OP5_SQL, op5_line_dedup
from valuemark.llm.packing import op1_packing
from valuemark.llm.pieces import op6_pieces
from valuemark.llm.quality import op10_quality
from valuemark.llm.rules import op13_rules
from valuemark.llm.token_records import op9_token_records
from valuemark.llm.toxicity import op8_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_packing": op1_packing,
        "op2_inner_products": op2_inner_products,
        "op3_chat": op3_chat,
        "op4_jaccard": op4_jaccard,
        "op5_line_dedup": op5_line_dedup,
        "op6_pieces": op6_pieces,
        "op7_fingerprints": op7_fingerprints,
        "op8_toxicity": op8_toxicity,
        "op9_token_records": op9_token_records,
        "op10_quality": op10_quality,
        "op11_importance": op11_importance,
        "op12_lexical": op12_lexical,
        "op13_rules": op13_rules,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_inner_products": OP2_SQL, "op5_line_dedup": OP5_SQL, "op11_importance": OP11_SQL, "op12_lexical": OP12_SQL}
