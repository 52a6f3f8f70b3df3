"""The queries of this subpackage: each operator over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from whlens.llm.chat import OP5_SQL, op5_chat
from whlens.llm.embeddings import op9_embeddings
from whlens.llm.huffman import op1_token_ids
from whlens.llm.langid import op2_language_id
from whlens.llm.licenses import op4_licenses
from whlens.llm.mixing import op3_mixing
from whlens.llm.packing import op10_packing
from whlens.llm.pii import op6_personal_data
from whlens.llm.quality import op7_quality
from whlens.llm.repair import OP12_SQL, op12_repair
from whlens.llm.search import OP13_SQL, op13_search
from whlens.llm.toxicity import op11_toxicity
from whlens.llm.simhash import op8_simhash


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_ids": op1_token_ids,
        "op2_language_id": op2_language_id,
        "op3_mixing": op3_mixing,
        "op4_licenses": op4_licenses,
        "op5_chat": op5_chat,
        "op6_personal_data": op6_personal_data,
        "op7_quality": op7_quality,
        "op8_simhash": op8_simhash,
        "op9_embeddings": op9_embeddings,
        "op10_packing": op10_packing,
        "op11_toxicity": op11_toxicity,
        "op12_repair": op12_repair,
        "op13_search": op13_search,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_chat": OP5_SQL, "op12_repair": OP12_SQL, "op13_search": OP13_SQL}
