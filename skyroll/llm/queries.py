"""Queries of the language-model operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyroll.llm.chat import OP2_SQL, op2_chat
from skyroll.llm.contamination import OP6_SQL, op6_decontamination
from skyroll.llm.langid import OP13_SQL, op13_language
from skyroll.llm.lines import op10_lines
from skyroll.llm.merkle import OP12_SQL, op12_merkle
from skyroll.llm.near import op4_near_duplicates
from skyroll.llm.packing import op8_packing
from skyroll.llm.pages import op9_main_text
from skyroll.llm.quality import op7_quality
from skyroll.llm.ranked import OP11_SQL, op11_search
from skyroll.llm.shard import OP3_SQL, op3_sharding
from skyroll.llm.substrings import OP1_SQL, op1_substrings
from skyroll.llm.tokens import op5_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substrings": op1_substrings,
    "op2_chat": op2_chat,
    "op3_sharding": op3_sharding,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_token_counts": op5_token_counts,
    "op6_decontamination": op6_decontamination,
    "op7_quality": op7_quality,
    "op8_packing": op8_packing,
    "op9_main_text": op9_main_text,
    "op10_lines": op10_lines,
    "op11_search": op11_search,
    "op12_merkle": op12_merkle,
    "op13_language": op13_language,
}

SQL: dict[str, str] = {
    "op1_substrings": OP1_SQL,
    "op2_chat": OP2_SQL,
    "op3_sharding": OP3_SQL,
    "op6_decontamination": OP6_SQL,
    "op11_search": OP11_SQL,
    "op12_merkle": OP12_SQL,
    "op13_language": OP13_SQL,
}
