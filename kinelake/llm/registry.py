"""Queries and SQL of this subpackage, for the driver's entry module."""

from __future__ import annotations

from kinelake.llm import oracles
from kinelake.llm.chat import op9_chat_format
from kinelake.llm.decontamination import op5_decontaminate
from kinelake.llm.jaccard import op2_jaccard_join
from kinelake.llm.packing import op4_pack_sequences
from kinelake.llm.quality import op6_quality_rules
from kinelake.llm.secrets import op7_secret_scans
from kinelake.llm.sharding import op3_shuffle_shards
from kinelake.llm.substrings import op10_substring_dedup
from kinelake.llm.toxicity import op1_toxicity
from kinelake.llm.urls import op8_url_filter

QUERIES = {f.__name__: f for f in (op1_toxicity, op2_jaccard_join, op3_shuffle_shards, op4_pack_sequences, op5_decontaminate, op6_quality_rules, op7_secret_scans, op8_url_filter, op9_chat_format, op10_substring_dedup)}
ORACLES = {"op2_jaccard_join": oracles.OP2, "op5_decontaminate": oracles.OP5, "op10_substring_dedup": oracles.OP10}
