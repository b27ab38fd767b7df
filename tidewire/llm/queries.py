"""The registered queries of this package and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm.ann import op1_ann
from tidewire.llm.decontaminate import op2_decontaminate
from tidewire.llm.importance import op12_importance
from tidewire.llm.language import op4_language
from tidewire.llm.near_dup import op3_near_dup
from tidewire.llm.oracles import ORACLES as ORACLES
from tidewire.llm.packing import op6_packing
from tidewire.llm.page_text import op9_page_text
from tidewire.llm.periodic_runs import op13_periodic_runs
from tidewire.llm.relative_dedup import op10_relative_dedup
from tidewire.llm.secrets import op8_secrets
from tidewire.llm.suffix_dedup import op7_suffix_dedup
from tidewire.llm.token_counts import op11_token_counts
from tidewire.llm.toxicity import op5_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": op1_ann,
    "op2_decontaminate": op2_decontaminate,
    "op3_near_dup": op3_near_dup,
    "op4_language": op4_language,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_secrets": op8_secrets,
    "op9_page_text": op9_page_text,
    "op10_relative_dedup": op10_relative_dedup,
    "op11_token_counts": op11_token_counts,
    "op12_importance": op12_importance,
    "op13_periodic_runs": op13_periodic_runs,
}
