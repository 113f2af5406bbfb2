"""The registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from packetflow.llm import lines
from packetflow.llm.decontaminate import op10_decontaminate
from packetflow.llm.lines import op6_line_dedup
from packetflow.llm.mixing import op9_mix_sources
from packetflow.llm.neighbours import op1_nearest_vectors
from packetflow.llm.periodic import op12_periodic_runs
from packetflow.llm.quality import op7_quality
from packetflow.llm.scoring import op5_lm_scoring
from packetflow.llm.sharding import op13_shards
from packetflow.llm.simhash import op8_simhash_near_dedup
from packetflow.llm.suffixes import op2_suffix_dedup
from packetflow.llm.tokens import op3_token_ids
from packetflow.llm.toxicity import op4_toxicity
from packetflow.llm.whitening import op11_whitening

QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    op1_nearest_vectors,
    op2_suffix_dedup,
    op3_token_ids,
    op4_toxicity,
    op5_lm_scoring,
    op6_line_dedup,
    op7_quality,
    op8_simhash_near_dedup,
    op9_mix_sources,
    op10_decontaminate,
    op11_whitening,
    op12_periodic_runs,
    op13_shards,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op6_line_dedup": lines.ORACLE_SQL}
