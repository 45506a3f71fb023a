"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from varaq.llm.byte_bpe import op6_byte_bpe
from varaq.llm.compaction import OP7_SQL, op7_sharding
from varaq.llm.divergence import OP12_SQL, op12_divergence
from varaq.llm.graph_dedup import OP1_SQL, op1_graph_dedup
from varaq.llm.html_extract import op10_html
from varaq.llm.minhash import OP9_SQL, op9_minhash
from varaq.llm.mixing import OP2_SQL, op2_mixing
from varaq.llm.pii import OP4_SQL, op4_pii
from varaq.llm.point_in_time import OP13_SQL, op13_point_in_time
from varaq.llm.quality import op8_quality
from varaq.llm.secret_scan import OP11_SQL, op11_secrets
from varaq.llm.token_count import op5_token_count
from varaq.llm.toxicity import op3_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_graph_dedup, op2_mixing, op3_toxicity, op4_pii, op5_token_count, op6_byte_bpe, op7_sharding, op8_quality, op9_minhash, op10_html, op11_secrets,
        op12_divergence, op13_point_in_time,
    )
    return {f.__name__: f for f in operators}


def oracle_sql() -> dict[str, str]:
    """Of those whose every column SQL can express. Tests hold the others against brute force, the tokenizer libraries
    and held-out labels, and the base columns of op8 against BASE_SQL."""
    return {"op1_graph_dedup": OP1_SQL, "op2_mixing": OP2_SQL, "op4_pii": OP4_SQL, "op7_sharding": OP7_SQL, "op9_minhash": OP9_SQL, "op11_secrets": OP11_SQL, "op12_divergence": OP12_SQL, "op13_point_in_time": OP13_SQL}
