"""Queries of the numbered operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lotwise.llm.bpe import op9_bpe
from lotwise.llm.divergence import OP13_SQL, op13_divergence
from lotwise.llm.licenses import op1_licenses, op1_sql
from lotwise.llm.negatives import OP11_SQL, op11_negatives
from lotwise.llm.neighbours import op3_neighbours
from lotwise.llm.ngram_join import OP6_SQL, op6_ngram_join
from lotwise.llm.packing import op5_packing
from lotwise.llm.pii import op12_pii
from lotwise.llm.sharding import op8_sharding
from lotwise.llm.suffix_dedup import op4_suffix_dedup
from lotwise.llm.topk import OP7_SQL, op7_topk
from lotwise.llm.toxicity import op2_toxicity
from lotwise.llm.warc import op10_warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_licenses, op2_toxicity, op3_neighbours, op4_suffix_dedup, op5_packing, op6_ngram_join, op7_topk, op8_sharding, op9_bpe, op10_warc, op11_negatives, op12_pii, op13_divergence)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_licenses": op1_sql(), "op6_ngram_join": OP6_SQL, "op7_topk": OP7_SQL, "op11_negatives": OP11_SQL, "op13_divergence": OP13_SQL}
