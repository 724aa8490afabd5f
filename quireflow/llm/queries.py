"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op1_bpe_codec
from .common import table
from .edit_counts import op3_edit_aware_counts
from .huffman import op6_huffman_ids
from .katz import op7_katz_scoring
from .mixing import op10_source_mixing
from .pivots import op4_pivot_near_dedup
from .prefix_trie import op13_conversation_trie
from .quality import op9_quality_rules, quality_ablations
from .resampling import op11_importance_resampling
from .sharding import op5_extendible_sharding
from .simhash import op2_simhash_near_dedup
from .sql import ORACLES
from .substring import op8_substring_dedup
from .transducer import op12_byte_bpe_transducer

Query = Callable[[SparkSession, str], DataFrame]


def _over(name: str, op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: op(table(spark, sf_dir, name))


def queries() -> dict[str, Query]:
    return {
        "op1_bpe_codec": _over("documents", op1_bpe_codec),
        "op2_simhash_near_dedup": _over("documents", op2_simhash_near_dedup),
        "op3_edit_aware_counts": _over("documents", op3_edit_aware_counts),
        "op4_pivot_near_dedup": _over("embeddings", op4_pivot_near_dedup),
        "op5_extendible_sharding": _over("documents", op5_extendible_sharding),
        "op6_huffman_ids": _over("documents", op6_huffman_ids),
        "op7_katz_scoring": _over("documents", op7_katz_scoring),
        "op8_substring_dedup": _over("documents", op8_substring_dedup),
        "op9_quality_rules": _over("documents", op9_quality_rules),
        "op10_source_mixing": _over("documents", op10_source_mixing),
        "op11_importance_resampling": lambda spark, sf_dir: op11_importance_resampling(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
        "op12_byte_bpe_transducer": _over("documents", op12_byte_bpe_transducer),
        "op13_conversation_trie": _over("conversations", op13_conversation_trie),
        "quality_ablations": _over("documents", quality_ablations),
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
