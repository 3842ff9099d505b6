"""Queries and DuckDB SQL of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

import corpus_pipeline
from spanforge.llm import arrow_tokens, delta_lloyd, factorisation, hilbert_shards, hyperdimensional, jaccard_join, licence_index, line_cleaning, ngram_trie, soft_mixing, spaced_seeds, suffix_removal, voronoi_negatives


def queries() -> dict[str, Callable[..., DataFrame]]:
    return {
        "op1_factorisation": factorisation.op1_factorisation,
        "op2_ngram_trie": ngram_trie.op2_ngram_trie,
        "op3_arrow_tokens": arrow_tokens.op3_arrow_tokens,
        "op4_hilbert_shards": hilbert_shards.op4_hilbert_shards,
        "op5_jaccard_join": jaccard_join.op5_jaccard_join,
        "op6_spaced_seeds": spaced_seeds.op6_spaced_seeds,
        "op7_suffix_removal": suffix_removal.op7_suffix_removal,
        "op8_line_cleaning": line_cleaning.op8_line_cleaning,
        "op9_hyperdimensional": hyperdimensional.op9_hyperdimensional,
        "op10_soft_mixing": soft_mixing.op10_soft_mixing,
        "op11_delta_lloyd": delta_lloyd.op11_delta_lloyd,
        "op12_licence_index": licence_index.op12_licence_index,
        "op13_voronoi_negatives": voronoi_negatives.op13_voronoi_negatives,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_jaccard_join": jaccard_join.ORACLE,
        "op6_spaced_seeds": spaced_seeds.ORACLE,
        "op7_suffix_removal": suffix_removal.ORACLE,
        "op8_line_cleaning": line_cleaning.ORACLE,
        "op11_delta_lloyd": delta_lloyd.ORACLE,
        "op12_licence_index": licence_index.ORACLE,
        "op13_voronoi_negatives": voronoi_negatives.ORACLE,
    }
