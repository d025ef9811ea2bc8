"""Queries and oracles of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import audit, codes, licenses, mixing, near_duplicates, neighbours, oracles as sql, order, packing, quality, scoring, secrets, sharding, substrings


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secrets": secrets.op1_secrets,
        "op2_neighbours": neighbours.op2_neighbours,
        "op3_sharding": sharding.op3_sharding,
        "op4_licenses": licenses.op4_licenses,
        "op5_scoring": scoring.op5_scoring,
        "op6_mixing": mixing.op6_mixing,
        "mixing_shards": mixing.mixing_shards,
        "op7_jaccard_join": near_duplicates.op7_jaccard_join,
        "op8_packing": packing.op8_packing,
        "op9_training_order": order.op9_training_order,
        "op10_repetition": quality.op10_repetition,
        "op11_substring_dedup": substrings.op11_substring_dedup,
        "op12_vector_codes": codes.op12_vector_codes,
        "op13_filter_audit": audit.op13_filter_audit,
        "pipeline": corpus_pipeline.run,
    }


def oracles() -> dict[str, str]:
    return sql.oracles()
