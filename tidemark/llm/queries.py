"""The registered queries of this subpackage and, where SQL can express them, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import best_fit, embedding_dedup, exact_dedup, fill_middle, language_id, main_text, mixing, near_dedup, phrases, pieces, private_data, quality, repeats


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pieces": pieces.op1_pieces,
        "op2_repeats": repeats.op2_repeats,
        "op3_private": private_data.op3_private,
        "op4_main_text": main_text.op4_main_text,
        "op5_source_mix": mixing.op5_source_mix,
        "op6_language": language_id.op6_language,
        "op7_exact_dedup": exact_dedup.op7_exact_dedup,
        "op8_quality": quality.op8_quality,
        "op9_near_dedup": near_dedup.op9_near_dedup,
        "op10_near_vectors": embedding_dedup.op10_near_vectors,
        "op11_best_fit": best_fit.op11_best_fit,
        "op12_collocations": phrases.op12_collocations,
        "op13_fill_middle": fill_middle.op13_fill_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {**exact_dedup.SQL, **fill_middle.SQL, **phrases.SQL}
