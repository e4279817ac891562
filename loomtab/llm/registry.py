"""The queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, fingerprints, hardnegatives, langid, neardup, neighbours, packing, pii, prefixtrie, repeats, rollups, tokenfiles, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        langid.op1_language_mixture,
        pii.op2_pii_skip_chain,
        fingerprints.op3_bottom_k_fingerprints,
        neardup.op4_chosen_path_dedup,
        rollups.op5_token_rollups,
        rollups.ledger_of_words,
        packing.op6_best_fit_packing,
        tokenfiles.op8_token_id_files,
        decontaminate.op7_qgram_decontamination,
        repeats.op9_suffix_bucket_dedup,
        toxicity.op10_toxicity_mil,
        prefixtrie.op11_prefix_trie,
        neighbours.op12_neighbour_quality,
        hardnegatives.op13_multi_index_negatives,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"ledger_of_words": rollups.WORDS_SQL, "op11_prefix_trie": prefixtrie.OP11_SQL, "op13_multi_index_negatives": hardnegatives.OP13_SQL}
