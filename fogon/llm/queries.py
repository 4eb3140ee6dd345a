"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fogon.llm import op1_packing as op1
from fogon.llm import op10_secrets as op10
from fogon.llm import op11_spelling as op11
from fogon.llm import op12_neighbours as op12
from fogon.llm import op13_fim as op13
from fogon.llm import op2_lattice as op2
from fogon.llm import op3_rules as op3
from fogon.llm import op4_substrings as op4
from fogon.llm import op5_toxicity as op5
from fogon.llm import op6_lines as op6
from fogon.llm import op7_bpe as op7
from fogon.llm import op8_jaccard as op8
from fogon.llm import op9_urls as op9


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_curve_packing": op1.op1_curve_packing,
        "op2_lattice_dedup": op2.op2_lattice_dedup,
        "op3_decision_list": op3.op3_decision_list,
        "op4_substring_dedup": op4.op4_substring_dedup,
        "op5_toxicity": op5.op5_toxicity,
        "op6_line_windows": op6.op6_line_windows,
        "op7_bpe_words": op7.op7_bpe_words,
        "op8_jaccard_join": op8.op8_jaccard_join,
        "op9_temporal_list": op9.op9_temporal_list,
        "op10_secret_scan": op10.op10_secret_scan,
        "op11_bit_sliced": op11.op11_bit_sliced,
        "op12_adaptive_scan": op12.op12_adaptive_scan,
        "op13_piece_table": op13.op13_piece_table,
    }


def oracle_sql() -> dict[str, str]:
    """SQL twins of those that SQL can express; the others are tested against brute force."""
    return {**op2.SQL, **op4.SQL, **op6.SQL, **op8.SQL, **op9.SQL, **op11.SQL, **op13.SQL}
