"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .alignment import op11_alignment
from .byte_bpe import op10_byte_bpe
from .chat_format import OP4_SQL, op4_chat_format
from .divergence import OP13_SQL, op13_divergence
from .exact_dedup import OP6_SQL, op6_exact_dedup
from .language_id import op2_language_id
from .license_scan import OP12_SQL, op12_license_scan
from .lm_scoring import op1_lm_scores
from .packing import op8_packing
from .quality_rules import op3_quality_rules
from .simhash import op5_simhash
from .surrogates import op9_surrogates
from .warc import OP7_SQL, op7_warc

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scores": op1_lm_scores,
    "op2_language_id": op2_language_id,
    "op3_quality_rules": op3_quality_rules,
    "op4_chat_format": op4_chat_format,
    "op5_simhash": op5_simhash,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_warc": op7_warc,
    "op8_packing": op8_packing,
    "op9_surrogates": op9_surrogates,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_alignment": op11_alignment,
    "op12_license_scan": op12_license_scan,
    "op13_divergence": op13_divergence,
}

ORACLES: dict[str, str] = {
    "op4_chat_format": OP4_SQL,
    "op6_exact_dedup": OP6_SQL,
    "op7_warc": OP7_SQL,
    "op12_license_scan": OP12_SQL,
    "op13_divergence": OP13_SQL,
}
