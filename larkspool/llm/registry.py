"""Queries of this subpackage and their SQL; a query without SQL is tested against brute force in tests/llm."""

from __future__ import annotations

from functools import wraps

from .byte_bpe import op5_byte_bpe
from .decontaminate import op3_benchmark_decontamination
from .exact_dedup import OP4_SQL, op4_exact_dedup
from .html_text import op1_html_extraction
from .jaccard_join import OP10_SQL, op10_ngram_jaccard
from .language_id import op9_language_id
from .license_scan import op8_license_scan
from .quality import op6_quality_classifier
from .scratch import prepare
from .substring_dedup import OP7_SQL, op7_substring_dedup
from .toxicity import op2_toxicity_crf


def _shipped(query):
    """The query, after its session has been prepared."""

    @wraps(query)
    def run(spark, sf_dir):
        prepare(spark)
        return query(spark, sf_dir)

    return run


_QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_toxicity_crf": op2_toxicity_crf,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_language_id": op9_language_id,
    "op10_ngram_jaccard": op10_ngram_jaccard,
}
QUERIES = {name: _shipped(query) for name, query in _QUERIES.items()}
ORACLES = {"op4_exact_dedup": OP4_SQL, "op7_substring_dedup": OP7_SQL, "op10_ngram_jaccard": OP10_SQL}
