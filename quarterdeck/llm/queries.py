"""The queries of this subpackage and the SQL that gives the same rows, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm.alignment import op13_tokenizer_alignment
from quarterdeck.llm.html_text import OP4_SQL, op4_html_extraction
from quarterdeck.llm.langid import op3_language_id
from quarterdeck.llm.minhash import op11_minhash_near_dedup
from quarterdeck.llm.mixing import op7_mix_sources
from quarterdeck.llm.pieces import op2_sentencepiece
from quarterdeck.llm.pii import op6_pii
from quarterdeck.llm.simhash import op9_simhash_near_dedup
from quarterdeck.llm.spelling import op12_spelling_variants
from quarterdeck.llm.substrings import op1_suffix_dedup
from quarterdeck.llm.topk import OP8_SQL, op8_exact_top_k
from quarterdeck.llm.toxicity import op5_toxicity
from quarterdeck.llm.weighted_minhash import op10_document_fingerprints


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_sentencepiece": op2_sentencepiece,
        "op3_language_id": op3_language_id,
        "op4_html_extraction": op4_html_extraction,
        "op5_toxicity": op5_toxicity,
        "op6_pii": op6_pii,
        "op7_mix_sources": op7_mix_sources,
        "op8_exact_top_k": op8_exact_top_k,
        "op9_simhash_near_dedup": op9_simhash_near_dedup,
        "op10_document_fingerprints": op10_document_fingerprints,
        "op11_minhash_near_dedup": op11_minhash_near_dedup,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_tokenizer_alignment": op13_tokenizer_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_html_extraction": OP4_SQL, "op8_exact_top_k": OP8_SQL}
