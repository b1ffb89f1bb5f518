"""Registered queries of the package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tierline.llm.decontamination import op6_benchmark_decontamination
from tierline.llm.fixity import OP10_SQL, op10_warc_fixity
from tierline.llm.infill import OP13_SQL, op13_fill_in_middle
from tierline.llm.language import op12_language_id
from tierline.llm.licenses import op5_license_scan
from tierline.llm.mixing import OP2_SQL, op2_source_mixing
from tierline.llm.ngram_join import op7_ngram_jaccard_join
from tierline.llm.pii import op9_pii
from tierline.llm.quality import op1_quality_rules
from tierline.llm.substring import op8_substring_dedup
from tierline.llm.tokens import op3_token_counts
from tierline.llm.toxicity import op4_toxicity
from tierline.llm.whitening import op11_embedding_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_source_mixing": op2_source_mixing,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_license_scan": op5_license_scan,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_pii": op9_pii,
    "op10_warc_fixity": op10_warc_fixity,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_language_id": op12_language_id,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {
    "op2_source_mixing": OP2_SQL,
    "op10_warc_fixity": OP10_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
