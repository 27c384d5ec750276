"""The registered queries of this subpackage: one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from llm.bpe import op10_byte_bpe
from llm.lines import op1_fuzzy_line_dedup
from llm.merkle import OP12_SQL, op12_merkle_manifest
from llm.neighbours import op7_hilbert_neighbours
from llm.packing import op8_best_fit_packing
from llm.pii import op9_pii_surrogates
from llm.quality import OP4_SQL, op4_host_quality_rules
from llm.repeats import op6_repeated_strings
from llm.secrets import OP3_SQL, op3_secret_scan
from llm.simhash import op2_simhash_near_dedup
from llm.variants import OP11_SQL, op11_spelling_variants
from llm.warc import OP5_SQL, op5_warc_revisits
from llm.wordbpe import op13_word_bpe

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_fuzzy_line_dedup, op2_simhash_near_dedup, op3_secret_scan, op4_host_quality_rules, op5_warc_revisits,
    op6_repeated_strings, op7_hilbert_neighbours, op8_best_fit_packing, op9_pii_surrogates, op10_byte_bpe, op11_spelling_variants,
    op12_merkle_manifest, op13_word_bpe)}
QUERIES["pipeline"] = corpus_pipeline.run

#: DuckDB statements for those that SQL can express over whole tables.
ORACLE_SQL: dict[str, str] = {"op3_secret_scan": OP3_SQL, "op4_host_quality_rules": OP4_SQL, "op5_warc_revisits": OP5_SQL,
                              "op11_spelling_variants": OP11_SQL, "op12_merkle_manifest": OP12_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
