"""The subpackage's queries (``QUERIES``) and their SQL (``ORACLE``)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import (op1_quality, op2_chains, op3_mix, op4_planes, op5_topk, op6_licenses,
                         op7_suffixes, op8_pieces, op9_jaccard, op10_html, op11_trees, op12_runs, op13_phrases)
from tessera.llm.common import ship
from tessera.llm.sql import ORACLE  # noqa: F401


def _table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def op1_line_quality(spark, base):
    return op1_quality.quality(_table(spark, base, "documents"))


def op2_fuzzy_passages(spark, base):
    return op2_chains.passages(_table(spark, base, "documents"))


def op3_budget_mix(spark, base):
    return op3_mix.mix(_table(spark, base, "documents"))


def op4_bit_planes(spark, base):
    return op4_planes.encode_and_read(_table(spark, base, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op5_tiled_topk(spark, base):
    return op5_topk.search(_table(spark, base, "embeddings"))


def op6_license_rules(spark, base):
    return op6_licenses.scan(_table(spark, base, "documents"))


def op7_suffix_dedup(spark, base):
    return op7_suffixes.digest(_table(spark, base, "documents"))


def op8_nbest_pieces(spark, base):
    return op8_pieces.digest(_table(spark, base, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_ngram_join(spark, base):
    return op9_jaccard.components(_table(spark, base, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_main_text(spark, base):
    return op10_html.extract(_table(spark, base, "pages"))


def op11_context_trees(spark, base):
    return op11_trees.score(_table(spark, base, "documents"))


def op12_convolved_runs(spark, base):
    return op12_runs.digest(op12_runs.runs(_table(spark, base, "documents"), rewrite=op12_runs.planted))


def op13_stream_phrases(spark, base):
    return op13_phrases.collocations(_table(spark, base, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_line_quality, op2_fuzzy_passages, op3_budget_mix, op4_bit_planes, op5_tiled_topk, op6_license_rules, op7_suffix_dedup,
    op8_nbest_pieces, op9_ngram_join, op10_main_text, op11_context_trees, op12_convolved_runs,
    op13_stream_phrases)}
