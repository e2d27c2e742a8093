"""One query per operator of this folder over the supplied tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from leadsmith.llm import bytebpe, fertility, language, linewindows, packing, periodic, pii, revisits, seekable, simhash, toxicity, vamana, variants
from leadsmith.llm.common import table


def op1_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.resolved_pages(table(spark, sf_dir, "pages"))


def op2_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_vamana(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vamana.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


def op4_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linewindows.line_dedup(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_seekable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seekable.written_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"), misspelt=97)


def op12_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), plant=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_revisits, op2_fertility, op3_vamana, op4_line_windows, op5_simhash, op6_seekable, op7_ftrl,
                            op8_centroids, op9_packing, op10_byte_bpe, op11_spelling_variants, op12_pii_spans, op13_periodic_runs)}
ORACLE: dict[str, str] = {"op1_revisits": revisits.ORACLE_SQL, "op4_line_windows": linewindows.ORACLE_SQL}
