"""A corpus pipeline over ``documents`` whose stages call operators of ``leadsmith.llm``.

Language ID, quality rules, line dedup, near-duplicates, packing.  Every stage works on
all rows its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadsmith.llm import fertility, language, linewindows, packing, simhash
from leadsmith.llm.common import staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rows(found: DataFrame) -> DataFrame:
    """The documents that a verdict (with the document's columns as _row_<name>) was found on."""
    return found.select(*[F.col(f"_row_{c}").alias(c) for c in COLUMNS])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the language operator rejects go; the row's predicted language replaces a missing one.

    The verdict is the row's own: other rows with its id (or without one) do not count."""
    found = language.identify(docs, keep=COLUMNS).where("not rejected")
    return _rows(found.withColumn("_row_lang", F.coalesce("_row_lang", "lang_pred")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows outside the fertility bands or failing the base rules go, each by its own verdict."""
    judged = fertility.quality(docs, public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json"), keep=COLUMNS)
    return _rows(judged.where("kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines in later occurrences of repeated three-line windows leave the text; a text of one or two lines is one window."""
    out = linewindows.cleaned(docs.select(*COLUMNS), short=True)
    return out.withColumn("n_chars", F.when(F.col("_n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: the smallest id (null after all others), of equal ids one row."""
    return simhash.survivors(docs.select(*COLUMNS)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("packing", pack),
]
#: Packing and the learnt language model have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
