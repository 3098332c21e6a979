"""A training corpus from raw documents: each stage takes what the stage before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caelum.llm.common import cut, table
from caelum.llm.decontaminate import decontaminate
from caelum.llm.line_dedup import dedup_lines
from caelum.llm.near_dup import one_of_each
from caelum.llm.quality import sample
from caelum.llm.sentence_pieces import encode


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards good text keeps."""
    return sample(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without later copies of repeated line runs, and without documents of which nothing is left."""
    return dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles agree by 80 per cent or more."""
    return one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold ten words of a benchmark item in a row."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document and the scores of its four best segmentations."""
    return encode(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding", piece_encoding),
]

#: SQL can express neither the hashed models and sampling nor the N-best search; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = cut(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
