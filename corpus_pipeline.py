"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before kept. All but the last return
the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise.llm import decontaminate, lines, pieces, quality, simhash
from zonewise.session import scratch_path

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
#: SQL can't express the classifier, XXH64 fingerprints or the encoding; tests hold the rows against brute force.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, rejects go."""
    return quality.selected(docs, quality.model(docs, _table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go; n_chars counts what is left."""
    found = lines.without_boilerplate(docs)
    return found.withColumn("n_chars", F.char_length("text").cast("bigint")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest doc_id."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat benchmark items go."""
    return decontaminate.decontaminated(docs, _table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_words, n_tokens, ids, and text_sha256 of the text that the ids decode to."""
    model = pieces.load(TOKENIZER)
    return pieces.encode(docs, model, digests=True).select("doc_id", "n_words", "n_tokens", "ids", "text_sha256")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage kept is written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
