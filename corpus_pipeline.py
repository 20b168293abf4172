"""A corpus pipeline over ``documents``: drop toxic texts and near-copies, decontaminate, redact, pack."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opsmart.llm import decontaminate, packing, secrets, simhash, toxicity
from opsmart.llm.common import materialize
from opsmart.llm.queries import tokenizer_path

SEQUENCE_TOKENS = 2048


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity, learned from ``labels``, is below 0.3. Texts that are null or empty stay."""
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model, 0.3)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of fingerprints within four bits.

    Repeated rows are one row; rows without an id stay. Empty texts share a fingerprint, so one of them stays.
    """
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of ``benchmark`` is found."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts become a mask; every document stays."""
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences: (doc_id, piece, start, length, sequence_id, offset)."""
    pieces = packing.token_pieces(docs, tokenizer_path(), SEQUENCE_TOKENS)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length"), SEQUENCE_TOKENS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: Learned models, fingerprints, token ids and packing have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
