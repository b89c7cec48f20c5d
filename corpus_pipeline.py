"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

Toxic documents go, of near copies one stays, repeated lines and sentences are cut, benchmark passages are cut, and what
is left is encoded. Every stage keeps the columns of ``documents`` but the last; ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rotorlake.llm import decontaminate, lines, piece_codec, shingles, toxicity
from rotorlake.session import shared_folder

BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lean(spark: SparkSession) -> None:
    """Batches of a thousand texts: a stage's executors keep what earlier stages have grown, so batches stay small."""
    if int(spark.conf.get(BATCH_CONF)) > BATCH_ROWS:
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from these documents and all labels, does not call toxic."""
    _lean(spark)
    return toxicity.clean(docs, _table(spark, sf_dir, "labels"), lambda doc_id: F.lit(True))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies."""
    _lean(spark)
    return shingles.clean(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without paragraphs, lines and sentences that an earlier document or place holds."""
    _lean(spark)
    return _counted(lines.clean(docs, whole=True))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of the benchmark."""
    _lean(spark)
    return _counted(decontaminate.clean(docs, _table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids with their digests, and the digest of the text decoded from them."""
    _lean(spark)
    return piece_codec.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", cut_benchmark),
    ("sentencepiece", encode),
]

#: SQL cannot express the classifier or the encoder; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
