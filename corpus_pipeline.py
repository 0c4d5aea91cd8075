"""A training corpus in five stages, each a function (spark, docs, sf_dir) -> DataFrame.

All but the last return the columns of documents. Rows with a null doc_id or text pass every stage
that cannot judge them: they have no label, no copies that could be named and hold no benchmark
passage; a null text is scored as an empty one. Rows that repeat a doc_id are one document
to the duplicate and benchmark stages. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.llm.common import saved
from scriptoria.llm.decontaminate import contaminated
from scriptoria.llm.near_dup import near_duplicates
from scriptoria.llm.pieces import encoded
from scriptoria.llm.quality import score_quality, train_quality
from scriptoria.llm.queries import PIECES
from scriptoria.llm.toxicity import score_toxicity, train_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Scores at which a document counts as toxic, and as good.
TOXIC, GOOD = 0.7, 0.7


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score, learnt from all labels, is below TOXIC."""
    model = train_toxicity(docs, _labels(spark, sf_dir), lambda doc_id: F.lit(True))
    return score_toxicity(docs, model, ("lang", "source", "n_chars")).where(F.col("score") < TOXIC).select(*COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score, learnt from the labels of what is left, is at least GOOD."""
    model = train_quality(docs, _labels(spark, sf_dir), lambda doc_id: F.lit(True))
    return score_quality(docs, model, ("lang", "source", "n_chars")).where(F.col("score") >= GOOD).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by five-word shingles at 0.8."""
    copies = near_duplicates(docs, words=5, percent=80).where("doc_id is not null and not kept").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(copies, "doc_id", "left_anti").select(*COLUMNS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    leaks = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(saved(leaks, "leaks"), "doc_id", "left_anti").select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_pieces, round_trip) of every document left."""
    return encoded(docs, PIECES)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("SentencePiece encoding and decoding", encode_pieces),
]
#: No stage before the fourth can be stated in SQL; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of sf_dir, each on what the one before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
