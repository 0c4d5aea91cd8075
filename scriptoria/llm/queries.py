"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.llm import sql
from scriptoria.llm.audit import audited
from scriptoria.llm.common import remainder
from scriptoria.llm.decontaminate import contaminated
from scriptoria.llm.langid import identified, train_languages
from scriptoria.llm.licenses import scan_licenses
from scriptoria.llm.lm import score_katz
from scriptoria.llm.mpeg import audio_columns
from scriptoria.llm.near_dup import near_duplicates
from scriptoria.llm.pieces import encoded
from scriptoria.llm.quality import score_quality, train_quality
from scriptoria.llm.runs import periodic_runs
from scriptoria.llm.toxicity import score_toxicity, train_toxicity
from scriptoria.llm.urls import filter_urls, page_signals
from scriptoria.llm.warc import round_trip

#: The public model that op4 and the pipeline encode with; another path may be given.
PIECES = os.environ.get("SCRIPTORIA_PIECES", "/opt/tokenizers/piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: (verdict, host and path prefix) of op1's explicit rules.
RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No table labels pages: the labels are signals of the pages themselves."""
    pages = _table(spark, sf_dir, "pages")
    return filter_urls(pages, page_signals(pages), RULES)


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at 80 of 100 shared four-word shingles, and the components they make."""
    return near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=80)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text scored by the bigrams of those whose remainder by 7 is not 2."""
    return score_katz(_table(spark, sf_dir, "documents"), lambda doc_id: remainder(doc_id, 7) != 2)


def _judged(scored: DataFrame, modulus: int, held: int) -> DataFrame:
    out = remainder(F.col("doc_id"), modulus) == held
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's pieces, and whether they give it back."""
    return encoded(_table(spark, sf_dir, "documents"), PIECES)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's quality, learnt from labels whose remainder by 4 is not 2."""
    docs = _table(spark, sf_dir, "documents")
    model = train_quality(docs, _table(spark, sf_dir, "labels"), lambda doc_id: remainder(doc_id, 4) != 2)
    return _judged(score_quality(docs, model), 4, 2)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's toxicity, learnt from labels whose remainder by 3 is not 1."""
    docs = _table(spark, sf_dir, "documents")
    model = train_toxicity(docs, _table(spark, sf_dir, "labels"), lambda doc_id: remainder(doc_id, 3) != 1)
    return _judged(score_toxicity(docs, model), 3, 1)


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as an audio stream and read back."""
    return audio_columns(_table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back from them."""
    return round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that a whole text, or a line of it, is."""
    return scan_licenses(_table(spark, sf_dir, "documents"))


def planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which every tenth text, by crc32 of its id, goes on from some word with a period; null ids have their text as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("words", F.when(h % 10 == 0, words)).withColumn("g", F.floor(h / 10)).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1).cast("int"))
    left = F.col("n") - F.col("a")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(left / F.col("p")).cast("int"))), F.lit(1), left)
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole text, the longest of them, and digests of all runs and of the text without repetitions."""
    found = periodic_runs(planted_runs(_table(spark, sf_dir, "documents")))
    first = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    found = found.withColumn("longest", F.get(first, F.lit(0)))
    length = -F.col("longest.l")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        length.alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(1000 * length / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learnt from those whose remainder by 5 is not 0."""
    docs = _table(spark, sf_dir, "documents")
    found = identified(docs, train_languages(docs, lambda doc_id: remainder(doc_id, 5) != 0))
    return found.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "ambiguous")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents, by source, in all 120 orders."""
    return audited(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_near_dup": op2_near_dup,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_pieces": op4_pieces,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_media": op7_media,
    "op8_decontaminate": op8_decontaminate,
    "op9_warc": op9_warc,
    "op10_licenses": op10_licenses,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_language_id": op12_language_id,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES: dict[str, str] = {
    "op8_decontaminate": sql.decontaminated(),
    "op10_licenses": sql.licenses(),
    "op13_filter_audit": sql.audited(),
    "op9_warc": "WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages), r AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY d, n >= 1000) END AS top FROM p) SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest, CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < top THEN top END AS refers_to FROM r",
}
