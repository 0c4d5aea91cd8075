"""Votes, disambiguation scores and candidate ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.operators.ranks import placed


def vote_counts(votes: DataFrame, *by: str) -> DataFrame:
    """Votes by choice; a null choice is none of the above and counted as such."""
    return votes.groupBy(*by).agg(F.count("*").alias("votes"))


def sense_votes(senses: DataFrame, votes: DataFrame, key: list[str]) -> DataFrame:
    """Votes of every sense, 0 for those without any."""
    return senses.join(votes.groupBy(*key).agg(F.count("*").alias("votes")), key, "left").withColumn("votes", F.coalesce("votes", F.lit(0)))


def shares(scores: DataFrame, group: list[str], score: str) -> DataFrame:
    """Each score over the group's sum; 0 where that is 0."""
    total = F.sum(score).over(Window.partitionBy(*group))
    return scores.withColumn("share", F.when(total == 0, 0.0).otherwise(F.col(score) / total))


def selected(scores: DataFrame, group: list[str], candidate: str, score: str) -> DataFrame:
    """Mean over the evaluators that have a score, renormalised, and the best (ties: least candidate)."""
    mean = scores.where(F.col(score).isNotNull()).groupBy(*group, candidate).agg(F.avg(score).alias("mean_score"))
    w = Window.partitionBy(*group)
    total = F.sum("mean_score").over(w)
    out = mean.withColumn("final_score", F.when(total > 0, F.col("mean_score") / total).otherwise(F.col("mean_score")))
    return out.withColumn("is_best", F.row_number().over(w.orderBy(F.desc("mean_score"), candidate)) == 1)


def distinguishing(parses: DataFrame, group: list[str], feature: str, candidate: str) -> DataFrame:
    """Features of a candidate that not all candidates of its group share; all of them if none."""
    n = parses.groupBy(*group).agg(F.countDistinct(candidate).alias("_n"))
    common = parses.groupBy(*group, feature).agg(F.countDistinct(candidate).alias("_c"))
    marked = parses.join(common, [*group, feature]).join(n, group).withColumn("_own", F.col("_c") < F.col("_n"))
    some = F.max(F.col("_own").cast("int")).over(Window.partitionBy(*group))
    return marked.withColumn("_some", some).where(F.col("_own") | (F.col("_some") == 0)).drop("_n", "_c", "_own", "_some")


def ranked_candidates(candidates: DataFrame, group: str) -> DataFrame:
    """Order by votes, then the current choice, then occurrences; ties by id. A group of any size is spread over tasks."""
    return placed(candidates, [group], [F.desc("votes"), F.desc("is_current"), F.desc("max_occ"), F.col("entity_id")])


def verified(chunks: DataFrame, parent: str, failed: str) -> DataFrame:
    """SUCCESS, or CHILD_FAILURE for parents of which a chunk failed, or FAILURE where all did."""
    counts = chunks.groupBy(parent).agg(F.count("*").alias("n_chunks"), F.sum(F.col(failed).cast("int")).alias("n_failed"))
    return counts.withColumn("status", F.when(F.col("n_failed") == 0, "SUCCESS").when(F.col("n_failed") == F.col("n_chunks"), "FAILURE").otherwise("CHILD_FAILURE"))
