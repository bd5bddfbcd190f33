"""From raw documents to a training mix: five stages, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, lines, mixing, ranker, simhash
from ledgerloom.llm.queries import prepared, table
from ledgerloom.session import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking does not reject."""
    prepared(spark)
    ranking = ranker.classifier(docs, table(spark, sf_dir, "labels"))
    scored = ranker.score_quality(docs, ranking)
    return scored.filter(F.col("quality_score") >= ranker.CUT).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that match an earlier line."""
    prepared(spark)
    return lines.remove_lines(docs)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    prepared(spark)
    return simhash.keep_first(docs, groups=simhash.similar_groups)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    prepared(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with how often to read each."""
    prepared(spark)
    return mixing.mix(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", keep_one_of_group),
    ("decontaminate", drop_benchmark),
    ("mixing", mix_to_targets),
]

#: Model scores, similarity joins and fitted rates have no plain SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the stages leave of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
