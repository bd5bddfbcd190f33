"""The operators of this subpackage over whole tables, with their result contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, jaccard, licenses, lines, lm, mixing, pii, quality_rules, ranker, simhash, spelling, suffixes, whitening

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Rows of one Arrow batch; texts are long, so few of them make a batch of megabytes.
BATCH_ROWS = "512"
PLAN_CHARS = "20000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepared(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    # The driver keeps the texts of a thousand plans; those of iterative operators are long.
    spark.conf.set("spark.sql.maxPlanStringLength", PLAN_CHARS)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        def ready(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepared(spark)
            return run(spark, sf_dir)

        QUERIES[name] = ready
        if sql:
            ORACLES[name] = sql.strip()
        return run

    return add


def hex_digest(text: Column) -> Column:
    return F.sha2(text, 256)


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = quality_rules.trusted_texts(docs, table(spark, sf_dir, "labels"))
    return quality_rules.apply_rules(docs, trusted).drop("text")


@query("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    hit = decontaminate.hit_words("leak_spans")
    return found.select(
        "doc_id", F.col("leak_words").alias("n_words"), hit.alias("n_hit"),
        F.size("leak_items").cast("bigint").alias("n_items"),
        hex_digest(F.array_join("leak_items", ",")).alias("items_sha256"), (hit > 0).alias("contaminated"))


@query("op3_personal_data")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs, pii.train_field(docs))
    counts = [F.regexp_count("base_found", F.lit(f"{kind}:")).cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, hex_digest(F.col("base_found")).alias("base_sha256"), F.col("found").alias("spans"))


@query("op4_simhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op5_suffix_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


@query("op6_license_scan", licenses.oracle())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_context_tree")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score_texts(docs.withColumn("held_out", ranker.held_out("doc_id", 5, 1)), across=True)


@query("op8_quality_ranker")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranking = ranker.classifier(docs, table(spark, sf_dir, "labels"))
    return ranker.score_quality(docs, ranking).select(
        "doc_id", ranker.held_out("doc_id").alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= ranker.CUT).cast("int").alias("predicted"))


@query("op9_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mixing.with_rates(docs, table(spark, sf_dir, "labels")).drop("text")


@query("op10_line_dedup", lines.oracle())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", hex_digest(F.col("text")).alias("kept_sha256"))


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)
    return found.withColumn("deviation", F.col("deviation").try_cast("bigint"))


@query("op12_jaccard_join")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_groups(table(spark, sf_dir, "documents"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"), every=199)
