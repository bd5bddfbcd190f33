"""What a job reads: records of its datasets and an account of the files they come from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.cdc import clean_lines
from ..operators.lookups import join_lookup
from ..session import materialize
from ..sources import files
from ..sources.sinks import write_trusted

DATASETS = ("employees", "finance")
#: Positions of items in a file stay below this, so file number and position make one number.
_FILE = 1 << 32


@dataclass
class Inputs:
    """``records``: company_id, domain, table, raw, source_file, source_modified, seq (order of reading).

    ``files``: company_id, domain, table, source_file, bytes, outcome, records, bad_items.
    ``companies``: company_id of all that the job is to answer for.
    """

    records: DataFrame
    files: DataFrame
    companies: DataFrame

    def counts(self) -> DataFrame:
        """Records and input files of each company and dataset, zero where there are none."""
        per = self.files.groupBy("company_id").agg(*[
            agg for domain in DATASETS for agg in (
                F.sum(F.when(F.col("domain") == domain, F.col("records"))).alias(domain),
                F.count_if(F.col("domain") == domain).alias(f"{domain}_files"),
                F.count_if((F.col("domain") == domain) & (F.col("outcome") == "unreadable")).alias(f"{domain}_unreadable"))
        ])
        return self.companies.join(per, "company_id", "left").fillna(0)


def _scoped(listing: DataFrame) -> DataFrame:
    """Company, domain and table from ``<company>/<domain>[/<table>]/...`` below the root; ``name=`` in a folder is left out."""
    parts = F.split("below", "/")

    def part(n: int):
        return F.regexp_replace(F.try_element_at(parts, F.lit(n)), "^[A-Za-z_]+=", "")

    return listing.select(
        "*", part(1).alias("company_id"), part(2).alias("domain"),
        F.when((F.size(parts) > 3) & ~part(3).rlike(r"^[0-9]{4}$"), part(3)).otherwise("").alias("table"),
    ).filter(F.col("domain").isin(*DATASETS)).drop("below")


def file_inputs(
    spark: SparkSession, root: str, companies: DataFrame | None = None, max_files: int | None = None,
    prefer_transactions: bool = False,
) -> Inputs:
    """Records of trusted files, JSON in any layout, kept as ``<root>/<company>/<domain>/[<table>/]...``.

    ``max_files`` takes the first so many of each company and domain by path; all by default.
    ``prefer_transactions`` leaves out other finance files of a company that has files of
    transactions.  Unreadable files are in the account and do not stop the job.
    """
    base = "/" + root.rstrip("/").rpartition("/")[2] + "/"
    listing = files.list_files(spark, root)
    listing = _scoped(listing.withColumn("below", F.substring_index("source_file", base, -1)))
    if companies is not None:
        listing = join_lookup(listing, companies.select("company_id"), ["company_id"], "left_semi")
    if prefer_transactions:
        has = F.bool_or((F.col("domain") == "finance") & (F.col("table") == "transactions")).over(W.partitionBy("company_id"))
        listing = listing.withColumn("_has", has).filter(
            (F.col("domain") != "finance") | ~F.col("_has") | (F.col("table") == "transactions")).drop("_has")
    place = F.row_number().over(W.partitionBy("company_id", "domain").orderBy("source_file"))
    listing = listing.withColumn("file_number", place)
    if max_files is not None:
        listing = listing.filter(F.col("file_number") <= max_files)
    chosen = materialize(listing.select("source_file", "company_id", "domain", "table", "file_number"), "chosen")
    records, account = files.read_accounted(spark, root, chosen)
    records = records.withColumn("seq", F.col("file_number").cast("bigint") * F.lit(_FILE) + F.col("position"))
    return Inputs(
        records.drop("file_number", "position"), account.drop("file_number", "source_modified"),
        materialize(chosen.select("company_id").distinct(), "companies") if companies is None else companies.select("company_id"))


def table_inputs(spark: SparkSession, path: str, companies: DataFrame | None = None, prefer_transactions: bool = False) -> Inputs:
    """Records of the trusted table, which the cleaning has checked already; its files are the landing files."""
    rows = spark.read.parquet(path).withColumn("company_id", F.col("company_id").cast("string"))
    if companies is not None:
        rows = join_lookup(rows, companies.select("company_id"), ["company_id"], "left_semi")
    raw = F.try_variant_get(F.try_parse_json("record"), "$", "map<string,variant>")
    rows = rows.select(
        "company_id", "domain", "table", "source_file", F.lit(None).cast("timestamp").alias("source_modified"),
        raw.alias("raw"), F.lit(0).cast("bigint").alias("seq"))
    account = rows.groupBy("company_id", "domain", "table", "source_file").agg(
        F.lit(None).cast("bigint").alias("bytes"), F.lit("read").alias("outcome"), F.count("raw").alias("records"),
        F.count_if(F.col("raw").isNull()).alias("bad_items"))
    account = materialize(account, "account")
    if prefer_transactions:
        have = materialize(account.filter("domain = 'finance' AND table = 'transactions'").select("company_id").distinct(), "have")
        other = "domain = 'finance' AND table <> 'transactions'"

        def preferred(df: DataFrame) -> DataFrame:
            left = join_lookup(df.filter(other), have, ["company_id"], "left_anti")
            return df.filter(f"NOT ({other})").unionByName(left)

        rows, account = preferred(rows), preferred(account)
    known = materialize(account.select("company_id").distinct(), "companies") if companies is None else companies.select("company_id")
    return Inputs(rows.filter("raw IS NOT NULL"), account, known)


def ingest_raw(spark: SparkSession, raw: str, company, trusted: str, under: str = "raw/") -> None:
    """Raw landing files into the trusted table; a corrupt file stops it, as nothing may be lost there."""
    lines = files.read_raw_lines(spark, raw, under=under)
    write_trusted(clean_lines(lines.withColumn("company_id", F.lit(company) if isinstance(company, str) else company)), trusted)
