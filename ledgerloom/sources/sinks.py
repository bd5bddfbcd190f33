"""Writing trusted records and run documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lookups import join_lookup
from ..session import materialize

PARTITIONS = ["company_id", "domain", "table", "dt"]
#: The batches that were written, by day; hidden from readers of the table.
MANIFEST = "_batches"
#: A partition with more files than this is worth compacting.
FILES = 8


def trusted_key(file, domain, table, company, raw_root: str = "raw/", trusted_root: str = "trusted/"):
    """Path of the trusted copy of a raw file: route first, ``.gz`` off, ``.json`` on."""
    below = F.regexp_replace(file, f"^.*?{raw_root}", "")
    bare = F.regexp_replace(below, r"\.gz$", "")
    named = F.when(bare.endswith(".json"), bare).otherwise(F.concat(bare, F.lit(".json")))
    return F.concat_ws("/", F.lit(trusted_root.rstrip("/")), company, domain, table, named)


def with_batch(records: DataFrame, file: str = "source_file") -> DataFrame:
    """Add ``dt`` (date of the path) and ``src_batch`` (hash of the file name)."""
    from ..functions.dates import path_date

    day = F.coalesce(path_date(F.col(file)), F.lit("1970-01-01").cast("date"))
    return records.withColumn("dt", day).withColumn("src_batch", F.substring(F.md5(file), 1, 12))


def _save(rows: DataFrame, path: str, fmt: str, mode: str) -> None:
    """Rebalancing gathers the rows of a partition, and AQE splits those that are large, so
    days stay in few files and none in one task."""
    (
        rows.hint("rebalance", *PARTITIONS)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip" if fmt == "json" else "zstd")
        .partitionBy(*PARTITIONS)
        .format(fmt)
        .save(path)
    )


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def _stored(spark: SparkSession, path: str, fmt: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).format(fmt).load(path).select(*like.columns)


def write_trusted(records: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write cleaned records; a replay of the same files replaces what they wrote before.

    Rows of many landing files share the files of their day.  The batches are noted before
    anything is written.  Batches never seen are appended.  Of a batch seen before (a replay,
    or a write that broke off) the old rows go: only the partitions that hold it are written
    again, without it and with its new rows.  No records write nothing.
    """
    spark = records.sparkSession
    rows = materialize(with_batch(records), "trusted-batch")
    batches = materialize(rows.select(*PARTITIONS, "src_batch").distinct(), "batches")
    noted = f"{path}/{MANIFEST}"
    replaced = None
    if _exists(spark, noted):
        days = [row.dt for row in batches.select("dt").distinct().collect()]  # as many as a write has days
        known = spark.read.schema(batches.schema).parquet(noted).filter(F.col("dt").isin(days)).select(*batches.columns).distinct()
        replaced = materialize(join_lookup(known, batches.select("src_batch").distinct(), ["src_batch"], "left_semi"), "replaced")
    batches.write.mode("append").partitionBy("dt").parquet(noted)
    if replaced is None or replaced.isEmpty():
        _save(rows, path, fmt, "append")
        return
    touched = materialize(replaced.select(*PARTITIONS).distinct(), "touched")
    old = materialize(replaced.select("src_batch").distinct(), "old")
    held = join_lookup(_stored(spark, path, fmt, rows), touched, PARTITIONS, "left_semi") if _has_rows(spark, path) else rows.limit(0)
    kept = materialize(join_lookup(held, old, ["src_batch"], "left_anti"), "kept")
    content = kept.unionByName(join_lookup(rows, touched, PARTITIONS, "left_semi"))
    gone = touched.join(content.select(*PARTITIONS).distinct(), PARTITIONS, "left_anti").collect()  # partitions of replayed batches
    _save(content, path, fmt, "overwrite")
    _save(join_lookup(rows, touched, PARTITIONS, "left_anti"), path, fmt, "append")
    for row in gone:
        _remove(spark, "/".join([path, *[f"{name}={row[name]}" for name in PARTITIONS]]))


def _has_rows(spark: SparkSession, path: str) -> bool:
    """Whether the table has any partition yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)
    return any("=" in status.getPath().getName() for status in found)


def _remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def compact_trusted(spark: SparkSession, path: str, files: int = FILES, fmt: str = "parquet") -> int:
    """Write the partitions of more than ``files`` files again, and return how many there were.

    Not to run beside a write of the same days.
    """
    stored = spark.read.format(fmt).load(path).withColumn("_file", F.col("_metadata.file_path"))
    crowded = stored.groupBy(*PARTITIONS).agg(F.count_distinct("_file").alias("n")).filter(F.col("n") > files)
    crowded = materialize(crowded.select(*PARTITIONS), "crowded")
    number = crowded.count()
    if number:
        rows = join_lookup(stored.drop("_file"), crowded, PARTITIONS, "left_semi")
        _save(materialize(rows, "compacted"), path, fmt, "overwrite")
    return number


def write_run(documents: DataFrame, path: str, run_id: str) -> None:
    """Append one run's documents under its day and id."""
    (
        documents.withColumn("run_date", F.to_date("generated_at"))
        .withColumn("run_id", F.lit(run_id))
        .write.mode("append")
        .partitionBy("run_date", "run_id")
        .parquet(path)
    )
