"""Streaming cleaning of landed files, and deduplication across them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.cdc import content_hash, line_records, parse_lines, standardize_times, trusted_records
from ..sources.files import with_lineage
from ..sources.sinks import write_trusted


def raw_stream(spark: SparkSession, path: str, max_bytes: int = 5 << 20) -> DataFrame:
    """Lines of files as they land below ``path``, about ``max_bytes`` of files per batch."""
    reader = spark.readStream.format("text").option("maxBytesPerTrigger", str(max_bytes))
    lines = reader.option("recursiveFileLookup", "true").load(path)
    return with_lineage(lines.withColumnRenamed("value", "line"))


#: A batch's rejects and backup are in a file for so many lines, in one for each task at most.
LINES = 100_000


def _dealt_out(lines: DataFrame) -> DataFrame:
    """Lines spread over all cores: a gzip file is read by one task, and reading is the least of the work."""
    number = 2 * lines.sparkSession.sparkContext.defaultParallelism
    return lines.withColumn("_n", F.monotonically_increasing_id()).repartition(number, "_n").drop("_n")


def start_ingest(
    lines: DataFrame,
    company,
    trusted: str,
    rejects: str,
    backup: str,
    checkpoint: str,
    every: str | None = "60 seconds",
) -> StreamingQuery:
    """Clean every batch into ``trusted``, keep rejected lines and a copy of the raw ones.

    A line is parsed once, whatever is made of it, and the lines of a file by many tasks.
    Each file is one source batch of the trusted table, so a batch that runs again
    replaces its own output; rejects and backup are keyed by batch for the same reason.
    ``every=None`` processes what has landed and stops.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch = batch.withColumn("company_id", F.lit(company))
        lines = line_records(_dealt_out(batch)).persist()
        try:
            files = lines.count() // LINES + 1
            write_trusted(trusted_records(lines), trusted)
            rejected = lines.select(*batch.columns, "reject").filter("reject IS NOT NULL")
            rejected.coalesce(files).write.mode("overwrite").parquet(f"{rejects}/batch={epoch}")
            copy = lines.select(*batch.columns).coalesce(files)
            copy.write.mode("overwrite").option("compression", "gzip").json(f"{backup}/batch={epoch}")
        finally:
            lines.unpersist()

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_records(lines: DataFrame) -> DataFrame:
    """Cleaned records of a stream with their hash; copies across files stay."""
    good = standardize_times(parse_lines(lines).filter("route IS NOT NULL"))
    return good.select(
        "company_id", "route", "source_file", "source_modified",
        content_hash().alias("row_hash"), F.to_json("raw").alias("record"),
    )


def start_dedupe(
    records: DataFrame, out: str, checkpoint: str, every: str | None = "60 seconds"
) -> StreamingQuery:
    """Write every record once per company, route and hash, however late a copy arrives.

    The keys seen so far are the stream's own state, without a watermark: nothing is
    forgotten, no late file is dropped, and a batch reads nothing but its own files.  The
    state is kept on disk, by key, and only its changes are checkpointed.  A batch that
    runs again replaces its own output.
    """
    state_on_disk(records.sparkSession)
    keys = ["company_id", "route", "row_hash"]

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        records.dropDuplicates(keys).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


_STORE = "spark.sql.streaming.stateStore"


def state_on_disk(spark: SparkSession) -> None:
    """Keep the state of streams in embedded stores on disk, unless the session has chosen a store.

    The default store holds all state in memory, which a state that only grows outlives.
    """
    if spark.conf.get(f"{_STORE}.providerClass").endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(
            f"{_STORE}.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        spark.conf.set(f"{_STORE}.rocksdb.changelogCheckpointing.enabled", "true")
