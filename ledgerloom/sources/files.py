"""Reading raw and trusted files, choosing files, and writing results."""

from __future__ import annotations

import gzip as gzip_module
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.lookups import join_lookup
from ..session import materialize


#: A file beyond this size is not read into one row.  Gzip grows about tenfold when read.
WHOLE_BYTES = 64 << 20
GZIP_BYTES = 8 << 20
OUTCOMES = ("read", "no_records", "empty", "unreadable")


def read_raw_lines(
    spark: SparkSession, path: str, pattern: str | None = None, under: str | None = None
) -> DataFrame:
    """Raw text lines with their file; gzip by suffix.  A corrupt file fails the read.

    ``under`` keeps files whose path holds that folder, such as ``raw/``; others are not opened.
    """
    reader = spark.read.option("ignoreCorruptFiles", "false")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if under:
        reader = reader.option("recursiveFileLookup", "true")
    lines = with_lineage(reader.text(path).withColumnRenamed("value", "line"))
    return lines.filter(F.contains("source_file", F.lit(f"/{under.strip('/')}/"))) if under else lines


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``source_file``, ``source_modified`` and ``bytes`` of every file below ``path``, which are not opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    listed = files.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_modified"),
        F.col("_metadata.file_size").alias("bytes"),
    )
    # A scan leaves out files without a byte; the index, which the driver holds anyway, has them.
    every = files.inputFiles()
    if len(every) == listed.count():
        return listed
    names = spark.createDataFrame([(re.sub("^file:/+", "file:/", name),) for name in every], "source_file string")
    empty = names.join(listed, "source_file", "left_anti").select(
        "source_file", F.lit(None).cast("timestamp").alias("source_modified"), F.lit(0).cast("bigint").alias("bytes"))
    return listed.unionByName(empty)


def with_lineage(df: DataFrame) -> DataFrame:
    """Add ``source_file`` and ``source_modified`` to rows of a file source."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_modified"),
    )


def read_polyglot(spark: SparkSession, path: str, layout: str = "document") -> DataFrame:
    """Trusted records as a ``raw`` map, from files in any of three layouts.

    A whole file may be one JSON object, or an array whose objects count, or JSON lines.
    Bad lines and non-objects are skipped, unreadable files too.  Landing files are
    bounded by the delivery buffer, so a whole one fits a row; ``layout="lines"`` reads
    line by line, for files known to hold JSON lines only.
    """
    reader = spark.read.option("ignoreCorruptFiles", "true")
    if layout == "lines":
        parsed = with_lineage(reader.text(path)).withColumn("_v", F.try_parse_json("value"))
    else:
        text = with_lineage(reader.option("wholetext", "true").text(path))
        parsed = text.withColumn("_v", F.explode(file_items(F.col("value"))))
    return (
        parsed.withColumn("raw", F.try_variant_get(F.col("_v"), "$", "map<string,variant>"))
        .filter("raw IS NOT NULL")
        .select("raw", "source_file", "source_modified")
    )


def file_items(text: Column) -> Column:
    """The JSON items of a whole file: one object, the entries of an array, or its lines (NULL where broken)."""
    whole = F.try_parse_json(text)
    entries = F.try_variant_get(whole, "$", "array<variant>")
    filled = F.filter(F.split(text, r"\r\n|\r|\n"), lambda line: F.trim(line) != "")
    lines = F.transform(filled, lambda line: F.try_parse_json(F.trim(line)))
    return F.when(whole.isNull(), lines).when(entries.isNotNull(), entries).otherwise(F.array(whole))


def read_accounted(
    spark: SparkSession, path: str, chosen: DataFrame | None = None, whole: int = WHOLE_BYTES, gzip: int = GZIP_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Trusted records, and an account of every file.

    Records have ``raw``, ``source_file``, ``source_modified`` and ``position`` (of the item in
    its file).  The account has ``source_file``, ``source_modified``, ``bytes``, ``outcome``,
    ``records`` and ``bad_items``; an outcome is one of ``OUTCOMES``.  Layouts are those of
    ``read_polyglot``; a file that is no whole gzip, or no UTF-8, is unreadable and does not stop
    the others.  Files too large for one row (``whole`` bytes, ``gzip`` if compressed) must hold
    JSON lines, and a corrupt one of them fails the read.  ``chosen`` has the ``source_file`` of
    the files to read, with any columns to carry (a written table); all by default.

    Everything is parsed once: items are written, and both results read them.
    """
    listing = list_files(spark, path)
    carried = [c for c in chosen.columns if c not in listing.columns] if chosen is not None else []
    if chosen is not None:
        listing = join_lookup(listing, chosen.select("source_file", *carried), ["source_file"], "inner")
    listing = materialize(listing, "listing")
    size = F.col("_metadata.file_size")
    large = size > F.when(F.endswith(F.col("_metadata.file_path"), F.lit(".gz")), F.lit(gzip)).otherwise(F.lit(whole))
    reader = spark.read.option("recursiveFileLookup", "true")
    wanted = listing.select("source_file", *carried)

    def rows(text: DataFrame) -> DataFrame:
        return join_lookup(with_lineage(text), wanted, ["source_file"], "inner")

    small = rows(reader.option("ignoreCorruptFiles", "true").option("wholetext", "true").text(path).filter(~large))
    readable = F.when(F.is_valid_utf8("value"), F.col("value"))
    small = small.withColumn("_items", file_items(readable)).select(
        "source_file", "source_modified", *carried, readable.isNull().alias("_broken"), F.crc32("value").alias("_crc"),
        F.posexplode_outer(F.transform("_items", lambda item: F.struct(item.alias("v")))).alias("position", "_item"))
    lines = rows(reader.option("ignoreCorruptFiles", "false").option("wholetext", "false").text(path).filter(large))
    lines = lines.filter("trim(value) <> ''").select(
        "source_file", "source_modified", *carried, F.lit(False).alias("_broken"), F.lit(None).cast("bigint").alias("_crc"),
        F.monotonically_increasing_id().alias("position"), F.struct(F.try_parse_json("value").alias("v")).alias("_item"))
    items = small.withColumn("position", F.col("position").cast("bigint")).unionByName(lines)
    items = materialize(items.select(
        "source_file", "source_modified", *carried, "position", "_broken", "_crc", F.col("_item").isNotNull().alias("_found"),
        F.try_variant_get(F.col("_item.v"), "$", "map<string,variant>").alias("raw")), "items")
    per = items.groupBy("source_file").agg(
        F.count("raw").alias("records"), F.count_if(F.col("_found") & F.col("raw").isNull()).alias("bad_items"),
        F.bool_or("_broken").alias("_broken"), F.max("_crc").alias("_crc"))
    per = materialize(per, "per-file")
    torn = _torn_files(spark, path, per.filter(F.endswith("source_file", F.lit(".gz")) & F.col("_crc").isNotNull()))
    bad = F.coalesce("_broken", F.lit(True))
    if torn:
        lost = materialize(spark.createDataFrame([(name,) for name in torn], "source_file string"), "torn")
        items = join_lookup(items, lost, ["source_file"], "left_anti")
        per = join_lookup(per, lost.withColumn("_torn", F.lit(True)), ["source_file"])
        whole_one = F.col("_torn").isNull()
        per = per.withColumns({c: F.when(whole_one, F.col(c)).otherwise(0) for c in ("records", "bad_items")})
        per = per.withColumn("_broken", F.col("_broken") | ~whole_one).drop("_torn")
    account = listing.join(per, "source_file", "left").withColumn(
        "outcome",
        F.when(F.col("bytes") == 0, "empty").when(bad, "unreadable")
        .when(F.col("records") > 0, "read").otherwise("no_records"),
    ).drop("_broken", "_crc").fillna(0, ["records", "bad_items"])
    return items.filter("raw IS NOT NULL").drop("_broken", "_found", "_crc"), account


def _torn_files(spark: SparkSession, path: str, found: DataFrame) -> list[str]:
    """The gzip files that end too early, which a reader takes for shorter ones.

    ``found`` has ``source_file`` and ``_crc``, the checksum of what was read.  It is compared
    with the one at the end of the file; only files where they differ (torn ones, and those of
    several parts) are unpacked again to see.
    """
    packed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path)
    packed = packed.select(F.col("_metadata.file_path").alias("source_file"), "content")
    tail = F.hex(F.substring("content", -8, 4))
    told = F.conv(F.concat(*[F.substring(tail, at, 2) for at in (7, 5, 3, 1)]), 16, 10).cast("bigint")
    tails = packed.select("source_file", told.alias("told"))
    odd = found.join(tails, "source_file").filter(~F.col("_crc").eqNullSafe(F.col("told"))).select("source_file")
    odd = materialize(odd, "odd")
    if odd.isEmpty():
        return []

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            torn = []
            for name, content in zip(batch.column("source_file").to_pylist(), batch.column("content").to_pylist()):
                try:
                    gzip_module.decompress(content)
                except (OSError, EOFError, zlib.error):
                    torn.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(torn, pa.string())], ["source_file"])

    checked = join_lookup(packed, odd, ["source_file"], "left_semi").mapInArrow(check, "source_file string")
    return [row.source_file for row in checked.collect()]  # names of broken files


def file_listing(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per file of a lineage-bearing table."""
    return rows.groupBy(*(by or []), "source_file").agg(
        F.max("source_modified").alias("source_modified"), F.count("*").alias("rows")
    )


def bounded_files(
    rows: DataFrame, n: int, by: list[str], order: str = "key_asc", listing: DataFrame | None = None
) -> DataFrame:
    """Rows of the first ``n`` files per ``by``: by path, or newest first.

    The choice is made on the file list; the rows only meet the chosen names.
    """
    files = listing if listing is not None else file_listing(rows, by)
    terms = {
        "key_asc": [F.asc("source_file")],
        "mtime_desc": [F.desc("source_modified"), F.asc("source_file")],
    }[order]
    place = F.row_number().over(W.partitionBy(*by).orderBy(*terms))
    chosen = materialize(
        files.withColumn("_n", place).filter(F.col("_n") <= n).select(*by, "source_file"), "files"
    )
    return join_lookup(rows, chosen, [*by, "source_file"], "left_semi")


def latest_batch(rows: DataFrame, by: list[str], tail: int | None = None, order: list | None = None) -> DataFrame:
    """Rows of the newest file per ``by``, or only its last ``tail`` rows."""
    newest = bounded_files(rows, 1, by, "mtime_desc")
    if tail is None:
        return newest
    place = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return newest.withColumn("_n", place).filter(F.col("_n") <= tail).drop("_n")


def merge_schemas(frames: list[DataFrame]) -> DataFrame:
    """Union of tables with compatible schemas; a missing column reads as NULL."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged


def register_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Register a parquet folder as a table, or bring the table up to date with the folder.

    The columns of all files are merged; later calls add new columns and recover new
    partitions, so rows written before a column existed read as NULL in it.
    """
    merged = spark.read.option("mergeSchema", "true").parquet(path)
    folders = merged.select("_metadata.file_path").limit(1).collect()
    below = folders[0][0].rpartition(path.rstrip("/").rpartition("/")[2] + "/")[2].split("/")[:-1] if folders else []
    partitions = [folder.partition("=")[0] for folder in below if "=" in folder]
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{n}` {t}" for n, t in merged.dtypes)
        by = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {by} LOCATION '{path}'")
    else:
        known = {n.lower() for n in spark.table(name).columns}
        new = ", ".join(f"`{n}` {t}" for n, t in merged.dtypes if n.lower() not in known)
        if new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({new})")
    if partitions:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)
