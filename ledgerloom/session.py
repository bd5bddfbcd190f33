"""Session settings and materialisation of intermediate results."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "ledgerloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every operator here relies on.

    Time zone is UTC because records carry UTC instants.  AQE picks shuffle
    partition counts, turns joins into broadcasts once the real size is known and
    splits skewed join partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for written intermediates: the one the cluster names.

    A folder of our own is chosen only where none is named, and only in local mode;
    elsewhere a machine-local folder would be lost with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    folder = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system remove ``path`` when the application ends, also after an error."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Used where several consumers share rows that are costly to compute (Python
    scores).  A parquet table survives executor loss and is read back by column.  It is
    removed when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _remove_at_exit(spark, path)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")  # the table replaces the shuffles that led to it
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove the files of a table that ``materialize`` wrote, once nothing reads it any more."""
    root = shared_dir(table.sparkSession).rpartition(":")[2]
    for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
        if root in folder:
            spark = table.sparkSession
            hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def computed_once(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with the given columns fixed, so that no later filter is pushed below them.

    A filter on a parsed column would otherwise be rewritten in terms of the raw text and
    parse it again, once per mention.  Filters do not move below a generator; this one
    gives exactly one row per row.
    """
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.inline(F.array(F.struct(*columns))))


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once per application, for the Python tasks."""
    context = spark.sparkContext
    if any("ledgerloom-code" in path for path in context.listFiles):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="ledgerloom-")) / "ledgerloom-code.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(root.rglob("*.py")):
            bundle.write(source, Path(root.name) / source.relative_to(root))
    context.addPyFile(str(archive))


def by_task(df: DataFrame, *keys: str) -> DataFrame:
    """Hash partitions for grouped Python work, as many as the cluster has cores or more.

    AQE sizes partitions by bytes and would put these small but compute-heavy groups into
    one task; a given number is left alone, and the grouping reuses this partitioning.
    """
    spark = df.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(wanted, 2 * spark.sparkContext.defaultParallelism), *keys)
