"""Runs of jobs: tables written per attempt, one commit each, recorded failures.

An attempt writes its tables to folders of its own, which no reader looks at.  One small
commit file, written last, makes them the result of the run; a run that is repeated under
its id replaces its result by the next commit.  A failed attempt is committed as failed,
without tables: the result of an earlier good attempt stays.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_COMMIT = (
    "job string, run_id string, attempt int, token string, status string, error string, "
    "generated_at string, tables array<struct<name:string,path:string>>"
)


class RunStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _exists(self, path: str) -> bool:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)

    def _remove(self, path: str) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)

    def attempts(self) -> DataFrame:
        """All commits, one row per attempt."""
        folder = f"{self.root}/commits"
        if not self._exists(folder):
            return self.spark.createDataFrame([], _COMMIT)
        return self.spark.read.schema(_COMMIT).json(folder)

    def runs(self, good: bool = False) -> DataFrame:
        """The newest attempt of every run, or (``good``) the newest that did not fail."""
        found = self.attempts()
        if good:
            found = found.filter("status <> 'failed'")
        newest = F.row_number().over(W.partitionBy("job", "run_id").orderBy(F.desc("attempt"), F.desc("token")))
        return found.withColumn("_n", newest).filter("_n = 1").drop("_n")

    def run(
        self, job: str, run_id: str, generated_at: str, build: Callable[[], dict[str, DataFrame]], raise_errors: bool = True
    ) -> Row:
        """Do one attempt of a run and return its commit.

        ``build`` gives the tables to write.  Whatever fails, in building or in writing, leaves
        a commit with status ``failed`` and the error, and no table; it is raised again unless
        ``raise_errors`` is off.  ``generated_at`` belongs to the run, so a repeated run gives
        the same rows.
        """
        last = self.attempts().filter((F.col("job") == job) & (F.col("run_id") == run_id)).agg(F.max("attempt")).first()[0]
        attempt, token = (last or 0) + 1, uuid.uuid4().hex
        day = dt.datetime.fromisoformat(generated_at.replace("Z", "+00:00")).date().isoformat()
        own = f"{job}-{hashlib.sha256(run_id.encode()).hexdigest()[:16]}-{attempt}-{token[:12]}"
        written: list[tuple[str, str]] = []
        try:
            for name, rows in build().items():
                path = f"{self.root}/{name}/{day}/{own}"
                written.append((name, path))
                rows.withColumn("run_id", F.lit(run_id)).write.mode("error").parquet(path)
        except Exception as failure:  # whatever it is, it belongs in the record
            for _, path in written:
                self._remove(path)
            text = f"{type(failure).__name__}: {str(failure).strip().splitlines()[0] if str(failure).strip() else ''}"
            commit = self._commit(job, run_id, attempt, token, "failed", text, generated_at, [])
            if raise_errors:
                raise
            return commit
        return self._commit(job, run_id, attempt, token, "committed", None, generated_at, written)

    def _commit(self, *values) -> Row:
        row = self.spark.createDataFrame([values], _COMMIT)
        row.coalesce(1).write.mode("append").json(f"{self.root}/commits")
        return row.first()

    def read(self, job: str, table: str, run_id: str | None = None, newest: bool = False) -> DataFrame | None:
        """A table of the good runs of a job, of one run, or of the newest; ``None`` without such a run.

        Only folders that a commit names are read.
        """
        runs = self.runs(good=True).filter(F.col("job") == job)
        if run_id is not None:
            runs = runs.filter(F.col("run_id") == run_id)
        if newest:
            runs = runs.orderBy(F.desc("generated_at"), F.desc("run_id")).limit(1)
        # A row per run, and a path for each.
        paths = [row.path for row in runs.select(F.explode("tables").alias("t")).select("t.*").filter(F.col("name") == table).collect()]
        return self.spark.read.option("mergeSchema", "true").parquet(*paths) if paths else None

    def documents(self, job: str) -> DataFrame:
        """``company_id``, ``generated_at``, ``document`` and ``run_id`` of every run, a failed one included.

        A run whose newest attempt failed has one document without a company that tells the error.
        """
        body = F.to_json(F.struct("status", "error", "generated_at", "job"))
        failed = self.runs().filter((F.col("job") == job) & (F.col("status") == "failed")).select(
            F.lit(None).cast("string").alias("company_id"), F.col("generated_at").cast("timestamp").alias("generated_at"),
            body.alias("document"), "run_id")
        good = self.read(job, "documents")
        return failed if good is None else good.select(*failed.columns).unionByName(failed)
