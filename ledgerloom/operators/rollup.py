"""A daily roll-up of finance rows that the dashboard figures are read from.

One aggregation of the rows gives, per company, day and label, exact sums, counts and the
largest expenses; everything the dashboard and the notes say of finance follows from it.
The written roll-up is kept up to date by days: only days that new rows touch are computed
again, from the trusted rows of these days, so a repeated refresh changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.values import exact
from ..session import materialize
from .lookups import join_lookup

KEYS = ("company_id",)
#: Largest expenses kept of a day and label; as many as a list of unusual ones can show.
KEPT = 3
_SQUARES = "decimal(38,6)"


def daily_facts(rows: DataFrame, keys: tuple[str, ...] = KEYS, kept: int = KEPT) -> DataFrame:
    """``total``, ``beyond``, ``squares``, ``n`` and ``largest`` per day, area, category and department.

    ``total`` is exact, ``beyond`` adds amounts that no decimal holds; ``largest`` has the
    ``kept`` largest expenses.  Rows without a date have a day of their own.
    """
    ids = [*keys, "date", "source_area", "category", "department"]
    amount = F.col("amount")
    sums = rows.groupBy(*ids).agg(
        F.sum(exact(amount)).alias("total"),
        F.sum(F.when(exact(amount).isNull(), amount)).alias("beyond"),
        F.sum((amount * amount).try_cast(_SQUARES)).alias("squares"),
        F.count(F.lit(1)).alias("n"),
        F.count("amount").alias("amounts"),
    )
    rank = F.row_number().over(W.partitionBy(*ids).orderBy(F.desc("amount"), "record_id"))
    item = F.struct((-F.col("amount")).alias("order"), "record_id", "vendor", "amount")
    best = (
        rows.filter("source_area = 'expenditure'").select(*ids, "record_id", "vendor", "amount")
        .withColumn("_n", rank).filter(F.col("_n") <= kept)
        .groupBy(*ids).agg(F.sort_array(F.collect_list(item)).alias("largest"))
    )
    # A label may be missing, which an ordinary join would not match.
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ids]
    on = same[0]
    for condition in same[1:]:
        on = on & condition
    return sums.alias("s").join(best.alias("b"), on, "left").select("s.*", "b.largest")


def refresh_facts(spark: SparkSession, path: str, rows: DataFrame, touched: DataFrame, keys: tuple[str, ...] = KEYS) -> None:
    """Bring the written roll-up up to date: the days of ``touched`` (``date``) are computed again from ``rows``.

    Days are partitions, so a refresh reads and writes only its own; ``rows`` is filtered by
    their days, which its source can prune.  A day that has no rows any more goes.
    """
    days = [row.date for row in touched.select("date").distinct().collect()]  # of one refresh
    dated = [day for day in days if day is not None]
    here = F.col("date").isin(dated) if dated else F.lit(False)
    if None in days:
        here = here | F.col("date").isNull()
    facts = materialize(daily_facts(rows.filter(here), keys).withColumn("day", F.coalesce(F.col("date").cast("string"), F.lit("none"))), "facts")
    facts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    left = {row.day for row in facts.select("day").distinct().collect()}
    for day in days:
        name = "none" if day is None else str(day)
        if name not in left:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/day={name}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("day")


def _money() -> Column:
    return F.coalesce(F.sum("total").cast("double"), F.lit(0.0)) + F.coalesce(F.sum("beyond"), F.lit(0.0))


def _of(area: str, column: str) -> Column:
    return F.when(F.col("source_area") == area, F.col(column))


def flows(facts: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Revenue and expenditure of each day, as ``finance.daily_flows`` gives them."""
    def side(area: str) -> Column:
        return (F.coalesce(F.sum(_of(area, "total")).cast("double"), F.lit(0.0))
                + F.coalesce(F.sum(_of(area, "beyond")), F.lit(0.0))).alias(area)

    return facts.filter("date IS NOT NULL").groupBy(*keys, "date").agg(side("revenue"), side("expenditure"))


def spent(facts: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Spend and number of expenses of each day, as ``spend.daily_spend`` gives them."""
    return facts.filter("source_area = 'expenditure' AND date IS NOT NULL").groupBy(*keys, "date").agg(
        _money().alias("value"), F.sum("n").alias("transactions"))


def top_labels(facts: DataFrame, label: str, k: int = 5, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """As ``spend.top_labels``, for ``category`` or ``department``."""
    totals = facts.filter("source_area = 'expenditure'").groupBy(*keys, F.trim(label).alias("label")).agg(_money().alias("value"))
    every = totals.groupBy(*keys).agg(F.sum(exact(F.col("value"))).cast("double").alias("_all"))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("value"), "label"))
    best = totals.filter("label <> ''").withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.join(every, list(keys)).withColumn("share", F.col("value") / F.col("_all")).drop("_all")


def weekly_activity(facts: DataFrame, days: int = 7, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """As ``spend.weekly_activity``: records on each of the last days that have any."""
    counts = facts.groupBy(*keys, "date").agg(F.sum("n").alias("value"))
    newest = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("date")))
    return counts.withColumn("_n", newest).filter(F.col("_n") <= days).drop("_n").withColumn("label", F.date_format("date", "EEE"))


def unusual_expenses(facts: DataFrame, k: int = KEPT, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """As ``spend.unusual_expenses``: the largest expenses far above a company's mean; ``k`` up to ``KEPT``."""
    own = facts.filter("source_area = 'expenditure'")
    n = F.sum("amounts")
    mean = F.sum("total").cast("double") / n
    squares = F.sum("squares").cast("double") / n
    limits = materialize(own.groupBy(*keys).agg(
        mean.alias("mean"), F.sqrt(F.greatest(squares - mean * mean, F.lit(0.0))).alias("deviation")), "limits")
    items = own.select(*keys, "date", F.explode("largest").alias("item")).select(*keys, "date", "item.record_id", "item.vendor", "item.amount")
    far = (F.col("amount") > F.col("mean") + F.col("deviation") * 1.8) & (F.col("amount") > F.col("mean") * 1.35)
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("amount"), "record_id"))
    return join_lookup(items, limits, list(keys), "inner").filter(far).withColumn("rank", rank).filter(
        F.col("rank") <= k).drop("mean", "deviation")


def sources(facts: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Number of finance rows of each company and their last day."""
    return facts.groupBy(*keys).agg(F.sum("n").alias("finance_rows"), F.max("date").cast("string").alias("latest_finance_date"))
