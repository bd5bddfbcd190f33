"""Unusual transactions and days: an isolation forest grown and scored by Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.records import snapshot
from ..functions.rules import severity_of
from ..functions.values import currency, percent_change
from ..session import by_task, materialize, ship_code
from .finance import daily_totals
from .lookups import join_lookup
from .quantiles import exact_quantile
from .series import rolling_features
from .trees import (
    FOREST_FIELDS, Forest, grow_isolation, join_blocks, leaf_values, path_length, seeded,
)

KEYS = ("company_id",)
_FEATURES = list(K.TRANSACTION_FEATURES)
_BLOCKS = 15
_CHUNK_ROWS = 200_000


def _day_id():
    return F.concat_ws("-", "source_area", F.col("date").cast("string"))


def daily_frame(rows: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row per area and day with rolling features and an id of its own."""
    return rolling_features(daily_totals(rows, keys), keys).withColumn("record_id", _day_id())


def fold_copies(rows: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Each distinct record once, with how many copies of it there are.

    Written once: totals, medians and frames read it instead of parsing the input again.
    Copies are combined before the shuffle, so a record repeated without end stays small.
    """
    folded = rows.groupBy(*keys, "source_area", "date", "record_id", "amount").agg(
        F.count("*").alias("copies")
    )
    return materialize(folded, "folded")


def _baselines(folded: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Median amount of every area, copies counted."""
    areas = [*keys, "source_area"]
    return exact_quantile(folded, areas, "amount", 0.5, "amount_baseline", "copies").drop("n")


def transaction_frame(rows: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Transactions with the totals of their day and the median amount of their area."""
    areas = [*keys, "source_area"]
    # Typed once and written where they are read: totals, medians and the join move no transaction.
    typed = materialize(rows.select(*areas, "date", "record_id", "amount"), "typed")
    medians = exact_quantile(typed, areas, "amount", 0.5, "amount_baseline").drop("n")
    lookup = materialize(rolling_features(daily_totals(typed, keys), keys).join(medians, areas), "daily")
    return join_lookup(typed, lookup, [*areas, "date"])


def model_gate(daily: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Which rows each company models, and with which model.

    From 20 transactions on, transactions are scored; otherwise days, from 14 on.  Each
    area with enough rows has its own model; if none has, all areas share one.
    """
    areas = daily.groupBy(*keys, "source_area").agg(
        F.sum("transaction_count").alias("transactions"), F.count("*").alias("days")
    )
    w = W.partitionBy(*keys)
    transactions, days = F.sum("transactions").over(w), F.sum("days").over(w)
    mode = F.when(transactions >= K.MIN_TRANSACTION_ROWS, "transaction").when(
        days >= K.MIN_DAILY_ROWS, "daily"
    )
    rows = F.when(F.col("mode") == "transaction", F.col("transactions")).otherwise(F.col("days"))
    minimum = F.when(F.col("mode") == "transaction", K.MIN_TRANSACTION_ROWS).otherwise(
        K.MIN_DAILY_ROWS
    )
    own = F.col("area_rows") >= F.col("minimum")
    any_own = F.max(own.cast("int")).over(w) == 1
    return (
        areas.withColumn("mode", mode)
        .withColumn("area_rows", rows)
        .withColumn("minimum", minimum)
        .withColumn(
            "model_key",
            F.when(F.col("mode").isNull(), None)
            .when(own, F.col("source_area"))
            .when(~any_own, "pooled"),
        )
        .withColumn("model_rows", F.sum("area_rows").over(W.partitionBy(*keys, "model_key")))
        .withColumn(
            "status", F.when(F.col("mode").isNull(), "insufficient_data").otherwise("modelled")
        )
        .drop("minimum")
    )


def model_frame(rows: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The rows to score: transactions or days, each distinct row once with its copies.

    Days have no amount; a constant stands in, which no tree can split on.
    """
    areas = [*keys, "source_area"]
    folded = fold_copies(rows, keys)
    daily = rolling_features(daily_totals(folded, keys, "copies"), keys)
    gate = model_gate(daily, keys).filter("model_key IS NOT NULL")
    models = gate.select(*areas, "mode", "model_key", "model_rows").join(
        _baselines(folded, keys), areas, "left"
    )
    lookup = materialize(daily.join(models, areas), "daily")
    transactions = join_lookup(
        folded, lookup.filter("mode = 'transaction'"), [*areas, "date"], "inner"
    )
    days = lookup.filter("mode = 'daily'").select(
        "*",
        _day_id().alias("record_id"),
        F.lit(0.0).alias("amount"),
        F.lit(1).cast("bigint").alias("copies"),
    )
    return transactions.unionByName(days)


def _model(keys: tuple[str, ...]) -> list[str]:
    return [*keys, "model_key"]


def sample_rows(
    frame: DataFrame, keys: tuple[str, ...] = KEYS, trees: int = K.ISOLATION_TREES
) -> DataFrame:
    """For every model and tree up to 256 rows drawn without replacement.

    A hash of row and tree thins the rows to about 512 per tree where they are read; the
    smallest hashes win.  The draw depends on content only, not on partitioning.  A row
    that stands for many copies is drawn in proportion to them.
    """
    content = [*_model(keys), "source_area", "date", "record_id", "amount"]
    scale = float(1 << 53)

    def uniform(*parts):
        return F.shiftrightunsigned(F.xxhash64(*parts, F.lit(K.MODEL_SEED)), 11) / F.lit(scale)

    share = F.least(F.lit(1.0), 2.0 * K.ISOLATION_SAMPLE / F.col("model_rows"))
    whole = F.floor(F.col("copies") * share).cast("int")
    rest = F.col("copies") * share - whole
    # One hash tells the first tree that draws the row beyond its whole copies, if any does;
    # only rows that some tree draws are spread over the trees.
    first = F.when(rest > 0, F.least(
        F.floor(F.ln(1 - uniform("_row", F.lit("first"))) / F.ln(1 - rest)), F.lit(trees))).otherwise(trees).cast("int")
    again = (F.col("tree") > F.col("_first")) & (uniform("_row", "tree") < F.col("_rest"))
    drawn = (
        frame.withColumn("_row", F.xxhash64(*content))
        .withColumns({"_whole": whole, "_rest": rest, "_first": first})
        .filter((F.col("_whole") > 0) | (F.col("_first") < trees))
        .withColumn("tree", F.explode(F.sequence(
            F.when(F.col("_whole") > 0, 0).otherwise(F.col("_first")), F.lit(trees - 1))))
        .withColumn("_times", F.col("_whole") + ((F.col("tree") == F.col("_first")) | again).cast("int"))
        .filter("_times > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
        .withColumn("_order", F.xxhash64("_row", "tree", "_copy"))
    )
    place = F.row_number().over(W.partitionBy(*_model(keys), "tree").orderBy("_order", "_row"))
    return (
        drawn.select(*_model(keys), "model_rows", "tree", "_order", "_row", *_FEATURES)
        .withColumn("_n", place)
        .filter(F.col("_n") <= K.ISOLATION_SAMPLE)
    )


def train_isolation(
    frame: DataFrame, keys: tuple[str, ...] = KEYS, trees: int = K.ISOLATION_TREES
) -> DataFrame:
    """One row per model and block of trees."""
    ids = _model(keys)
    per_block = -(-trees // _BLOCKS)

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        *name, block = key
        forest = Forest()
        for tree, part in pdf.sort_values(["tree", "_n"]).groupby("tree"):
            x = part[_FEATURES].to_numpy(float)
            depth = int(np.ceil(np.log2(max(len(x), 2))))
            grow_isolation(forest, x, seeded(K.MODEL_SEED, *name, tree), depth)
        size = int(pdf.groupby("tree").size().max())
        return pd.DataFrame(
            [{**dict(zip(ids, name)), "block": block, "sample_size": size, **forest.columns()}]
        )

    ship_code(frame.sparkSession)
    types = dict(frame.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in ids)
    drawn = sample_rows(frame, keys, trees).withColumn(
        "block", F.floor(F.col("tree") / per_block).cast("int")
    )
    return (
        by_task(drawn, *ids, "block")
        .groupBy(*ids, "block")
        .applyInPandas(grow, f"{schema}, block int, sample_size int, {FOREST_FIELDS}")
    )


#: Forests of all models together, up to so many bytes, are sent to where the rows are.
SENT_BYTES = 64 << 20
_NODE_BYTES = 28


def _raw_scores(forest: dict[str, np.ndarray], sample_size: int, x: np.ndarray) -> np.ndarray:
    mean = leaf_values(forest, x, int(np.ceil(np.log2(K.ISOLATION_SAMPLE))))
    scale = path_length(sample_size)
    return np.power(2.0, -mean / scale) if scale > 0 else np.full(len(x), 0.5)


def score_in_place(frame: DataFrame, forests: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Raw scores computed where the rows are read; ``forests`` are few enough to be sent to every task."""
    ids = _model(keys)
    models: dict[tuple, list] = {}
    for row in forests.collect():  # under SENT_BYTES
        models.setdefault(tuple(row[c] for c in ids), []).append(row)
    laid_out = {
        name: (join_blocks(sorted(blocks, key=lambda b: b.block)), max(b.sample_size for b in blocks))
        for name, blocks in models.items()
    }
    shared = frame.sparkSession.sparkContext.broadcast(laid_out)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in _FEATURES], axis=1)
            codes = np.zeros(batch.num_rows, np.int64)
            names: list[list] = []
            for column in ids:
                coded = batch.column(column).dictionary_encode(null_encoding="encode")
                names.append(coded.dictionary.to_pylist())
                codes = codes * len(names[-1]) + coded.indices.to_numpy(zero_copy_only=False)
            raw = np.zeros(batch.num_rows)
            for code in np.unique(codes).tolist():
                at, rest, name = codes == code, code, []
                for values in reversed(names):
                    rest, place = divmod(rest, len(values))
                    name.append(values[place])
                forest, size = shared.value[tuple(reversed(name))]
                raw[at] = _raw_scores(forest, size, x[at])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw)], [*batch.schema.names, "raw_score"])

    schema = ", ".join(f"`{c}` {t}" for c, t in frame.dtypes) + ", raw_score double"
    return frame.mapInArrow(score, schema)


def score_moved(frame: DataFrame, forests: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Raw scores where there are too many models to send them all.

    A model's rows are cut into chunks of at most about 200,000 by content hash, and its
    trees (of fixed size) go along with each chunk, so no task holds a whole model's rows.
    """
    ids = _model(keys)
    chunks = F.ceil(F.col("model_rows") / _CHUNK_ROWS).cast("int")
    rows = frame.withColumn(
        "chunk",
        F.pmod(F.xxhash64("record_id", "date", "amount"), chunks).cast("int"),
    )
    sizes = frame.select(*ids, chunks.alias("_chunks")).distinct()
    spread = forests.join(sizes, ids).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))
    ).drop("_chunks")

    def score(_key: tuple, pdf: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pdf.drop(columns="chunk").assign(raw_score=np.zeros(0))
        forest = join_blocks(blocks.sort_values("block").itertuples())
        raw = _raw_scores(forest, int(blocks["sample_size"].max()), pdf[_FEATURES].to_numpy(float))
        return pdf.drop(columns="chunk").assign(raw_score=raw)

    schema = ", ".join(f"`{c}` {t}" for c, t in frame.dtypes) + ", raw_score double"
    group = [*ids, "chunk"]
    return (
        by_task(rows, *group)
        .groupBy(*group)
        .cogroup(by_task(spread, *group).groupBy(*group))
        .applyInPandas(score, schema)
    )


def score_rows(
    frame: DataFrame, forests: DataFrame, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """Raw isolation score of every row of ``frame``.

    Forests are written once and their nodes counted.  As long as all of them are small
    enough, they go to the rows; beyond that rows and forests meet by model.
    """
    ship_code(frame.sparkSession)
    forests = materialize(forests, "forests")
    nodes = forests.agg(F.sum(F.size("feature"))).first()[0] or 0
    score = score_in_place if nodes * _NODE_BYTES <= SENT_BYTES else score_moved
    return score(frame, forests, keys)


def isolation_scores(
    rows: DataFrame,
    keys: tuple[str, ...] = KEYS,
    trees: int = K.ISOLATION_TREES,
    contamination: float = K.CONTAMINATION,
) -> DataFrame:
    """Every modelled row with its score in [0, 1] and whether it is flagged.

    A row is flagged when its raw score lies beyond the (1 - contamination) quantile of
    its model.  Scores are written once and feed the quantile, the scaling and the result.
    """
    ids = _model(keys)
    frame = model_frame(rows, keys)
    scored = materialize(
        score_rows(frame, train_isolation(frame, keys, trees), keys), "model-scores"
    )
    limit = exact_quantile(
        scored, ids, "raw_score", 1.0 - contamination, "threshold", weight="copies"
    ).drop("n")
    ends = scored.groupBy(*ids).agg(F.min("raw_score").alias("_min"), F.max("raw_score").alias("_max"))
    spread = F.col("_max") - F.col("_min")
    return (
        join_lookup(scored, materialize(limit.join(ends, ids), "limits"), ids)
        .withColumn("anomaly_flag", F.col("raw_score") > F.col("threshold"))
        .withColumn(
            "anomaly_score",
            F.when(spread > 0, (F.col("raw_score") - F.col("_min")) / spread).otherwise(0.0),
        )
        .drop("_min", "_max", "threshold")
    )


def _described(mode, area, heavy, weak):
    """(type, title, description) by rule."""
    kinds = {
        ("daily", "heavy"): (
            "daily_expenditure_spike",
            "Unusual expenditure spike detected",
            "IsolationForest flagged the daily expenditure total as unusually high for recent history.",
        ),
        ("daily", "weak"): (
            "daily_revenue_drop",
            "Unusual revenue drop detected",
            "IsolationForest flagged the daily revenue total as unusually low for recent history.",
        ),
        ("daily", "other"): (
            "daily_total_anomaly",
            "Suspicious daily finance total detected",
            "IsolationForest flagged the daily finance aggregate as outside the recent baseline.",
        ),
        ("transaction", "heavy"): (
            "transaction_expenditure_spike",
            "Transaction sits inside an expenditure spike",
            "IsolationForest flagged this transaction because it lands on an unusually heavy spend day.",
        ),
        ("transaction", "weak"): (
            "transaction_revenue_drop",
            "Transaction sits inside a low-revenue day",
            "IsolationForest flagged this transaction because it lands on an unusually weak revenue day.",
        ),
    }
    other = F.struct(
        F.lit("transaction_amount_outlier").alias("type"),
        F.lit("Anomalous transaction amount detected").alias("title"),
        F.concat(
            F.lit("IsolationForest flagged the "), area,
            F.lit(" transaction amount as unusual compared with recent activity."),
        ).alias("description"),
    )

    def fixed(kind):
        return F.struct(*[F.lit(t).alias(n) for t, n in zip(kind, ("type", "title", "description"))])

    daily = mode == "daily"
    return (
        F.when(daily & heavy, fixed(kinds["daily", "heavy"]))
        .when(daily & weak, fixed(kinds["daily", "weak"]))
        .when(daily, fixed(kinds["daily", "other"]))
        .when(heavy, fixed(kinds["transaction", "heavy"]))
        .when(weak, fixed(kinds["transaction", "weak"]))
        .otherwise(other)
    )


def anomaly_rows(
    scored: DataFrame,
    run_at: str,
    keys: tuple[str, ...] = KEYS,
    cap: int = K.MAX_ANOMALIES,
) -> DataFrame:
    """Full anomaly rows of the flagged ones, the ``cap`` highest scores per company.

    The id is a hash of company, run and record, so a repeated run gives the same ids.
    Each copy of a repeated record is an anomaly of its own.
    """
    mode, area = F.col("mode"), F.when(F.col("model_key") == "pooled", F.col("source_area")).otherwise(
        F.col("model_key")
    )
    total, mean = F.col("daily_total"), F.col("rolling_mean_7")
    by_transaction = mode == "transaction"
    copies = F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(cap)).cast("int")))
    best = F.row_number().over(
        W.partitionBy(*keys).orderBy(F.desc("anomaly_score"), "source_area", "record_id", "_copy")
    )
    flagged = (
        scored.filter("anomaly_flag")
        .withColumn("_copy", copies)
        .withColumn("_n", best)
        .filter(F.col("_n") <= cap)
        .drop("_n")
        .withColumn("source_area", area)
        .withColumn("anomaly_score", F.bround("anomaly_score", 4))
        .withColumn("actual", F.bround(F.when(by_transaction, F.col("amount")).otherwise(total), 2))
        .withColumn(
            "expected",
            F.bround(
                F.when(by_transaction, F.coalesce(F.nullif("amount_baseline", F.lit(0.0)), "actual"))
                .otherwise(F.coalesce(F.nullif(mean, F.lit(0.0)), F.col("actual"))),
                2,
            ),
        )
        .withColumn(
            "_kind",
            _described(
                mode, area,
                (area == "expenditure") & (total >= mean),
                (area == "revenue") & (total <= mean),
            ),
        )
    )
    day_reason = F.concat(
        F.lit("Daily total "), currency(total), F.lit(" vs rolling mean "), currency(mean), F.lit("."),
    )
    reasons = F.when(
        by_transaction,
        F.array(
            F.concat(
                F.lit("Transaction amount "), currency(F.col("actual")),
                F.lit(" differs from the typical "), F.col("source_area"),
                F.lit(" amount baseline."),
            ),
            day_reason,
        ),
    ).otherwise(
        F.array(
            F.concat(
                F.lit("Daily total "), currency(F.col("actual")),
                F.lit(" differs from the rolling mean of "), currency(F.col("expected")), F.lit("."),
            ),
            F.concat(
                F.lit("Transaction count for the day is "),
                F.col("transaction_count").cast("string"), F.lit("."),
            ),
        )
    )
    identity = F.sha2(
        F.concat_ws("|", *keys, F.lit(run_at), "mode", "source_area",
                    F.col("date").cast("string"), "record_id",
                    F.col("actual").cast("string"), F.col("_copy").cast("string")),
        256,
    )
    return flagged.select(
        *keys,
        identity.alias("anomaly_id"),
        "record_id",
        F.array("record_id").alias("record_ids"),
        "date",
        "anomaly_flag",
        "anomaly_score",
        "source_area",
        F.lit("IsolationForest").alias("model_name"),
        F.lit("new").alias("status"),
        F.col("_kind.type").alias("anomaly_type"),
        F.when(by_transaction, "transaction").otherwise("daily_finance").alias("entity_type"),
        severity_of(F.col("anomaly_score")).alias("severity"),
        F.col("anomaly_score").alias("confidence"),
        F.col("_kind.title").alias("title"),
        F.col("_kind.description").alias("description"),
        reasons.alias("reasons"),
        F.lit("review").alias("suggested_action"),
        F.struct(
            F.col("actual").alias("actual_value"),
            F.col("expected").alias("expected_value"),
            F.bround(percent_change(F.col("expected"), F.col("actual")), 2).alias("percent_deviation"),
            F.lit(None).cast("double").alias("z_score"),
        ).alias("metrics"),
        F.lit(run_at).cast("timestamp").alias("detected_at"),
        F.when(by_transaction, "transactions").otherwise("finance_daily").alias("source_table"),
        F.struct(
            F.when(by_transaction, F.col("actual")).alias("amount"),
            F.bround(total, 2).alias("daily_total"),
            "transaction_count",
            F.bround(mean, 2).alias("rolling_mean_7"),
            F.bround("rolling_deviation_7", 2).alias("rolling_deviation_7"),
            "day_of_week",
        ).alias("features"),
    )


def anomaly_counts(anomalies: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Number of anomalies by severity and by type, blanks counted as unknown."""

    def named(field: str):
        text = F.when(F.coalesce(F.col(field), F.lit("")) != "", F.col(field)).otherwise("unknown")
        return F.struct(F.lit(field).alias("field"), text.alias("label"))

    pairs = anomalies.select(
        *keys, F.explode(F.array(named("severity"), named("anomaly_type"))).alias("_p")
    )
    return pairs.groupBy(*keys, "_p.field", "_p.label").agg(F.count("*").alias("n"))


def attach_details(
    anomalies: DataFrame, records: DataFrame, keys: tuple[str, ...] = KEYS, limit: int = K.SNAPSHOT_FIELDS
) -> DataFrame:
    """Add a snapshot of each anomaly's record: its first fields by name, private ones
    left out.  Only the few flagged ids meet the records."""
    wanted = materialize(anomalies.select(*keys, "record_id").distinct(), "wanted")
    ids = [*keys, "record_id"]
    found = join_lookup(records, wanted, ids, "left_semi").groupBy(*ids).agg(
        F.first(F.to_json(snapshot(F.col("raw"), limit))).alias("record_snapshot")
    )
    return anomalies.join(found, ids, "left")
