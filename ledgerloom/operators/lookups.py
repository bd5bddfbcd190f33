"""Joins of many rows to small tables of a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Up to this many rows a lookup is broadcast: tens of megabytes at most.
BROADCAST_ROWS = 200_000
SALTS = 16


def join_lookup(
    rows: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left"
) -> DataFrame:
    """Join many rows to a lookup, which is counted first and so should be a written table.

    A small lookup is broadcast and the rows stay where they are.  Beyond that the rows
    of a key go to ``SALTS`` partitions by a hash of their content and the lookup is
    repeated once per salt, so a key with a third of all rows does not meet one task.
    """
    if lookup.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(lookup), keys, how)
    content = [c for c, t in rows.dtypes if "map<" not in t and "variant" not in t]
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*content), F.lit(SALTS)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
