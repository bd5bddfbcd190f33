"""Change records: unwrap, route, clean and de-duplicate raw lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.dates import iso_seconds
from ..session import computed_once


def select_captured(
    changes: DataFrame,
    schema: str = "schema_name",
    table: str = "table_name",
    finance_tables: tuple[str, ...] = K.FINANCE_TABLES,
) -> DataFrame:
    """Changes the capture tasks let through: all of ``public`` but four internal
    tables, and the listed finance tables."""
    public = (F.col(schema) == "public") & ~F.col(table).isin(*K.INTERNAL_PUBLIC_TABLES)
    finance = (F.col(schema) == K.FINANCE_SCHEMA) & F.col(table).isin(*finance_tables)
    return changes.filter(public | (finance & ~F.startswith(table, F.lit(K.INTERNAL_TABLE_PREFIX))))


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add ``route``, ``reject`` and the cleaned ``raw`` map to every line.

    A line is a change envelope (``metadata`` and ``data``) or a plain record, which
    counts as an employee row.  ``reject`` names the reason where ``route`` is NULL.
    """
    blank = F.trim(line) == ""
    parsed = lines.withColumn("_v", F.try_parse_json(line))
    v = F.col("_v")
    has_meta = F.try_variant_get(v, "$.metadata", "variant").isNotNull()
    has_data = F.try_variant_get(v, "$.data", "variant").isNotNull()

    def name(key: str):
        text = F.try_variant_get(v, f"$.metadata['{key}']", "string")
        return F.lower(F.coalesce(text, F.lit("")))

    envelope = has_meta & has_data
    table, schema = F.col("_table"), F.col("_schema")
    routed = (
        parsed.withColumn("_envelope", envelope)
        .withColumn("_control", has_meta & ~has_data)
        .withColumn("_table", F.when(envelope, name("table-name")))
        .withColumn("_schema", F.when(envelope, name("schema-name")))
        .withColumn(
            "_fields",
            F.when(
                F.col("_envelope"), F.try_variant_get(v, "$.data", "map<string,variant>")
            ).otherwise(F.try_variant_get(v, "$", "map<string,variant>")),
        )
        .withColumn(
            "raw",
            F.map_filter(
                "_fields",
                lambda _, item: ~F.is_variant_null(item)
                & (F.coalesce(F.try_variant_get(item, "$", "string"), F.lit("_")) != ""),
            ),
        )
        .withColumn(
            "_target",
            F.when(F.col("_control") | table.startswith(K.INTERNAL_TABLE_PREFIX), None)
            .when(
                (schema == K.FINANCE_SCHEMA) & table.isin(*K.FINANCE_TABLES),
                F.concat(F.lit("finance/"), table),
            )
            .when(schema.isin(*K.PUBLIC_SCHEMAS) & (table == "employees"), "employees/employees")
            .when(~F.col("_envelope"), "employees/employees"),
        )
        .withColumn(
            "reject",
            F.when(blank, "blank_line")
            .when(v.isNull(), "malformed_json")
            .when(F.col("_control"), "control_record")
            .when(F.col("_target").isNull(), "unrouted_table")
            .when(F.col("_fields").isNull(), "not_an_object")
            .when(F.size("raw") == 0, "empty_record"),
        )
        .withColumn("route", F.when(F.col("reject").isNull(), F.col("_target")))
    )
    return computed_once(
        routed.select(*lines.columns, "raw", "reject", "route"), ["raw", "reject", "route"]
    )


def standardize_times(df: DataFrame, raw: str = "raw") -> DataFrame:
    """ISO text for the common time fields of a record.

    Text with a ``T`` gets a ``Z`` unless it ends in one or has a ``+``; numbers (and
    booleans) are epoch seconds; other text stays.
    """

    def fixed(key, item):
        text = F.try_variant_get(item, "$", "string")
        kind = F.schema_of_variant(item)
        naive = (
            (kind == "STRING") & text.contains("T")
            & ~text.rlike("[Zz]$") & ~text.contains("+")
        )
        seconds = F.when(
            kind == "BOOLEAN", F.try_variant_get(item, "$", "boolean").cast("int").cast("double")
        ).when(kind != "STRING", F.try_variant_get(item, "$", "double"))
        iso = F.when(naive, F.concat(text, F.lit("Z"))).otherwise(iso_seconds(seconds))
        is_time = key.isin(*K.STANDARD_TIME_FIELDS)
        return F.coalesce(F.when(is_time, iso.cast("variant")), item)

    return df.withColumn(raw, F.transform_values(raw, fixed))


def content_hash(raw: str = "raw"):
    """Hash of a record's typed content, the same for any field order.

    The type is part of the text, so ``1``, ``1.0`` and ``"1"`` stay apart.
    """
    typed = F.transform_values(
        raw, lambda _, item: F.concat_ws("|", F.schema_of_variant(item), F.to_json(item))
    )
    return F.md5(F.to_json(F.array_sort(F.map_entries(typed))))


def drop_copies(df: DataFrame, scope: list[str], digest: str = "row_hash") -> DataFrame:
    """One row per content hash inside ``scope``.

    Equal hashes mean equal content, so any copy will do, and ``dropDuplicates``
    combines copies before the shuffle: a record repeated without end costs one row
    per map task.
    """
    return df.dropDuplicates([*scope, digest])


def line_records(lines: DataFrame, line: str = "line") -> DataFrame:
    """Every line with its ``route`` or ``reject``, and the ``record`` and ``row_hash`` of a routed one.

    The record leaves as JSON text; a VARIANT cannot be compared, so it must not meet
    a shuffle key.
    """
    parsed = parse_lines(lines, line)
    routed = parsed.withColumn("raw", F.when(F.col("route").isNotNull(), F.col("raw")))
    return standardize_times(routed).select(
        *lines.columns, "reject", "route", content_hash().alias("row_hash"), F.to_json("raw").alias("record")
    )


def trusted_records(
    records: DataFrame, keys: tuple[str, ...] = ("company_id",), file: str = "source_file"
) -> DataFrame:
    """One row per distinct record of a file and route, from ``line_records``."""
    rows = records.filter("route IS NOT NULL").select(
        *keys,
        F.col(file),
        F.split_part("route", F.lit("/"), F.lit(1)).alias("domain"),
        F.split_part("route", F.lit("/"), F.lit(2)).alias("table"),
        "row_hash",
        "record",
    )
    return drop_copies(rows, [*keys, file, "domain", "table"])


def clean_lines(
    lines: DataFrame,
    keys: tuple[str, ...] = ("company_id",),
    line: str = "line",
    file: str = "source_file",
) -> DataFrame:
    """Trusted records from raw lines: one row per distinct record of a file and route."""
    texts = lines.select(*keys, F.col(file), F.col(line).alias("line"))
    return trusted_records(line_records(texts), keys, file)


def rejected_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines that were not kept, with the reason."""
    return parse_lines(lines, line).filter("reject IS NOT NULL").drop("raw", "route")
