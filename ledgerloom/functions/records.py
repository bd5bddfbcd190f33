"""Access to fields of schemaless records.

A record's fields are either top-level columns, or entries of one
``MAP<STRING,VARIANT>`` column.  ``Fields`` hides the difference, so one set of
priority lists serves typed tables and raw change records alike.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dates import instant_of_number, parse_instant
from .rules import truth_of
from .values import non_blank, parse_number

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


class Fields:
    def __init__(self, df: DataFrame, raw: str | None = None):
        self.raw = raw
        self.types = dict(df.dtypes)

    def usable(self, names: Iterable[str]) -> list[str]:
        """The names that can hold a value: all of them in a map, else existing columns."""
        return [n for n in names if self.raw or n in self.types]

    def parses(self, names: Iterable[str]) -> bool:
        """Whether any of the fields is read from text or a variant rather than typed."""
        return any(self.raw or self.types[n] == "string" for n in self.usable(names))

    def _item(self, name: str) -> Column:
        return F.try_element_at(F.col(self.raw), F.lit(name))

    def present(self, name: str) -> Column:
        if self.raw:
            return F.coalesce(F.map_contains_key(F.col(self.raw), F.lit(name)), F.lit(False))
        return F.col(name).isNotNull()

    def text(self, name: str) -> Column:
        if self.raw:
            return F.try_variant_get(self._item(name), "$", "string")
        return F.col(name).cast("string")

    def number(self, name: str) -> Column:
        if self.raw:
            item = self._item(name)
            return (
                F.when(F.schema_of_variant(item) == "STRING", parse_number(self.text(name)))
                .when(
                    F.schema_of_variant(item) == "BOOLEAN",
                    F.try_variant_get(item, "$", "boolean").cast("int").cast("double"),
                )
                .otherwise(F.try_variant_get(item, "$", "double"))
            )
        kind = self.types[name]
        if kind.startswith(_NUMERIC):
            return F.col(name).cast("double")
        if kind == "boolean":
            return F.col(name).cast("int").cast("double")
        return parse_number(self.text(name))

    def instant(self, name: str) -> Column:
        if self.raw:
            item = self._item(name)
            return F.when(
                F.schema_of_variant(item) == "STRING", parse_instant(self.text(name))
            ).otherwise(instant_of_number(F.try_variant_get(item, "$", "double")))
        kind = self.types[name]
        if kind.startswith(("timestamp", "date")):
            return F.col(name).cast("timestamp")
        if kind.startswith(_NUMERIC):
            return instant_of_number(F.col(name).cast("double"))
        return parse_instant(self.text(name))

    def truth(self, name: str) -> Column:
        """Boolean field: a boolean, a number other than 0, or a word."""
        if self.raw:
            item = self._item(name)
            kind = F.schema_of_variant(item)
            return (
                F.when(kind == "STRING", truth_of(self.text(name)))
                .when(kind == "BOOLEAN", F.try_variant_get(item, "$", "boolean"))
                .otherwise(F.try_variant_get(item, "$", "double") != 0)
            )
        kind = self.types[name]
        if kind == "boolean":
            return F.col(name)
        if kind.startswith(_NUMERIC):
            return F.col(name) != 0
        return truth_of(F.col(name))

    def first_text(self, names: Iterable[str], default: str | None = None) -> Column:
        found = [non_blank(self.text(n)) for n in self.usable(names)]
        return F.coalesce(*found, F.lit(default).cast("string"))

    def first_number(self, names: Iterable[str]) -> Column:
        return F.coalesce(*[self.number(n) for n in self.usable(names)], F.lit(None).cast("double"))

    def first_instant(self, names: Iterable[str]) -> Column:
        """The first field that parses, which need not be the first that is present."""
        return F.coalesce(
            *[self.instant(n) for n in self.usable(names)], F.lit(None).cast("timestamp")
        )


def snapshot(record: Column, limit: int) -> Column:
    """The first ``limit`` fields by name, private ones (leading ``_``) left out."""
    visible = F.map_filter(record, lambda k, _: ~F.startswith(k, F.lit("_")))
    names = F.slice(F.array_sort(F.map_keys(visible)), 1, limit)
    return F.map_filter(visible, lambda k, _: F.array_contains(names, k))
