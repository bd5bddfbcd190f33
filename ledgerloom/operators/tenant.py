"""Tenant scope and the read-only select of one tenant's trusted rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.values import safe_projection, strip
from .lookups import join_lookup

DATASETS = {
    "employees": ("employees", "employees"),
    "transactions": ("finance", "transactions"),
    "accounts": ("finance", "accounts"),
}


_TEXT = re.compile(r"'(?:[^'\\]|'')*'")
_NAME = re.compile(r"`[^`]+`|[A-Za-z_][A-Za-z0-9_]*")
_PLAIN = re.compile(r"[\w\s.,()<>=!+*/%`-]*")


def guard(text: str | None, what: str, columns: list[str]) -> str | None:
    """An expression of a user over the given columns.

    Only listed functions, words of expressions, columns, numbers and quoted texts may stand
    in it; anything else is refused, so nothing new in the SQL dialect is let in by default.
    """
    if text is None or not text.strip():
        return None
    bare = _TEXT.sub(" ", text)
    if not _PLAIN.fullmatch(bare) or "--" in bare or "/*" in bare:
        raise ValueError(f"{what}: only plain expressions are allowed")
    known = {c.lower() for c in columns}
    for found in _NAME.finditer(bare):
        name = found.group().strip("`").lower()
        called = bare[found.end() :].lstrip().startswith("(")
        if found.group()[0] == "`":
            allowed = name in known and not called
        elif called:
            allowed = name in K.EXPRESSION_FUNCTIONS or name in K.EXPRESSION_WORDS
        else:
            allowed = name in known or name in K.EXPRESSION_WORDS
        if not allowed:
            raise ValueError(f"{what}: {found.group()!r} is not allowed")
    return text.strip()


def _terms(text: str) -> list[str]:
    """Parts between commas that stand outside brackets and quotes."""
    parts, depth, quoted = [""], 0, False
    for c in text:
        quoted ^= c == "'"
        depth += 0 if quoted else (c == "(") - (c == ")")
        if c == "," and not depth and not quoted:
            parts.append("")
        else:
            parts[-1] += c
    return parts


def tenant_select(
    trusted: DataFrame,
    company: str,
    projection: str | list[str] = "*",
    where: str | None = None,
    order_by: str | None = None,
    limit: int = 20,
    cap: int = 200,
    dataset: str = "trusted",
    as_text: bool = True,
) -> DataFrame:
    """Rows of one company: projection, predicate, order and a bounded limit.

    The company filter is a step of its own below the user's predicate, so no predicate
    can widen it; on a table partitioned by company it prunes.  ``as_text`` returns every
    value as a string.
    """
    rows = trusted.filter(F.col("company_id") == company)
    if dataset != "trusted":
        domain, table = DATASETS[dataset]
        rows = rows.filter((F.col("domain") == domain) & (F.col("table") == table))
    predicate = guard(where, "where", rows.columns)
    if predicate:
        rows = rows.filter(F.expr(f"({predicate})"))
    columns = [projection] if isinstance(projection, str) else list(projection)
    counting = len(columns) == 1 and safe_projection(columns[0]).startswith("count(")
    if counting:
        rows = rows.select(F.count("*").alias("row_count"))
    else:
        order = guard(order_by, "order by", rows.columns)
        if order:
            rows = rows.orderBy(*[_order_term(term) for term in _terms(order)])
        rows = rows.selectExpr(*[safe_projection(c) for c in columns])
    rows = rows.limit(max(1, min(int(limit), cap)))
    return rows.select([F.col(f"`{c}`").cast("string").alias(c) for c in rows.columns]) if as_text else rows


def _order_term(term: str):
    column, *direction = term.strip().rsplit(None, 1)
    if direction and direction[0].lower() in ("asc", "desc"):
        return F.expr(column).desc() if direction[0].lower() == "desc" else F.expr(column).asc()
    return F.expr(term.strip())


def group_counts(rows: DataFrame, by: str, limit: int | None = None) -> DataFrame:
    """Rows per value of a column, the largest groups first; all of them unless a limit is asked for."""
    counts = rows.groupBy(by).agg(F.count("*").alias("row_count")).orderBy(F.desc("row_count"), by)
    return counts if limit is None else counts.limit(limit)


def tenant_scope(
    companies: DataFrame, trusted_root: str = "trusted/", analytics_root: str = "trusted-analytics/"
) -> DataFrame:
    """Active companies with the prefixes their data lives under.

    A company's own prefix counts only if it lies under the root and names a folder there;
    a missing status counts as active.
    """

    def prefix(column: str, root: str):
        bare = F.regexp_replace(strip(F.col(column)), "^/+", "")
        closed = F.when(bare.endswith("/"), bare).otherwise(F.concat(bare, F.lit("/")))
        below = F.btrim(F.substr(closed, F.lit(len(root) + 1)), F.lit("/"))
        own = F.when(closed.startswith(root) & (below != ""), closed)
        return F.coalesce(own, F.concat(F.lit(root), "company_id", F.lit("/")))

    status = F.lower(strip(F.coalesce(F.nullif("status", F.lit("")), F.lit("active"))))
    return (
        companies.filter(status == "active")
        .withColumn("trusted_base", prefix("trusted_prefix", trusted_root))
        .withColumn("analytics_base", prefix("analytics_prefix", analytics_root))
        .select(
            "company_id",
            "trusted_base",
            "analytics_base",
            F.concat("trusted_base", F.lit("employees/")).alias("employees_prefix"),
            F.concat("trusted_base", F.lit("finance/transactions/")).alias("finance_prefix"),
            F.concat("analytics_base", F.lit("predictions/")).alias("predictions_prefix"),
            F.concat("analytics_base", F.lit("anomalies/")).alias("anomalies_prefix"),
        )
    )


def scoped_rows(rows: DataFrame, scope: DataFrame, keys: tuple[str, ...] = ("company_id",)) -> DataFrame:
    """Rows of active companies only."""
    return join_lookup(rows, scope.select(*keys).distinct(), list(keys), "left_semi")


def rows_under(rows: DataFrame, prefix: str, path: str = "source_file") -> DataFrame:
    """Rows of files below a prefix, for a root table shared by all tenants."""
    bare = prefix.strip("/")
    if not bare:
        raise ValueError("company data prefix is not configured")
    return rows.filter(F.contains(F.col(path), F.lit(f"/{bare}/")))
