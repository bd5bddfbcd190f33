"""Licence scan by canonical digests, with native expressions only.

Texts are normalised alike on both sides: lower case, copyright lines dropped, equivalent
spellings made one, punctuation and white space made single spaces.  The SHA-256 of the
whole normal form is joined with the digests of the known texts, so a hit means that the
entire text is a known licence.  A document is looked up as a whole and line by line,
where each line is an entire text of its own (a notice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import SPELLINGS, TEXTS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_LINE = r"\n[ \t\r]*(?:copyright|\(c\)|©)[^\n]*"
#: ASCII and typographic punctuation and white space other than line ends.
PUNCTUATION = r"[!-/:-@\[-`{-~“”‘’«»–—…•\t\x0b\x0c\r]+"


def folded(text: Column) -> Column:
    """The text in normal form but for its line ends and runs of spaces."""
    out = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    out = F.regexp_replace(F.concat(F.lit("\n"), out), COPYRIGHT_LINE, "\n")
    for given, usual in SPELLINGS:
        out = F.replace(out, F.lit(given), F.lit(usual))
    return F.regexp_replace(out, PUNCTUATION, " ")


def normal(part: Column) -> Column:
    return F.btrim(F.regexp_replace(F.replace(part, F.lit("\n"), F.lit(" ")), " +", " "))


def known_digests(spark: SparkSession, texts: tuple[tuple[str, str], ...] = TEXTS) -> DataFrame:
    """``license`` and ``digest`` of the known texts."""
    if not texts:
        return spark.range(0).select(F.lit("").alias("license"), F.lit("").alias("digest"))
    rows = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in texts])
    given = spark.range(1).select(F.inline(rows))
    return given.select("license", F.sha2(normal(folded(F.col("text"))), 256).alias("digest")).distinct()


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", texts: tuple[tuple[str, str], ...] = TEXTS) -> DataFrame:
    """``key``, ``license``, ``notices`` and ``n_notices`` of every row.

    ``license`` names the known text that the whole document is (the last by name if several
    names share a text), null if none; ``notices`` the licences of lines that are known
    texts, sorted and comma-joined, empty if none.  Null and empty texts have none.  Rows
    that share a key share what any of them holds.  Other columns are ignored.
    """
    body = docs.select(F.col(key).alias("_key"), folded(F.col(text)).alias("body"))
    whole = F.struct(F.lit(True).alias("whole"), normal(F.col("body")).alias("part"))
    lines = F.transform(
        F.array_distinct(F.split("body", "\n")), lambda line: F.struct(F.lit(False).alias("whole"), normal(line).alias("part")))
    units = body.select("_key", F.inline(F.concat(F.array(whole), lines))).filter("part <> ''")
    digests = units.select("_key", "whole", F.sha2("part", 256).alias("digest"))
    hits = digests.join(F.broadcast(known_digests(docs.sparkSession, texts)), "digest")  # a fixed list of texts
    found = hits.groupBy("_key").agg(
        F.max(F.when(F.col("whole"), F.col("license"))).alias("license"),
        F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("license")))).alias("names"))  # at most the known names
    joined = docs.select(F.col(key)).join(found, F.col(key).eqNullSafe(F.col("_key")), "left")
    names = F.coalesce("names", F.array().cast("array<string>"))
    return joined.select(
        key, "license", F.array_join(names, ",").alias("notices"), F.size(names).cast("bigint").alias("n_notices"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle(texts: tuple[tuple[str, str], ...] = TEXTS) -> str:
    """The scan of ``documents`` in SQL."""
    def fold(column: str) -> str:
        out = f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"
        out = f"regexp_replace(chr(10) || {out}, {_quoted(COPYRIGHT_LINE)}, chr(10), 'g')"
        for given, usual in SPELLINGS:
            out = f"replace({out}, {_quoted(given)}, {_quoted(usual)})"
        return f"regexp_replace({out}, {_quoted(PUNCTUATION)}, ' ', 'g')"

    def norm(column: str) -> str:
        return f"trim(regexp_replace(replace({column}, chr(10), ' '), ' +', ' ', 'g'), ' ')"

    given = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in texts)
    return f"""
WITH given(license, text) AS (VALUES {given}),
known AS (SELECT DISTINCT license, sha256({norm(fold("text"))}) AS digest FROM given),
bodies AS (SELECT doc_id, {fold("text")} AS body FROM documents),
units AS (
    SELECT doc_id, TRUE AS whole, {norm("body")} AS part FROM bodies
    UNION ALL
    SELECT doc_id, FALSE, {norm("line")} FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM bodies)
),
hits AS (SELECT DISTINCT doc_id, whole, license FROM units JOIN known ON sha256(part) = digest WHERE part <> '')
SELECT d.doc_id, max(h.license) FILTER (WHERE h.whole) AS license,
    coalesce(string_agg(h.license, ',' ORDER BY h.license) FILTER (WHERE NOT h.whole), '') AS notices,
    count(h.license) FILTER (WHERE NOT h.whole) AS n_notices
FROM documents d LEFT JOIN hits h ON h.doc_id = d.doc_id GROUP BY d.doc_id"""
