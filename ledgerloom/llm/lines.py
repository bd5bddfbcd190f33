"""Removal of near-duplicate lines: an exact set-similarity join with native expressions only.

A line is the set of its words.  Two lines match at a Jaccard similarity of 4/5 or more; a
line that matches an earlier one (smaller document, then smaller line number) is removed,
whether or not the earlier one is removed itself.

* Copies of a line are folded first: only its first occurrence takes part in the join.
* Words are ordered by rarity.  Rarity is the count of a word's hash bucket over all lines;
  buckets are of a fixed number, so their classes travel as one constant of that many
  bytes.  Any order that all lines share gives the same result; rare words first keep
  candidates few.
* Matching sets share a word within their prefixes, whose lengths follow from the threshold;
  lengths, the places of the shared word and 64 parity bits bound the overlap, and what
  passes is verified on the words themselves.
* In a first round a line only meets the earliest line of each of its prefix words, which
  settles most near copies of one line without comparing them with each other.  Only lines
  that found no match then meet all others.
* There the shorter line of a pair brings the fewer prefix words, and words only meet within
  classes of sizes, as lines of very unequal sizes cannot match.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import computed_once, discard, materialize

#: Lines with fewer distinct words are left alone.
MIN_WORDS = 5
#: Similarity threshold as a fraction.
OVER, UNDER = 4, 5
#: Buckets that words are counted in, a power of two.
BUCKETS = 1 << 20
#: The prefix join is done in so many shares of the words, one after the other, to use less disk.
SHARES = 4
#: Lines of more words than ``LONG`` have ``WIDE`` times 64 parity bits.
LONG, WIDE = 90, 4
#: Lines are compared by classes of sizes, each so many times the one below; more than UNDER / OVER.
CLASS = 1.6
_HASH_BITS = 56
_PARTS = [f"wide_{k}" for k in range(WIDE)]


def _plain(text: Column) -> Column:
    """Lower case, with single-character spaces; plain replacements are far cheaper than a pattern."""
    out = F.lower(text)
    for space in "\t\x0b\x0c\r":
        out = F.replace(out, F.lit(space), F.lit(" "))
    return out


def line_words(line: Column) -> Column:
    """Distinct words of a line, in lower case."""
    return F.array_remove(F.array_distinct(F.split(_plain(line), " ")), "")


def word_hashes(line: Column) -> Column:
    """Distinct hashes of a line's words; numbers are told apart faster than words."""
    hashes = F.transform(F.split(_plain(line), " "), lambda w: F.xxhash64(w))
    return F.array_remove(F.array_distinct(hashes), F.xxhash64(F.lit("")))


def text_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc``, ``line_no``, ``line`` of every line of every document."""
    parts = F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n")
    return docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("doc"), F.posexplode(parts).alias("line_no", "line"))


def _bucket(word_hash: Column) -> Column:
    return word_hash.bitwiseAND(F.lit(BUCKETS - 1))


def rarity_classes(sets: DataFrame) -> bytes:
    """One character per bucket of ``hashes``, greater for more frequent words; its size is ``BUCKETS`` bytes."""
    spark = sets.sparkSession
    seen = sets.select(F.explode("hashes").alias("word")).select(_bucket(F.col("word")).alias("bucket"))
    counts = seen.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    every = spark.range(BUCKETS).select(F.col("id").alias("bucket"), F.lit(0).cast("bigint").alias("n"))
    total = counts.union(every).groupBy("bucket").agg(F.sum("n").alias("n"))
    level = F.least(F.lit(90), F.floor(3 * F.log2(F.col("n") + 1))).cast("int")
    rows = total.groupBy(F.shiftright("bucket", 10).alias("row")).agg(
        F.array_sort(F.collect_list(F.struct("bucket", level.alias("level")))).alias("cells"))  # 1024 cells a row
    texts = rows.select("row", F.array_join(F.transform("cells", lambda c: F.chr(c["level"] + 32)), "").alias("text"))
    return "".join(r["text"] for r in sorted(texts.collect())).encode("ascii")


def ordered_codes(hashes: Column, classes: bytes) -> Column:
    """Word hashes under their rarity class, rarest first."""
    def code(hashed: Column) -> Column:
        level = F.ascii(F.substring(F.lit(classes), _bucket(hashed).cast("int") + 1, F.lit(1)).cast("string"))
        return F.shiftleft(level.cast("bigint"), _HASH_BITS).bitwiseOR(hashed.bitwiseAND(F.lit((1 << _HASH_BITS) - 1)))

    return F.sort_array(F.transform(hashes, code))


def _parities(hashes: Column) -> Column:
    """64 bits, each telling whether an odd number of words fall on it.

    Lines differ in at least as many words as these bits differ.
    """
    return F.aggregate(
        hashes, F.lit(0).cast("bigint"),
        lambda bits, h: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(F.lit(63)).cast("int"))))


def _parted(sets: DataFrame) -> DataFrame:
    """``sets`` with ``parts``: the ``hashes`` of a long line in ``WIDE`` parts by their value, others in one.

    64 bits are soon full; the words of each part are told apart by 64 bits of their own.
    Bounds are sorted in with the hashes, so that parts are slices and no word is tested.
    """
    bounds = [F.lit((k << 64) // WIDE - (1 << 63)).cast("bigint") for k in range(1, WIDE)]
    long_ = F.size("hashes") > LONG
    held = F.when(long_, F.sort_array(F.concat("hashes", F.array(*bounds))))
    sets = computed_once(sets.withColumn("_held", held), ["hashes", "_held"])
    ends = [F.lit(0), *[F.array_position("_held", b).cast("int") for b in bounds], F.size("_held") + 1]
    parts = [F.slice("_held", first + 1, last - first - 1) for first, last in zip(ends, ends[1:])]
    sets = sets.withColumn("parts", F.when(long_, F.array(*parts)).otherwise(F.array("hashes")))
    return computed_once(sets.drop("_held"), ["hashes", "parts"])


def _differing(x: str, y: str) -> Column:
    """Words that certainly differ, from the parities of two lines."""
    def apart(name: str) -> Column:
        return F.bit_count(F.col(f"{x}.{name}").bitwiseXOR(F.col(f"{y}.{name}")))

    return F.coalesce(reduce(Column.__add__, map(apart, _PARTS)), apart("bits"))


def _least(numerator: int, denominator: int, n: Column) -> Column:
    """The smallest integer at or above n * numerator / denominator."""
    return F.floor((n * numerator + (denominator - 1)) / denominator).cast("int")


def _index_size(n: Column) -> Column:
    """Prefix words that the shorter one of two matching lines needs."""
    return n - _least(2 * OVER, OVER + UNDER, n) + 1


def size_class(n: Column) -> Column:
    """Lines match within one class or with the class below."""
    return F.floor(F.log(n) / math.log(CLASS)).cast("bigint")


def _prefixes(firsts: DataFrame, role: str) -> DataFrame:
    """A row per prefix word: ``token``, ``place``, the line and its size; ``key`` of word and size class, or of the word alone.

    As the ``shorter`` one a line needs fewer words, in its own class; as the ``longer`` one it
    also meets the class of the shortest line that can match it.
    """
    n, place = F.col("n"), F.col("at") + 1
    line = ["id", "n", "bits", *_PARTS]
    parts = [F.get("wide", F.lit(k)).alias(name) for k, name in enumerate(_PARTS)]
    rows = firsts.select("id", "n", "bits", *parts, size_class(n).alias("class"), F.posexplode("codes").alias("at", "token"))
    if role == "any":
        return rows.select(*line, "token", place.alias("place"), F.col("token").alias("key"))
    if role == "shorter":
        rows = rows.filter(place <= _index_size(n))
    else:
        classes = F.array_distinct(F.array("class", size_class(_least(OVER, UNDER, n))))
        rows = rows.select(*line, "at", "token", F.explode(classes).alias("class"))
    return rows.select(
        *line, "token", place.alias("place"),
        F.col("token").bitwiseXOR(F.shiftleft("class", _HASH_BITS - 8)).alias("key"))  # equal keys of unequal words only cost time


def _sizes_allow(nx: Column, ny: Column, differing: Column) -> Column:
    """Length bounds, and room for the words that certainly differ."""
    return (
        (nx * OVER <= ny * UNDER) & (ny * OVER <= nx * UNDER)
        & (differing * (OVER + UNDER) <= (nx + ny) * (UNDER - OVER))
    )


def _possible(x: str, y: str) -> Column:
    """Length and positional bounds of a shared prefix word; sizes decide which prefix counts."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    place_x, place_y = F.col(f"{x}.place"), F.col(f"{y}.place")
    need = _least(OVER, OVER + UNDER, nx + ny)
    return (
        _sizes_allow(nx, ny, F.bit_count(F.col(f"{x}.bits").bitwiseXOR(F.col(f"{y}.bits"))))
        & _sizes_allow(nx, ny, _differing(x, y))
        & ((nx < ny) | (place_y <= _index_size(ny))) & ((ny < nx) | (place_x <= _index_size(nx)))
        & (1 + F.least(nx - place_x, ny - place_y) >= need)
    )


def _sharing(x: DataFrame, y: DataFrame, share: int) -> DataFrame:
    """Pairs of ids, the smaller one first, of lines that can match by a prefix word of this share."""
    own = F.pmod("token", F.lit(SHARES)) == share
    allowed = _possible("x", "y")
    if x is y:
        roles, hint = ("shorter", "longer"), "shuffle_hash"
        allowed = (F.col("x.n") <= F.col("y.n")) & allowed & (F.col("x.id") != F.col("y.id"))
    else:
        roles, hint = ("any", "any"), None
    sides = [_prefixes(lines, role).filter(own).drop("token") for lines, role in zip((x, y), roles)]
    left = sides[0].hint(hint) if hint else sides[0]
    ids = F.col("x.id"), F.col("y.id")
    return left.alias("x").join(sides[1].alias("y"), F.expr("x.key = y.key") & allowed).select(
        F.least(*ids).alias("a"), F.greatest(*ids).alias("b"))


def _verified(pairs: DataFrame, docs: DataFrame, key: str, text: str, firsts: DataFrame) -> DataFrame:
    """``id`` of the later line of each pair (``a``, ``b``) whose lines match, by the words of both lines."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    # Written, so that its size is known: few places go to the texts instead of the texts to them.
    places = materialize(firsts.select("id", "doc", "line_no").join(wanted, "id"), "places")
    of_doc = places.groupBy(F.col("doc").alias("_doc")).agg(F.collect_list(F.struct("id", "doc", "line_no")).alias("_places"))
    parts = computed_once(docs.select(F.col(key).alias("_doc"), F.col(text).cast("string").alias("_text")).join(of_doc, "_doc").select(
        "_places", F.split(F.coalesce("_text", F.lit("")), "\n").alias("_parts")), ["_parts"])
    texts = materialize(parts.select(F.inline(F.transform("_places", lambda p: F.struct(
        p["id"].alias("id"), F.struct(p["doc"], p["line_no"]).alias("at"), F.get("_parts", p["line_no"]).alias("line"))))), "line-texts")
    sides = [texts.select(F.col("id").alias(s), F.col("at").alias(f"at_{s}"), F.col("line").alias(f"line_{s}")) for s in "ab"]
    both = computed_once(pairs.join(sides[0], "a").join(sides[1], "b").select(
        F.when(F.col("at_a") > F.col("at_b"), F.col("a")).otherwise(F.col("b")).alias("id"),
        line_words(F.col("line_a")).alias("a"), line_words(F.col("line_b")).alias("b")), ["a", "b"])
    # common / (|a| + |b| - common) >= OVER / UNDER, with the costly side once
    matches = F.size(F.array_intersect("a", "b")) * (OVER + UNDER) >= (F.size("a") + F.size("b")) * OVER
    return both.filter(matches).select("id").distinct()


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc`` and ``line_no`` of every line that matches an earlier one."""
    lines = text_lines(docs, key, text)
    hashed = computed_once(lines.select("doc", "line_no", word_hashes(F.col("line")).alias("hashes")), ["hashes"])
    sets = materialize(hashed.filter(F.size("hashes") >= MIN_WORDS), "line-words")  # texts are cut into words once
    classes = rarity_classes(sets)
    parities = F.transform("parts", _parities)
    coded = computed_once(_parted(sets).select(
        "doc", "line_no", F.array(F.array_min("hashes"), F.array_max("hashes")).alias("extremes"),
        parities.alias("parities"), ordered_codes(F.col("hashes"), classes).alias("codes")), ["parities", "codes"])
    n = F.size("codes")
    bits = F.aggregate("parities", F.lit(0).cast("bigint"), lambda total, part: total.bitwiseXOR(part))
    wide = F.when(F.size("parities") > 1, F.col("parities"))
    placed = materialize(coded.select(
        "doc", "line_no", n.alias("n"), F.xxhash64("codes").alias("id"),  # lines with one set of words share an id
        F.slice("codes", 1, n - _least(OVER, UNDER, n) + 1).alias("codes"),
        bits.alias("bits"), wide.alias("wide"), "extremes"), "lines")
    discard(sets)
    firsts = materialize(placed.groupBy("id").agg(
        F.min(F.struct("doc", "line_no")).alias("at"), F.min("n").alias("n"), F.min("codes").alias("codes"),
        F.min("bits").alias("bits"), F.min("wide").alias("wide"), F.min("extremes").alias("extremes"),
    ).select("id", "at.doc", "at.line_no", "n", "codes", "bits", "wide", "extremes"), "first-lines")
    copies = materialize(placed.select("id", "doc", "line_no").join(
        firsts.select("id", F.struct("doc", "line_no").alias("at")), "id",
    ).filter(F.struct("doc", "line_no") > F.col("at")).select("doc", "line_no"), "copies")
    discard(placed)

    settled = materialize(_verified(materialize(_leader_pairs(firsts), "pairs"), docs, key, text, firsts), "settled")
    open_ = materialize(firsts.join(settled, "id", "left_anti"), "open-lines")
    done = materialize(firsts.join(settled, "id", "left_semi"), "settled-lines")
    found = []
    for share in range(SHARES):
        # Lines settled already only serve as the earlier ones of others, never of each other.
        pairs = _sharing(open_, open_, share).union(_sharing(open_, done, share))
        found.append(materialize(pairs.distinct(), "pairs"))
    discard(open_)
    pairs = materialize(reduce(DataFrame.union, found).distinct(), "pairs")
    matched = settled.union(materialize(_verified(pairs, docs, key, text, firsts), "settled"))
    near = firsts.join(matched, "id", "left_semi").select("doc", "line_no")
    return copies.union(near)


def _leader_pairs(firsts: DataFrame) -> DataFrame:
    """Each line with the earliest line that has the same smallest, or the same greatest, word hash.

    Two lines share one with a probability of their similarity; two pairs a line at most.
    """
    rows = firsts.select("id", "doc", "line_no", "n", "bits", F.posexplode("extremes").alias("which", "key"))
    leaders = rows.groupBy("which", "key").agg(F.min(F.struct("doc", "line_no", "id", "n", "bits")).alias("first"))
    differing = F.bit_count(F.col("bits").bitwiseXOR(F.col("first.bits")))
    return rows.join(leaders, ["which", "key"]).filter(
        (F.col("id") != F.col("first.id")) & _sizes_allow(F.col("n"), F.col("first.n"), differing),
    ).select(F.col("id").alias("a"), F.col("first.id").alias("b")).distinct()


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns of ``docs`` with ``text`` freed of repeated lines, ``n_lines`` and ``n_removed``.

    Lines are what stands between line ends.  A line with fewer than ``MIN_WORDS`` different
    words stays, so empty texts stay as they are; a null text stays null and has no lines.
    Rows without a key are not compared.  Repeated rows count as one document.  Columns of
    ``docs`` with the names of results are replaced.
    """
    gone = repeated_lines(docs, key, text).groupBy("doc").agg(F.collect_set("line_no").alias("_gone"))  # of one text
    joined = docs.drop("n_lines", "n_removed").join(gone.withColumnRenamed("doc", "_doc").hint("shuffle_hash"), F.col(key) == F.col("_doc"), "left")
    # The text is cut once; an expression inside the lambda would be evaluated for every line.
    cut = computed_once(joined.withColumn("_parts", F.split(F.col(text).cast("string"), "\n")), ["_parts"])
    kept = F.array_except(F.sequence(F.lit(0), F.size("_parts") - 1), F.col("_gone"))
    rest = F.array_join(F.transform(kept, lambda k: F.element_at("_parts", k + 1)), "\n")
    return cut.withColumns({
        "n_lines": F.when(F.col(text).isNull(), 0).otherwise(F.size("_parts")).cast("bigint"),
        "n_removed": F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint"),
        text: F.when(F.col("_gone").isNull(), F.col(text)).otherwise(rest),
    }).drop("_doc", "_gone", "_parts")


def remove_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without repeated lines; a document that lost lines and has no word left goes."""
    found = without_repeats(docs, key, text)
    empty = (F.col("n_removed") > 0) & (F.btrim(F.col(text), F.lit(" \t\x0b\x0c\r\n")) == "")
    found = found.filter(~empty)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.coalesce(F.length(text), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return found.select(docs.columns)


def oracle() -> str:
    """Lines left of ``documents``, in SQL: the same join by rarity prefixes, with exact word counts."""
    spaces = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS line_no
    FROM documents
), sets AS (
    SELECT doc_id, line_no, list_distinct(string_split_regex(
        trim(lower(line), {spaces}), '[ \\t\\x0b\\x0c\\r]+')) AS words
    FROM lines
), tokens AS (
    SELECT doc_id, line_no, len(words) AS n, unnest(words) AS word FROM sets WHERE len(words) >= {MIN_WORDS}
), counted AS (
    SELECT *, count(*) OVER (PARTITION BY word) AS seen FROM tokens
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, line_no ORDER BY seen, word) AS place FROM counted
), prefix AS (
    SELECT * FROM ranked WHERE place <= n - ({OVER} * n + {UNDER - 1}) // {UNDER} + 1
), pairs AS (
    SELECT DISTINCT a.doc_id AS da, a.line_no AS la, a.n AS na, b.doc_id AS db, b.line_no AS lb, b.n AS nb
    FROM prefix a JOIN prefix b ON a.word = b.word
    WHERE (a.doc_id < b.doc_id OR (a.doc_id = b.doc_id AND a.line_no < b.line_no))
        AND a.n * {OVER} <= b.n * {UNDER} AND b.n * {OVER} <= a.n * {UNDER}
), gone AS (
    SELECT DISTINCT db AS doc_id, lb AS line_no FROM (
        SELECT da, la, db, lb, any_value(na) + any_value(nb) AS total, count(*) AS common
        FROM pairs
        JOIN tokens x ON x.doc_id = da AND x.line_no = la
        JOIN tokens y ON y.doc_id = db AND y.line_no = lb AND y.word = x.word
        GROUP BY da, la, db, lb)
    WHERE common * {OVER + UNDER} >= total * {OVER}
)
SELECT d.doc_id, count(l.line_no) AS n_lines, count(g.line_no) AS n_removed,
    CASE WHEN any_value(d.text) IS NULL THEN NULL ELSE sha256(coalesce(
        string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (WHERE g.line_no IS NULL), '')) END AS kept_sha256
FROM documents d
LEFT JOIN lines l ON l.doc_id = d.doc_id
LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.line_no = l.line_no
GROUP BY d.doc_id"""
