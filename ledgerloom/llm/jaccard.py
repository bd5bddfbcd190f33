"""Exact Jaccard join of shingle sets, skipping work by what sets have in common.

Sets of word shingles are equal, nearly equal, or have little in common, so most of the
work is skipped in four steps:

1. Equal sets are one class.  Of every class an extended prefix (by hash) is looked at; a
   set that shares too little of it with any other set has no partner and leaves.
2. Shingles of the sets that remain are ordered by rarity.  Shingles that only one set has
   come first and join nothing.  Index lists hold, for each shingle of a prefix, the sets
   with their sizes and the shingle's position; they are cut by size class, so a list joins
   its own and the next class.
3. Each list has a leader.  All members are verified against it, which links most of a list
   at once, and leaves the exact overlap of every member with the leader: its answers.
4. Lists within one component are skipped whole.  In the others blocks of members are
   skipped by size and position, and the answers of a member follow from those of the
   leader: if a and b share p and q shingles with it, they share at most the smaller of p
   and q and the smaller of what they have besides.  What passes is verified, the most
   promising pairs of two components first, until no list has a pair left.

Every pair that links two components in the end has been verified on whole sets, and no
pair that could link is left out, so components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize, ship_code
from .blocks import _STEP, SPACED, Block, find_words, mix, windows_hash
from .components import connected
from .rows import gathered, per_text_columns

WORDS = 5
PERCENT = 80
#: Members of a list in one task; larger lists are cut, and each pair of pieces is a task's.
CHUNK = 2048
BLOCK = 64
#: Pairs of two components that a list offers in a round; the last round offers all.
OFFERS = (4, 256, None)
#: Up to so many rows of about 40 bytes are broadcast.
BROADCAST_ROWS = 200_000
_SECOND = np.uint64(0x2545F4914F6CDD1D)


def needed(n: Column, percent: int) -> Column:
    """Least overlap of a set of ``n`` with any set that it links with."""
    return F.ceil(n * F.lit(percent) / F.lit(100)).cast("bigint")


def shingle_sets(block: Block, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different shingles of all texts, in rising order within a text, and the texts' limits.

    A text of fewer words than ``size`` has one shingle, all its words; one without words none.
    """
    words = find_words(block, SPACED)
    counts = np.diff(words.cuts)
    windows = np.where(counts >= size, counts - size + 1, 0)
    text_of = np.repeat(np.arange(block.n), windows)
    at = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(words.cuts[:-1], windows)
    hashes = windows_hash(words.hashes, size)[at] if len(at) else np.zeros(0, np.uint64)
    for few in range(1, size):
        short = np.flatnonzero(counts == few)
        total = np.full(len(short), few, np.uint64)
        for k in range(few):
            total += words.hashes[words.cuts[short] + k] * _STEP[k]
        hashes, text_of = np.r_[hashes, mix(total)], np.r_[text_of, short]
    order = np.lexsort((hashes, text_of))
    hashes, text_of = hashes[order], text_of[order]
    if len(hashes):
        first = np.r_[True, (hashes[1:] != hashes[:-1]) | (text_of[1:] != text_of[:-1])]
        hashes, text_of = hashes[first], text_of[first]
    return hashes, np.searchsorted(text_of, np.arange(block.n + 1))


def set_names(hashes: np.ndarray, cuts: np.ndarray) -> list[pa.Array]:
    """Two sums of mixed hashes that name a set."""
    out = []
    for values in (mix(hashes), mix(hashes ^ _SECOND)):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values, out=total[1:])
        out.append(pa.array((total[cuts[1:]] - total[cuts[:-1]]).view(np.int64)))
    return out


def _lists(hashes: np.ndarray, cuts: np.ndarray, take: np.ndarray) -> pa.Array:
    """The first ``take`` hashes of every text."""
    ends = np.concatenate([[0], np.cumsum(take)])
    at = np.arange(ends[-1]) - np.repeat(ends[:-1] - cuts[:-1], take)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes[at].view(np.int64)))


def _allowance(n: np.ndarray, percent: int) -> np.ndarray:
    """How many shared shingles an extended prefix asks for, of a set of ``n``."""
    return np.maximum(1, -(-n * percent // 100) // 8)


def marked(docs: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """Of every row ``k``, ``n``, ``h1``, ``h2`` and ``prefix``, its extended prefix in the order of hashes."""

    def look(block: Block) -> list[pa.Array]:
        hashes, cuts = shingle_sets(block, size)
        n = np.diff(cuts)
        take = np.where(n > 0, n + percent * -n // 100 + _allowance(n, percent), 0)
        return [pa.array(n.astype(np.int64)), *set_names(hashes, cuts), _lists(hashes, cuts, take)]

    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    return per_text_columns(rows, "t", "n bigint, h1 bigint, h2 bigint, prefix array<bigint>", look, ["k"])


def with_company(marks: DataFrame, percent: int) -> DataFrame:
    """Classes (``h1``, ``h2``, ``n``, ``first``) that share enough of their extended prefixes with others.

    Two linked sets share ``l`` shingles of their extended prefixes, where ``l`` is the
    allowance of the smaller; each is then held by two classes at least.
    """
    rows = marks.filter("n > 0").select("h1", "h2", F.explode("prefix").alias("token"))
    shared = rows.groupBy("token").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).filter("low <> high").select("token")
    hits = rows.join(shared, "token").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("hits"))
    classes = marks.filter("n > 0").groupBy("h1", "h2").agg(
        F.max("n").alias("n"), F.min("k").alias("first"), F.count(F.lit(1)).alias("copies"))
    least = F.greatest(F.lit(1), F.floor(needed(needed(F.col("n"), percent), percent) / 8))
    return classes.join(hits, ["h1", "h2"]).filter(
        F.col("first").isNotNull() & (F.col("hits") >= least * F.col("copies"))).select("h1", "h2", "n", "first")


def whole_sets(docs: DataFrame, key: str, text: str, size: int, alive: DataFrame) -> DataFrame:
    """``set``, ``n`` and ``tokens`` of the classes in ``alive``, from the texts of their first keys."""

    def look(block: Block) -> list[pa.Array]:
        hashes, cuts = shingle_sets(block, size)
        return [*set_names(hashes, cuts), _lists(hashes, cuts, np.diff(cuts))]

    rows = docs.select(F.col(f"`{key}`").alias("first"), F.col(f"`{text}`").cast("string").alias("t"))
    wanted = alive.select("first", "h1", "h2", "set", "n")
    if alive.count() <= BROADCAST_ROWS:
        rows = rows.join(F.broadcast(alive.select("first").distinct()), "first", "left_semi")
        wanted = F.broadcast(wanted)
    found = per_text_columns(rows, "t", "h1 bigint, h2 bigint, tokens array<bigint>", look, ["first"])
    # A key may come with several texts, and a row several times.
    return found.join(wanted, ["first", "h1", "h2"]).groupBy("set").agg(F.max("n").alias("n"), F.any_value("tokens").alias("tokens"))


def by_rarity(sets: DataFrame, percent: int) -> DataFrame:
    """``set``, ``n`` and ``tokens``, those that other sets hold too, rarest first.

    A set stays if it shares enough for a link, and some of its prefix.
    """
    rows = sets.select("set", "n", F.explode("tokens").alias("token"))
    held = rows.groupBy("token").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    ordered = rows.join(held, "token").groupBy("set").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("held", "token"))).getField("token").alias("tokens"))
    return ordered.filter(F.size("tokens") >= needed(F.col("n"), percent))


def index_lists(sets: DataFrame, percent: int) -> DataFrame:
    """Members of the lists: ``token``, ``class``, ``set``, ``n``, ``known``, ``pos``, ``lower`` and ``leader``.

    ``known`` counts the shingles that others hold, ``pos`` is the shingle's position in the
    whole set.  A list joins the members of its size class (``lower``) with one another and
    with those of the next class; its leader is of its class.
    """
    alone = F.col("n") - F.size("tokens")
    take = F.col("n") - needed(F.col("n"), percent) + 1 - alone
    own = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    held = sets.select(
        "set", "n", F.size("tokens").cast("bigint").alias("known"), own.alias("own"), alone.alias("alone"),
        F.posexplode(F.slice("tokens", 1, take.cast("int"))).alias("place", "token"))
    both = held.select(
        "set", "n", "known", "token", (F.col("alone") + F.col("place")).alias("pos"), "own",
        F.explode(F.array(F.col("own"), F.col("own") - 1)).alias("class"))
    both = both.withColumn("lower", F.col("own") == F.col("class")).drop("own")
    leaders = both.groupBy("token", "class").agg(
        F.min(F.when(F.col("lower"), F.col("set"))).alias("leader"), F.count(F.lit(1)).alias("members"),
    ).filter("leader IS NOT NULL AND members > 1")
    return both.join(leaders, ["token", "class"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a``, ``b``, their exact ``overlap``, and whether they are ``linked``."""
    left = sets.select(F.col("set").alias("a"), F.col("n").alias("an"), F.col("tokens").alias("at"))
    right = sets.select(F.col("set").alias("b"), F.col("n").alias("bn"), F.col("tokens").alias("bt"))
    overlap = F.size(F.array_intersect("at", "bt")).cast("bigint")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "an", "bn", overlap.alias("overlap")).select(
        "a", "b", "overlap", (F.col("overlap") * F.lit(100) >= F.lit(percent) * (F.col("an") + F.col("bn") - F.col("overlap"))).alias("linked"))


def merged(components: DataFrame, links: DataFrame) -> DataFrame:
    """``set`` and ``comp`` after further links (``a``, ``b``) between sets."""
    name = components.select(F.col("set").alias("a"), F.col("comp").alias("u"))
    other = components.select(F.col("set").alias("b"), F.col("comp").alias("v"))
    between = links.select("a", "b").join(name, "a").join(other, "b").select("u", "v")
    groups = connected(between).select(F.col("node").alias("comp"), "root")
    return materialize(components.join(groups, "comp", "left").select("set", F.coalesce("root", "comp").alias("comp")), "components")


def _offers(member: dict[str, np.ndarray], across: bool, percent: int, most: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members of one list that may link two components, the most promising of two components first.

    Blocks of members in the order of size and position are skipped as a whole where no pair
    in them is close enough in size or can share enough from its positions on.  ``across``
    asks for pairs from different pieces only.
    """
    n, known, pos, overlap, comp, lower, piece = (member[name] for name in _MEMBER[1:])
    rest, besides = n - pos, known - overlap
    starts = range(0, len(n), BLOCK)
    left, right, bounds = ([np.zeros(0, np.int64)] for _ in range(3))
    for i in starts:
        a = slice(i, i + BLOCK)
        for j in starts[i // BLOCK :]:
            b = slice(j, j + BLOCK)
            if percent * n[b].min() > 100 * n[a].max():
                break
            if (100 + percent) * min(rest[a].max(), rest[b].max()) < percent * (n[a].min() + n[b].min()):
                continue
            bound = np.minimum(overlap[a, None], overlap[b]) + np.minimum(besides[a, None], besides[b])
            bound = np.minimum(bound, np.minimum(rest[a, None], rest[b]))
            fits = ((100 + percent) * bound >= percent * (n[a, None] + n[b])) & (comp[a, None] != comp[b])
            fits &= lower[a, None] | lower[b]
            if across:
                fits &= piece[a, None] != piece[b]
            p, q = np.nonzero(np.triu(fits, 1) if i == j else fits)
            left.append(p + i)
            right.append(q + j)
            bounds.append(bound[p, q])
    a, b = np.concatenate(left), np.concatenate(right)
    if most is None or not len(a):
        return a, b
    low, high = np.minimum(comp[a], comp[b]), np.maximum(comp[a], comp[b])
    order = np.lexsort((-np.concatenate(bounds), high, low))
    a, b, low, high = a[order], b[order], low[order], high[order]
    first = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
    rank = np.arange(len(a)) - np.repeat(first, np.diff(np.r_[first, len(a)]))
    return a[rank < most], b[rank < most]


_LIST = ("token", "class", "pieces")
_MEMBER = ("set", "n", "known", "pos", "overlap", "comp", "lower", "piece")
_PIECES = 1 << 20


def offered(lists: DataFrame, answers: DataFrame, components: DataFrame, percent: int, most: int | None, chunk: int) -> DataFrame:
    """Pairs (``a`` < ``b``) of lists with more than one component, each once.

    ``answers`` hold the overlaps of leaders (``a``) and members (``b``).
    """
    members = lists.join(components, "set")
    mixed = members.groupBy("token", "class").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.ceil(F.count(F.lit(1)) / F.lit(chunk)).cast("int").alias("number"),
    ).filter("low <> high").select("token", "class", "number")
    answer = answers.select(F.col("a").alias("leader"), F.col("b").alias("set"), "overlap")
    rows = members.join(mixed, ["token", "class"]).join(answer, ["leader", "set"], "left")
    rows = rows.withColumn("overlap", F.when(F.col("set") == F.col("leader"), F.col("known")).otherwise(F.col("overlap")))
    rows = rows.withColumn("piece", F.pmod(F.xxhash64("set"), F.col("number")).cast("int"))
    # Each piece of a large list meets every other one, in a task of their own.
    meets = F.transform(F.sequence(F.lit(0), F.col("number") - 1), lambda other: (
        F.least(other, F.col("piece")).cast("bigint") * F.lit(_PIECES) + F.greatest(other, F.col("piece"))))
    rows = rows.withColumn("pieces", F.explode(meets)).select(*_LIST, *_MEMBER)
    parts = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, *_LIST).sortWithinPartitions(*_LIST, "n", "pos", "set")

    def pairs(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        column = {name: table[name].to_numpy() for name in _MEMBER}
        code = table["pieces"].to_numpy()[starts]
        found = []
        for i, j, across in zip(starts, np.r_[starts[1:], table.num_rows], code // _PIECES != code % _PIECES):
            p, q = _offers({name: values[i:j] for name, values in column.items()}, bool(across), percent, most)
            found.append((column["set"][p + i], column["set"][q + i]))
        a, b = (np.concatenate(side) for side in zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        starts = np.zeros(0, np.int64)
        for batch in gathered(batches, 1 << 14):
            table = pa.Table.from_batches([*held, batch])
            keys = np.stack([table[name].to_numpy() for name in _LIST], axis=1)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            if len(starts) > 1:  # the last list may go on
                yield pairs(table.slice(0, starts[-1]), starts[:-1])
            held = table.slice(starts[-1]).combine_chunks().to_batches()
        if held:
            yield pairs(pa.Table.from_batches(held), np.zeros(1, np.int64))

    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def linked_components(sets: DataFrame, percent: int = PERCENT, chunk: int = CHUNK) -> DataFrame:
    """``set`` and ``comp``, the smallest set it is linked with over any number of links; ``sets`` as ``by_rarity`` gives them."""
    components = sets.select("set", F.col("set").alias("comp"))
    lists = materialize(index_lists(sets, percent), "lists")
    pairs = lists.filter("set <> leader").select(F.col("leader").alias("a"), F.col("set").alias("b")).distinct()
    answers = materialize(verified(pairs, sets, percent), "answers")
    components = merged(components, answers.filter("linked"))
    tried = answers.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    for most in OFFERS:
        pairs = offered(lists, answers, components, percent, most, chunk).join(tried, ["a", "b"], "left_anti")
        found = materialize(verified(materialize(pairs, "pairs"), sets, percent), "verified")
        links = found.filter("linked")
        if not links.isEmpty():
            components = merged(components, links)
        tried = tried.unionByName(found.select("a", "b"))
    discard(lists)
    return components


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of every row.

    Words are lower-cased (A-Z) and lie between spaces, tabs and line ends; a set holds the
    different runs of ``size`` words, or the whole sequence of a shorter text.  Sets with a
    Jaccard similarity of ``percent`` hundredths or more link.  A text without words, or
    null, has an empty set and links with nothing: its component is its own key.  Repeated
    rows and equal sets share a component.  A null key keeps its row and gets the component
    of a row with an equal set, or null if there is none; it links nothing itself.  Other
    columns are ignored.  No rows give no rows.
    """
    ship_code(docs.sparkSession)
    marks = materialize(marked(docs, key, text, size, percent), "marks")
    alive = materialize(with_company(marks, percent).withColumn("set", F.monotonically_increasing_id()), "alive")
    sets = materialize(by_rarity(materialize(whole_sets(docs, key, text, size, alive), "sets"), percent), "ranked")
    components = linked_components(sets, percent)
    named = alive.join(components, "set").select("h1", "h2", "first", "comp")
    smallest = named.groupBy("comp").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "comp").select("h1", "h2", "component_id")
    classes = marks.filter("n > 0").groupBy("h1", "h2").agg(F.min("k").alias("first")).join(named, ["h1", "h2"], "left")
    classes = classes.select("h1", "h2", F.coalesce("component_id", "first").alias("component_id"))
    found = marks.select("k", "n", "h1", "h2").join(classes, ["h1", "h2"], "left")
    return found.select(
        F.col("k").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("k")).alias("component_id"))
