"""Removal of repeated passages by longest previous factors.

A byte goes if some string of ``LENGTH`` bytes over it also starts earlier.  Where a string
starts earlier is read off the suffix order: of all places that precede a place, the one
with the longest match is next to it among the smaller places before or after it in that
order (its previous and its next smaller value).

The corpus is cut so that equal strings meet.  Every window of ``LENGTH`` bytes has an
anchor, the run of ``GRAM`` bytes in it with the smallest hash; neighbouring windows with
one anchor form a stretch.  Equal windows have equal anchors at equal offsets.

1. Stretches are counted by anchor and content.  A stretch that occurs in an earlier
   document, or before in its own, is removed whole.  Copies are combined before the
   shuffle, so a passage with very many copies is a row a task.
2. Anchors of several different stretches (where copies begin, end or were edited) are
   settled on the bytes: the first stretch of each content is sent to its anchor's task,
   which sorts the suffixes and takes previous and next smaller places.
3. An anchor with more than ``CROWD`` different stretches would not fit a task.  Its stretches
   are halved by where in a window the anchor stands.  All windows of a half share most of
   their bytes around the anchor; equal ones share them all, so these bytes are the half's
   new anchor.  Halves that are still crowded are halved again, down to single windows.

Documents themselves are moved by id only, to cut out stretches and to remove bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_code
from .blocks import Block, RollingHash, mix, text_blocks

LENGTH = 100
GRAM = 24
#: Most different stretches of one anchor that meet in a task.
CROWD = 2_000
#: Places in a window where its anchor may stand.
WIDTH = LENGTH - GRAM + 1
#: Bytes of stretches that a task sorts at once.
SORT_BYTES = 1 << 20
#: Rows a task gathers before it combines copies and sends them.
_GATHER = 1 << 18
#: Bytes of text cut into stretches at once; a task needs some hundred times as many.
_CUT_BYTES = 512 << 10
_PLACE_BITS = 22
_STRETCH = "_key bigint, anchor bigint, content bigint, start bigint, windows int, again boolean"


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of ``width`` values, by doubling."""
    reach, out = 1, values
    while 2 * reach <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    if reach < width:
        rest = width - reach
        out = np.minimum(out[:-rest], out[rest:])
    return out


def stretches(block: Block, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Text number, anchor and content hash, first window and number of windows of every stretch.

    Anchors are the leftmost smallest; only the upper hash bits are compared, next to the
    place, so that one minimum gives both.
    """
    data = block.data
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none
    if len(data) >= 1 << _PLACE_BITS:
        return _long_stretches(block, length, gram)
    rolling = RollingHash(data)
    n = len(data) - gram + 1
    hashes = rolling.of(np.arange(n), np.arange(gram, gram + n))
    low = np.uint64((1 << _PLACE_BITS) - 1)
    anchor = (sliding_minimum((hashes & ~low) | np.arange(n, dtype=np.uint64), length - gram + 1) & low).astype(np.int64)
    text_of = np.repeat(np.arange(block.n), np.diff(block.bounds))
    inside = text_of[: len(anchor)] == text_of[length - 1 :]
    breaks = np.ones(len(anchor) + 1, bool)
    breaks[1:-1] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1]) | (text_of[1 : len(anchor)] != text_of[: len(anchor) - 1])
    edges = np.flatnonzero(breaks)
    first, last = edges[:-1], edges[1:]
    first, last = first[inside[first]], last[inside[first]]
    content = rolling.of(first, last - 1 + length)
    return text_of[first], hashes[anchor[first]].view(np.int64), content.view(np.int64), first, last - first


def _long_stretches(block: Block, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """A text too long for packed places, in overlapping parts; every window is in one part.

    Stretches are cut at the part's edge.  That would give equal windows different stretches,
    so the anchor, not the stretch, is what brings them together: both parts of a cut stretch
    keep its anchor.
    """
    size = 1 << (_PLACE_BITS - 2)
    found = []
    for low in range(0, len(block.data) - length + 1, size):
        data = block.data[low : low + size + length - 1]
        text, anchor, content, first, windows = stretches(Block(0, data, np.array([0, len(data)])), length, gram)
        found.append((text, anchor, content, first + low, windows))
    return tuple(np.concatenate(columns) for columns in zip(*found))


def _stretch_rows(docs: DataFrame, key: str, text: str, combined: bool = False) -> DataFrame:
    """Every stretch, ``again`` where its content occurs before in the same document.

    ``combined``: a row for each content of a task instead, with its smallest key and number.
    """
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("_key").to_numpy()
            for block in text_blocks(batch.column("_text"), _CUT_BYTES):
                number, anchor, content, first, windows = stretches(block)
                again = np.ones(len(number), bool)
                seen = mix(anchor.view(np.uint64) + mix(content.view(np.uint64) + number.astype(np.uint64)))
                again[np.unique(seen, return_index=True)[1]] = False
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[block.first + number]), pa.array(anchor), pa.array(content),
                    pa.array(first - block.bounds[number]), pa.array(windows.astype(np.int32)), pa.array(again),
                ], ["_key", "anchor", "content", "start", "windows", "again"])

    rows = docs.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("_key"), F.col(text).cast("string").alias("_text"))
    if combined:
        return rows.mapInArrow(
            lambda batches: _combined(run(batches)), "_key bigint, anchor bigint, content bigint, many bigint")
    return rows.mapInArrow(run, _STRETCH)


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies of a content within a task as one row: smallest key and number."""
    def combine(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        key, anchor, content = (np.concatenate([p.column(i).to_numpy() for p in parts]) for i in range(3))
        order = np.lexsort((key, content, anchor))
        key, anchor, content = key[order], anchor[order], content[order]
        starts = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])])
        return pa.RecordBatch.from_arrays(
            [pa.array(key[starts]), pa.array(anchor[starts]), pa.array(content[starts]),
             pa.array(np.diff(np.r_[starts, len(key)]))], ["_key", "anchor", "content", "many"])

    parts, size = [], 0
    for batch in batches:
        if batch.num_rows:
            parts.append(batch)
            size += batch.num_rows
        if size >= _GATHER:
            yield combine(parts)
            parts, size = [], 0
    if parts:
        yield combine(parts)


def suffix_ranks(data: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Ranks of ``data[p : p + length]`` for every place, in suffix order, by prefix doubling."""
    padded = np.append(data, np.zeros(length + 8, np.uint8))
    width = min(8, length)
    key = np.zeros(len(data), np.uint64)
    for k in range(width):
        key = (key << np.uint64(8)) | padded[k : k + len(data)]
    rank = np.unique(key, return_inverse=True)[1].astype(np.int64)

    def joined(at: np.ndarray, ahead: int) -> np.ndarray:
        beyond = at + ahead
        after = np.where(beyond < len(data), rank[np.minimum(beyond, len(data) - 1)] + 1, 0)
        return np.unique(rank[at] * (len(data) + 2) + after, return_inverse=True)[1].astype(np.int64)

    everywhere = np.arange(len(data))
    while 2 * width < length:
        rank = joined(everywhere, width)
        width *= 2
    return joined(places, length - width) if width < length else rank[places]


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value to the left, -1 where there is none, by pointer jumping."""
    found = np.arange(-1, len(values) - 1)
    open_ = np.flatnonzero((found >= 0) & (values[np.maximum(found, 0)] >= values))
    while len(open_):
        found[open_] = found[found[open_]]
        at = found[open_]
        open_ = open_[(at >= 0) & (values[np.maximum(at, 0)] >= values[open_])]
    return found


def has_previous(ranks: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Which places have an equal string at a place with a smaller ``order`` number.

    In suffix order the longest match with anything earlier is at the previous or at the
    next smaller value; it spans the whole string if that neighbour has the same rank.
    """
    sorted_ = np.lexsort((order, ranks))
    values, rank = order[sorted_], ranks[sorted_]
    before = nearest_smaller(values)
    after = len(values) - 1 - nearest_smaller(values[::-1])[::-1]
    matched = (before >= 0) & (rank[np.maximum(before, 0)] == rank)
    matched |= (after < len(values)) & (rank[np.minimum(after, len(values) - 1)] == rank)
    out = np.zeros(len(order), bool)
    out[sorted_] = matched
    return out


def settle(
    pieces: list[bytes], keys: np.ndarray, starts: np.ndarray, length: int = LENGTH,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans (key, start, end) of windows that occur earlier, for stretches that meet in a task."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    many = sizes - length + 1
    piece = np.repeat(np.arange(len(pieces)), many)
    offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    places = bounds[piece] + offset
    at = starts[piece] + offset
    order = np.empty(len(at), np.int64)
    by_place = np.lexsort((at, keys[piece]))
    order[by_place] = np.cumsum(np.r_[False, (np.diff(keys[piece][by_place]) != 0) | (np.diff(at[by_place]) != 0)][: len(at)])
    # Windows of the same document and start (repeated rows) share a number: neither is earlier.
    gone = has_previous(suffix_ranks(data, places, length), order)
    piece, at = piece[gone], at[gone]
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none
    new = np.flatnonzero(np.r_[True, (piece[1:] != piece[:-1]) | (at[1:] != at[:-1] + 1)])
    last = np.r_[new[1:], len(at)] - 1
    return keys[piece[new]], at[new], at[last] + length


def _settle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in the order of their anchors; whole anchors are settled together."""
    def settled(table: pa.Table) -> pa.RecordBatch:
        found = settle(
            table.column("bytes").to_pylist(), *(table.column(c).to_numpy() for c in ("_key", "start")))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["_key", "start", "end"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < SORT_BYTES:
            continue
        table = pa.Table.from_batches(held)
        anchor = table.column("anchor").to_numpy()
        last = int(np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])[-1])
        if last:
            yield settled(table.slice(0, last))
        held = table.slice(last).combine_chunks().to_batches()
        size = sum(b.nbytes for b in held)
    if held:
        yield settled(pa.Table.from_batches(held))


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted stretches of every document."""
    for batch in batches:
        keys = batch.column("_key").to_numpy()
        wanted = batch.column("wanted")
        for block in text_blocks(batch.column("_text")):
            anchor, contents, start, key, cut = [], [], [], [], []
            for i in range(block.n):
                low = int(block.bounds[i])
                for w in wanted[block.first + i].as_py():
                    anchor.append(w["anchor"])
                    contents.append(w["contents"])
                    start.append(w["start"])
                    key.append(keys[block.first + i])
                    cut.append(block.data[low + w["start"] : low + w["start"] + w["windows"] + LENGTH - 1].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor, pa.int64()), pa.array(contents, pa.int64()), pa.array(start, pa.int64()),
                 pa.array(key, pa.int64()), pa.array(cut, pa.binary())],
                ["anchor", "contents", "start", "_key", "bytes"])


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Byte spans (``_key``, ``start``, ``end``) of documents to remove; spans may overlap."""
    spark = docs.sparkSession
    rows = _stretch_rows(docs, key, text)
    counted = _stretch_rows(docs, key, text, combined=True)
    contents = counted.groupBy("anchor", "content").agg(F.min("_key").alias("owner"), F.sum("many").alias("many"))
    mixed = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1")
    known = materialize(
        contents.join(mixed, "anchor", "left").filter("many > 1 OR contents IS NOT NULL")
        .select("anchor", "content", "owner", F.coalesce("contents", F.lit(0)).alias("contents")), "stretches")
    judged = rows.join(known, ["anchor", "content"]).filter("owner < _key OR again OR contents > 0").select(
        "_key", "anchor", "start", "windows", "contents", (F.col("again") | (F.col("owner") < F.col("_key"))).alias("gone"))
    judged = materialize(judged, "judged")
    whole = judged.filter("gone").select("_key", "start", (F.col("start") + F.col("windows") + LENGTH - 1).alias("end"))
    open_ = judged.filter("NOT gone").groupBy("_key").agg(
        F.collect_list(F.struct("anchor", "contents", "start", "windows")).alias("wanted"))  # within one document
    texts = docs.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("_key"), F.col(text).cast("string").alias("_text"))
    pieces = materialize(texts.join(open_.hint("shuffle_hash"), "_key").mapInArrow(
        _cut_out, "anchor bigint, contents bigint, start bigint, _key bigint, bytes binary"), "pieces")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    calm, copied = _without_crowds(pieces)
    partly = calm.repartition(parts, "anchor").sortWithinPartitions("anchor", "_key", "start").mapInArrow(
        _settle_rows, "_key bigint, start bigint, end bigint")
    return reduce(DataFrame.union, copied, whole.union(materialize(partly, "partly")))


def _halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both halves of stretches whose windows have their anchor at ``low`` to ``high``, under new anchors."""
    upper = ~np.uint64((1 << _PLACE_BITS) - 1)
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = batch.column("bytes").to_pylist()
        sizes = np.array([len(c) for c in cut], np.int64)
        begin = np.cumsum(sizes) - sizes
        rolling = RollingHash(np.frombuffer(b"".join(cut), np.uint8))
        at = begin[:, None] + np.arange(WIDTH)
        # The anchor is the leftmost smallest of the first window, as in ``stretches``.
        place = np.argmin(rolling.of(at, at + GRAM) & upper, axis=1)
        old, key, start, low, high = (batch.column(c).to_numpy() for c in ("anchor", "_key", "start", "low", "high"))
        middle = (low + high) // 2
        for a, b in ((low, middle), (middle, high)):
            first, last = np.maximum(0, place - b + 1), np.minimum(sizes - LENGTH, place - a)
            some = np.flatnonzero(first <= last)
            shared = rolling.of((begin + place - a)[some], (begin + place - b + 1 + LENGTH)[some])
            anchor = mix(shared + mix(old[some].view(np.uint64) + (a * (WIDTH + 1) + b)[some].astype(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array((start + first)[some]), pa.array(key[some]),
                 pa.array([cut[i][first[i] : last[i] + LENGTH] for i in some], pa.binary()), pa.array(a[some]), pa.array(b[some])],
                ["anchor", "start", "_key", "bytes", "low", "high"])


def _without_crowds(pieces: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Pieces (``anchor``, ``start``, ``_key``, ``bytes``) of which no anchor has more than ``CROWD``, and spans settled on the way.

    Halves with equal bytes are copies: the first goes on, the others are spans to remove.
    """
    columns = ["anchor", "start", "_key", "bytes"]
    calm, copied = pieces.filter(F.col("contents") <= CROWD).select(columns), []
    crowded = pieces.filter(F.col("contents") > CROWD).select(
        *columns, F.lit(0).cast("bigint").alias("low"), F.lit(WIDTH).cast("bigint").alias("high"))
    place = F.struct("_key", "start")
    while not crowded.isEmpty():
        halves = materialize(crowded.mapInArrow(
            _halved, "anchor bigint, start bigint, _key bigint, bytes binary, low bigint, high bigint"), "halves")
        firsts = halves.groupBy("anchor", "bytes").agg(
            F.min(place).alias("first"), F.min("low").alias("low"), F.min("high").alias("high"))
        contents = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents"))
        firsts = materialize(firsts.join(contents, "anchor"), "first-halves")
        copied.append(halves.join(firsts.select("anchor", "bytes", "first"), ["anchor", "bytes"]).filter(place > F.col("first")).select(
            "_key", "start", (F.col("start") + F.length("bytes")).alias("end")))
        open_ = firsts.filter("contents > 1").select("anchor", "first.start", "first._key", "bytes", "low", "high", "contents")
        again = (F.col("contents") > CROWD) & (F.col("high") - F.col("low") > 1)
        calm = calm.union(open_.filter(~again).select(columns))
        crowded = open_.filter(again).drop("contents")
    return calm, copied


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept`` (bytes) of every row.

    Lengths are in UTF-8 bytes; ``kept`` may end within a character where a removed run does.
    A null text is an empty one.  Texts under ``LENGTH`` bytes lose nothing.  Repeated rows
    count as one document and get the same result.  Rows without a key are not compared and
    lose nothing.  Other columns are ignored.
    """
    found = repeated_spans(docs, key, text)
    spans = found.groupBy("_key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    rows = docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans")
            for block in text_blocks(batch.column("_text")):
                size, removed, runs, digest, kept = [], [], [], [], []
                for i in range(block.n):
                    data = block.data[block.bounds[i] : block.bounds[i + 1]]
                    change = np.zeros(len(data) + 1, np.int64)
                    for span in spans[block.first + i].as_py() or ():
                        change[span["start"]] += 1
                        change[span["end"]] -= 1
                    gone = np.cumsum(change)[:-1] > 0
                    rest = data[~gone].tobytes()
                    size.append(len(data))
                    removed.append(int(gone.sum()))
                    runs.append(int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) and gone[0])))
                    digest.append(hashlib.sha256(rest).hexdigest())
                    kept.append(rest)
                yield pa.RecordBatch.from_arrays([
                    batch.column("_key").slice(block.first, block.n), pa.array(size, pa.int64()),
                    pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest), pa.array(kept, pa.binary()),
                ], ["_key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = rows.join(spans.hint("shuffle_hash"), "_key", "left")
    result = joined.mapInArrow(
        run, "_key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    return result.withColumnRenamed("_key", key)
