"""SimHash near-duplicates, compared bit plane by bit plane.

Fingerprints that differ in at most three bits agree wholly in two of five blocks of bits.
Distinct fingerprints (copies are folded first) are sent to the ten buckets that two of
their blocks name.  A bucket keeps its fingerprints as 64 vertical bit planes.  One pass
compares every fingerprint with the one ``lag`` places on: planes are combined with
themselves shifted, and carry-save counters add up the differing bits of 64 pairs in each
machine word.  Words whose pairs are all beyond the radius are abandoned.  Of the links of
a bucket only those that join two groups are emitted, so a group of m fingerprints gives at
most m - 1 rows.  Larger buckets are cut into chunks, and each pair of chunks is a bucket
of its own: nothing is dropped and no task holds more than two chunks of a bucket.

``near_groups`` links fingerprints of 64 bits within three, as its contract says.
``similar_groups`` finds near copies by the similarity of their shingle sets: longer
fingerprints with a wider radius give candidates, and whole sets verify them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_code
from .blocks import SPACED, Block, Words, find_words, mix
from .components import connected
from .jaccard import set_names, shingle_sets, verified, whole_sets
from .rows import gathered, per_text_columns

RADIUS = 3
SHINGLE = 3
SEED = 42
CHUNK = 1024
#: The blocks of bits: lowest bit and width.
PARTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_limits(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last word of every shingle, and the shingle limits of the texts.

    A text with fewer words than ``size`` has one shingle, all of them; one without words none.
    """
    counts = np.diff(words.cuts)
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    cuts = np.concatenate([[0], np.cumsum(shingles)])
    first = np.arange(cuts[-1]) - np.repeat(cuts[:-1] - words.cuts[:-1], shingles)
    last = np.minimum(first + size, np.repeat(words.cuts[1:], shingles)) - 1
    return first, last, cuts


def fingerprints(block: Block) -> np.ndarray:
    """The fingerprint of every text of a block."""
    words = find_words(block, SPACED)
    spaced = np.append(np.where(SPACED[words.data], words.data, 0x20).astype(np.uint8), np.uint8(0x20))
    keep = np.append(SPACED[words.data], True)
    keep[words.ends] = True  # one space after each word; where two texts meet no shingle spans
    at = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=at[1:])
    joined = spaced[keep].tobytes()
    first, last, cuts = shingle_limits(words, SHINGLE)
    digest = xxhash.xxh64_digest
    hashes = b"".join([
        digest(joined[a:b], SEED) for a, b in zip(at[words.starts[first]].tolist(), at[words.ends[last]].tolist())
    ])
    out = np.zeros(block.n, np.uint64)
    filled = np.flatnonzero(np.diff(cuts))
    if len(filled):
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, cuts[filled], axis=0, dtype=np.int64)
        major = ones * 2 > np.diff(cuts)[filled, None]
        out[filled] = np.packbits(major, axis=1).view(">u8").ravel().astype(np.uint64)
    return out


def with_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and ``fp``, a signed 64-bit integer, of every row."""
    found = per_text_columns(
        docs.select(key, F.col(text).cast("string").alias(text)).select(F.col(key).alias("_key"), F.col(text).alias("_text")),
        "_text", "fp bigint", lambda block: [pa.array(fingerprints(block).view(np.int64))], carried=["_key"])
    return found.select(F.col("_key").alias(key), "fp")


def _planes(prints: np.ndarray) -> np.ndarray:
    """64 rows of bits, one word for 64 fingerprints, and a spare word for shifts."""
    n = -(-len(prints) // 64) * 64
    padded = np.zeros(n, np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _shifted(plane: np.ndarray, words: np.ndarray, lag: int) -> np.ndarray:
    """The bits ``lag`` places on, for the given words."""
    whole, part = divmod(lag, 64)
    low = words + whole
    near = np.where(low < len(plane), plane[np.minimum(low, len(plane) - 1)], np.uint64(0))
    if not part:
        return near
    high = low + 1
    far = np.where(high < len(plane), plane[np.minimum(high, len(plane) - 1)], np.uint64(0))
    return (near >> np.uint64(part)) | (far << np.uint64(64 - part))


def close_at_lag(planes: np.ndarray, lag: int, wanted: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Places whose fingerprint is within the radius of the one ``lag`` places on.

    ``wanted`` marks the places to compare, packed like a plane.  Three counter bits hold
    the differences so far; a fourth says that the radius is passed.
    """
    words = np.flatnonzero(wanted)
    ones = np.zeros(len(words), np.uint64)
    twos, over = ones.copy(), ~wanted[words]
    for p in range(64):
        differ = planes[p][words] ^ _shifted(planes[p], words, lag)
        carry = ones & differ
        ones ^= differ
        again = twos & carry
        twos ^= carry
        over |= again
        if p % 8 == 7:
            left = over != _ALL
            if not left.all():
                words, ones, twos, over = words[left], ones[left], twos[left], over[left]
            if not len(words):
                break
    close = np.zeros(len(wanted), np.uint64)
    close[words] = ~over
    return np.flatnonzero(np.unpackbits(close.view(np.uint8), bitorder="little"))


def _roots(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    found = parent[nodes]
    while True:
        up = parent[found]
        if (up == found).all():
            return found
        found = up


def links_within(buckets: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the groups of each bucket; ``buckets`` are equal for members and in order."""
    parent = np.arange(len(prints))
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    place = np.arange(len(prints))
    lag = 1
    while True:
        here = np.zeros(len(place), bool)
        here[:-lag] = buckets[place[:-lag]] == buckets[place[lag:]]
        if not here.any():
            break
        if lag & (lag - 1) == 0:  # rows of small buckets leave at every doubling of the lag
            starts = np.flatnonzero(np.r_[True, buckets[place[1:]] != buckets[place[:-1]]])
            size = np.diff(np.r_[starts, len(place)])
            place = place[np.repeat(size > lag, size)]
            planes = _planes(prints[place])
            here = np.zeros(len(place), bool)
            here[:-lag] = buckets[place[:-lag]] == buckets[place[lag:]]
        wanted = np.zeros(planes.shape[1] * 64, bool)
        wanted[: len(place)] = here
        at = close_at_lag(planes, lag, np.packbits(wanted, bitorder="little").view(np.uint64))
        a, b = place[at], place[at + lag]
        while len(a):
            ra, rb = _roots(parent, a), _roots(parent, b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if not len(a):
                break
            high, low = np.maximum(ra, rb), np.minimum(ra, rb)
            _, once = np.unique(high, return_index=True)
            parent[high[once]] = low[once]
            left.append(a[once])
            right.append(b[once])
        lag += 1
        if lag >= len(place):
            break
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _link_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition come in the order of their buckets; a bucket may go on in the next batch."""
    held_key = np.zeros((0, 2), np.int64)
    held = np.zeros(0, np.uint64)

    def found(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        change = np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)] if len(keys) else np.zeros(0, bool)
        a, b = links_within(np.cumsum(change), prints)
        return pa.RecordBatch.from_arrays(
            [pa.array(prints[a].view(np.int64)), pa.array(prints[b].view(np.int64))], ["u", "v"])

    for batch in batches:
        keys = np.stack([batch.column("bucket").to_numpy(), batch.column("chunks").to_numpy()], axis=1)
        keys = np.concatenate([held_key, keys])
        prints = np.concatenate([held, batch.column("fp").to_numpy().view(np.uint64)])
        if not len(keys):
            continue
        last = int(np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])[-1])
        held_key, held = keys[last:], prints[last:]
        if last > 1:
            yield found(keys[:last], prints[:last])
    if len(held) > 1:
        yield found(held_key, held)


def _buckets() -> Column:
    """Ten bucket numbers of a fingerprint: which two blocks, and their bits."""
    fp = F.col("fp")

    def bits(part: tuple[int, int]) -> Column:
        return F.shiftrightunsigned(fp, part[0]).bitwiseAND(F.lit((1 << part[1]) - 1))

    return F.array(*[
        (F.lit(number).cast("bigint") * F.lit(1 << 26) + bits(a) * F.lit(1 << 13) + bits(b)).cast("bigint")
        for number, (a, b) in enumerate(combinations(PARTS, 2))
    ])


def links(prints: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Links (``u``, ``v``) that connect the fingerprints within the radius; ``fp`` must be distinct."""
    ship_code(prints.sparkSession)
    spread = prints.select("fp", F.explode(_buckets()).alias("bucket"))
    sizes = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    number = F.ceil(F.col("size") / F.lit(chunk)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("number")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("number") - 1),
        lambda k: (F.least(k, F.col("own")) * F.lit(1 << 20) + F.greatest(k, F.col("own"))).cast("bigint"),
    )
    rows = (
        spread.join(sizes, "bucket").withColumn("number", number).withColumn("own", own)
        .select("fp", "bucket", F.explode(others).alias("chunks"))
    )
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "bucket", "chunks").sortWithinPartitions("bucket", "chunks", "fp")
    return rows.mapInArrow(_link_rows, "u bigint, v bigint")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` and ``component_id`` of every row.

    A null text is an empty one; a text without words has fingerprint zero and is linked
    like any other.  Equal texts, and repeated rows, share a component.  A null key keeps
    its row; ``component_id`` is the smallest key that is not null, or null if there is
    none.  Other columns are ignored.  No rows give no rows.
    """
    marked = materialize(with_fingerprints(docs, key, text), "prints")
    classes = marked.groupBy("fp").agg(F.min(key).alias("first_key"))
    groups = connected(links(classes.select("fp")))
    named = (
        classes.join(groups, classes.fp == groups.node, "left")
        .select("fp", "first_key", F.coalesce("root", "fp").alias("root"))
    )
    roots = named.groupBy("root").agg(F.min("first_key").alias("component_id"))
    table = materialize(named.join(roots, "root").select("fp", "component_id"), "groups")
    return marked.join(table, "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- near copies by similarity -----------------------------------------------------------------
WORDS = 5
PERCENT = 80
#: Share of the pairs at the wanted similarity that meet in some bucket and stay within the radius.
RECALL = 0.97
#: Members of a bucket in one task; small pieces keep the lags few and the planes long.
PIECE = 256
#: Pairs of members that a task compares at once.
_AT_ONCE = 1 << 22


@dataclass(frozen=True)
class Plan:
    """Fingerprints of ``words`` 64-bit words, cut into ``blocks`` of ``width`` bits; pairs within ``radius`` are verified."""

    words: int
    blocks: int
    width: int
    radius: int

    @staticmethod
    def of(rows: int, percent: int = PERCENT, recall: float = RECALL) -> Plan:
        """Blocks as wide as keep buckets small among so many rows, and as many as the recall asks for.

        Bits of sets with Jaccard similarity j differ with probability arccos(2j / (1 + j)) / pi.
        """
        j = percent / 100
        differ = math.acos(2 * j / (1 + j)) / math.pi
        width = min(max(math.ceil(math.log2(max(rows, 2))) - 4, 8), 24)
        blocks = math.ceil(math.log((1 - recall) / 2) / math.log(1 - (1 - differ) ** width))
        words = -(-blocks * width // 64)
        bits = 64 * words
        return Plan(words, blocks, width, math.ceil(bits * differ + 2.2 * math.sqrt(bits * differ * (1 - differ))))


def wide_fingerprints(hashes: np.ndarray, cuts: np.ndarray, words: int) -> np.ndarray:
    """A row of bytes for each text: a bit is one if it is in over half the hashes of its shingles.

    How often each value of a byte occurs in a text tells how often its bits are set.
    """
    n, counts = len(cuts) - 1, np.diff(cuts)
    out = np.zeros((n, 8 * words), np.uint8)
    first = np.repeat(np.arange(n) * 256, counts)
    for word in range(words):
        own = mix(hashes + np.uint64((2 * word + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)).view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            values = np.bincount(first + own[:, byte], minlength=256 * n).reshape(n, 256)
            out[:, 8 * word + byte] = np.packbits((values @ _BIT_SET) * 2 > counts[:, None], axis=1)[:, 0]
    return out


#: Which of its eight bits each value of a byte has set, the highest first.
_BIT_SET = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)


def _block_values(prints: np.ndarray, plan: Plan) -> np.ndarray:
    """The number that each block of bits of each fingerprint holds, with the block's own number above it."""
    bits = np.unpackbits(prints, axis=1)[:, : plan.blocks * plan.width].reshape(len(prints), plan.blocks, plan.width)
    values = bits.astype(np.int64) @ (1 << np.arange(plan.width, dtype=np.int64))
    return values + (np.arange(plan.blocks, dtype=np.int64) << plan.width)


def _add_eight(counter: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Add eight planes of bits to vertical counters by carry-save adders; returns what is carried out of them."""

    def add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        either = a ^ b
        return either ^ c, (a & b) | (either & c)

    ones, twos, fours = counter[:3]
    ones, t = add(ones, differ[0], differ[1])
    ones, u = add(ones, differ[2], differ[3])
    twos, f = add(twos, t, u)
    ones, t = add(ones, differ[4], differ[5])
    ones, u = add(ones, differ[6], differ[7])
    twos, g = add(twos, t, u)
    fours, carry = add(fours, f, g)
    counter[0], counter[1], counter[2] = ones, twos, fours
    for k in range(3, len(counter)):
        counter[k], carry = counter[k] ^ carry, counter[k] & carry
    return carry


def _limits(planes: int, radius: int) -> list[int]:
    """How many of the first 64, 128, ... planes may differ, of pairs that differ in ``radius`` of all at most."""
    share = radius / planes
    return [min(radius, math.ceil(p * share + 3.5 * math.sqrt(p * share * (1 - share)))) for p in range(64, planes, 64)] + [radius]


def distances_at_lag(planes: np.ndarray, lag: int, wanted: np.ndarray, radius: int, early: bool = False) -> np.ndarray:
    """Places whose fingerprint is within the radius of the one ``lag`` places on, for planes of any number.

    The differing bits of 64 pairs are added up in vertical counters, one machine word a binary
    digit, by carry-save adders.  After every 64 planes, words are abandoned all of whose pairs
    are over the radius, or (``early``) so far off that they will hardly come within it.
    """
    limits = _limits(len(planes), radius) if early else [radius] * (len(planes) // 64)
    digits = max(int(radius).bit_length(), 3)
    top = (1 << digits) - 1
    words = np.flatnonzero(wanted)
    counter = np.zeros((digits, len(words)), np.uint64)
    over, before = ~wanted[words], top
    for block, limit in enumerate(limits):
        rows = planes[64 * block : 64 * block + 64]
        differ = rows[:, words] ^ _shifted_rows(rows, words, lag)
        # Counters overflow as soon as the limit is passed: it is taken off their largest number,
        # and what they hold moves with it.
        over |= _moved(counter, before - limit)
        before = limit
        for k in range(0, 64, 8):
            over |= _add_eight(counter, differ[k : k + 8])
        left = over != _ALL
        if not left.all():
            words, counter, over = words[left], np.ascontiguousarray(counter[:, left]), over[left]
        if not len(words):
            break
    close = np.zeros(len(wanted), np.uint64)
    close[words] = ~over
    return np.flatnonzero(np.unpackbits(close.view(np.uint8), bitorder="little"))


def _moved(counter: np.ndarray, by: int) -> np.ndarray:
    """Add a number to all counters, or take it off; returns what is carried out, nothing when taking off."""
    carry = np.zeros(counter.shape[1], np.uint64)
    number = by if by >= 0 else by + (1 << len(counter))
    for k in range(len(counter)):
        bit = _ALL if number >> k & 1 else np.uint64(0)
        either = counter[k] ^ bit
        counter[k], carry = either ^ carry, (counter[k] & bit) | (either & carry)
    return carry if by >= 0 else np.zeros_like(carry)


def _shifted_rows(rows: np.ndarray, words: np.ndarray, lag: int) -> np.ndarray:
    """``_shifted`` for several planes at once."""
    whole, part = divmod(lag, 64)
    size = rows.shape[1]

    def at(place: np.ndarray) -> np.ndarray:
        inside = place < size
        found = rows[:, np.where(inside, place, 0)]
        return found if inside.all() else np.where(inside, found, np.uint64(0))

    near = at(words + whole)
    if not part:
        return near
    return (near >> np.uint64(part)) | (at(words + whole + 1) << np.uint64(64 - part))


def _wide_planes(prints: np.ndarray) -> np.ndarray:
    n = -(-len(prints) // 64) * 64
    padded = np.zeros((n, prints.shape[1]), np.uint8)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded, axis=1)
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def nearest_links(buckets: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of each bucket that join its groups, the nearest pairs first; a bucket of m gives m - 1 at most."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    place = np.arange(len(prints))
    lag = 1
    while lag < max(len(place), 1):
        here = np.zeros(len(place), bool)
        here[:-lag] = buckets[place[:-lag]] == buckets[place[lag:]]
        if not here.any():
            break
        if lag & (lag - 1) == 0:  # rows of small buckets leave at every doubling of the lag
            starts = np.flatnonzero(np.r_[True, buckets[place[1:]] != buckets[place[:-1]]])
            size = np.diff(np.r_[starts, len(place)])
            place = place[np.repeat(size > lag, size)]
            planes = _wide_planes(prints[place])
            here = np.zeros(len(place), bool)
            here[:-lag] = buckets[place[:-lag]] == buckets[place[lag:]]
        wanted = np.zeros(planes.shape[1] * 64, bool)
        wanted[: len(place)] = here
        at = distances_at_lag(planes, lag, np.packbits(wanted, bitorder="little").view(np.uint64), radius, early=True)
        found.append((place[at], place[at + lag]))
        lag += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = (np.concatenate(x) for x in zip(*found))
    distance = _BITS[prints[a] ^ prints[b]].sum(axis=1, dtype=np.int64)
    parent = np.arange(len(prints))
    left, right = [a[:0]], [b[:0]]
    for low in range(0, radius + 1, max(radius // 8, 1)):  # an eighth of the radius after the other
        some = (distance >= low) & (distance < low + max(radius // 8, 1))
        x, y = a[some], b[some]
        while len(x):
            rx, ry = _roots(parent, x), _roots(parent, y)
            apart = rx != ry
            x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
            if not len(x):
                break
            high, lower = np.maximum(rx, ry), np.minimum(rx, ry)
            _, once = np.unique(high, return_index=True)
            parent[high[once]] = lower[once]
            left.append(x[once])
            right.append(y[once])
    return np.concatenate(left), np.concatenate(right)


_BITS = np.array([bin(x).count("1") for x in range(256)], np.uint8)


def _fingerprinted(docs: DataFrame, key: str, text: str, size: int, plan: Plan) -> DataFrame:
    """Of every row ``k``, ``n``, ``h1``, ``h2`` (the set's names) and ``fp``, the fingerprint's bytes."""

    def look(block: Block) -> list[pa.Array]:
        hashes, cuts = shingle_sets(block, size)
        prints = wide_fingerprints(hashes, cuts, plan.words)
        return [pa.array(np.diff(cuts).astype(np.int64)), *set_names(hashes, cuts), pa.array([p.tobytes() for p in prints], pa.binary())]

    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    return per_text_columns(rows, "t", "n bigint, h1 bigint, h2 bigint, fp binary", look, ["k"])


def candidate_pairs(classes: DataFrame, plan: Plan, chunk: int = PIECE) -> DataFrame:
    """Pairs (``a``, ``b``) of classes (``set``, ``fp``) in a common bucket and within the radius, each once."""
    ship_code(classes.sparkSession)
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.frombuffer(b"".join(batch.column("fp").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("set").to_numpy(), plan.blocks)), pa.array(_block_values(prints, plan).ravel())],
                ["set", "bucket"])

    rows = classes.mapInArrow(spread, "set bigint, bucket bigint")
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    number = F.ceil(F.col("size") / F.lit(chunk)).cast("int")
    own = F.pmod(F.xxhash64("set"), F.col("number")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("number") - 1),
        lambda k: (F.least(k, F.col("own")) * F.lit(1 << 20) + F.greatest(k, F.col("own"))).cast("bigint"))
    dealt = rows.join(sizes, "bucket").withColumn("number", number).withColumn("own", own).select(
        "set", "bucket", F.explode(others).alias("chunks")).join(classes.select("set", "fp"), "set")
    dealt = dealt.repartition(parts, "bucket", "chunks").sortWithinPartitions("bucket", "chunks", "fp", "set")

    def pairs(table: pa.Table) -> pa.RecordBatch:
        sets = table["set"].to_numpy()
        prints = np.frombuffer(b"".join(table["fp"].to_pylist()), np.uint8).reshape(len(sets), -1)
        keys = np.stack([table["bucket"].to_numpy(), table["chunks"].to_numpy()], axis=1)
        numbers = np.cumsum(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        a, b = nearest_links(numbers, prints, plan.radius)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(sets[a], sets[b])), pa.array(np.maximum(sets[a], sets[b]))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in gathered(batches, 4096):
            table = pa.Table.from_batches([*held, batch])
            keys = np.stack([table["bucket"].to_numpy(), table["chunks"].to_numpy()], axis=1)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            first = 0  # whole buckets, as many as have no more pairs than are compared at once
            work = 0
            for at, end in zip(starts[:-1], starts[1:]):
                work += int(end - at) ** 2 // 2
                if work >= _AT_ONCE:
                    yield pairs(table.slice(first, end - first))
                    first, work = int(end), 0
            if first < starts[-1]:
                yield pairs(table.slice(first, starts[-1] - first))
            held = table.slice(starts[-1]).combine_chunks().to_batches()
        if held:
            yield pairs(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT,
                   recall: float = RECALL) -> DataFrame:
    """``key`` and ``component_id`` of every row, by near copies of sets of ``size`` words.

    Candidates come from SimHash buckets and bit planes, wide enough to find ``recall`` of the
    pairs at ``percent`` hundredths of Jaccard similarity; every link is verified on the whole
    sets, so no less similar texts are linked.  Equal sets and repeated rows share a component.
    A text without words links with nothing and keeps its key; a null key gets the component of
    an equal set, or null.  Other columns are ignored; no rows give no rows.
    """
    plan = Plan.of(docs.count(), percent, recall)
    marks = materialize(_fingerprinted(docs, key, text, size, plan), "prints")
    classes = marks.filter("n > 0").groupBy("h1", "h2").agg(
        F.max("n").alias("n"), F.min("k").alias("first"), F.max("fp").alias("fp")).filter("first IS NOT NULL")
    classes = materialize(classes.withColumn("set", F.monotonically_increasing_id()), "classes")
    pairs = materialize(candidate_pairs(classes.select("set", "fp"), plan), "pairs")
    met = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    alive = materialize(classes.select("set", "h1", "h2", "n", "first").join(met, "set"), "alive")
    sets = materialize(whole_sets(docs, key, text, size, alive), "sets")
    links = verified(pairs, sets, percent).filter("linked")
    groups = connected(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    named = classes.select("h1", "h2", "first", "set").join(groups, F.col("set") == F.col("node"), "left").select(
        "h1", "h2", "first", F.coalesce("root", "set").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    table = materialize(named.join(smallest, "root").select("h1", "h2", "component_id"), "groups")
    return marks.select("k", "n", "h1", "h2").join(table, ["h1", "h2"], "left").select(
        F.col("k").alias(key), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("k")).alias("component_id"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text",
               groups: Callable[[DataFrame, str, str], DataFrame] = near_groups) -> DataFrame:
    """Rows of ``docs`` whose key names its component: one document of each of ``groups`` stays.

    Groups are those of near fingerprints, or of near copies with ``similar_groups``, which
    leaves texts without words alone.  Repeated rows of one key stay together; rows without a
    key stay.
    """
    found = groups(docs, key, text).filter(F.col(key) != F.col("component_id")).select(key).distinct()
    found = found.hint("shuffle_hash")  # keys are hashed, so the texts need no sort
    return docs.join(found, key, "left_anti")
