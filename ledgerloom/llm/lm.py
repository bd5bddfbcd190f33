"""Scoring of texts by context-tree weighting over bytes.

A text is a sequence of tokens: its words in lower case, then one end.  It is coded byte by
byte (a word closes with a space), a byte as eight binary decisions, each given the last
``DEPTH`` bytes of the text, whichever tokens they belong to; before the text stand spaces.
For every decision and every context two counts give a Krichevsky-Trofimov estimate; a
context's weighted probability is half its own estimate and half the product of its longer
contexts.  So all depths are mixed, with weights that the training text decides.

How the work is spread:

1. Each task turns its documents into numbers of a local dictionary, and counts the bytes
   with their contexts (codes) before anything is shuffled.  The codes of such a split travel
   sorted in ``BINS`` bins by their remainder, a bin a row.
2. Codes are added up over the corpus, a bin at a time, split after split.  All that share
   their last two bytes of context are mixed together in one group; only the sums of depths 0
   and 1 pass through the driver.
3. The same groups then score every different code once.
4. Scores return to the splits their codes came from, bin by bin again, where each text is
   run through.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import by_task, discard, materialize, ship_code
from .blocks import SPACED, find_words, text_blocks

DEPTH = 5
#: Tokens that share one local dictionary.
SPLIT_TOKENS = 4_000_000
#: Tokens of a split that are coded at once, or one longer text.
CODED_TOKENS = 100_000
#: Bins that codes travel in, by their remainder; a prime.
BINS = 1021
#: Most decisions that are mixed in one group, about.
BLOCK_DECISIONS = 1_000_000
#: Code rows written at once.
CODE_ROWS = 500_000
_SPACE, _END = 0x20, "\n"
_HALF = math.log(0.5)


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes; equal places of the numbers stand together, as high ones are mostly zero."""
    return zlib.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def packed_codes(codes: np.ndarray) -> bytes:
    """Codes in order, as the steps between them."""
    return packed(np.diff(codes, prepend=0))


def unpacked_codes(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw, np.int64))


# --- tokens ---------------------------------------------------------------------------------

class _Split:
    """Documents gathered by a task and the dictionary of their words."""

    def __init__(self) -> None:
        self.numbers: dict[int, int] = {}
        self.words: list[bytes] = []
        self.ids: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.keys: list[pa.Array] = []
        self.held: list[pa.Array] = []
        self.tokens = 0

    def add(self, block, keys: pa.Array, held: pa.Array) -> None:
        words = find_words(block, SPACED)
        raw = words.data.tobytes()
        hashes, index = np.unique(words.hashes, return_inverse=True)
        some = np.empty(len(hashes), np.int64)
        some[index] = np.arange(len(index))
        numbers = []
        for h, a, b in zip(hashes.tolist(), words.starts[some].tolist(), words.ends[some].tolist()):
            number = self.numbers.setdefault(h, len(self.words))
            if number == len(self.words):
                self.words.append(raw[a:b])
            numbers.append(number)
        self.ids.append(np.array(numbers, np.int32)[index])
        self.counts.append(np.diff(words.cuts))
        self.sizes.append(np.diff(block.bounds))
        self.keys.append(keys)
        self.held.append(held)
        self.tokens += len(index)

    def rows(self, number: int, depth: int, across: bool) -> Iterator[pa.RecordBatch]:
        """A row per word of the dictionary, a row per bin of different codes, then a row per document."""
        ids = np.concatenate(self.ids)
        order = np.argsort(-np.bincount(ids, minlength=len(self.words)), kind="stable")
        frequent = np.empty(len(order), np.int32)
        frequent[order] = np.arange(1, len(order) + 1)  # small numbers are common
        ids = frequent[ids]
        counts, sizes = np.concatenate(self.counts), np.concatenate(self.sizes)
        held = pa.concat_arrays(self.held)
        taught = ~held.to_numpy(zero_copy_only=False)
        trained = np.bincount(ids[np.repeat(taught, counts)], minlength=len(order) + 1)
        trained[0] = taught.sum()  # number 0 is the end
        words = [_END.encode(), *(self.words[at] for at in order.tolist())]
        self.numbers, self.words, self.ids = {}, [], []
        n = len(words)
        yield _row_batch(
            n, split=np.full(n, number), local=np.arange(n, dtype=np.int32),
            word=pa.array(words, pa.binary()).cast(pa.string()), trained=trained.astype(np.int64))
        every, seen = counted(coded(words, ids, counts, depth, across), taught)
        bins = (every % BINS).astype(np.int16)
        by_bin = np.argsort(bins, kind="stable")
        every, seen = every[by_bin], seen[by_bin]
        starts = np.searchsorted(bins[by_bin], np.arange(BINS + 1))
        used = np.flatnonzero(np.diff(starts))
        yield _row_batch(
            len(used), split=np.full(len(used), number), bin=used.astype(np.int32),
            codes=pa.array([packed_codes(every[starts[i] : starts[i + 1]]) for i in used], pa.binary()),
            seen=pa.array([packed(seen[starts[i] : starts[i + 1]].astype(np.int32)) for i in used], pa.binary()))
        n = len(counts)
        table = _row_batch(
            n, split=np.full(n, number), _key=pa.concat_arrays(self.keys), held=held, size=sizes.astype(np.int64),
            ids=pa.array([packed(x) for x in np.split(ids, np.cumsum(counts)[:-1])], pa.binary()))
        for low in range(0, n, 2000):
            yield table.slice(low, 2000)


_ROW = pa.schema([
    ("split", pa.int64()), ("local", pa.int32()), ("word", pa.string()), ("trained", pa.int64()), ("bin", pa.int32()),
    ("codes", pa.binary()), ("seen", pa.binary()), ("_key", pa.int64()), ("held", pa.bool_()), ("size", pa.int64()),
    ("ids", pa.binary())])
_ROWS = ("split bigint, local int, word string, trained bigint, bin int, codes binary, seen binary, _key bigint, "
         "held boolean, size bigint, ids binary")


def _row_batch(n: int, **columns) -> pa.RecordBatch:
    """Rows with the given columns, null in all others."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name]) if f.name in columns else pa.nulls(n, f.type) for f in _ROW], _ROW.names)


def encode(docs: DataFrame, key: str, text: str, held: str, depth: int = DEPTH, across: bool = True) -> DataFrame:
    """Dictionary, code and document rows of all documents; ``held`` marks those not to learn from."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        split = _Split()
        for batch in batches:
            for block in text_blocks(batch.column("_text")):
                split.add(block, batch.column("_key").slice(block.first, block.n),
                          batch.column("_held").slice(block.first, block.n))
                if split.tokens >= SPLIT_TOKENS:
                    yield from split.rows(number, depth, across)
                    number, split = number + 1, _Split()
        if split.counts:
            yield from split.rows(number, depth, across)

    rows = docs.select(
        F.col(key).cast("bigint").alias("_key"), F.col(held).cast("boolean").alias("_held"),
        F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, _ROWS)


# --- contexts -------------------------------------------------------------------------------

def coded(words: list[bytes], ids: np.ndarray, counts: np.ndarray, depth: int, across: bool) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Some texts at a time: which, how many bytes each has, and the codes of all their bytes with the ``depth`` bytes before.

    ``ids`` are the words of all texts (number 0 is the end, which every text gets), ``counts``
    how many a text has.  Bytes before a text count as spaces; unless contexts go ``across``
    tokens, those before every token do.  A code has the context above the lowest byte.
    """
    padding = len(words)
    written = pa.array([words[0], *(w + b" " for w in words[1:]), b" " * depth], pa.large_binary())
    sizes = np.diff(np.frombuffer(written.buffers()[1], np.int64)[: padding + 2])
    cuts = np.r_[0, np.cumsum(counts)]
    low = 0
    while low < len(counts):
        high = max(low + 1, int(np.searchsorted(cuts, cuts[low] + CODED_TOKENS, "right")) - 1)
        many = counts[low:high] + 1
        tokens = np.insert(ids[cuts[low] : cuts[high]], np.cumsum(many - 1), 0)
        first = np.cumsum(many) - many
        size = np.add.reduceat(sizes[tokens], first)
        tokens = np.insert(tokens, first if across else np.arange(len(tokens)), padding)
        own = sizes[tokens]
        data = np.frombuffer(written.take(pa.array(tokens)).buffers()[2], np.uint8)[: int(own.sum())]
        codes = np.zeros(len(data), np.int64)
        for back in range(depth, -1, -1):
            codes <<= 8
            codes[back:] |= data[: len(data) - back]
        padded = np.flatnonzero(tokens == padding)
        real = np.ones(len(data), bool)
        real[((np.cumsum(own) - own)[padded][:, None] + np.arange(depth)).ravel()] = False
        yield slice(low, high), size, codes[real]
        low = high


def added(codes: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The different codes of sorted runs in order, and the sums of their numbers."""
    every, number = np.concatenate(codes), np.concatenate(n)
    order = np.argsort(every, kind="stable")  # merges sorted runs
    every = every[order]
    first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]][: len(every)])
    return every[first], np.add.reduceat(number[order], first) if len(first) else number


class Sums:
    """Numbers of codes, added up run by run; merged when the runs waiting outweigh what is merged."""

    def __init__(self) -> None:
        self.codes, self.n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self.waiting = 0

    def add(self, codes: np.ndarray, n: np.ndarray) -> None:
        self.codes.append(codes)
        self.n.append(n)
        self.waiting += len(codes)
        if self.waiting > len(self.codes[0]):
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        codes, n = added(self.codes, self.n)
        self.codes, self.n, self.waiting = [codes], [n], 0
        return codes, n


def counted(chunks: Iterator[tuple[slice, np.ndarray, np.ndarray]], taught: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different codes in order, and how often each stands in a text that is ``taught``."""
    sums = Sums()
    for texts, size, codes in chunks:
        known, n = np.unique((codes << 1) | np.repeat(taught[texts], size), return_counts=True)
        sums.add(known >> 1, n * (known & 1))
    return sums.total()


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive numbers, by Stirling's series from 8 on."""
    shift, y = np.zeros_like(x), x.copy()
    for _ in range(8):
        low = y < 8
        shift += np.where(low, np.log(y), 0.0)
        y = np.where(low, y + 1, y)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


#: Logarithms of the gamma function at n + 1/2 and n + 1 for common n.
_TABLE = {shift: _log_gamma(np.arange(4096) + shift) for shift in (0.5, 1.0)}


def _log_gamma_of(n: np.ndarray, shift: float) -> np.ndarray:
    table = _TABLE[shift]
    out = table[np.minimum(n, len(table) - 1)]
    large = np.flatnonzero(n >= len(table))
    out[large] = _log_gamma(n[large] + shift)
    return out


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _log_gamma_of(zeros, 0.5) + _log_gamma_of(ones, 0.5) - 2 * _TABLE[0.5][0] - _log_gamma_of(zeros + ones, 1.0)


class Level:
    """One binary decision of the bytes in all contexts of one depth.

    Nodes are in the order of their keys.  ``keys`` hold the context and the byte's earlier
    bits; ``parent`` is the number of the node with the oldest byte of the context left out.
    """

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, parent: np.ndarray | None = None):
        self.keys, self.zeros, self.ones, self.parent = keys, zeros, ones, parent

    def weigh(self, longer: Level | None, product: np.ndarray | None = None) -> Level:
        """Mix the own estimate with the product of the longer contexts."""
        own = log_estimate(self.zeros, self.ones)
        if longer is not None:
            product = np.bincount(longer.parent, longer.log_weighted, len(self.keys))
        if product is None:
            self.log_weighted, self.stop = own, np.ones(len(own))
        else:
            self.log_weighted = _HALF + np.logaddexp(own, product)
            self.stop = np.exp(_HALF + own - self.log_weighted)
        return self

    def settle(self, shorter: Level | None) -> Level:
        """Probability of a one mixed so far, and the share left to longer contexts."""
        estimate = (self.ones + 0.5) / (self.zeros + self.ones + 1.0)
        sure, left = 0.0, 1.0
        if shorter is not None:
            sure, left = shorter.sure[self.parent], shorter.left[self.parent]
        self.sure = sure + left * self.stop * estimate
        self.left = left * (1 - self.stop)
        return self


def mix_subtree(codes: np.ndarray, n: np.ndarray, depth: int) -> Iterator[tuple[Level, np.ndarray]]:
    """For each of the eight decisions: the level of depth 2, and the probability of a one for every code.

    ``codes`` are different ones, in order, of whole groups of contexts with the same last two
    bytes.  A context that was never seen weighs nothing and adds nothing, so codes without
    a count change no other's probability.
    """
    tables, up = {depth: (codes, n)}, {}
    for d in range(depth - 1, 1, -1):  # the contexts one byte shorter
        long, many = tables[d + 1]
        short, up[d + 1] = np.unique(long & ((1 << (8 * d + 8)) - 1), return_inverse=True)
        total = np.zeros(len(short), np.int64)
        np.add.at(total, up[d + 1], many)
        tables[d] = short, total
    for bit in range(8):
        levels, node = {}, None
        for d in range(2, depth + 1):
            own, many = tables[d]
            keys = own >> (8 - bit)
            new = np.r_[True, keys[1:] != keys[:-1]][: len(keys)]
            first = np.flatnonzero(new)
            one = (own >> (7 - bit)) & 1
            ones, both = (np.add.reduceat(x, first) if len(first) else x for x in (many * one, many))
            levels[d] = Level(keys[first], both - ones, ones, None if node is None else node[up[d][first]])
            node = np.cumsum(new) - 1
        for d in range(depth, 1, -1):
            levels[d].weigh(levels.get(d + 1))
        for d in range(2, depth + 1):
            levels[d].settle(levels.get(d - 1))
        yield levels[2], (levels[depth].sure + 0.5 * levels[depth].left)[node]


def _grouped(counts: DataFrame, groups: int):
    """Codes in groups that hold all codes with the same last two bytes of context."""
    last_two = F.shiftright(F.col("code"), 8).bitwiseAND(F.lit(0xFFFF))
    return counts.select("code", "n", F.pmod(F.xxhash64(last_two), F.lit(groups)).alias("part")).groupBy("part")


def _in_order(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    codes, n = table.column("code").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(codes)
    return codes[order], n[order]


def _two_byte_sums(counts: DataFrame, groups: int, depth: int) -> DataFrame:
    """Decisions of depth 2 added up for depth 1: ``key``, ``zeros``, ``ones``, ``log_weighted``; at most 256 x 255 rows."""

    def run(table: pa.Table) -> pa.Table:
        found = []
        for bit, (two, _) in enumerate(mix_subtree(*_in_order(table), depth)):
            # The last byte of the context, then the node: a leading one and the bits so far.
            keys = ((two.keys >> bit) & 0xFF) << 8 | 1 << bit | two.keys & ((1 << bit) - 1)
            known, index = np.unique(keys, return_inverse=True)
            found.append((known, *(np.bincount(index, x, len(known)) for x in (two.zeros, two.ones, two.log_weighted))))
        return pa.table(dict(zip(("key", "zeros", "ones", "log_weighted"), map(np.concatenate, zip(*found)))))

    found = _grouped(counts.filter("n > 0"), groups).applyInArrow(run, "key bigint, zeros double, ones double, log_weighted double")
    return found.groupBy("key").agg(F.sum("zeros"), F.sum("ones"), F.sum("log_weighted"))


class Top:
    """Depths 0 and 1, at most 256 x 255 decisions."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, product: np.ndarray):
        order = np.argsort(keys)
        keys = keys[order]
        node, index = np.unique(keys & 0xFF, return_inverse=True)
        one = Level(keys, zeros[order].astype(np.int64), ones[order].astype(np.int64), index).weigh(None, product[order])
        root = Level(node, *(np.bincount(index, x, len(node)).astype(np.int64) for x in (one.zeros, one.ones)))
        root.weigh(one).settle(None)
        one.settle(root)
        self.sure, self.left = np.full(65536, np.nan), np.zeros(65536)
        self.sure[one.keys], self.left[one.keys] = one.sure, one.left
        self.root = np.full(256, 0.5)
        self.root[root.keys] = root.sure + 0.5 * root.left


def log_probabilities(codes: np.ndarray, n: np.ndarray, depth: int, top: Top) -> np.ndarray:
    """Log10 of the probability of the byte of every code."""
    byte = codes & 0xFF
    total = np.zeros(len(codes))
    for bit, (_, deeper) in enumerate(mix_subtree(codes, n, depth)):
        node = (1 << bit) | (byte >> (8 - bit))
        short = (((codes >> 8) & 0xFF) << 8) | node
        one = np.where(np.isnan(top.sure[short]), top.root[node], top.sure[short] + top.left[short] * deeper)
        total += np.log10(np.where((byte >> (7 - bit)) & 1 == 1, one, 1 - one))
    return total


def score_codes(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``code`` and ``score``, the log10 probability of its byte, of every row of ``counts`` (``code``, ``n``), one a code.

    ``n`` is how often the code was seen in training, zero for one that is only to be scored.
    """
    groups = max(16, -(-8 * counts.count() // BLOCK_DECISIONS))
    columns = np.array([tuple(r) for r in _two_byte_sums(counts, groups, depth).collect()], float).reshape(-1, 4)
    shared = counts.sparkSession.sparkContext.broadcast(Top(columns[:, 0].astype(np.int64), *columns[:, 1:].T))

    def run(table: pa.Table) -> pa.Table:
        codes, n = _in_order(table)
        return pa.table({"code": codes, "score": log_probabilities(codes, n, depth, shared.value)})

    return _grouped(counts, groups).applyInArrow(run, "code bigint, score double")


# --- bins -----------------------------------------------------------------------------------

def _bin_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Stretches of rows of one bin; a bin may come in several."""
    for batch in batches:
        bins = batch.column("bin").to_numpy()
        cuts = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1], True]) if len(bins) else ()
        for low, high in zip(cuts[:-1], cuts[1:]):
            yield int(bins[low]), batch.slice(low, high - low)


def _sum_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes of whole bins added up; rows come in the order of their bins."""
    def rows(sums: Sums) -> Iterator[pa.RecordBatch]:
        codes, n = sums.total()
        for low in range(0, len(codes), CODE_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(x[low : low + CODE_ROWS]) for x in (codes, n)], ["code", "n"])

    at, sums = -1, Sums()
    for number, some in _bin_runs(batches):
        if number != at:
            yield from rows(sums)
            at, sums = number, Sums()
        for codes, seen in zip(some.column("codes"), some.column("seen")):
            sums.add(unpacked_codes(codes.as_py()), unpacked(seen.as_py(), np.int32))
    yield from rows(sums)


def _answer_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores of the codes of every split; the scored codes of a bin come before the splits', in order."""
    at, known, values = -1, [], []
    for number, some in _bin_runs(batches):
        if number != at:
            at, known, values = number, [], []
        scored = some.column("part").null_count
        if scored:
            known.append(some.column("code").slice(0, scored).to_numpy())
            values.append(some.column("score").slice(0, scored).to_numpy())
        if scored == some.num_rows:
            continue
        known, values = [np.concatenate(known)], [np.concatenate(values)]
        asked = some.slice(scored)
        found = [packed(values[0][np.searchsorted(known[0], unpacked_codes(codes))]) for codes in asked.column("codes").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [asked.column("part"), asked.column("codes"), pa.array(found, pa.binary())], ["part", "codes", "scores"])


# --- documents ------------------------------------------------------------------------------

def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", held: str = "held_out", depth: int = DEPTH,
                across: bool = False) -> DataFrame:
    """``key``, ``held_out``, ``n_bytes``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``bits_per_byte``.

    ``held`` names a boolean column: documents marked there (not null, true) teach nothing.
    Scores are log10 probabilities: ``base_score`` by smoothed token counts, ``score`` by
    context-tree weighting.  A null or empty text is the end token alone.  Repeated rows
    teach and are scored each.  Without training documents every bit has probability a half.
    Contexts go ``across`` tokens if wanted; else each begins anew, and the order of words does
    not matter.  ``bits_per_byte`` is the code length over the text's bytes, null for an empty text.
    """
    marked = docs.withColumn(held, F.coalesce(F.col(held), F.lit(False)))
    rows = materialize(encode(marked, key, text, held, depth, across), "tokens")
    entries = rows.filter("word IS NOT NULL").select("split", "local", "word", "trained")
    codes = rows.filter("codes IS NOT NULL").select(F.col("split").alias("part"), "bin", "codes", "seen")
    vocabulary = materialize(entries.groupBy("word").agg(F.sum("trained").alias("trained")), "words")
    n, v = vocabulary.agg(F.coalesce(F.sum("trained"), F.lit(0)), F.count(F.when(F.col("trained") > 0, 1))).first()
    counts = materialize(
        by_task(codes.select("bin", "codes", "seen"), "bin").sortWithinPartitions("bin").mapInArrow(_sum_bins, "code bigint, n bigint"), "contexts")
    scored = materialize(score_codes(counts, depth), "code-scores")
    discard(counts)
    asked = scored.select(
        F.pmod("code", F.lit(BINS)).cast("int").alias("bin"), F.lit(None).cast("bigint").alias("part"), "code",
        F.col("score").cast("float").alias("score"), F.lit(None).cast("binary").alias("codes"),
    ).union(codes.select("bin", "part", F.lit(None).cast("bigint"), F.lit(None).cast("float"), "codes"))
    answered = by_task(asked, "bin").sortWithinPartitions("bin", F.col("part").asc_nulls_first(), "code").mapInArrow(
        _answer_bins, "part bigint, codes binary, scores binary")
    nothing = F.lit(None)
    returned = materialize(entries.select("split", "local", "word").join(vocabulary, "word").select(
        F.col("split").alias("part"), "local", "word", "trained", nothing.cast("binary").alias("codes"), nothing.cast("binary").alias("scores"),
    ).union(answered.select(
        "part", nothing.cast("int").alias("local"), nothing.cast("string").alias("word"),
        nothing.cast("bigint").alias("trained"), "codes", "scores")), "entry-scores")
    discard(scored)
    discard(vocabulary)

    def run(documents: pa.Table, entries: pa.Table) -> pa.Table:
        owned = entries.filter(pc.is_valid(entries["word"])).sort_by("local")
        trained = owned.column("trained").to_numpy()
        words = owned.column("word").cast(pa.binary()).to_pylist()
        binned = entries.filter(pc.is_valid(entries["codes"]))
        known = np.concatenate([unpacked_codes(x) for x in binned["codes"].to_pylist()])
        values = np.concatenate([unpacked(x, np.float32) for x in binned["scores"].to_pylist()])
        order = np.argsort(known)
        known, values = known[order], values[order].astype(float)
        ids = [unpacked(x, np.int32) for x in documents.column("ids").to_pylist()]
        flat, counts = np.concatenate(ids), np.array([len(x) for x in ids])
        of_token = np.repeat(np.arange(len(counts)), counts)
        base, seen = (np.bincount(of_token, v[flat], len(counts)) + v[0] for v in (
            np.log10((trained + 0.5) / (n + 0.5 * (v + 1))), (trained > 0).astype(float)))
        score = np.zeros(len(counts))
        for texts, sizes, codes in coded(words, flat, counts, depth, across):
            different, index = np.unique(codes, return_inverse=True)
            score[texts] = np.add.reduceat(values[np.searchsorted(known, different)][index], np.cumsum(sizes) - sizes)
        size = documents.column("size").to_numpy()
        bits = -score / math.log10(2) / np.maximum(size, 1)
        return pa.table({
            "_key": documents.column("_key"), "held_out": documents.column("held"), "n_bytes": size,
            "n_tokens": pa.array(counts.astype(np.int64) + 1), "n_known": pa.array(seen.astype(np.int64)),
            "train_tokens": pa.array(np.full(len(counts), n, np.int64)), "base_score": base, "score": score,
            "bits_per_byte": pa.array(bits, mask=size == 0),
        })

    documents = rows.filter("ids IS NOT NULL").select("split", "_key", "held", "size", "ids")
    result = documents.groupBy("split").cogroup(returned.groupBy("part")).applyInArrow(
        run, "_key bigint, held_out boolean, n_bytes bigint, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double, bits_per_byte double")
    return result.withColumnRenamed("_key", key)
