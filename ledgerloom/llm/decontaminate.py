"""Benchmark passages in documents: a prefix-filtered join of word windows.

A window is a run of ten words of an item (all words of a shorter item).  A document can
contain a window only where it has all of its words, so one word is the whole prefix: the
window's rarest, by counts over all documents.  Each occurrence of that word names the one
place where the window could stand; places that the document's length or ends rule out are
dropped, the rest is verified word by word, first by hash and then by bytes.

The benchmark goes through in blocks of items.  A block's size is bounded in bytes, so its
index can be sent to every task whatever the size of the benchmark; each block is one more
step over the documents, which are not shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_code
from .blocks import LETTERS, Block, find_words, text_blocks
from .rows import per_text_columns

WINDOW = 10
#: Most bytes of item texts in one block; one longer item is a block by itself.
BLOCK_BYTES = 8 << 20
#: Candidate places held at once in a task.
_STRETCH = 1 << 20
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _column(texts: list[str | None]) -> list[tuple[Block, object]]:
    return [(block, find_words(block, LETTERS)) for block in text_blocks(pa.array(texts, pa.large_string()))]


class Index:
    """Windows of a block of items, under the hash of their rarest word."""

    def __init__(self, items: list[tuple[str, str | None]], size: int = WINDOW):
        self.size = size
        self.item_ids = [str(name) for name, _ in items]
        owners: dict[tuple[bytes, ...], list[int]] = defaultdict(list)
        hashed: dict[bytes, int] = {}
        number = 0
        for block, words in _column([text for _, text in items]):
            raw = words.data.tobytes()
            found = [raw[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist())]
            hashed.update(zip(found, words.hashes.tolist()))
            for a, b in zip(words.cuts[:-1].tolist(), words.cuts[1:].tolist()):
                for start in range(a, max(b - size + 1, min(a + 1, b))):
                    group = owners[tuple(found[start : min(start + size, b)])]
                    if not group or group[-1] != number:
                        group.append(number)
                number += 1
        self.windows = list(owners)
        self.owners = list(owners.values())
        self.words = hashed

    def vocabulary(self) -> np.ndarray:
        return np.unique(np.fromiter(self.words.values(), np.uint64, len(self.words)))

    def order(self, counts: dict[int, int]) -> Index:
        """Choose every window's rarest word; equally rare ones by hash."""
        offsets, tokens = [], []
        self.hashes = np.zeros((len(self.windows), self.size), np.uint64)
        self.lengths = np.array([len(w) for w in self.windows], np.int64)
        for row, window in enumerate(self.windows):
            codes = [self.words[word] for word in window]
            self.hashes[row, : len(codes)] = codes
            rarest = min(range(len(codes)), key=lambda k: (counts.get(codes[k], 0), codes[k]))
            offsets.append(rarest)
            tokens.append(codes[rarest])
        token = np.array(tokens, np.uint64)
        self.by_token = np.argsort(token, kind="stable")
        self.offsets = np.array(offsets, np.int64)
        self.tokens, first = np.unique(token[self.by_token], return_index=True)
        self.cuts = np.r_[first, len(token)].astype(np.int64)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.tokens >> np.uint64(48)] = True
        return self

    def _candidates(self, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of prefix words and the windows they may belong to, a stretch at a time."""
        place = np.flatnonzero(self.maybe[hashes >> np.uint64(48)])
        if not len(place) or not len(self.tokens):
            return
        at = np.minimum(np.searchsorted(self.tokens, hashes[place]), len(self.tokens) - 1)
        same = self.tokens[at] == hashes[place]
        place, at = place[same], at[same]
        many = self.cuts[at + 1] - self.cuts[at]
        total = np.cumsum(many)
        low = 0
        while low < len(place):
            high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + _STRETCH, "right")))
            some = many[low:high]
            inner = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
            yield np.repeat(place[low:high], some), self.by_token[np.repeat(self.cuts[at[low:high]], some) + inner]
            low = high

    def find(self, block: Block) -> tuple[np.ndarray, list[list[dict[str, int]]], list[set[int]]]:
        """Per text: number of words, spans of hit words in order, items."""
        words = find_words(block, LETTERS)
        spans: list[list[dict[str, int]]] = [[] for _ in range(block.n)]
        items: list[set[int]] = [set() for _ in range(block.n)]
        n = len(words.starts)
        text_of = words.text_of
        hits: list[tuple[np.ndarray, np.ndarray]] = []
        for place, window in self._candidates(words.hashes):
            start = place - self.offsets[window]
            end = start + self.lengths[window]
            text = text_of[place]
            fits = (start >= words.cuts[text]) & (end <= words.cuts[text + 1])
            start, window = start[fits], window[fits]
            for k in range(self.size):
                if not len(start):
                    break
                at = np.minimum(start + k, n - 1)
                same = (k >= self.lengths[window]) | (words.hashes[at] == self.hashes[window, k])
                start, window = start[same], window[same]
            if len(start):
                hits.append((start, window))
        if hits:
            start = np.concatenate([a for a, _ in hits])
            window = np.concatenate([b for _, b in hits])
            order = np.argsort(start, kind="stable")
            for first, row in zip(start[order].tolist(), window[order].tolist()):
                last = first + len(self.windows[row])
                if any(words.data[a:b].tobytes() != word for a, b, word in zip(
                        words.starts[first:last].tolist(), words.ends[first:last].tolist(), self.windows[row])):
                    continue
                text = int(text_of[first])
                low = first - int(words.cuts[text])
                span = spans[text]
                if span and span[-1]["end"] >= low:
                    span[-1]["end"] = max(span[-1]["end"], low + last - first)
                else:
                    span.append({"start": low, "end": low + last - first})
                items[text].update(self.owners[row])
        return np.diff(words.cuts), spans, items


def word_counts(docs: DataFrame, text: str, vocabulary: np.ndarray) -> dict[int, int]:
    """Occurrences over all documents of the given word hashes."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # words of one block of items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        total = np.zeros(len(known), np.int64)
        maybe = np.zeros(1 << 16, bool)
        maybe[known >> np.uint64(48)] = True
        for batch in batches:
            for block in text_blocks(batch.column(0)):
                hashes = find_words(block, LETTERS).hashes
                hashes = hashes[maybe[hashes >> np.uint64(48)]]
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                total += np.bincount(at[known[at] == hashes], minlength=len(known))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(known[seen].view(np.int64)), pa.array(total[seen])], ["word", "n"])

    if not len(vocabulary):
        return {}
    sums = docs.select(text).mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n"))
    return {word % (1 << 64): n for word, n in sums.collect()}  # at most the words of the block


def item_blocks(benchmark: DataFrame, key: str, text: str, limit: int) -> Iterator[list[tuple[str, str | None]]]:
    """Items in order of their ids, in blocks of bounded size; rows come one partition at a time."""
    block, size = [], 0
    rows = benchmark.select(F.col(key).cast("string"), F.col(text).cast("string"))
    for name, content in rows.dropna(subset=[rows.columns[0]]).toLocalIterator():
        block.append((name, content))
        size += len(content or "")
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Columns of ``docs`` with ``leak_words``, ``leak_spans`` and ``leak_items``.

    ``leak_words`` is the number of words, ``leak_spans`` the hit words as spans (from several
    blocks of items they may overlap), ``leak_items`` the ids of items with windows in the
    text, sorted as strings.  Null and empty texts have no words, on either side; an item
    without words has no window; items without an id are left out.  Items repeated under one
    id are one item.  Columns of ``docs`` with these names are replaced.
    """
    ship_code(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    found = docs.drop("leak_words", "leak_spans", "leak_items").withColumn(text, F.col(text).cast("string"))
    plain = found.select(text)
    carried = list(found.columns)
    first = True
    for items in [*item_blocks(benchmark, item_key, item_text, block_bytes)] or [[]]:
        index = Index(items, window)
        shared = context.broadcast(index.order(word_counts(plain, text, index.vocabulary())))

        def look(block: Block, shared=shared) -> list[pa.Array]:
            index = shared.value
            n, spans, items = index.find(block)
            names = [sorted({index.item_ids[i] for i in some}) for some in items]
            return [pa.array(n), pa.array(spans, _SPANS), pa.array(names, pa.list_(pa.string()))]

        fields = "leak_words bigint, new_spans array<struct<start:int,end:int>>, new_items array<string>"
        found = per_text_columns(found, text, fields, look, carried)
        if first:
            found = found.withColumnsRenamed({"new_spans": "leak_spans", "new_items": "leak_items"})
            carried += ["leak_spans", "leak_items"]
            first = False
        else:
            found = found.withColumn("leak_spans", F.concat("leak_spans", "new_spans")).withColumn(
                "leak_items", F.array_sort(F.array_union("leak_items", "new_items"))).drop("new_spans", "new_items")
    return found


def hit_words(spans: str = "leak_spans"):
    """How many words the spans cover; spans of several blocks of items may overlap."""
    return F.aggregate(
        F.array_sort(spans), F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda s, p: F.struct(
            F.greatest(s["end"], p["end"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0), p["end"] - F.greatest(s["end"], p["start"]))).alias("n")),
        lambda s: s["n"])


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs`` in which no window of the benchmark occurs."""
    found = find_contamination(docs, benchmark, text)
    return found.filter(F.size("leak_spans") == 0).select(docs.columns)

