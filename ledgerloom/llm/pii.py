"""Personal data: plain patterns, and a semi-Markov conditional random field that adds to them.

The patterns give the base spans.  Around words with digits or an at-sign a window is cut
into tokens, and the field scores whole candidate segments of at most ``MAX_TOKENS`` tokens:
digit groups, separators, check digits, what stands directly before and after.  Dynamic
programming over the window chooses boundaries and kinds together; base spans are given
segments there, so the field can only add.

The field is trained on a bounded sample of windows, labelled by the patterns.  So that it
learns what the data look like and not only how the patterns write them, sampled spans are
also written in other usual ways (without the plus, with other separators, in groups), and
those are labelled alike.  All documents are searched whole.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import ship_code
from .blocks import SPACED, Block, code_points, find_words, text_blocks
from .rows import per_text_columns

KINDS = ("email", "ip", "card", "phone")
#: Most windows of each kind, and of those without personal data, that the field is trained on,
#: and most of them whose span is written alike.
PER_KIND, PER_SHAPE = 64, 8
#: Bytes of the longest window that is trained on.
LONGEST = 160
MAX_TOKENS = 18
#: Words of context on each side of a window.
CONTEXT = 3
#: How much better than leaving it a segment must score.
MARGIN = 2.0
_EPOCHS = 12

Span = tuple[str, int, int]


def _table(chars: bytes, *ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    for low, high in ranges:
        out[low : high + 1] = True
    return out


_DIGITS, _LETTERS = (0x30, 0x39), ((0x41, 0x5A), (0x61, 0x7A))
_RUNS = {
    "email": (_table(b"._%+-@", _DIGITS, *_LETTERS), b"@"),
    "ip": (_table(b".", _DIGITS), b"."),
    "card": (_table(b" -", _DIGITS), b"0123456789"),
    "phone": (_table(b"+ ().-", _DIGITS), b"+"),
}
_DOMAIN = re.compile(rb"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = _table(b"._%+-", _DIGITS, *_LETTERS)
_CHAIN = re.compile(rb"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: bytes) -> bool:
    """Whether the last digit checks the others."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = digit - 0x30
        if place % 2:
            value = 2 * value - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _digits(raw: bytes) -> bytes:
    return bytes(b for b in raw if 0x30 <= b <= 0x39)


def _emails(run: bytes) -> Iterator[tuple[int, int]]:
    """A pass over the at-signs; the local part reaches back to the last match."""
    last = 0
    for m in _DOMAIN.finditer(run):
        start = m.start()
        while start > last and _LOCAL[run[start - 1]]:
            start -= 1
        if start < m.start():
            yield start, m.end()
            last = m.end()


def _addresses(run: bytes) -> Iterator[tuple[int, int]]:
    for m in _CHAIN.finditer(run):
        groups = m.group().split(b".")
        at = m.start()
        for k in range(0, len(groups) - 3, 4):
            four = groups[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(g.lstrip(b"0")) <= 3 and int(g) <= 255 for g in four):
                yield at, end
            at = end + 1


def _cards(run: bytes) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(run):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(run: bytes) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(run):
        if 9 <= len(_digits(m.group())) <= 15:
            yield m.span()


_FIND = {"email": _emails, "ip": _addresses, "card": _cards, "phone": _phones}


def base_spans(block: Block) -> list[list[Span]]:
    """Per text the pattern matches, in byte places of the text.

    A match lies within one run of the characters its kind allows, so only runs that hold
    the kind's telling character are looked at.
    """
    found: list[list[Span]] = [[] for _ in range(block.n)]
    for kind, (allowed, telling) in _RUNS.items():
        marks = np.zeros(len(block.data) + 1, np.int64)
        np.cumsum(_table(telling)[block.data], out=marks[1:])
        if not marks[-1]:
            continue
        runs = find_words(block, allowed, lower=False)
        some = marks[runs.ends] - marks[runs.starts] >= (3 if kind == "ip" else 13 if kind == "card" else 1)
        for text, a, b in zip(runs.text_of[some].tolist(), runs.starts[some].tolist(), runs.ends[some].tolist()):
            low = a - int(block.bounds[text])
            found[text] += [(kind, low + s, low + e) for s, e in _FIND[kind](block.data[a:b].tobytes())]
    return found


_MARKED = _table(b"@", _DIGITS)


def windows(block: Block) -> list[list[tuple[int, int]]]:
    """Per text the byte limits of stretches of marked words with their context."""
    found: list[list[tuple[int, int]]] = [[] for _ in range(block.n)]
    marks = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum(_MARKED[block.data], out=marks[1:])
    if not marks[-1]:
        return found
    words = find_words(block, SPACED, lower=False)
    at = np.flatnonzero(marks[words.ends] > marks[words.starts])
    text_of = words.text_of
    if not len(at):
        return found
    apart = np.r_[True, (at[1:] - at[:-1] > CONTEXT) | (text_of[at[1:]] != text_of[at[:-1]])]
    first, last = at[apart], at[np.r_[apart[1:], True]]
    first = np.maximum(first - CONTEXT, words.cuts[text_of[first]])
    last = np.minimum(last + CONTEXT, words.cuts[text_of[last] + 1] - 1)
    for a, b in zip(first.tolist(), last.tolist()):
        text = int(text_of[a])
        low = int(block.bounds[text])
        found[text].append((int(words.starts[a]) - low, int(words.ends[b]) - low))
    return found


_TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|\s+|.", re.DOTALL)
_CUES = {word: kind for kind, words in {
    "phone": "tel phone call fax mobile cell", "email": "mail email contact", "card": "card visa credit",
    "ip": "ip host server address"}.items() for word in words.split()}


class Window:
    """Tokens of a stretch of text and the segments that may be personal data."""

    def __init__(self, raw: bytes, given: list[Span] = ()):
        self.raw = raw
        self.limits = [m.span() for m in _TOKEN.finditer(raw)]
        self.n = len(self.limits)
        starts = {a: i for i, (a, _) in enumerate(self.limits)}
        ends = {b: i + 1 for i, (_, b) in enumerate(self.limits)}
        #: Base spans cut at token limits; a base span that starts within a token covers the whole token.
        self.given = []
        covered = [False] * (self.n + 1)
        for kind, a, b in given:
            i = starts.get(a, next((k for k, (x, y) in enumerate(self.limits) if x <= a < y), 0))
            j = ends.get(b, next((k + 1 for k, (x, y) in enumerate(self.limits) if x < b <= y), self.n))
            self.given.append((kind, i, j))
            covered[i:j] = [True] * (j - i)
        self.covered = covered
        self.kinds = [self._kind(i) for i in range(self.n)]

    def _kind(self, i: int) -> str:
        c = self.raw[self.limits[i][0]]
        if 0x30 <= c <= 0x39:
            return "9"
        if c >= 0x80 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A:
            return "a"
        return " " if chr(c).isspace() else chr(c)

    def candidates(self) -> Iterator[tuple[int, int]]:
        """Segments free of base spans that could be an address or a number of some length."""
        for i in range(self.n):
            if self.kinds[i] not in ("9", "a", "+", "("):
                continue
            digits, sign, letters = 0, False, 0
            for j in range(i, min(self.n, i + MAX_TOKENS)):
                kind = self.kinds[j]
                if self.covered[j] or (kind not in " 9a" and kind not in "@.+-()_%"):
                    break
                digits += (self.limits[j][1] - self.limits[j][0]) * (kind == "9")
                sign |= kind == "@"
                letters += kind == "a"
                if kind == " " and (letters or sign):
                    break  # names and addresses hold no space
                if kind in "9a" and (digits >= 7 and not letters or sign and kind == "a" and j > i + 1):
                    yield i, j + 1

    def features(self, i: int, j: int) -> list[str]:
        a, b = self.limits[i][0], self.limits[j - 1][1]
        raw = self.raw[a:b]
        groups = [len(g) for g in re.findall(rb"[0-9]+", raw)]
        digits = _digits(raw)
        separators = "".join(sorted({k for k in self.kinds[i:j] if k not in "9a"}))
        size = len(digits)
        out = [
            "digits" + str(size if size < 20 else 20), "groups" + "-".join(map(str, groups[:6])),
            "separators" + separators, "first" + self.kinds[i], "last" + self.kinds[j - 1],
            "letters" + str("a" in self.kinds[i:j]),
        ]
        if 13 <= size <= 19:
            out.append("check" + str(luhn(digits)))
        if raw.count(b"@"):
            domain = raw.rpartition(b"@")[2]
            out.append(f"at{min(raw.count(b'@'), 2)}dot{b'.' in domain}")
        parts = raw.split(b".")
        if len(parts) == 4 and separators == ".":
            out.append("quad" + str(all(p.isdigit() and len(p) < 4 and int(p) <= 255 for p in parts)))
        # What stands around counts only where it is telling, so the usual surroundings of the
        # sample take no weight from what the span itself looks like.
        before, after = self.kinds[i - 1] if i else " ", self.kinds[j] if j < self.n else " "
        if before in "9a@" or after in "9a@" or after != " " and j + 1 < self.n and self.kinds[j + 1] in "9a":
            out.append("glued")
        word = next((self.raw[x:y].decode("utf-8", "replace").lower() for x, y in reversed(self.limits[max(0, i - 3) : i])
                     if self.raw[x:y].isalpha()), "")
        if word in _CUES:
            out.append("cue " + _CUES[word])
        return out


def _lattice(window: Window) -> list[tuple[int, int, list[str]]]:
    return [(i, j, window.features(i, j)) for i, j in window.candidates()]


class Field:
    """Weights of (kind, feature) for segments and of token classes left outside."""

    def __init__(self, weights: dict[str, float] | None = None):
        self.weights: dict[str, float] = defaultdict(float, weights or {})

    def _outside(self, window: Window, i: int) -> str:
        return "out" + (window.kinds[i] if window.kinds[i] in "9a @" else ".")

    def _score(self, kind: str, features: list[str]) -> float:
        w = self.weights
        return sum(w.get(kind + f, 0.0) for f in features) + w.get(kind, 0.0)

    def best(self, window: Window, margin: float = MARGIN) -> list[tuple[str, int, int]]:
        """The segments of the best labelling, base spans being fixed."""
        ending = defaultdict(list)
        for i, j, features in _lattice(window):
            for kind in KINDS:
                ending[j].append((i, kind, self._score(kind, features) - margin))
        top, back = [0.0], [(0, "")]
        for j in range(1, window.n + 1):
            choice = (top[j - 1] + self.weights.get(self._outside(window, j - 1), 0.0), (j - 1, ""))
            for i, kind, score in ending[j]:
                choice = max(choice, (top[i] + score, (i, kind)))
            top.append(choice[0])
            back.append(choice[1])
        found, j = [], window.n
        while j:
            i, kind = back[j]
            if kind:
                found.append((kind, i, j))
            j = i
        return found[::-1]

    def train(self, labelled: list[tuple[Window, list[tuple[str, int, int]]]], rate: float = 0.5) -> Field:
        """Likelihood of the labelled segmentations, by forward and backward sums and AdaGrad steps."""
        squares: dict[str, float] = defaultdict(float)
        ready = [(w, _lattice(w), set(gold)) for w, gold in labelled]
        for _ in range(_EPOCHS):
            for window, lattice, gold in ready:
                slope = self._slope(window, lattice, gold)
                for name, value in slope.items():
                    value -= 1e-3 * self.weights[name]
                    squares[name] += value * value
                    if squares[name]:
                        self.weights[name] += rate * value / math.sqrt(squares[name])
        return self

    def _slope(self, window: Window, lattice: list, gold: set) -> dict[str, float]:
        n = window.n
        outside = [self.weights.get(self._outside(window, i), 0.0) for i in range(n)]
        scored = [(i, j, kind, features, self._score(kind, features)) for i, j, features in lattice for kind in KINDS]
        into, from_ = defaultdict(list), defaultdict(list)
        for edge in scored:
            into[edge[1]].append(edge)
            from_[edge[0]].append(edge)
        ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            ahead[j] = _log_sum([ahead[j - 1] + outside[j - 1], *(ahead[e[0]] + e[4] for e in into[j])])
        for i in range(n - 1, -1, -1):
            behind[i] = _log_sum([behind[i + 1] + outside[i], *(behind[e[1]] + e[4] for e in from_[i])])
        total = ahead[n]
        slope: dict[str, float] = defaultdict(float)
        inside = [False] * n
        for kind, a, b in gold:
            inside[a:b] = [True] * (b - a)
        for i in range(n):
            p = math.exp(min(0.0, ahead[i] + outside[i] + behind[i + 1] - total))
            slope[self._outside(window, i)] += (not inside[i]) - p
        for i, j, kind, features, score in scored:
            p = math.exp(min(0.0, ahead[i] + score + behind[j] - total))
            value = ((kind, i, j) in gold) - p
            if abs(value) > 1e-6:
                slope[kind] += value
                for f in features:
                    slope[kind + f] += value
        return slope


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def other_writings(kind: str, raw: bytes) -> list[bytes]:
    """A found span as others would write it."""
    digits = _digits(raw).decode()
    if kind == "phone" and len(digits) >= 10:
        area, first, rest = digits[-10:-7], digits[-7:-4], digits[-4:]
        return [f"({area}) {first}-{rest}".encode(), f"{area}-{first}-{rest}".encode(),
                f"{area}.{first}.{rest}".encode(), raw[1:] if raw[:1] == b"+" else raw]
    if kind == "card" and len(digits) == 16:
        fours = [digits[k : k + 4] for k in range(0, 16, 4)]
        return ["-".join(fours).encode(), " ".join(fours).encode(), ".".join(fours).encode()]
    return []


#: Numbers that are no personal data, for training.
OTHER_NUMBERS = (
    b"2024-01-02", b"on 02/01/2024 at", b"2023-11-30 10:20:30", b"10:20:30", b"1999.12.31", b"of 12,345,678 in",
    b"10000000", b"3.14159265", b"from 1990 to 2010", b"2021-06-05 07:08", b"4.0.1", b"1234567890123456789012",
)


def labelled_windows(samples: list[tuple[bytes, list[Span]]]) -> list[tuple[Window, list[tuple[str, int, int]]]]:
    """Training windows: as found, and once for every other way of writing a span.

    A window that the patterns find nothing in teaches what is no personal data, unless it
    holds something written like another way of a found span, which the patterns cannot tell.
    """
    out = [(Window(raw), []) for raw in OTHER_NUMBERS]
    alike = {_shape(other) for raw, spans in samples for kind, a, b in spans for other in other_writings(kind, raw[a:b])}
    for raw, spans in samples:
        if not spans and any(shape in _shape(raw) for shape in alike):
            continue
        versions = [(raw, spans)]
        for number, (kind, a, b) in enumerate(spans):
            for other in other_writings(kind, raw[a:b]):
                moved = [(k, x, y) if y <= a else (k, x + len(other) - (b - a), y + len(other) - (b - a))
                         for n, (k, x, y) in enumerate(spans) if n != number]
                versions.append((raw[:a] + other + raw[b:], [*moved, (kind, a, a + len(other))]))
        for text, marked in versions:
            window = Window(text)
            starts = {x: i for i, (x, _) in enumerate(window.limits)}
            ends = {y: i + 1 for i, (_, y) in enumerate(window.limits)}
            gold = [(k, starts[x], ends[y]) for k, x, y in marked if x in starts and y in ends]
            possible = set(window.candidates())
            out.append((window, [g for g in gold if g[1:] in possible]))
    return out


def _shape(raw: bytes) -> str:
    """How a stretch is written: digits as 9, runs of letters as a, other signs as they are."""
    return re.sub(r"[A-Za-z]+", "a", re.sub(rb"[0-9]", b"9", raw).decode("latin-1"))[:80]


def sample_windows(
    docs: DataFrame, text: str = "text", per_kind: int = PER_KIND, per_shape: int = PER_SHAPE
) -> list[tuple[bytes, list[Span]]]:
    """Windows with their base spans: of every kind, and of those without any, at most ``per_kind``.

    Of spans (or other numbers) that are written alike at most ``per_shape`` are taken, by a hash
    of the window's content, and the shapes that most windows have come first.  So neither a
    corpus full of plain numbers nor one writing or odd ones crowd out what is usual.
    """
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[tuple[bytes, str, str]] = set()
            for block in text_blocks(batch.column(0)):
                base = base_spans(block)
                for i, limits in enumerate(windows(block)):
                    low = int(block.bounds[i])
                    for a, b in limits:
                        if b - a > LONGEST:  # a long stretch teaches nothing more than a short one
                            continue
                        raw = block.data[low + a : low + b].tobytes()
                        within = {kind: (s - a, e - a) for kind, s, e in base[i] if a <= s and e <= b}
                        for kind, (s, e) in within.items():
                            found.add((raw, kind, _shape(raw[s:e])))
                        if not within:
                            found.add((raw, "", " ".join(sorted({_shape(w) for w in raw.split() if _MARKED[list(w)].any()}))[:80]))
            rows = sorted(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.binary()), *(pa.array([r[k] for r in rows], pa.string()) for k in (1, 2))],
                ["raw", "kind", "shape"])

    rows = docs.select(F.col(text).cast("string")).mapInArrow(run, "raw binary, kind string, shape string").distinct()
    order = F.xxhash64("raw")
    placed = rows.withColumn("place", F.row_number().over(W.partitionBy("kind", "shape").orderBy(order, "raw"))).filter(F.col("place") <= per_shape)
    usual = rows.groupBy("kind", "shape").agg(F.count(F.lit(1)).alias("windows"))
    # At most per_shape rows of a shape are left, of a number of shapes that ranks and is cut before it is shuffled.
    placed = placed.join(usual, ["kind", "shape"])
    first = W.partitionBy("kind").orderBy(F.desc("windows"), "shape", "place")
    chosen = placed.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= per_kind)
    out = []
    for row in chosen.select("raw").distinct().orderBy("raw").collect():  # at most per_kind of five kinds
        content = bytes(row["raw"])
        block = Block(0, np.frombuffer(content, np.uint8), np.array([0, len(content)]))
        out.append((content, base_spans(block)[0]))
    return out


def train_field(docs: DataFrame, text: str = "text", per_kind: int = PER_KIND, per_shape: int = PER_SHAPE) -> Field:
    return Field().train(labelled_windows(sample_windows(docs, text, per_kind, per_shape)))


def added_spans(field: Field, raw: bytes, base: list[Span], limits: list[tuple[int, int]]) -> list[Span]:
    """What the field adds to the base spans of a text."""
    out = []
    for a, b in limits:
        given = [(kind, max(s, a) - a, min(e, b) - a) for kind, s, e in base if s < b and e > a]
        window = Window(raw[a:b], given)
        for kind, i, j in field.best(window):
            out.append((kind, a + window.limits[i][0], a + window.limits[j - 1][1]))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def find_personal_data(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """Columns of ``docs`` with ``base_found`` and ``found``: spans as kind:start:end, comma-joined.

    Places are code points, the end is exclusive; spans are in the order of ``KINDS``, then of
    their starts.  ``base_found`` has the pattern matches only, ``found`` also what the field
    adds.  A null or empty text has no spans.  Repeated rows get the same result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dict(field.weights))  # weights of a bounded sample

    def look(block: Block) -> list[pa.Array]:
        model = Field(shared.value)
        points = code_points(block.data)
        base, limits = base_spans(block), windows(block)
        before, after = [], []
        for i in range(block.n):
            spans = base[i]
            more = list(spans)
            low, high = int(block.bounds[i]), int(block.bounds[i + 1])
            if limits[i]:
                more += added_spans(model, block.data[low:high].tobytes(), spans, limits[i])
            origin = points[low]

            def placed(some: list[Span], low: int = low, origin: int = origin) -> list[Span]:
                return [(k, int(points[low + a] - origin), int(points[low + b] - origin)) for k, a, b in some]

            before.append(joined(placed(spans)))
            after.append(joined(placed(more)))
        return [pa.array(before, pa.string()), pa.array(after, pa.string())]

    return per_text_columns(
        docs.withColumn(text, F.col(text).cast("string")), text, "base_found string, found string", look)

