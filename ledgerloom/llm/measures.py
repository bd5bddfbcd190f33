"""Plain measures of texts, block by block."""

from __future__ import annotations

import numpy as np

from .blocks import SPACED, Block, RollingHash, Words, code_points, find_words, mix, per_text, windows_hash

REPEAT_WINDOW = 3
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_LINE_END = 0x0A


def in_text(hashes: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Hashes that differ between texts of a block."""
    return mix(hashes + text_of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def repeated_words(words: Words, size: int = REPEAT_WINDOW) -> np.ndarray:
    """Which words lie in a window of ``size`` words that its text holds twice or more."""
    n = len(words.starts)
    marked = np.zeros(n + 1, np.int64)
    if n < size:
        return np.zeros(n, bool)
    text_of = words.text_of
    whole = np.flatnonzero(text_of[: n - size + 1] == text_of[size - 1 :])
    keys = in_text(windows_hash(words.hashes, size)[whole], text_of[whole])
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    at = whole[again]
    np.add.at(marked, at, 1)
    np.add.at(marked, at + size, -1)
    return np.cumsum(marked)[:n] > 0


def duplicate_lines(block: Block, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines that hold a word, and those of them equal to an earlier line."""
    ends_at = np.flatnonzero(block.data == _LINE_END)
    starts = np.unique(np.concatenate([block.bounds[:-1], ends_at + 1]))
    starts = starts[starts < len(block.data)]
    if not len(starts):
        return np.zeros(block.n, np.int64), np.zeros(block.n, np.int64)
    after = np.r_[starts[1:], len(block.data)]
    ends = after - (block.data[after - 1] == _LINE_END)
    some = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[some], ends[some]
    text_of = np.searchsorted(block.bounds, starts, "right") - 1
    lines = np.bincount(text_of, minlength=block.n)
    keys = in_text(RollingHash(block.data).of(starts, ends), text_of)
    _, first = np.unique(keys, return_index=True)
    return lines, lines - np.bincount(text_of[first], minlength=block.n)


def base_measures(block: Block, words: Words) -> dict[str, np.ndarray]:
    """Counts per text; words are those between spaces, with their letters as they are."""
    points = code_points(block.data)
    return {
        "n_words": np.diff(words.cuts),
        "word_chars": per_text(points[words.ends] - points[words.starts], words.cuts),
        "n_symbols": per_text(_SYMBOLS[block.data], block.bounds),
        "n_dup_lines": duplicate_lines(block, words)[1],
        "n_repeat_words": per_text(repeated_words(words), words.cuts),
    }


def spaced_words(block: Block, lower: bool = False) -> Words:
    return find_words(block, SPACED, lower=lower)
