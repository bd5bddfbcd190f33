"""Words, hashes and base measures against plain Python."""

from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import blocks, measures

from .conftest import lowered, spaced_words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbÉé \t\n\x0b#|.1", max_size=60)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_are_those_of_the_pattern(texts, limit):
    found = []
    for block in blocks.text_blocks(pa.array(texts, pa.string()), limit):
        words = blocks.find_words(block, blocks.SPACED)
        raw = words.data.tobytes()
        for a, b in zip(words.cuts[:-1], words.cuts[1:]):
            found.append([raw[s:e].decode() for s, e in zip(words.starts[a:b], words.ends[a:b])])
    assert found == [spaced_words(lowered(t)) for t in texts]


def test_equal_stretches_have_equal_hashes():
    data = np.frombuffer(b"abcabcabd" * 50, np.uint8)
    rolling = blocks.RollingHash(data)
    starts = np.arange(len(data) - 5)
    hashes = rolling.of(starts, starts + 5)
    strings = [data[s : s + 5].tobytes() for s in starts]
    assert len(set(hashes.tolist())) == len(set(strings))
    assert all((hashes[i] == hashes[j]) == (strings[i] == strings[j]) for i in range(0, 90, 7) for j in range(90))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab c\n#", max_size=80), min_size=1, max_size=6))
def test_base_measures(texts):
    (block,) = blocks.text_blocks(pa.array(texts, pa.string()))
    found = measures.base_measures(block, measures.spaced_words(block))
    for i, text in enumerate(texts):
        words = spaced_words(text)
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        many = Counter(windows)
        repeated = {k + j for k, w in enumerate(windows) if many[w] > 1 for j in range(3)}
        lines = [line for line in text.split("\n") if spaced_words(line)]
        assert [int(found[n][i]) for n in found] == [
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)]
