"""The Jaccard join against brute force, and on odd rows."""

import random

import pytest

from ledgerloom.llm import jaccard, queries

from .conftest import lowered, spaced_words
from .test_duplicates import components_of


def shingles(text, size=5):
    words = spaced_words(lowered(text))
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))} if words else set()


def brute_join(rows, size=5, percent=80):
    sets = [shingles(text, size) for _, text in rows]
    at = [i for i, (key, _) in enumerate(rows) if sets[i] and key is not None]
    holders = {}
    for i in at:
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    seen, links = set(), []
    for group in holders.values():
        for x, i in enumerate(group):
            for j in group[:x]:
                if (i, j) not in seen:
                    seen.add((i, j))
                    both = len(sets[i] & sets[j])
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        links.append((i, j))
    root = components_of(len(rows), links)
    least = {}
    for i in at:
        least[root[i]] = min(least.get(root[i], rows[i][0]), rows[i][0])
    equal = {frozenset(sets[i]): least[root[i]] for i in at}
    return sorted(
        ((key, len(s), key if not s else equal.get(frozenset(s))) for (key, _), s in zip(rows, sets)), key=str)


def found_rows(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_texts(seed, n=250, words=60):
    """Chains of texts, each a few words off another one, around some bases that share a passage."""
    source = random.Random(seed)
    passage = [f"p{i}" for i in range(12)]
    texts = []
    for i in range(n):
        if i < 8 or source.random() < 0.1:
            text = [f"w{source.randrange(400)}" for _ in range(source.randrange(3, words))]
            if source.random() < 0.6:
                text[2:2] = passage
        else:
            text = list(source.choice(texts))
            for _ in range(source.randrange(3)):
                text[source.randrange(len(text))] = f"w{source.randrange(400)}"
            text += [f"e{source.randrange(9)}"] * source.randrange(2)
        texts.append(text)
    return [(1000 - i, " ".join(t)) for i, t in enumerate(texts)]


def as_docs(ready, rows):
    return ready.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_query_equals_brute_force(ready, sf, texts):
    assert found_rows(queries.QUERIES["op12_jaccard_join"](ready, sf)) == brute_join(list(texts.items()))


@pytest.mark.parametrize("seed", range(2))
def test_chains_of_near_copies(ready, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "OFFERS", (1, 2, None))  # all rounds have something to do
    rows = near_texts(seed)
    found = found_rows(jaccard.near_groups(as_docs(ready, rows)))
    assert found == brute_join(rows)
    assert len({r[2] for r in found}) < 0.8 * len(rows)


@pytest.mark.parametrize("percent", [55, 90])
def test_other_similarities_and_sizes(ready, percent):
    rows = near_texts(7, 150)
    assert found_rows(jaccard.near_groups(as_docs(ready, rows), size=2, percent=percent)) == brute_join(rows, 2, percent)


def test_large_lists_are_cut(ready, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rows = near_texts(11, 200, 30)
    whole = jaccard.linked_components

    def cut(sets, percent):
        return whole(sets, percent, chunk=5)

    monkeypatch.setattr(jaccard, "linked_components", cut)
    assert found_rows(jaccard.near_groups(as_docs(ready, rows))) == brute_join(rows)


def test_many_sets_beyond_a_broadcast(ready, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    rows = near_texts(5, 120) + [(7, "again " * 3), (7, "other words under one key here"), (7, "again " * 3)]
    assert found_rows(jaccard.near_groups(as_docs(ready, rows))) == brute_join(rows)


def test_join_of_odd_rows(odd_docs, odd_rows, no_docs):
    assert found_rows(jaccard.near_groups(odd_docs)) == brute_join(odd_rows)
    assert jaccard.near_groups(no_docs).count() == 0


def test_null_keys_and_ties(ready):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (None, "one two three four five six"), (9, text + " more"), (4, text), (9, text + " more"), (5, "one two"), (6, "ONE\ttwo"), (8, "two one")]
    assert found_rows(jaccard.near_groups(as_docs(ready, rows))) == brute_join(rows)
