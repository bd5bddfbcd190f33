"""Near copies by similarity of shingle sets: wide fingerprints, recall, and no link below the similarity."""

import random

import numpy as np
import pytest

import corpus_pipeline
from ledgerloom.llm import simhash

from .test_jaccard_join import as_docs, brute_join, near_texts


@pytest.mark.parametrize("words,radius", [(1, 3), (2, 30), (6, 74)])
def test_counters_tell_who_is_within_the_radius(words, radius):
    random_bits = np.random.default_rng(words)
    prints = random_bits.integers(0, 256, (300, 8 * words), np.uint8)
    for k in range(1, 300):  # near ones at many distances
        if k % 3:
            flips = random_bits.random((8 * words, 8)) < random_bits.random() * radius / (32 * words)
            prints[k] = prints[k - 1] ^ np.packbits(flips, axis=1)[:, 0]
    planes = simhash._wide_planes(prints)
    for lag in (1, 2, 7, 64, 65, 200):
        wanted = np.zeros(planes.shape[1] * 64, bool)
        wanted[: 300 - lag] = random_bits.random(300 - lag) < 0.9
        found = simhash.distances_at_lag(planes, lag, np.packbits(wanted, bitorder="little").view(np.uint64), radius)
        apart = np.unpackbits(prints[:-lag] ^ prints[lag:], axis=1).sum(axis=1)
        assert found.tolist() == np.flatnonzero((apart <= radius) & wanted[: 300 - lag]).tolist()


def test_links_join_what_is_near_nearest_first():
    source = np.random.default_rng(1)
    base = source.integers(0, 256, (5, 16), np.uint8)
    prints = np.concatenate([base[source.integers(0, 5, 200)] ^ np.packbits(source.random((200, 16, 8)) < 0.06, axis=2)[:, :, 0]])
    buckets = np.sort(source.integers(0, 3, 200))
    a, b = simhash.nearest_links(buckets, prints, 30)
    apart = np.unpackbits(prints[:, None] ^ prints[None], axis=2).sum(axis=2)
    assert (buckets[a] == buckets[b]).all() and (apart[a, b] <= 30).all() and len(a) < 200

    def groups(pairs):
        parent = list(range(200))
        for x, y in pairs:
            x, y = (next_root(parent, z) for z in (x, y))
            parent[max(x, y)] = min(x, y)
        return [next_root(parent, x) for x in range(200)]

    def next_root(parent, x):
        while parent[x] != x:
            x = parent[x]
        return x

    near = [(i, j) for i in range(200) for j in range(i) if buckets[i] == buckets[j] and apart[i, j] <= 30]
    assert groups(zip(a.tolist(), b.tolist())) == groups(near)


def changed(source, words, n):
    words = list(words)
    for at in source.sample(range(len(words)), n):
        words[at] = f"changed{source.randrange(10**6)}"
    return words


def pairs_of_copies(n, length, changes, seed=5):
    source = random.Random(seed)
    rows = []
    for k in range(n):
        words = [f"w{source.randrange(5000)}" for _ in range(length)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(changed(source, words, changes)))]
    return rows


def test_near_copies_at_the_similarity_are_found(ready):
    rows = pairs_of_copies(300, 200, 4)
    brute = {r[0]: r[2] for r in brute_join(rows)}
    linked = [k for k in range(300) if brute[2 * k + 1] == 2 * k]  # some fall just below 0.8
    found = {r.doc_id: r.component_id for r in simhash.similar_groups(as_docs(ready, rows)).collect()}
    caught = [k for k in linked if found[2 * k + 1] == 2 * k]
    print("recall near 0.8:", len(caught), "of", len(linked))
    assert len(linked) > 100 and len(caught) >= 0.9 * len(linked)
    assert all(brute[k] == c for k, c in found.items() if c != k)


@pytest.mark.parametrize("seed", [0, 1])
def test_no_link_below_the_similarity(ready, seed):
    rows = near_texts(seed, 200)
    brute = {r[0]: r[2] for r in brute_join(rows)}
    found = {r.doc_id: r.component_id for r in simhash.similar_groups(as_docs(ready, rows)).collect()}
    assert set(found) == set(brute) and all(brute[k] == brute[c] for k, c in found.items())
    together = sum(found[k] != k for k in found)
    assert together >= 0.9 * sum(brute[k] != k for k in brute)


def test_stage_keeps_one_of_each_group(ready):
    rows = pairs_of_copies(60, 120, 1) + [(k, "same words in every copy of this text " * 3) for k in range(1000, 1040)] + [(2000, None), (2001, "")]
    docs = as_docs(ready, rows)
    kept = {r.doc_id for r in corpus_pipeline.keep_one_of_group(ready, docs, "").collect()}
    assert {k for k in kept if k < 1000} == set(range(0, 120, 2)) and {k for k in kept if k >= 1000} == {1000, 2000, 2001}


def test_similar_groups_of_odd_rows(odd_docs, odd_rows, no_docs):
    found = simhash.similar_groups(odd_docs)
    assert found.columns == ["doc_id", "component_id"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(str((r[0], r[2])) for r in brute_join(odd_rows))
    assert simhash.similar_groups(no_docs).count() == 0


def test_plan_grows_with_the_rows():
    plans = [simhash.Plan.of(n) for n in (0, 100, 10**5, 10**9)]
    assert [p.width for p in plans] == sorted(p.width for p in plans) and plans[-1].width == 24 and plans[0].width == 8
    for p in plans:
        assert p.blocks * p.width <= 64 * p.words and 0 < p.radius < 32 * p.words
