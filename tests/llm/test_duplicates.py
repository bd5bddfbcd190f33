"""SimHash groups, suffix dedup and near-duplicate lines."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import lines, queries, simhash, suffixes
from ledgerloom.llm.components import connected

from .conftest import lowered, spaced_words


# --- SimHash ----------------------------------------------------------------------------------
def brute_print(text):
    words = spaced_words(lowered(text))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def brute_groups(prints):
    n = len(prints)
    return components_of(n, [(i, j) for i in range(n) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3])


def clusters(n, seed, flips=4):
    """Fingerprints around a few centres, so that chains of links occur."""
    source = random.Random(seed)
    centres = [source.getrandbits(64) for _ in range(6)]
    return list({c ^ sum(1 << source.randrange(64) for _ in range(source.randrange(flips))) & (1 << 64) - 1
                 for c in (source.choice(centres) for _ in range(n))})


@pytest.mark.parametrize("seed", range(8))
def test_planes_link_what_is_near(seed):
    prints = clusters(300, seed)
    source = random.Random(seed)
    buckets = np.array(sorted(source.randrange(4) for _ in prints))
    a, b = simhash.links_within(buckets, np.array(prints, np.uint64))
    near = [(i, j) for i in range(len(prints)) for j in range(i)
            if buckets[i] == buckets[j] and (prints[i] ^ prints[j]).bit_count() <= 3]
    assert components_of(len(prints), zip(a.tolist(), b.tolist())) == components_of(len(prints), near)
    assert len(a) < len(prints)
    assert all((prints[i] ^ prints[j]).bit_count() <= 3 for i, j in zip(a.tolist(), b.tolist()))


@pytest.mark.parametrize("chunk", [1024, 16])
def test_links_connect_all_near_prints(ready, chunk):
    prints = clusters(400, 3)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.links(ready.createDataFrame(signed, "fp long"), chunk).collect()
    at = {p[0]: i for i, p in enumerate(signed)}
    assert components_of(len(prints), [(at[r.u], at[r.v]) for r in links]) == brute_groups(prints)


def test_components_of_a_long_chain(ready):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100), (50, 60), (60, 55), (55, 50), (60, 50)]
    found = {r.node: r.root for r in connected(ready.createDataFrame(chain, "u long, v long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys((50, 55, 60), 50)}


def test_simhash_of_odd_rows(ready, odd_docs, no_docs, odd_rows):
    rows = simhash.near_groups(odd_docs).collect()
    prints = [brute_print(t) for _, t in odd_rows]
    roots = brute_groups(prints)
    smallest = {}
    for (key, _), root in zip(odd_rows, roots):
        if key is not None:
            smallest[root] = min(key, smallest.get(root, key))
    expected = sorted(((k, f"{p:016x}", smallest.get(r)) for (k, _), p, r in zip(odd_rows, prints, roots)), key=str)
    assert sorted(map(tuple, rows), key=str) == expected
    assert simhash.near_groups(no_docs).count() == 0
    kept = [r.doc_id for r in simhash.keep_first(odd_docs).collect()]
    assert sorted(k for k in kept if k is not None) == sorted(k for k, _, c in expected if k is not None and k == c)
    assert kept.count(None) == 2


def test_simhash_of_the_test_tables(ready, sf, texts):
    keys = sorted(texts)
    prints = [brute_print(texts[k]) for k in keys]
    expected = {(k, f"{p:016x}", keys[r]) for k, p, r in zip(keys, prints, brute_groups(prints))}
    assert set(map(tuple, queries.QUERIES["op4_simhash"](ready, sf).collect())) == expected


# --- suffixes ---------------------------------------------------------------------------------
def brute_repeats(rows, length=100):
    seen, out = set(), {}
    for key, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            if window in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[key] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def made_rows():
    source = random.Random(3)
    base = "".join(source.choice("abcdefgh ") for _ in range(900))
    rows = [(1, None), (2, ""), (3, "is " * 300), (4, "ab" * 40 + "x" * 250), (5, "x" * 99), (6, "x" * 100), (7, "é" * 120)]
    for key in range(8, 60):
        text = list(base)
        for _ in range(source.randint(0, 9)):
            text[source.randrange(900)] = source.choice("xyz")
        low = source.randrange(500)
        rows.append((key, "".join(text)[low : low + source.randint(50, 800)] + "".join(
            source.choice("abc") for _ in range(source.randint(0, 300)))))
    return rows


@pytest.mark.parametrize("crowd", [2_000, 3])
def test_repeats_equal_brute_force(ready, monkeypatch, crowd):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    rows = made_rows()
    docs = ready.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: tuple(r)[1:5] for r in suffixes.remove_repeats(docs).collect()}
    assert found == brute_repeats(rows)


def test_crowded_anchors_are_halved_not_cut_into_windows(ready, monkeypatch):
    """A passage in many surroundings: a few rows a stretch at most, and no window is lost."""
    source = random.Random(8)
    passage = "".join(source.choice("abcdefgh ") for _ in range(60))
    rows = [(key, "".join(source.choice("ijklmnop ") for _ in range(80)) + passage
             + "".join(source.choice("qrstuvw ") for _ in range(80))) for key in range(400)]
    rows += [(key + 400, rows[key][1][5 + key % 9 :]) for key in range(0, 400, 4)]
    docs = ready.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sizes, keep = {}, suffixes.materialize

    def kept(df, label):
        out = keep(df, label)
        sizes.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(suffixes, "materialize", kept)
    monkeypatch.setattr(suffixes, "CROWD", 50)
    found = {r.doc_id: tuple(r)[1:5] for r in suffixes.remove_repeats(docs).collect()}
    assert found == brute_repeats(rows)
    assert sizes["halves"] and sum(sizes["halves"]) <= 2 * len(sizes["halves"]) * sizes["pieces"][0]
    assert len(sizes["halves"]) <= 3


def test_long_texts_are_cut_alike(monkeypatch):
    """Every window is in one stretch, and equal windows keep equal anchors, in parts or whole."""
    import pyarrow as pa

    from ledgerloom.llm.blocks import text_blocks

    source = random.Random(5)
    text = "".join(source.choice("abcd") for _ in range(3000)) * 2

    def anchors():
        (block,) = text_blocks(pa.array([text]))
        _, anchor, _, first, windows = suffixes.stretches(block)
        return {int(f) + k: int(a) for a, f, n in zip(anchor, first, windows) for k in range(int(n))}

    whole = anchors()
    monkeypatch.setattr(suffixes, "_PLACE_BITS", 10)
    parts = anchors()
    assert set(parts) == set(whole) == set(range(len(text) - 99))
    assert sum(parts[k] == whole[k] for k in whole) > 0.99 * len(whole)
    assert all(whole[k] == whole[k + 3000] for k in range(2900))


def test_suffix_order_and_smaller_neighbours():
    source = np.random.default_rng(1)
    data = source.integers(97, 99, 300).astype(np.uint8)
    places = np.arange(280)
    ranks = suffixes.suffix_ranks(data, places, 20)
    raw = data.tobytes()
    order = sorted(set(raw[p : p + 20] for p in places))
    assert [order[r] for r in ranks] == [raw[p : p + 20] for p in places]
    values = source.integers(0, 50, 200)
    expected = [next((j for j in range(i - 1, -1, -1) if values[j] < values[i]), -1) for i in range(200)]
    assert suffixes.nearest_smaller(values).tolist() == expected


def test_repeats_of_odd_rows(ready, odd_docs, no_docs, odd_rows):
    rows = suffixes.remove_repeats(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    expected = brute_repeats(list({k: t for k, t in odd_rows if k is not None}.items()))
    for r in rows:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert tuple(r)[1:5] == expected[r.doc_id]
    assert suffixes.remove_repeats(no_docs).count() == 0


def test_repeats_of_the_test_tables(ready, sf, texts):
    rows = queries.QUERIES["op5_suffix_dedup"](ready, sf).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == brute_repeats(texts.items())


# --- lines ------------------------------------------------------------------------------------
def brute_lines(rows):
    """Removed (key, line number), by comparing every line with all earlier ones."""
    sets = sorted(
        (key, number, set(spaced_words((line or "").lower())))
        for key, text in {k: t for k, t in rows if k is not None}.items() for number, line in enumerate((text or "").split("\n")))
    sets = [s for s in sets if len(s[2]) >= 5]
    out = set()
    for i, (key, number, words) in enumerate(sets):
        if any(5 * len(words & other) >= 4 * len(words | other) for _, _, other in sets[:i]):
            out.add((key, number))
    return out


def test_lines_equal_brute_force(ready):
    source = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    bases = [[source.choice(vocabulary) for _ in range(source.randint(5, 25))] for _ in range(12)]
    rows = []
    for key in range(80):
        text = []
        for _ in range(source.randint(0, 6)):
            words = list(source.choice(bases))
            for _ in range(source.randint(0, 4)):
                words[source.randrange(len(words))] = source.choice(vocabulary)
            text.append(" \t".join(words).title())
        rows.append((key, "\n".join(text)))
    docs = ready.createDataFrame(rows, "doc_id long, text string").repartition(4)
    gone = {(r.doc, r.line_no) for r in lines.repeated_lines(docs).collect()}
    assert gone == brute_lines(rows) and gone
    for r in lines.without_repeats(docs).collect():
        parts = dict(rows)[r.doc_id].split("\n")
        kept = [p for i, p in enumerate(parts) if (r.doc_id, i) not in gone]
        assert (r.text, r.n_lines, r.n_removed) == ("\n".join(kept), len(parts), len(parts) - len(kept))


def test_lines_of_odd_rows(ready, odd_docs, no_docs, odd_rows):
    expected = brute_lines(odd_rows)
    found = lines.without_repeats(odd_docs)
    rows = found.collect()
    assert len(rows) == len(odd_rows) and set(odd_docs.columns) <= set(found.columns)
    for r in rows:
        assert r.n_removed == sum(key == r.doc_id for key, _ in expected)
    assert {r.text for r in rows if r.doc_id == 1} == {None}
    assert lines.without_repeats(no_docs).count() == 0
    left = {r.doc_id for r in lines.remove_lines(odd_docs).collect()}
    assert 5 not in left and {1, 2, 3, 4, 7, None} <= left


def test_line_joins_stay_native(ready, documents):
    plan = lines.without_repeats(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_lines_of_all_sizes_equal_brute_force(ready):
    """Lines below and above ``LONG`` words, near copies across size classes, one word in all lines."""
    source = random.Random(5)
    rows = []
    for key in range(60):
        words = [f"w{source.randrange(10**6)}" for _ in range(source.choice([5, 6, 8, 12, 20, 32, 50, 89, 91, 120, 200, 260]))]
        text = []
        for _ in range(4):
            size = source.randint(-(-4 * len(words) // 5) - 1, len(words))
            copy = source.sample(words, size) + [f"v{source.randrange(10**6)}" for _ in range(source.randint(0, len(words) // 6))]
            text.append(" ".join([*copy, "everywhere"]))
        rows.append((key, "\n".join(text)))
    docs = ready.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = brute_lines(rows)
    assert {(r.doc, r.line_no) for r in lines.repeated_lines(docs).collect()} == expected
    assert 40 < len(expected) < 200


def test_line_pairs_meet_without_lambdas(ready, documents, monkeypatch):
    """What runs for each pair of lines is generated code, and only lines of near sizes meet."""
    plans = []

    def watched(df, label):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return materialize(df, label)

    materialize = lines.materialize
    monkeypatch.setattr(lines, "materialize", watched)
    lines.repeated_lines(documents).count()
    joins = [plan for label, plan in plans if label == "pairs"]
    assert len(joins) > lines.SHARES and not any("lambda" in plan for plan in joins)
    sizes = ready.range(5, 3000).selectExpr("cast(id as int) as n")
    classes = {r.n: r["class"] for r in sizes.select("n", lines.size_class(F.col("n")).alias("class")).collect()}
    assert all({classes[m] for m in range(-(-4 * n // 5), n + 1)} <= {classes[n], classes[-(-4 * n // 5)]} for n in range(7, 3000))
    assert classes[2999] > classes[5] + 8
