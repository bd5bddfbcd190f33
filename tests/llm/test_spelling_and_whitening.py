"""Spelling variants and whitening against brute force, and on odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import queries, spelling, whitening

from .conftest import lowered

RUN = re.compile("[A-Za-zÀ-ÿ]+")


# --- spelling variants ------------------------------------------------------------------------
def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute_variants(rows, every=None, letters=6, count=5, ratio=5):
    counts = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= letters and n >= count}
    by_size = {}
    for w in counts:
        by_size.setdefault(len(w), []).append(w)
    found = {}
    for w, n in counts.items():
        near = [v for size in (-1, 0, 1) for v in by_size.get(len(w) + size, []) if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best and counts[best] >= ratio * n else None
        found[w] = [form, None, n, len(near), counts[form] if form else None]
    for w, row in found.items():
        row[1] = w
        while found[row[1]][0]:
            row[1] = found[row[1]][0]
    return {(w, *row) for w, row in found.items()}


def variant_rows(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_brute_force(ready, sf, texts):
    assert variant_rows(queries.QUERIES["op13_spelling_variants"](ready, sf)) == brute_variants(texts.items(), 199)


@pytest.mark.parametrize("symbols", [2, 5, 8])
def test_neighbourhoods_are_full_and_hold_nothing_twice(symbols):
    source = random.Random(symbols)
    words = ["".join(source.choice("abcdeé") for _ in range(source.randrange(1, 9))) for _ in range(80)]
    pairs = [(n, k) for numbers, keys in spelling.neighbour_keys(words, symbols) for n, k in zip(numbers.tolist(), keys.tolist())]
    assert len(pairs) == len(set(pairs))
    generated = set(pairs)
    for v, key in zip(words, spelling.reduced_keys(words, symbols).tolist()):
        for n, w in enumerate(words):
            if w == v or one_edit(w, v):
                assert (n, key) in generated
    for n, w in enumerate(words):  # itself, deletions by runs of equals, replacements, insertions
        reduced = spelling._symbols([w], symbols)[0].tolist()
        edits = {tuple(reduced)} | {tuple(reduced[:i] + reduced[i + 1 :]) for i in range(len(w))}
        edits |= {tuple(reduced[:i] + [s] + reduced[i + 1 :]) for i in range(len(w)) for s in range(symbols)}
        edits |= {tuple(reduced[:i] + [s] + reduced[i:]) for i in range(len(w) + 1) for s in range(symbols)}
        assert len(edits) == sum(m == n for m, _ in pairs)


def test_chains_ties_and_letters_beyond_ascii(ready):
    counts = {
        "garden": 200, "gardan": 40, "gardans": 8, "gardons": 8, "ÉLAN-x élanée": 30, "élanèe": 6, "Élanée": 5,
        "letter": 50, "lettre": 50, "better": 50, "bettes": 10, "short": 100, "shorts": 100, "xgarden": 4,
    }
    rows = [(i, " ".join([word] * n) + ". 7") for i, (word, n) in enumerate(counts.items())]
    found = variant_rows(spelling.group_variants(ready.createDataFrame(rows, "doc_id long, text string")))
    assert found == brute_variants(rows)
    roots = {r[0]: r[2] for r in found}
    assert roots["gardans"] == "garden" and roots["élanèe"] == "élanée" and roots["bettes"] == "better" and "short" not in roots


def test_variants_of_odd_rows(odd_docs, odd_rows, no_docs):
    found = spelling.group_variants(odd_docs, every=3)
    assert variant_rows(found) == brute_variants(odd_rows, 3)
    assert found.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert spelling.group_variants(no_docs).count() == 0


def test_very_long_words(ready):
    source = random.Random(1)
    base = "".join(source.choice("abcd") for _ in range(30_000))
    rows = [(1, f"{base} " * 30), (2, f"{base[:17000]}{base[17001:]} " * 5), (3, f"{base[:5]}x{base[6:]} " * 5), (4, f"{base}yy " * 5)]
    found = variant_rows(spelling.group_variants(ready.createDataFrame(rows, "doc_id long, text string")))
    assert found == brute_variants(rows)
    assert sorted(r[4] for r in found) == [0, 1, 1, 2]


# --- whitening --------------------------------------------------------------------------------
def usable(vector):
    return vector is not None and all(v is not None and math.isfinite(v) for v in vector)


def brute_whitening(rows, k, weights="one"):
    """Per row and component: key, component, n, deviation, |whitened|, explained; for one length."""
    points = [(key, tuple(math.floor(256 * float(v)) for v in vector)) for key, vector in rows if usable(vector) and len(vector)]
    counts = Counter(x for _, x in points)
    xs = sorted(counts)
    w = [counts[x] if weights == "counts" else 1 for x in xs]
    n, sums = sum(w), [sum(c * x[i] for c, x in zip(w, xs)) for i in range(len(xs[0]))]
    centred = np.array(xs, float) - np.array(sums) / n
    cov = (centred * np.array(w)[:, None]).T @ centred / n
    e, vectors = np.linalg.eigh(cov)
    e, vectors = e[::-1][:k], vectors[:, ::-1][:, :k]
    out = []
    for key, x in points:
        white = (np.array(x, float) - np.array(sums) / n) @ vectors / np.sqrt(e)
        deviation = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        out += [(key, i + 1, n, deviation, abs(white[i]), e[i] / np.trace(cov)) for i in range(len(e))]
    return out


def same(found, wanted):
    found = sorted((r.vec_id is None, r.vec_id, r.component, r.n, int(r.deviation), abs(r.whitened), r.explained) for r in found)
    wanted = sorted((w[0] is None, *w) for w in wanted)
    assert [f[:5] for f in found] == [w[:5] for w in wanted]
    assert np.allclose([f[5:] for f in found], [w[5:] for w in wanted], rtol=1e-7, atol=1e-7)


def test_whitening_query_equals_brute_force(ready, sf):
    rows = [(r.vec_id, r.embedding) for r in ready.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found = queries.QUERIES["op11_whitening"](ready, sf)
    assert dict(found.dtypes)["deviation"] == "bigint" and dict(found.dtypes)["component"] == "int"
    found = found.collect()
    same(found, brute_whitening(rows, 4))
    assert all(r.identity_error < 1e-10 for r in found)
    first = [r for r in found if r.component == 1]
    signs = {r.vec_id: r.whitened for r in first}
    assert min(signs.values()) < 0 < max(signs.values())


ODD = [
    (1, [0.5, -1.0, 2.0]), (2, [0.5, -1.0, 2.0]), (3, [0.5, -1.0, 2.001]), (3, [1.5, 3.0, -2.0]), (None, [4.0, 0.25, 1.0]),
    (4, None), (5, [1.0, None, 2.0]), (6, [float("nan"), 0.0, 0.0]), (7, [float("inf"), 0.0, 0.0]), (8, []),
    (9, [-0.0, 0.0, -0.001]), (10, [3.0, 3.0, 7.0]), (11, [2.5, 0.1, 9.0]), *[(12, [1.0, 2.0, 3.0])] * 40,
]


def odd_vectors(ready, rows, kind="double"):
    extra = "x string, k string, n string, whitened string, component string, held string, size string"
    return ready.createDataFrame([(*r, *"abcdefg") for r in rows], f"vec_id long, embedding array<{kind}>, {extra}")


@pytest.mark.parametrize("weights", ["one", "counts"])
def test_whitening_of_odd_rows(ready, weights):
    found = whitening.whiten(odd_vectors(ready, ODD), weights=weights)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = found.collect()
    same(found, brute_whitening(ODD, 3, weights))
    assert {r.n for r in found} == {7 if weights == "one" else 48}
    assert all(r.identity_error < 1e-9 for r in found)


def test_lengths_are_fitted_apart(ready):
    source = random.Random(3)
    short = [(i, [source.gauss(0, 1) for _ in range(2)]) for i in range(30)]
    long = [(100 + i, [source.gauss(0, 1) for _ in range(5)]) for i in range(40)]
    same(whitening.whiten(odd_vectors(ready, short + long), components=4).collect(), brute_whitening(short, 4) + brute_whitening(long, 4))


def test_flat_directions_and_nothing(ready):
    flat = [(i, [float(i % 3), 2.0 * (i % 3)]) for i in range(9)]
    found = whitening.whiten(odd_vectors(ready, flat)).collect()
    assert {(r.component, r.whitened is None) for r in found} == {(1, False), (2, True)} and all(r.identity_error < 1e-9 for r in found)
    alone = whitening.whiten(odd_vectors(ready, [(1, [1.0, 2.0])])).collect()
    assert [(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 0, None, None, None)] * 2
    assert whitening.whiten(odd_vectors(ready, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(odd_vectors(ready, [])).count() == 0


def test_sums_beyond_machine_words_are_exact(ready):
    rows = [(i, [1e13 * (i + 1), float(i % 5)]) for i in range(20)] + [(50, [3e38, 1.0])]
    found = {(r.vec_id, r.component): r for r in whitening.whiten(odd_vectors(ready, rows[:20])).collect()}
    for key, component, n, deviation, white, _ in brute_whitening(rows[:20], 2):
        assert int(found[key, component].deviation) == deviation
    assert whitening.whiten(odd_vectors(ready, rows)).count() == 42  # steps at the limit of 64 bits do not fail


def test_floats_are_taken_as_doubles(ready):
    rows = [(i, [0.1 * i, 0.3 - 0.7 * i]) for i in range(12)]
    narrow = [(i, [float(np.float32(v)) for v in vector]) for i, vector in rows]
    same(whitening.whiten(odd_vectors(ready, rows, "float")).collect(), brute_whitening(narrow, 2))
