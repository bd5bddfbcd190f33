"""Context-tree weighting, licence digests, mixing and the pipeline."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from compare import connect, differences
from ledgerloom.llm import license_texts, licenses, lm, mixing, queries

from .conftest import lowered, remainder, spaced_words


# --- context-tree weighting -------------------------------------------------------------------
class Book:
    """Context-tree weighting as in the book: P after one more symbol over P before."""

    def __init__(self, counts, depth):
        self.depth, self.tree, self.longer = depth, {}, {}
        for word, many in counts.items():
            data = self.coded(word)
            for at in range(depth, len(data)):
                for d in range(depth + 1):
                    for bit in range(8):
                        key = (data[at - d : at], (1 << bit) | (data[at] >> (8 - bit)))
                        self.tree.setdefault(key, [0, 0])[data[at] >> (7 - bit) & 1] += many
        for context, node in self.tree:
            if context:
                self.longer.setdefault((context[1:], node), []).append((context, node))
        self.known = {}

    def coded(self, word):
        return b" " * self.depth + (b"\n" if word == "\n" else word.encode() + b" ")

    @staticmethod
    def estimate(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)

    def weighted(self, key):
        if key not in self.known:
            own = self.estimate(*self.tree.get(key, (0, 0)))
            if len(key[0]) < self.depth:
                own = math.log(0.5) + np.logaddexp(own, sum(map(self.weighted, self.longer.get(key, ()))))
            self.known[key] = own
        return self.known[key]

    def bit(self, context, node, one):
        new = None
        for d in range(self.depth, -1, -1):
            key = (context[self.depth - d :], node)
            a, b = self.tree.get(key, (0, 0))
            own = self.estimate(a + (not one), b + one)
            if d < self.depth:
                below = (context[self.depth - d - 1 :], node)
                rest = sum(map(self.weighted, self.longer.get(key, ()))) - (self.weighted(below) if below in self.tree else 0)
                own = math.log(0.5) + np.logaddexp(own, rest + new)
            new = own
        return new - self.weighted(((b""), node))

    def score(self, words):
        total = 0.0
        for word in words:
            data = self.coded(word)
            for at in range(self.depth, len(data)):
                for bit in range(8):
                    total += self.bit(data[at - self.depth : at], (1 << bit) | (data[at] >> (8 - bit)), data[at] >> (7 - bit) & 1)
        return total / math.log(10)


def taught(rows):
    counts = Counter()
    for held, text in rows:
        if not held:
            counts.update([*spaced_words(lowered(text)), "\n"])
    return counts


@pytest.mark.parametrize("block", [3_000_000, 150])
def test_scores_equal_the_book(ready, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK_DECISIONS", block)
    texts = ["abra cadabra abra", "Élan abra é", None, "", "zebra  zebra\nabracadabra", "x" * 40]
    rows = [(i, text, i % 5 == 4) for i, text in enumerate(texts)]
    docs = ready.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(3)
    counts = taught([(held, text) for _, text, held in rows])
    book = Book(counts, 3)
    n, v = sum(counts.values()), len(counts)
    for r in lm.score_texts(docs, depth=3).collect():
        words = [*spaced_words(lowered(texts[r.doc_id])), "\n"]
        assert r.score == pytest.approx(book.score(words), rel=1e-5)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)


def test_context_tree_query(ready, sf, texts):
    rows = queries.QUERIES["op7_context_tree"](ready, sf).collect()
    counts = taught([(remainder(k) == 1, t) for k, t in texts.items()])
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        words = [*spaced_words(lowered(texts[r.doc_id])), "\n"]
        assert r.held_out == (remainder(r.doc_id) == 1)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words))
    assert len(rows) == len(texts)
    held = [r for r in rows if r.held_out]
    bits = -sum(r.score for r in held) / math.log10(2) / sum(r.n_bytes for r in held)
    assert bits < 2.7  # of 8


def test_scores_of_odd_rows(ready, odd_docs, no_docs, odd_rows):
    marked = odd_docs.withColumn("held_out", F.col("doc_id") == 7)
    rows = lm.score_texts(marked).collect()
    assert len(rows) == len(odd_rows) and all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert lm.score_texts(no_docs.withColumn("held_out", F.lit(False))).count() == 0
    untaught = lm.score_texts(odd_docs.filter("doc_id = 7").withColumn("held_out", F.lit(True))).first()
    assert untaught.score == pytest.approx(-8 * math.log10(2) * (len("one ") + len("two ") + 1), rel=1e-6)


def test_a_break_after_very_many_copies_has_a_finite_score(ready):
    # After one byte both go on; only the longer contexts are sure, and all weight is theirs.
    seen = [(b"xab", 10**8), (b"yaa", 10**8), (b"xaa", 0)]
    codes = [(int.from_bytes((b"     " + w)[at - 5 : at + 1]), n) for w, n in seen for at in (5, 6, 7)]
    counts = ready.createDataFrame(codes, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    scores = {r.code: r.score for r in lm.score_codes(counts).collect()}
    odd = int.from_bytes(b"   xaa")
    assert all(map(math.isfinite, scores.values())) and -30 < scores[odd] < -8


class Running(Book):
    """The book with contexts over the whole text."""

    def coded(self, text):
        return b" " * self.depth + "".join(w + " " for w in spaced_words(lowered(text))).encode() + b"\n"


@pytest.mark.parametrize("block", [3_000_000, 150])
def test_contexts_go_across_words(ready, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK_DECISIONS", block)
    monkeypatch.setattr(lm, "CODE_ROWS", 7)
    monkeypatch.setattr(lm, "CODED_TOKENS", 4)
    texts = ["abra cadabra abra", "Élan abra é", None, "", "zebra  zebra\nabracadabra", "x" * 40, "cadabra abra abra", "b d\tb d", "b d b e"]
    rows = [(i, text, i % 5 == 4) for i, text in enumerate(texts)]
    docs = ready.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(3)
    book = Running(Counter(text for _, text, held in rows if not held), 3)
    found = {r.doc_id: r.score for r in lm.score_texts(docs, depth=3, across=True).collect()}
    for i, text in enumerate(texts):
        assert found[i] == pytest.approx(book.score([text]), rel=1e-5)
    assert abs(found[0] - found[6]) > 0.01  # the same words in another order


def test_codes_are_counted_in_few_rows_and_little_room(ready):
    """A split's codes travel as a row a bin, and a text's words in less than four bytes each."""
    source = random.Random(2)
    texts = [" ".join("".join(source.choice("aeinorst") for _ in range(source.randint(2, 7))) for _ in range(4000)) for _ in range(6)]
    docs = ready.createDataFrame([(i, text, False) for i, text in enumerate(texts)], "doc_id long, text string, held boolean").coalesce(1)
    rows = lm.encode(docs, "doc_id", "text", "held").collect()
    binned = [r for r in rows if r["word"] is None and r["_key"] is None]
    assert 0 < len(binned) <= 1021
    assert sum(len(r["ids"]) for r in rows if r["_key"] is not None) < 3 * 6 * 4000
    seen = Counter()
    for r in binned:
        seen.update(dict(zip(lm.unpacked_codes(r["codes"]).tolist(), lm.unpacked(r["seen"], np.int32).tolist())))
    expected = Counter()
    for text in texts:
        data = b" " * 5 + text.encode() + b" \n"
        expected.update(int.from_bytes(data[at - 5 : at + 1]) for at in range(5, len(data)))
    assert seen == expected


def test_codes_are_added_up_without_hashing_them_all(monkeypatch):
    """Runs of counted codes are merged in order; the union by hashing took most of a task's time."""
    monkeypatch.setattr(np, "union1d", None)
    words, ids, counts = [b"\n", b"ab", b"abc"], np.array([1, 2, 1, 1, 2], np.int32), np.array([2, 0, 3])
    monkeypatch.setattr(lm, "CODED_TOKENS", 2)
    every, seen = lm.counted(lm.coded(words, ids, counts, 5, True), np.array([True, True, False]))
    both, many = Counter(), Counter()
    for data, weight in ((b"ab abc \n", 1), (b"\n", 1), (b"ab ab abc \n", 0)):
        data = b" " * 5 + data
        for at in range(5, len(data)):
            both[int.from_bytes(data[at - 5 : at + 1])] += 1
            many[int.from_bytes(data[at - 5 : at + 1])] += weight
    assert dict(zip(every.tolist(), seen.tolist())) == {code: many[code] for code in sorted(both)}


def test_query_scores_the_order_of_words(ready, tmp_path):
    texts = ["one two three four five six"] * 40 + ["six two four one three five", "one two three four five six"]
    held = [k for k in range(2000) if remainder(k) == 1][:2]
    keys = [k for k in range(2000) if remainder(k) != 1][:40] + held
    ready.createDataFrame(list(zip(keys, texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.score for r in queries.QUERIES["op7_context_tree"](ready, str(tmp_path)).collect()}
    assert found[held[0]] < found[held[1]] - 1


# --- licences ---------------------------------------------------------------------------------
def test_whole_texts_are_recognised_however_they_are_written(ready):
    mit = license_texts.TEXTS[1][1]
    rows = [
        (1, mit), (2, "MIT LICENSE\n\nCopyright (c) 2020 Somebody\n© others\n" + mit.upper().replace('"', "“") + "\n"),
        (3, mit + " and more"), (4, "Intro\n  released under the MIT licence!\nThe end"), (5, None), (6, ""), (7, "Copyright 2020"),
        (8, "All rights reserved."), (8, "All rights reserved."), (None, "All rights reserved"),
    ]
    docs = ready.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.license, r.notices, r.n_notices) for r in licenses.scan(docs).collect()}
    reserved = "all-rights-reserved"
    assert found == {
        (1, "MIT", "", 0), (2, "MIT", "", 0), (3, None, "", 0), (4, None, "MIT", 1), (5, None, "", 0), (6, None, "", 0),
        (7, None, "", 0), (8, reserved, reserved, 1), (None, reserved, reserved, 1)}
    assert licenses.scan(docs).count() == len(rows)


def test_scan_of_nothing(odd_docs, no_docs, odd_rows):
    assert licenses.scan(no_docs).count() == 0
    assert licenses.scan(odd_docs, texts=()).count() == len(odd_rows)
    plan = licenses.scan(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan.replace("PythonRDD", "") and "CartesianProduct" not in plan


# --- mixing -----------------------------------------------------------------------------------
def soft_documents(n, seed, noise):
    """Token counts and posteriors of documents of three domains."""
    random = np.random.default_rng(seed)
    kinds = random.choice(3, n, p=[0.8, 0.12, 0.08])
    p = random.dirichlet([noise] * 3, n)
    p[np.arange(n), kinds] += 4 * noise
    return random.integers(50, 500, n), p / p.sum(axis=1, keepdims=True)


def as_known(ready, n, p):
    rows = [(int(n[i]), *map(float, p[i])) for i in range(len(n))]
    return ready.createDataFrame(rows, "n_tokens long, p_clean double, p_toxic double, p_poor double").coalesce(1)


@pytest.mark.parametrize("noise", [0.05, 0.3])
def test_rates_solve_the_least_squares(ready, noise):
    n, p = soft_documents(1500, 1, noise)
    targets = {"clean": 0.9, "toxic": 0.04, "poor": 0.06}
    known = as_known(ready, n, p)
    mix = mixing.fit_mix(known, targets)
    rates = np.array([r.rate for r in known.withColumn("rate", mix.rate).collect()])
    totals = (p * (n * rates)[:, None]).sum(axis=0)
    now = (p * n[:, None]).sum(axis=0)
    own = (p * n[:, None] * (p > 0.5)).sum(axis=0)
    wanted = np.clip(np.array([0.9, 0.04, 0.06]) * now[0] / 0.9, now - own, now + (mixing.MOST - 1) * own)
    # The same objective by plain projected gradient on the rates themselves, with small steps.
    weight = np.linalg.inv((p * n[:, None]).T @ p)
    r = np.ones(len(n))
    for _ in range(20_000):
        r = np.clip(r - 0.5 * p @ weight @ ((p * (n * r)[:, None]).sum(axis=0) - wanted), 0, mixing.MOST)
    best = (p * (n * r)[:, None]).sum(axis=0) - wanted
    miss = totals - wanted
    assert (rates >= 0).all() and miss @ weight @ miss <= best @ weight @ best + 1e-6 * now.sum()
    assert np.allclose(mix.shares, totals / totals.sum())
    assert mix.reached == (np.abs(totals / (np.array([0.9, 0.04, 0.06]) * now[0] / 0.9) - 1).max() < mixing.TOLERANCE)


def test_domains_that_cannot_be_told_apart_are_left_alone(ready):
    known = as_known(ready, np.full(200, 100), np.tile([0.756, 0.133, 0.111], (200, 1)))
    mix = mixing.fit_mix(known)
    assert not mix.reached and {r.rate for r in known.withColumn("rate", mix.rate).collect()} == {1.0}


def test_a_domain_without_members_bends_no_other(ready):
    rows = [(100, 1.0, 0.0, 0.0)] * 50 + [(100, 0.999, 0.0, 0.001)] * 2
    known = ready.createDataFrame(rows, "n_tokens long, p_clean double, p_toxic double, p_poor double")
    mix = mixing.fit_mix(known)
    rates = [r.rate for r in known.withColumn("rate", mix.rate).collect()]
    assert max(abs(r - 1) for r in rates) < 0.01 and not mix.reached


def test_query_reaches_the_targets(ready):
    rows = queries.QUERIES["op9_mixing"](ready, "/root/testdata/sf0.01").toPandas()
    for many, near in ((rows.rate, 0.005), (rows.copies, 0.3)):
        have = np.array([(rows.n_tokens * rows[f"p_{name}"] * many).sum() for name in mixing.DOMAINS])
        wanted = np.array([mixing.TARGETS[name] for name in mixing.DOMAINS])
        assert np.abs(have / have.sum() / wanted - 1).max() < near, (have / have.sum(), near)


def test_a_short_domain_is_filled_up(ready):
    rows = [(k, 100, 0.99, 0.005, 0.005) for k in range(4000)] + [(k, 100, 0.02, 0.0, 0.98) for k in range(4000, 4010)]
    rows += [(k, 100, 0.02, 0.98, 0.0) for k in range(4010, 4100)]
    known = ready.createDataFrame(rows, "doc_id long, n_tokens long, p_clean double, p_toxic double, p_poor double")
    found = known.withColumn("rate", mixing.fit_to_targets(known, {"clean": 0.94, "toxic": 0.01, "poor": 0.05})).toPandas()
    have = np.array([(found.n_tokens * found[f"p_{name}"] * found.rate).sum() for name in mixing.DOMAINS])
    assert np.abs(have / have.sum() / [0.94, 0.01, 0.05] - 1).max() < 0.005 and found.rate[4005] > 10


def test_labels_teach_the_domains(ready):
    folder = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op9_mixing"](ready, folder).toPandas()
    labels = ready.read.parquet(f"{folder}/labels.parquet").toPandas()
    both = rows.merge(labels, on="doc_id")
    toxic = both.toxic == 1
    assert both.p_toxic[toxic].mean() > 0.6 and both.p_toxic[~toxic].mean() < 0.05
    clean = both[(both.quality == 1) & ~toxic]
    assert (clean.copies >= 1).mean() > 0.98 and both.rate[toxic].mean() < 0.4
    assert np.allclose(rows[["p_clean", "p_toxic", "p_poor"]].sum(axis=1), 1) and (rows.rate >= 0).all()


def test_mixing_of_odd_rows(ready, odd_docs, no_docs, odd_rows):
    labels = ready.createDataFrame(
        [(4, 1, 0), (4, 1, 0), (7, 0, 0), (8, 1, 1), (9, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = mixing.with_rates(odd_docs, labels).collect()
    assert len(rows) == len(odd_rows) and all(r.rate >= 0 and r.copies >= 0 for r in rows)
    assert len({(r.rate, r.copies) for r in rows if r.doc_id == 4}) == 1
    assert mixing.mix(no_docs, labels).count() == 0
    assert mixing.with_rates(odd_docs, labels.limit(0)).count() == len(odd_rows)


# --- pipeline and registry --------------------------------------------------------------------
def test_stages_follow_each_other(ready):
    folder = "/root/testdata/sf0.01"
    docs = ready.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    labels = {r.doc_id: r for r in ready.read.parquet(f"{folder}/labels.parquet").collect()}
    clean = {k for k in before if k in labels and labels[k].quality == 1 and labels[k].toxic == 0}
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(ready, docs, folder), "test-stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= before and docs.count() == len(after)
        left[name], before = after, after
    assert len(clean & left["quality"]) > 0.98 * len(clean)
    poor = {k for k, r in labels.items() if r.quality == 0}
    assert len(poor & left["quality"]) < 0.1 * len(poor)
    assert len(left["mixing"]) < len(left["decontaminate"]) < len(left["line_dedup"])
    assert len(clean & left["mixing"]) >= 0.95 * len(clean & left["decontaminate"])


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_mixing_keeps_clean_documents(ready, size):
    folder = f"/root/testdata/sf{size}"
    docs, labels = (ready.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    clean = {r.doc_id for r in labels.filter("quality = 1 AND toxic = 0").collect()}
    kept = {r.doc_id for r in corpus_pipeline.mix_to_targets(ready, docs, folder).collect()}
    assert len(clean & kept) >= 0.95 * len(clean & {r.doc_id for r in docs.collect()})


def test_pipeline_on_odd_tables(ready, no_docs, odd_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(ready, no_docs, "/root/testdata/sf0.001").count() == 0, name
        found = stage(ready, odd_docs, "/root/testdata/sf0.001")
        assert set(odd_docs.columns) <= set(found.columns) and found.count() <= odd_docs.count()


def test_every_operator_is_registered():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(ready, sf, name):
    assert differences(queries.QUERIES[name](ready, sf), connect(sf), queries.ORACLES[name]) == []
