"""Quality rules, decontamination, personal data and the pairwise ranking."""

import hashlib
import re

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.blocks import Block
from ledgerloom.llm import decontaminate, pii, quality_rules, queries, ranker

from .conftest import lowered, remainder, spaced_words

LETTERS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# --- quality rules ----------------------------------------------------------------------------
def test_rules_keep_what_resembles_the_trusted(ready):
    good = " ".join(f"word{i}" for i in range(200))
    junk = " ".join(f"zz{i}##" for i in range(200))
    rows = [(i, good) for i in range(30)] + [(100 + i, junk) for i in range(5)] + [(200, "short text")]
    docs = ready.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in quality_rules.apply_rules(docs, docs.filter("doc_id < 20").select("text")).collect()}
    assert all(found[i].kept for i in range(30)) and not any(found[100 + i].kept for i in range(5))
    assert found[200].base_failed and not found[200].kept and found[0].llr > 0 > found[100].llr


def test_ratio_is_the_mean_log_ratio(ready):
    trusted, raw = np.array([3, 0, 1]), np.array([3, 4, 1])
    share = raw / 8
    expected = np.log((trusted + 2 * share) / 6) - np.log(share)
    assert np.allclose(quality_rules.log_ratios(trusted, raw, 2), expected)
    for size in (1, 1000):  # equal distributions, of whatever size, and a bucket without n-grams
        assert np.allclose(quality_rules.log_ratios(np.array([2, 6, 0]), size * np.array([1, 3, 0])), 0)


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_good_documents_are_kept_at_any_size(ready, size):
    docs, labels = (ready.read.parquet(f"/root/testdata/sf{size}/{name}.parquet") for name in ("documents", "labels"))
    found = {r.doc_id: r for r in queries.QUERIES["op1_quality_rules"](ready, f"/root/testdata/sf{size}").collect()}
    good = [k for k, in labels.filter("quality = 1").select("doc_id").collect() if k in found and not found[k].base_failed]
    poor = [k for k, in labels.filter("quality = 0").select("doc_id").collect() if k in found and not found[k].base_failed]
    assert sum(found[k].kept for k in good) >= 0.98 * len(good) and sum(found[k].kept for k in poor) <= 0.1 * len(poor)
    # The ratios against counts in plain Python; only the buckets' names are taken from the operator.
    trusted = {k for k, in labels.filter("quality = 1").select("doc_id").distinct().collect()}
    raw, own, buckets = Counter(), Counter(), {}
    for r in docs.select("doc_id", "text").collect():
        data = np.frombuffer((r.text or "").encode(), np.uint8)
        block = Block(0, data, np.array([0, len(data)]))
        buckets[r.doc_id] = quality_rules.ngram_buckets(block, quality_rules.spaced_words(block))[0].tolist()
        words = len(spaced_words(r.text))
        assert len(buckets[r.doc_id]) == max(2 * words - 1, 0)
        raw.update(buckets[r.doc_id])
        own.update(buckets[r.doc_id] if r.doc_id in trusted else [])
    total, mass = sum(raw.values()), quality_rules.MASS
    for k in sorted(buckets)[:60]:
        each = [np.log((own[g] * total / raw[g] + mass) / (sum(own.values()) + mass)) for g in buckets[k]]
        assert found[k].llr == pytest.approx(np.mean(each) if each else 0.0)


def test_trusted_texts_are_the_same_beyond_a_broadcast(ready, sf, monkeypatch):
    docs, labels = (ready.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels"))
    sent = sorted(r.text or "" for r in quality_rules.trusted_texts(docs, labels).collect())
    monkeypatch.setattr(quality_rules, "BROADCAST_KEYS", 0)
    assert sent == sorted(r.text or "" for r in quality_rules.trusted_texts(docs, labels).collect()) and len(sent) > 10


def test_rules_on_odd_rows(odd_docs, no_docs, odd_rows):
    found = quality_rules.apply_rules(odd_docs, odd_docs.filter("doc_id = 4").select("text"))
    rows = found.collect()
    assert len(rows) == len(odd_rows) and {"row", "fp", "_key"} <= set(found.columns)
    for r in rows:
        words = spaced_words(r.text)
        assert r.n_words == len(words) and r.word_chars == sum(map(len, words))
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_rules.apply_rules(no_docs, no_docs.select("text")).count() == 0
    without = quality_rules.apply_rules(odd_docs, no_docs.select("text"))
    assert {r.kept == (not r.base_failed) for r in without.collect()} == {True}


def test_rules_separate_labelled_documents(ready, sf):
    found = queries.QUERIES["op1_quality_rules"](ready, "/root/testdata/sf0.01")
    labels = ready.read.parquet("/root/testdata/sf0.01/labels.parquet")
    shares = dict(found.join(labels, "doc_id").filter("NOT base_failed").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int"))).collect())
    assert shares[1] > 0.99 and shares[0] < 0.1


# --- decontamination --------------------------------------------------------------------------
def brute_hits(docs, items, size=10):
    windows = {}
    for name, text in items:
        words = LETTERS.findall(lowered(text))
        for k in range(max(len(words) - size + 1, 1) if words else 0):
            windows.setdefault(tuple(words[k : k + size]), set()).add(str(name))
    out = []
    for key, text in docs:
        words = LETTERS.findall(lowered(text))
        hit, found = set(), set()
        for length in {len(w) for w in windows}:
            for k in range(len(words) - length + 1):
                names = windows.get(tuple(words[k : k + length]))
                if names:
                    hit |= set(range(k, k + length))
                    found |= names
        out.append((key, len(words), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_contamination_equals_brute_force(ready, odd_docs, odd_rows, block_bytes):
    items = [(1, odd_rows[3][1]), (2, "two"), (3, None), (4, ""), (5, "alpha beta gamma alpha"), (6, "É ñandú é"),
             (7, odd_rows[3][1] + " and more words than that to make another few windows"), (8, "two")]
    benchmark = ready.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(odd_docs, benchmark, block_bytes=block_bytes)
    rows = found.select("doc_id", "leak_words", decontaminate.hit_words().alias("hit"), "leak_items").collect()
    assert sorted(map(lambda r: (r.doc_id, r.leak_words, r.hit, list(r.leak_items)), rows), key=str) == brute_hits(odd_rows, items)


def test_contamination_of_the_test_tables(ready, sf, texts):
    items = [tuple(r) for r in ready.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = queries.QUERIES["op2_decontaminate"](ready, sf).collect()
    expected = {key: (n, hit, names) for key, n, hit, names in brute_hits(texts.items(), items)}
    for r in rows:
        n, hit, names = expected[r.doc_id]
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(names), digest, hit > 0)
    assert len(rows) == len(texts) and any(r.contaminated for r in rows)


def test_no_benchmark_or_no_documents(ready, odd_docs, no_docs, odd_rows):
    none = ready.createDataFrame([], "item_id long, text string")
    assert decontaminate.remove_contaminated(odd_docs, none).count() == len(odd_rows)
    some = ready.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.remove_contaminated(no_docs, some).count() == 0


# --- personal data ----------------------------------------------------------------------------
def brute_spans(text):
    text, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and pii.luhn(digits.encode()):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return pii.joined(found)


@pytest.fixture(scope="module")
def private_docs(ready):
    random = np.random.default_rng(4)
    parts = [*"0123456789.@+-() ab\n", "é", "+1 (555) 123-4567", "1.2.3.4", "a@b.c", "4111 1111 1111 1111", "300.1.1.1"]
    rows = [(i, "".join(random.choice(parts, random.integers(0, 60)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "9" * 30000), (1003, "1." * 20000 + "x@" * 3000), (1004, "call (212) 555-0147 now")]
    rows += [(2000 + i, f"word after word, reach me at +1 ({200 + i}) 555-{1000 + i} or x{i}@mail.example.com please") for i in range(40)]
    return ready.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_base_spans_equal_the_patterns(ready, private_docs):
    field = pii.train_field(private_docs)
    for r in pii.find_personal_data(private_docs, field).collect():
        assert r.base_found == brute_spans(r.text), r.text[:200]
        base, full = set(filter(None, r.base_found.split(","))), set(filter(None, r.found.split(",")))
        assert base <= full
        spans = sorted(tuple(map(int, s.split(":")[1:])) for s in full - base)
        assert all(a < b <= len(r.text or "") for a, b in spans)
        if r.doc_id == 1004:
            assert "phone:5:19" in full


def test_field_learns_other_writings_and_leaves_numbers(ready, private_docs):
    field = pii.train_field(private_docs)
    for text, kind in ((b"at 212-555-0147 today", "phone"), (b"on 2024-01-02 we", None), (b"version 4.0.1 of", None),
                       (b"in 12,345,678 cases", None), (b"plain words only", None)):
        found = pii.added_spans(field, text, [], [(0, len(text))])
        assert [k for k, _, _ in found] == ([kind] if kind else [])


def test_best_segmentation_is_the_best_of_all(ready):
    """The dynamic program against all ways to cut a short window."""
    random = np.random.default_rng(2)
    window = pii.Window(b"tel 212 555-0147 4111111111111111")
    lattice = [(i, j, window.features(i, j)) for i, j in window.candidates()]
    names = {kind + f for _, _, features in lattice for f in features for kind in pii.KINDS}
    for _ in range(20):
        field = pii.Field({n: float(random.normal()) for n in sorted(names)})
        edges = [(i, j, kind, field._score(kind, f) - pii.MARGIN) for i, j, f in lattice for kind in pii.KINDS]

        def best(at):
            if at == window.n:
                return 0.0
            rest = best_of[at + 1] + field.weights.get(field._outside(window, at), 0.0)
            return max([rest, *(s + best_of[j] for i, j, _, s in edges if i == at)])

        best_of = {}
        for at in range(window.n, -1, -1):
            best_of[at] = best(at)
        chosen = field.best(window)
        inside = {k for _, i, j in chosen for k in range(i, j)}
        score = sum(next(s for a, b, k, s in edges if (k, a, b) == c) for c in chosen) + sum(
            field.weights.get(field._outside(window, k), 0.0) for k in range(window.n) if k not in inside)
        assert score == pytest.approx(best_of[0])


def test_personal_data_of_nothing(ready, odd_docs, no_docs, odd_rows):
    assert pii.find_personal_data(no_docs, pii.train_field(no_docs)).count() == 0
    found = pii.find_personal_data(odd_docs, pii.train_field(odd_docs))
    assert found.count() == len(odd_rows)
    assert {r.base_found for r in found.filter("doc_id = 11").collect()} == {"email:85:100,phone:101:118"}


def test_personal_data_contract(ready, sf, texts):
    rows = queries.QUERIES["op3_personal_data"](ready, sf).collect()
    for r in rows:
        base = brute_spans(texts[r.doc_id])
        kinds = [s.split(":")[0] for s in base.split(",")] if base else []
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds.count(k) for k in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert len(rows) == len(texts)


# --- pairwise ranking -------------------------------------------------------------------------
def test_ranking_prefers_the_good_of_each_pair():
    random = np.random.default_rng(1)
    good = random.random(400) < 0.8
    rows = random.normal(size=(400, 5)) + np.outer(good, [2.0, 0, 0, -1.0, 0])
    ranking = ranker.fit_pairs(rows, good)
    worth, scores = ranking.worth(rows), ranking.scores(rows)
    assert (worth[good][:, None] > worth[~good][None, :]).mean() > 0.9
    assert abs(((scores < ranker.CUT).mean()) - (~good).mean()) < 0.02  # cut at the quantile
    assert ((scores >= ranker.CUT) == (worth >= ranking.cut)).all()


@pytest.mark.parametrize("good", [[], [True, True], [False, False]])
def test_ranking_without_pairs(good):
    ranking = ranker.fit_pairs(np.zeros((len(good), len(ranker.MEASURES))), np.array(good, bool))
    scores = ranking.scores(np.zeros((3, len(ranker.MEASURES))))
    assert ((scores >= ranker.CUT) == (good != [False, False])).all() and ((0 <= scores) & (scores <= 1)).all()


def test_quality_scores_hold_out(ready):
    folder = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op8_quality_ranker"](ready, folder).collect()
    quality = {r.doc_id: r.quality for r in ready.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(r.held_out == (remainder(r.doc_id) == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in quality]
    good = np.array([r.score for r in held if quality[r.doc_id] == 1])
    poor = np.array([r.score for r in held if quality[r.doc_id] == 0])
    assert (good[:, None] > poor[None, :]).mean() > 0.97


def test_quality_of_odd_rows(ready, odd_docs, no_docs, odd_rows):
    labels = ready.createDataFrame([(4, 1, 0), (4, 1, 0), (7, 0, 0), (9, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    ranking = ranker.classifier(odd_docs, labels)
    scores = [r.quality_score for r in ranker.score_quality(odd_docs, ranking).collect()]
    assert len(scores) == len(odd_rows) and all(0 <= s <= 1 for s in scores)
    assert ranker.score_quality(no_docs, ranker.classifier(no_docs, labels)).count() == 0
