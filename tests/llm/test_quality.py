"""Quality classifier and quality rules."""

import os
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymark.llm import quality_classifier
from tallymark.llm.common import WORDS
from tallymark.llm.quality_classifier import classify, descend, features, scaled
from tallymark.llm.quality_rules import PRIOR, RIGHT, ROUNDS, agreed, measures, quality_rules, rules
from tests.llm.helpers import EDGES, documents

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels"))
    rows = classify(spark, docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_labels_that_are_held_out_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels"))
    docs = docs.where("doc_id < 300")
    turned = labels.selectExpr(
        "doc_id", "case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - quality else quality end as quality")
    one, two = ({r.doc_id: r.score for r in classify(spark, docs, x).collect()} for x in (labels, turned))
    assert one == two


def test_scores_of_edge_rows(spark):
    docs = documents(spark, EDGES)
    labels = spark.createDataFrame([(1, 1), (2, 0), (9, 1), (14, 0), (None, 1), (3, None), (999, 1)],
                                   "doc_id long, quality int")
    rows = classify(spark, docs, labels).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4, 5)}) == 1
    none = classify(spark, docs, labels.limit(0)).collect()
    assert {round(r.score, 6) for r in none} == {0.5}
    assert classify(spark, docs.limit(0), labels).count() == 0


def test_a_repeated_id_is_one_training_row_and_every_part_has_some(spark, monkeypatch):
    seen = []
    real = quality_classifier.written
    monkeypatch.setattr(quality_classifier, "written", lambda df, label: seen.append(real(df, label)) or seen[-1])
    docs = spark.createDataFrame([(i % 200, f"text {i} of words {i % 7}") for i in range(4000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] * 3, "doc_id long, quality int")
    quality_classifier.fit(docs, labels, rows=60)
    parts = {r.part: r["count"] for r in seen[0].groupBy("part").count().collect()}
    assert sum(parts.values()) == 60 and sorted(parts) == list(range(quality_classifier.PARTS))


def test_descent_reaches_the_optimum_of_the_dual():
    """Against projected gradient steps on the same dual, taken until nothing moves."""
    rng = np.random.default_rng(5)
    ratios = rng.standard_normal(20)
    rows = [np.unique(rng.integers(0, 20, 6)) for _ in range(40)]
    signs = np.where(rng.random(40) < 0.5, 1.0, -1.0)
    x = np.zeros((40, 21))
    for i, on in enumerate(rows):
        x[i, on], x[i, -1] = scaled(ratios, on), 1
    q = (x * signs[:, None]) @ (x * signs[:, None]).T
    alpha = np.zeros(40)
    for _ in range(200_000):
        alpha = np.clip(alpha - (q @ alpha - 1) / 60, 0, 1)
    best = alpha @ q @ alpha / 2 - alpha.sum()
    weights = descend(rows, signs, ratios, cost=1.0, epochs=2000)
    primal = weights @ weights / 2 + np.maximum(0, 1 - signs * (x @ weights)).sum()
    assert abs(primal + best) < 1e-2  # no gap between the two problems


def test_descent_separates_what_can_be_separated():
    rng = np.random.default_rng(1)
    ratios = rng.standard_normal(50)
    rows = [np.unique(rng.integers(0, 50, 8)) for _ in range(60)]
    signs = np.where(rng.random(60) < 0.5, 1.0, -1.0)
    rows = [np.union1d(r, [0 if s > 0 else 1]) if s > 0 else np.setdiff1d(np.union1d(r, [1]), [0])
            for r, s in zip(rows, signs)]
    ratios[0], ratios[1] = 3.0, -3.0
    weights = descend(rows, signs, ratios, cost=100.0, epochs=200)
    margins = np.array([weights[r] @ scaled(ratios, r) + weights[-1] for r in rows])
    assert (np.sign(margins) == signs).mean() > 0.95


def test_features_of_nothing():
    assert len(features(None)) == len(features("")) == len(features(" \n")) == 0
    assert len(features("a")) > 0


def test_shapes_are_of_whole_words():
    prose, mixed = "本" * 100, "本" * 64 + "、0{}A本" * 9
    assert len(np.setxor1d(features(prose), features(mixed))) > 2  # more than the words' own hashes
    assert len(np.setxor1d(features(prose), features("本" * 101))) == 2  # a run has one sign


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab #|\n\t\x0bé\x85", max_size=60))
def test_measures(text):
    words = WORDS.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    inside = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    assert measures(text)[:5] == (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
                                  len(lines) - len(set(lines)), len(inside))


def test_estimate_finds_accurate_rules():
    rng = np.random.default_rng(2)
    good = rng.random(5000) < 0.8
    right = np.array([0.95, 0.9, 0.9, 0.6])
    votes = np.where(rng.random((5000, 4)) < right, np.where(good, 1, -1)[:, None], np.where(good, -1, 1)[:, None])
    patterns, where, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    kept = agreed(patterns, counts.astype(float))[where.reshape(-1)] >= 0.5
    assert (kept == good).mean() > 0.94


def test_the_verdict_is_that_of_a_plain_estimate_over_all_rows(spark):
    """The same model estimated row by row, without patterns: equal posteriors and verdicts."""
    names = list(rules())
    got = quality_rules(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    votes = np.array([[r[n] for n in names] for r in got])
    share, right = PRIOR, {0: np.full(len(names), RIGHT[0]), 1: np.full(len(names), RIGHT[1])}
    p = np.full(len(got), share)
    for _ in range(ROUNDS):
        last = p.copy()
        for i, v in enumerate(votes):
            good, bad = share, 1 - share
            for j, vote in enumerate(v):
                if vote:
                    good *= right[1][j] if vote > 0 else 1 - right[1][j]
                    bad *= right[0][j] if vote < 0 else 1 - right[0][j]
            p[i] = good / (good + bad)
        share = (p.sum() + 1) / (len(p) + 2)
        for kind, weight, sign in ((0, 1 - p, -1), (1, p, 1)):
            for j in range(len(names)):
                heard = weight[votes[:, j] != 0].sum()
                right[kind][j] = (weight[votes[:, j] == sign].sum() + 4 * RIGHT[kind]) / (heard + 4)
        right[0] = np.maximum(right[0], 1 - right[1])
        if np.abs(p - last).max() < 1e-9:
            break
    assert np.allclose(p, [r.p_good for r in got], atol=1e-6)
    assert [r.kept for r in got] == [bool(x >= 0.5 and not r.base_failed) for x, r in zip(p, got)]


def test_rules_on_edge_rows(spark):
    rows = quality_rules(documents(spark, EDGES)).collect()
    assert len(rows) == len(EDGES)
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept is not None and not (r.kept and r.base_failed)
    assert all(not r.kept for r in rows if r.doc_id in (3, 4, 5))
    assert quality_rules(documents(spark, [])).count() == 0


def test_rules_keep_good_documents(spark):
    rows = quality_rules(spark.read.parquet(f"{SF_DIR}/documents.parquet")).join(
        spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id").where("not base_failed").collect()
    assert np.mean([r.kept for r in rows if r.quality == 1]) > 0.98
    assert np.mean([r.kept for r in rows if r.quality == 0]) < 0.2
