"""Duplicate operators against brute force."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymark.llm import shingle_join
from tallymark.llm.common import WORDS
from tallymark.llm.components import components
from tallymark.llm.embedding_dedup import embedding_components
from tallymark.llm.shingle_join import Bands, bit_sketch, cell_keys, jaccard_components, narrowed
from tallymark.llm.suffix_dedup import anchors, deep_shallow, multikey_quicksort, suffix_dedup
from tests.llm.helpers import EDGES, documents

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def least_reachable(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        i, j = find(i), find(j)
        root[max(i, j)] = min(i, j)
    return [find(i) for i in range(n)]


def near_copies(seed, bases=6, each=14):
    """Texts with from none to many words changed, cut or repeated."""
    rng, out = random.Random(seed), []
    for b in range(bases):
        base = [f"b{b}w{rng.randrange(400)}" for _ in range(rng.choice([4, 6, 9, 15, 40, 120, 400]))]
        for _ in range(each):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, len(base) // 30])):
                words[rng.randrange(len(words))] = f"n{rng.randrange(50)}"
            out.append(" ".join(words[rng.choice([0, 0, 0, 1]):]))
    return out


def brute_jaccard(texts, percent):
    sets = []
    for t in texts:
        w = WORDS.findall((t or "").translate(LOWER))
        sets.append({tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return [len(s) for s in sets], least_reachable(len(sets), pairs)


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_groups(spark, seed):
    texts = near_copies(seed) + [t for _, t, _ in EDGES]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           jaccard_components(documents(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()}
    sizes, groups = brute_jaccard(texts, 80)
    assert got == {i: (n, g) for i, (n, g) in enumerate(zip(sizes, groups, strict=True))}


def test_pairs_that_are_nearly_linked_are_not_handed_on(spark):
    """Texts of 40 words whose last five are random: no link, and no step with a row per pair."""
    rng = random.Random(3)
    same = " ".join(f"w{i}" for i in range(35))
    handed, real = {}, shingle_join.written
    for n in (150, 600):
        texts = [f"{same} {' '.join(f'x{rng.randrange(10**9)}' for _ in range(5))}" for _ in range(n)]
        counts = []
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(shingle_join, "written", lambda df, label: (
                out := real(df, label), counts.append(out.count() if label != "sketch-buckets" else 0))[0])
            got = jaccard_components(documents(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()
        assert all(r.component_id == r.doc_id for r in got) and len(got) == n
        handed[n] = max(counts)
    assert handed[600] <= 6 * handed[150]


@pytest.mark.parametrize("block, shingles", [(5, 1 << 20), (2048, 200)])
def test_jaccard_groups_in_small_blocks(spark, monkeypatch, block, shingles):
    monkeypatch.setattr(shingle_join, "BLOCK", block)
    monkeypatch.setattr(shingle_join, "BLOCK_SHINGLES", shingles)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    texts = near_copies(4, 3)
    for _ in range(60):  # a chain of texts, each near its neighbours and none near all
        base[rng.randrange(60)] = f"y{rng.randrange(10**6)}"
        texts.append(" ".join(base))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           jaccard_components(documents(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()}
    sizes, groups = brute_jaccard(texts, 80)
    assert got == {i: (n, g) for i, (n, g) in enumerate(zip(sizes, groups, strict=True))}


def test_jaccard_of_edge_rows(spark):
    got = jaccard_components(documents(spark, EDGES)).collect()
    assert len(got) == len(EDGES)
    assert {r.component_id for r in got if r.doc_id in (1, 2, 14)} == {1}
    assert {r.component_id for r in got if r.doc_id is None} <= {None, 1}
    assert jaccard_components(documents(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 2**32))
def test_linked_sets_share_a_cell_and_sketches_bound_their_difference(n, seed):
    rng, bands = np.random.default_rng(seed), Bands(80)
    a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    drop = int(rng.integers(0, len(a) // 9 + 1))
    b = np.unique(np.r_[a[drop:], rng.integers(0, 2**64, drop, dtype=np.uint64)])
    shared = len(np.intersect1d(a, b))
    if len(b) and 100 * shared >= 80 * (len(a) + len(b) - shared):
        assert np.intersect1d(cell_keys(a, bands), cell_keys(b, bands)).size
    x, y = bit_sketch(a, 1024), narrowed(bit_sketch(b, 4096), 16)
    assert np.bitwise_count(x ^ y).sum() <= len(a) + len(b) - 2 * shared


def brute_bytes(docs, length):
    seen, out = set(), {}
    for i, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if (w := data[s:s + length]) in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(w)
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not before for g, before in zip(gone, [0, *gone]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("block", [1000, 2])
def test_repeated_substrings(spark, block):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("ab cdé") for _ in range(rng.randrange(1, 40)))
    passages = ["".join(word() for _ in range(12)) for _ in range(4)]
    docs = [(i, "".join(rng.choice([word(), word(), rng.choice(passages)[rng.randrange(60):]]) for _ in range(8)))
            for i in range(60)]
    docs += [(100, "a" * 1000), (101, "a" * 150), (102, "ab" * 400), (103, None), (104, ""), (105, "a" * 99),
             (106, docs[3][1]), (107, "\0" * 300), (108, "x" + "\0" * 130 + "y")]
    rows = [(i, t, "a") for i, t in docs]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup(documents(spark, rows), block=block).collect()}
    assert got == brute_bytes(docs, 100)


def test_substrings_of_edge_rows(spark):
    got = suffix_dedup(documents(spark, EDGES)).collect()
    assert len(got) == len(EDGES)
    assert {r.n_removed for r in got if r.doc_id is None} == {0}  # the smallest id
    assert {r.n_removed > 0 for r in got if r.doc_id == 1} == {True}
    known = suffix_dedup(documents(spark, [r for r in EDGES if r[0] is not None])).collect()
    assert {r.n_removed for r in known if r.doc_id == 1} == {0}
    twice = {(r.n_removed, r.n_bytes) for r in got if r.doc_id == 2}
    assert len(twice) == 1 and all(a == b for a, b in twice)
    assert suffix_dedup(documents(spark, [])).count() == 0


@pytest.mark.parametrize("block", [1000, 2])
def test_substrings_that_rows_without_id_hold_first(spark, block):
    rng = random.Random(8)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passages = [prose(600) for _ in range(6)]
    nulls = [prose(80) + p + prose(80) for p in passages]
    rows = [(None, t) for t in [*nulls, nulls[0], nulls[0], None, ""]]
    known = [(10 + i, prose(90) + p + prose(50)) for i, p in enumerate(passages)]
    known += [(20 + i, prose(70) + p[150:400] + prose(60)) for i, p in enumerate(passages)]
    known += [(30 + i, t) for i, t in enumerate(nulls)]
    got = [r for r in suffix_dedup(documents(spark, [(i, t, "a") for i, t in rows + known]), block=block).collect()]
    # the null rows as documents before all others: what goes from the known ones is the same
    want = brute_bytes([(i - 100, t) for i, (_, t) in enumerate(rows)] + known, 100)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got if r.doc_id is not None} == {
        i: w for i, w in want.items() if i >= 0}
    assert sorted((r.n_bytes, r.n_removed) for r in got if r.doc_id is None) == sorted((len(t or ""), 0) for _, t in rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.binary(max_size=6).map(lambda b: b * 7)), min_size=1, max_size=30),
       st.sampled_from([8, 24]))
def test_deep_shallow_sorting(rows, shallow):
    group, texts = np.array([g for g, _ in rows]), [t for _, t in rows]
    order, shared = deep_shallow(group, texts, shallow)
    keys = [(int(group[i]), texts[i]) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(len(rows)))
    for n, (i, j) in enumerate(zip(order, order[1:])):
        same = next((k for k, (a, b) in enumerate(zip(texts[i], texts[j])) if a != b), min(map(len, (texts[i], texts[j]))))
        assert shared[n + 1] == (same if group[i] == group[j] else -1)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=60))
def test_multikey_quicksort(rows):
    group, words = np.array([r[0] for r in rows]), np.array([r[1:] for r in rows], dtype=np.uint64)
    start = np.argsort(group, kind="stable")
    order, begins = multikey_quicksort(words, start, np.r_[True, np.diff(group[start]) != 0])
    keys = [rows[i] for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(len(rows)))
    assert begins.tolist() == [n == 0 or a != b for n, (a, b) in enumerate(zip(keys, [None, *keys]))]


def test_anchors_depend_on_the_window_alone():
    data = random.Random(2).randbytes(500)
    _, place, first, last = anchors(data)
    assert first[0] == 0 and last[-1] == 400 and (first[1:] == last[:-1] + 1).all()
    moved = {int(p) - 7 for p in anchors(b"1234567" + data)[1]}
    assert set(place.tolist()) <= moved


def test_components_of_chains_stars_and_nulls(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(1000, i) for i in range(1001, 1300)] + [(1300, 1299), (5, 5)]
    frame = spark.createDataFrame([*edges, (None, 7), (8, None)], "a bigint, b bigint")
    got = {r.id: r.component for r in components(frame).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {i: 1000 for i in range(1000, 1301)}
    assert components(frame.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1024, 4])
def test_vectors(spark, block):
    rng = np.random.default_rng(3)
    rows, base = [], rng.standard_normal((8, 16))
    for i in range(160):
        v = base[i % 8] + rng.standard_normal(16) * rng.choice([0, 0.05, 0.12, 0.25])
        rows.append((i, int(i % 2), [float(x) for x in v * rng.choice([0.001, 1, 1e8])], "x"))
    odd = [None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0]]
    rows += [(200 + i, 0, v, "x") for i, v in enumerate(odd)] + [(300, None, rows[0][2], "x"), (301, None, rows[0][2], "x")]
    rows += [(302, 0, [1.0, 2.0], "x"), rows[0]]
    frame = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>, class string")
    good = [(n, r) for n, r in enumerate(rows) if r[1] is not None and r[2] and None not in r[2]
            and np.isfinite(r[2]).all() and np.any(r[2])]
    unit = {n: np.array(r[2]) / np.linalg.norm(r[2]) for n, r in good}
    pairs = [(a, b) for a, x in good for b, y in good if b < a and x[1] == y[1] and len(x[2]) == len(y[2])
             and unit[a] @ unit[b] >= 0.98]
    links = [sum(n in p for p in pairs) for n in range(len(rows))]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in
                 embedding_components(frame, block=block, tables=40, bits=8).collect())
    groups = least_reachable(len(rows), pairs)
    ids = [min(rows[m][0] for m in range(len(rows)) if groups[m] == g) for g in groups]
    assert got == sorted((rows[n][0], links[n], ids[n], rows[n][0] == ids[n]) for n in range(len(rows)))
    assert embedding_components(frame.limit(0)).count() == 0


def test_recall_of_the_production_parameters():
    rng = np.random.default_rng(4)
    from tallymark.llm.embedding_dedup import BITS, TABLES, signatures
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    aside = rng.standard_normal(x.shape)
    aside -= (aside * x).sum(axis=1, keepdims=True) * x
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * aside
    found = (signatures(x, TABLES, BITS) == signatures(y, TABLES, BITS)).any(axis=1)
    assert found.mean() > 0.97


def test_vectors_with_the_parameters_of_the_query(spark):
    """Planted neighbours on both sides of 0.98 at the default tables and bits, against all pairs."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal((40, 48))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    rows = []
    for i in range(1200):
        v = base[i % 40] + rng.standard_normal(48) * rng.choice([0.005, 0.015, 0.02, 0.03])
        rows.append((i, i % 3, [float(x) for x in v]))
    unit = np.array([r[2] for r in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([r[1] for r in rows])
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in embedding_components(
        spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")).collect()}
    found = sum(r.n_links for r in got.values())
    assert near.sum() > 2000 and 0.9 * near.sum() <= found <= near.sum()
    assert all(got[i].n_links <= n for i, n in enumerate(near.sum(axis=1).tolist()))
    whole = least_reachable(1200, [tuple(p) for p in np.argwhere(near).tolist()])
    assert np.mean([got[i].component_id == g for i, g in enumerate(whole)]) > 0.97
