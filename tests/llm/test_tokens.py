"""Token counts and packing against the tokenizer library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallymark.llm.packing import best_fit, best_fit_packing, byte_tokenizer, ids_of
from tallymark.llm.token_counts import WordBPE, token_counts
from tests.llm.helpers import EDGES, documents

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
COUNTER, LIBRARY, ID_LIBRARY = WordBPE(WORDS), Tokenizer.from_file(WORDS), Tokenizer.from_file(BYTES)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text_counts_and_cuts_as_the_library_does(text):
    assert COUNTER.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)
    assert list(ids_of(byte_tokenizer(BYTES), text, 2)) == [
        *ID_LIBRARY.encode(text, add_special_tokens=False).ids, 2]


def test_counts_of_edge_rows(spark):
    got = token_counts(documents(spark, EDGES), WORDS, limit=100).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (i or 0, len((t or "").encode()), n, n > 100) for i, t, _ in EDGES
        for n in [len(LIBRARY.encode(t or "", add_special_tokens=False).ids)])


@pytest.mark.parametrize("options", [{}, {"max_docs": 3}, {"max_cost": 1024.0**2, "score": "dot"},
                                     {"group_rows": 2}])
def test_packing_of_edge_rows(spark, options):
    got = best_fit_packing(documents(spark, EDGES), BYTES, **options).collect()
    ids = defaultdict(list)
    for i, text, _ in EDGES:
        ids[i].append(np.array([*ID_LIBRARY.encode(text or "", add_special_tokens=False).ids, 2], "<u4"))
    want = sorted((i or 0, p, a, b - a, zlib.crc32(x[a:b].tobytes())) for i, xs in ids.items() for x in xs
                  for cuts in [[0, *range(len(x) % 1024 or 1024, len(x) + 1, 1024)]]
                  for p, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert sorted((r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024 and len(pieces) <= options.get("max_docs", 1024)


def test_packing_is_tight():
    lengths = np.sort(np.random.default_rng(1).integers(1, 1025, 3000))[::-1]
    bins = best_fit(lengths, 1024, 1024, 1024.0**2, (1.0, 0.05, 0.05), "norm")
    assert np.bincount(bins, lengths).max() <= 1024
    assert bins.max() + 1 <= 1.02 * lengths.sum() / 1024


def test_every_limit_binds():
    bins = best_fit(np.full(40, 10), 1024, 4, 1024.0**2, (1, 1, 1), "dot")
    assert np.bincount(bins).max() == 4
    bins = best_fit(np.full(40, 100), 1024, 99, 35_000.0, (1, 1, 1), "norm")
    assert np.bincount(bins).max() == 3


def test_empty_table(spark):
    assert token_counts(documents(spark, []), WORDS).count() == 0
    assert best_fit_packing(documents(spark, []), BYTES).count() == 0


def test_alike_pieces_are_dealt_to_many_groups(spark):
    docs = spark.createDataFrame([(None, "")] * 3000 + [(1, "one two")] * 1000, "doc_id long, text string")
    got = best_fit_packing(docs, BYTES, group_rows=200).collect()
    groups = defaultdict(int)
    for r in got:
        groups[r.sequence_id // 2**32] += 1
    assert len(got) == 4000 and max(groups.values()) < 400
