"""Byte-level BPE against the library, and the resampling against a plain form of it."""

import hashlib
import math
import re
import zlib
from array import array
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymark.llm.byte_bpe import ByteBPE, bpe_decode, bpe_encode, read_ranks, round_trip_digests
from tallymark.llm.resampling import importance_resample, least
from tests.llm.helpers import EDGES, PROSE, documents

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
MANY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
OWN = ByteBPE(RANKS, PATTERN)


def library(path):
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})


def encoded(bpe, text):
    return array("i", bpe.encode(text)).tolist()


LIBRARY = library(RANKS)
PIECES = st.sampled_from([*"abcdefgh '\n\t\x1c\x85　é日\U0001f642͸\U0002ebf0", "  ", "'s", "the", " in", "aaaa"])


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(PIECES, max_size=60).map("".join)))
def test_any_text_has_the_ids_of_the_library(text):
    ids = encoded(OWN, text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert b"".join(OWN.tokens[i] for i in ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 50255), min_size=1, max_size=6))
def test_tokens_side_by_side_are_merged_as_the_library_merges_them(ids):
    text = b"".join(OWN.tokens[i] for i in ids).decode("utf-8", "ignore")
    assert encoded(OWN, text) == LIBRARY.encode_ordinary(text)


def test_every_token_is_its_own_encoding():
    assert all(OWN.piece(token) == [rank] for rank, token in OWN.tokens.items())
    assert len(OWN.halves) == len(OWN.tokens) - 256


def test_another_vocabulary():
    own, known = ByteBPE(MANY, PATTERN), library(MANY)
    for _, text, _ in EDGES:
        assert encoded(own, text or "") == known.encode_ordinary(text or "")


def test_classes_of_characters_are_those_of_the_library():
    shown = "".join(f"a{chr(c)}1 " for c in (0x88F, 0xC5C, 0x11DE0, 0x378, 0x1C, 0x85, 0x2EBF0, 0x323B0))
    assert encoded(OWN, shown) == LIBRARY.encode_ordinary(shown)


def test_digests_of_edge_rows(spark):
    got = round_trip_digests(documents(spark, EDGES), RANKS, PATTERN).collect()
    want = []
    for i, text, _ in EDGES:
        ids = LIBRARY.encode_ordinary(text or "")
        want.append((i or 0, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted((r.doc_id or 0, *r[1:]) for r in got) == sorted(want)
    assert round_trip_digests(documents(spark, []), RANKS, PATTERN).count() == 0


def test_ids_from_elsewhere_are_decoded(spark):
    rows = spark.createDataFrame([(1, [464, 262]), (2, []), (3, None)], "doc_id int, ids array<bigint>")
    got = {r.doc_id: r.decoded for r in bpe_decode(rows, RANKS).collect()}
    assert got == {1: OWN.tokens[464] + OWN.tokens[262], 2: b"", 3: None}
    assert bpe_decode(rows.where("doc_id > 1"), RANKS).count() == 2
    with pytest.raises(Exception, match="99999"):
        bpe_decode(spark.createDataFrame([(1, [99999])], "doc_id int, ids array<int>"), RANKS).collect()


def test_text_in_another_column(spark):
    rows = spark.createDataFrame([("x", "the cat")], "name string, body string")
    assert bpe_encode(rows, RANKS, PATTERN, "name", "body").first().ids == LIBRARY.encode_ordinary("the cat")


def plain_resample(rows, target, buckets, min_words, percent):
    def found(text):
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        runs = words + [" ".join(p) for p in zip(words, words[1:])]
        return len(words), [zlib.crc32(f.encode()) % buckets for f in runs]

    s = Counter(b for _, t in rows for b in found(t)[1])
    t = Counter(b for text in target for b in found(text)[1])
    out = []
    for i, text in rows:
        words, fs = found(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets)
                                            / ((s[b] + 1) * (t.total() + buckets)))) for b in fs]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([i, len(fs), weight, score, None, words >= min_words])
    pool = sorted((r for r in out if r[5]), key=lambda r: (-r[3], math.inf if r[0] is None else r[0], r[1], r[2]))
    for rank, row in enumerate(pool[:len(pool) * percent // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


MORE = [(i, " ".join(f"word{(i * k) % 11}" for k in range(25 + i % 9)), "a") for i in range(100, 160)]
TIED = [(7, PROSE, "a")] * 9 + [(8, PROSE, "a")] * 3 + [(7, PROSE + " end", "b")] * 2


@pytest.mark.parametrize("percent", [0, 1, 25, 50, 100])
@pytest.mark.parametrize("rows", [EDGES + MORE, TIED + EDGES, []])
def test_resampling_agrees_with_its_plain_form(spark, rows, percent):
    target = [PROSE[:200], None, "", "word3 word5 and others"]
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, weight int")
    got = importance_resample(documents(spark, rows), goal, percent=percent, buckets=101)
    assert sorted(map(tuple, got.collect()), key=str) == plain_resample(
        [(i, t) for i, t, _ in rows], target, 101, 20, percent)


def test_an_empty_target(spark):
    goal = spark.createDataFrame([], "text string")
    got = importance_resample(documents(spark, MORE), goal).collect()
    assert sorted(map(tuple, got), key=str) == plain_resample([(i, t) for i, t, _ in MORE], [], 10_000, 20, 25)


@settings(max_examples=200, deadline=None)
@given(st.integers(-(1 << 62), 1 << 62), st.integers(0, 1 << 62), st.data())
def test_bisection_finds_the_least_number(low, width, data):
    goal = data.draw(st.integers(low, low + width))
    jobs = []
    assert least(low, low + width, lambda at: [jobs.append(0) or a >= goal for a in at]) == goal
    assert len(jobs) <= 16 * 17
