"""Operators in DataFrame functions: against SQL on the given tables, and on edge rows."""

import os

import pytest
from pyspark.sql import functions as F

from tallymark.llm.line_chunks import chunks_of, line_dedup
from tallymark.llm.mixing import copies, mix
from tallymark.llm.queries import ORACLES, QUERIES
from tallymark.llm.url_lists import url_filter
from tests.compare import differences, reference_connection
from tests.llm.helpers import EDGES, LINES, documents

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_agrees_with_sql(spark, key):
    problem, _ = differences(spark, reference_connection(SF_DIR), QUERIES[key], ORACLES[key], SF_DIR)
    assert problem is None, problem


def test_no_python_runs_in_native_operators(spark):
    docs = documents(spark, EDGES)
    for frame in (line_dedup(docs), mix(docs)):
        plan = frame._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_line_chunks_cover_the_text_and_resist_shifts(spark):
    frame = documents(spark, [(1, LINES, "a"), (2, "new line\n" + LINES, "a")]).select(
        F.col("doc_id"), chunks_of(F.col("text")).alias("c"))
    one, two = (r.c for r in frame.orderBy("doc_id").collect())
    assert "\n".join("\n".join(c) for c in one) == LINES
    assert one[1:] == two[-len(one) + 1:]


def test_line_dedup_of_edge_rows(spark):
    got = {(r.doc_id, r.text, r.n_removed) for r in line_dedup(documents(spark, EDGES)).collect()}
    texts = {i: (t, n) for i, t, n in got}
    assert texts[9] == (LINES, 0)  # the first stays
    assert texts[10][1] > 0 and len(texts[10][0].split("\n")) == 13 - texts[10][1]
    assert texts[3] == (None, 0) and texts[4] == ("", 0) and texts[5] == (" \n\t ", 0)
    whole = line_dedup(documents(spark, EDGES))
    assert whole.count() == len(EDGES) and whole.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_line_dedup_within_a_document_and_of_blank_lines(spark):
    text = "\n".join(["a b", "c d", "e f", "g h"] * 6)
    r = line_dedup(documents(spark, [(1, text, None), (2, "\n\n\n\n\n", None), (3, "\n\n\n\n\n", None)])).collect()
    got = {x.doc_id: (x.n_removed, x.text) for x in r}
    assert got[1][0] > 0 and got[2] == (0, "\n" * 5) == got[3]


def test_folded_line_dedup_takes_later_copies_whole(spark):
    texts = ["\n".join(f"text {t} says {i * i} in line {i}" + "\n" * (i % 3 == t % 3) for i in range(2 + t % 9))
             for t in range(40)]
    rows = [(i, t, "a") for i, t in enumerate(texts * 3)] + [(200, "before\n" + texts[8] + "\nafter", "a")]
    plain, fold = ({r.doc_id: (r.text, r.n_removed) for r in line_dedup(documents(spark, rows), fold=f).collect()}
                   for f in (False, True))
    assert all(fold[i] == (t, 0) for i, t in enumerate(texts))
    assert all(fold[i][0] == "" for i in range(40, 120)) and any(plain[i][0] for i in range(40, 120))
    assert all(fold[i][1] >= plain[i][1] for i in fold)
    assert fold[200][0].startswith("before") and fold[200][0].endswith("after") and fold[200][1] > 0


def test_folded_line_dedup_of_edge_rows(spark):
    odd = [(20, "\n\n", "a"), (21, "\n\n", "a"), (22, "one line", "a"), (23, "one line", "a"), (24, LINES + "\n\nend", "a")]
    got = line_dedup(documents(spark, [*EDGES, *odd]), fold=True).collect()
    texts = {r.doc_id: (r.text, r.n_removed) for r in got}
    assert len(got) == len(EDGES) + len(odd)
    assert texts[9] == (LINES, 0) and texts[3] == (None, 0) and texts[4] == ("", 0) and texts[5] == (" \n\t ", 0)
    assert texts[20] == texts[21] == ("\n\n", 0) and texts[22] == texts[23] == ("one line", 0)
    assert texts[10][1] > 0 and texts[24][1] > 0 and texts[24][0].endswith("end")


def test_mix_of_edge_rows(spark):
    docs = documents(spark, EDGES)
    rows = mix(docs).collect()
    assert len(rows) == len(EDGES) and sorted(map(str, rows)) == sorted(map(str, mix(docs).collect()))
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    for (size, target), taken in by.items():
        assert target <= 2 * size and abs(sum(taken) - target) < 1 + 1e-9 * target
    sizes = sum({s for s, _ in by})
    assert abs(sum(t for _, t in by) - 1.5 * sizes) < 1e-6 * sizes


def test_resharing_stops_at_twice_the_size(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(10, "a"), (1000, "b"), (10, "c"), (100, None)])]
    got = {r.source_size: r.target for r in mix(documents(spark, rows)).collect()}
    assert got[10] == 20 and got[100] == 200 and got[1000] == pytest.approx(1.5 * 1120 - 240)


def test_heavier_documents_are_taken_more_often(spark):
    rows = [(i, "w " * 50 if i % 2 else " ".join(f"w{j}" for j in range(50)), "a") for i in range(2000)]
    got = mix(documents(spark, rows), weights=(1,), share=0.3).where("taken > 0").collect()
    assert sum(r.doc_id % 2 == 0 for r in got) > 0.8 * len(got)


def test_copies_take_what_the_mix_says(spark):
    docs = documents(spark, EDGES)
    mixed = mix(docs, keep=docs.columns)
    taken = mixed.agg(F.sum("taken")).first()[0]
    words = copies(mixed).select(F.sum(F.size(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))))
    assert words.first()[0] == taken


def test_urls_as_of_the_fetch(spark):
    events = spark.createDataFrame([
        ("bad.com", "block", "add", 100), ("bad.com", "block", "remove", 200), ("bad.com", "block", "add", 300),
        ("bad.com", "block", "add", 300), ("bad.com/good", "allow", "add", 0), ("both.org", "block", "add", 5),
        ("both.org", "allow", "add", 5), ("odd.net", "block", "add", 7), ("odd.net", "block", "remove", 7),
        (None, "block", "add", 1), ("x.com", "block", None, 1)], "entry string, list string, action string, at long")
    asked = [
        (1, "http://www.bad.com/p", 99, False), (2, "https://sub.bad.com", 100, True), (3, "http://bad.com/", 200, False),
        (4, "http://bad.com:80/x?q", 10**9, True), (5, "http://BAD.com/good/x", 150, False), (6, "http://both.org/", 5, True),
        (7, "http://odd.net/", 9, False), (8, None, 150, False), (9, "", 150, False), (10, "http://bad.com/", None, False),
        (11, "http://notbad.com/", 150, False), (None, "http://bad.com/a", 150, True)]
    captures = spark.createDataFrame([(i, u, t, "e") for i, u, t, _ in [*asked, asked[1]]],
                                     "page_id long, url string, fetched_at long, entry string")
    got = {r.page_id: (r.copies, r.blocked) for r in url_filter(captures, events).collect()}
    assert got == {i: (2 if i == 2 else 1, b) for i, _, _, b in asked}
    assert url_filter(captures.limit(0), events).count() == 0
    assert not url_filter(captures, events.limit(0)).where("blocked").count()


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert line_dedup(empty).count() == 0 and mix(empty).count() == 0


def test_list_entries_and_captures_of_any_time(spark):
    """Seconds, milliseconds, microseconds and times before 1970 in one table, against plain loops."""
    times = [-10**15, -5, 0, 100, 10**9, 10**12, 10**15, 2**61]
    long_url = "http://a.com/" + "x/" * 300 + "y" * 50_000
    urls = ["http://a.com/p/q", "https://www.b.a.com/", "http://c.org", "none", None, long_url]
    captures = [(i, u, t) for i, (u, t) in enumerate((u, t) for u in urls for t in [*times, None])]
    events = [("a.com", "block", "add", 0), ("a.com", "block", "remove", 10**12), ("a.com", "block", "add", 10**15),
              ("b.a.com", "allow", "add", -10**15), ("c.org", "block", "add", 10**12), ("c.org", "block", "remove", 10**12),
              ("a.com/p", "allow", "add", 100), ("a.com/x", "block", "add", -5), ("a.com", "block", "add", 5)]
    got = {r.page_id: r for r in url_filter(
        spark.createDataFrame(captures, "page_id int, url string, fetched_at bigint"),
        spark.createDataFrame(events, "entry string, list string, action string, at bigint")).collect()}
    assert len(got) == len(captures)
    for i, url, t in captures:
        active = set()
        for entry, name, action, at in sorted(events, key=lambda e: (e[3], e[2])):
            if t is not None and at <= t:
                (active.add if action == "add" else active.discard)((entry, name))
        bare = (url or "").split("://")[-1].removeprefix("www.")
        host = bare.split("/")[0]
        hits = [(len(e), name == "block", e) for e, name in active if "." in bare and (
            host == e or host.endswith("." + e) or ("/" in e and (bare + "/").startswith(e + "/")))]
        best = max(hits, default=None)
        assert (got[i].n_active, got[i].entry, got[i].blocked) == (
            len(hits), best and best[2], bool(best and best[1])), (url, t)


def test_a_hot_source_is_mixed_in_many_ranges(spark):
    """Texts of one word repeated have the least weight: their keys used to share one bucket."""
    docs = documents(spark, [(i, "word " * (1 + i % 50), "a") for i in range(2000)] + [(5000, "x y", "b")])
    rows = mix(docs).collect()
    size = sum(1 + i % 50 for i in range(2000))
    hot = [r for r in rows if r.doc_id < 5000]
    assert len(rows) == 2001 and abs(sum(r.taken for r in hot) - hot[0].target) < 1
    assert hot[0].source_size == size and all(r.taken <= 2 * r.size for r in rows)
