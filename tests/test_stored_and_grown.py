"""Facts stored by key, and an index that grows."""

import re

import pytest

from tallymark.operators.bitmaps import SPAN, lists_to_bitmaps, numbers_of, to_bitmaps
from tallymark.operators.indexlog import IndexLog
from tallymark.operators.textindex import build_index, query_index, query_words
from tallymark.plans import QUERIES, account_reports, rental_reports, sales_reports

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key, moved", [
    ("r11c_top300_stored", ()), ("r13c_pct_vs_previous_stored", ()), ("r14b_weekly_stored", ()),
    ("r19b_last_rental_stored", ()),
    ("r10c_quarter_crosstab_stored", ("o_orderkey",)), ("r18d_most_popular_stored", ("o_orderkey",))])
def test_stored_lines_meet_their_orders_without_a_shuffle(spark, monkeypatch, key, moved):
    """Neither side moves; where customers restrict the orders, those are dealt as the lines are stored."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    plans = []
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    # the report of rentals writes its rows by ranges: what it is given is looked at
    monkeypatch.setattr(account_reports, "latest_rentals_by_title", lambda film, rentals, *_: rentals)
    for reports in (rental_reports, sales_reports, account_reports):
        monkeypatch.setattr(reports, "settled", lambda df, label: plans.append(plan_of(df)) or df)
    for name in names:
        spark.conf.set(name, "-1")
    try:
        plans.append(plan_of(QUERIES[key](spark, SF_DIR)))
    finally:
        for name in names:
            spark.conf.unset(name)
    plan = "\n".join(plans)
    assert "Bucketed: true" in plan and "hashpartitioning(l_orderkey" not in plan
    assert ("hashpartitioning(o_orderkey" in plan) == bool(moved)


TEXTS = [(i, f"common word{i % 7} only{i}") for i in range(40)] + [(70_000, "far common"), (41, ""), (42, None)]
SCHEMA = "doc_id long, text string"


def lists(index):
    return sorted((r.word, r.block, r.n_docs, list(r.doc_ids)) for r in index.collect())


@pytest.fixture()
def log(spark, tmp_path):
    return IndexLog(spark, str(tmp_path / "log"), block=10)


def built(spark, rows):
    return lists(build_index(spark.createDataFrame(rows, SCHEMA), 10))


def test_loads_with_changed_and_repeated_ids_equal_one_build(spark, log):
    assert lists(log.index()) == []
    log.add(spark.createDataFrame(TEXTS[:20], SCHEMA))
    later = TEXTS[20:] + [(3, "changed text"), (3, "changed again"), (5, TEXTS[5][1]), (None, "nobody")]
    log.add(spark.createDataFrame(later, SCHEMA))
    want = [r for r in TEXTS if r[0] != 3] + [(3, "changed text")]
    assert lists(log.index()) == built(spark, want)
    asked = query_words(spark.createDataFrame([("q", "common word3"), ("r", "changed")], "query_id string, query string"))
    got = {(r.query_id, r.doc_id) for r in query_index(log.index(), asked).collect()}
    assert got == {("q", i) for i in range(40) if i % 7 == 3 and i != 3} | {("r", 3)}


def test_deletions_and_merges(spark, log):
    log.add(spark.createDataFrame(TEXTS, SCHEMA))
    log.delete(spark.createDataFrame([(2,), (70_000,), (999,), (None,)], "doc_id long"))
    left = [r for r in TEXTS if r[0] not in (2, 70_000)]
    assert lists(log.index()) == built(spark, left)
    log.add(spark.createDataFrame([(2, "back again")], SCHEMA))
    want = [*left, (2, "back again")]
    assert lists(log.index()) == built(spark, want) and len(log.segments()) == 3
    log.merge(small=5)  # the two newest; the deletion must still hold for the large one
    assert lists(log.index()) == built(spark, want) and len(log.segments()) == 2
    log.merge()
    assert lists(log.index()) == built(spark, want) and len(log.segments()) == 1
    again = IndexLog(spark, log.path, block=10)
    again.delete(spark.createDataFrame([(i,) for i, _ in want], "doc_id long"))
    again.merge()
    assert lists(again.index()) == []


def test_a_load_that_fails_changes_nothing(spark, log):
    log.add(spark.createDataFrame(TEXTS[:5], SCHEMA))
    before = lists(log.index())
    bad = spark.range(3).selectExpr("id as doc_id", "raise_error('no') as text").selectExpr("doc_id", "cast(text as string) as text")
    with pytest.raises(Exception, match="no"):
        log.add(bad)
    assert lists(log.index()) == before and len(log.segments()) == 1


def plain_lists(rows, block):
    """Of documents whose texts are split at blanks; a repeated id stands as often as it has the word."""
    found = {}
    for i, text in rows:
        for word in set((text or "").lower().split()):
            found.setdefault((word, None if i is None else i // block), []).append(i)
    return [(w, b, len(ids), sorted(i for i in ids if i is not None)) for (w, b), ids in found.items()]


@pytest.mark.parametrize("block", [10, 2_048, 5_000, 65_536])
def test_lists_of_runs_repeated_and_missing_ids(spark, block):
    """Blocks of several runs, ids below zero and beyond doubles' reach, one id twice, ids that are null."""
    ids = [*range(0, 9_000, 7), *range(3, 9_000, 11), -1, -2_049, 1 << 40, None, None]
    rows = [(i, f"common w{n % 5} Only{n}") for n, i in enumerate(ids)] + [(7, None), (8, "")]
    got = [tuple(r) for r in build_index(spark.createDataFrame(rows, SCHEMA), block).collect()]
    key = lambda r: (r[0], r[1] is None, r[1] or 0)
    assert sorted(got, key=key) == sorted(plain_lists(rows, block), key=key)


def test_postings_of_a_block_meet_without_a_shuffle_of_words(spark, log, monkeypatch):
    """Texts alone are dealt for an index or a load, and a merge makes its lists once."""
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    docs = spark.createDataFrame(TEXTS, SCHEMA)
    assert not re.search(r"hashpartitioning\(word#\d+, block", plan_of(build_index(docs, 10)))
    log.add(docs)
    log.add(docs.limit(5))
    made, merged = [], IndexLog._merged
    monkeypatch.setattr(IndexLog, "_merged", lambda self, segments: made.append(merged(self, segments)) or made[-1])
    assert "array_except" not in plan_of(log.index()) and "flatten" not in plan_of(log.index())
    made.clear()
    written, write = [], IndexLog._write
    monkeypatch.setattr(IndexLog, "_write", lambda self, lists, ids=None: written.append(ids) or write(self, lists, ids))
    log.merge()
    assert len(made) == 1 and written == [None]
    assert lists(log.index()) == built(spark, TEXTS)


def test_a_merge_of_large_blocks_in_shares(spark, tmp_path):
    log = IndexLog(spark, str(tmp_path / "large"), block=5_000)
    rows = [(i, f"common w{i % 9} only{i}") for i in range(6_000)]
    log.add(spark.createDataFrame(rows, SCHEMA))
    log.add(spark.createDataFrame([(i, "other common") for i in range(0, 6_000, 3)], SCHEMA))
    log.delete(spark.createDataFrame([(i,) for i in range(0, 6_000, 6)], "doc_id long"))
    want = [(i, t) if i % 3 else (i, "other common") for i, t in rows if i % 6]
    assert lists(log.index()) == sorted(plain_lists(want, 5_000))


def test_lists_become_bitmaps_as_their_numbers_do(spark):
    """Unordered, repeated, negative and null numbers, spans' edges, null and empty lists, one key in two rows."""
    rows = [("a", [5, SPAN - 1, SPAN, 5, -1, None]), ("a", [6, 1 << 40]), ("b", []), ("c", None), (None, [-SPAN, -SPAN - 1])]
    df = spark.createDataFrame(rows, "k string, ids array<long>")
    got = lists_to_bitmaps(df, ["k"], "ids")
    each = df.selectExpr("k", "explode(ids) as id").filter("id is not null")
    as_rows = lambda d: sorted((str(r.k), r.span, bytes(r.bits)) for r in d.collect())
    assert as_rows(got) == as_rows(to_bitmaps(each, ["k"], "id")) != []
    numbers = {(r.k, r.n) for r in numbers_of(got, "n").collect()}
    assert numbers == {(k, i) for k, ids in rows for i in ids or () if i is not None}


def test_a_batch_of_queries_sorts_no_numbers_of_lists(spark):
    """Lists are read as lists: their ids are not made rows before they are bitmaps."""
    docs = [(i, f"common w{i % 3} only{i}") for i in range(300)]
    index = build_index(spark.createDataFrame(docs, SCHEMA), 100)
    asked = query_words(spark.createDataFrame(
        [("q", "common W1"), ("r", "only7 w2"), ("s", "only7 w1")], "query_id string, query string"))
    found = query_index(index, asked)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "explode(doc_ids" not in plan and "bitmap_construct_agg" not in plan
    assert {(r.query_id, r.doc_id) for r in found.collect()} == {("q", i) for i in range(1, 300, 3)} | {("s", 7)}
