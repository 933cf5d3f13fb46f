"""Own aggregates, whole-frame descriptions, lateral table functions, bitmaps, observed counts."""

import pathlib
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.operators import aggregates
from tallymark.operators.aggregates import aggregate_by
from tallymark.operators.bitmaps import in_all, numbers_of, to_bitmaps
from tallymark.operators.frames import describe_frame
from tallymark.operators.lists import common_prefix
from tallymark.operators.textindex import top_words
from tallymark.plans import QUERIES
from tallymark.plans.rental_reports import most_popular_in_lists
from tallymark.sources.files import read_words

SF_DIR = "/root/testdata/sf0.001"


def test_states_are_merged_whatever_task_they_come_from(spark, monkeypatch):
    """A hot key, a NULL key, more groups than a task keeps at once."""
    rows = [(None if i % 50 == 0 else 0 if i % 3 else i % 40, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(7)
    for limit in (50_000, 2):
        monkeypatch.setattr(aggregates, "MAX_GROUPS", limit)
        got = aggregate_by(df, ["k"], ["v"], start=list, step=lambda s, v: s + [v], merge=lambda a, b: a + b,
                           finish=lambda s: ",".join(map(str, sorted(s))), name="all", kind="string")
        want = {}
        for k, v in rows:
            want.setdefault(k, []).append(str(v))
        assert {r.k: r["all"] for r in got.collect()} == {k: ",".join(v) for k, v in want.items()}


def test_an_aggregate_without_keys_and_without_rows(spark):
    df = spark.range(1, 21, 1, 5)
    options = {"start": lambda: 1, "step": lambda s, v: s * v % 97, "merge": lambda a, b: a * b % 97,
               "finish": lambda s: s, "name": "p", "kind": "bigint"}
    product = 1
    for i in range(1, 21):
        product = product * i % 97
    assert [r.p for r in aggregate_by(df, [], ["id"], **options).collect()] == [product]
    assert aggregate_by(df.limit(0), [], ["id"], **options).collect() == []
    assert aggregate_by(df.limit(0), ["id"], ["id"], **options).count() == 0


def test_a_task_sends_one_state_of_a_hot_key(spark):
    df = spark.range(0, 10_000, 1, 4).select(F.lit(1).alias("k"), "id")
    got = aggregate_by(df, ["k"], ["id"], start=lambda: 0, step=lambda s, v: s + v, merge=lambda a, b: a + b,
                       finish=lambda s: s, name="s", kind="bigint")
    assert got.first().s == sum(range(10_000))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("MapInArrow")  # one below it, where the rows are


@pytest.mark.parametrize("ranges", [2, 1024])
def test_quantiles_of_all_columns(spark, monkeypatch, ranges):
    from tallymark.operators import frames
    monkeypatch.setattr(frames, "RANGES", ranges)
    rng = random.Random(2)
    rows = [(i, rng.choice([1, 2, 2, 3]), rng.gauss(0, 1e-9), None if i % 3 else rng.uniform(-1e12, 1e12), None, 7,
             float("nan") if i % 2 else float(i)) for i in range(777)]
    schema = "a int, b int, c double, d double, e double, f int, g double"
    df = spark.createDataFrame(rows, schema)
    points = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r.column_name: r for r in describe_frame(df, list("abcdefg"), points).collect()}
    for i, c in enumerate("abcdefg"):
        x = np.array([r[i] for r in rows if r[i] is not None and r[i] == r[i]], dtype=float)
        assert got[c]["count"] == len(x)
        for name, p in points.items():
            assert got[c][name] == (pytest.approx(np.quantile(x, p), rel=1e-12, abs=1e-24) if len(x) else None)
    empty = describe_frame(df.limit(0), ["a"], points).first()
    assert empty["count"] == 0 and empty.p50 is None


def test_bitmaps_hold_any_whole_numbers(spark):
    rng = random.Random(4)
    sets = {s: {rng.randrange(-70_000, 70_000) for _ in range(3000)} | {-1, 0, 32_767, 32_768, -32_768, 1 << 40} for s in range(3)}
    df = spark.createDataFrame([(s, n) for s, ns in sets.items() for n in ns for _ in range(1 + n % 2)], "s int, n bigint")
    bits = to_bitmaps(df, ["s"], "n")
    assert {(r.s, r.n) for r in numbers_of(bits, "n").collect()} == {(s, n) for s, ns in sets.items() for n in ns}
    shared = [r.n for r in numbers_of(in_all(bits, [], F.lit(3)), "n").collect()]
    assert sorted(shared) == sorted(sets[0] & sets[1] & sets[2])


def test_common_starts(spark):
    groups = {1: ["abcde", "abcxy", "abc"], 2: ["", "a"], 3: ["same"], 4: ["x" * 1000 + "a", "x" * 1000 + "b"], 5: ["q", "r"],
              6: [None], 7: ["ab", "abcdefgh"]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k int, v string")
    got = {r.k: r.p for r in df.groupBy("k").agg(common_prefix("v").alias("p")).collect()}
    assert got == {1: "abc", 2: "", 3: "same", 4: "x" * 1000, 5: "", 6: "", 7: "ab"}


def test_a_lateral_function_becomes_a_join(spark):
    frame = QUERIES["o02b_table_function_lateral"](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_counts_come_from_the_write(spark):
    """What was written is not read again: the result has its counts already."""
    for key in ("j04b_delete_by_expression", "j07_add_column_backfill"):
        plan = QUERIES[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan


def test_a_list_of_stop_words_from_a_file(spark, tmp_path):
    """The words of a file with blanks, capitals and empty lines; of equally frequent words the first seen wins."""
    (tmp_path / "stop.txt").write_text("The\n  and \n\nOF\n", encoding="utf-8")
    docs = spark.createDataFrame(
        [(2, "The cat, and the dog; of cats: CAT"), (1, "dog's day of the cat. Zebra zebra"), (3, None), (4, "the and of")],
        "doc_id long, text string")
    found = top_words(docs, read_words(spark, str(tmp_path / "stop.txt")), 4).collect()
    assert [(r.word, r.n) for r in found] == [("cat", 3), ("dog", 2), ("zebra", 2), ("s", 1)]


@pytest.mark.parametrize("missing", ["tiktoken", "corpus_pipeline", "tallymark.llm"])
def test_the_entry_survives_what_is_missing(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = pathlib.Path(__file__).parent.parent
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[0]) == len(QUERIES) == int(done.stdout.split()[1])


def test_popular_films_of_lists_that_overlap(spark):
    rentals = spark.createDataFrame(
        [("A", 1), ("A", 1), ("A", 2), ("B", 2), ("B", 3), ("C", 1)], "country string, film_id int")
    film = spark.createDataFrame([(i, f"f{i}", "G", 2000) for i in (1, 2, 3)],
                                 "film_id int, title string, rating string, release_year int")
    lists = spark.createDataFrame([("x", "A"), ("x", "B"), ("y", "A"), ("y", "A"), ("z", "nowhere"), (None, "C")],
                                  "list_id string, country string")
    got = {(r.list_id, r.country, r.film, r._score) for r in most_popular_in_lists(rentals, film, lists).collect()}
    assert got == {("x", "A", "f1", 2), ("x", "B", "f2", 1), ("x", "B", "f3", 1), ("y", "A", "f1", 2), (None, "C", "f1", 1)}
    assert most_popular_in_lists(rentals, film, lists.limit(0)).count() == 0
