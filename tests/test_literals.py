"""Small literal cases with known answers."""

import pytest
from pyspark.sql import functions as F

from tallymark.functions.numbers import division_report, unit_price
from tallymark.functions.text import (
    ascii_words, brackets_balance, combinations, find_substring, title_case, words)
from tallymark.operators.joins import earliest_pair_with_sum
from tallymark.operators.lists import common_prefix, list_chunks
from tallymark.operators.scores import trainee_scores
from tallymark.operators.sets import distinct_keep_order
from tallymark.operators.textindex import top_words
from tallymark.operators.windows import first_duplicate
from tallymark.plans.joins_and_aggregates import merge_sum
from tallymark.plans.scalars import transpose
from tallymark.plans.windows_and_sets import top_keys
from tallymark.sources.generate import linspace, series


def numbered(spark, values, kind="int"):
    return spark.createDataFrame([(0, i, v) for i, v in enumerate(values)], f"k int, pos int, v {kind}")


@pytest.mark.parametrize("values, target, expected", [
    ([2, 7, 11, 15], 9, (2, 7)), ([3, 3], 6, (3, 3)), ([2], 2, None), ([-1, -1], 2, None),
    ([3, 2, 4], 6, (2, 4)), ([5, 1, 5, 9], 10, (5, 5)), ([9, 5, 1, 5], 10, (9, 1)), ([4, 4, 4], 8, (4, 4)),
])
def test_pair_with_sum(spark, values, target, expected):
    found = earliest_pair_with_sum(numbered(spark, values), ["k"], "v", "pos", target).collect()
    assert [(r.first_value, r.second_value) for r in found] == ([expected] if expected else [])


@pytest.mark.parametrize("values, expected", [([2, 1, 5, 3, 3, 2, 4], 3), (list(range(1, 11)), -1), ([], None)])
def test_first_duplicate(spark, values, expected):
    found = first_duplicate(numbered(spark, values), ["k"], "v", "pos").collect()
    assert [r.first_duplicate for r in found] == ([] if expected is None else [expected])


def test_merge_sum(spark):
    a = spark.createDataFrame([("a", 123), ("b", 23), ("c", 0)], "key string, v int")
    b = spark.createDataFrame([("a", 1), ("b", 11), ("d", 99)], "key string, v int")
    assert dict(map(tuple, merge_sum([a, b]).collect())) == {"a": 124, "b": 34, "c": 0, "d": 99}


def test_combinations(spark):
    lists = F.array(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("c"), F.lit("d")))
    assert spark.range(1).select(combinations(lists)).first()[0] == ["ac", "ad", "bc", "bd"]


def test_top_keys(spark):
    data = [("a", 500), ("b", 5874), ("c", 560), ("d", 400), ("e", 5874), ("f", 20)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "pos int, key string, v int")
    assert [r.key for r in top_keys(df, "key", "v", "pos", 3).collect()] == ["b", "e", "c"]
    assert top_keys(df.limit(0), "key", "v", "pos", 3).collect() == []


def test_lists_by_key(spark):
    pairs = [("yellow", 1), ("blue", 2), ("yellow", 3), ("blue", 4), ("red", 1)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "pos int, key string, v int")
    out = {r.key: r.vs for r in list_chunks(df, ["key"], [F.col("pos")], "v", "vs").collect()}
    assert out == {"yellow": [1, 3], "blue": [2, 4], "red": [1]}


@pytest.mark.parametrize("strings, prefix", [
    (["flower", "flows"], "flow"), (["sun", "recap"], ""), (["abf", "abc", "acd"], "a"), (["one"], "one"), ([], "")])
def test_common_prefix(spark, strings, prefix):
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    assert df.agg(common_prefix("s")).first()[0] == prefix


def test_find_substring(spark):
    cases = [("Killer", 5), ("l", 7), ("Miller", -1), ("", 0)]
    for needle, expected in cases:
        found = spark.range(1).select(find_substring(F.lit("Star Killer"), F.lit(needle))).first()[0]
        assert found == expected, needle


def test_brackets(spark):
    cases = {"((()))": True, ")()": False, "())(()": False, "": True, "a (b) c": True, "(": False, "a\n(\n)": True}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert dict(map(tuple, df.select("t", brackets_balance("t")).collect())) == cases


def test_division(spark):
    cases = {("5", "0"): "Can't divide by zero", ("12", "aba"): "Entered value is wrong", ("12", "6"): "2",
             ("10", "3"): "3.333", ("-7", "2"): "-3.500", ("", "2"): "Entered value is wrong"}
    df = spark.createDataFrame(list(cases), "a string, b string")
    assert {(r.a, r.b): r.x for r in df.select("a", "b", division_report("a", "b").alias("x")).collect()} == cases


def test_unit_price(spark):
    df = spark.createDataFrame([(1, 100.0, 3.0), (2, 100.0, 0.0), (3, 100.0, None)], "i int, p double, a double")
    assert [r[0] for r in df.orderBy("i").select(unit_price("p", "a")).collect()] == [33.33, -1.0, -1.0]


def test_words_of_any_script(spark):
    df = spark.createDataFrame([("Étre, l'été_2 — obi-van!  ÜBER",)], "t string")
    assert df.select(words("t")).first()[0] == ["étre", "l", "été_2", "obi", "van", "über"]
    assert df.select(ascii_words("t")).first()[0] == ["tre", "l", "t", "obi", "van", "ber"]


def test_title_case(spark):
    df = spark.createDataFrame([("o'neil mac-donald",)], "t string")
    assert df.select(title_case("t")).first()[0] == "O'Neil Mac-Donald"


def test_distinct_keeps_the_first_place(spark):
    values = ['"1"', '"2"', "1", "1", "2", "2"]
    out = distinct_keep_order(numbered(spark, values, "string"), "v", "pos").orderBy("first_pos")
    assert [r.v for r in out.collect()] == ['"1"', '"2"', "1", "2"]


def test_top_words_ties_by_first_appearance(spark):
    docs = spark.createDataFrame([(1, "b The a the"), (2, "a b c 1c")], "doc_id long, text string")
    stop = spark.createDataFrame([("the",)], "word string")
    assert [tuple(r) for r in top_words(docs, stop, 3).collect()] == [("b", 2), ("a", 2), ("c", 2)]


ACTIONS = {"+l": "visit_lecture", "+h": "do_homework", "-l": "miss_lecture", "-h": "miss_homework"}


@pytest.mark.parametrize("moves, mark", [
    (["+h"] * 5, 10), (["+h"] * 5 + ["-l"] * 2, 8), (["+h", "-h"] * 5 + ["+h", "+h", "+l"], 5),
    (["-h", "-h", "+l"], 1), (["+h"] * 9 + ["-h"], 8)])
def test_scores(spark, moves, mark):
    df = spark.createDataFrame([(7, i, i, ACTIONS[m]) for i, m in enumerate(moves)],
                               "trainee long, at long, seq long, action string")
    (out,) = trainee_scores(df).collect()
    assert out.mark == mark and out.passed == (mark >= 8)
    assert out.missed_lectures == -moves.count("-l") and out.done_home_tasks == 2 * moves.count("+h")


def test_transpose_twice_is_the_same(spark):
    m = spark.createDataFrame([(r, c, r * 10 + c) for r in range(3) for c in range(2)], "row int, col int, value int")
    flipped = transpose(m)
    assert {(r.row, r.col): r.value for r in flipped.collect()}[(1, 2)] == 21
    assert sorted(map(tuple, transpose(flipped).select("row", "col", "value").collect())) == sorted(map(tuple, m.collect()))


def test_series_and_linspace(spark):
    assert [r.x for r in series(spark, 1, 10, 3).collect()] == [1, 4, 7, 10]
    assert [r.x for r in series(spark, 5, 1, -2).collect()] == [5, 3, 1]
    assert [r.x for r in linspace(spark, 0, 1, 5).collect()] == [0.0, 0.25, 0.5, 0.75, 1.0]
    assert [r.x for r in linspace(spark, 0, 1, 5, endpoint=False).collect()] == pytest.approx([0, 0.2, 0.4, 0.6, 0.8])
    assert [r.x for r in linspace(spark, 3, 9, 1).collect()] == [3.0]
