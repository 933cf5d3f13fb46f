"""Marks of trainees: points added and taken, kept between 0 and 10, and four counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.folds import apply_step, clamped_steps
from tallymark.operators.joins import null_safe_join

# The actions, their points, and the mark needed to pass.
POINTS = {"visit_lecture": 1, "do_homework": 2, "miss_lecture": -1, "miss_homework": -2}
COUNTERS = {
    "visit_lecture": "visited_lectures", "do_homework": "done_home_tasks",
    "miss_lecture": "missed_lectures", "miss_homework": "missed_home_tasks",
}
LOWEST, HIGHEST, PASSING_GRADE = 0, 10, 8


def points() -> Column:
    change = F.lit(0)
    for action, n in POINTS.items():
        change = F.when(F.col("action") == action, n).otherwise(change)
    return change.cast("bigint")


def score_changes(actions: DataFrame) -> DataFrame:
    """``actions(trainee, at, seq, action)`` -> per trainee the mark's step and the counters.

    Every counter adds the points of its action, so the two for missed work go below 0.
    """
    marked = actions.withColumn("_points", points())
    steps = clamped_steps(marked, ["trainee"], [F.col("at"), F.col("seq")], F.col("_points"), LOWEST, HIGHEST)
    sums = marked.groupBy("trainee").agg(*[
        F.sum(F.when(F.col("action") == action, F.col("_points")).otherwise(0)).alias(counter)
        for action, counter in COUNTERS.items()])
    return null_safe_join(steps, sums, ["trainee"])


def with_verdict(scores: DataFrame) -> DataFrame:
    return scores.withColumn("passed", F.col("mark") >= PASSING_GRADE)


def trainee_scores(actions: DataFrame) -> DataFrame:
    mark = apply_step(F.lit(LOWEST).cast("bigint")).alias("mark")
    return with_verdict(score_changes(actions).select("trainee", mark, *COUNTERS.values()))
