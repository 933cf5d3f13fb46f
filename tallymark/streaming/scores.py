"""Running trainee marks over a stream of actions, with Spark's keyed state.

A trainee's state is the mark and counters of the actions that are settled, and the few that are not:
an action is pending until the watermark has passed its time, since one from before it may still
arrive. Settled actions are folded in the order of (at, seq) and forgotten. What is written after every
batch with news of a trainee is the mark with the pending actions folded on top, so it is right for
all actions so far, whatever batches they came in, as long as none is later than the watermark allows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallymark.operators.scores import COUNTERS, HIGHEST, LOWEST, POINTS, with_verdict

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TOTALS = "mark long, " + ", ".join(f"{c} long" for c in COUNTERS.values()) + ", actions long"
OUTPUT = f"trainee long, {TOTALS}"
MARK = Row(*[field.split()[0] for field in OUTPUT.split(", ")])
NOTHING = (LOWEST, *[0] * len(COUNTERS), 0)
PLACE = {action: i for i, action in enumerate(COUNTERS, 1)}


def after(totals: tuple, action: str) -> tuple:
    """Mark, counters and number of actions after one more action."""
    points = POINTS.get(action, 0)
    new = list(totals)
    new[0] = min(max(totals[0] + points, LOWEST), HIGHEST)
    if action in PLACE:
        new[PLACE[action]] += points
    new[-1] += 1
    return tuple(new)


def folded(totals: tuple, rows: list[tuple]) -> tuple:
    for _, _, action in rows:
        totals = after(totals, action)
    return totals


class Marks(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.settled = handle.getValueState("settled", TOTALS)
        self.pending = handle.getListState("pending", "at long, seq long, action string")

    def settle(self, rows: list[tuple], watermark_ms: int) -> tuple[tuple, list[tuple]]:
        """Fold what the watermark has passed; the new totals and the rows still pending."""
        rows.sort(key=lambda r: (r[0], r[1] is not None, r[1] or 0))
        known = self.settled.get() if self.settled.exists() else NOTHING
        done = [r for r in rows if r[0] < watermark_ms * 1000]
        totals, rest = folded(tuple(known), done), rows[len(done):]
        if done:
            self.settled.update(totals)
        if rest:
            self.pending.put(rest)
            self.handle.registerTimer(rest[-1][0] // 1000 + 1)  # when all of them are settled
        else:
            self.pending.clear()
        return totals, rest

    def waiting(self) -> list[tuple]:
        return [tuple(r) for r in self.pending.get()] if self.pending.exists() else []

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [(r.us, r.seq, r.action) for r in rows]
        totals, rest = self.settle(self.waiting() + new, timerValues.getCurrentWatermarkInMs())
        yield MARK(*key, *folded(totals, rest))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Only the state shrinks: the mark that was written had all these actions in it."""
        if rows := self.waiting():
            self.settle(rows, timerValues.getCurrentWatermarkInMs())
        return iter(())


def stream_scores(actions: DataFrame, path: str, checkpoint: str, delay: str = "2 hours") -> StreamingQuery:
    """Append the mark of every trainee with new actions, batch by batch, to the table below ``path``.

    ``actions(trainee, at, seq, action)``. An action without a time counts as the earliest and has to
    come before the watermark gets going, which starts at 1970; one later than ``delay`` allows is dropped. State and
    progress are in ``checkpoint``; a run that is started anew goes on where the last one ended. A batch
    holds the new actions of a trainee in one task: bound it at the source (maxFilesPerTrigger).
    """
    spark = actions.sparkSession
    timed = actions.select(
        "trainee", "seq", "action",
        F.coalesce(F.col("at").cast("timestamp"), F.timestamp_millis(F.lit(1))).alias("at"))
    changes = (
        timed.withWatermark("at", delay).withColumn("us", F.unix_micros("at"))
        .groupBy("trainee").transformWithState(Marks(), OUTPUT, "Append", "EventTime")
    )
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # lists and timers need it; read when the query starts
    try:
        return (
            changes.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        )
    finally:
        spark.conf.set(PROVIDER, before)


def current_scores(spark: SparkSession, path: str) -> DataFrame:
    """The last mark written of every trainee: the one with the most actions in it."""
    written = spark.read.schema(OUTPUT).parquet(path)
    columns = [c for c in written.columns if c not in ("trainee", "actions")]
    newest = written.groupBy("trainee").agg(F.max_by(F.struct(*columns), "actions").alias("_row"))
    return with_verdict(newest.select("trainee", "_row.*"))
