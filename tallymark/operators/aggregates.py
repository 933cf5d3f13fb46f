"""A user's own aggregate: a state per group, made where the rows are, merged and finished.

The caller gives four functions, as an engine's CREATE AGGREGATE does: the state of a group without rows,
the state after a row, one state out of two, and the result of a state. States are combined in
every task before they are shuffled, so a group that holds most of the rows sends one state per task
(and one more whenever a task has met MAX_GROUPS groups). States are Python objects that can be pickled.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

MAX_GROUPS, BATCH = 50_000, 4096


def aggregate_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str], *, start: Callable[[], Any],
                 step: Callable[..., Any], merge: Callable[[Any, Any], Any], finish: Callable[[Any], Any],
                 name: str, kind: str) -> DataFrame:
    """One row per group: ``keys`` and ``finish(state)`` as column ``name`` of the Spark type ``kind``.

    ``step(state, *values)`` is called with the values of ``columns``; ``merge`` has to be associative and
    must not mind the order of its arguments, as tasks end in any order. What depends on the order of rows keeps
    the order in its state. NULL keys are a group; without ``keys`` there is one group, if there are rows.
    """
    n = len(keys)
    fields = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)

    def handed(groups: dict[tuple, Any], types: list[pa.DataType], last: Callable[[Any], Any],
               last_type: pa.DataType | None, last_name: str) -> Iterator[pa.RecordBatch]:
        rows = list(groups.items())
        for at in range(0, len(rows), BATCH):
            part = rows[at:at + BATCH]
            arrays = [pa.array([key[i] for key, _ in part], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([last(s) for _, s in part], last_type)],
                                             names=[*keys, last_name])

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, Any] = {}
        types: list[pa.DataType] = []
        for batch in batches:
            types = batch.schema.types[:n]
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                key = row[:n]
                groups[key] = step(groups[key] if key in groups else start(), *row[n:])
            if len(groups) >= MAX_GROUPS:
                yield from handed(groups, types, pickle.dumps, pa.binary(), "__state")
                groups = {}
        yield from handed(groups, types, pickle.dumps, pa.binary(), "__state")

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a group come one after another; one group's state is held at a time."""
        key, state, done, types = None, None, {}, []
        for batch in batches:
            types = batch.schema.types[:n]
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                other = pickle.loads(row[n])
                if key is not None and row[:n] == key:
                    state = merge(state, other)
                else:
                    if key is not None:
                        done[key] = state
                    key, state = row[:n], other
            if len(done) >= BATCH:
                yield from handed(done, types, finish, None, name)
                done = {}
        if key is not None:
            done[key] = state
        yield from handed(done, types, finish, None, name)

    states = df.select(*keys, *columns).mapInArrow(begun, f"{fields}__state binary")
    dealt = states.repartition(*keys).sortWithinPartitions(*keys) if keys else states.coalesce(1)
    return dealt.mapInArrow(merged, f"{fields}`{name}` {kind}")
