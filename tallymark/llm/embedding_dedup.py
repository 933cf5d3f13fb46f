"""Embedding near-dedup: sign hashes of random hyperplanes, exact cosines, connected components.

Every vector gets `bits` signs per table; vectors of one label that agree in all signs of a table
share a bucket. Equal vectors are one class. In a bucket, blocks of classes are multiplied with
each other in double precision; a pair counts only in the first table where its signs agree. Two
vectors at a cosine of 0.98 agree in all 16 signs of a table with a chance of 0.35, and in one of
12 tables at least with 0.994; closer pairs more often.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import written
from tallymark.llm.components import components

TABLES, BITS = 12, 16
BLOCK = 1024  # classes of a bucket that are compared at once
SEED = 20


def planes(width: int, tables: int, bits: int) -> np.ndarray:
    return np.random.default_rng([SEED, width, tables, bits]).standard_normal((width, tables * bits))


def signatures(vectors: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """One number per vector and table."""
    on = (vectors @ planes(vectors.shape[1], tables, bits) >= 0).reshape(len(vectors), tables, bits)
    return on @ (1 << np.arange(bits, dtype=np.int64))


def pairs_of(x: np.ndarray, y: np.ndarray, sx: np.ndarray, sy: np.ndarray, table: int, least: float) -> np.ndarray:
    """Which rows of x and y are linked and meet in this table first."""
    near = x @ y.T >= least
    for before in range(table):
        near &= sx[:, None, before] != sy[None, :, before]
    return near


def forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges among a, b that connect what all of them connect."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    kept = []
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        if (p := find(i)) != (q := find(j)):
            root[max(p, q)] = min(p, q)
            kept.append((i, j))
    return kept


def embedding_components(vectors: DataFrame, least: float = 0.98, tables: int = TABLES, bits: int = BITS,
                         block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Only rows with equal labels link. A null label or vector, a zero vector and one with a null or
    non-finite component link with nothing, and vectors of other lengths never meet. Equal vectors,
    repeated rows too, link with each other (they need no hash). Rows that share a vec_id are rows
    of their own that lend it to their component. Other columns are not read; an empty table gives
    no rows.
    """
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & (F.size("embedding") > 0) & ~bad
                        & F.exists("embedding", lambda v: v != 0), F.lit(False))
    # 128 bits: among 10^9 vectors two different ones are taken for equal with a chance below 1e-20
    both = [F.lpad(F.hex(F.xxhash64(F.lit(half), "label", "embedding")), 16, "0") for half in (1, 2)]
    rows = rows.withColumn("usable", usable).withColumn("class", F.when(F.col("usable"), F.concat(*both)))
    table = written(rows.select("vec_id", "class", F.when(F.col("usable"), F.col("label")).alias("label"),
                                F.when(F.col("usable"), F.col("embedding")).alias("embedding")), "vectors")
    distinct = table.where("class is not null").groupBy("class", "label", "embedding").agg(
        F.count("*").alias("copies"))
    kind = distinct.schema["label"].dataType.simpleString()

    def hashed(batches):
        for frame in batches:
            frame["width"] = frame["embedding"].map(len)
            for width, part in frame.groupby("width"):
                x = np.stack(part["embedding"].to_numpy()).astype(float)
                x = x / np.abs(x).max(axis=1, keepdims=True)  # lengths of large or tiny components stay finite
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                yield pd.DataFrame({
                    "class": part["class"].to_numpy(), "label": part["label"].to_numpy(), "width": width,
                    "copies": part["copies"].to_numpy(), "unit": [u.tobytes() for u in unit],
                    "signs": list(signatures(unit, tables, bits))})

    classes = written(distinct.mapInPandas(
        hashed, f"class string, label {kind}, width int, copies bigint, unit binary, signs array<bigint>"),
        "vector-classes")
    keys = ["label", "width", "t", "sign"]
    buckets = classes.select("class", "label", "width", F.posexplode("signs").alias("t", "sign"))
    counts = buckets.groupBy(keys).agg(F.count("*").alias("many")).where("many > 1")
    parts = F.ceil(F.col("many") / block).cast("int")
    dealt = (
        buckets.join(counts, keys)
        .withColumn("own", F.pmod(F.xxhash64("class"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other"))
        .join(classes.select("class", "copies", "unit", "signs"), "class")  # vectors of shared buckets alone
        .select(*keys, "x", "y", "own", "class", "copies", "unit", "signs")
        .repartition(*keys, "x", "y").sortWithinPartitions(*keys, "x", "y")
    )

    def compared(rows: list[tuple]):
        t, x, y = rows[0][2], rows[0][4], rows[0][5]
        left = [r for r in rows if r[6] == x]
        right = left if x == y else [r for r in rows if r[6] == y]
        if not left or not right or (x == y and len(left) == 1):
            return None
        unit = lambda side: np.stack([np.frombuffer(r[9]) for r in side])
        sign = lambda side: np.array([r[10] for r in side])
        near = pairs_of(unit(left), unit(right), sign(left), sign(right), t, least)
        if x == y:
            near = np.triu(near, 1)
        a, b = np.nonzero(near)
        if not len(a):
            return None
        n, ids = len(left), np.array([r[7] for r in left + (right if x != y else [])], dtype=object)
        copies = np.array([r[8] for r in left + (right if x != y else [])])
        b = b + (n if x != y else 0)
        links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
        on = np.flatnonzero(links)
        joined = {}
        for i, j in forest(a, b, len(ids)):
            joined.setdefault(i, []).append(ids[j])
        return pd.DataFrame({"class": ids[on], "links": links[on].astype(np.int64),
                             "others": [joined.get(int(i), []) for i in on]})

    def linked(batches):
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and row[:6] != rows[0][:6]:
                    if (found := compared(rows)) is not None:
                        yield pa.RecordBatch.from_pandas(found, result, preserve_index=False)
                    rows = []
                rows.append(row)
        if rows and (found := compared(rows)) is not None:
            yield pa.RecordBatch.from_pandas(found, result, preserve_index=False)

    result = pa.schema([("class", pa.string()), ("links", pa.int64()), ("others", pa.list_(pa.string()))])
    found = written(dealt.mapInArrow(linked, "class string, links bigint, others array<string>"), "vector-links")
    groups = components(found.select(F.col("class").alias("a"), F.explode("others").alias("b")))
    per_class = (
        classes.select("class", "copies")
        .join(found.groupBy("class").agg(F.sum("links").alias("links")), "class", "left")
        .join(groups.withColumnRenamed("id", "class"), "class", "left")
        .select("class", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "class").alias("group"))
    )
    grouped = table.select("vec_id", "class").join(per_class, "class", "left")
    least_id = grouped.where("group is not null").groupBy("group").agg(F.min("vec_id").alias("least"))
    component = F.coalesce("least", "vec_id")
    return grouped.join(least_id, "group", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
