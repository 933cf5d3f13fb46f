"""Best-fit packing of token sequences by vector bin packing.

Documents become pieces of at most `capacity` tokens. Each bin has three residual capacities:
tokens, documents and attention cost (the sum of squared piece lengths). Pieces come longest
first; a piece goes to the bin that fits under every constraint and has the largest weighted dot
product of residual and demand, or the smallest weighted norm of what would remain.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymark.llm.common import forget_others, written
from tallymark.llm.token_counts import byte_symbols, unassigned

PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


@lru_cache(maxsize=2)
def byte_tokenizer(path: str) -> tiktoken.Encoding:
    """The tokenizer of a byte-level .json file; tiktoken gives the same ids several times faster.

    Identifiers of such a file follow the order of its merges, which is what tiktoken calls ranks;
    the file's special strings become their ids wherever they stand, as is the library's default.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte_of = {c: b for b, c in enumerate(byte_symbols())}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(map(byte_of.__getitem__, word)): i
             for word, i in spec["model"]["vocab"].items() if word not in special}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=special)


@lru_cache(maxsize=2)
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def ids_of(tokens: tiktoken.Encoding, text: str, end_id: int) -> np.ndarray:
    if unassigned(text):  # the two libraries' Unicode tables may differ there
        ids = np.array(library(tokens.name).encode(text, add_special_tokens=False).ids, "<u4")
    else:
        ids = tokens.encode_to_numpy(text, allowed_special="all")
    return np.append(ids, end_id).astype("<u4")


def pieces_of(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Token pieces of at most `capacity`; only longer documents are cut, their first piece short."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        forget_others()
        tokens = byte_tokenizer(path)
        for batch in batches:
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = ids_of(tokens, text or "", end_id)
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                rows += [(i, p, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                         for p, (a, b) in enumerate(zip(edges, edges[1:]))]
            at, piece, start, length, crc = map(list, zip(*rows)) if rows else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, {PIECES}")


def best_fit(lengths: np.ndarray, capacity: int, max_docs: int, max_cost: float,
             weights: tuple[float, float, float], score: str) -> np.ndarray:
    """Bin numbers of pieces that come longest first; every bin keeps within all three limits."""
    limits = np.array([capacity, max_docs, max_cost], dtype=float)
    least = int(lengths.min()) if len(lengths) else 0
    residual = np.empty((64, 3))  # of open bins
    number = np.empty(64, dtype=np.int64)
    n, made = 0, 0
    out = np.empty(len(lengths), dtype=np.int64)
    w = np.asarray(weights, dtype=float)
    for i, length in enumerate(lengths):
        need = np.array([length, 1, float(length) ** 2])
        rest = residual[:n] - need
        fits = np.flatnonzero((rest >= 0).all(axis=1))
        if len(fits):
            if score == "dot":
                value = -((residual[fits] / limits) @ (w * need / limits))
            else:
                value = ((rest[fits] / limits) ** 2) @ w
            at = fits[np.argmin(value)]
        else:
            if n == len(residual):
                residual, number = np.resize(residual, (2 * n, 3)), np.resize(number, 2 * n)
            residual[n], number[n] = limits, made
            at, made, n = n, made + 1, n + 1
        out[i] = number[at]
        residual[at] -= need
        if residual[at, 0] < least or residual[at, 1] < 1 or residual[at, 2] < least * least:
            n -= 1  # nothing fits any more: the last open bin takes its place
            residual[at], number[at] = residual[n], number[n]
    return out


def pack(pieces: DataFrame, capacity: int = 1024, max_docs: int | None = None,
         max_cost: float | None = None, weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
         score: str = "norm", group_rows: int = 4096) -> DataFrame:
    """`pieces` with sequence_id and offset.

    Pieces are dealt by a hash to groups of about `group_rows`, alike ones too, and each group
    is packed by itself: a group leaves about one sequence partly filled, one in a thousand. All
    rows are packed whatever their number. Limits left out do not bind.
    """
    max_docs = max_docs or capacity
    max_cost = max_cost or float(capacity) ** 2
    if max_docs < 1 or max_cost < capacity ** 2 or capacity < 1:
        raise ValueError("a sequence must have room for one piece of full length")
    if score not in ("norm", "dot"):
        raise ValueError(f"unknown score {score}")
    groups = max(1, -(-pieces.count() // group_rows))

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32"],
                                  ascending=[False, True, True, True], kind="stable")
        group = int(frame["bucket"].iloc[0])
        bins = best_fit(frame["length"].to_numpy(), capacity, max_docs, max_cost, weights, score)
        frame["sequence_id"] = bins + group * 2**32
        frame["offset"] = frame.groupby(bins)["length"].cumsum() - frame["length"]
        return frame.drop(columns="bucket")

    # with a row's place in the table, so that rows that are alike don't meet in one group
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return (pieces.withColumn("bucket", bucket).groupBy("bucket")
            .applyInPandas(packed, f"{schema}, sequence_id bigint, offset bigint"))


def best_fit_packing(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2,
                     **options) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone: one piece of length 1. Repeated rows and ids are
    packed as often as they come, null ids stay null, an empty table gives no rows, further
    columns are not read. Ties go to the oldest open sequence.
    """
    return pack(written(pieces_of(docs, path, capacity, end_id), "pieces"), capacity, **options)
