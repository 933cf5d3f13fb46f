"""Quality rules as weak supervision.

Each rule votes for a document, against it, or abstains. Expectation-maximisation estimates how
accurate each rule's votes are and how many documents are good, without any labels; a document is
kept if its posterior probability of being good is one half at least.

Votes are counted per pattern first: there are at most three to the power of the number of rules,
whatever the number of documents, and the estimate works on these counts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import WORDS, written

SYMBOLS = re.compile(r"[#*$%&|<>]")
ODD = re.compile(r"[^\x20\x09-\x0D#*$%&|<>]*[#*$%&|<>][^\x20\x09-\x0D]*")  # a word with a symbol
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_upper_words", "n_odd_words")
ROUNDS = 200
#: What the estimate starts from: the share of good documents, and of every rule the share of its
#: votes that are right on bad documents (which mostly break one rule of many) and on good ones.
PRIOR, RIGHT = 0.85, (0.4, 0.98)


class _Numbers(dict):
    """A number for each word of one text."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def measures(text: str | None) -> tuple[int, ...]:
    """BASE, the lines that have a word, the words in capitals and those with a symbol."""
    if not text:
        return (0,) * len((*BASE, *MORE))
    words = WORDS.findall(text)
    n = len(words)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    repeated = 0
    if n > 3:
        numbers = _Numbers()
        at = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
        _, pair = np.unique(at[:-1] * len(numbers) + at[1:], return_inverse=True)
        _, window, times = np.unique(pair[:-1] * len(numbers) + at[2:], return_inverse=True, return_counts=True)
        often = times[window] > 1
        inside = np.zeros(n, dtype=bool)
        for i in range(3):
            inside[i:n - 2 + i] |= often
        repeated = int(inside.sum())
    return (n, sum(map(len, words)), len(SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated,
            len(lines), sum(len(w) > 1 for w in words if w.isupper()),
            len(ODD.findall(text)))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, BASE and MORE per document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            got = list(map(list, zip(*map(measures, texts), strict=True))) if texts else [[]] * len((*BASE, *MORE))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(g, pa.int64()) for g in got]], names=["doc_id", *BASE, *MORE])

    columns = ", ".join(f"{c} bigint" for c in (*BASE, *MORE))
    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, {columns}")


def band(value: Column, bad: Column, good: Column) -> Column:
    """-1 where `bad`, 1 where `good`, else an abstention, 0; a value that is unknown abstains."""
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes: 1 for, -1 against, 0 abstains."""
    n = F.when(F.col("n_words") > 0, F.col("n_words"))
    length = F.col("word_chars") / n
    symbols = F.col("n_symbols") / n
    odd = F.col("n_odd_words") / n
    lines = F.when(F.col("n_lines") > 1, F.col("n_dup_lines") / F.col("n_lines"))
    repeats = F.col("n_repeat_words") / n
    capitals = F.col("n_upper_words") / n
    return {
        "enough_words": band(n, n < 50, n >= 80),
        "word_length": band(length, (length < 2.5) | (length > 12), (length >= 3.5) & (length <= 9)),
        "few_symbols": band(symbols, symbols > 0.3, symbols < 0.1),
        "plain_words": band(odd, odd > 0.3, odd < 0.1),
        "few_equal_lines": band(lines, lines > 0.5, lines < 0.1),
        "few_capitals": band(capitals, capitals > 0.4, capitals < 0.15),
        "few_repeats": band(repeats, repeats > 0.4, repeats < 0.15),
    }


def agreed(votes: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Posterior probability of good for each pattern of votes (rows), `counts` of which occur.

    Expectation-maximisation of a model in which rules err independently, each with a rate of its
    own per class; a rule's abstentions say nothing. Four votes as at the start are added to each.
    """
    good_share = PRIOR
    right = np.repeat(np.array(RIGHT)[:, None], votes.shape[1], axis=1)
    posterior = np.full(len(votes), good_share)
    for _ in range(rounds):
        on_good = np.where(votes > 0, np.log(right[1]), np.where(votes < 0, np.log(1 - right[1]), 0)).sum(axis=1)
        on_bad = np.where(votes < 0, np.log(right[0]), np.where(votes > 0, np.log(1 - right[0]), 0)).sum(axis=1)
        odds = on_good - on_bad + math.log(good_share / (1 - good_share))
        before, posterior = posterior, 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        good, bad = counts * posterior, counts * (1 - posterior)
        good_share = (good.sum() + 1) / (counts.sum() + 2)
        spoken = votes != 0
        for kind, share, sign in ((0, bad, -1), (1, good, 1)):
            heard = (share[:, None] * spoken).sum(axis=0)
            right[kind] = ((share[:, None] * (votes == sign)).sum(axis=0) + 4 * RIGHT[kind]) / (heard + 4)
        right[0] = np.maximum(right[0], 1 - right[1])  # a rule is never taken for its opposite
        if np.abs(posterior - before).max(initial=0) < 1e-9:
            break
    return posterior


def judged(table: DataFrame, votes: dict[str, Column], least: float = 0.5) -> DataFrame:
    """`table` with the votes as columns, p_good and `good` (p_good >= least)."""
    names: Sequence[str] = list(votes)
    table = table.withColumns({k: v.cast("int") for k, v in votes.items()})
    patterns = table.groupBy(*names).agg(F.count("*").alias("n")).orderBy(*names).collect()  # 3 ** rules at most
    seen = np.array([[r[k] for k in names] for r in patterns], dtype=int).reshape(len(patterns), len(names))
    found = agreed(seen, np.array([r["n"] for r in patterns], dtype=float))
    rows = [(*map(int, v), float(p)) for v, p in zip(seen, found, strict=True)]
    schema = ", ".join(f"{k} int" for k in names) + ", p_good double"
    return (table.join(F.broadcast(table.sparkSession.createDataFrame(rows, schema)), list(names), "left")
            .withColumn("good", F.col("p_good") >= least))


def quality_rules(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, p_good, votes.

    Null, empty and wordless texts have counts of 0 and fail the base rules; every rule abstains on
    them. Repeated rows are judged alike and each counts; other columns are not
    read; an empty table gives no rows. A line is equal to an earlier one if all its characters are.
    """
    table = written(measured(docs), "rule-measures")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    votes = rules()
    return (
        judged(table, votes, least).withColumn("base_failed", failed)
        .select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & F.col("good")).alias("kept"), "p_good",
                *votes)
    )
