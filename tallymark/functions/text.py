"""Text expressions. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates words. Letters, digits and underscore of any script make
# up a word; Java's own \W knows ASCII only.
NOT_A_WORD = r"[^\p{L}\p{N}_]+"
ASCII_WORD = r"[a-z]+"


def find_substring(haystack: str | Column, needle: str | Column) -> Column:
    """0-based place of the needle, -1 when absent, 0 for an empty needle."""
    hay = F.col(haystack) if isinstance(haystack, str) else haystack
    return F.when(needle == "", 0).otherwise(F.instr(hay, needle) - 1)


def words(text: str | Column) -> Column:
    """Lower-case words of any script, without empty strings."""
    folded = F.lower(text)
    return F.filter(F.split(folded, NOT_A_WORD), lambda w: w != "")


def ascii_words(text: str | Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(ASCII_WORD), F.lit(0))


def brackets_balance(text: str | Column) -> Column:
    """Whether every ``)`` closes an earlier ``(`` and none stays open.

    Everything but the brackets is removed first, so the fold runs over a few characters
    of a text, not all of them.
    """
    brackets = F.split(F.regexp_replace(text, r"[^()]", ""), "")
    start = F.struct(F.lit(0).alias("open"), F.lit(True).alias("ok"))

    def step(state: Column, char: Column) -> Column:
        change = F.when(char == "(", 1).when(char == ")", -1).otherwise(0)
        now = state["open"] + change
        return F.struct(now.alias("open"), (state["ok"] & (now >= 0)).alias("ok"))

    return F.aggregate(brackets, start, step, lambda s: s["ok"] & (s["open"] == 0))


def combinations(lists: Column) -> Column:
    """All strings made of one item of each list, in list order (an array of arrays)."""
    return F.aggregate(
        lists, F.array(F.lit("")),
        lambda done, items: F.flatten(
            F.transform(done, lambda start: F.transform(items, lambda item: F.concat(start, item)))))


def title_case(text: str | Column) -> Column:
    """Upper case after every non-letter; ``initcap`` only does so after white space."""
    column = F.col(text) if isinstance(text, str) else text
    runs = F.regexp_extract_all(column, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.concat(
        F.upper(F.substring(r, 1, 1)), F.lower(F.substr(r, F.lit(2))))), "")
