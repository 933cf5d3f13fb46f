"""Conversation repair against a search over all edits, written down plainly."""

import hashlib
import zlib
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymark.llm import conversations as c
from tallymark.llm.conversations import Repair, repaired_conversations, transcript_digests

SPACE = " \t\n\v\f\r"
NOTHING = hashlib.sha256(b"").hexdigest()


def next_states(state):
    """State: initials given out so far, shortened to what decides the rest."""
    return {"": "su", "s": "u", "u": "a", "a": "u"}[state]


def plain(rows):
    """Figures of one conversation, rows (turn, role, text) in order."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.rstrip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                      else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))

    @cache
    def best(i, state):
        """Least (cost, letters, lines) from row i on."""
        found = [after(i, state)]
        found += [f for f in (inserted(i, state, 2),) if f]
        return min(found)

    @cache
    def inserted(i, state, left):
        """As best, after up to `left` turns put in before row i; at least one."""
        found = []
        for new in ("user", "assistant"):
            if left and new[0] in next_states(state):
                here = [after(i, new[0])] + [f for f in (inserted(i, new[0], left - 1),) if f]
                found += [(cost + 3, "I" + audit, (f"{new}:", *lines)) for cost, audit, lines in here]
        return min(found) if found else None

    @cache
    def after(i, state):
        """best(i, state) with nothing put in before row i."""
        if i == len(rows):
            return (0, "", ()) if state in ("", "a") else (10**9, "", ())
        _, role, text = rows[i]
        more = 3 if faults[i] == "truncated" else 0
        cost, audit, lines = best(i + 1, state)
        found = [(cost + 4, "D" + audit, lines)]
        if faults[i] not in ("blank", "duplicate"):
            if role[:1] and role[:1] in next_states(state):
                cost, audit, lines = best(i + 1, role[0])
                found.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
            for new in ("user", "assistant"):
                if new[0] in next_states(state):
                    cost, audit, lines = best(i + 1, new[0])
                    found.append((cost + 3 + more, "R" + audit, (f"{new}:{text}", *lines)))
        return min(found)

    cost, audit, lines = best(0, "")
    turns = [t for t, _, _ in rows if t is not None]
    pairs = zip(rows, rows[1:])
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def in_order(rows):
    spaced = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(spaced, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(),
                                         hashlib.md5(r[2].encode()).digest()))


SYMBOLS = {"s": ("system", "."), "u": ("user", "."), "a": ("assistant", "."), "o": ("tool", "."),
           "S": ("system", ""), "U": ("user", ""), "A": ("assistant", ""), "O": ("tool", ""), "x": ("user", None)}


@settings(max_examples=600, deadline=None)
@given(st.text("suaoSUAOx", max_size=9), st.integers(1, 4))
def test_least_weights_are_the_least_cost_and_letters(symbols, step):
    rows = [(i, SYMBOLS[s][0], "" if s == "x" else f"text {i}{SYMBOLS[s][1]}") for i, s in enumerate(symbols)]
    want = plain(rows)
    tables = [c.table_of(symbols[i:i + step]) for i in range(0, len(symbols), step)]
    cost, digits = c.cheapest(c.all_joined(tables) if tables else c.table_of(""))
    assert (cost, "".join(map(c.LETTERS.__getitem__, digits))) == (want["cost"], want["audit"])


def test_long_stretches_and_short_ones_agree():
    symbols = "suauAuxoUaUSsua" * 40
    whole = c.cheapest(c.table_of(symbols[:300]))
    assert c.cheapest(c.rows_table(symbols[:300])) == whole


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Yes."),
    (2, None, "user", "first."), (2, 5, "user", "second"), (2, 5, "user", "second"), (2, 9, "assistant", "third! \n"),
    (3, 1, None, None), (3, 2, "", "x."), (3, 3, "tool", "y."), (3, 4, "system", "z."),
    (None, 1, "user", "a."), (None, None, "assistant", "b."), (None, 2, "user", "a."),
    (4, 7, "assistant", ""), (5, None, "user", "q."), (5, None, "user", "q."), (6, 1, "system", "only."),
    (7, 1, "user", "x" * 200_000 + "."), (7, 3, "assistant", "same."), (7, 3, "assistant", "same."),
    *[(8, t, "user" if t % 3 else "assistant", "again." if t % 5 == 0 else f"{t}.") for t in range(150)],
    *[(9, 1, "user", "alike.")] * 40, (9, 2, "assistant", "ok."), (9, 2, "user", "no"),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, block string, n string, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "b", "n", "d") for r in rows], SCHEMA)


def by_conversation(rows):
    groups = {}
    for conv, *row in rows:
        groups.setdefault(conv, []).append(tuple(row))
    return {conv: plain(in_order(group)) for conv, group in groups.items()}


@pytest.mark.parametrize("block", [1024, 3])
def test_repair_of_whole_and_of_cut_conversations(spark, block, monkeypatch):
    monkeypatch.setattr(c, "BLOCK_ROWS", block)
    repair = Repair(frame(spark, ROWS))
    got = {r.conv_id: r.asDict() for r in repair.summary.collect()}
    digests = {r.conv_id: r.repaired_sha256 for r in transcript_digests(repair.rows).collect()}
    assert {k: {**{n: v for n, v in r.items() if n != "conv_id"}, "repaired_sha256": digests.get(k, NOTHING)}
            for k, r in got.items()} == by_conversation(ROWS)


def test_repaired_rows_are_the_lines_of_the_digest(spark):
    rows = Repair(frame(spark, ROWS)).rows.where("conv_id = 1").orderBy("place").collect()
    assert [(r.place, r.edit, r.turn, r.role, r.text) for r in rows] == [
        (1, "K", 0, "system", "Be kind."), (2, "K", 1, "user", "Hello?"), (3, "K", 2, "assistant", "Yes.")]


def harmed(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text, role = " " if text is None else text, " " if role is None else role
        text = "" if kind == 1 else text.translate({ord(x): None for x in ".!?"}) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def test_query_on_edge_rows_and_on_the_whole_table(spark):
    whole = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    for rows in (ROWS, whole, ROWS[:1], []):
        want = by_conversation(harmed(rows))
        for conv in {r[0] for r in rows} - want.keys():
            want[conv] = plain(())
        got = {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"}
               for r in repaired_conversations(frame(spark, rows)).collect()}
        assert got == want
