"""Conversations repaired by the cheapest edits, so that roles read `(s?(ua)+)?`.

Rows are kept (0), given the other of user and assistant (3) or deleted (4), and empty turns may be
put in (3); blank and repeated rows must go, and an unfinished row that stays costs 3 more. Of the
cheapest edits those whose letters D, I, K, R come first in ASCII order are taken.

A path through a conversation has one whole number as its weight: the cost in the high digits, below
them the letters, one octal digit each, first letter first, with zeros after the last. So the least
number is the least cost and then the least letters, and the dynamic program over (rows read, last
role given out) takes minima of whole numbers and nothing else. Two paths of one cost over the same
rows to the same role are never one the beginning of the other (the letters decide the role), so
the least is the least whatever follows, and stretches of rows can be worked out on their own:
a stretch is a table of the least weights from role to role, and tables are joined by shifting digits.

On Spark a conversation is cut into blocks of its ordered rows (range buckets, so that one that holds
most of the rows is spread over many tasks); each block's table is made where its rows are. What meets
in one task per conversation is the tables, in size a small multiple of the letters that are the result.
Texts stay out of all this: rows are known by the MD5 of their text until the edits are certain.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import written
from tallymark.operators.joins import null_safe_join
from tallymark.operators.ordered import range_buckets

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
#: Digits of the letters, in ASCII order; a kept system row is told from other kept rows by a digit
#: of its own, which no other path can have in its place with the same letters before.
D, I, K, S, R = 1, 2, 3, 4, 5
LETTERS = {D: "D", I: "I", K: "K", S: "K", R: "R"}
#: What has been given out last.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
BITS = 3
#: Ordered rows of a block at most, and rows whose table is made and remembered at once.
BLOCK_ROWS, STEP = 1024, 32
BLANK = r"[^\x20\x09-\x0D]"
Table = tuple[int, dict[tuple[int, int], int]]  # number of places, least weight from role to role


def turned(last: int) -> int:
    """The role out of user and assistant that may come next; there always is just one."""
    return ASSISTANT if last == USER else USER


def edits(symbol: str, last: int) -> Iterator[tuple[int, int, int]]:
    """(cost, digit, role given out last then) of what may be done to a row.

    `symbol` is s, u, a or o for its role (o: another), a capital if unfinished, x if it must go.
    """
    yield DELETE, D, last
    if symbol == "x":
        return
    more = UNFINISHED if symbol.isupper() else 0
    role = symbol.lower()
    if role == "s" and last == NOTHING:
        yield KEEP + more, S, SYSTEM
    if role == ("a" if last == USER else "u"):
        yield KEEP + more, K, turned(last)
    yield REROLE + more, R, turned(last)


@lru_cache(maxsize=1 << 14)
def table_of(symbols: str) -> Table:
    """Least weights of paths over these rows; an empty turn may go in before each of them."""
    width = 2 * len(symbols)

    def weight(cost: int, digit: int, place: int) -> int:
        return cost << BITS * width | digit << BITS * (width - 1 - place)

    def relax(paths: dict[int, tuple[int, int]], last: int, value: int, places: int) -> None:
        if last not in paths or value < paths[last][0]:
            paths[last] = value, places

    least: dict[tuple[int, int], int] = {}
    for first in range(4):
        paths = {first: (0, 0)}
        for symbol in symbols:
            opened = dict(paths)
            for last, (value, at) in paths.items():
                relax(opened, turned(last), value + weight(INSERT, I, at), at + 1)
            paths = {}
            for last, (value, at) in opened.items():
                for cost, digit, then in edits(symbol, last):
                    relax(paths, then, value + weight(cost, digit, at), at + 1)
        least |= {(first, last): value for last, (value, _) in paths.items()}
    return width, least


def places_used(digits: int, width: int) -> int:
    """Letters of a path; no letter is zero, so the zeros at the end are padding."""
    return width - ((digits & -digits).bit_length() - 1) // BITS if digits else 0


def joined(left: Table, right: Table) -> Table:
    """The table of two stretches, one after the other."""
    (w1, first), (w2, second) = left, right
    width, mask1, mask2 = w1 + w2, (1 << BITS * w1) - 1, (1 << BITS * w2) - 1
    least: dict[tuple[int, int], int] = {}
    for (a, mid), value in first.items():
        gap = BITS * (w1 - places_used(value & mask1, w1))  # the padding that the right digits move into
        for b in range(4):
            if (more := second.get((mid, b))) is not None:
                whole = (value << BITS * w2) + ((more >> BITS * w2) << BITS * width) + ((more & mask2) << gap)
                if (a, b) not in least or whole < least[a, b]:
                    least[a, b] = whole
    return width, least


def all_joined(tables: list[Table]) -> Table:
    """Joined two by two, so that long digits are shifted few times."""
    while len(tables) > 1:
        tables = [joined(*tables[i:i + 2]) if i + 1 < len(tables) else tables[i]
                  for i in range(0, len(tables), 2)]
    return tables[0]


def rows_table(symbols: str) -> Table:
    return all_joined([table_of(symbols[i:i + STEP]) for i in range(0, len(symbols), STEP)])


def cheapest(table: Table) -> tuple[int, list[int]]:
    """(cost, digits of the letters) from nothing given out to a whole conversation."""
    width, least = table
    ends = [least[NOTHING, last] << BITS for last in (NOTHING, ASSISTANT) if (NOTHING, last) in least]
    if (NOTHING, USER) in least:  # one more turn closes it
        value = least[NOTHING, USER]
        used = places_used(value & ((1 << BITS * width) - 1), width)
        ends.append((value << BITS) + (INSERT << BITS * (width + 1)) + (I << BITS * (width - used)))
    best = min(ends)
    digits = [int(c) for c in f"{best & ((1 << BITS * (width + 1)) - 1):o}".zfill(width + 1).rstrip("0")]
    return best >> BITS * (width + 1), digits


def steps(digits: list[int]) -> Iterator[tuple[int, int]]:
    """(digit, role given out last before it)."""
    last = NOTHING
    for digit in digits:
        yield digit, last
        last = last if digit == D else SYSTEM if digit == S else turned(last)


def breaks(initials: str) -> int:
    return sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(initials, initials[1:])))


# --- on Spark


def plain_rows(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text) with one space for a null role or text; other columns go."""
    return rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                       F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"))


def judged(rows: DataFrame) -> DataFrame:
    """One row per (conv, turn, role, digest): n alike rows and the fault of the first of them.

    The others repeat it. `fault` is blank, duplicate, truncated or null.
    """
    blank = ~F.col("text").rlike(BLANK)
    unfinished = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    keys = ("conv", "turn", "role", "digest")
    items = rows.withColumn("digest", F.unhex(F.md5("text"))).groupBy(*keys).agg(
        F.count("*").alias("n"), F.bool_and(blank).alias("blank"), F.bool_and(unfinished).alias("unfinished"))
    # where a role and text first stand, if they stand in several turns; a null turn comes first
    first = (items.groupBy("conv", "role", "digest")
             .agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("turns"))
             .where("turns > 1").drop("turns"))
    seen = null_safe_join(items, first, ["conv", "role", "digest"], "left")
    again = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    return seen.select(*keys, "n", F.when(F.col("blank"), "blank").when(again, "duplicate")
                       .when(F.col("unfinished"), "truncated").alias("fault"))


def blocks_of(items: DataFrame) -> DataFrame:
    """(conv, block, items, symbols, initials) with at most BLOCK_ROWS distinct rows each, in order."""
    placed = range_buckets(items, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")])
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    symbol = (F.when(F.col("fault").isin("blank", "duplicate"), "x")
              .when(F.col("fault") == "truncated", F.upper(known)).otherwise(known))
    n = F.col("n").cast("int") - 1  # alike rows after the first must go
    lettered = placed.select(
        "conv", F.struct("_bucket", F.expr(f"_pos div {BLOCK_ROWS}").alias("part")).alias("block"),
        F.struct("_pos", "turn", "role", "digest", "n",
                 F.concat(symbol, F.repeat(F.lit("x"), n)).alias("symbols"),
                 F.repeat(known, F.col("n").cast("int")).alias("initials")).alias("item"))
    grouped = lettered.groupBy("conv", "block").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return grouped.select(
        "conv", "block",
        F.transform("items", lambda x: F.struct(x["turn"], x["role"], x["digest"], x["n"])).alias("items"),
        F.array_join(F.col("items.symbols"), "").alias("symbols"),
        F.array_join(F.col("items.initials"), "").alias("initials"))


def tabled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the least weights of their rows; weights of paths that do not exist are null."""
    for batch in batches:
        weights, illegal = [], []
        for symbols, initials in zip(batch.column("symbols").to_pylist(), batch.column("initials").to_pylist()):
            _, least = rows_table(symbols)
            found = [least.get((a, b)) for a in range(4) for b in range(4)]
            weights.append([None if v is None else v.to_bytes((v.bit_length() + 7) // 8, "big") for v in found])
            illegal.append(breaks(initials))
        initials = batch.column("initials").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("block"), pa.array(list(map(len, initials)), pa.int64()),
             pa.array(weights, pa.list_(pa.binary())), pa.array(illegal, pa.int64()),
             pa.array([s[0] + s[-1] for s in initials], pa.string())],
            names=["conv", "block", "n_rows", "weights", "illegal", "ends"])


def decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation its cost and letters, and of each block the digits, the role given out last
    before them and the number of rows given out before them."""
    kind = pa.list_(pa.struct([("block", pa.struct([("_bucket", pa.int32()), ("part", pa.int64())])),
                               ("digits", pa.string()), ("last", pa.int32()), ("place", pa.int64())]))
    for batch in batches:
        costs, audits, illegal, shares = [], [], [], []
        for blocks in batch.column("blocks").to_pylist():
            tables = [(2 * b["n_rows"], {divmod(i, 4): int.from_bytes(w, "big")
                                         for i, w in enumerate(b["weights"]) if w is not None}) for b in blocks]
            cost, digits = cheapest(all_joined(tables))
            costs.append(cost)
            audits.append("".join(map(LETTERS.__getitem__, digits)))
            illegal.append(sum(b["illegal"] for b in blocks)
                           + sum(breaks(a["ends"][1] + b["ends"][0]) for a, b in zip(blocks, blocks[1:])))
            share, path, place = [], steps(digits), 0
            for number, block in enumerate(blocks, 1):
                mine, before, left = [], None, block["n_rows"]
                start = place
                # a turn put in after a block's last row belongs to the next block, if there is one
                while left or number == len(blocks):
                    digit, last = next(path, (None, None))
                    if digit is None:
                        break
                    before = last if before is None else before
                    mine.append(str(digit))
                    left -= digit != I
                    place += digit != D
                share.append({"block": block["block"], "digits": "".join(mine), "last": before, "place": start})
            shares.append(share)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), pa.array(costs, pa.int64()), pa.array(audits, pa.string()),
             pa.array(illegal, pa.int64()), pa.array(shares, kind)],
            names=["conv", "cost", "audit", "illegal", "shares"])


def placed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that are given out: place, letter, role, and of a kept one the turn, own role and digest."""
    for batch in batches:
        out: dict[str, list] = {name: [] for name in ("conv", "place", "edit", "new_role", "turn", "role", "digest")}
        for conv, items, digits, last, place in zip(*[batch.column(c).to_pylist() for c in (
                "conv", "items", "digits", "last", "place")]):
            rows = (item if i == 0 else None for item in items for i in range(item["n"]))
            for c in digits:
                digit = int(c)
                item = None if digit == I else next(rows)
                if digit == D:
                    continue
                place += 1
                role = None if digit in (K, S) else "assistant" if turned(last) == ASSISTANT else "user"
                last = SYSTEM if digit == S else turned(last)
                own = (item["turn"], item["role"], item["digest"]) if item else (None, None, None)
                for name, value in zip(out, (conv, place, LETTERS[digit], role, *own)):
                    out[name].append(value)
        types = (batch.schema.field("conv").type, pa.int64(), pa.string(), pa.string(),
                 batch.schema.field("items").type.value_type.field("turn").type, pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))


class Repair:
    """The cheapest repair of every conversation of a table.

    Conversations are the rows of one conversation id, in the order of their turns, null turns first;
    rows of one turn are ordered by role and by the MD5 of their text, alike rows stand together. A null
    id is a conversation of its own; a null role or text is one space. Texts and conversations of any
    length are taken whole; MD5 decides whether texts are equal. Further columns are not read; an
    empty table has no conversations.

    `summary`: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. `rows`: conv_id, place
    (from 1), edit (K, R or I), turn, role and text of the repaired conversations.
    """

    def __init__(self, rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text"):
        self.names, self.plain = (conv, turn), plain_rows(rows, conv, turn, role, text)
        conv_type, turn_type = (self.plain.schema[c].dataType.simpleString() for c in ("conv", "turn"))
        self.items = written(judged(self.plain), "judged")
        self.blocks = written(blocks_of(self.items), "blocks")
        block = "block struct<_bucket: int, part: bigint>"
        tables = self.blocks.select("conv", "block", "symbols", "initials").mapInArrow(
            tabled, f"conv {conv_type}, {block}, n_rows bigint, weights array<binary>, illegal bigint, ends string")
        met = tables.groupBy("conv").agg(F.sort_array(F.collect_list(
            F.struct("block", "n_rows", "weights", "illegal", "ends"))).alias("blocks"))
        self.decisions = written(met.mapInArrow(
            decided, f"conv {conv_type}, cost bigint, audit string, illegal bigint, "
            f"shares array<struct<{block.replace(' ', ': ', 1)}, digits: string, last: int, place: bigint>>"), "decided")
        self.types = conv_type, turn_type

    @property
    def summary(self) -> DataFrame:
        def of(fault: str) -> Column:
            return F.sum(F.when(F.col("fault") == fault, 1).otherwise(0))

        n, turn = F.col("n"), F.col("turn")
        repeats = F.sum(F.when(F.col("fault") == "blank", 0).when(F.col("fault") == "duplicate", n).otherwise(n - 1))
        span = F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn)
        counts = self.items.groupBy("conv").agg(
            F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps"),
            F.sum(F.when(F.col("fault") == "blank", n).otherwise(0)).alias("blank"),
            repeats.alias("duplicate"), of("truncated").alias("truncated"))
        both = null_safe_join(counts, self.decisions.drop("shares"), ["conv"])
        return both.select(F.col("conv").alias(self.names[0]), "gaps", "blank", "duplicate", "truncated",
                           "illegal", "cost", "audit")

    @property
    def rows(self) -> DataFrame:
        conv_type, turn_type = self.types
        shares = self.decisions.select("conv", F.explode("shares").alias("s")).select("conv", "s.*")
        cut = null_safe_join(self.blocks.select("conv", "block", "items"), shares, ["conv", "block"])
        given = cut.select("conv", "items", "digits", "last", "place").mapInArrow(
            placed_rows, f"conv {conv_type}, place bigint, edit string, new_role string, turn {turn_type}, "
            "role string, digest binary")
        keys = ["conv", "turn", "role", "digest"]
        texts = self.plain.groupBy(*keys[:3], F.unhex(F.md5("text")).alias("digest")).agg(
            F.any_value("text").alias("text"))
        kept = null_safe_join(given.where("edit != 'I'"), texts, keys)
        put_in = given.where("edit = 'I'").withColumn("text", F.lit(""))
        conv, turn = self.names
        return kept.unionByName(put_in).select(
            F.col("conv").alias(conv), "place", "edit", F.col("turn").alias(turn),
            F.coalesce("new_role", "role").alias("role"), "text")


def transcript_digests(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, repaired_sha256) of the lines `role:text` in order, joined by line breaks.

    The digest of a conversation is sequential by nature: its rows pass through one task, sorted and
    one after another, none of them kept.
    """
    kind = rows.schema[conv].dataType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, whose = None, None
        for batch in batches:
            done = []
            for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if state is None or key != whose:
                    if state is not None:
                        done.append((whose, state.hexdigest()))
                    state, whose = hashlib.sha256(line.encode()), key
                else:
                    state.update(b"\n" + line.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in done], batch.schema.field(0).type),
                 pa.array([d for _, d in done], pa.string())], names=[conv, "repaired_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([whose], batch.schema.field(0).type), pa.array([state.hexdigest()], pa.string())],
                names=[conv, "repaired_sha256"])

    lines = rows.select(conv, "place", F.concat_ws(":", "role", "text").alias("line"))
    return (lines.repartition(conv).sortWithinPartitions(conv, "place").select(conv, "line")
            .mapInArrow(digests, f"`{conv}` {kind}, repaired_sha256 string"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, shorn of full stops, repeated or given to the user, by a hash of their place."""
    blank = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", blank)
    return (conversations.withColumn("__kind", kind).where("__kind != 0")
            .withColumn("text", F.when(F.col("__kind") == 1, "")
                        .when(F.col("__kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text))
            .withColumn("role", F.when(F.col("__kind") == 4, "user").otherwise(F.coalesce("role", blank)))
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.when(F.col("__kind") == 3, 2).otherwise(1))))
            .select("conv_id", "turn", "role", "text"))


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """Every conversation of the table with the figures of its repair after damage, and its digest.

    One that the damage leaves without rows has zeros, no letters and the digest of no bytes.
    """
    repair = Repair(damaged(conversations))
    found = null_safe_join(repair.summary, transcript_digests(repair.rows), ["conv_id"], "left")
    every = null_safe_join(conversations.select("conv_id").distinct(), found, ["conv_id"], "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def _step(state: str, cost: str, letter: str, line: str) -> str:
    """SQL of a path `{v: cost in nine figures and letters, r: lines}` after one more edit."""
    return (f"CASE WHEN {state} IS NOT NULL THEN {{'v': lpad((left({state}.v, 9)::INT + {cost})::VARCHAR, 9, '0') "
            f"|| substr({state}.v, 10) || '{letter}', 'r': {state}.r || {line}}} END")


def _repair_sql() -> str:
    free = "list_min([p.st.n, p.st.s, p.st.a])"  # a user may be next
    more = "x.more"
    gap = ("{'n': p.st.n, 's': p.st.s, "
           f"'u': list_min([p.st.u, {_step(free, '3', 'I', "chr(10) || 'user:'")}]), "
           f"'a': list_min([p.st.a, {_step('p.st.u', '3', 'I', "chr(10) || 'assistant:'")}])}}")
    line = "chr(10) || x.role || ':' || x.text"

    def stay(state: str, initial: str, role: str) -> str:
        kept = f"CASE WHEN NOT x.must AND x.initial = '{initial}' THEN {_step(state, more, 'K', line)} END"
        if role == "system":
            return kept
        given = f"CASE WHEN NOT x.must THEN {_step(state, '3 + ' + more, 'R', f"chr(10) || '{role}:' || x.text")} END"
        return f"{kept}, {given}"

    def gone(state: str) -> str:
        return _step(f"p.st.{state}", "4", "D", "''")

    row = (f"{{'n': {gone('n')}, 's': list_min([{gone('s')}, {stay('p.st.n', 's', 'system')}]), "
           f"'u': list_min([{gone('u')}, {stay(free, 'u', 'user')}]), "
           f"'a': list_min([{gone('a')}, {stay('p.st.u', 'a', 'assistant')}])}}")
    path = "STRUCT(v VARCHAR, r VARCHAR)"
    states = f"STRUCT(n {path}, s {path}, u {path}, a {path})"
    blank = BLANK
    return rf"""
WITH crc AS (  -- the table of the CRC-32 polynomial, by its rule
  SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
    CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
kinds AS (
  SELECT name, xor(list_reduce(list_concat([4294967295], list_transform(range(length(name)), lambda i:
      ascii(substr(name, i + 1, 1))::BIGINT)), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])),
    4294967295) % 20 AS kind FROM (SELECT DISTINCT name FROM named), crc),
harmed AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM named JOIN kinds USING (name) WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS spot FROM harmed),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '{blank}') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY spot) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated' ELSE '' END AS fault,
    substr(role, 1, 1) AS initial,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY spot) || substr(role, 1, 1) AS pair
  FROM numbered),
figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal,
    flatten(list([{{'st': NULL::{states}, 'gap': true, 'initial': '', 'role': '', 'text': '', 'must': false, 'more': 0}},
      {{'st': NULL::{states}, 'gap': false, 'initial': initial, 'role': role, 'text': text,
        'must': fault IN ('blank', 'duplicate'), 'more': CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END}}]
      ORDER BY spot)) AS items
  FROM judged GROUP BY conv_id),
repaired AS (
  SELECT * EXCLUDE (items), list_reduce(
    list_concat(items, [{{'st': NULL::{states}, 'gap': true, 'initial': '', 'role': '', 'text': '', 'must': false, 'more': 0}}]),
    lambda p, x: {{'st': CASE WHEN x.gap THEN {gap} ELSE {row} END, 'gap': x.gap, 'initial': '', 'role': '',
      'text': '', 'must': false, 'more': 0}},
    {{'st': {{'n': {{'v': '000000000', 'r': ''}}, 's': NULL, 'u': NULL, 'a': NULL}}::{states}, 'gap': true, 'initial': '',
      'role': '', 'text': '', 'must': false, 'more': 0}}) AS last
  FROM figures),
best AS (SELECT *, list_min([last.st.n, last.st.a]) AS path FROM repaired)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(left(path.v, 9)::BIGINT, 0) AS cost,
  coalesce(substr(path.v, 10), '') AS audit, sha256(coalesce(substr(path.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
"""


REPAIR_SQL = _repair_sql()
