"""Exact substring dedup over sparse suffix arrays, ordered by deep-shallow sorting.

Every window of `length` bytes has an anchor: the k-gram in it with the least hash, the leftmost
of equals. Equal windows have equal anchors at equal places, so only anchors meet in a shuffle, a
few per hundred bytes. An anchor's context is all that its windows cover. Where whole contexts are
equal, all but the first are repeats throughout. Where one anchor has several contexts, the
suffixes that start at the anchors, and the reversed prefixes that end there, are sorted:
multikey quicksort, eight bytes at a time, to a shallow depth, then blind tries for the groups
with longer common prefixes. Common prefix lengths tell which windows are equal, byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import written
from tallymark.llm.shingle_join import mixed

LENGTH = 100
GRAM = 32
SHALLOW = 24  # bytes that multikey quicksort looks at
PART = 1 << 20  # window starts of a text that are worked on at once
BLOCK = 1000  # contexts of one anchor that are sorted in one place
BATCH = 20_000  # contexts that a task sorts together
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Hashes of the anchors, their places, and the first and last window start of each."""
    n = len(data) - length + 1
    if n < 1:
        return (np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3)
    found = []
    for start in range(0, n, PART):
        stop = min(start + PART, n)
        x = _BYTES[np.frombuffer(data, np.uint8, stop - start + length - 1, start)]
        size = 1
        while size < gram:  # hashes of 2, 4, 8 ... bytes
            x = x[:-size] * np.uint64(0x9E3779B97F4A7C15 + 2 * size) + x[size:]
            size *= 2
        x = mixed(x)
        # the hash without its low bits, and the place there: the leftmost of equals is the least
        least = (x & ~np.uint64(0x1FFFFF)) | np.arange(len(x), dtype=np.uint64)
        width, covered = length - gram + 1, 1
        while covered < width:
            step = min(covered, width - covered)
            least = np.minimum(least[:-step], least[step:])
            covered += step
        place = (least & np.uint64(0x1FFFFF)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:], len(place)] - 1
        found.append((x[place[first]], place[first] + start, first + start, last + start))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class BlindTrie:
    """A trie that stores, per branching, only its depth and the bytes that differ there."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.root = None  # a node is [depth, {byte or -1 at a text's end: child}], a leaf a tuple of numbers

    def byte(self, i: int, depth: int) -> int:
        text = self.texts[i]
        return text[depth] if depth < len(text) else -1

    def add(self, i: int) -> None:
        if self.root is None:
            self.root = (i,)
            return
        node = self.root
        while type(node) is list:  # blindly down to any leaf
            node = node[1].get(self.byte(i, node[0])) or next(iter(node[1].values()))
        j = node[0]
        depth = common(self.texts[i], self.texts[j])
        above, node = None, self.root
        while type(node) is list and node[0] < depth:
            above, node = node, node[1][self.byte(i, node[0])]
        own = self.byte(i, depth)
        if type(node) is list and node[0] == depth:
            node[1][own] = (*node[1].get(own, ()), i)  # one is there if the text is the same
            return
        if own == -1 and self.byte(j, depth) == -1:
            new = (*node, i)  # the same text again
        else:
            new = [depth, {self.byte(j, depth): node, own: (i,)}]
        if above is None:
            self.root = new
        else:
            above[1][self.byte(i, above[0])] = new

    def ordered(self) -> tuple[list[int], list[int]]:
        """Texts in order, and the common prefix of each with the one before (-1 for the first)."""
        order, shared = [], []

        def walk(node, before: int) -> None:
            if type(node) is tuple:
                order.extend(node)
                shared.append(before)
                shared.extend([len(self.texts[node[0]])] * (len(node) - 1))
                return
            for byte in sorted(node[1]):
                walk(node[1][byte], before)
                before = node[0]

        walk(self.root, -1)
        return order, shared


def multikey_quicksort(words: np.ndarray, order: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of `words` sorted within segments, one word (eight bytes) at a time.

    order: the rows, segment by segment; begins: the places at which one begins. Each round splits all open
    segments in three by the word at their depth: below, like and above that of their middle row; the
    middle part goes one word deeper. Returns the order, and where rows begin that are alike in all words.
    """
    order, begins, n = order.copy(), begins.copy(), len(order)
    depth = np.zeros(n, np.int64)  # of the segment that a place is in
    while True:
        first = np.flatnonzero(begins)
        size = np.diff(np.r_[first, n])
        split = (size > 1) & (depth[first] < words.shape[1])
        first, size = first[split], size[split]
        if not len(first):
            return order, begins
        segment = np.repeat(np.arange(len(first)), size)
        place = np.arange(len(segment)) + np.repeat(first - (np.cumsum(size) - size), size)
        row, at = order[place], depth[place]
        key, pivot = words[row, at], words[order[first + size // 2], depth[first]][segment]
        side = (key >= pivot).astype(np.int64) + (key > pivot)
        parts = np.bincount(segment * 3 + side, minlength=3 * len(first)).reshape(-1, 3)
        begin = first[:, None] + np.cumsum(parts, axis=1) - parts
        target = np.empty(len(place), np.int64)
        for s in range(3):
            mine = np.flatnonzero(side == s)
            ahead = np.cumsum(parts[:, s]) - parts[:, s]  # rows of this side in the segments before
            target[mine] = begin[segment[mine], s] + np.arange(len(mine)) - ahead[segment[mine]]
            begins[begin[parts[:, s] > 0, s]] = True
        order[target], depth[target] = row, at + (side == 1)


def deep_shallow(group: np.ndarray, texts: list[bytes], shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of (group, text), and the common prefix of each with the one before it.

    The prefix is -1 where a group begins.
    """
    n = len(texts)
    head = np.frombuffer(b"".join(t[:shallow].ljust(shallow, b"\0") for t in texts), np.uint8).reshape(n, shallow)
    words = head.view(">u8").astype(np.uint64)
    sizes = np.array([len(t) for t in texts])
    order = np.argsort(group, kind="stable")
    order, begins = multikey_quicksort(words, order, np.r_[True, group[order][1:] != group[order][:-1]])
    shared = np.full(n, -1, np.int64)
    same = np.flatnonzero(group[order][1:] == group[order][:-1]) + 1
    a, b = order[same - 1], order[same]
    equal = head[a] == head[b]
    first = np.where(equal.all(axis=1), shallow, equal.argmin(axis=1))
    shared[same] = np.minimum(first, np.minimum(sizes[a], sizes[b]))
    # what the shallow sort left together
    edge = np.flatnonzero(np.r_[begins, True])
    for low, high in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        if high - low > 1:
            trie = BlindTrie(texts)
            for i in order[low:high].tolist():
                trie.add(i)
            order[low:high], inside = trie.ordered()
            shared[low + 1:high] = inside[1:]
            if low and shared[low] >= 0:
                shared[low] = common(texts[order[low - 1]], texts[order[low]])
            if high < n and shared[high] >= 0:
                shared[high] = common(texts[order[high - 1]], texts[order[high]])
    return order, shared


def classes(order: np.ndarray, shared: np.ndarray, depth: int) -> np.ndarray:
    """A number for each text, the same for texts of a group that agree up to `depth`."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(shared < depth)
    return out


def repeats(group: np.ndarray, left: np.ndarray, count: np.ndarray, contexts: list[bytes],
            length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Which windows repeat a window of an earlier row of their group: rows x (length - gram + 1).

    Column o is the window whose anchor stands at its byte o. left: the anchor's place in the
    context; count: the windows it has, the first at the context's start.
    """
    suffixes = deep_shallow(group, [c[at:] for c, at in zip(contexts, left.tolist(), strict=True)])
    prefixes = deep_shallow(group, [c[:at][::-1] for c, at in zip(contexts, left.tolist(), strict=True)])
    out = np.zeros((len(contexts), length - gram + 1), dtype=bool)
    for o in range(out.shape[1]):
        has = np.flatnonzero((o <= left) & (o > left - count))
        if len(has) > 1:
            code = classes(*suffixes, length - o)[has] * (len(contexts) + 1) + classes(*prefixes, o)[has]
            _, first = np.unique(code, return_index=True)
            again = np.ones(len(has), bool)
            again[first] = False
            out[has[again], o] = True
    return out


def _spans(on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of ones."""
    steps = np.diff(np.r_[0, on.astype(np.int8), 0])
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def _utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """(doc_id, start, n): n windows of `length` bytes from byte `start` on that start earlier too."""
    width = length - gram + 1
    if gram & (gram - 1) or not 0 < width <= 128:
        raise ValueError("gram must be a power of two, and at most 127 bytes shorter than length")
    kind = docs.schema["doc_id"].dataType.simpleString()
    # rows with a null id are only there for others to repeat: each of their texts once, told apart by a hash
    docs, unknown = docs.select("doc_id", "text"), F.col("doc_id").isNull()
    docs = (docs.where(~unknown).union(docs.where(unknown).distinct())
            .withColumn("row", F.when(unknown, F.xxhash64("text")).otherwise(F.lit(0).cast("bigint"))))

    def found(batches):
        for batch in batches:
            for i, text in enumerate(batch.column(1).to_pylist()):
                data = _utf8(text)
                key, place, first, last = anchors(data, length, gram)
                if not len(key):
                    continue
                context = np.fromiter((xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(
                    first.tolist(), (last + length).tolist(), strict=True)), np.uint64, len(key))
                context ^= place_code(place - first)
                # what repeats inside the text is known here, and is dealt out evenly, not by its key
                again = np.ones(len(key), bool)
                again[np.unique(key ^ mixed(context), return_index=True)[1]] = False
                key = np.where(again, mixed(context + first.astype(np.uint64)), key)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(context.view(np.int64)),
                     *[batch.column(c).take(pa.array(np.full(len(key), i))) for c in (0, 2)],
                     pa.array((first * 128 + place - first) * 128 + last - first), pa.array(again)],
                    names=["key", "context", "doc_id", "row", "at", "again"])

    def place_code(left: np.ndarray) -> np.ndarray:
        return mixed(left.astype(np.uint64) + np.uint64(1))

    of_key, of_context = Window.partitionBy("key"), Window.partitionBy("key", "context")
    met = written(
        docs.mapInArrow(found, f"key bigint, context bigint, doc_id {kind}, row bigint, at bigint, again boolean")
        .repartition("key")  # serves both windows
        .withColumn("first", F.min(F.when(~F.col("again"), F.struct("doc_id", "row", "at"))).over(of_context))
        .withColumn("leads", ~F.col("again") & (F.struct("doc_id", "row", "at") == F.col("first")))
        .withColumn("contexts", F.sum(F.col("leads").cast("int")).over(of_key))
        .where("not leads or contexts > 1").drop("first", "context", "again"), "suffix-anchors")
    whole = met.where("not leads and doc_id is not null").select(
        "doc_id", F.expr("at div 16384").alias("start"), (F.col("at") % 128 + 1).alias("n"))

    blocks = F.ceil(F.col("contexts") / block)
    known = F.coalesce("doc_id", F.lit("0").cast(kind)).alias("known")
    wanted = met.where("leads").groupBy(known, "row").agg(F.collect_list(F.struct(
        "key", "at", F.pmod(F.xxhash64("doc_id", "row", "at"), blocks).alias("block"), blocks.alias("blocks"))).alias("w"))

    def cut(batches):
        for batch in batches:
            names, out = ["key", "block", "blocks", "doc_id", "start", "left", "count", "context"], []
            for i, (text, rows) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                                                 strict=True)):
                data = _utf8(text)
                for row in rows:
                    start, left, count = row["at"] >> 14, row["at"] >> 7 & 127, (row["at"] & 127) + 1
                    out.append((row["key"], row["block"], row["blocks"], i, start, left, count,
                                data[start:start + count - 1 + length]))
            columns = list(map(list, zip(*out, strict=True))) if out else [[] for _ in names]
            arrays = [pa.array(c, pa.int64()) for c in columns[:7]] + [pa.array(columns[7], pa.binary())]
            arrays[3] = batch.column(0).take(arrays[3])
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    contexts = (
        docs.withColumn("known", known).join(wanted, ["known", "row"]).select("doc_id", "text", "w").mapInArrow(
            cut, f"key bigint, block bigint, blocks bigint, doc_id {kind}, start bigint, left bigint, "
                 "count bigint, context binary")
        .repartition("key", "block").sortWithinPartitions("key", "block", "doc_id", F.col("start") + F.col("left"))
    )

    def compared(rows: list[tuple]) -> pa.RecordBatch:
        group = np.cumsum([a[:2] != b[:2] for a, b in zip(rows, [(None, None), *rows])])
        left, count = np.array([r[5] for r in rows]), np.array([r[6] for r in rows])
        again = repeats(group, left, count, [r[7] for r in rows], length, gram)
        out = []
        for row, on in zip(rows, again, strict=True):
            at, n, total = row[5], row[6], row[2]
            on = on[at - n + 1:at + 1][::-1]  # by window start
            if on.any():
                out += [(row[3], row[4] + a, b - a, None, None) for a, b in zip(*map(np.ndarray.tolist, _spans(on)))]
            if total > 1:  # the other blocks may have these windows too
                for s in np.flatnonzero(~on).tolist():
                    h = xxhash.xxh3_128_intdigest(row[7][s:s + length])
                    out.append((row[3], row[4] + s, 1, (h >> 64) - 2**63, h % 2**64 - 2**63))
        columns = list(map(list, zip(*out, strict=True))) if out else [[] for _ in result]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, result, strict=True)], schema=result)

    def sorted_out(batches) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(rows) >= BATCH and row[:2] != rows[-1][:2]:
                    yield compared(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield compared(rows)

    arrow_id = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    result = pa.schema([("doc_id", arrow_id), ("start", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()),
                        ("h2", pa.int64())])
    judged = written(contexts.mapInArrow(
        sorted_out, f"doc_id {kind}, start bigint, n bigint, h1 bigint, h2 bigint"), "suffix-runs")
    open_ = judged.where("h1 is not null")
    firsts = open_.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("m"))
    late = (open_.join(firsts.where("m > 1"), ["h1", "h2"])
            .where(F.struct("doc_id", "start") != F.col("first")).select("doc_id", "start", "n"))
    return whole.union(judged.where("h1 is null").select("doc_id", "start", "n")).union(late)


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every whole text as UTF-8 bytes.

    Every byte goes that is covered by a string of `length` bytes that also starts earlier: in a
    document with a smaller doc_id, or before it in the same one. Null texts are empty; texts
    shorter than `length` stay whole. doc_id names a document: rows that share one are the same
    document given again, and what is found in one goes from all. A null id is the smallest, and
    rows with it stay whole. Other columns are not read; an empty table gives no rows. kept holds
    the bytes that are left.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    runs = (repeated_runs(docs, length, gram, block).where("doc_id is not null").groupBy("doc_id")
            .agg(F.collect_list(F.struct("start", "n")).alias("runs")))

    def removed(batches):
        for batch in batches:
            out = []
            for text, rows in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = _utf8(text)
                if not rows:
                    out.append((len(data), 0, 0, hashlib.sha256(data).hexdigest(), data))
                    continue
                change = np.zeros(len(data) + 1, np.int64)
                for row in rows:
                    if row["start"] < len(data):
                        change[row["start"]] += 1
                        change[min(row["start"] + row["n"] - 1 + length, len(data))] -= 1
                gone = np.cumsum(change[:-1]) > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out.append((len(data), int(gone.sum()), len(_spans(gone)[0]), hashlib.sha256(kept).hexdigest(), kept))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = list(map(list, zip(*out, strict=True))) if out else [[] for _ in types]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return docs.select("doc_id", "text").join(runs, "doc_id", "left").mapInArrow(
        removed, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
