"""N-gram Jaccard join by parity sketches.

A document's set is its distinct 5-word shingles. Two sets of Jaccard similarity 0.8 differ in at
most a ninth of their summed sizes. In each size band a document has a sketch of more cells than
that: every shingle is XORed into one cell, so the cells in which two sketches differ are no more
than the shingles in which the sets do, and by the pigeonhole principle linked documents have
equal cells. Cells are joined by value, the pairs are verified on the whole sets.

Equal sets are one class. Classes also have a bit sketch, a parity bit per place, whose Hamming
distance is a lower bound too. In a bucket of classes with an equal cell, each is paired with one
centre; the pairs that the bit sketches allow connect most of what is linked. Classes of a bucket
that are still apart are compared in blocks, and as many pairs are added as connect the rest (first in some
of the buckets, then in all).
All these are verified. Then the sets of the classes that the sketches allow a pair with, and that
the links found so far leave apart, are brought to the blocks, where each such pair is verified and
as many links leave as connect what is linked: no link is lost, and no step hands on the pairs of a
large group whose members are nearly, but not quite, linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import forget_others, remembered, written
from tallymark.llm.components import components

WIDTH = 5
CACHE = 400_000  # words whose hashes a Python worker remembers
#: Cells of a sketch that are joined. Short documents have no more; a pair of longer ones that are
#: just linked has each cell equal with a chance of 0.29 at least, so that all 96 differ with a
#: chance below 1e-14.
CELLS = 96
SOME = 32  # of so many buckets one is compared before all the others
BLOCK = 2048  # classes of a bucket that are compared at once
BLOCK_SHINGLES = 1 << 20  # and what their sets have together, about


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = remembered(_WordHashes())


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; the whole sequence if it is shorter."""
    # of bytes, lower() turns A-Z alone, and split() cuts at blanks and 0x09 to 0x0D alone
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    got = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(len(words), width)
    n = len(words) - size + 1
    key = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        key = key * np.uint64(0x9E3779B97F4A7C15) + got[i:i + n]
    return np.unique(mixed(key))


def class_of(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64))


class Bands:
    """Size bands for a similarity of percent/100: edges grow by at most its inverse."""

    def __init__(self, percent: int):
        self.percent = percent
        self.edges = [1]

    def of(self, n: int) -> int:
        while self.edges[-1] <= n:
            last = self.edges[-1]
            self.edges.append(max(last + 1, last * 100 // self.percent))
        return int(np.searchsorted(self.edges, n, side="right")) - 1

    def differ(self, total: int) -> int:
        """The most shingles in which two linked sets of so many together differ."""
        return total * (100 - self.percent) // (100 + self.percent)

    def both(self, n: int) -> range:
        """Bands of the larger document in the links of one with n shingles."""
        return range(self.of(n), self.of(n * 100 // self.percent) + 1)

    def most(self, band: int) -> int:
        self.of(1 if band < 1 else self.edges[min(band, len(self.edges) - 1)])
        while len(self.edges) <= band + 1:
            self.of(self.edges[-1])
        return self.differ(2 * (self.edges[band + 1] - 1))


def cell_keys(found: np.ndarray, bands: Bands, cells: int = CELLS) -> np.ndarray:
    """Keys (band, cell, value) of the document's cells in all its bands."""
    keys = []
    for band in bands.both(len(found)):
        differ = bands.most(band)
        count = 1 if differ == 0 else -(-5 * (differ + 1) // 4)
        place = (mixed(found ^ np.uint64(band)) >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)
        used = place < min(count, cells)
        place, own = place[used], found[used]
        order = np.argsort(place, kind="stable")
        place, own = place[order], own[order]
        at = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.empty(0, np.int64)
        cell, value = place[at], np.bitwise_xor.reduceat(own, at) if len(at) else own
        if count - len(cell) >= count - differ and count <= cells:  # the equal cells may all be empty
            none = np.setdiff1d(np.arange(count, dtype=np.uint64), cell)
            cell, value = np.r_[cell, none], np.r_[value, np.zeros(len(none), np.uint64)]
        keys.append(mixed(value ^ mixed(cell * np.uint64(1 << 20) + np.uint64(band + 1))))
    return np.concatenate(keys)


def bit_sketch(found: np.ndarray, width: int) -> np.ndarray:
    """Parity bits: each shingle flips one of `width` bits."""
    odd = np.bincount((found & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def sketch_width(n: int) -> int:
    """Places of a sketch: eight a shingle, so that few of the shingles that differ share one."""
    return min(max(64, 1 << int(8 * n - 1).bit_length()), 1 << 16)


def narrowed(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch at a smaller width, which is the XOR of its halves again and again."""
    while len(sketch) > words:
        sketch = sketch[:len(sketch) // 2] ^ sketch[len(sketch) // 2:]
    return sketch


def _sketched(docs: DataFrame, bands: Bands, cells: int) -> DataFrame:
    """(key, node) per cell, and per document a row with its doc_id, number of shingles and bit sketch."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches):
        forget_others(_HASHES)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                key, node, owner, size, bits = [], [], [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    found = shingles(text)
                    own = class_of(found) if len(found) else 0
                    keys = cell_keys(found, bands, cells).view(np.int64) if len(found) else np.empty(0, np.int64)
                    key += [np.array([xxhash.xxh3_64_intdigest(f"{start} {i} {own}") >> 1], np.int64), keys]
                    node.append(np.full(len(keys) + 1, own))
                    owner.append(np.r_[i, np.full(len(keys), -1)])
                    size.append(np.r_[len(found), np.zeros(len(keys), np.int64)])
                    bits += [bit_sketch(found, sketch_width(len(found))).tobytes() if len(found) else b"",
                             *[None] * len(keys)]
                at = np.concatenate(owner)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(key)), pa.array(np.concatenate(node)),
                    part.column(0).take(pa.array(np.maximum(at, 0), mask=at < 0)),
                    pa.array(np.concatenate(size), mask=at < 0), pa.array(bits, pa.binary())],
                    names=["key", "node", "doc_id", "n_shingles", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(
        rows, f"key bigint, node bigint, doc_id {kind}, n_shingles bigint, sketch binary")


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that sizes and bit sketches allow to be linked."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"),
                                  F.col("sketch").alias(f"of_{x}"))
    fit = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(fit).select("a", "b", "n_a", "n_b", "of_a", "of_b")

    def allowed(batches):
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                words = min(len(x), len(y))
                apart = int(np.bitwise_count(narrowed(x, words) ^ narrowed(y, words)).sum())
                keep.append(apart <= (n + m) * (100 - percent) // (100 + percent))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(allowed, "a bigint, b bigint")


def _sets(docs: DataFrame) -> DataFrame:
    """(node, places): the whole set of every document given, if it is of that class."""

    def rows(batches):
        for batch in batches:
            got = [shingles(t) for t in batch.column(1).to_pylist()]
            own = [class_of(g) == n for g, n in zip(got, batch.column(0).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g.tobytes() for g in got], pa.binary())],
                names=["node", "places"]).filter(pa.array(own, pa.bool_()))

    return docs.select("node", "text").mapInArrow(rows, "node bigint, places binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are linked."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("places").alias(f"of_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "of_a", "of_b")

    def linked(batches):
        for batch in batches:
            keep = []
            for start in range(0, batch.num_rows, 64):  # sets of long texts are large
                part = batch.slice(start, 64)
                for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                    shared = len(x) + len(y) - len(np.union1d(x, y))
                    keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    return both.mapInArrow(linked, "a bigint, b bigint")


def _blocks(buckets: DataFrame, groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, x, y, own, node, component, n, sketch): classes of the buckets that hold several components.

    A bucket is cut into parts of a bounded number of classes and shingles; a block (x, y) has the
    classes of two parts, or of one. Buckets of two classes are left out, as their pair has been
    verified already.
    """
    bucket = Window.partitionBy("key")
    rows = (
        buckets.join(groups.withColumnRenamed("id", "node"), "node", "left").join(nodes.select("node", "n"), "node")
        .select("key", "node", "n", F.coalesce("component", "node").alias("component"))
        .withColumn("first", F.min("component").over(bucket)).withColumn("last", F.max("component").over(bucket))
        .withColumn("many", F.count("*").over(bucket)).withColumn("of", F.max("n").over(bucket))
        .where("first < last and many > 2").join(nodes.select("node", "sketch"), "node")
    )
    # the sets of a bucket are of like size, as its key names their band
    parts = F.ceil(F.col("many") / F.greatest(F.lit(2), F.least(F.lit(BLOCK), F.lit(BLOCK_SHINGLES) / F.col("of")))).cast("int")
    return (
        rows.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own",
                "node", "component", "n", "sketch")
    )


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each block, which come one after another."""
    block: list[tuple] = []
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            for row in zip(*(c.to_pylist() for c in batch.slice(start, 1024).columns), strict=True):
                if block and row[:3] != block[0][:3]:
                    yield block
                    block = []
                block.append(row)
    if block:
        yield block


class _Block:
    """The classes of a block, and which pairs of them sizes and bit sketches allow to be linked."""

    def __init__(self, rows: list[tuple], percent: int):
        x, y = rows[0][1], rows[0][2]
        self.percent, self.same = percent, x == y
        self.left = [r for r in rows if r[3] == x]
        self.right = self.left if self.same else [r for r in rows if r[3] == y]
        if not self.left or not self.right:
            self.left = self.right = []
            return
        words = min(len(r[7]) for r in rows) // 8
        self.of_left, self.bits = (np.stack([narrowed(np.frombuffer(r[7], "<u8"), words) for r in side])
                                   for side in (self.left, self.right))
        names, number = np.unique([r[5] for r in [*self.left, *self.right]], return_inverse=True)
        self.own, self.group = number[:len(self.left)].tolist(), number[len(self.left):]
        self.merged = np.arange(len(names))  # the component that each has become part of
        self.size, self.ids = (np.array([r[i] for r in self.right], dtype=np.int64) for i in (6, 4))

    def allowed(self, i: int) -> np.ndarray:
        """Places on the right that may be linked with class i on the left and are apart from it."""
        row = self.left[i]
        fit = (self.merged[self.group] != self.merged[self.own[i]]) & (
            100 * np.minimum(self.size, row[6]) >= self.percent * np.maximum(self.size, row[6]))
        if self.same:
            fit &= self.ids > row[4]
        at = np.flatnonzero(fit)
        most = (self.size[at] + row[6]) * (100 - self.percent) // (100 + self.percent)
        return at[np.bitwise_count(self.bits[at] ^ self.of_left[i]).sum(axis=1) <= most]

    def joined(self, i: int, at: np.ndarray) -> np.ndarray:
        """One of these places per component that they are in; all are one with that of i from now on."""
        at = at[np.unique(self.merged[self.group[at]], return_index=True)[1]]
        self.merged[np.isin(self.merged, self.merged[self.group[at]])] = self.merged[self.own[i]]
        return at


def _pairs(i: int, at: np.ndarray, block: _Block) -> pa.RecordBatch:
    a, b = np.full(len(at), block.left[i][4]), block.ids[at]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _apart(buckets: DataFrame, groups: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a bucket's classes in different components that size and bit sketch allow:
    as many as connect what all of them would connect."""

    def found(batches):
        for rows in _by_block(batches):
            block = _Block(rows, percent)
            for i in range(len(block.left)):
                if len(at := block.allowed(i)):
                    yield _pairs(i, block.joined(i, at), block)

    dealt = _blocks(buckets, groups, nodes).repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "node")
    return dealt.mapInArrow(found, "a bigint, b bigint").distinct()


def _linked_in_blocks(buckets: DataFrame, groups: DataFrame, nodes: DataFrame, sets: DataFrame,
                      percent: int) -> DataFrame:
    """Links (a, b) between components: as many as connect all that are linked in some block.

    First each block names the classes that have an allowed partner in it; only their sets are brought
    to the block, where they are verified.
    """
    schema = "key bigint, x int, y int, own int, node bigint, component bigint, n bigint, sketch binary"

    def with_partner(batches):
        for rows in _by_block(batches):
            block, some = _Block(rows, percent), set()
            for i, row in enumerate(block.left):
                if len(at := block.allowed(i)):
                    some.add(row[4])
                    some.update(block.ids[at].tolist())
            if some:
                kept = [r for r in rows if r[4] in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*kept), (pa.int64(), *[pa.int32()] * 3, *[pa.int64()] * 3,
                                                                 pa.binary()))], names=[c.split()[0] for c in schema.split(", ")])

    def verified(batches):
        forget_others()
        for rows in _by_block(batches):
            block = _Block(rows, percent)
            if not block.left:
                continue
            # shingles by number, so that what a set shares with all others is one look-up
            whole = np.concatenate([np.frombuffer(r[8], "<u8") for r in [*block.left, *block.right]])
            number = np.unique(whole, return_inverse=True)[1]
            size = np.array([len(r[8]) // 8 for r in [*block.left, *block.right]])
            ends = np.cumsum(size)
            starts, many = ends - size, len(block.left)
            marked = np.zeros(number.max() + 1, dtype=bool)
            for i in range(many):
                at = block.allowed(i)
                if not len(at):
                    continue
                mine = number[starts[i]:ends[i]]
                marked[mine] = True
                shared = np.array([np.count_nonzero(marked[number[starts[many + j]:ends[many + j]]]) for j in at.tolist()])
                marked[mine] = False
                at = at[100 * shared >= percent * (size[i] + size[many + at] - shared)]
                if len(at):
                    yield _pairs(i, block.joined(i, at), block)

    dealt = _blocks(buckets, groups, nodes).repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "node")
    # written first: the sets that are joined to them are few
    members = written(dealt.mapInArrow(with_partner, schema), "sketch-members")
    complete = (members.join(sets, "node").select(*members.columns, "places")
                .repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "node"))
    return complete.mapInArrow(verified, "a bigint, b bigint").distinct()


def jaccard_components(docs: DataFrame, percent: int = 80, cells: int = CELLS) -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest doc_id reachable by links, itself included.

    Null, empty and wordless texts have no shingles and link with nothing. Rows with equal sets
    are linked, repeated rows too, whatever their doc_ids. A null id names no component unless there
    is no other id in it, and sets that come with null ids alone link with their equals only. Other
    columns are not read; an empty table gives no rows.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    bands = Bands(percent)
    bucket = Window.partitionBy("key")
    table = written(
        _sketched(docs, bands, cells)
        .withColumn("centre", F.min("node").over(bucket)).withColumn("last", F.max("node").over(bucket))
        .where("centre < last or n_shingles is not null").drop("last"), "sketch-buckets")
    profile = table.where("n_shingles is not null").select("doc_id", "n_shingles", "node")
    buckets = table.where("n_shingles is null").select("key", "node", "centre").distinct()
    nodes = written(
        table.where("n_shingles > 0").groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")),
        "sketch-classes")

    stars = buckets.where("node != centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    stars = written(_likely(stars, nodes, percent), "sketch-pairs")
    # similar classes share many cells: a few of the buckets join most of them, all the buckets the rest
    some = buckets.where(F.pmod("key", F.lit(SOME)) == 0)
    first = written(stars.union(_apart(some, components(stars), nodes, percent)).distinct(),
                    "sketch-pairs")
    pairs = written(first.union(_apart(buckets, components(first), nodes, percent)).distinct(),
                    "sketch-pairs")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = docs.select("doc_id", "text").join(nodes.select("node", "doc_id").join(ends, "node"), "doc_id")
    sets = written(_sets(texts), "sketch-sets").dropDuplicates(["node"])  # a doc_id may have several texts
    links = written(_verified(pairs, sets, percent), "sketch-links")
    # what the verified links leave apart, though the sketches would have it together
    more = _linked_in_blocks(buckets, components(links), nodes, sets, percent)
    links = links.union(written(more, "sketch-links"))
    groups = components(links).withColumnRenamed("id", "node")

    grouped = profile.join(groups, "node", "left").withColumn(
        "group", F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")))
    least = (grouped.where("group is not null").groupBy("group")
             .agg(F.min("doc_id").alias("least")))
    return grouped.join(least, "group", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def without_near_copies(docs: DataFrame, percent: int = 80) -> DataFrame:
    """`docs` with one document of each group: the one that names it.

    Rows that share this document's id and set stay together; rows with a null id stay.
    """
    found = jaccard_components(docs, percent)
    gone = found.where("component_id != doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
