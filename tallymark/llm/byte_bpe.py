"""Byte-level BPE ids by backtracking over longest matches, and back.

Bytes are read as Latin-1, so that an Aho-Corasick automaton over the vocabulary finds every token
that starts at a byte. A piece is then covered from its start with the longest token; two tokens may
stand side by side only if merging their bytes would leave the seam between them. Where nothing fits,
the token before gives way to its longest shorter prefix. The cover of a prefix by such tokens is
unique, and it is what the merges give; so a byte from which nothing follows is never tried again,
and the work is linear in the piece. Whether a seam stays is found by undoing the merges on both of
its sides, the later one first, and is remembered per pair of tokens.

Pieces are the matches of the vocabulary's pattern, with the character classes of the library.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces and pairs of tokens that a Python worker remembers. Of pieces there are two such lots: when
#: the new one is full it becomes the old one, from which what is still in use moves on.
KNOWN_PIECES, KNOWN_PAIRS = 1 << 18, 1 << 18
#: A remembered piece is no longer than this.
PIECE_CHARS = 32
#: Rows handled, and handed back, at once.
SLICE = 256


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Splitter:
    """Cuts texts into matches of a pattern, in Unicode as the library knows it.

    A character of whose class the library and this regex module hold different views is shown to
    the pattern as a character of the library's class that both agree on.
    """

    CLASSES = {r"\p{L}": "一", r"\p{N}": "٣", r"\s": " ", r"[^\s\p{L}\p{N}]": "…"}

    def __init__(self, pattern: str):
        def own(p: str) -> regex.Pattern:
            return regex.compile(p.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))

        single = {bytes([b]): b for b in range(256)}
        self.pattern = own(pattern)
        #: the library returns the bytes of a text's matches and drops what does not match
        self.views = [(tiktoken.Encoding("class", pat_str=p, mergeable_ranks=single, special_tokens={}),
                       own(p), shown) for p, shown in self.CLASSES.items()]
        self.seen = set(map(chr, range(128)))
        self.shown: dict[int, str] = {}

    def look_at(self, chars: set[str]) -> None:
        for c in chars:
            for library, here, shown in self.views:
                if library.encode_ordinary(c):
                    if not here.fullmatch(c):
                        self.shown[ord(c)] = shown
                    break
        self.seen |= chars

    def __call__(self, text: str) -> list[str]:
        if text.isascii():
            return self.pattern.findall(text)
        chars = set(text)
        if new := chars - self.seen:
            self.look_at(new)
        if self.shown and not self.shown.keys().isdisjoint(map(ord, chars)):
            return [text[m.start():m.end()] for m in self.pattern.finditer(text.translate(self.shown))]
        return self.pattern.findall(text)


class Pieces(dict):
    """Packed ids of the pieces seen; those not seen yet are encoded when they are asked for."""

    def __init__(self, encode: Callable[[bytes], list[int]], older: dict[str, bytes]):
        super().__init__()
        self.encode, self.older = encode, older

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece) or array("i", self.encode(piece.encode())).tobytes()
        if len(piece) <= PIECE_CHARS and len(self) < KNOWN_PIECES:
            self[piece] = ids
        return ids


class ByteBPE:
    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.split = Splitter(pattern)
        self.matcher = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.matcher.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        self.matcher.make_automaton()
        self.pieces = Pieces(self.piece, {})
        self.seams: dict[tuple[int, int], bool] = {}
        every = range(max(self.tokens) + 1)
        self.size = [len(self.tokens.get(rank, b"")) for rank in every]
        #: the longest token that a token begins with, itself left out
        self.prefix = [next((self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1)
                             if token[:n] in self.ranks), None)
                       for token in (self.tokens.get(rank, b"") for rank in every)]
        #: the two tokens whose merge makes a token; none for single bytes
        self.halves: dict[int, tuple[int, int]] = {}
        for rank in sorted(self.tokens):
            if made := self.made_of(rank):
                self.halves[rank] = made

    def made_of(self, rank: int) -> tuple[int, int] | None:
        token, of = self.tokens[rank], self.ranks.get
        cuts = [(left, right) for n in range(1, len(token))
                if (left := of(token[:n], rank)) < rank and (right := of(token[n:], rank)) < rank]
        if len(cuts) < 2:
            return cuts[0] if cuts else None
        return next((cut for cut in cuts if self.seam_stays(*cut, below=rank)), None)

    def seam_stays(self, left: int, right: int, below: float = float("inf")) -> bool:
        """Whether merges of ranks less than `below` leave the seam between two tokens.

        Seen backwards in time: the pair at the seam lives until one of the two is merged away from
        it. It is merged itself if its own rank comes first; of equal ranks the leftmost does.
        """
        tokens, of, halves = self.tokens, self.ranks.get, self.halves
        while True:
            rank = of(tokens[left] + tokens[right])
            if rank is not None and rank < below:
                return False
            a, b = halves.get(left), halves.get(right)
            if a and (not b or left > right):  # the left token's merge came last
                below, left = left, a[1]
            elif b:  # among equals the right one's did; a pair across the seam goes before it
                below, right = right + 0.5, b[0]
            else:
                return True

    def fit(self, left: int, right: int) -> bool:
        if len(self.seams) >= KNOWN_PAIRS:
            self.seams.clear()
        stays = self.seams[left, right] = self.seam_stays(left, right)
        return stays

    def piece(self, data: bytes) -> list[int]:
        """Ids of the bytes of one match of the pattern."""
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        size, prefix, seams = self.size, self.prefix, self.seams
        longest = [0] * len(data)
        for end, (rank, back) in self.matcher.iter(data.decode("latin-1")):
            longest[end - back] = rank  # ends go up, so the longest one stays
        blocked = bytearray(len(data) + 1)
        ids: list[int] = []
        at, last, token = 0, None, longest[0]
        while True:
            while token is not None:
                end = at + size[token]
                if not blocked[end]:
                    if last is None or (stays := seams.get((last, token))):
                        break
                    if stays is None and self.fit(last, token):
                        break
                token = prefix[token]
            if token is None:
                blocked[at] = 1
                token = ids.pop()
                last = ids[-1] if ids else None
                at -= size[token]
                continue
            ids.append(token)
            if end == len(data):
                return ids
            at, last, token = end, token, longest[end]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, packed as native 32-bit integers."""
        if len(self.pieces) >= KNOWN_PIECES:
            self.pieces = Pieces(self.piece, dict(self.pieces))
        return b"".join(map(self.pieces.__getitem__, self.split(text)))


@lru_cache(maxsize=1)
def tokenizer(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(path, pattern)


@lru_cache(maxsize=1)
def token_bytes(path: str) -> pa.Array:
    """The bytes of every id, in the order of the ids; null where the vocabulary has a gap."""
    tokens = {rank: token for token, rank in read_ranks(path).items()}
    return pa.array([tokens.get(rank) for rank in range(max(tokens) + 1)], pa.binary())


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def bpe_encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(id, ids) of every whole text, by the ranks of a .tiktoken file; special strings are plain text.

    A null text counts as empty and has an empty list. A null id stays null, repeated rows and ids give
    one row each, an empty table none; other columns are neither read nor returned. A text of any
    length is encoded whole, in time linear in it, by one task; there are no ties to decide.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def encoded(batches):
        bpe = tokenizer(path, pattern)
        for batch in sliced(batches):
            packed = [bpe.encode(t) if t else b"" for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, packed)]) // 4
            flat = np.frombuffer(b"".join(packed), np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                names=[id_col, "ids"])

    return docs.select(id_col, text_col).mapInArrow(encoded, f"`{id_col}` {kind}, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, decoded): the bytes that a list of ids stands for.

    A null list stays null, an empty one gives no bytes; an id that the vocabulary lacks is an error.
    The bytes of a list that was cut somewhere need not be valid UTF-8, hence a binary column.
    """
    kind = encoded.schema[id_col].dataType.simpleString()

    def decoded(batches):
        tokens = token_bytes(path)
        for batch in sliced(batches):
            ids = batch.column(1)
            flat = tokens.take(ids.flatten())
            if flat.null_count:
                raise ValueError("an id that the vocabulary lacks")
            # the tokens' bytes lie one after another: a row's are cut out at its first and last token
            ends = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset:]
            lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
            starts = ends[np.concatenate([[0], np.cumsum(lengths)])] if len(flat) else np.zeros(len(ids) + 1, np.int32)
            found = pa.Array.from_buffers(pa.binary(), len(ids), [
                pc.is_valid(ids).buffers()[1] if ids.null_count else None, pa.py_buffer(starts),
                flat.buffers()[2]])
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, found], names=[id_col, "ids", "decoded"])

    return encoded.select(id_col, F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(
        decoded, f"`{id_col}` {kind}, ids array<int>, decoded binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every whole text, after encoding and decoding."""
    there_and_back = bpe_decode(bpe_encode(docs, path, pattern, id_col, text_col), path, id_col)
    return there_and_back.select(
        id_col, F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
