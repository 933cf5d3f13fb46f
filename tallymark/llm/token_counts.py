"""Token counts by heap-and-linked-list byte-pair merging.

A word starts as one symbol per byte (the last one marked as the word's end). A heap holds the
adjacent pairs that have a rank; the lowest rank, leftmost first, is popped and merged until no
ranked pair is left. The count is the initial symbols less the merges; no identifier is emitted.
Texts are cut into words just as the tokenizer file says (NFC, lower case, white space dropped),
and a worker remembers the counts of the words it has seen.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections import Counter
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tallymark.llm.common import CACHE


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def unassigned(text: str) -> bool:
    """Whether it has characters that this Python's Unicode tables don't know, though a library's may."""
    return not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(text))


class WordBPE:
    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        tail = model.get("end_of_word_suffix") or ""
        letters = byte_symbols()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.inner = [vocab.get(c) for c in letters]
        self.last = [vocab.get(c + tail) for c in letters]
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        #: rank of a pair, its two ids packed into one number; and the id that each rank makes
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (left, right) in enumerate(pairs):
            self.ranks[vocab[left] << 32 | vocab[right]] = rank
            self.made.append(vocab[left + right])
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split.replace(r"\s", r"\p{White_Space}"))
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.markers = special
        self.counts: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Tokens of one word: symbols less merges."""
        data = word.encode("utf-8", "surrogatepass")
        symbols = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        symbols = [s for s in symbols if s is not None]  # the library drops symbols it doesn't know
        n = len(symbols)
        rank_of, made = self.ranks.get, self.made
        heap = [rank << 32 | i for i, rank in enumerate(
            [rank_of(a << 32 | b) for a, b in zip(symbols, symbols[1:])]) if rank is not None]
        heapq.heapify(heap)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        done = 0
        while heap:
            top = heapq.heappop(heap)
            rank, i = top >> 32, top & 0xFFFFFFFF
            j = after[i]
            if j < 0 or symbols[i] < 0 or rank_of(symbols[i] << 32 | symbols[j]) != rank:
                continue  # one of the two has been merged since
            whole = made[rank]
            symbols[i], symbols[j] = whole, -1
            done += 1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (rank := rank_of(whole << 32 | symbols[k])) is not None:
                    heapq.heappush(heap, rank << 32 | i)
            if (h := before[i]) >= 0 and (rank := rank_of(symbols[h] << 32 | whole)) is not None:
                heapq.heappush(heap, rank << 32 | h)
        return n - done

    def piece(self, text: str) -> int:
        if not text.isascii():
            if unassigned(text):
                return self.total(self.cut(text))
            text = unicodedata.normalize("NFC", text)
        # letter by letter where a word-final sigma would differ
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        return self.total(self.words.findall(text))

    def cut(self, text: str) -> list[str]:
        """Words as the library cuts them, slowly."""
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, w)).decode("utf-8") for w, _ in found]

    def total(self, words: list[str]) -> int:
        known, total = self.counts, 0
        for word, times in Counter(words).items():
            n = known.get(word)
            if n is None:
                if len(known) >= CACHE:
                    known.clear()
                n = self.word(word)
                if len(word) <= 64:
                    known[word] = n
            total += n * times
        return total

    def count(self, text: str) -> int:
        if self.special is None or not any(m in text for m in self.markers):
            return self.piece(text)
        return len(self.special.findall(text)) + sum(map(self.piece, self.special.split(text)))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBPE:
    return WordBPE(path)


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text.

    A null text counts as empty: 0 bytes, 0 tokens. A null id stays null, repeated rows and ids
    give one row each, an empty table none; other columns are neither read nor returned.
    Special strings inside a text count as one token each, as in the library.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def counted(batches):
        bpe = tokenizer(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = [bpe.count(t) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(
        counted, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
