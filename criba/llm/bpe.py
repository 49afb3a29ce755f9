"""Byte-pair encoding with a public vocabulary, by a contiguous rank array per word."""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from criba.session import worker_memory

# The folder and file of the vocabulary, parameters of every function below.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that parts a text into words before the merges.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words of more bytes than this are merged through a heap, which gives the same ids.
SHORT_WORD = 128
#: Words kept with their ids in a worker; beyond it the memory starts anew.
REMEMBERED = 400_000

_NEVER = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank (the id) of a vocabulary file with base64 tokens."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def encode_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: boundaries and adjacent ranks in two contiguous arrays.

    ``at`` has the starts of the parts and the end; ``rank[i]`` is that of parts i
    and i + 1 joined. While some pair has a rank, the least (the leftmost of equals)
    is joined by deleting the boundary between, and its two neighbours are looked up
    again.
    """
    at = list(range(len(word) + 1))
    rank = [ranks.get(word[i : i + 2], _NEVER) for i in range(len(word) - 1)]
    while rank:
        least = min(rank)
        if least == _NEVER:
            break
        i = rank.index(least)
        del at[i + 1], rank[i]
        if i < len(rank):
            rank[i] = ranks.get(word[at[i] : at[i + 2]], _NEVER)
        if i:
            rank[i - 1] = ranks.get(word[at[i - 1] : at[i + 1]], _NEVER)
    return [ranks[word[a:b]] for a, b in zip(at, at[1:])]


def encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids in n log n steps, for words too long to scan again and again."""
    n = len(word)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (r := ranks.get(word[i : after[j]])) is not None:
            heapq.heappush(heap, (r, i, after[j]))

    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or after[j] != end:
            continue
        alive[j] = False
        after[i] = end
        if end < n:
            before[end] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : after[i]]])
        i = after[i]
    return out


class Encoder:
    """Encodes texts; remembers the ids of words it has met."""

    def __init__(self, path: str = VOCABULARY):
        self.ranks = load_ranks(path)
        self.words = regex.compile(WORDS)
        self.known: dict[str, list[int]] = {}

    def word(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "replace")
        whole = self.ranks.get(raw)
        if whole is not None:
            ids = [whole]
        elif len(raw) <= SHORT_WORD:
            ids = encode_short(raw, self.ranks)
        else:
            return encode_long(raw, self.ranks)
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[word] = ids
        return ids

    def extend(self, out: array, text: str | None) -> None:
        """Appends the ids of ``text``; a null text has none."""
        if not text:
            return
        known = self.known
        for word in self.words.findall(text):
            ids = known.get(word)
            out.extend(self.word(word) if ids is None else ids)


def encode(df: DataFrame, key: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """``key`` and ``ids`` (array of int): the token ids of each text, no special tokens.

    One row for each row of ``df``, repeated ones too. An empty and a null text have
    an empty list; texts of any length are encoded whole; strings of special tokens
    are ordinary text. Other columns are not read. Nothing is shuffled.
    """
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_memory(f"bpe {path}", lambda: Encoder(path))
        for batch in batches:
            ids, ends = array("i"), array("i", [0])
            for value in batch.column(1).to_pylist():
                encoder.extend(ids, value)
                ends.append(len(ids))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["k", "ids"])

    found = df.selectExpr(f"`{key}` as k", f"`{text}` as t").mapInArrow(run, f"k {kind}, ids array<int>")
    return found.withColumnRenamed("k", key)


def token_counts(df: DataFrame, key: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """``key`` and ``tokens`` (int): the number of token ids of each text, 0 for null and empty."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_memory(f"bpe {path}", lambda: Encoder(path))
        for batch in batches:
            counts = array("i")
            for value in batch.column(1).to_pylist():
                ids = array("i")
                encoder.extend(ids, value)
                counts.append(len(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int32())], ["k", "tokens"])

    found = df.selectExpr(f"`{key}` as k", f"`{text}` as t").mapInArrow(run, f"k {kind}, tokens int")
    return found.withColumnRenamed("k", key)
