"""Order-preserving packing: the token stream of the documents, in the order they are stored, is
cut into windows of at most ``capacity`` tokens by dynamic programming.

A cut may fall where a document ends (free), where a sentence ends (``sentence`` tokens of
penalty) and, so that long sentences fit, at every ``stride`` tokens of a longer one (``inside``).
The least cost of all ways to cut the stream before each such place is found from left to right:

    cost[j] = penalty[j] + per_window + min over i of (cost[i] + padding(at[j] - at[i]))

where a window is padded to ``capacity`` unless its length is a power of two. The padded windows
need the least ``cost[i] + at[i]`` of the places within reach, which a monotone queue holds at
its head; those that need no padding are looked up by their distance. So the work is linear.

Each task cuts the rows of its own partition, without a shuffle. It solves the stream in blocks of
about ``BLOCK`` tokens, commits all but the last windows of a block and takes their tokens into the
next, so memory is bounded and no block ends in a short window. Only a partition does: close
to its end sums of a few powers of two are offered as cuts too. A retried task reads the same
rows in the same order and cuts them alike.

Tokens are those of the library's tokenizer for a vocabulary file, then ``END``. Its model sees
each word once and its tokens are remembered, up to ``CACHE`` words in a worker; the library
splits words of rare characters itself, and texts with special tokens or rare blanks whole.

Defined cases: a null or empty text is its end mark alone; texts are taken whole; repeated rows
and null or repeated ids are packed each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.bpe import byte_alphabet
from tidemark.llm.common import table

END = 1
BLOCK = 1 << 20
CACHE = 400_000
CACHED_CHARS = 48


@dataclass(frozen=True)
class Rule:
    capacity: int = 2048
    sentence: int = 8
    inside: int = 64
    per_window: int = 16
    stride: int = 256


class Words:
    """Token ids of texts, as little-endian 32-bit numbers, equal to the library's own."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.model = self.whole.model
        # Special tokens, and characters that only one of the two libraries takes for blanks.
        self.odd = re.compile(r"<\||[\x1c-\x1f\u180e]").search
        # Characters that no normal form changes and that lower-case to one character.
        own = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x180)) if c != 0x130]
        letters, numbers = ("".join(c for c in own if unicodedata.category(c)[0] == kind) for kind in "LN")
        self.plain = re.compile(f"[\t\n\r {re.escape(''.join(own))}]*").fullmatch
        # Fixed value: the split pattern of the vocabulary file, for such characters.
        self.parts = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\\s{letters}{numbers}]+").findall
        self.letters = byte_alphabet()
        self.known: dict[str, bytes] = {}

    def _new(self, word: str, plain: bool) -> bytes:
        if plain:
            raw = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            ids = [token.id for token in self.model.tokenize(raw)]
        else:
            ids = self.whole.encode(word, add_special_tokens=False).ids
        got = np.array(ids, "<u4").tobytes()
        if len(word) <= CACHED_CHARS and len(self.known) < CACHE:
            self.known[word] = got
        return got

    def _plain(self, text: str) -> bytes:
        known, new = self.known.get, self._new
        return b"".join([known(p) or new(p, True) for p in self.parts(text.lower())])

    def encode(self, text: str) -> bytes:
        if self.odd(text):
            return self._new(text, False)
        if self.plain(text):
            return self._plain(text)
        known, new, plain = self.known.get, self._new, self.plain
        return b"".join([self._plain(w) if plain(w) else known(w) or new(w, False) for w in text.split()])

    @lru_cache(maxsize=1)
    def closing(self) -> np.ndarray:
        """For each id, whether the token ends a sentence."""
        vocab = self.whole.get_vocab()
        out = np.zeros(max(vocab.values()) + 1, bool)
        close = re.compile(r"[^\w]*[.!?][^\w]*</w>").fullmatch
        out[[i for token, i in vocab.items() if close(token)]] = True
        return out


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    """Made once in each worker."""
    return Words(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def least_cuts(at: np.ndarray, penalty: np.ndarray, rule: Rule = Rule()) -> list[int]:
    """Places (numbers into ``at``) of the cheapest way to cut a stream, first and last included.

    ``at`` rises strictly from 0 to the length of the stream by steps of at most ``capacity``."""
    place, extra = at.tolist(), penalty.tolist()
    unpadded: dict[int, list[int]] = {}
    free = 1
    while free < rule.capacity:
        i = np.searchsorted(at, at - free)
        for j in np.flatnonzero(at[i] == at - free).tolist():
            unpadded.setdefault(j, []).append(int(i[j]))
        free *= 2
    cost, back = [0] * len(place), [0] * len(place)
    queue = deque([0])  # places within reach, cost + place rising
    for j in range(1, len(place)):
        here = place[j]
        reach = here - rule.capacity
        while place[queue[0]] < reach:
            queue.popleft()
        best = queue[0]
        least = cost[best] + rule.capacity - (here - place[best])
        for i in unpadded.get(j, ()):
            if cost[i] < least:
                best, least = i, cost[i]
        cost[j], back[j] = least + extra[j] + rule.per_window, best
        key = cost[j] + here
        while queue and cost[queue[-1]] + place[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    out = [len(place) - 1]
    while out[-1]:
        out.append(back[out[-1]])
    return out[::-1]


def places(closes: np.ndarray, first: np.ndarray, last: bool, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Where a stream may be cut, and the penalty there. ``closes`` marks tokens that end a
    sentence, ``first`` are the first tokens of documents; ``last`` says that nothing follows."""
    n = len(closes)
    price = np.full(n + 1, -1, np.int64)
    price[1:][closes] = rule.sentence
    price[first] = 0
    price[[0, n]] = 0
    if last:
        powers = 1 << np.arange(rule.capacity.bit_length() - 1)
        two = (powers[:, None] + powers).ravel()
        sums = n - np.unique(np.concatenate([powers, two, (two[:, None] + powers).ravel()]))
        sums = sums[sums > 0]
        price[sums[price[sums] < 0]] = rule.inside
    at = np.flatnonzero(price >= 0)
    steps = (np.diff(at) - 1) // rule.stride
    if steps.any():
        more = np.repeat(at[:-1], steps)
        nth = np.arange(len(more)) - np.repeat(np.cumsum(steps) - steps, steps) + 1
        price[more + nth * rule.stride] = rule.inside
        at = np.flatnonzero(price >= 0)
    return at, price[at]


class Packer:
    """Windows of one stream of documents; ``add`` each, then take what ``pieces`` gives."""

    def __init__(self, closing: np.ndarray, rule: Rule, sequence: int):
        self.closing, self.rule, self.sequence = closing, rule, sequence
        self.held: list[bytes] = []
        self.ids: list = []
        self.tokens: list[int] = []
        self.first: list[int] = []  # of each document, in the stream held; the first may be negative
        self.size = 0

    def add(self, doc_id, raw: bytes) -> None:
        self.ids.append(doc_id)
        self.tokens.append(len(raw) // 4)
        self.first.append(self.size)
        self.held.append(raw)
        self.size += len(raw) // 4

    def pieces(self, last: bool) -> dict[str, list]:
        """Columns of the pieces of committed windows."""
        if not self.size:
            return {}
        raw = b"".join(self.held)
        first = np.array(self.first, np.int64)
        closes = self.closing[np.frombuffer(raw, "<u4")]
        at, price = places(closes, first[first > 0], last, self.rule)
        cuts = at[least_cuts(at, price, self.rule)]
        if not last:
            # Windows close to the end may change with what follows.
            cuts = cuts[cuts <= max(self.size - 4 * self.rule.capacity, 0)]
        stop = int(cuts[-1])
        start = np.union1d(cuts[:-1], first[(first > 0) & (first < stop)])
        end = np.append(start[1:], stop)
        doc = np.searchsorted(first, start, side="right") - 1
        window = np.searchsorted(cuts, start, side="right") - 1
        out = {
            "doc_id": [self.ids[d] for d in doc.tolist()],
            "start": (start - first[doc]).tolist(),
            "length": (end - start).tolist(),
            "doc_tokens": [self.tokens[d] for d in doc.tolist()],
            "sequence_id": (window + self.sequence).tolist(),
            "offset": (start - cuts[window]).tolist(),
            "ids": [raw[4 * a : 4 * b] for a, b in zip(start.tolist(), end.tolist())],
        }
        self.sequence += len(cuts) - 1
        keep = int(np.searchsorted(first, stop, side="right")) - 1 if stop < self.size else len(first)
        self.ids, self.tokens = self.ids[keep:], self.tokens[keep:]
        self.first = (first[keep:] - stop).tolist()
        self.held, self.size = [raw[4 * stop :]], self.size - stop
        return out


def pack(docs: DataFrame, path: str | None = None, rule: Rule = Rule()) -> DataFrame:
    """One row for each piece of a document: ``doc_id, start, length, doc_tokens, sequence_id,
    offset, ids``; ``ids`` are the piece's tokens as little-endian 32-bit numbers."""
    columns = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    end = np.array([END], "<u4").tobytes()

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = words(path or default_path())
        packer = Packer(made.closing(), rule, TaskContext.get().partitionId() << 36)
        kind = None

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            got = packer.pieces(last)
            if got and got["start"]:
                arrays = [pa.array(got.pop("doc_id"), kind)]
                raw = pa.array(got.pop("ids"), pa.binary())
                arrays += [pa.array(v, pa.int64()) for v in got.values()] + [raw]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *got, "ids"])

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                packer.add(doc_id.as_py(), made.encode(text.as_py() or "") + end)
                if packer.size >= BLOCK:
                    yield from flush(False)
        yield from flush(True)

    return docs.select("doc_id", "text").mapInArrow(take, f"doc_id {doc_id}, {columns}")


def padding(lengths: Sequence[int], capacity: int = Rule.capacity) -> int:
    """Padding of sequences of these lengths."""
    return sum(0 if n & (n - 1) == 0 else capacity - n for n in lengths)


def op13_ordered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )
