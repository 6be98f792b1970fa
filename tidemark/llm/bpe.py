"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

A text is cut at special tokens, then into pretokens. Of every prefix of a pretoken the last
token of its encoding is unique, and it is found from left to right: an automaton over all
tokens lists those that end at a position, and the one is right that may stand after the
last token of the prefix before it. Whether two tokens may stand side by side is decided by
undoing their merges from the latest back: if a merge across the border would have come
before a merge already undone, they may not. Back-pointers from the end then give the tokens.
The work is linear in the length of a pretoken and exact, without a merge loop.

Encodings of short pretokens are remembered up to ``CACHE`` in each worker, which bounds
memory. Texts are encoded whole; a text is held by one task.

Defined cases: a null text is empty; an empty text has no tokens; repeated rows are encoded
each; an empty table gives an empty result. Only the named columns of the input are read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import table

CACHE = 250_000
CACHED_CHARS = 40
BASES = 256
# Fixed value: the public pretoken pattern of byte-level vocabularies, with the white space
# of Unicode spelt out (this library counts four more controls as white space).
_WS = r"\t-\r \x85\xa0  -     　"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _WS + r"\p{L}\p{N}]+|["
    + _WS + r"]+(?![^" + _WS + r"])|[" + _WS + r"]+"
)


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary file: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


class Encoder:
    """Tokens carry numbers in order of their making: bytes first, then merges by rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"]:
            raise ValueError(f"{path} is not a plain byte-level vocabulary")
        vocab, letters = model["vocab"], byte_alphabet()
        byte_of = {c: b for b, c in letters.items()}
        number = {letters[b]: b for b in range(BASES)}
        self.left, self.right = [-1] * BASES, [-1] * BASES
        self.joined: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            if a + b in number:
                raise ValueError(f"two merges make the same token: {a + b!r}")
            self.joined[number[a], number[b]] = number[a + b] = len(self.left)
            self.left.append(number[a])
            self.right.append(number[b])
        self.ids = [0] * len(number)
        self.raw = [b""] * len(number)
        self.matches = ahocorasick.Automaton()
        for token, n in number.items():
            self.ids[n] = vocab[token]
            self.raw[n] = bytes(byte_of[c] for c in token)
            self.matches.add_word(self.raw[n].decode("latin-1"), (n, len(token)))
        self.matches.make_automaton()
        self.bytes_of = {vocab[t]: self.raw[n] for t, n in number.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, n in self.special.items():
            self.bytes_of[n] = content.encode()
        self.cut = regex.compile("|".join(regex.escape(c) for c in sorted(self.special, key=len, reverse=True)))
        self.pretokens = regex.compile(PATTERN).findall
        self.apart: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[str, int, bytes]] = {}

    def may_follow(self, a: int, b: int) -> bool:
        """Whether the encoding of the two tokens' bytes keeps them as they are."""
        left, right, joined = self.left, self.right, self.joined
        limit = len(left)
        while True:
            made = joined.get((a, b))
            if made is not None and made < limit:
                return False
            if a > b:
                if a < BASES:
                    return True
                limit, a = a, right[a]
            else:
                if b < BASES:
                    return True
                # Of equal merges the left one comes first, hence the one more.
                limit, b = b + 1, left[b]

    def tokens(self, piece: bytes) -> list[int]:
        """Token numbers of one pretoken."""
        last = [-1] * (len(piece) + 1)
        size = [0] * (len(piece) + 1)
        apart = self.apart
        for end, (token, length) in self.matches.iter(piece.decode("latin-1")):
            end += 1
            if size[end]:
                continue
            before = last[end - length]
            if before >= 0:
                pair = (before, token)
                good = apart.get(pair)
                if good is None:
                    good = self.may_follow(before, token)
                    if len(apart) < CACHE:
                        apart[pair] = good
                if not good:
                    continue
            last[end], size[end] = token, length
        out, at = [], len(piece)
        while at:
            out.append(last[at])
            at -= size[at]
        out.reverse()
        return out

    def encode(self, text: str) -> list[int]:
        out = []
        for part, special in self._parts(text):
            if special is not None:
                out.append(special)
            for word in self.pretokens(part):
                out += (self.ids[t] for t in self.tokens(word.encode()))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", "replace")

    def _parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Stretches of plain text, each with the special token before it."""
        at, special = 0, None
        for m in self.cut.finditer(text) if self.special else ():
            yield text[at : m.start()], special
            at, special = m.end(), self.special[m.group()]
        yield text[at:], special

    def _word(self, word: str) -> tuple[str, int, bytes]:
        ids = [self.ids[t] for t in self.tokens(word.encode())]
        got = (",".join(map(str, ids)), len(ids), b"".join(self.bytes_of[i] for i in ids))
        if len(word) <= CACHED_CHARS and len(self.known) < CACHE:
            self.known[word] = got
        return got

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, and digests of the listed ids and of what they decode to."""
        known, found = self.known, []
        for part, special in self._parts(text):
            if special is not None:
                found.append((str(special), 1, self.bytes_of[special]))
            found += [known.get(w) or self._word(w) for w in self.pretokens(part)]
        ids = hashlib.sha256(",".join([f[0] for f in found]).encode())
        back = b"".join([f[2] for f in found]).decode("utf-8", "replace")
        return sum([f[1] for f in found]), ids.hexdigest(), hashlib.sha256(back.encode()).hexdigest()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, made once in each worker."""
    return Encoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``_ids array<int>`` of its column ``text``."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        made = encoder(path or default_path())
        return pd.Series([made.encode(t or "") for t in texts])

    return docs.withColumn("_ids", ids("text"))


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """``tokens`` with ``_text``, the decoded text of its column ``_ids``."""

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        made = encoder(path or default_path())
        return pd.Series([made.decode(list(i)) if i is not None else "" for i in ids])

    return tokens.withColumn("_text", text("_ids"))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with the struct ``_tokens``: number, digest of ids, digest of the decoded."""

    @F.pandas_udf("n long, ids string, decoded string")
    def digest(texts: pd.Series) -> pd.DataFrame:
        made = encoder(path or default_path())
        return pd.DataFrame([made.digest(t or "") for t in texts], columns=["n", "ids", "decoded"])

    return docs.withColumn("_tokens", digest("text"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        F.col("_tokens.n").alias("n_tokens"),
        F.col("_tokens.ids").alias("ids_sha256"),
        F.col("_tokens.decoded").alias("decoded_sha256"),
    )
