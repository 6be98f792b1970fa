from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidemark.llm import windows

DOCS = "doc_id long, text string, start string, ids int, length int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(windows.default_path())


def ids_of(library, text) -> list[int]:
    return [*library.encode(text or "", add_special_tokens=False).ids, windows.END]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.text("aA'sSt .,!\t\n1²éÉİıſΣ́<|endoftext|>", max_size=30))
def test_ids_are_the_library_s(text):
    made = windows.words(windows.default_path())
    assert np.frombuffer(made.encode(text), "<u4").tolist() == made.whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "<|startoftext|><|x|>", "a\x1cb", "a\x85b\xa0c", "ΑΣ ΣΑ", "<| plain"])
def test_special_tokens_and_rare_blanks(text):
    made = windows.words(windows.default_path())
    assert np.frombuffer(made.encode(text), "<u4").tolist() == made.whole.encode(text, add_special_tokens=False).ids


def cheapest(at, price, rule):
    """Cost of every way to cut, by recursion over the last window."""
    cost = [0]
    for j in range(1, len(at)):
        ways = []
        for i in range(j):
            n = int(at[j] - at[i])
            if n <= rule.capacity:
                pad = 0 if n & (n - 1) == 0 else rule.capacity - n
                ways.append(cost[i] + pad)
        cost.append(min(ways) + int(price[j]) + rule.per_window)
    return cost[-1]


@pytest.mark.parametrize("seed", range(40))
def test_cuts_are_the_cheapest(seed):
    rng = np.random.default_rng(seed)
    rule = windows.Rule(capacity=32, sentence=2, inside=7, per_window=int(rng.integers(0, 5)), stride=9)
    n = int(rng.integers(1, 400))
    closes = rng.random(n) < rng.choice([0.0, 0.05, 0.3])
    first = np.flatnonzero(rng.random(n) < 0.03)
    at, price = windows.places(closes, first[first > 0], bool(seed % 2), rule)
    cuts = windows.least_cuts(at, price, rule)
    assert cuts[0] == 0 and cuts[-1] == len(at) - 1 and np.diff(at).max() <= rule.capacity
    lengths = np.diff(at[cuts])
    assert lengths.max() <= rule.capacity
    got = windows.padding(lengths.tolist(), rule.capacity) + int(price[cuts[1:]].sum()) + rule.per_window * len(lengths)
    assert got == cheapest(at, price, rule)


def check(library, rows, pieces, capacity=2048):
    """Each id of each row in exactly one piece, gapless in sequences; lengths of sequences."""
    by_start, sequences, docs = {}, {}, {}
    for p in pieces:
        docs.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    want = {}
    for doc_id, text, *_ in rows:
        ids = ids_of(library, text)
        want.setdefault((doc_id, len(ids)), []).append(ids)
    assert set(docs) == set(want)
    for key, found in docs.items():
        texts = want[key]
        assert sum(p["length"] for p in found) == key[1] * len(texts)
        if len(texts) == 1:
            at = 0
            for p in sorted(found, key=lambda p: p["start"]):
                assert p["start"] == at and p["length"] > 0
                raw = np.array(texts[0][at : at + p["length"]], "<u4").tobytes()
                assert p["ids_crc32"] == zlib.crc32(raw)
                at += p["length"]
            assert at == key[1]
    sizes = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        sizes.append(at)
    return sizes


def test_query_on_the_given_table(spark, sf_dir, library):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = windows.op13_ordered_packing(spark, sf_dir)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    sizes = check(library, rows, got.collect())
    assert windows.padding(sizes) <= 0.02 * sum(sizes)


def test_odd_rows(spark, tmp_path, library, monkeypatch):
    """Nulls, empty and long texts, rows that repeat, clashing columns, blocks that end inside a
    document. Small blocks make commits frequent."""
    monkeypatch.setattr(windows, "BLOCK", 12_000)
    rng = random.Random(2)
    words = ["alpha", "Beta.", "gamma,", "don't", "é", "中文", "<|endoftext|>", "12."]
    texts = [None, "", " ", "no end " * 9000, "x" * 20_000, *(" ".join(rng.choices(words, k=rng.randrange(900))) for _ in range(60))]
    rows = [(i if i != 7 else None, t, "s", 1, 2) for i, t in enumerate(texts)] + [(70, "again.", "s", 1, 2)] * 3
    spark.createDataFrame(rows, DOCS).coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    got = windows.op13_ordered_packing(spark, str(tmp_path)).collect()
    sizes = check(library, rows, got)
    assert windows.padding(sizes) <= 0.05 * sum(sizes)


def test_order_is_kept_and_ids_come_out(spark, library):
    rows = [(i, f"Text number {i}. " * (i % 70), "s", 1, 2) for i in range(200)]
    got = windows.pack(spark.createDataFrame(rows, DOCS).coalesce(1)).orderBy("sequence_id", "offset").collect()
    assert [(p["doc_id"], p["start"]) for p in got] == sorted((p["doc_id"], p["start"]) for p in got)
    stream = np.frombuffer(b"".join(p["ids"] for p in got), "<u4").tolist()
    assert stream == [i for _, text, *_ in rows for i in ids_of(library, text)]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert windows.op13_ordered_packing(spark, str(tmp_path)).collect() == []
