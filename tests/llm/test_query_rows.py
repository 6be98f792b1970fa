"""The contract columns of registered queries, row by row, against plain versions."""

from __future__ import annotations

from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark import llm
from tidemark.llm import bpe


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def rows_of(spark, sf_dir, key, ident="doc_id"):
    got = [r.asDict() for r in llm.queries()[key](spark, sf_dir).collect()]
    assert len({r[ident] for r in got}) == len(got)
    return {r[ident]: r for r in got}


def columns(rows, *names):
    return {d: tuple(r[n] for n in names) for d, r in rows.items()}


def test_op1_rows(spark, sf_dir, texts):
    want = {d: (n, root, d == root) for d, (n, root) in brute.components(list(texts.items()), 4).items()}
    got = rows_of(spark, sf_dir, "op1_minhash_dedup")
    assert columns(got, "n_shingles", "component_id", "kept") == want


def test_op4_rows(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").drop("label").toPandas()
    (vector,) = [c for c in given.columns if c != "vec_id"]
    ids, unit = [], []
    for d, v in zip(given["vec_id"], given[vector]):
        v = np.array([np.nan if x is None else x for x in v], float) if v is not None else np.zeros(1)
        if np.isfinite(v).all() and v.any():
            ids.append(d)
            unit.append(v / np.linalg.norm(v))
    close = np.array(unit) @ np.array(unit).T >= 0.9
    union, links = brute.Union(), Counter()
    for i, j in zip(*np.nonzero(close)):
        if i != j:
            links[ids[i]] += 1
            union.join(ids[i], ids[j])
    want = {d: (links[d], union.find(d), d == union.find(d)) for d in given["vec_id"]}
    got = rows_of(spark, sf_dir, "op4_embedding_dedup", "vec_id")
    assert columns(got, "n_links", "component_id", "kept") == want


def test_op5_rows(spark, sf_dir, texts):
    got = rows_of(spark, sf_dir, "op5_quality_rules")
    assert got.keys() == texts.keys()
    for d, text in texts.items():
        want = brute.quality_counts(text)
        n = want["n_words"]
        want["base_failed"] = n < 10 or 100 * want["n_repeat_words"] > 20 * n
        assert {k: got[d][k] for k in want} == want, d
        assert not (got[d]["kept"] and want["base_failed"])


def test_op6_rows(spark, sf_dir, texts):
    plain = Tokenizer.from_file(bpe.default_path())
    plain.no_truncation()
    plain.no_padding()
    want = {}
    for d, text in texts.items():
        ids = plain.encode(text, add_special_tokens=False).ids
        decoded = plain.decode(ids, skip_special_tokens=False)
        want[d] = (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(decoded))
    got = rows_of(spark, sf_dir, "op6_bpe")
    assert columns(got, "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_op7_rows(spark, sf_dir, texts):
    got = rows_of(spark, sf_dir, "op7_hilbert_shards")
    want = {d: (len(t.encode()) + 16, brute.crc(t), "rows", None) for d, t in texts.items()}
    assert columns(got, "size", "text_crc32", "law", "grown_shard") == want
    slots = defaultdict(list)
    for r in got.values():
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_op9_rows(spark, sf_dir, texts):
    raws = [t.encode() for t in texts.values()]
    want = {}
    for d, raw, spans in zip(texts, raws, brute.repeated_bytes(raws, 200)):
        kept = brute.without(raw, spans)
        want[d] = (len(raw), len(raw) - len(kept), len(spans), brute.sha(kept))
    got = rows_of(spark, sf_dir, "op9_suffix_dedup")
    assert columns(got, "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_op10_rows(spark, sf_dir, texts):
    got = rows_of(spark, sf_dir, "op10_secret_scan")
    assert got.keys() == texts.keys()
    order = ("assign", "access", "hex")
    for d, text in texts.items():
        spans = brute.base_spans(text)
        kinds = Counter(k for _, k, _ in spans)
        want = (*(kinds[k] for k in order), brute.sha(brute.listed(spans)))
        row = got[d]
        assert (row["n_assign"], row["n_access"], row["n_hex"], row["base_sha256"]) == want, d
        # The base spans stay, in their order, among those the method adds.
        listed = row["spans"].split(",") if row["spans"] else []
        assert [s for s in listed if s.split(":")[0] in order] == [brute.listed([s]) for s in spans], d
