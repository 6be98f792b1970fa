from __future__ import annotations

import random

import brute
import oracle
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tidemark import llm


def test_registered():
    names = set(entry.queries())
    assert set(llm.queries()) | {"pipeline"} <= names
    assert set(llm.oracle_sql()) <= names


@pytest.mark.parametrize("key", sorted(llm.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, key):
    problem, rows = oracle.compare(oracle.connect(sf_dir), llm.queries()[key](spark, sf_dir), llm.oracle_sql()[key])
    assert problem is None, problem


NATIVE = ("op2_chat_format", "op5_quality_rules", "op10_secret_scan")


@pytest.mark.parametrize("key", NATIVE)
def test_native_plans_hold_no_python(spark, sf_dir, key):
    plan = llm.queries()[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_pipeline_against_plain_versions(spark, sf_dir):
    """Each stage on what the one before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)

    def step(name, before):
        out = steps[name](spark, before, sf_dir)
        if name != "best_fit_packing":
            assert out.columns == columns
        return spark.createDataFrame(out.collect(), out.schema)

    langs = step("language_id", docs)
    kept = {r["doc_id"]: r["text"] for r in langs.collect()}
    assert all(any(c.isalpha() for c in t or "") for t in kept.values())
    assert all(kept[d] == given[d] for d in kept) and len(kept) >= 0.99 * len(given)

    near = step("minhash_dedup", langs)
    groups = brute.components(list(kept.items()), 5)
    assert {r["doc_id"] for r in near.collect()} == {d for d, (_, root) in groups.items() if d == root}

    cut = step("suffix_dedup", near)
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in near.collect()]
    spans = brute.repeated_bytes([raw for _, raw in rows], 200)
    want = {d: brute.without(raw, s).decode("utf-8", "ignore") for (d, raw), s in zip(rows, spans)}
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == want

    safe = {r["doc_id"]: r for r in step("secret_scan", cut).collect()}
    for d, text in want.items():
        spans = brute.base_spans(text)
        assert not any(text[a:b] in safe[d]["text"] for a, _, b in spans)
        assert spans or "[entropy" in safe[d]["text"] or safe[d]["text"] == text
        assert safe[d]["n_chars"] == len(safe[d]["text"])

    packed = step("best_fit_packing", spark.createDataFrame(list(safe.values()), docs.schema))
    total = {}
    for r in packed.collect():
        assert sum(r["lengths"]) == r["n_tokens"] <= r["capacity"]
        for d, n in zip(r["doc_ids"], r["lengths"]):
            total[d] = total.get(d, 0) + n
    assert total == {d: len(brute.words(r["text"])) + 1 for d, r in safe.items()}


ODD = "_kept string, row long, _text int, text string, _lang string, doc_id long, lang string, _spans string, source string, n_chars long"


def test_pipeline_with_clashing_columns_and_odd_rows(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).collect()
    rows = [("k", 7, 1, r["text"], "x", r["doc_id"], r["lang"], "s", r["source"], r["n_chars"]) for r in given]
    rows += [(None, None, None, None, None, None, None, None, None, None), rows[0], rows[0]]
    rows += [("k", 8, 2, text, "y", 10**6 + i, None, "t", None, None) for i, text in enumerate([None, "", "   ", "12 34"])]
    docs = spark.createDataFrame(rows, ODD)
    extra = ["_kept", "row", "_text", "_lang", "_spans"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        kept = out.collect()
        if name == "best_fit_packing":
            assert sum(r["n_tokens"] for r in kept) > 0
            break
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert {tuple(r[c] for c in extra) for r in kept} <= {("k", 7, 1, "x", "s"), ("k", 8, 2, "y", "t"), (None,) * 5}
        assert kept
        docs = spark.createDataFrame(kept, out.schema)


def test_pipeline_on_an_empty_table(spark, sf_dir):
    docs = spark.createDataFrame([], ODD)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.collect() == []
        if name != "best_fit_packing":
            assert out.columns == docs.columns


def test_stages_leave_odd_texts_alone(spark, sf_dir):
    """Nulls and empty texts past the first stage."""
    rows = [(1, None, "en", None, None), (2, "", None, "s", 0), (None, "some words here", None, None, 15), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    steps = dict(corpus_pipeline.STAGES)
    for name in ("minhash_dedup", "suffix_dedup", "secret_scan"):
        got = steps[name](spark, docs, sf_dir).collect()
        assert sorted(str(r["text"]) for r in got) == sorted(str(r[1]) for r in rows), name
    packed = steps["best_fit_packing"](spark, docs, sf_dir).collect()
    assert sum(r["n_tokens"] for r in packed) == 3 + 4


def test_texts_cross_one_shuffle_when_passages_are_cut(spark, sf_dir):
    """Only spans are joined with the documents; the copy of the texts they were found in is not read again."""
    rng = random.Random(3)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage = line(40) + " é "
    texts = [line(30) + passage + line(30), passage + line(20), line(50), None, "", passage]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = dict(corpus_pipeline.STAGES)["suffix_dedup"](spark, docs, sf_dir)
    assert not [f for f in out.inputFiles() if "anchored-texts" in f]
    raws = [(t or "").encode() for t in texts]
    want = {
        i: None if t is None else brute.without(raw, gone).decode("utf-8", "ignore")
        for i, (t, raw, gone) in enumerate(zip(texts, raws, brute.repeated_bytes(raws, 200)))
    }
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert got == {i: (t, None if t is None else len(t)) for i, t in want.items()}
    assert sum(t != texts[i] for i, t in want.items()) == 3
