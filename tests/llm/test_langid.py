from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import langid

DOCS = "doc_id long, text string, lang string, _best string, _row int"


def plain_grams(text) -> list[int]:
    """Bucket of every n-gram of a text, one by one."""
    chars = [c if c.isalpha() else " " for c in (text or "").lower()]
    runs = [c for i, c in enumerate(chars) if c != " " or i == 0 or chars[i - 1] != " "]
    if not any(c != " " for c in runs):
        return []
    # A text ends in a blank.
    runs += [" "] if runs[-1] != " " else []
    out = []
    for n in langid.SIZES:
        for i in range(len(runs) - n + 1):
            gram = runs[i : i + n]
            if gram[0] == " " if n < 3 else all(c == " " for c in gram):
                continue
            code = 0
            for c in gram:
                code = (code * (1 << 21) + ord(c)) % (1 << 64)
            hashed = (code + n) * 0x9E3779B97F4A7C15 % (1 << 64)
            out.append((hashed >> (64 - langid.BUCKET_BITS)) + (langid.SIZES.index(n) << langid.BUCKET_BITS))
    return out


def plain_bayes(rows) -> dict:
    """Language and posterior of each row, by sums over n-grams in 64-bit floats."""
    counts = {}
    for doc_id, text, lang in rows:
        if doc_id is not None and lang is not None and zlib.crc32(str(doc_id).encode()) % 4 != 2:
            counts.setdefault(lang, Counter()).update(plain_grams(text))
    size = 1 << langid.BUCKET_BITS
    logs = {}
    for lang, own in counts.items():
        totals = [sum(n for b, n in own.items() if b // size == k) + 0.5 * size for k in range(len(langid.SIZES))]
        logs[lang] = lambda b, own=own, totals=totals: math.log((own[b] + 0.5) / totals[b // size])
    out = {}
    for doc_id, text, _ in rows:
        grams = plain_grams(text)
        sums = {lang: sum(map(log, grams)) for lang, log in logs.items()}
        if not grams or not sums:
            out[doc_id] = ("und", 0.0)
            continue
        best = max(sorted(sums), key=sums.get)
        out[doc_id] = (best, 1 / sum(math.exp(s - sums[best]) for s in sums.values()))
    return out


def invented(langs: int, rows: int, seed: int):
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzäöüéèñ"
    own = {f"l{k:03}": [[rng.choice(letters) for _ in range(3)] for _ in range(12)] for k in range(langs)}
    out = []
    for i in range(rows):
        lang = f"l{i % langs:03}"
        words = ["".join(rng.choice(own[lang])) + "".join(rng.choice(own[lang])) for _ in range(rng.randrange(3, 9))]
        out.append((i, " ".join(words).title() + "... 12", lang))
    return out


@pytest.mark.parametrize("langs, block", [(3, 256), (5, 2), (300, 128)])
def test_equal_to_plain_naive_bayes(spark, langs, block):
    """Also with more languages than a block holds."""
    rows = invented(langs, 4 * langs + 40, langs)
    rows += [(10_000, None, "l001"), (10_001, "", None), (10_002, "12 --", "none"), (10_003, "Abc", None), (10_005, "9", "none")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)
    model = langid.train(docs, lang_block=block)
    assert model.count() == langs + 1
    want = plain_bayes(rows)
    got = langid.identify(docs.drop("_best", "_row"), model).collect()
    assert len(got) == len(rows)
    for r in got:
        lang, score = want[r["doc_id"]]
        assert r["_score"] == pytest.approx(score, abs=1e-3)
        assert r["_lang"] == lang or score < 0.51


def test_query_against_plain_naive_bayes(spark, tmp_path):
    rows = invented(4, 120, 9) + [(500, None, "l001"), (None, "Some words", "l002"), (501, "7", None)]
    spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    want = plain_bayes(rows)
    got = langid.op8_language_id(spark, str(tmp_path))
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    for r in got.collect():
        lang, score = want[r["doc_id"]]
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, abs=1e-3)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_gathered_in_parts(monkeypatch):
    """Sums do not depend on how many entries of the matrix are taken at once."""
    logs = np.log(np.random.default_rng(3).random((langid.WIDTH, 7)))
    texts = ["one two three " * 30, None, "", "vier fünf", "x"]
    whole = langid.sums_of(texts, logs)
    monkeypatch.setattr(langid, "GATHER", 70)
    parts = langid.sums_of(texts, logs)
    assert np.allclose(whole[0], parts[0]) and (whole[1] == parts[1]).all()
