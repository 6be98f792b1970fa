"""Language identification: multinomial naive Bayes over hashed character n-grams.

Text is lower-cased; everything but letters becomes one blank, so that n-grams see the ends
of words. N-grams of 1 to 3 characters hash to 2**15 buckets each. Training counts buckets by
language as Spark rows (a task sends one row for each bucket it has seen) and makes them one
vector a language, the logarithms of the smoothed shares, still on the executors. The matrix is
broadcast in blocks of ``LANG_BLOCK`` languages, of 100 MB at most, and there is no bound on their
number: with more than one block each is scored in a job of its own, which holds that block
only, and the best and the sums of all blocks are joined. Scoring gathers, for each n-gram of a
text, one row of the matrix and sums them, in numpy over blocks of ``PIECE`` characters and
``GATHER`` matrix entries; long texts go through in pieces that overlap by the length of an n-gram
less one, so memory depends neither on the longest text nor on the number of languages.

Training takes at most ``TRAIN_ROWS`` rows of a language on average: each labelled row is
taken with the share that gives this number, decided by a hash of its id. Only labelled rows
whose id passes ``crc32 mod 4 != 2`` are learned from; the rest is held out.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a null id is
neither learned from nor held out; an empty table, or one without labels, yields ``und`` only;
repeated rows count each. Equal scores go to the language that sorts first. A language whose rows
hold no letter has equal shares. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidemark.llm.common import table, written

BUCKET_BITS = 15
SIZES = (1, 2, 3)
TRAIN_ROWS = 4000
LANG_BLOCK = 256
PIECE = 1 << 17
GATHER = 1 << 20
WIDTH = len(SIZES) << BUCKET_BITS
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """For every code point: itself if a letter, else a blank."""
    global _TABLE
    if _TABLE is None:
        points = np.arange(0x110000, dtype=np.uint32)
        chars = points.copy()
        chars[0xD800:0xE000] = 32
        text = chars.astype("<u4").tobytes().decode("utf-32-le")
        alpha = np.fromiter((c.isalpha() for c in text), bool, len(text))
        _TABLE = np.where(alpha, points, 32).astype(np.uint32)
    return _TABLE


_TABLE = None


def pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of code points of about ``PIECE`` with the number of the text of each."""
    overlap = max(SIZES) - 1
    held: list[tuple[int, str]] = []
    size = 0

    def block():
        joined = " ".join(t for _, t in held) + " "
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        owner = np.repeat([i for i, _ in held], [len(t) + 1 for _, t in held])
        return _letters()[points], owner

    for i, text in enumerate(texts):
        text = (text or "").lower()
        for at in range(0, max(1, len(text)), PIECE):
            held.append((i, text[max(0, at - overlap) : at + PIECE]))
            size += len(held[-1][1]) + 1
            if size >= PIECE:
                yield block()
                held, size = [], 0
    if held:
        yield block()


def grams(points: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: the bucket and the text of every n-gram that holds a letter."""
    points = points.astype(np.uint64)
    blank = points == 32
    # A run of blanks counts as one.
    keep = ~blank
    keep[0] = True
    keep[1:] |= ~blank[:-1]
    points, owner, blank = points[keep], owner[keep], blank[keep]
    code = np.zeros(len(points), np.uint64)
    for n in range(1, max(SIZES) + 1):
        m = len(points) - n + 1
        if m <= 0:
            return
        code = code[:m] * np.uint64(1 << 21) + points[n - 1 :]
        if n not in SIZES:
            continue
        mixed = (code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        bucket = (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        good = owner[:m] == owner[n - 1 :]
        good &= ~blank[:m] if n < 3 else ~(blank[:m] & blank[n - 1 :] & blank[1 : m + 1])
        yield bucket[good] + (SIZES.index(n) << BUCKET_BITS), owner[:m][good]


def bucket_counts(labelled: DataFrame) -> DataFrame:
    """``lang, bucket, n`` over rows with ``lang, text``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch["lang"].to_numpy()
            names, code = np.unique(langs.astype(str), return_inverse=True)
            for points, owner in pieces(batch["text"].tolist()):
                for bucket, who in grams(points, owner):
                    lang = code[who]
                    order = np.argsort(lang, kind="stable")
                    for part in np.split(order, np.flatnonzero(np.diff(lang[order])) + 1):
                        if len(part):
                            name = names[lang[part[0]]]
                            sums[name] = sums.get(name, 0) + np.bincount(bucket[part], minlength=WIDTH)
            if len(sums) > LANG_BLOCK:
                yield from emptied(sums)
        yield from emptied(sums)

    def emptied(sums: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
        while sums:
            name, total = sums.popitem()
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": name, "bucket": at, "n": total[at]})

    return (
        labelled.select("lang", "text")
        .mapInPandas(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def log_shares(bucket: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The vector of a language: logarithms of smoothed shares, for each length of n-grams."""
    counts = np.full(WIDTH, 0.5)
    counts[bucket] += n
    counts = counts.reshape(len(SIZES), -1)
    return np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32).ravel()


def train(docs: DataFrame, rows_per_lang: int = TRAIN_ROWS, lang_block: int = LANG_BLOCK) -> DataFrame:
    """A row for each language: ``lang, block, logs``, its vector as 32-bit numbers, null where its
    rows hold no letter. Languages are dealt to blocks in sorted order."""
    usable = docs.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
    )
    sizes = written(usable.groupBy("lang").agg(F.count("*").alias("_n")), "language-sizes")
    # A row's hash, as a number from 0 to 1, against the share its language is taken with.
    spot = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 30)) / float(1 << 30)
    taken = usable.join(sizes, "lang").where(spot < F.lit(float(rows_per_lang)) / F.col("_n"))

    def vector(rows: pd.DataFrame) -> pd.DataFrame:
        logs = log_shares(rows["bucket"].to_numpy(), rows["n"].to_numpy())
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "logs": [logs.tobytes()]})

    vectors = bucket_counts(taken).groupBy("lang").applyInPandas(lambda rows: vector(rows), "lang string, logs binary")
    # One row a language here.
    block = F.floor((F.row_number().over(W.orderBy("lang")) - 1) / lang_block).cast("int")
    return written(sizes.select("lang", block.alias("block")).join(vectors, "lang", "left"), "language-vectors")


def matrix_of(rows: list) -> tuple[list[str], np.ndarray]:
    """Sorted languages and the matrix of log shares, buckets by languages."""
    rows = sorted(rows, key=lambda r: r["lang"])
    none = log_shares(np.zeros(0, np.int64), np.zeros(0))
    logs = [none if r["logs"] is None else np.frombuffer(r["logs"], np.float32) for r in rows]
    return [r["lang"] for r in rows], np.stack(logs, axis=1) if rows else np.zeros((WIDTH, 0), np.float32)


def sums_of(texts: list[str | None], logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood of each text in each language, and its number of n-grams."""
    n, langs = len(texts), logs.shape[1]
    total, seen = np.zeros((n, langs)), np.zeros(n, np.int64)
    step = max(1, GATHER // max(langs, 1))
    for points, owner in pieces(texts):
        for buckets, owners in grams(points, owner):
            for at in range(0, len(owners), step):
                bucket, who = buckets[at : at + step], owners[at : at + step]
                starts = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
                if langs:
                    np.add.at(total, who[starts], np.add.reduceat(logs[bucket], starts, axis=0, dtype=np.float64))
                np.add.at(seen, who[starts], np.diff(np.r_[starts, len(who)]))
    return total, seen


_SCORE = "lang string, top double, mass double, seen boolean"


def score_texts(texts: list[str | None], langs: list[str], logs: np.ndarray) -> pd.DataFrame:
    """The best of the languages for each text, its log likelihood, the sum of all likelihoods in
    units of the best, and whether the text has a letter."""
    parts = []
    # Sums are texts by languages.
    some = max(1, GATHER // max(len(langs), 1))
    for at in range(0, len(texts), some):
        total, seen = sums_of(texts[at : at + some], logs)
        top = total.max(axis=1, initial=-np.inf)
        mass = np.exp(total - top[:, None]).sum(axis=1) if len(langs) else np.zeros(len(total))
        names = [langs[b] for b in total.argmax(axis=1)] if len(langs) else [None] * len(total)
        parts.append(pd.DataFrame({"lang": names, "top": top, "mass": mass, "seen": seen > 0}))
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=["lang", "top", "mass", "seen"])


def _scored(docs: DataFrame, model: DataFrame, block: int) -> Column:
    """The scores of ``text`` in the languages of one block."""
    rows = model.where(F.col("block") == block).collect()
    held = docs.sparkSession.sparkContext.broadcast(matrix_of(rows))

    @F.pandas_udf(_SCORE)
    def score(texts: pd.Series) -> pd.DataFrame:
        return score_texts(texts.tolist(), *held.value)

    return score(F.col("text"))


def identify(docs: DataFrame, model: DataFrame) -> DataFrame:
    """``docs`` with ``_lang`` and ``_score``, the posterior probability, of its column ``text``."""
    blocks = (model.agg(F.max("block")).first()[0] or 0) + 1
    good = F.col("_best.seen") & F.col("_best.lang").isNotNull()
    lang = F.when(good, F.col("_best.lang")).otherwise(UNKNOWN)
    if blocks == 1:
        found = docs.withColumn("_best", _scored(docs, model, 0))
        score = 1.0 / F.col("_best.mass")
    else:
        rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "language-rows")
        scored = None
        for b in range(blocks):
            one = rows.select("_row", _scored(rows, model, b).alias("s")).select("_row", "s.*", F.lit(-b).alias("first"))
            one = written(one, "language-scores")
            scored = one if scored is None else scored.unionByName(one)
        best = scored.groupBy("_row").agg(
            F.max(F.struct("top", "first", "lang", "seen")).alias("_best"),
            # One for each block of languages.
            F.collect_list(F.struct("top", "mass")).alias("_all"),
        )
        found = rows.join(best, "_row").drop("_row")
        mass = F.aggregate("_all", F.lit(0.0), lambda sum_, b: sum_ + b["mass"] * F.exp(b["top"] - F.col("_best.top")))
        score = 1.0 / mass
    found = found.withColumn("_lang", lang).withColumn("_score", F.when(good, score).otherwise(0.0))
    return found.drop("_best", "_all")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return identify(docs.select("doc_id", "text"), train(docs)).select(
        "doc_id", held_out().alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score")
    )
