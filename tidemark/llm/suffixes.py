"""Repeated byte strings by a depth-limited radix sort of suffixes.

A byte goes if it lies in a string of ``depth`` bytes (200) that starts anywhere else too.
Equality through ``depth`` bytes is all that is asked, so suffixes are ordered only that far, by
passes from the most significant digit, and only groups of two or more go on to the next. The
groups left after the last pass are exactly the repeated strings.

*Pass 1, anchors.* The digit of a suffix is the least (by hash) of the ``GRAM``-byte strings
within its first ``depth`` bytes, with its place. Equal suffixes have equal digits, and
neighbours share one, so a run of suffixes is one row: about three rows for 200 bytes.
Runs whose digit occurs once in the whole table end here.
*Pass 2, whole runs.* The digit is all bytes of a run of suffixes. Runs that are equal are
repeated in full and only one of them goes on, to stand for the rest.
*Pass 3, cores.* Runs that share an anchor but differ are cut by distance from the anchor into
``STEP`` suffixes each; the digit is the bytes all of these have in common.
*Pass 4.* What is left is taken suffix by suffix, with all ``depth`` bytes as the digit.

Digits are 64-bit hashes; as each pass keeps the groups of the one before, a group that is kept
agrees in several of them, and the last pass takes two more. Groups are counted by partial
aggregation before each shuffle, and counts are written before they are joined back, so a group
that fills a third of the table is split. Texts never cross a shuffle whole in one group: only
those rows with something to look at or to remove are joined, by document.

Defined cases: a null text is empty; texts shorter than ``depth`` are never changed; texts are
taken whole, in pieces of bounded size; rows that repeat are copies of each other; null or
repeated ids are allowed (rows are then numbered in a written copy); an empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidemark.llm.common import numbered, table, written
from tidemark.llm.hashing import Stretches, U, mixed

PIECE = 1 << 17
ROWS = 1 << 18
STEP_BITS = 3
STEP = 1 << STEP_BITS


@dataclass(frozen=True)
class Depth:
    """Length of the strings and of the anchors in them."""

    depth: int = 200
    gram: int = 64

    @property
    def span(self) -> int:
        """Anchors that lie within one string."""
        return self.depth - self.gram + 1


def _texts(batch: pa.RecordBatch) -> Iterator[memoryview]:
    """The bytes of each text where they lie in the batch; a null text has none."""
    for text in batch.column("text"):
        yield memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")


def _blocks(texts: Iterator[tuple[int, memoryview]], depth: int) -> Iterator[tuple]:
    """Blocks of about PIECE bytes: bytes, and for each stretch its place in the block, its row and
    where it starts in its text. Long texts come in stretches that overlap by ``depth - 1``."""
    parts, size = [], 0
    for row, raw in texts:
        if len(raw) < depth:
            continue
        for at in range(0, len(raw) - depth + 1, PIECE):
            part = raw[at : at + PIECE + depth - 1]
            parts.append((row, at, part))
            size += len(part)
            if size >= PIECE:
                yield _joined(parts)
                parts, size = [], 0
    if parts:
        yield _joined(parts)


def _joined(parts: list[tuple[int, int, memoryview]]) -> tuple:
    lengths = np.array([len(p[2]) for p in parts])
    return (
        np.frombuffer(b"".join(p[2] for p in parts), np.uint8),
        np.cumsum(np.r_[0, lengths]),
        np.array([p[0] for p in parts], np.int64),
        np.array([p[1] for p in parts], np.int64),
    )


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key in every window of ``width``, by doubling."""
    out, have = keys, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def runs(texts: Iterator[tuple[int, memoryview]], rule: Depth) -> Iterator[dict[str, np.ndarray]]:
    """Pass 1: ``gram, run, row, place`` for every run of suffixes with one anchor. ``run`` is
    the digit of pass 2; ``place`` holds the first suffix, and in its low bytes their
    number and how far behind the first the anchor stands, both at most the span."""
    for data, starts, row, offset in _blocks(texts, rule.depth):
        hashed = Stretches(data)
        grams = hashed.sliding(rule.gram)
        # Place in the low bits, so that the first of equals counts and is known.
        bits = U(22)
        keys = ((grams >> bits) << bits) | np.arange(len(grams), dtype=np.uint64)
        anchor = (_least(keys, rule.span) & U((1 << 22) - 1)).astype(np.int64)
        # Suffixes that have all their bytes within one stretch.
        fine = np.zeros(len(anchor) + 1, np.int64)
        np.add.at(fine, np.minimum(starts[:-1], len(anchor)), 1)
        np.add.at(fine, np.minimum(starts[1:] - rule.depth + 1, len(anchor)), -1)
        ok = np.cumsum(fine[:-1]) > 0
        head = ok.copy()
        head[1:] &= (anchor[1:] != anchor[:-1]) | ~ok[:-1]
        first = np.flatnonzero(head)
        # A new stretch is a new run even when its anchor happens to be shared.
        last_of = np.ones(len(first), bool)
        stop = np.empty(len(first), np.int64)
        ends = np.flatnonzero(ok & np.r_[~ok[1:] | (anchor[1:] != anchor[:-1]), True]) + 1
        stop[last_of] = ends
        part = np.searchsorted(starts, first, side="right") - 1
        shift = offset[part] - starts[part]
        at = anchor[first]
        length = (stop - first).astype(np.uint64)
        run = mixed(Stretches(data, 1).plain(first, stop + rule.depth - 1) + length)
        # Where the anchor stands in the run belongs to its digit.
        run = mixed(run ^ (at - first).astype(np.uint64))
        yield {
            "gram": grams[at].view(np.int64),
            "run": run.view(np.int64),
            "row": row[part],
            "place": ((first + shift) << 20) | ((stop - first) << 10) | (at - first),
        }


_RUNS = "gram long, run long, row long, place long"


def _unfolded(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First suffix, number of suffixes, anchor."""
    first = place >> 20
    return first, (place >> 10) & 1023, first + (place & 1023)


def all_runs(docs: DataFrame, rule: Depth) -> DataFrame:
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(batch.column("row").to_pylist(), _texts(batch))
            for found in runs(texts, rule):
                yield pa.RecordBatch.from_pydict(found)

    return docs.select("row", "text").mapInArrow(take, _RUNS)


def _places(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as counted, one after the other."""
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    return np.repeat(starts - first, counts) + np.arange(total)


def _stretches(batches: Iterator[pa.RecordBatch], reach: int, bits: int) -> Iterator[tuple]:
    """Row, bytes, where they start in the text, and the numbers in ``open`` whose place, all but
    the low ``bits``, lies within a stretch of PIECE bytes."""
    for batch in batches:
        lists = batch.column("open")
        ends, every = lists.offsets.to_numpy(), lists.values.to_numpy()
        rows = batch.column("row").to_pylist()
        for row, text, start, stop in zip(rows, _texts(batch), ends[:-1], ends[1:]):
            raw = np.frombuffer(text, np.uint8)
            todo = np.sort(every[start:stop])
            part = (todo >> bits) // PIECE
            for some in np.split(todo, np.flatnonzero(part[1:] != part[:-1]) + 1):
                base, last = int(some[0]) >> bits, int(some[-1]) >> bits
                yield row, raw[base : last + reach], base, some


def _gathered(found: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """Batches of about ROWS lines out of many small ones."""
    held, size = [], 0
    for one in found:
        held.append(one)
        size += len(next(iter(one.values())))
        if size >= ROWS:
            yield pa.RecordBatch.from_pydict({k: np.concatenate([h[k] for h in held]) for k in held[0]})
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pydict({k: np.concatenate([h[k] for h in held]) for k in held[0]})


def cores(docs: DataFrame, rule: Depth) -> DataFrame:
    """Pass 3: ``core, row, low, high`` for rows with ``row, text`` and an array ``open`` of
    places: suffixes ``low`` to ``high`` share the core."""

    def each(batches):
        for row, data, base, todo in _stretches(batches, 4 * rule.depth, 20):
            hashed = Stretches(data, 2)
            first, n, anchor = _unfolded(todo)
            first, anchor = first - base, anchor - base
            last = first + n - 1
            # By distance before the anchor, in steps.
            near, far = (anchor - last) // STEP, (anchor - first) // STEP
            counts = far - near + 1
            step = _places(near, counts)
            a, f, g = (np.repeat(x, counts) for x in (anchor, first, last))
            start = a - step * STEP
            core = mixed(hashed.plain(start, start - (STEP - 1) + rule.depth))
            core = mixed(core + step.astype(np.uint64) * U(0x9E3779B97F4A7C15))
            yield {
                "core": core.view(np.int64),
                "row": np.full(len(core), row, np.int64),
                "low": np.maximum(f, start - (STEP - 1)) + base,
                "high": np.minimum(g, start) + base,
            }

    return docs.select("row", "text", "open").mapInArrow(
        lambda it: _gathered(each(it)), "core long, row long, low long, high long"
    )


def last_digits(docs: DataFrame, rule: Depth) -> DataFrame:
    """Pass 4: ``d1, d2, row, at`` for rows with an array ``open`` of ranges: the first suffix,
    and in the lowest bits how many follow it, fewer than STEP."""

    def each(batches):
        for row, data, base, todo in _stretches(batches, STEP + rule.depth, STEP_BITS):
            at = _places((todo >> STEP_BITS) - base, (todo & (STEP - 1)) + 1)
            d1, d2 = (mixed(Stretches(data, s).plain(at, at + rule.depth)) for s in (3, 4))
            yield {
                "d1": d1.view(np.int64),
                "d2": d2.view(np.int64),
                "row": np.full(len(at), row, np.int64),
                "at": at + base,
            }

    return docs.select("row", "text", "open").mapInArrow(
        lambda it: _gathered(each(it)), "d1 long, d2 long, row long, at long"
    )


def _with_open(docs: DataFrame, parts: DataFrame, part: Column) -> DataFrame:
    """Texts of the rows in ``parts``, each with its parts as one array."""
    lists = parts.groupBy("row").agg(F.collect_list(part).alias("open"))
    return docs.select("row", "text").join(lists, "row")


def repeated_starts(docs: DataFrame, rule: Depth = Depth()) -> tuple[DataFrame, DataFrame]:
    """``row, low, high``: suffixes of ``row, text`` whose first ``depth`` bytes start at
    another place too (ranges may name a place again); and the texts they may be in."""
    # Made twice rather than written: the runs of all texts are larger than what they cost.
    found = all_runs(docs, rule)
    twice = written(
        found.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1").select("gram"), "repeated-anchors"
    )
    found = written(found.join(twice, "gram"), "anchored-runs", "zstd")
    rows = found.select("row").distinct().hint("shuffle_hash")
    texts = written(docs.select("row", "text").join(rows, "row", "left_semi"), "anchored-texts", "zstd")
    groups = written(
        found.groupBy("gram", "run").agg(
            F.count("*").alias("m"), F.min(F.struct("row", "place")).alias("one")
        ),
        "run-groups",
    )
    first = F.shiftright("place", 20)
    n = F.shiftright("place", 10).bitwiseAND(F.lit(1023))
    whole = found.join(groups.where("m > 1").select("gram", "run"), ["gram", "run"]).select(
        "row", first.alias("low"), (first + n - 1).alias("high")
    )
    # One run for each group, where an anchor has several groups.
    several = written(groups.groupBy("gram").agg(F.count("*").alias("g")).where("g > 1").select("gram"), "mixed-anchors")
    open_ = groups.join(several, "gram").select("one.*")
    core = written(cores(_with_open(texts, open_, F.col("place")), rule), "suffix-cores")
    same = written(core.groupBy("core").agg(F.count("*").alias("m")).where("m > 1").select("core"), "repeated-cores")
    left = core.join(same, "core").select("row", "low", "high")
    digits = written(last_digits(_with_open(texts, left, F.col("low") * STEP + F.col("high") - F.col("low")), rule), "suffix-digits")
    pairs = written(
        digits.groupBy("d1", "d2").agg(F.count("*").alias("m")).where("m > 1").select("d1", "d2"), "repeated-digits"
    )
    single = digits.join(pairs, ["d1", "d2"]).select("row", F.col("at").alias("low"), F.col("at").alias("high"))
    return whole.unionByName(single), texts


def spans(starts: DataFrame, rule: Depth = Depth()) -> DataFrame:
    """``row, spans``: maximal stretches of bytes ``[start, stop)`` to remove of each row. Ranges
    are merged in order before they are gathered, so only what is left of them is an array."""
    ordered = W.partitionBy("row").orderBy("low", "high")
    before = F.max("high").over(ordered.rowsBetween(W.unboundedPreceding, -1))
    first = before.isNull() | (F.col("low") > before + rule.depth)
    stretch = F.count_if("_first").over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow))
    merged = (
        starts.withColumn("_first", first)
        .withColumn("_stretch", stretch)
        .groupBy("row", "_stretch")
        .agg(F.min("low").alias("start"), (F.max("high") + rule.depth).alias("stop"))
    )
    return merged.groupBy("row").agg(F.sort_array(F.collect_list(F.array("start", "stop"))).alias("spans"))


def _without(raw: bytes, spans) -> bytes:
    kept, at = [], 0
    for start, stop in spans:
        kept.append(raw[at:start])
        at = stop
    return b"".join([*kept, raw[at:]])


def cut_texts(docs: DataFrame, rule: Depth = Depth()) -> DataFrame:
    """``row, n_removed, n_spans, kept binary`` of the numbered rows that lose anything."""
    starts, texts = repeated_starts(docs, rule)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = [_without(t.encode(), s) for t, s in zip(batch["text"], batch["spans"])]
            gone = [sum(int(b - a) for a, b in s) for s in batch["spans"]]
            yield pd.DataFrame(
                {"row": batch["row"], "n_removed": gone, "n_spans": batch["spans"].map(len), "kept": kept}
            )

    found = spans(starts, rule)
    return texts.join(found, "row").select("row", "text", "spans").mapInPandas(
        cut, "row long, n_removed long, n_spans long, kept binary"
    )


def cut(text: Column, spans: Column) -> Column:
    """Bytes of ``text`` without its ``spans``; null where nothing goes, and such texts stay in the JVM."""

    @F.pandas_udf("binary")
    def rest(texts: pd.Series, lists: pd.Series) -> pd.Series:
        return pd.Series([None if s is None else _without(t.encode(), s) for t, s in zip(texts, lists)], dtype=object)

    return rest(F.when(spans.isNotNull(), text), spans)


def as_text(kept: Column) -> Column:
    """Bytes as text; bytes of a character that was cut in two are dropped."""

    @F.pandas_udf("string")
    def decode(raws: pd.Series) -> pd.Series:
        return raws.map(lambda raw: raw.decode("utf-8", "ignore"), na_action="ignore")

    return decode(kept)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = numbered(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    none = F.lit(0).cast("long")
    # Texts that lose nothing are digested where they are; only digests are joined.
    every = docs.select(
        "row", "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole")
    )
    changed = cut_texts(docs).select("row", "n_removed", "n_spans", F.sha2("kept", 256).alias("rest"))
    return every.join(changed, "row", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("rest", "whole").alias("kept_sha256"),
    )
