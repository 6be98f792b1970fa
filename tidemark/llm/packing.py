"""Variable-capacity best-fit packing of documents into training sequences.

Lengths are words plus one end mark. A document longer than the largest capacity is cut into
pieces of that capacity and a rest, so nothing is truncated. Pieces are dealt at random into
groups of about ``GROUP_ITEMS`` and each group is packed on its own, longest first: a piece
goes into the open bin it leaves fullest; if none has room, a bin is opened of the capacity with
the least cost per token expected in it: its length plus a fixed cost per sequence, over the
tokens that the pieces still to come would put into it. Pieces that two bins count on come to
one only, so this plan of all capacities is held against plans that open one capacity wherever
it holds the piece; at the end every bin shrinks to the smallest capacity that holds its
contents, and the plan of least cost stays. The waste of cutting the work into groups is one
unfilled bin or so a group, whatever the table's size.

Defined cases: a null or empty text has length 1 (its end mark); rows that repeat an id are
packed each; ties in length go by id, then piece; an empty table gives no bins. Other
columns of the input are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import table, text_or_empty, words_of, written

CAPACITIES = (512, 1024, 2048, 4096)
SEQUENCE_COST = 64
GROUP_ITEMS = 20_000


def _fill(falling: Sequence[int], after: int, space: int) -> int:
    """Tokens that the lengths behind ``after`` put into ``space``, longest first. ``falling``
    holds lengths as negative numbers, longest first."""
    free, at = space, after + 1
    while free and (at := bisect_left(falling, -free, at)) < len(falling):
        free += falling[at]
        at += 1
    return space - free


def _placed(lengths: Sequence[int], opening) -> tuple[list, list, list]:
    """Bin and offset of each length and the tokens of each bin: a length goes where it leaves
    the least room, or into a new bin of capacity ``opening(index)``."""
    bins, offsets, used, room = [], [], [], []  # room: (free, bin) of open bins, sorted
    for i, length in enumerate(lengths):
        at = bisect_left(room, (length, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = opening(i), len(used)
            used.append(0)
        bins.append(b)
        offsets.append(used[b])
        used[b] += length
        if free > length:
            insort(room, (free - length, b))
    return bins, offsets, used


def best_fit(lengths: Sequence[int], capacities: Sequence[int], sequence_cost: int):
    """Bin, offset in the bin and final capacity of each length, and its bin's tokens; lengths
    must not rise and none may exceed the largest capacity."""
    capacities = sorted(capacities)
    falling = [-n for n in lengths]

    def holding(tokens):
        return bisect_left(capacities, tokens)

    def by_cost(i):
        fits = capacities[holding(lengths[i]) :]
        return min(fits, key=lambda c: ((c + sequence_cost) / (lengths[i] + _fill(falling, i, c - lengths[i])), c))

    def at_least(size):
        return lambda i: max(size, capacities[holding(lengths[i])])

    def cost(plan):
        return sum(capacities[holding(u)] + sequence_cost for u in plan[2])

    plans = (_placed(lengths, opening) for opening in (by_cost, *map(at_least, capacities)))
    bins, offsets, used = min(plans, key=cost)
    final = [capacities[holding(u)] for u in used]
    return bins, offsets, [final[b] for b in bins], [used[b] for b in bins]


def lengths(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", (F.size(words_of(text_or_empty())) + 1).cast("long").alias("n_tokens")
    )


def pack(
    sized: DataFrame,
    capacities: Sequence[int] = CAPACITIES,
    sequence_cost: int = SEQUENCE_COST,
    group_items: int = GROUP_ITEMS,
) -> DataFrame:
    """One row for each piece of ``sized`` (``doc_id, n_tokens``): ``doc_id, piece, start``
    (first token in the document), ``length, bin_id, bin_offset, capacity, bin_tokens``."""
    top = max(capacities)
    cuts = F.sequence(F.lit(0).cast("long"), F.expr(f"(greatest(n_tokens, 1) - 1) div {top}"))
    pieces = written(
        sized.select("doc_id", "n_tokens", F.explode(cuts).alias("piece")).select(
            "doc_id",
            "piece",
            (F.col("piece") * top).alias("start"),
            F.least(F.lit(top), F.greatest("n_tokens", F.lit(1)) - F.col("piece") * top).cast("long").alias("length"),
            # Rows may repeat, so the dealing does not rest on the id alone.
            F.xxhash64(F.monotonically_increasing_id(), "doc_id", "piece").alias("_deal"),
        ),
        "packing-pieces",
    )
    groups = max(1, -(-pieces.count() // group_items))

    def fill(key, items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(
            ["length", "doc_id", "piece"], ascending=[False, True, True], na_position="last"
        ).reset_index(drop=True)
        bins, offsets, sizes, used = best_fit(items["length"].tolist(), capacities, sequence_cost)
        items["bin_id"] = pd.Series(bins, dtype="int64") + (int(key[0]) << 32)
        items["bin_offset"], items["capacity"], items["bin_tokens"] = offsets, sizes, used
        return items.drop(columns="_group")

    kind = sized.schema["doc_id"].dataType.simpleString()
    return (
        pieces.withColumn("_group", F.pmod("_deal", F.lit(groups)))
        .drop("_deal")
        .groupBy("_group")
        .applyInPandas(
            fill,
            f"doc_id {kind}, piece long, start long, length long, bin_id long, bin_offset long, "
            "capacity long, bin_tokens long",
        )
    )


def bins(packed: DataFrame) -> DataFrame:
    """One row for each bin: ``bin_id, capacity, n_tokens`` and its pieces in order."""
    parts = F.array_sort(F.collect_list(F.struct("bin_offset", "doc_id", "piece", "start", "length")))
    return (
        packed.groupBy("bin_id", "capacity", F.col("bin_tokens").alias("n_tokens"))
        .agg(parts.alias("pieces"))
        .select(
            "bin_id", "capacity", "n_tokens", F.col("pieces.doc_id").alias("doc_ids"),
            F.col("pieces.start").alias("starts"), F.col("pieces.length").alias("lengths"),
        )
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(lengths(table(spark, sf_dir, "documents")))
