"""Near-duplicate documents by HyperMinHash.

A document is its set of word shingles, lower-cased in A-Z, each a 64-bit hash. Documents with
equal sets form a class, and only classes go on.

*Sketch.* The top bits of a hash choose one of 128 buckets; of the least remainder in a bucket
the number of leading zeros and the ten bits after the leading one are stored, 16 bits.
*Bands.* Four neighbouring registers form a band; classes that share a band with anything in
it are candidates. At a similarity of 0.8 all 32 bands miss with a chance below 1e-7.
*Estimate.* The share of equal registers among those that either holds, less the equal ones
that chance alone would give, must come within six deviations of the threshold.
*Verification.* Shingle sets of what is left are made again from the whole texts and compared.

All pairs of a band are never made. First each class is paired with the least member of each
of its bands, the most promising of these pairs is verified, and components are formed. That
settles bands of two, whose only pair is verified whenever it is promising. Then
only bands that still hold two components are looked at: their members are dealt into blocks once,
and blocks compared with blocks, pairs within a component being passed over. From bands of more than one
block go first all members that share too few shingles with others there to be linked. Only members of
promising pairs, each counted in the first band it shares, go on. Where these pairs are few, all
are verified at once. Where they are many, the best partner of each member is first, and components are
formed anew as long as that links some; then what is left across components is compared again.
Pairs of blocks are compared many at a time, as most bands have a few members only.
A link is thus left out only inside a component, where it changes nothing.

Defined cases: a null or blank text has no shingles and links with nothing; a text with fewer
words than a shingle is one shingle; texts are taken whole, in pieces of bounded size; rows
that repeat an id or a text are each returned; a null id gets the component of its class, if
that has an id, and texts under one id are one node, linked by the links of either. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import table, written
from tidemark.llm.components import connected
from tidemark.llm.hashing import Stretches, U, mixed

BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA = 10
BAND = 4
EMPTY = 0xFFFF
BLOCK = 512
# Pairs of sketches compared at once, about a megabyte of each side.
PAIRS = 1 << 12
PIECE = 1 << 17
SPREAD = 6.0
# Promising pairs for each of their members up to which all are verified at once.
MANY = 64
# Stand-ins for null ids lie above all ids.
UNNAMED = 1 << 62


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; linked from ``percent`` per cent of their union on."""

    words: int = 5
    percent: int = 80


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BLANKS = b" \t\n\x0b\x0c\r"
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _pieces(texts: list[str | None], words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of bytes of about PIECE in which each unit (a text, or a stretch of a long one
    that overlaps the next by ``words - 1`` words) ends in a blank, with the text of each byte."""
    held: list[bytes] = []
    owner: list[int] = []
    size = 0

    def block():
        data = np.frombuffer(b"".join(held), np.uint8)
        return data, np.repeat(owner, [len(h) for h in held])

    for i, text in enumerate(texts):
        raw = (text or "").encode()
        at = stop = 0
        while True:
            done, stop = stop, len(raw)
            if stop - done > 2 * PIECE:
                # A blank after which a unit may end, at least PIECE beyond the last one's end,
                # however long the words are that it repeats.
                blank = _BLANK.search(raw, done + PIECE)
                stop = blank.start() if blank and len(raw) - blank.start() > PIECE else stop
            held.append(raw[at:stop] + b" ")
            owner.append(i)
            size += len(held[-1])
            if size >= PIECE:
                yield block()
                held, owner, size = [], [], 0
            if stop == len(raw):
                break
            # Back to where the last words start, which the next unit begins with.
            at = stop
            for _ in range(words - 1):
                while at and raw[at - 1] in _BLANKS:
                    at -= 1
                while at and raw[at - 1] not in _BLANKS:
                    at -= 1
    if held:
        yield block()


def shingles(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of the distinct shingles, sorted by both."""
    owners, hashes = [], []
    n_texts = len(texts)
    whole = np.zeros(n_texts, bool)  # has a shingle of full length
    short: list[tuple[np.ndarray, np.ndarray]] = []
    for data, who in _pieces(texts, words):
        word = ~_SPACE[data]
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        if word[0]:
            edge = np.r_[0, edge]
        # Every unit ends in a blank, so starts and stops pair up.
        start, stop = edge[0::2], edge[1::2]
        if not len(start):
            continue
        one = mixed(Stretches(_LOWER[data]).plain(start, stop) + (stop - start).astype(np.uint64))
        own = who[start]
        m = len(one) - words + 1
        if m > 0:
            code = np.zeros(m, np.uint64)
            for k in range(words):
                code = code * U(0x9E3779B97F4A7C15) + one[k : k + m]
            same = own[:m] == own[words - 1 :]
            owners.append(own[:m][same])
            hashes.append(mixed(code[same]))
            whole[own[:m][same]] = True
        # Texts with fewer words: all their words, and how many.
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        count = np.diff(np.r_[first, len(own)])
        few = count < words
        if few.any():
            code = np.zeros(few.sum(), np.uint64)
            for k in range(words - 1):
                at = first[few] + k
                inside = k < count[few]
                step = one[np.minimum(at, len(one) - 1)]
                code = np.where(inside, code * U(0xC2B2AE3D27D4EB4F) + step, code)
            short.append((own[first[few]], mixed(code + count[few].astype(np.uint64))))
    if short:
        # Of a text in several units the last one holds all its words, if they are so few.
        own, code = (np.concatenate(c)[::-1] for c in zip(*short))
        own, last = np.unique(own, return_index=True)
        fresh = ~whole[own]
        owners.append(own[fresh])
        hashes.append(code[last][fresh])
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    own, code = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((code, own))
    own, code = own[order], code[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (code[1:] != code[:-1])
    return own[new], code[new]


def registers(own: np.ndarray, code: np.ndarray, n_texts: int) -> np.ndarray:
    """``n_texts`` rows of 128 registers from sorted distinct shingles."""
    out = np.full((n_texts, BUCKETS), EMPTY, np.uint16)
    if not len(own):
        return out
    bucket = (code >> U(64 - BUCKET_BITS)).astype(np.int64)
    first = np.ones(len(own), bool)
    first[1:] = (own[1:] != own[:-1]) | (bucket[1:] != bucket[:-1])
    width = 64 - BUCKET_BITS
    rest = code[first] & U((1 << width) - 1)
    # 53 bits are exact as a double, whose exponent is the number of bits.
    bits = np.frexp((rest >> U(width - 53)).astype(np.float64))[1].astype(np.int64)
    zeros = 53 - bits
    shift = zeros + 1 + (64 - width)
    mantissa = (rest << shift.astype(np.uint64)) >> U(64 - MANTISSA)
    mantissa[bits == 0] = 0
    value = (np.minimum(zeros, 62) << MANTISSA) | mantissa.astype(np.int64)
    out[own[first], bucket[first]] = value
    return out


def _names(own: np.ndarray, code: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each text's shingles, which together name the set."""
    k1, k2 = np.zeros(n_texts, np.uint64), np.zeros(n_texts, np.uint64)
    np.add.at(k1, own, mixed(code ^ U(0xA5A5A5A5A5A5A5A5)))
    np.add.at(k2, own, mixed(code + U(0x1234567890ABCDEF)))
    return k1.view(np.int64), k2.view(np.int64)


def by_batch(texts: list[str | None], words: int) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of about PIECE characters, with the place of the first."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= PIECE:
            yield at, texts[at : i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def sketches(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id, n_shingles, k1, k2, sketch``: k1 and k2 name the set."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch["text"]]
            for at, part in by_batch(texts, rule.words):
                own, code = shingles(part, rule.words)
                n = np.bincount(own, minlength=len(part))
                k1, k2 = _names(own, code, len(part))
                rows = registers(own, code, len(part))
                yield pd.DataFrame(
                    {
                        "doc_id": batch["doc_id"].iloc[at : at + len(part)].to_numpy(),
                        "n_shingles": n,
                        "k1": k1,
                        "k2": k2,
                        "sketch": [r.tobytes() for r in rows],
                    }
                )

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Ids travel as text so that a null does not turn them into floating numbers.
    return (
        given.withColumn("doc_id", F.col("doc_id").cast("string"))
        .mapInPandas(sketch, "doc_id string, n_shingles long, k1 long, k2 long, sketch binary")
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    )


def shingle_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """``k1, k2, grams``: sorted hashes of the shingles as bytes."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for at, part in by_batch(texts, rule.words):
                own, code = shingles(part, rule.words)
                cut = np.searchsorted(own, np.arange(len(part) + 1))
                k1, k2 = _names(own, code, len(part))
                yield pd.DataFrame(
                    {
                        "k1": k1,
                        "k2": k2,
                        "grams": [code[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])],
                    }
                )

    return docs.select("text").mapInPandas(sets, "k1 long, k2 long, grams binary")


def corrected(equal, used, na, nb) -> np.ndarray:
    """Similarity from the equal registers among those in use. Equal registers that unequal
    least values would give are taken off: about 0.17 * 2**-MANTISSA of those in use, most for
    sets of equal size."""
    ratio = np.minimum(na, nb) / np.maximum(np.maximum(na, nb), 1)
    chance = 0.169919487 * used * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return (equal - chance) / np.maximum(used - chance, 1e-9)


def near_enough(found, used, na, nb, rule: Rule) -> np.ndarray:
    """Whether a pair may be linked: sizes allow it, and the estimate comes near."""
    t = rule.percent / 100
    margin = SPREAD * np.sqrt(t * (1 - t) / np.maximum(used, 1))
    return (100 * np.minimum(na, nb) >= rule.percent * np.maximum(na, nb)) & (found >= t - margin)


def _rows(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(len(column), BUCKETS)


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""

    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y):
            n = (len(p) + len(q)) // 8
            both = np.sort(np.concatenate([np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)]))
            common = int((both[1:] == both[:-1]).sum())
            out.append(100 * common >= rule.percent * (n - common))
        return pd.Series(out, dtype=bool)

    left = sets.select(F.col("id").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("id").alias("b"), F.col("grams").alias("gb"))
    return pairs.join(left, "a").join(right, "b").where(linked("ga", "gb")).select("a", "b")


BLOCKS = ["band", "key", "bi", "bj"]


def _whole_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Many whole pairs of blocks at once, with where each begins and the last ends, from rows sorted
    by BLOCKS. Within a pair of blocks the rows of the first one come first."""
    held = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(rows):
            continue
        cuts = _cuts(rows)
        if len(cuts) > 2:
            yield _first_block_first(rows.iloc[: cuts[-2]]), cuts[:-1]
        held = rows.iloc[cuts[-2] :]
    if held is not None:
        yield _first_block_first(held), _cuts(held)


def _cuts(rows: pd.DataFrame) -> np.ndarray:
    new = np.zeros(len(rows) - 1, bool)
    for c in BLOCKS:
        one = rows[c].to_numpy()
        new |= one[1:] != one[:-1]
    return np.r_[0, np.flatnonzero(new) + 1, len(rows)]


def _first_block_first(rows: pd.DataFrame) -> pd.DataFrame:
    later = rows["at"].to_numpy() != rows["bi"].to_numpy()
    if not later.any():
        return rows
    block = np.zeros(len(rows), np.int64)
    block[_cuts(rows)[1:-1]] = 1
    return rows.iloc[np.lexsort((later, block.cumsum()))]


def _equal(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which registers are equal, and how many, empty ones too."""
    alike = x == y
    # Eight truth values are added at a time, each in a byte of its own, then the eight bytes.
    lanes = alike.view(np.uint64).sum(axis=1)
    return alike, ((lanes * U(0x0101010101010101)) >> U(56)).astype(np.int64)


def _candidates(rows: pd.DataFrame, cuts: np.ndarray, rule: Rule, best: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the promising pairs across components within pairs of blocks, some at a
    time, by the first row: those whose first shared band this is, of each row all or the best one."""
    regs, size, label = _rows(rows["sketch"]), rows["n"].to_numpy(), rows["label"].to_numpy()
    shared = rows.get("shared", rows["n"]).to_numpy()
    band, empty = rows["band"].to_numpy(), np.packbits(regs == EMPTY, axis=1).view(np.uint64)
    length = np.diff(cuts)
    stop = np.repeat(cuts[1:], length)
    same = rows["bi"].to_numpy() == rows["bj"].to_numpy()
    first = rows["at"].to_numpy() == rows["bi"].to_numpy()
    # Partners are the rows after it in its block, or all those of the other block.
    start = np.where(same, np.arange(len(rows)) + 1, np.repeat(cuts[:-1] + np.add.reduceat(first, cuts[:-1], dtype=np.int64), length))
    partners = np.where(first, stop - start, 0)
    total = np.cumsum(partners)
    at = 0
    while at < len(rows):
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + PAIRS, "right")))
        count = partners[at:to]
        x = np.repeat(np.arange(at, to), count)
        y = np.arange(len(x)) + np.repeat(start[at:to] - (total[at:to] - count - done), count)
        at = to
        # No more in common than either has in common with others; with all shared, a limit to sizes.
        most = np.minimum(shared[x], shared[y])
        fine = (label[x] != label[y]) & ((100 + rule.percent) * most >= rule.percent * (size[x] + size[y]))
        x, y = x[fine], y[fine]
        if not len(x):
            continue
        alike, equal = _equal(regs[x], regs[y])
        both = np.bitwise_count(empty[x] & empty[y]).sum(axis=1, dtype=np.int64)
        # Registers empty in both are equal too.
        found = corrected(equal - both, BUCKETS - both, size[x], size[y])
        good = near_enough(found, BUCKETS - both, size[x], size[y], rule)
        x, y, found, alike = x[good], y[good], found[good], alike[good]
        if not len(x):
            continue
        bands = alike.reshape(len(x), -1, BAND).all(axis=2)
        bands &= (regs[x] != EMPTY).reshape(len(x), -1, BAND).any(axis=2)
        here = bands.argmax(axis=1) == band[x]
        x, y, found = x[here], y[here], found[here]
        if best and len(x):
            order = np.lexsort((-found, x))
            x, y = x[order], y[order]
            keep = np.r_[True, x[1:] != x[:-1]]
            x, y = x[keep], y[keep]
        yield x, y


def _best_pairs(batches: Iterator[pd.DataFrame], rule: Rule) -> Iterator[pd.DataFrame]:
    for rows, cuts in _whole_blocks(batches):
        band, key, ids = rows["band"].to_numpy(), rows["key"].to_numpy(), rows["id"].to_numpy()
        for x, y in _candidates(rows, cuts, rule, best=True):
            yield pd.DataFrame({"band": band[x], "key": key[x], "x": ids[x], "y": ids[y]})


def _concerned(batches: Iterator[pd.DataFrame], rule: Rule) -> Iterator[pd.DataFrame]:
    """Rows that are in any candidate pair, with the number of those they come first in."""
    for rows, cuts in _whole_blocks(batches):
        hit, pairs = np.zeros(len(rows), bool), np.zeros(len(rows), np.int64)
        for x, y in _candidates(rows, cuts, rule, best=False):
            hit[x] = hit[y] = True
            pairs += np.bincount(x, minlength=len(rows))
        if hit.any():
            yield rows.loc[hit].assign(pairs=pairs[hit])


def _common(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs of sets."""
    whole = np.concatenate(sets)
    if len(x) > 2000 and len(whole) < 1_000_000:
        # Many pairs: products of membership rows, some columns at a time.
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        column = np.unique(whole, return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        total = np.zeros((len(sets), len(sets)), np.float32)
        step = 4096
        for at in range(0, int(column[-1]) + 1, step):
            a, b = np.searchsorted(column, [at, at + step])
            part = np.zeros((len(sets), step), np.float32)
            part[owner[a:b], column[a:b] - at] = 1
            total += part @ part.T
        return total[x, y].astype(np.int64)
    out = np.empty(len(x), np.int64)
    for k, (i, j) in enumerate(zip(x, y)):
        both = np.sort(np.concatenate([sets[i], sets[j]]))
        out[k] = (both[1:] == both[:-1]).sum()
    return out


def _block_links(batches: Iterator[pd.DataFrame], rule: Rule) -> Iterator[pd.DataFrame]:
    """Links among the candidate pairs of each pair of blocks, by full sets."""
    for rows, cuts in _whole_blocks(batches):
        found = list(_candidates(rows, cuts, rule, best=False))
        if not found:
            continue
        xs, ys = (np.concatenate(c) for c in zip(*found))
        n, ids, grams = rows["n"].to_numpy(), rows["id"].to_numpy(), rows["grams"].to_list()
        ends = np.searchsorted(xs, cuts)
        for k in np.flatnonzero(np.diff(ends)):
            x, y = xs[ends[k] : ends[k + 1]], ys[ends[k] : ends[k + 1]]
            sets = [np.frombuffer(g, np.uint64) for g in grams[cuts[k] : cuts[k + 1]]]
            common = _common(sets, x - cuts[k], y - cuts[k])
            linked = 100 * common >= rule.percent * (n[x] + n[y] - common)
            if linked.any():
                yield pd.DataFrame({"x": ids[x[linked]], "y": ids[y[linked]]})


def _labelled(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with the component of each ``id`` as ``label``."""
    return rows.join(roots, "id", "left").withColumn("label", F.coalesce("root", "id")).drop("root")


def _open_bands(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``band, key, id, label, main, outer, inner, shared``: members of bands that hold several components,
    whether a member is in the component that has most of the band, and the number of blocks that
    the others and its members are dealt into. A band that fits one block is one. How many shingles
    a member shares with others is not known yet."""
    labelled = written(_labelled(members.select("band", "key", "id"), roots), "band-labels")
    several = (
        labelled.groupBy("band", "key", "label")
        .agg(F.count("*").alias("c"))
        .groupBy("band", "key")
        .agg(F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("m"))
        .where("m > top.c")
        .select(
            "band", "key", F.when(F.col("m") > BLOCK, F.col("top.label")).alias("most"),
            F.when(F.col("m") > BLOCK, _blocks(F.col("m") - F.col("top.c"))).otherwise(1).alias("outer"),
            F.when(F.col("m") > BLOCK, _blocks(F.col("top.c"))).otherwise(0).alias("inner"),
        )
    )
    found = labelled.join(written(several, "several-components"), ["band", "key"])
    main = F.coalesce(F.col("label") == F.col("most"), F.lit(False))
    return found.withColumn("main", main).withColumn("shared", F.lit(None).cast("long")).drop("most")


def _blocks(n: Column) -> Column:
    return F.ceil(n / BLOCK).cast("long")


def _one_by_one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        n = batch["grams"].map(len).to_numpy() // 8
        for _, part in batch.assign(n=n).groupby(n.cumsum() // PIECE):
            grams = np.frombuffer(b"".join(part["grams"]), np.int64)
            yield pd.DataFrame({"id": np.repeat(part["id"].to_numpy(), part["n"]), "gram": grams})


def _shared(ids: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """``id, n, shared``: how many shingles each of ``ids`` has, and has in common with any other of them."""
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grams = sets.join(ids, "id", "left_semi").repartition(parts, "id").mapInPandas(_one_by_one, "id long, gram long")
    alone = (
        grams.groupBy("gram").agg(F.count("*").alias("c"), F.min("id").alias("id")).where("c = 1")
        .groupBy("id").agg(F.count("*").alias("alone"))
    )
    found = classes.select("id", "n").join(ids, "id", "left_semi").join(alone, "id", "left")
    return found.select("id", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared"))


def _within_reach(open_: DataFrame, classes: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """``open_`` without those members of bands of several blocks that nothing there can be linked with.

    What only one member of these bands has is in no intersection, so the intersection of two is at
    most what either shares, and a link needs (100 + percent) * shared >= percent * (n + n of the other)
    on both sides: the other's size has to be within reach. Sizes within a band are put into cells,
    each with its least size and longest reach; a member stays where a cell of others may meet it."""
    open_ = written(open_, "open-bands")
    one = F.col("outer") + F.col("inner") == 1
    large = open_.where(~one).drop("shared")
    if large.isEmpty():
        return open_
    shared = written(_shared(large.select("id").distinct(), classes, sets), "shared-shingles")
    p = rule.percent
    reach = (100 + p) * F.col("shared") - p * F.col("n")
    members = written(large.join(shared, "id", "left").withColumn("reach", reach), "large-bands")
    cells = (
        members.groupBy("band", "key", "main", F.floor(16 * F.log("n")).alias("cell"))
        .agg(F.min("n").alias("least"), F.max("reach").alias("longest"))
        .groupBy("band", "key").agg(F.collect_list(F.struct("main", "least", "longest")).alias("cells"))
    )
    # Those of the component that has most of the band meet the others only.
    meets = F.exists(
        "cells",
        lambda c: ~(c["main"] & F.col("main")) & (p * c["least"] <= F.col("reach")) & (c["longest"] >= p * F.col("n")),
    )
    left = written(members.join(written(cells, "size-cells"), ["band", "key"]).where(meets).drop("cells", "outer", "inner"), "within-reach")
    wide = F.col("m") > BLOCK
    counts = (
        left.groupBy("band", "key").agg(F.count("*").alias("m"), F.count_if("main").alias("most")).where("m > most")
        .select(
            "band", "key", wide.alias("wide"),
            F.when(wide, _blocks(F.col("m") - F.col("most"))).otherwise(1).alias("outer"),
            F.when(wide, _blocks(F.col("most"))).otherwise(0).alias("inner"),
        )
    )
    dealt = left.join(written(counts, "large-band-blocks"), ["band", "key"]).withColumn("main", F.col("main") & F.col("wide"))
    return open_.where(one).unionByName(dealt.select(*open_.columns))


def _dealt(open_: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of open bands in every pair of blocks they are in, with their sketches. Blocks of the
    component that has most of a band follow those of the others and meet these only, so a few
    strangers in the band of a large group cost as many rows as the group has."""
    spot = F.xxhash64("id")
    at = F.when(F.col("main"), F.col("outer") + F.pmod(spot, F.col("inner"))).otherwise(F.pmod(spot, F.col("outer")))
    last = F.when(F.col("main"), F.col("outer")).otherwise(F.col("outer") + F.col("inner")) - 1
    return _sorted(
        open_.withColumn("at", at)
        .select("band", "key", "id", "label", "shared", "at", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("to"))
        .withColumns({"bi": F.least("at", "to"), "bj": F.greatest("at", "to")}).drop("to")
        .join(classes.select("id", "n", "sketch"), "id")
        .withColumn("shared", F.coalesce("shared", "n"))
    )


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition(*BLOCKS).sortWithinPartitions(*BLOCKS)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def _concerned_rows(dealt: DataFrame, rule: Rule) -> tuple[DataFrame, int, int]:
    """Members of promising pairs, in the pairs of blocks where these are, and how many of both there are."""
    rows = written(
        dealt.mapInPandas(
            lambda it: _concerned(it, rule),
            "band int, key long, bi long, bj long, at long, id long, label long, n long, shared long, sketch binary, pairs long",
        ),
        "concerned",
    )
    return rows, *rows.agg(F.count("*"), F.coalesce(F.sum("pairs"), F.lit(0))).first()


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``doc_id, text``."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    drawn = written(sketches(given, rule), "sketches")
    some = drawn.where("n_shingles > 0")
    unnamed = F.lit(UNNAMED).bitwiseOR(F.shiftrightunsigned(F.xxhash64("k1", "k2"), 2))
    classes = written(
        some.groupBy("k1", "k2").agg(
            F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")
        ).withColumn("id", F.coalesce("id", unnamed)),
        "shingle-classes",
    )

    width = 2 * BAND
    cut = F.transform(
        F.sequence(F.lit(0), F.lit(BUCKETS // BAND - 1)),
        lambda i: F.struct(i.alias("band"), F.substring("sketch", i * width + 1, F.lit(width)).alias("regs")),
    )
    bands = (
        classes.select("id", F.explode(cut).alias("x"))
        .where(F.col("x.regs") != F.lit(b"\xff" * width))
        .select("id", F.col("x.band").alias("band"), F.xxhash64("x.regs").alias("key"))
    )
    shared = written(
        bands.groupBy("band", "key").agg(F.count("*").alias("m"), F.min("id").alias("least")).where("m > 1"),
        "shared-bands",
    )
    members = written(bands.join(shared, ["band", "key"]), "band-members")

    # First the least member of each band: one verified link joins most of a group. The only pair of
    # a band of two is verified even if it is not the best.
    x = classes.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    y = classes.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))

    @F.pandas_udf("double")
    def hope(sa: pd.Series, sb: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        a, b, na, nb = _rows(sa), _rows(sb), na.to_numpy(), nb.to_numpy()
        used = ((a != EMPTY) | (b != EMPTY)).sum(axis=1)
        found = corrected(((a == b) & (a != EMPTY)).sum(axis=1), used, na, nb)
        return pd.Series(np.where(near_enough(found, used, na, nb, rule), found, -1.0))

    stars = (
        members.where("id != least").groupBy(F.col("id").alias("a"), F.col("least").alias("b"))
        .agg((F.min("m") == 2).alias("only"))
    )
    stars = (
        stars.join(x, "a").join(y, "b")
        .select("a", "b", "only", hope("sa", "sb", "na", "nb").alias("hope"))
        .where("hope >= 0")
        .groupBy("a").agg(
            F.max(F.struct("hope", -F.col("b"))).alias("best"), F.collect_set(F.when(F.col("only"), F.col("b"))).alias("only")
        )
        .select("a", F.explode(F.array_union("only", F.array(-F.col("best")["col2"]))).alias("b"))
    )
    stars = written(stars, "star-pairs")

    # Sets of the candidate classes, from the texts under their ids.
    wanted = classes.select("k1", "k2", "id").join(members.select("id").distinct(), "id", "left_semi")
    texts = given.join(
        wanted.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi"
    ).unionByName(given.where("doc_id is null"))
    sets = (
        shingle_sets(texts, rule).dropDuplicates(["k1", "k2"])
        .join(wanted, ["k1", "k2"]).select("id", "grams")
    )
    sets = written(sets, "shingle-sets")
    first = written(verified(stars, sets, rule), "first-links")
    # Then larger bands that hold more than one component: where many pairs are promising, the best
    # partners of each member, as long as that links anything, and at last all that is left.
    links, roots = first, connected(first)
    dealt = _dealt(_within_reach(_open_bands(members.where("m > 2"), roots), classes, sets, rule), classes)
    while True:
        rows, n_rows, n_pairs = _concerned_rows(dealt, rule)
        if n_pairs <= MANY * n_rows:
            break
        pairs = _sorted(rows).mapInPandas(lambda it: _best_pairs(it, rule), "band int, key long, x long, y long")
        some = written(_ordered(pairs), "best-pairs")
        more = written(verified(some, sets, rule), "best-links")
        few = more.count() * 100 <= some.count()
        # Links so far, as one link from each node to its root.
        links = written(roots.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(more), "links-so-far")
        if few:
            break
        roots = connected(links)
        dealt = _sorted(_labelled(rows.drop("label", "pairs"), roots))
    if n_rows:
        # Pairs are found again, now with the sets of those concerned; only links leave a task.
        full = _sorted(rows.join(sets, "id"))
        rest = _ordered(full.mapInPandas(lambda it: _block_links(it, rule), "x long, y long"))
        roots = connected(links.unionByName(rest))
    named = written(
        classes.select("k1", "k2", "id").join(roots, "id", "left")
        .select("k1", "k2", F.coalesce("root", "id").alias("component")),
        "class-components",
    )
    out = drawn.select("doc_id", "n_shingles", "k1", "k2").join(
        named.withColumnsRenamed({"k1": "_k1", "k2": "_k2"}),
        (F.col("n_shingles") > 0) & (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")),
        "left",
    )
    component = F.when(F.col("component") < UNNAMED, F.col("component"))
    return out.select("doc_id", "n_shingles", F.coalesce(component, "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Rule(words=4))
