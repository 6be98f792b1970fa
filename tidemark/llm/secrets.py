"""Secret scans: fixed patterns plus a sliding-window entropy scan, as SQL expressions.

Spans are counted in code points, end exclusive. A regular expression yields its matches and,
by splitting, what lies between them; the lengths of both give the positions, so the whole
scan is built-in functions.

The entropy scan looks at what a fixed pattern has not covered and is no word of the
allow-list (``HARMLESS``). It takes candidate strings there (runs of ``CANDIDATE``, cut where such a
span or word stands), sorts each into a character class (``hex`` or ``base64``), and slides a window over it. Counts per character are kept
from window to window: one character enters, one leaves, and ``sum(c * log2 c)`` changes by
two terms, from which Shannon entropy follows. A candidate counts from the first to the last
window at or above the threshold of its class, unless its whole form is ``ALLOWED``.

Defined cases: null text is empty; an empty text has no spans; repeated rows are scanned
each; texts are scanned whole, however long. Only the named columns of the input are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import table

# Fixed patterns and their least lengths.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
# Runs of the class are maximal, so a least length in the pattern drops the same ones.
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")


@dataclass(frozen=True)
class EntropyRule:
    """``window`` characters whose entropy is at least ``bits`` a character."""

    window: int
    bits: float


# A window of random characters stays near log2 of its alphabet or length, words far below.
RULES = {"hex": EntropyRule(24, 3.0), "base64": EntropyRule(20, 3.8)}

# Candidates that look random but are no secrets.
ALLOWED = "|".join((
    r"^[A-Za-z/_=-]+[0-9]{0,4}$",  # words, paths and identifiers of words
    r"^[0-9_=+/-]+$",  # numbers, rulers, dates
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUIDs
))

# Words that stand for a secret; what is joined to them may still be one.
HARMLESS = r"(?i)example|placeholder|changeme|x{6,}"

_SPANS = "array<struct<start:bigint,rank:int,stop:bigint,kind:string>>"


def _bound(value: Column, build) -> Column:
    """``build(value)`` with ``value`` worked out once, however often and in whatever inner
    function ``build`` uses it."""
    return F.get(F.transform(F.array(value), build), F.lit(0))


def _before(values: Column, merge) -> Column:
    """What ``merge``, from 0, makes of all values before each one of an array. Blocks of the
    root of its length are folded first, so that no append copies more than such a block."""
    zero, none = F.lit(0).cast("long"), F.array().cast("array<bigint>")

    def fold(block):
        state = F.struct(zero.alias("at"), none.alias("out"))
        return F.aggregate(
            block,
            state,
            lambda acc, v: F.struct(
                merge(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")
            ),
        )

    def blocks(all_):
        width = F.greatest(F.ceil(F.sqrt(F.size(all_))), F.lit(1)).cast("int")
        firsts = F.sequence(F.lit(1), F.greatest(F.size(all_), F.lit(1)), width)
        return F.transform(firsts, lambda i: fold(F.slice(all_, i, width)))

    state = F.struct(zero.alias("at"), F.array().cast("array<array<bigint>>").alias("out"))
    joined = F.aggregate(
        _bound(values, blocks),
        state,
        lambda acc, block: F.struct(
            merge(acc["at"], block["at"]).alias("at"),
            F.concat(
                acc["out"], F.array(F.transform(block["out"], lambda v: merge(acc["at"], v)))
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.flatten(joined)


def _located(text: Column, pattern: str, build) -> Column:
    """``build`` of the leftmost non-overlapping matches (``m``, ``start``), in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(
        found,
        F.slice(between, F.lit(1), F.size(between) - 1),
        lambda m, gap: F.struct(m.alias("m"), F.length(gap).cast("long").alias("gap")),
    )

    def spots(all_):
        begun = _before(
            F.transform(all_, lambda p: p["gap"] + F.length(p["m"])), lambda at, v: at + v
        )
        return F.zip_with(
            all_, begun, lambda p, at: F.struct(p["m"].alias("m"), (at + p["gap"]).alias("start"))
        )

    none = F.array().cast("array<struct<m:string,start:bigint>>")
    return _bound(F.when(text.rlike(pattern), _bound(pairs, spots)).otherwise(none), build)


def _span(kind: str, start: Column, stop: Column) -> Column:
    return F.struct(
        start.cast("long").alias("start"),
        F.lit(KINDS.index(kind)).alias("rank"),
        stop.cast("long").alias("stop"),
        F.lit(kind).alias("kind"),
    )


def _pattern_spans(text: Column, kind: str, pattern: str, keep) -> Column:
    return _located(
        text,
        pattern,
        lambda spots: F.transform(
            F.filter(spots, lambda s: keep(s["m"])),
            lambda s: _span(kind, s["start"], s["start"] + F.length(s["m"])),
        ),
    )


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns by start, then kind as listed."""
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8
    return F.sort_array(
        F.concat(
            _pattern_spans(text, "assign", ASSIGN, value),
            _pattern_spans(text, "access", ACCESS, lambda m: F.length(m) >= 16),
            _pattern_spans(text, "hex", HEX, lambda m: F.length(m) >= 32),
        )
    )


def hot_windows(value: Column, rule: EntropyRule) -> Column:
    """``struct<first, last>``: where the first and the last window of ``value`` start that
    reach ``rule.bits``; null fields when none does. ASCII only, windows of at most 127."""
    terms = F.array(*(F.lit(c * log2(c) if c else 0.0) for c in range(rule.window + 2)))
    none = F.lit(None).cast("int")

    # Counts lie in one byte each, eight to a number.
    def place(c):
        code = F.ascii(c)
        byte = code.bitwiseAND(7) * 8
        return F.struct(
            F.shiftright(code, 3).alias("slot"),
            byte.alias("byte"),
            F.call_function("shiftleft", F.lit(1).cast("long"), byte).alias("unit"),
        )

    def steps(places):
        nowhere = F.lit(None).cast("struct<slot:int,byte:int,unit:bigint>")
        gone = F.concat(F.array_repeat(nowhere, rule.window), places)
        return F.zip_with(
            places,
            F.slice(gone, F.lit(1), F.size(places)),
            lambda new, old: F.struct(new.alias("new"), old.alias("old")),
        )

    state = F.struct(
        F.array_repeat(F.lit(0).cast("long"), 16).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(0).alias("seen"),
        none.alias("first"),
        none.alias("last"),
    )

    def judged(acc):
        """First and last with the window that ends here."""
        begin = acc["seen"] - rule.window
        # The margin is for rounding of the running sum.
        hot = (begin >= 0) & (acc["total"] <= rule.window * (log2(rule.window) - rule.bits + 1e-9))
        first = F.when(acc["first"].isNull() & hot, begin).otherwise(acc["first"])
        return first.alias("first"), F.when(hot, begin).otherwise(acc["last"]).alias("last")

    def count(acc, p):
        word = F.get(acc["counts"], p["slot"])
        return F.call_function("shiftright", word, p["byte"]).bitwiseAND(127).cast("int")

    def slide(acc, s):
        new, old = s["new"], s["old"]
        came = F.get(terms, count(acc, new) + 1) - F.get(terms, count(acc, new))
        left = F.get(terms, count(acc, old) - 1) - F.get(terms, count(acc, old))
        # The old character leaves after the new one has come; equal ones cancel out.
        change = F.when(old.isNull(), came).when(old == new, F.lit(0.0)).otherwise(came + left)
        counts = F.transform(
            acc["counts"],
            lambda word, k: F.when(k == new["slot"], word + new["unit"]).otherwise(word)
            - F.when(k == old["slot"], old["unit"]).otherwise(F.lit(0).cast("long")),
        )
        return F.struct(
            F.when(old.isNotNull() & (old == new), acc["counts"]).otherwise(counts).alias("counts"),
            (acc["total"] + change).alias("total"),
            (acc["seen"] + 1).alias("seen"),
            *judged(acc),
        )

    places = F.transform(F.split(value, ""), place)
    return F.aggregate(_bound(places, steps), state, slide, lambda acc: F.struct(*judged(acc)))


def _hot(spots: Column, name: str, rule: EntropyRule) -> Column:
    """Spans of the candidates of one class that reach its threshold."""
    is_hex = lambda s: s["m"].rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
    mine = F.filter(spots, is_hex if name == "hex" else lambda s: ~is_hex(s))
    seen = F.transform(
        mine, lambda s: F.struct(s["start"].alias("start"), hot_windows(s["m"], rule).alias("hot"))
    )
    return F.transform(
        F.filter(seen, lambda s: s["hot"]["first"].isNotNull()),
        lambda s: _span(
            f"entropy_{name}", s["start"] + s["hot"]["first"], s["start"] + s["hot"]["last"] + rule.window
        ),
    )


def _rewritten(text: Column, spans: Column, mark) -> Column:
    """``text`` with ``mark(span, at)`` for all characters in ``spans``, which are sorted by
    start; ``at`` is where the spans before end."""

    def build(chars):
        part = lambda at, n: F.array_join(
            F.slice(chars, (at + 1).cast("int"), F.greatest(n, F.lit(0)).cast("int")), ""
        )
        ends = _before(F.transform(spans, lambda s: s["stop"]), F.greatest)
        pieces = F.zip_with(
            spans, ends, lambda s, at: F.concat(part(at, s["start"] - at), mark(s, at))
        )
        done = F.array_max(F.transform(spans, lambda s: s["stop"]))
        return F.array_join(F.concat(pieces, F.array(part(done, F.size(chars) - done))), "")

    return F.when(F.size(spans) > 0, _bound(F.split(text, ""), build)).otherwise(text)


def blanked(text: Column, spans: Column) -> Column:
    """``text`` with blanks for all characters in ``spans``, which are sorted by start."""

    def mark(s, at):
        fresh = F.greatest(s["stop"], at) - F.greatest(s["start"], at)
        return F.repeat(F.lit(" "), fresh.cast("int"))

    return _rewritten(text, spans, mark)


def harmless_spans(text: Column) -> Column:
    return _located(
        text,
        HARMLESS,
        lambda spots: F.transform(
            spots,
            lambda s: F.struct(s["start"].alias("start"), (s["start"] + F.length(s["m"])).alias("stop")),
        ),
    )


def entropy_spans(text: Column) -> Column:
    """Spans of high entropy."""

    def build(spots):
        open_ = F.filter(spots, lambda s: ~s["m"].rlike(ALLOWED))
        return F.concat(*(_hot(open_, name, rule) for name, rule in RULES.items()))

    return _located(text, CANDIDATE, build)


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_text`` (null read as empty), ``_base`` and ``_spans``; the first
    holds the fixed patterns, the second all spans."""
    return (
        docs.withColumn("_text", F.coalesce("text", F.lit("")))
        .withColumn("_base", base_spans(F.col("_text")).cast(_SPANS))
        .withColumn("_rest", blanked(F.col("_text"), F.col("_base")))
        # A word half covered by a fixed pattern is still a word.
        .withColumn("_rest", blanked(F.col("_rest"), harmless_spans(F.col("_text"))))
        .withColumn("_spans", F.sort_array(F.concat("_base", entropy_spans(F.col("_rest")))).cast(_SPANS))
        .drop("_rest")
    )


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by ``[kind]``; overlapping spans give one mark."""

    def mark(s, at):
        return F.when(s["start"] >= at, F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise("")

    return _rewritten(text, spans, mark)


def listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(listed(F.col("_base")), 256).alias("base_sha256"),
        listed(F.col("_spans")).alias("spans"),
    )
