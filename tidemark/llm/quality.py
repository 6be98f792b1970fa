"""Quality rules: counts of a text, and its divergence from its language.

For every text two histograms are taken: of character classes, and of the common words of
the languages known here (with all other words as one class). The reference of a language
is the sum of the histograms of all its documents, whatever their share of the table, from
``MIN_DOCS`` documents with ``MIN_WORDS`` words in all on. Documents of a language with less are
not judged by distance, as no other language tells what is usual in theirs; those without
a language are held against the nearest reference of all. The distance is Jensen-Shannon's
(square root of the divergence, base 2: 0 to 1).
A text shorter than the minimum lengths is not judged, since its histograms say little.

All of it is built-in functions. The counts are taken once and written to the shared folder;
references and distances both read that narrow table. The references are broadcast, under
two kilobytes a language.

Defined cases: a null or blank text has no words and fails the least word count; rows that
repeat an id are judged each; an empty table gives an empty result; other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import SPACES, table, text_or_empty, words_of, written

# Frequent words of each language, as found in public stop-word lists.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch",
    "en": "the of and to in is that it for was on are as with be this by at or an",
    "es": "de la que el en y a los del se las por un para con no una su al es",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur",
}
# Character classes as Java patterns; what is left is a class of its own.
CLASSES = {
    "lower": r"\p{Ll}+",
    "upper": r"\p{Lu}+",
    "digit": r"\p{Nd}+",
    "space": SPACES,
    "stop": ".,;:",
    "symbol": "#*$%&|<>",
}
SYMBOLS = CLASSES["symbol"]
MIN_DOCS = 20
MIN_WORDS = 5000


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    # Least lengths for a verdict by divergence.
    judged_words: int = 30
    judged_chars: int = 150
    # Greatest distances: a fixed part, and one that falls with the root of the words, as
    # the histograms of short texts stray further by chance.
    class_distance: tuple[float, float] = (0.17, 0.5)
    word_distance: tuple[float, float] = (0.28, 1.5)


def vocabulary(lists: dict[str, str] = COMMON_WORDS) -> list[str]:
    return sorted({w for words in lists.values() for w in words.split()})


def repeated_words(words: Column, window: int) -> Column:
    """Words inside windows of ``window`` words that the text has twice or more."""
    count = F.size(words)
    grams = F.transform(
        F.sequence(F.lit(0), count - window),
        lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(window))),
    )

    def covered(grams):
        # Sorted with their places, equal windows stand side by side.
        placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        near = lambda s, j, d: F.coalesce(
            F.when(j + d >= 0, F.get(s, j + d))["g"] == F.get(s, j)["g"], F.lit(False)
        )

        def places(s):
            twice = F.filter(s, lambda x, j: near(s, j, -1) | near(s, j, 1))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        def spread(at):
            # Each place adds its window less the overlap with the place before.
            return F.aggregate(
                at,
                F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n")),
                lambda acc, p: F.struct(
                    p.alias("last"), (acc["n"] + F.least(F.lit(window), p - acc["last"])).alias("n")
                ),
                lambda acc: acc["n"],
            )

        inner = F.transform(F.array(placed), lambda s: places(s))
        return F.get(F.transform(inner, spread), F.lit(0))

    some = F.transform(
        F.array(grams),
        lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(F.lit(0)),
    )
    return F.when(count > window, F.get(some, F.lit(0))).otherwise(F.lit(0)).cast("long")


def counts(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One narrow row for each document: the base counts and both histograms."""
    vocab = vocabulary()
    text = F.col("_text")
    # Longer words are none of the vocabulary, with up to three marks behind them.
    longest = max(map(len, vocab)) + 3
    short = F.filter("_words", lambda w: F.length(w) <= longest)
    plain = lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?"))
    # Each class is taken out of what the ones before have left, which soon is little.
    by_class = docs.select("doc_id", "lang", text_or_empty().alias("_text")).withColumn("_left", text)
    for kind, what in CLASSES.items():
        left = F.col("_left")
        rest = F.regexp_replace(left, what, "") if what[0] == "\\" else F.translate(left, what, "")
        by_class = by_class.withColumn("_rest", rest).select(
            *(c for c in by_class.columns if c != "_left"),
            (F.length("_left") - F.length("_rest")).alias(f"_c_{kind}"),
            F.col("_rest").alias("_left"),
        )
    rows = (
        by_class.withColumn("_words", words_of(text))
        .select(
            "doc_id",
            "lang",
            "_text",
            "_words",
            F.size("_words").cast("long").alias("n_words"),
            F.filter(F.split("_text", "\n"), lambda x: F.length(F.trim(x, F.lit(SPACES))) > 0).alias("_lines"),
            F.array_join(F.filter(F.transform(short, plain), lambda w: w.isin(*vocab)), "  ").alias("_common"),
            F.length("_text").cast("long").alias("_chars"),
            *(F.col(f"_c_{k}").cast("long").alias(f"_c_{k}") for k in CLASSES),
            repeated_words(F.col("_words"), rules.window).alias("n_repeat_words"),
        )
    )
    known = sum((F.col(f"_c_{k}") for k in CLASSES), F.lit(0))
    # Common words stand between blanks of their own, so that taking one out leaves the rest.
    joined = F.concat(F.lit(" "), F.col("_common"), F.lit(" "))
    found = F.array(
        *(
            ((F.length(joined) - F.length(F.replace(joined, F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)).cast("long")
            for w in vocab
        )
    )
    rest = F.col("n_words") - F.aggregate("_found", F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.withColumn("_found", found).select(
        "doc_id",
        "lang",
        "n_words",
        (F.col("_chars") - F.col("_c_space")).alias("word_chars"),
        F.col("_c_symbol").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        "_chars",
        F.array(*(f"_c_{k}" for k in CLASSES), F.col("_chars") - known).alias("_classes"),
        F.concat("_found", F.array(rest)).alias("_hist"),
    )


def references(stats: DataFrame) -> DataFrame:
    """``_lang, _refs``: an array with the summed histograms of the language, for each that
    has enough of them, and with those of all these languages for a null ``_lang``."""
    sizes = {"_classes": len(CLASSES) + 1, "_hist": len(vocabulary()) + 1}
    sums = [
        F.array(*(F.sum(F.get(c, F.lit(i))) for i in range(n))).alias(c) for c, n in sizes.items()
    ]
    own = (
        stats.where(F.col("lang").isNotNull())
        .groupBy(F.col("lang").alias("_lang"))
        .agg(F.count("*").alias("_n"), F.sum("n_words").alias("_w"), *sums)
        .where((F.col("_n") >= MIN_DOCS) & (F.col("_w") >= MIN_WORDS))
        .select("_lang", F.struct(*sizes).alias("_one"))
    )
    whole = own.agg(F.collect_list("_one").alias("_refs"))
    return own.select("_lang", F.array("_one").alias("_refs")).unionByName(
        whole.select(F.lit(None).cast("string").alias("_lang"), "_refs")
    )


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts; null if either is empty."""
    total = lambda h: F.aggregate(h, F.lit(0).cast("double"), lambda a, x: a + x)
    term = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def of(pair):
        n, m = pair["n"], pair["m"]
        parts = F.zip_with(
            p, q, lambda x, y: term(x / n, (x / n + y / m) / 2) / 2 + term(y / m, (x / n + y / m) / 2) / 2
        )
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)))

    sums = F.array(F.struct(total(p).alias("n"), total(q).alias("m")))
    return F.get(
        F.transform(F.filter(sums, lambda s: (s["n"] > 0) & (s["m"] > 0)), of), F.lit(0)
    )


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Counts, ``base_failed``, both distances (null where not judged) and ``kept``."""
    stats = written(counts(docs, rules), "quality-counts")
    refs = written(references(stats).coalesce(1), "quality-references")
    rows = stats.join(F.broadcast(refs), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    least = lambda c: F.array_min(F.transform("_refs", lambda ref: distance(F.col(c), ref[c])))
    long_enough = (F.col("n_words") >= rules.judged_words) & (F.col("_chars") >= rules.judged_chars)
    rows = rows.select(
        *(c for c in stats.columns if c not in ("_classes", "_hist")),
        F.when(long_enough, least("_classes")).alias("class_distance"),
        F.when(long_enough, least("_hist")).alias("word_distance"),
        ((F.col("n_words") < rules.min_words)
         | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))).alias("base_failed"),
    )
    stray = 1 / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    near = F.lit(True)
    for name in ("class_distance", "word_distance"):
        fixed, falling = getattr(rules, name)
        near &= F.coalesce(F.col(name) <= fixed + falling * stray, F.lit(True))
    return rows.withColumn("kept", ~F.col("base_failed") & near).drop("_chars")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )
