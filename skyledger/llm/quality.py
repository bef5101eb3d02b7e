"""Quality rules with adaptive thresholds (operator 7), with DataFrame operations only.

Base counts are array expressions of one row. Four ratios follow from them; a KLL sketch per (language, source) holds the
distribution of each, sketches merge into one per language and one over everything, and the thresholds are fences read
from the sketches: quartiles widened by FENCE times their distance. Shares of repeated lines and words are zero in most
documents, so theirs come from a sketch of the non-zero values: median and 90 % quantile, if at least RARE of the documents
have any, and otherwise no repetition is usual in the group. A group with fewer than LEAST documents takes the
sketch of its language, and a small language that of the whole table. The fences, a few per group, are joined back, and a
document outside any of them is not kept. Sketches are partial aggregates, so a source with a third of all rows is no
burden; documents that fail the base rules do not shape the fences.

Defined cases: null text has no words and fails the base rules; null lang or source is a group of its own; equal rows are
judged alike; an empty table gives an empty result; further columns of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.columns import WORD, words
from skyledger.sources.tables import stage

SYMBOLS = "[#*$%&|<>]"
K = 400
FENCE = 4.0
LEAST = 200
RARE = 0.01
#: Ratios with the smallest distance of quantiles they are widened by, and whether low values count as well.
RATIOS = {"symbol_ratio": (0.01, False), "dup_line_ratio": (1e-9, False), "repeat_ratio": (1e-9, False), "word_length": (0.25, True)}
#: Ratios whose fences come from their non-zero values; the distance is only against numerical ties.
NON_ZERO = ("dup_line_ratio", "repeat_ratio")


def repeated_words(tokens: Column) -> Column:
    """How many words lie in a 3-word window that the text holds twice or more.

    Windows are sorted with their places, so equal ones are neighbours; the places that have an equal neighbour are sorted
    again, and each covers three words less those that the next one covers."""
    at = F.sequence(F.lit(0), F.size(tokens) - 3)
    windows = F.transform(at, lambda i: F.struct(F.concat_ws(" ", F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)).alias("w"), i.alias("i")))

    def places(ordered: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(ordered, j)["w"] == x["w"], F.lit(False))
        hit = F.filter(ordered, lambda x, j: same(x, j - 1) | same(x, j + 1))
        return F.array_sort(F.transform(hit, lambda x: x["i"]))

    def covered(found: Column) -> Column:
        gaps = F.transform(found, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(found, j + 1), p + 3) - p))
        return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

    let = lambda value, body: F.get(F.transform(F.array(value), body), 0)
    counted = let(F.array_sort(windows), lambda ordered: let(places(ordered), covered))
    return F.when(F.size(tokens) < 4, 0).otherwise(counted).cast("long")


def base_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, counts): one row for each document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = docs.select("doc_id", "lang", "source", text.alias("text")).withColumn("tokens", words(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda line: F.regexp_like(line, F.lit(WORD)))
    return split.select(
        "doc_id", "lang", "source",
        F.size("tokens").cast("long").alias("n_words"),
        F.length(F.array_join("tokens", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.get(F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x))), 0).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        repeated_words(F.col("tokens")).alias("n_repeat_words"),
    )


def with_ratios(counts: DataFrame) -> DataFrame:
    n = F.col("n_words")
    return counts.withColumns({
        "base_failed": (n < 50) | (100 * F.col("n_repeat_words") > 50 * n),
        "symbol_ratio": F.try_divide("n_symbols", "word_chars"),
        "dup_line_ratio": F.try_divide("n_dup_lines", "n_lines"),
        "repeat_ratio": F.try_divide("n_repeat_words", "n_words"),
        "word_length": F.try_divide("word_chars", "n_words"),
    })


def fences(rated: DataFrame, k: int = K, least: int = LEAST, fence: float = FENCE) -> DataFrame:
    """(lang, source, <ratio>_low, <ratio>_high) from mergeable sketches, one row for each group of the table."""
    shapes = {r: f"NOT base_failed AND {r} > 0" if r in NON_ZERO else "NOT base_failed" for r in RATIOS}
    shaping = [F.expr(f"kll_sketch_agg_double(CASE WHEN {shapes[r]} THEN {r} END, {k})").alias(r) for r in RATIOS]
    having = [F.count_if(F.expr(shapes[r])).alias(f"n_{r}") for r in RATIOS]
    merging = [F.expr(f"kll_merge_agg_double({r}, {k})").alias(r) for r in RATIOS] + [F.sum(f"n_{r}").alias(f"n_{r}") for r in RATIOS]
    n = F.sum("n").alias("n")
    groups = stage(rated.groupBy("lang", "source").agg(F.count_if(~F.col("base_failed")).alias("n"), *shaping, *having), "sketches")
    languages = groups.groupBy("lang").agg(n, *merging)

    def quantiles(ratio: str, prefix: str = "") -> Column:
        """The two quantiles of a group that its fence is made of."""
        low, high = (0.5, 0.9) if ratio in NON_ZERO else (0.25, 0.75)
        read = F.call_function("kll_sketch_get_quantile_double", F.col(prefix + ratio), F.array(F.lit(low), F.lit(high)))
        usual = F.col(f"{prefix}n_{ratio}") >= RARE * F.col(f"{prefix}n")
        return F.when(usual, read).otherwise(F.array(F.lit(0.0), F.lit(0.0)))

    overall = groups.agg(n, *merging).select(*[F.when(F.col("n") > 0, quantiles(r)).alias(r) for r in RATIOS]).first()
    placed = groups.join(languages.select(*[F.col(c).alias(f"l_{c}") for c in languages.columns]), F.col("lang").eqNullSafe(F.col("l_lang")))
    out = [F.col("lang"), F.col("source")]
    for ratio, (smallest, both) in RATIOS.items():
        every = F.lit(None).cast("array<double>") if overall[ratio] is None else F.array(*[F.lit(float(q)) for q in overall[ratio]])
        own = F.when(F.col("n") >= least, quantiles(ratio)).when(F.col("l_n") >= least, quantiles(ratio, "l_")).otherwise(every)
        width = fence * F.greatest(own[1] - own[0], F.lit(smallest))
        out += [(own[0] - width if both else F.lit(float("-inf"))).alias(f"{ratio}_low"), (own[1] + width).alias(f"{ratio}_high")]
    return placed.select(*out)


def quality(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, the counts, base_failed and kept."""
    rated = stage(with_ratios(base_counts(docs)), "rated")
    limits = stage(fences(rated, **options), "fences")
    held = rated.alias("d").join(limits.alias("f"), F.col("d.lang").eqNullSafe(F.col("f.lang")) & F.col("d.source").eqNullSafe(F.col("f.source")))
    inside = ~F.col("base_failed")
    for ratio in RATIOS:
        inside &= F.coalesce(F.col(ratio).between(F.col(f"{ratio}_low"), F.col(f"{ratio}_high")), F.lit(False))
    return held.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", inside.alias("kept"))
