"""Quality rules with adaptive thresholds.

Cut-offs are not fixed numbers: every group of documents (language and source) gets its own, read from a quantile
sketch of each measure. The sketch is a histogram over log-linear buckets (16 per power of two, so a quantile is off by
at most a sixteenth). Histograms of two groups merge by adding counts, which is how a group that is too small to speak
for itself falls back to its language, and that to the whole table.

A document is measured once and the measures are written; the sketch is an aggregate with partial sums, so a hot
source costs no more than any other, and thresholds come back by an ordinary join of one row per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import cut_lineage
from .common import SPACE_CLASS, fresh, nullable_key, quoted, text_of, words_of

# measure: (numerator, denominator, least distance of the fence from the median), in thousandths
MEASURES = {
    "symbols": ("n_symbols", "n_words", 150),
    "dup_lines": ("n_dup_lines", "n_lines", 300),
    "repeats": ("n_repeat_words", "n_words", 300),
    "capitals": ("n_capitals", "word_chars", 300),
    "word_length": ("word_chars", "n_words", 6000),
}
WIDTH = 6          # fence: median + WIDTH * (upper quartile - median)
LEAST_GROUP = 100  # smaller groups use the sketch of the next larger one
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The frame with a column `m`: a struct of the counts in COUNTS, of the whole text of each row.

    A missing text counts as empty: every count is zero. Other columns pass through untouched.
    """
    t, w, h, s, p, line, m = fresh(docs, "t_", "w_", "h_", "s_", "p_", "l_", "m")
    keep = docs.columns
    step = docs.withColumn(t, text_of(text))
    step = step.withColumn(w, words_of(F.col(t))).withColumn(
        line, F.filter(F.split(F.col(t), "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != ""))
    words = F.col(w)
    step = step.withColumn(h, F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2))))
    repeated = F.size(F.array_distinct(h)) < F.size(h)
    step = step.withColumn(s, F.when(repeated, F.sort_array(F.transform(
        F.col(h), lambda x, i: F.struct(x.alias("h"), i.alias("p"))))))
    same = lambda x, i, d: F.coalesce(F.get(F.col(s), i + d)["h"] == x["h"], F.lit(False))
    marked = F.filter(F.col(s), lambda x, i: same(x, i, -1) | same(x, i, 1))
    step = step.withColumn(p, F.when(F.col(s).isNotNull(), F.array_sort(F.transform(marked, lambda x: x["p"]))))
    covered = F.aggregate(
        F.transform(F.col(p), lambda x, i: F.least(F.lit(3), F.coalesce(F.get(F.col(p), i + 1) - x, F.lit(3)))),
        F.lit(0), lambda a, x: a + x)
    without = lambda pattern: F.length(F.col(t)) - F.length(F.regexp_replace(F.col(t), pattern, ""))
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.col(t)) - without(SPACE_CLASS),
        "n_symbols": without("[#*$%&|<>]+"),
        "n_dup_lines": F.size(line) - F.size(F.array_distinct(line)),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size(line),
        "n_capitals": without(r"\p{Lu}+"),
    }
    return step.select(*[docs[quoted(c)] for c in keep], F.struct(*[v.cast("long").alias(k) for k, v in counts.items()]).alias(m))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def thousandths(m: Column, name: str) -> Column:
    over, under, _ = MEASURES[name]
    return F.when(m[under] > 0, F.floor(1000 * m[over] / m[under])).otherwise(0).cast("long")


def bucket(v: Column) -> Column:
    """Log-linear bucket of a whole number from 0: exact below 32, then 16 buckets per power of two."""
    e = F.greatest(F.length(F.bin(v)) - 5, F.lit(0))
    return e * 16 + F.call_function("shiftright", v, e).cast("int")


def bucket_top(b: Column) -> Column:
    """The largest number in a bucket."""
    e = F.when(b < 32, F.lit(0)).otherwise(F.floor(b / 16).cast("int") - 1)
    return F.call_function("shiftleft", (b - e * 16 + 1).cast("long"), e) - 1


def sketch(measured: DataFrame, m: str, lang: str, source: str) -> DataFrame:
    """Histogram (lang_key, source_key, measure, bucket, n) of the rows that pass the base rules."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("measure"), bucket(thousandths(F.col(m), name)).alias("bucket")) for name in MEASURES]))
    rows = measured.where(~base_failed(F.col(m))).select(
        nullable_key(lang).alias("lang_key"), nullable_key(source).alias("source_key"), pairs.alias("x"))
    return rows.groupBy("lang_key", "source_key", "x.measure", "x.bucket").agg(F.count(F.lit(1)).alias("n"))


def fences(hist: DataFrame) -> DataFrame:
    """One row per (lang_key, source_key) with a map measure -> largest accepted value, in thousandths."""
    levels = (("lang_key", "source_key"), ("lang_key",), ())
    found = None
    for depth, keys in enumerate(levels):
        merged = hist.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
        w = W.partitionBy(*keys, "measure")
        ranked = merged.withColumn("cum", F.sum("n").over(w.orderBy("bucket"))).withColumn("all", F.sum("n").over(w))
        quant = lambda pct: F.min(F.when(F.col("cum") * 100 >= F.col("all") * pct, bucket_top(F.col("bucket"))))
        slack = F.element_at(F.create_map(*[F.lit(x) for k, (_, _, d) in MEASURES.items() for x in (k, d)]), F.col("measure"))
        level = ranked.groupBy(*keys, "measure").agg(quant(50).alias("mid"), quant(75).alias("up"), F.max("all").alias("n")).select(
            *keys, "measure", F.col("n").alias(f"n{depth}"),
            (F.col("mid") + F.greatest(slack, WIDTH * (F.col("up") - F.col("mid")))).cast("long").alias(f"f{depth}"))
        found = level if found is None else found.join(level, [*keys, "measure"])
    fence = F.when(F.col("n0") >= LEAST_GROUP, F.col("f0")).when(F.col("n1") >= LEAST_GROUP, F.col("f1")).otherwise(F.col("f2"))
    return found.groupBy("lang_key", "source_key").agg(
        F.map_from_entries(F.collect_list(F.struct("measure", fence.alias("fence")))).alias("fences"))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          carry: list[str] | None = None) -> DataFrame:
    """The frame (or its columns `carry`, which must hold language and source) with `m` (counts), `base_failed` and `kept`; one row out per row in, repeated rows included.

    A row is kept if the base rules pass it and no measure lies above the fence of its group. Missing languages and
    sources are groups of their own. Empty texts fail the base rules; an empty table gives an empty frame.
    """
    measured = measure(docs, text)
    m = measured.columns[-1]
    written = cut_lineage(measured if carry is None else measured.select(*[F.col(quoted(c)) for c in carry], m))
    # Written, so that Spark knows its size when it plans the join, and moves the texts only if there are too many groups.
    limit = cut_lineage(fences(sketch(written, m, lang, source)))
    kl, ks, failed, kept = fresh(written, "kl_", "ks_", "base_failed", "kept")
    keyed = written.withColumn(kl, nullable_key(lang)).withColumn(ks, nullable_key(source))
    joined = keyed.join(limit, (F.col(kl) == F.col("lang_key")) & (F.col(ks) == F.col("source_key")), "left")
    inside = [thousandths(F.col(m), name) <= F.coalesce(limit["fences"][name], F.lit(2**62)) for name in MEASURES]
    verdict = ~base_failed(F.col(m))
    for ok in inside:
        verdict = verdict & ok
    return joined.select(*[written[quoted(c)] for c in written.columns], base_failed(F.col(m)).alias(failed), verdict.alias(kept))
