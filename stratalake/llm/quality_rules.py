"""Quality rules: hashed n-gram log-likelihood ratio of trusted target to raw corpus.

Two multinomials over hashed pairs of neighbouring word endings are fitted, on trusted texts and
on all texts; a text's mean log ratio over its n-grams meets one fixed threshold. A word equal to
the one before it counts as a special ending. Beside it stand plain rules on counts. Everything is
DataFrame functions; an n-gram exists only between the scan and a partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import TRUSTED, saved, trusted_ids

BUCKETS = 1 << 16
#: Pseudo-count, in n-grams of the target sample.
SMOOTHING = 5.0
#: Least mean log ratio, in nats per n-gram, of a text that is kept.
THRESHOLD = -0.4
LEAST_WORDS = 20
#: Words of a window whose second occurrence is a repetition, and the share of words in such windows.
REPEAT_WINDOW = 8
MOST_REPEATED_PERCENT = 30
NOT_SYMBOLS = r"[^#*$%&|<>]+"
WORD = r"[^\x20\x09-\x0D]+"


def _ending(word: str) -> str:
    return f"substring({word}, -2)"


def _bucket(before: str, word: str) -> Column:
    """Bucket of the n-gram of two neighbours."""
    ending = f"CASE WHEN {word} = {before} THEN '=' ELSE {_ending(word)} END"
    return F.expr(f"CAST(pmod(xxhash64({_ending(before)}, {ending}), {BUCKETS}) AS INT)")


def _pairs(words: str) -> Column:
    """One ``struct(before, word)`` per word; the first word's neighbour is empty. NULL without words."""
    return F.when(
        F.size(words) > 0,
        F.arrays_zip(
            F.concat(F.array(F.lit("")), F.slice(words, F.lit(1), F.size(words) - 1)).alias("before"),
            F.col(words).alias("word"),
        ),
    )


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _repeated_words(windows: str) -> Column:
    """Words inside windows that occur twice or more, from the hashes of a text's windows in order.

    Only texts whose hashes aren't all different are sorted. Window starts that share a hash are
    put in order again; each covers its words up to the next such start.
    """
    hashes = F.col(windows)

    def of_sorted(s: Column) -> Column:
        def same(e: Column, k: Column) -> Column:
            return e["h"].eqNullSafe(F.get(s, k - 1)["h"]) | e["h"].eqNullSafe(F.get(s, k + 1)["h"])

        return F.array_sort(F.transform(F.filter(s, same), lambda e: e["i"]))

    def covered(p: Column) -> Column:
        gaps = F.transform(
            p, lambda x, k: F.least(F.lit(REPEAT_WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(REPEAT_WINDOW)))
        )
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def bound(value: Column, body) -> Column:
        """``body`` of the value, which is computed once."""
        return F.transform(F.array(value), body)[0]

    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(hashes) == F.size(F.array_distinct(hashes)), F.lit(0)).otherwise(
        bound(bound(ordered, of_sorted), covered)
    )


def measures(documents: DataFrame) -> DataFrame:
    """``documents`` as ``row, doc_id, words`` and the counts that the plain rules use.

    ``row`` keeps repeated and missing ids apart. NULL has no words, symbols or lines.
    """
    parts = ", ".join(f"words[i + {k}]" for k in range(1, REPEAT_WINDOW))
    text = F.coalesce(F.col("text"), F.lit(""))
    split = documents.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        words_of(F.col("text")).alias("words"),
        F.length(F.regexp_replace(text, NOT_SYMBOLS, "")).alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    windows = F.expr(
        f"transform(slice(words, 1, greatest(size(words) - {REPEAT_WINDOW - 1}, 0)), (w, i) -> xxhash64(w, {parts}))"
    )
    hashed = split.select(
        "row",
        "doc_id",
        "words",
        F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        windows.alias("windows"),
    )
    return hashed.withColumn("n_repeat_words", _repeated_words("windows")).drop("windows")


def log_ratios(documents: DataFrame, trusted: DataFrame, most: int = TRUSTED) -> DataFrame:
    """``bucket, ratio``: log of target over raw probability, for the buckets that the corpus has.

    ``trusted`` has at most ``most`` ids, which bounds its broadcast; all texts count as raw.
    """
    flagged = documents.select("doc_id", words_of(F.col("text")).alias("words")).join(
        F.broadcast(trusted.limit(most).withColumn("target", F.lit(1))), "doc_id", "left"
    )
    counts = saved(
        flagged.select("target", F.explode(_pairs("words")).alias("p"))
        .select("target", _bucket("p.before", "p.word").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count("target").alias("target"))
    )
    raw, target = counts.agg(F.sum("raw"), F.sum("target")).first()
    expected = F.col("raw") * ((target or 0) / max(raw or 0, 1))
    return counts.select("bucket", F.log((F.col("target") + SMOOTHING) / (expected + SMOOTHING)).alias("ratio"))


def judge(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: its counts, ``score`` (mean log ratio), ``base_failed`` and ``kept``.

    A text without words scores 0. Without trusted documents every ratio is 0, and the plain rules
    alone decide. The broadcast table has a row per bucket at most.
    """
    ratios = log_ratios(documents, trusted_ids(labels))
    counts = ["row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    pairs = measures(documents).select(*counts, F.explode_outer(_pairs("words")).alias("p"))
    scored = (
        pairs.select(*counts, _bucket("p.before", "p.word").alias("bucket"))
        .join(F.broadcast(ratios), "bucket", "left")
        .groupBy(*counts)
        .agg(F.coalesce(F.sum("ratio"), F.lit(0.0)).alias("total"))
    )
    score = F.col("total") / F.greatest("n_words", F.lit(1))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * F.lit(100) > F.col("n_words") * F.lit(MOST_REPEATED_PERCENT)
    )
    return scored.select(
        "doc_id",
        *[F.col(c).cast("long").alias(c) for c in counts[2:]],
        score.alias("score"),
        failed.alias("base_failed"),
        (~failed & (score >= threshold)).alias("kept"),
    )
