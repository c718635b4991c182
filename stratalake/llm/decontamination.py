"""Benchmark decontamination: a prefix-filtered containment join of item windows with documents.

An item's window is ``window`` consecutive words of it (a shorter item is one window). Its tokens
are the window's word shingles, ordered by rarity in the corpus. A document holds the window only
if it holds all of them, so the rarest alone is the necessary prefix: only documents with that
shingle become candidates. Positional bound: the shingle's place fixes where the window begins.
Length bound: the window must fit between the first and the last word. What is left is verified by
finding every shingle of the window at its own place, compared as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import KEY, ascii_lower, free_name, row_key, saved, small, with_marks

#: Words of items and documents after lower-casing A-Z: digits, a-z and everything beyond ASCII.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3
#: Shingles of the benchmark that are broadcast (about 100 bytes each); more are joined by a shuffle.
BROADCAST_SHINGLES = 500_000


def item_words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(ITEM_WORD), F.lit(0))


def _shingles(words: str, width: int) -> Column:
    """``struct(pos, shingle)`` for every ``width`` consecutive words of an array column."""
    rest = ", ".join(f"{words}[i + {k}]" for k in range(1, width))
    text = f"concat_ws(' ', w, {rest})" if rest else "w"
    return F.expr(
        f"transform(slice({words}, 1, greatest(size({words}) - {width - 1}, 0)),"
        f" (w, i) -> struct(i AS pos, {text} AS shingle))"
    )


def _windows(benchmark: DataFrame, window: int) -> DataFrame:
    """``item_id, window`` (its text), ``words`` (its length); distinct, items without words have none."""
    items = benchmark.select(F.col("item_id"), item_words(F.col("text")).alias("words")).where("size(words) > 0")
    return (
        items.select(
            "item_id",
            F.explode(
                F.expr(
                    f"transform(sequence(0, greatest(size(words) - {window}, 0)),"
                    f" s -> slice(words, s + 1, {window}))"
                )
            ).alias("words"),
        )
        .select("item_id", F.array_join("words", " ").alias("window"), F.size("words").alias("n"))
        .distinct()
    )


def find_windows(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every occurrence of a benchmark window in a document.

    Returns three frames: ``row, doc_id, n_words`` with one row per document; ``row, start, n,
    window`` with one row per occurrence (``start`` counts words from 0); ``window, item_id``.
    Repeated documents and repeated or missing ids are kept apart by ``row``. NULL and empty texts
    have no words and are in the first frame only. A shingle that a third of the documents share
    makes as many rows as it has occurrences, spread as the documents are; nothing is paired.
    """
    items = saved(_windows(benchmark, window))
    texts = items.select("window", "n").distinct()
    parts = texts.withColumn("words", F.split("window", " "))
    parts = [
        parts.where(F.col("n") >= shingle if width == shingle else F.col("n") == width)
        .select("window", "n", F.explode(_shingles("words", width)).alias("s"))
        .select("window", "n", F.col("s.pos").alias("offset"), "s.shingle")
        for width in range(1, shingle + 1)
    ]
    tokens = parts[0]
    for part in parts[1:]:
        tokens = tokens.unionByName(part)
    tokens = saved(tokens)
    known = tokens.select("shingle").distinct().withColumn("known", F.lit(True))
    # What may be broadcast is counted: shingles, windows, and shingles of windows.
    n_known, n_windows, n_tokens = known.count(), texts.count(), tokens.count()
    widths = sorted({shingle} | {r.n for r in texts.where(F.col("n") < shingle).select("n").distinct().collect()})

    # One pass over the texts: a header row per document, and a row per shingle that some item has.
    spread = documents.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", item_words(F.col("text")).alias("words")
    ).select(
        "row",
        "doc_id",
        F.size("words").alias("n_words"),
        F.explode(
            F.concat(
                F.expr("array(struct(-1 AS pos, CAST(NULL AS STRING) AS shingle))"),
                *[_shingles("words", width) for width in widths],
            )
        ).alias("s"),
    )
    found = saved(
        spread.select("row", "doc_id", "n_words", F.col("s.pos").alias("pos"), F.col("s.shingle").alias("shingle"))
        .join(small(known, n_known, BROADCAST_SHINGLES), "shingle", "left")
        .where("pos < 0 OR known")
        .drop("known")
    )
    documents = found.where("pos < 0").select("row", "doc_id", "n_words")
    hits = found.where("pos >= 0").select("row", "n_words", "pos", "shingle")

    # Rarity over all documents; a window with a shingle that never occurs can't occur.
    rarity = hits.groupBy("shingle").agg(F.count("*").alias("rarity"))
    ordered = tokens.join(rarity, "shingle", "left").groupBy("window", "n").agg(
        F.min(F.struct(F.coalesce("rarity", F.lit(0)).alias("rarity"), "offset", "shingle")).alias("p"),
        F.count("*").alias("n_tokens"),
    )
    prefix = ordered.where("p.rarity > 0").select("window", "n", "n_tokens", "p.shingle", "p.offset")
    candidates = (
        hits.join(small(prefix, n_windows, BROADCAST_SHINGLES), "shingle")
        .withColumn("start", F.col("pos") - F.col("offset"))
        .where("start >= 0 AND start + n <= n_words")
        .select("row", "start", "n", "window", "n_tokens")
    )
    wanted = candidates.join(
        small(tokens.select("window", "offset", "shingle"), n_tokens, BROADCAST_SHINGLES), "window"
    ).select("row", (F.col("start") + F.col("offset")).alias("pos"), "shingle", "start", "n", "window", "n_tokens")
    verified = (
        wanted.join(hits.select("row", "pos", "shingle"), ["row", "pos", "shingle"])
        .groupBy("row", "start", "n", "window", "n_tokens")
        .agg(F.count("*").alias("held"))
        .where("held = n_tokens")
    )
    return documents, verified.select("row", "start", "n", "window"), items.select("window", "item_id")


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: its words, those inside a benchmark window, and the items found.

    ``doc_id, n_words, n_hit, n_items, item_ids`` (sorted as text). An item without an id counts
    for ``n_hit`` but isn't listed. Documents without words have zeros and an empty list.
    """
    docs, found, items = find_windows(documents, benchmark, window)
    found = saved(found)
    before = Window.partitionBy("row").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        found.groupBy("row", "start")
        .agg(F.max("n").alias("n"))
        .withColumn("end", F.col("start") + F.col("n"))
        .withColumn("reached", F.max("end").over(before))
        .groupBy("row")
        .agg(
            F.sum(
                F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("reached", F.lit(0))))
            ).alias("n_hit")
        )
    )
    listed = (
        found.select("row", "window")
        .distinct()
        .join(items.where("item_id IS NOT NULL"), "window")
        .select("row", F.col("item_id").cast("string").alias("item"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    )
    return (
        docs.join(covered, "row", "left")
        .join(listed, "row", "left")
        .select(
            "doc_id",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("item_ids", F.expr("CAST(array() AS ARRAY<STRING>)")).alias("item_ids"),
        )
    )


def keep_clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``documents`` in which no benchmark window occurs, with all their columns."""
    keyed = documents.select(row_key(documents).alias("doc_id"), "text")
    found = contamination(keyed, benchmark, window).where("n_hit > 0")
    mark = free_name("__found", documents.columns)
    marks = found.select(F.col("doc_id").alias(KEY)).distinct().withColumn(mark, F.lit(True))
    return with_marks(documents, marks).where(f"{mark} IS NULL").drop(mark)
