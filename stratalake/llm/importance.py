"""Quality classifier by importance resampling.

Two generative models of hashed n-grams, of trusted target texts and of all raw texts, give every
document the log of its importance weight; documents are drawn without replacement in proportion
to the weights by Gumbel top-k. N-grams: words, pairs of words and word endings; a word that
repeats its predecessor counts as one special word.

A document's own n-grams are taken out of both models before it is weighed: else those that only it
has would speak for it where it is trusted and against it elsewhere, the more the smaller the
corpus. The weight is that of an average stretch of ``TEMPERED`` n-grams, or of the whole text if it
is shorter, so that long texts are not drawn for their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import TRUSTED, free_name, saved, trusted_ids
from stratalake.llm.ngrams import WordHashes, mixed

BUCKETS = 1 << 13
#: Pseudo-count, in n-grams of the target sample; buckets with fewer say little.
SMOOTHING = 20.0
SEED = 7
#: N-grams that a weight stands for, at most.
TEMPERED = 100
#: Log of the envelope of the accept-reject step that fixes how many documents are drawn: those whose
#: weight is above its inverse count in full. Junk lies far below; clean texts lie around 0, those of
#: a language with few trusted texts in a small corpus down to -12.
ENVELOPE = 14.0
#: Values of the k-th key's interval that are told apart on the driver.
LAST_KEYS = 1000

_TRUSTED = "__trusted"
_REPEATED = np.uint64(0x5851F42D4C957F2D)


def buckets_of(hashes: WordHashes, text: bytes) -> Iterator[np.ndarray]:
    """Buckets of a text's n-grams: words, pairs, endings; three per word."""
    previous = np.zeros(1, np.uint64)
    for words, tails in hashes.of(text):
        before = np.concatenate((previous, words[:-1])) if len(words) else words
        marked = np.where(words == before, _REPEATED, words)
        pairs = mixed(before * np.uint64(3) + marked)
        for grams in (marked, pairs, tails):
            yield (grams >> np.uint64(11)).astype(np.int64) % BUCKETS
        if len(words):
            previous = words[-1:]


def _own_counts(hashes: WordHashes, text: bytes | None) -> np.ndarray:
    """N-grams of a text by bucket."""
    counts = np.zeros(BUCKETS, np.int64)
    for grams in buckets_of(hashes, text or b""):
        counts += np.bincount(grams, minlength=BUCKETS)
    return counts


def _flagged(documents: DataFrame, trusted: DataFrame, most: int) -> DataFrame:
    """``documents`` with whether they are trusted; ``trusted`` has at most ``most`` ids, which bounds its broadcast."""
    flag = free_name(_TRUSTED, documents.columns)
    ids = F.broadcast(trusted.limit(most).withColumn(flag, F.lit(True)))
    flagged = documents.join(ids, "doc_id", "left")
    return flagged.select(*[F.col(f"`{c}`") for c in documents.columns], F.coalesce(flag, F.lit(False)).alias(flag))


def models(documents: DataFrame, trusted: DataFrame, most: int = TRUSTED) -> dict[str, np.ndarray]:
    """Counts of ``raw`` and ``target`` n-grams by bucket, over all documents and over the trusted."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = WordHashes(), np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            flags = batch.column(_TRUSTED).to_pylist()
            for text, trusted in zip(batch.column("text").cast(pa.binary()), flags):
                own = _own_counts(hashes, text.as_py())
                counts[0] += own
                if trusted:
                    counts[1] += own
        used = np.flatnonzero(counts[0])
        columns = [pa.array(used), pa.array(counts[0, used]), pa.array(counts[1, used])]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "raw", "target"])

    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = (
        _flagged(texts, trusted, most)
        .mapInArrow(of_batches, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .collect()
    )
    found = {"raw": np.zeros(BUCKETS, np.int64), "target": np.zeros(BUCKETS, np.int64)}
    for row in rows:
        found["raw"][row.bucket], found["target"][row.bucket] = row.raw, row.target
    return found


def _weigh(
    model: dict[str, np.ndarray], hashes: WordHashes, text: bytes | None, trusted: bool, seed: int
) -> tuple[int, float, float]:
    """N-grams, log weight, and log weight plus Gumbel noise that depends on the text alone."""
    own = _own_counts(hashes, text)
    used = np.flatnonzero(own)
    counts, n, weight = own[used], int(own.sum()), 0.0
    if n:
        raw = np.maximum(model["raw"][used] - counts, 0)
        target = np.maximum(model["target"][used] - counts * trusted, 0)
        share = max(0, int(model["target"].sum()) - n * trusted) / max(1, int(model["raw"].sum()) - n)
        ratios = np.log((target + SMOOTHING) / (raw * share + SMOOTHING))
        weight = float((counts * ratios).sum()) / n * min(n, TEMPERED)
    uniform = ((xxhash.xxh64_intdigest(text or b"", seed) >> 11) + 0.5) / (1 << 53)
    return n, weight, weight - float(np.log(-np.log(uniform)))


def weights(documents: DataFrame, trusted: DataFrame, model: dict[str, np.ndarray], seed: int = SEED) -> DataFrame:
    """``doc_id, n_grams, log_weight, key`` of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [
            documents.schema["doc_id"],
            T.StructField("n_grams", T.LongType()),
            T.StructField("log_weight", T.DoubleType()),
            T.StructField("key", T.DoubleType()),
        ]
    )

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = zip(batch.column("text").cast(pa.binary()), batch.column(_TRUSTED).to_pylist())
            found = [_weigh(shared.value, hashes, text.as_py(), trusted, seed) for text, trusted in rows]
            n, weight, key = zip(*found) if found else ((), (), ())
            columns = [pa.array(n, pa.int64()), pa.array(weight, pa.float64()), pa.array(key, pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema.names)

    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return _flagged(texts, trusted, TRUSTED).mapInArrow(of_batches, schema)


def kth_largest(rows: DataFrame, column: str, k: int) -> float | None:
    """The exact k-th largest value, by counting ever finer intervals; None if k is 0.

    The driver sees at most about a thousand counts a round. More rows than there are return the least.
    """
    if k <= 0:
        return None
    values = rows.select(F.col(column).alias("x")).where("x IS NOT NULL")
    low, high = values.agg(F.min("x"), F.max("x")).first()
    if low is None:
        return None
    while low < high:
        inside = values.where(F.col("x").between(low, high))
        step = (high - low) / LAST_KEYS
        bin_of = F.least(F.lit(LAST_KEYS - 1), F.floor((F.col("x") - low) / step)) if step > 0 else F.lit(0)
        bins = inside.groupBy(bin_of.alias("b")).agg(
            F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
        )
        for row in sorted(bins.collect(), key=lambda r: -r.b):
            if row.n >= k or row.b == 0:
                break
            k -= row.n
        k = min(k, row.n)
        if (low, high) == (row.low, row.high):
            break
        low, high = row.low, row.high
        if k == row.n:
            return low
    return high


def resampled(weighted: DataFrame, k: int | None = None) -> tuple[DataFrame, float | None]:
    """The k documents with the largest keys, and the key they reach.

    ``k`` None: the number that accepting each document with probability
    ``min(1, exp(ENVELOPE) * weight)`` would keep on average, which follows the corpus. Documents
    that tie with the last, such as repeated rows, are drawn with it.
    """
    if k is None:
        share = F.round(F.lit(1e6) * F.exp(F.least(F.col("log_weight") + ENVELOPE, F.lit(0.0)))).cast("long")
        k = round((weighted.agg(F.sum(share)).first()[0] or 0) / 1e6)
    cut = kth_largest(weighted, "key", k)
    return weighted.where(F.lit(False) if cut is None else F.col("key") >= cut), cut


def classify(documents: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """``doc_id, n_grams, log_weight, key, kept`` for every document.

    NULL and texts without words have weight 1 (log 0) and are drawn like any other. Without
    trusted documents every weight is 1.
    """
    trusted = trusted_ids(labels)
    weighted = saved(weights(documents, trusted, models(documents, trusted)))
    _, cut = resampled(weighted, k)
    return weighted.withColumn("kept", F.lit(False) if cut is None else F.col("key") >= cut)


def keep_good(documents: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """The rows of ``documents`` that ``classify`` keeps, with all their columns.

    Keys are computed again beside the rows, which costs less than a join of the texts.
    """
    trusted = trusted_ids(labels)
    model = models(documents, trusted)
    _, cut = resampled(saved(weights(documents, trusted, model)), k)
    if cut is None:
        return documents.where(F.lit(False))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    place, flag = documents.columns.index("text"), len(documents.columns)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = zip(batch.column(place).cast(pa.string()).cast(pa.binary()), batch.column(flag).to_pylist())
            kept = [_weigh(shared.value, hashes, text.as_py(), trusted, SEED)[2] >= cut for text, trusted in rows]
            kept = batch.filter(pa.array(kept, pa.bool_(), size=batch.num_rows))
            yield pa.RecordBatch.from_arrays(kept.columns[:flag], batch.schema.names[:flag])

    return _flagged(documents, trusted, TRUSTED).mapInArrow(of_batches, documents.schema)
