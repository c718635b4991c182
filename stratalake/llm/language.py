"""Hierarchical language identification.

A text's family is predicted first, then its language among those of the family; both steps are
one-versus-one linear support vector machines over hashed character n-grams of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
#: Closely related languages by family; a language that isn't listed is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is"],
    "romance": ["fr", "es", "it", "pt", "ca", "gl", "ro", "oc"],
    "slavic": ["ru", "uk", "be", "bg", "sr", "hr", "bs", "sl", "mk", "cs", "sk", "pl"],
    "uralic": ["fi", "et", "hu"],
    "indic": ["hi", "mr", "ne", "bn", "gu", "pa"],
    "turkic": ["tr", "az", "kk", "uz"],
}
DIMENSIONS = 1 << 11
#: Labelled rows that are learnt from, at most, in equal shares of the languages.
TRAINING_ROWS = 2000
EPOCHS = 20
PENALTY = 10.0
#: Bytes hashed at once.
BLOCK = 1 << 20


def features(text: bytes) -> np.ndarray:
    """Unit vector of the square roots of hashed byte pair and triple counts; A-Z lowered."""
    counts = np.zeros(DIMENSIONS)
    for at in range(0, len(text), BLOCK):
        block = np.frombuffer(text[at : at + BLOCK + 2].lower(), np.uint8).astype(np.uint32)
        pairs = block[:-1] * np.uint32(256) + block[1:]
        triples = pairs[:-1] * np.uint32(256) + block[2:]
        for grams, odd in ((pairs[:BLOCK], 2654435761), (triples[:BLOCK], 2246822519)):
            hashed = (grams * np.uint32(odd)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1)
            counts += np.bincount(hashed, minlength=DIMENSIONS)
    vector = np.sqrt(counts)
    return vector / max(np.linalg.norm(vector), 1e-12)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def separate(x: np.ndarray, positive: np.ndarray, epochs: int = EPOCHS, penalty: float = PENALTY) -> np.ndarray:
    """Weights of a linear support vector machine, by dual coordinate descent; the last is the bias."""
    sign = np.where(positive, 1.0, -1.0)
    squares, alpha, weights, bias = (x * x).sum(axis=1) + 1.0, np.zeros(len(x)), np.zeros(x.shape[1], x.dtype), 0.0
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for k in order.permutation(len(x)):
            gradient = sign[k] * (x[k] @ weights + bias) - 1.0
            change = min(max(alpha[k] - gradient / squares[k], 0.0), penalty) - alpha[k]
            if change:
                alpha[k] += change
                weights += x.dtype.type(change * sign[k]) * x[k]
                bias += change * sign[k]
    return np.append(weights, x.dtype.type(bias))


def duels(x: np.ndarray, names: np.ndarray) -> dict:
    """One machine for each two of the names; positive stands for the first."""
    found, machines = sorted(set(names.tolist())), {}
    for a, b in combinations(found, 2):
        chosen = (names == a) | (names == b)
        machines[a, b] = separate(x[chosen], names[chosen] == a)
    return {"names": found, "machines": machines}


def winner(level: dict, x: np.ndarray) -> tuple[str, float]:
    """The name with most duels won, ties by total margin, then by name; its mean confidence, 0 to 1."""
    won, total = dict.fromkeys(level["names"], 0), dict.fromkeys(level["names"], 0.0)
    sure: dict[str, list[float]] = {name: [] for name in level["names"]}
    for (a, b), weights in level["machines"].items():
        margin = float(x @ weights[:-1] + weights[-1])
        won[a if margin >= 0 else b] += 1
        for name, m in ((a, margin), (b, -margin)):
            total[name] += m
            sure[name].append(1 / (1 + np.exp(-4.0 * m)))
    best = min(level["names"], key=lambda name: (-won[name], -total[name], name))
    return best, float(np.mean(sure[best])) if sure[best] else 1.0


def family_of(families: dict[str, list[str]], lang: str) -> str:
    return next((family for family, members in families.items() if lang in members), lang)


def fit(documents: DataFrame, training: str, families: dict = FAMILIES, most: int = TRAINING_ROWS) -> dict | None:
    """A model from ``text`` and non-null ``lang`` of rows that meet ``training``; None without any.

    Different texts are drawn by their hash, so copies count once and the same texts are drawn
    however rows are divided; a language with few texts gives all of them.
    """
    rows = documents.where(F.expr(f"({training}) AND lang IS NOT NULL AND text IS NOT NULL"))
    rows = rows.select("lang", F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("h"))
    sizes = {r.lang: r["count"] for r in rows.select("lang", "h").distinct().groupBy("lang").count().collect()}
    if not sizes:
        return None
    share = max(1, most * 4 // 5 // len(sizes))  # a fifth spared, since a share is drawn by chance
    chance = F.create_map(*[F.lit(v) for lang, n in sizes.items() for v in (lang, min(1.0, share / n))])
    drawn = F.pmod(F.col("h"), F.lit(1 << 20)) < chance[F.col("lang")] * (1 << 20)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array([has_letter(t) for t in batch.column("text").to_pylist()], pa.bool_()))
            packed = [features(t.encode()).astype(np.float32).tobytes() for t in batch.column("text").to_pylist()]
            columns = [batch.column("lang"), batch.column("h"), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "h", "x"])

    sample = rows.where(drawn).dropDuplicates(["lang", "h"]).mapInArrow(of_batches, "lang string, h long, x binary")
    found = sample.orderBy("h", "lang").limit(most).select("lang", "x").collect()
    if not found:
        return None
    found.sort()
    x = np.frombuffer(b"".join(r.x for r in found), np.float32).reshape(len(found), DIMENSIONS)
    langs = np.array([r.lang for r in found])
    groups = np.array([family_of(families, lang) for lang in langs])
    return {
        "family": duels(x, groups),
        "within": {g: duels(x[groups == g], langs[groups == g]) for g in sorted(set(groups.tolist()))},
    }


def predict(model: dict | None, text: str | None) -> tuple[str, float]:
    """``language, score``; texts without a letter, and all without a model, are unknown with score 0."""
    if model is None or not has_letter(text):
        return UNKNOWN, 0.0
    x = features(text.encode())
    family, sure = winner(model["family"], x)
    lang, surer = winner(model["within"][family], x)
    return lang, sure * surer


def identify(documents: DataFrame, model: dict | None) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row; only ``text`` is looked at."""
    schema = T.StructType(
        [
            documents.schema["doc_id"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    current = documents.sparkSession.sparkContext.broadcast(model)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predict(current.value, t.as_py()) for t in batch.column("text")]
            langs, scores = zip(*found) if found else ((), ())
            columns = [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(of_batches, schema)


def keep_identified(documents: DataFrame, model: dict | None) -> DataFrame:
    """The rows whose language is predicted, with all their columns; the unknown go."""
    current = documents.sparkSession.sparkContext.broadcast(model)
    place = documents.columns.index("text")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [predict(current.value, t.as_py())[0] != UNKNOWN for t in batch.column(place).cast(pa.string())]
            yield batch.filter(pa.array(kept, pa.bool_(), size=batch.num_rows))

    return documents.mapInArrow(of_batches, documents.schema)
