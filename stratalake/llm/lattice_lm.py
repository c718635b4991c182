"""LM scoring: the marginal probability of a text over all its subword segmentations.

A text is its words (A-Z lowered, split at white space), each behind the vocabulary's space mark,
and one end. The vocabulary and its scores exist already; they are the prior of a unigram model
over pieces. Expectation-maximisation over the counts of all training words fits the weights, and
a forward recursion in log space sums over every segmentation of a word.

Words are scored once each, not once per occurrence: per-text work is a weighted sum. The most
frequent words (at most ``HOT_WORDS``) are looked up where the text is read; only rows of the
others are shuffled, so no word's rows can crowd one task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from stratalake.llm.common import saved
from stratalake.llm.piece_model import NORMAL, SPACE, UNIGRAM, PieceModel

#: Words looked up in a broadcast table, at most.
HOT_WORDS = 100_000
#: Counts of words fall into this many classes per doubling when the hot ones are chosen.
CLASSES = 16
ROUNDS = 2
#: Weight of the vocabulary's own scores against the corpus, in pieces.
PRIOR_PIECES = 10_000.0
#: Stands for the end of a text among the words; no word contains white space.
END = "\n"
#: Words held back in a task before they are counted out or scored together.
HELD_WORDS = 200_000
SCORED_WORDS = 30_000
SCORED_CHARS = 400_000


@dataclass(frozen=True)
class Lattice:
    """A trie over pieces in sorted arrays, and the natural log of every piece's probability."""

    keys: np.ndarray  # node * len(chars) + char, sorted
    children: np.ndarray
    piece_of: np.ndarray  # by node, -1 where no piece ends
    chars: np.ndarray  # code points, sorted
    single: np.ndarray  # by char: whether it is a piece itself
    longest: int
    logp: np.ndarray  # pieces, then the 256 bytes, then the end of a text
    n_pieces: int



def build_lattice(model: PieceModel) -> Lattice:
    """The lattice of a vocabulary with its own scores as weights.

    A unigram vocabulary's scores are log probabilities. Those of a merge vocabulary are negated
    ranks, read as Zipf's law. Bytes and the end weigh as much as the least of the pieces.
    """
    normal = [(p, s) for p, s, kind in model.pieces if kind == NORMAL and s > -1e8]
    chars = np.array(sorted({ord(c) for p, _ in normal for c in p}), np.int64)
    char_of = {int(c): k for k, c in enumerate(chars)}
    nodes: list[dict[int, int]] = [{}]
    piece_of = [-1]
    for number, (piece, _) in enumerate(normal):
        node = 0
        for c in piece:
            child = nodes[node].setdefault(char_of[ord(c)], len(nodes))
            if child == len(nodes):
                nodes.append({})
                piece_of.append(-1)
            node = child
        piece_of[node] = number
    edges = sorted((node * len(chars) + c, child) for node, out in enumerate(nodes) for c, child in out.items())
    scores = np.array([s for _, s in normal])
    weights = np.exp(scores - scores.max()) if model.kind == UNIGRAM else 1.0 / (2.0 - (scores - scores.max()))
    weights = np.concatenate((weights, np.full(257, weights.min())))
    first = {char_of[ord(p)] for p, _ in normal if len(p) == 1}
    return Lattice(
        keys=np.array([k for k, _ in edges], np.int64),
        children=np.array([v for _, v in edges], np.int64),
        piece_of=np.array(piece_of, np.int64),
        chars=chars,
        single=np.isin(np.arange(len(chars)), list(first)),
        longest=max(len(p) for p, _ in normal),
        logp=np.log(weights / weights.sum()),
        n_pieces=len(normal),
    )


def _arcs(lattice: Lattice, codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray | None]]:
    """Arcs of the words' lattices by begin and end: ``begin, end, words, log weights, pieces``.

    ``codes`` holds one word of equal length a row. A character that is no piece is spelt in bytes;
    its arc has no pieces.
    """
    at = np.searchsorted(lattice.chars, codes)
    at[at == len(lattice.chars)] = 0
    chars = np.where(lattice.chars[at] == codes, at, -1)
    every = np.arange(len(codes))
    for begin in range(codes.shape[1]):
        words, node = every, np.zeros(len(codes), np.int64)
        for end in range(begin + 1, min(codes.shape[1], begin + lattice.longest) + 1):
            char = chars[words, end - 1]
            key = node * len(lattice.chars) + char
            at = np.minimum(np.searchsorted(lattice.keys, key), len(lattice.keys) - 1)
            alive = (lattice.keys[at] == key) & (char >= 0)
            words, node = words[alive], lattice.children[at[alive]]
            if not len(words):
                break
            piece = lattice.piece_of[node]
            whole = piece >= 0
            if whole.any():
                yield begin, end, words[whole], lattice.logp[piece[whole]], piece[whole]
        first = chars[:, begin]
        spelt = np.flatnonzero((first < 0) | ~lattice.single[first])
        if len(spelt):
            points, back = np.unique(codes[spelt, begin], return_inverse=True)
            weights = np.array([lattice.logp[_byte_pieces(lattice, p)].sum() for p in points.tolist()])
            yield begin, begin + 1, spelt, weights[back], None


def _byte_pieces(lattice: Lattice, point: int) -> list[int]:
    return [lattice.n_pieces + b for b in chr(point).encode()]


def _by_length(words: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Positions and code points of words of one length, space mark included."""
    order = sorted(range(len(words)), key=lambda k: len(words[k]))
    at = 0
    while at < len(order):
        length, end = len(words[order[at]]), at
        most = at + max(1, SCORED_CHARS // (length + 1))
        while end < len(order) and end < most and len(words[order[end]]) == length:
            end += 1
        chosen = order[at:end]
        text = "".join(SPACE + words[k] for k in chosen)
        yield chosen, np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64).reshape(-1, length + 1)
        at = end


def log_marginals(lattice: Lattice, words: list[str]) -> np.ndarray:
    """Natural log of each word's probability, summed over all its segmentations."""
    out = np.zeros(len(words))
    for chosen, codes in _by_length(words):
        forward = np.full((len(codes), codes.shape[1] + 1), -np.inf)
        forward[:, 0] = 0.0
        for begin, end, rows, weights, _ in _arcs(lattice, codes):
            forward[rows, end] = np.logaddexp(forward[rows, end], forward[rows, begin] + weights)
        out[chosen] = forward[:, -1]
    return out


def expected_pieces(lattice: Lattice, words: list[str], counts: np.ndarray) -> np.ndarray:
    """How often each piece (and byte) is expected in so many of the words."""
    expected = np.zeros(len(lattice.logp))
    for chosen, codes in _by_length(words):
        shape = (len(codes), codes.shape[1] + 1)
        forward, backward = np.full(shape, -np.inf), np.full(shape, -np.inf)
        forward[:, 0], backward[:, -1] = 0.0, 0.0
        arcs = list(_arcs(lattice, codes))
        for begin, end, rows, weights, _ in arcs:
            forward[rows, end] = np.logaddexp(forward[rows, end], forward[rows, begin] + weights)
        times = counts[chosen]
        for begin, end, rows, weights, pieces in reversed(arcs):
            onward = weights + backward[rows, end]
            backward[rows, begin] = np.logaddexp(backward[rows, begin], onward)
            share = times[rows] * np.exp(forward[rows, begin] + onward - forward[rows, -1])
            if pieces is not None:
                expected += np.bincount(pieces, share, len(expected))
            else:
                for point, part in zip(codes[rows, begin].tolist(), share.tolist()):
                    np.add.at(expected, _byte_pieces(lattice, point), part)
    return expected


def _split(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def word_counts(documents: DataFrame, training: str) -> DataFrame:
    """``word, c``: every word of every text and ``END``, and its count in training rows (0: none there)."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            words = pa.array(list(held.keys()), pa.binary()).cast(pa.string())
            counts = pa.array(list(held.values()), pa.int64())
            held.clear()
            return pa.RecordBatch.from_arrays([words, counts], ["word", "c"])

        for batch in batches:
            for text, training in zip(batch.column("text").cast(pa.binary()), batch.column("training").to_pylist()):
                words = _split(text.as_py())
                words.append(END.encode())
                for word, n in Counter(words).items():
                    held[word] = held.get(word, 0) + (n if training else 0)
                if len(held) >= HELD_WORDS:
                    yield out()
        if held:
            yield out()

    texts = documents.select(F.col("text").cast("string").alias("text"), F.expr(training).alias("training"))
    return texts.mapInArrow(of_batches, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray]]:
    words: list[str] = []
    counts: list[int] = []
    for batch in batches:
        words += batch.column("word").to_pylist()
        counts += batch.column("c").to_pylist()
        if len(words) >= SCORED_WORDS:
            yield words, np.array(counts, float)
            words, counts = [], []
    if words:
        yield words, np.array(counts, float)


def fit(lattice: Lattice, counts: DataFrame, ends: int, rounds: int = ROUNDS) -> Lattice:
    """Weights after some rounds of expectation-maximisation over all counted words.

    The driver receives one number per piece and round, so many as the vocabulary has.
    """
    prior = np.exp(lattice.logp) * PRIOR_PIECES
    for _ in range(rounds):
        current = counts.sparkSession.sparkContext.broadcast(vars(lattice))

        def of_batches(batches: Iterator[pa.RecordBatch], current=current) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(**current.value)
            total = np.zeros(len(lattice.logp))
            for words, times in _grouped(batches):
                total += expected_pieces(lattice, words, times)
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["piece", "n"])

        rows = (
            counts.where(f"c > 0 AND word != '{END}'")
            .select("word", "c")
            .mapInArrow(of_batches, "piece long, n double")
            .groupBy("piece")
            .agg(F.sum("n").alias("n"))
            .collect()
        )
        expected = prior.copy()
        for row in rows:
            expected[row.piece] += row.n
        expected[-1] += ends
        lattice = replace(lattice, logp=np.log(expected / expected.sum()))
    return lattice


def _hot(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent words, by classes of counts; never more than ``most``."""
    with_class = counts.where("c > 0").withColumn("class", F.floor(F.log2("c") * CLASSES))
    classes = sorted(with_class.groupBy("class").count().collect(), reverse=True)
    taken, lowest = 0, None
    for row in classes:
        taken += row["count"]
        if taken > most:
            break
        lowest = row["class"]
    return with_class.where(F.lit(False) if lowest is None else F.col("class") >= lowest).drop("class")


def score(
    documents: DataFrame, model: PieceModel, training: str, rounds: int = ROUNDS, hot_words: int = HOT_WORDS
) -> DataFrame:
    """One row per document: word-level base and marginal subword log10 probability.

    ``training`` is an SQL condition on ``documents``; rows that meet it are learnt from, a row for
    which it is NULL isn't. Returns ``doc_id, training, n_tokens, n_known, train_tokens,
    base_score, score``. NULL and empty texts consist of their end alone. Repeated rows are scored
    and, if they are training rows, counted each time.
    """
    spark = documents.sparkSession
    training = f"coalesce({training}, false)"
    counts = saved(word_counts(documents, training))
    totals = counts.agg(
        F.sum("c").alias("n"),
        F.count(F.when(F.col("c") > 0, 1)).alias("v"),
        F.sum(F.when(F.col("word") == END, F.col("c"))).alias("ends"),
    ).first()
    n_all, n_ends = totals.n or 0, totals.ends or 0
    lattice = fit(build_lattice(model), counts, n_ends, rounds)
    current = spark.sparkContext.broadcast(vars(lattice))
    floor = math.log10(n_all + 0.1 * (totals.v + 1))
    per_nat = 1 / math.log(10)

    def of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(**current.value)
        for words, times in _grouped(batches):
            nats = log_marginals(lattice, [w if w != END else "" for w in words])
            nats[[k for k, w in enumerate(words) if w == END]] = lattice.logp[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words), pa.array(times.astype(np.int64)), pa.array(nats * per_nat)], ["word", "c", "logp"]
            )

    scored = saved(counts.mapInArrow(of_words, "word string, c long, logp double"))
    hot = spark.sparkContext.broadcast(
        {
            r.word.encode(): (1 if r.c else 0, math.log10(r.c + 0.1) - floor, r.logp)
            for r in _hot(scored.where(F.col("word") != END), hot_words).union(scored.where(F.col("word") == END)).collect()
        }
    )

    head = T.StructType(
        [documents.schema["doc_id"]]
        + [T.StructField("training", T.BooleanType()), T.StructField("n_tokens", T.LongType())]
        + [T.StructField("n_known", T.LongType())]
        + [T.StructField(name, T.DoubleType()) for name in ("base", "score")]
    )
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("word", T.StringType()),
            T.StructField("tf", T.LongType()),
            T.StructField("head", head),
        ]
    )

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row with what the hot words contribute, and one for every other word of the text.

        The former's word is a space and the row: no word, and spread evenly by the join.
        """
        known = hot.value
        for batch in batches:
            rows, words, times, heads = [], [], [], []
            columns = [batch.column(c).to_pylist() for c in ("row", "doc_id", "training")]
            for row, doc_id, training, text in zip(*columns, batch.column("text").cast(pa.binary())):
                tokens = _split(text.as_py())
                tokens.append(END.encode())
                n_known, base, marginal = 0, 0.0, 0.0
                for word, n in Counter(tokens).items():
                    if (entry := known.get(word)) is not None:
                        n_known += n * entry[0]
                        base += n * entry[1]
                        marginal += n * entry[2]
                    else:
                        rows.append(row)
                        words.append(word)
                        times.append(n)
                        heads.append(None)
                rows.append(row)
                words.append(b" %d" % row)
                times.append(0)
                heads.append(
                    {
                        "doc_id": doc_id,
                        "training": training,
                        "n_tokens": len(tokens),
                        "n_known": n_known,
                        "base": base,
                        "score": marginal,
                    }
                )
                if len(rows) >= HELD_WORDS:
                    yield batch_of(rows, words, times, heads)
                    rows, words, times, heads = [], [], [], []
            if rows:
                yield batch_of(rows, words, times, heads)

    arrow_head = to_arrow_type(head)

    def batch_of(rows: list, words: list, times: list, heads: list) -> pa.RecordBatch:
        columns = [
            pa.array(rows, pa.int64()),
            pa.array(words, pa.binary()).cast(pa.string()),
            pa.array(times, pa.int64()),
            pa.array(heads, arrow_head),
        ]
        return pa.RecordBatch.from_arrays(columns, ["row", "word", "tf", "head"])

    texts = documents.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.expr(training).alias("training"),
        F.col("text").cast("string").alias("text"),
    )
    known = F.when(F.col("c") > 0, F.col("tf")).otherwise(0)
    return (
        texts.mapInArrow(of_texts, schema)
        .join(scored, "word", "left")
        .groupBy("row")
        .agg(
            *[F.max(f"head.{name}").alias(name) for name in ("doc_id", "training", "n_tokens")],
            *[F.max(f"head.{name}").alias(f"hot_{name}") for name in ("n_known", "base", "score")],
            F.sum(F.when(F.col("tf") > 0, known).otherwise(0)).alias("n_known"),
            F.sum(F.when(F.col("tf") > 0, F.col("tf") * (F.log10(F.col("c") + 0.1) - floor)).otherwise(0.0)).alias("base"),
            F.sum(F.when(F.col("tf") > 0, F.col("tf") * F.col("logp")).otherwise(0.0)).alias("score"),
        )
        .select(
            "doc_id",
            "training",
            "n_tokens",
            (F.col("hot_n_known") + F.col("n_known")).alias("n_known"),
            F.lit(n_all).cast("long").alias("train_tokens"),
            (F.col("hot_base") + F.col("base")).alias("base_score"),
            (F.col("hot_score") + F.col("score")).alias("score"),
        )
    )
