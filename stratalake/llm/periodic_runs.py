"""Periodic runs: stretches of words that repeat with one period four times or more.

The words of a portion of texts become integers, different ones in different texts, in one array. At
every scale B = 1, 2, 4, .. the array is cut into blocks of B words. A run of a period q with
B <= q < 2 B holds two neighbouring blocks that occur again q words on. So each block is compared with
the window of 2 B words behind it: the sum of squared differences at every distance comes from one
convolution, an integer number theoretic transform modulo two primes, and is zero where the block
occurs. Such distances are seeds, extended word by word to both sides; the words decide.

Blocks that cannot occur in their window are left out before: one with a word that does not come back
within 2 B words, and one that, with its window, lies in a run of a smaller period (by the theorem of
Fine and Wilf no longer smallest period can be found there).

A NULL or blank text has no words and no runs; texts of any length are handled whole, in memory
proportional to the text. Texts are handled by themselves: repeated rows and rows without an id give
a row each, an empty table gives none. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: A run has at least this many words, and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4

#: Primes with a generator of their units; each has roots of unity for transforms of up to 2**25 places.
PRIMES = ((2013265921, 31), (2113929217, 5))
#: Words in transforms at a time, windows included.
AT_ONCE = 1 << 18
#: Words of texts handled together; a longer text is handled by itself.
PORTION = 1 << 18

RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
_RUNS_ARROW = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def find(documents: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row.

    ``runs`` are by start, then period; ``collapsed`` has the words, joined by one space, that no run
    contains after its first period.
    """
    schema = T.StructType(
        [
            documents.schema["doc_id"],
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", RUNS),
            T.StructField("collapsed", T.StringType()),
        ]
    )

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            # Half of its bytes is the most words that a text can have.
            most = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) // 2 + 1)
            begin = 0
            while begin < batch.num_rows:
                before = most[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(most, before + PORTION, side="right")))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(begin, end - begin), *_of_texts(texts.slice(begin, end - begin))], schema.names
                )
                begin = end

    return documents.select("doc_id", "text").mapInArrow(of_batches, schema)


def _of_texts(texts: pa.Array) -> list[pa.Array]:
    """Number of words, runs and collapsed text of each text."""
    # Bytes split without an argument are cut at the six ASCII white space characters.
    words = [text.split() if text else [] for text in texts.cast(pa.binary()).to_pylist()]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    flat = pa.array([w for of_text in words for w in of_text], pa.binary())
    text_of = np.repeat(np.arange(len(words)), sizes)
    found = runs(flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64), text_of)
    owner = text_of[found[:, 0]]
    drop = np.zeros(len(flat) + 1, np.int64)
    np.add.at(drop, found[:, 0] + found[:, 2], 1)
    np.add.at(drop, found[:, 0] + found[:, 1], -1)
    dropped = np.cumsum(drop[:-1]) > 0
    collapsed = []
    touched = set(owner.tolist())
    for k, of_text in enumerate(words):
        if k in touched:
            gone = dropped[bounds[k] : bounds[k + 1]].tolist()
            of_text = [w for w, g in zip(of_text, gone) if not g]
        collapsed.append(b" ".join(of_text))
    starts = found[:, 0] - bounds[owner]
    columns = [pa.array(c, pa.int64()) for c in (starts, found[:, 1], found[:, 2])]
    values = pa.StructArray.from_arrays(columns, ["start", "length", "period"])
    offsets = np.searchsorted(owner, np.arange(len(words) + 1)).astype(np.int32)
    listed = pa.ListArray.from_arrays(pa.array(offsets), values).cast(_RUNS_ARROW)
    return [pa.array(sizes, pa.int64()), listed, pa.array(collapsed, pa.binary()).cast(pa.string())]


def runs(words: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Rows of start, length and period, by start and period, in the given numbering of words.

    ``words`` are integers, equal for equal words; ``text_of`` is the text of each, ascending.
    """
    n = len(words)
    if not n:
        return np.empty((0, 3), np.int64)
    word = words + text_of * (int(words.max()) + 1)
    order = np.argsort(word, kind="stable")
    same = word[order[1:]] == word[order[:-1]]
    codes = np.zeros(n, np.int64)  # equal only for equal words of one text
    codes[order[1:]] = np.cumsum(~same)
    again = np.full(n, n, np.int64)  # distance to the word's next occurrence
    again[order[:-1][same]] = np.diff(order)[same]
    longest = int(np.bincount(text_of).max())
    covered = np.zeros(n, np.int64)  # end of the longest run so far that a word is in
    found: list[tuple[int, int, int]] = []
    most, size = again, 1  # within each block, the largest distance to a next occurrence
    while LEAST_PERIODS * size <= longest:
        blocks = _possible(most, size, covered, n)
        seeds = _occurrences(codes, blocks, size)
        found += _extended(codes, seeds, size, found, covered)
        most = np.maximum(most[: len(most) // 2 * 2 : 2], most[1::2])
        size *= 2
    return np.array(sorted(found), np.int64).reshape(-1, 3)[:, [0, 2, 1]]


def _possible(most: np.ndarray, size: int, covered: np.ndarray, n: int) -> np.ndarray:
    """Starts of neighbouring blocks that may lie in a run of this scale."""
    back = most[: n // size] < 2 * size
    first = np.flatnonzero(back[:-1] & back[1:]) * size
    first = first[covered[first] < first + 3 * size]
    return np.union1d(first, first + size)


def _occurrences(codes: np.ndarray, blocks: np.ndarray, size: int) -> np.ndarray:
    """Pairs of a block's start and a distance in ``size .. 2 * size - 1`` at which it occurs again."""
    found = []
    rows = max(1, AT_ONCE // (2 * size))
    window = np.arange(2 * size)
    top = int(codes.max()) + 1
    for begin in range(0, len(blocks), rows):
        starts = blocks[begin : begin + rows]
        # Behind the end stands a number that no word has.
        at = starts[:, None] + size + window
        behind = np.where(at < len(codes), codes[np.minimum(at, len(codes) - 1)], top)
        block = codes[starts[:, None] + window[:size]]
        zero = np.ones((len(starts), size), bool)
        for prime, generator in PRIMES:
            zero &= _squared_differences(block, behind, size, prime, generator) == 0
        row, distance = np.nonzero(zero)
        found.append(np.stack([starts[row], distance + size], axis=1))
    return np.concatenate(found) if found else np.empty((0, 2), np.int64)


def _squared_differences(block: np.ndarray, behind: np.ndarray, size: int, prime: int, generator: int) -> np.ndarray:
    """Sum over a block of squared differences from each of ``size`` places of its window, modulo a prime."""
    p = np.uint64(prime)
    x, y = block.astype(np.uint64) % p, behind.astype(np.uint64) % p
    squares = np.cumsum(np.pad(y * y % p, ((0, 0), (1, 0))), axis=1)  # below 2**31 each, at most 2**26 of them
    own = (x * x % p).sum(axis=1, keepdims=True)
    sums = (own + squares[:, size : 2 * size] - squares[:, :size]) % p
    # Correlation as a cyclic convolution with the block reversed; the places read do not wrap around.
    reverse = np.zeros_like(y)
    reverse[:, 0] = x[:, 0]
    reverse[:, size + 1 :] = x[:, :0:-1]
    roots = _roots(2 * size, prime, generator)
    product = _transform(reverse, roots, p) * _transform(y, roots, p) % p
    back = _transform_back(product, _roots(2 * size, prime, pow(generator, -1, prime)), p)[:, :size]
    cross = back * np.uint64(pow(2 * size, -1, prime)) % p
    return (sums + 2 * (p - cross)) % p


_ROOTS: dict[tuple[int, int], np.ndarray] = {}


def _roots(n: int, prime: int, generator: int) -> np.ndarray:
    """The first half of the powers of an ``n``-th root of unity."""
    if (n, generator) not in _ROOTS:
        root, powers = pow(generator, (prime - 1) // n, prime), np.ones(1, np.uint64)
        while len(powers) < n // 2:
            step = np.uint64(pow(root, len(powers), prime))
            powers = np.concatenate([powers, powers * step % np.uint64(prime)])
        _ROOTS[n, generator] = powers
    return _ROOTS[n, generator]


def _transform(values: np.ndarray, roots: np.ndarray, p: np.uint64) -> np.ndarray:
    """Number theoretic transform of each row, in bit-reversed order."""
    rows, n = values.shape
    half = n // 2
    while half:
        parts = values.reshape(rows, -1, 2, half)
        low, high = parts[:, :, 0], parts[:, :, 1]
        out = np.empty_like(parts)
        out[:, :, 0] = (low + high) % p
        out[:, :, 1] = (low + p - high) % p * roots[:: n // (2 * half)] % p
        values, half = out.reshape(rows, n), half // 2
    return values


def _transform_back(values: np.ndarray, roots: np.ndarray, p: np.uint64) -> np.ndarray:
    """From bit-reversed order to the usual one, with inverse roots, times the number of places."""
    rows, n = values.shape
    half = 1
    while half < n:
        parts = values.reshape(rows, -1, 2, half)
        low, high = parts[:, :, 0], parts[:, :, 1] * roots[:: n // (2 * half)] % p
        out = np.empty_like(parts)
        out[:, :, 0] = (low + high) % p
        out[:, :, 1] = (low + p - high) % p
        values, half = out.reshape(rows, n), half * 2
    return values


def _extended(
    codes: np.ndarray, seeds: np.ndarray, size: int, smaller: list[tuple[int, int, int]], covered: np.ndarray
) -> list[tuple[int, int, int]]:
    """Runs (start, period, length) that the seeds lie in; ``covered`` learns of them."""
    order = np.lexsort((seeds[:, 0], seeds[:, 1]))
    # Two neighbouring blocks at one distance, as every run has; the second is the next seed or none.
    start, distance = seeds[order, 0], seeds[order, 1]
    pair = (start[1:] == start[:-1] + size) & (distance[1:] == distance[:-1])
    found, ends = [], {}
    for s, d in zip(start[:-1][pair].tolist(), distance[:-1][pair].tolist()):
        if s + d < ends.get(d, 0):
            continue  # in the stretch just extended
        right = s + d + _agreeing(codes[s:-d], codes[s + d :])
        left = s - _agreeing(codes[:s][::-1], codes[d : s + d][::-1])
        ends[d] = right
        length = right - left
        if length >= max(LEAST_WORDS, LEAST_PERIODS * d):
            found.append((left, d, length))
    # A stretch with a smaller period lies in a run of that period, found before.
    found = [run for run in found if covered[run[0]] < run[0] + run[2] or not _inside(run, smaller)]
    for left, _, length in found:
        part = covered[left : left + length]
        np.maximum(part, left + length, out=part)
    return found


def _inside(run: tuple[int, int, int], smaller: list[tuple[int, int, int]]) -> bool:
    return any(s <= run[0] and run[0] + run[2] <= s + n and run[1] % q == 0 for s, q, n in smaller)


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common beginning."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = np.flatnonzero(a[at : min(n, at + step)] != b[at : min(n, at + step)])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 4
    return n
