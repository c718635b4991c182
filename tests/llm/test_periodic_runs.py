import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_texts import awkward, documents, space_words, words

from stratalake.llm.periodic_runs import PRIMES, _occurrences, find, runs
from stratalake.llm.queries import QUERIES


def brute_runs(w):
    """Start, length, period of every run, by trying every period at every word."""
    n, found = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            smallest = not any(all(w[k] == w[k + e] for k in range(i, j + q - e)) for e in range(1, q))
            if j + q - i >= max(6, 4 * q) and smallest:
                found.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(w, found):
    dropped = {k for s, length, q in found for k in range(s + q, s + length)}
    return " ".join(x for k, x in enumerate(w) if k not in dropped)


def looped(doc_id, w):
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_runs_of_random_texts():
    rng = random.Random(3)
    for _ in range(300):
        texts = []
        for _ in range(rng.randrange(1, 4)):
            n, v = rng.randrange(120), rng.choice([1, 2, 3, 40])
            w = [rng.randrange(v) for _ in range(n)]
            if n and rng.random() < 0.7:
                a, p = rng.randrange(n), rng.randrange(1, n // 3 + 2)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
                if rng.random() < 0.5:
                    w[rng.randrange(n)] = 99
            texts.append(w)
        flat = np.array([x for w in texts for x in w], np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(w) for w in texts])
        want, before = [], 0
        for w in texts:
            want += [(s + before, length, q) for s, length, q in brute_runs(w)]
            before += len(w)
        assert [tuple(r) for r in runs(flat, owner).tolist()] == want


@pytest.mark.parametrize("size", [1, 2, 8, 64])
def test_convolution_finds_every_occurrence(size):
    rng = np.random.default_rng(size)
    codes = np.tile(rng.integers(0, 3, 3 * size), 4)[: 10 * size]
    blocks = np.arange(0, len(codes) - size + 1, size)
    want = [
        (s, d)
        for s in blocks
        for d in range(size, 2 * size)
        if s + d + size <= len(codes) and (codes[s : s + size] == codes[s + d : s + d + size]).all()
    ]
    assert sorted(map(tuple, _occurrences(codes, blocks, size).tolist())) == want


@pytest.mark.parametrize("prime, generator", PRIMES)
def test_roots_of_the_largest_transform(prime, generator):
    assert all(prime % d for d in range(2, int(prime**0.5) + 1))
    assert pow(generator, (prime - 1) // 2, prime) == prime - 1 and (prime - 1) % (1 << 25) == 0


def test_long_texts_with_nothing_but_repetition():
    w = np.zeros(200_000, np.int64)
    assert runs(w, w).tolist() == [[0, 200_000, 1]]
    w[5::6] = 1
    assert runs(w, np.zeros_like(w)).tolist() == [[0, 200_000, 6]]


def sample(rng):
    phrase = words(rng, 7, 1000)
    rows = [*awkward(), (20, "a a a a a"), (21, "a a a a a a"), (22, "x y \x0b a\tb\x1cc " * 9), (23, None)]
    rows += [(30, f"{words(rng, 40, 9)} {' '.join([phrase] * 6)} {words(rng, 30)}"), (31, "ab " * 20_000)]
    return rows + [(k, words(rng, rng.randrange(1, 90), 30)) for k in range(100, 260)]


def test_find(spark):
    rows = sample(random.Random(11))
    got = find(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    want = []
    for doc_id, text, *_ in rows:
        w = space_words(text)
        found = brute_runs(w) if len(w) < 2000 else [(0, 20_000, 1)] if doc_id == 31 else []
        want.append((doc_id, len(w), found, brute_collapsed(w, found)))
    assert sorted(((r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in got), key=str) == sorted(want, key=str)


def test_query(spark, tmp_path):
    rows = [r for r in sample(random.Random(12)) if len(space_words(r[1])) < 2000]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for doc_id, text, *_ in rows:
        w = looped(doc_id, space_words(text))
        found = brute_runs(w)
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        want.append((doc_id, len(found), *best, milli, sha(listed), sha(brute_collapsed(w, found))))
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path)).drop("n_words").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(r[1] for r in want) > 5


def test_empty_table(spark):
    assert find(documents(spark, [])).collect() == []
