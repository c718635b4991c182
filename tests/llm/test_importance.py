import random
from collections import Counter

import numpy as np
import pytest
from llm_texts import awkward, documents, space_words, words

from stratalake.llm.importance import BUCKETS, ENVELOPE, TEMPERED, buckets_of, classify, keep_good, kth_largest, trusted_ids
from stratalake.llm.ngrams import BLOCK, WordHashes


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus(seed=2, n=300):
    """Clean texts, and every fifth one with symbols, bars or repeated words."""
    rng = random.Random(seed)
    rows, quality = [], []
    for k in range(n):
        if k % 5:
            text = words(rng, rng.randrange(4, 80), 300)
        else:
            text = rng.choice([
                lambda: " ".join(f"{w}$$$" for w in words(rng, 40, 300).split()),
                lambda: " ".join(f"{w} |" for w in words(rng, 40, 300).split()),
                lambda: " ".join(w for w in words(rng, 10, 300).split() for _ in range(6)),
            ])()
        rows.append((k, text))
        quality.append((k, int(k % 5 > 0), 0))
    return rows, quality


def test_word_hashes_are_functions_of_the_words():
    hashes, of_word, of_end = WordHashes(), {}, {}
    for text in [t or "" for _, t, *_ in awkward()]:
        raw = text.encode()
        got = [(int(a), int(b)) for words, tails in hashes.of(raw) for a, b in zip(words, tails)]
        split = raw.split()
        assert len(got) == len(split)
        for word, (whole, end) in zip(split, got):
            assert of_word.setdefault(word, whole) == whole and of_end.setdefault(word[-2:], end) == end
    assert len(set(of_word.values())) == len(of_word) and len(set(of_end.values())) == len(of_end)


def test_blocks_end_between_words():
    text = (b"word " * (BLOCK // 4)) + b"x" * (BLOCK + 10) + b" end"
    got = [len(words) for words, _ in WordHashes().of(text)]
    assert len(got) > 1 and sum(got) == len(text.split())


def test_a_repeated_word_counts_as_one_mark():
    hashes = WordHashes()
    unigrams = next(buckets_of(hashes, b"a a a b b"))
    assert unigrams[1] == unigrams[2] == unigrams[4] != unigrams[0]


@pytest.mark.parametrize("seed", range(3))
def test_kth_largest(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([rng.gauss(0, 1), rng.gauss(0, 1e6), 5.0, float(rng.randrange(4))]) for _ in range(3000)]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 17, 1500, 2999, 3000):
        assert kth_largest(frame, "x", k) == sorted(values, reverse=True)[k - 1]
    assert kth_largest(frame, "x", 9999) == min(values)
    assert kth_largest(frame, "x", 0) is None


def plain_weights(rows, trusted):
    """Log weights by counting, a text's own n-grams taken out of both models."""
    hashes = WordHashes()
    grams = [[int(b) for g in buckets_of(hashes, (t or "").encode()) for b in g] for _, t in rows]
    raw = Counter(b for gs in grams for b in gs)
    target = Counter(b for (d, _), gs in zip(rows, grams) if d in trusted for b in gs)
    out = []
    for (d, _), gs in zip(rows, grams):
        own, mine = Counter(gs), d in trusted
        share = (sum(target.values()) - len(gs) * mine) / max(1, sum(raw.values()) - len(gs))
        logs = [np.log((target[b] - own[b] * mine + 20.0) / ((raw[b] - own[b]) * share + 20.0)) for b in gs]
        out.append(float(np.mean(logs)) * min(len(gs), TEMPERED) if gs else 0.0)
    return out


def test_weights_against_counting(spark):
    rows, quality = corpus()
    got = {r.doc_id: r for r in classify(documents(spark, rows), labels(spark, quality)).collect()}
    for (d, t), want in zip(rows, plain_weights(rows, {d for d, q, _ in quality if q})):
        assert got[d].log_weight == pytest.approx(want) and got[d].n_grams == 3 * len(space_words(t))
    share = sum(min(1.0, np.exp(r.log_weight + ENVELOPE)) for r in got.values())
    assert sum(r.kept for r in got.values()) == round(share)
    assert min(r.key for r in got.values() if r.kept) > max(r.key for r in got.values() if not r.kept)
    for d, q, _ in quality:
        assert got[d].kept == bool(q)


@pytest.mark.parametrize("n", [150, 600])
def test_clean_texts_without_a_label_stay(spark, n):
    """Whether a clean text is in the trusted sample makes no difference, however small the corpus."""
    rows, quality = corpus(7, n)
    some = [(d, q, t) for d, q, t in quality if d % 3 == 0]
    kept = {r.doc_id for r in classify(documents(spark, rows), labels(spark, some)).where("kept").collect()}
    good = {d for d, q, _ in quality if q}
    assert good <= kept
    assert len(kept - good) <= 0.02 * n


def test_top_k_and_kept_rows(spark):
    rows, quality = corpus(3)
    docs, marks = documents(spark, rows), labels(spark, quality)
    found = classify(docs, marks, 100).where("kept")
    kept = keep_good(docs, marks, 100)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert len(ids) == 100 and ids == {r.doc_id for r in found.select("doc_id").collect()}
    assert keep_good(docs, marks, 0).count() == 0


def test_awkward_and_empty(spark):
    rows = awkward()
    none = labels(spark, [])
    got = classify(documents(spark, rows), none).collect()
    assert len(got) == len(rows) and all(r.log_weight == 0 and r.kept for r in got)
    some = labels(spark, [(1, 1, 0), (13, 1, 0), (13, 1, 0), (14, 0, None), (None, 1, 0), (6, None, 0)])
    assert classify(documents(spark, rows), some).count() == len(rows)
    assert trusted_ids(some).count() == 2
    assert classify(documents(spark, []), some).count() == 0
    assert keep_good(documents(spark, []), some).count() == 0
    assert all(0 <= b < BUCKETS for grams in buckets_of(WordHashes(), b"x y z") for b in grams)
