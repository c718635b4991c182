import math
import random
import re
from collections import Counter

import pytest
from test_importance import corpus, labels
from llm_texts import awkward, documents, space_words, words

from stratalake.llm.quality_rules import BUCKETS, THRESHOLD, _bucket, judge


def brute(text):
    text = text or ""
    w = space_words(text)
    lines = [line for line in text.split("\n") if space_words(line)]
    windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
    counts, covered = Counter(windows), set()
    for k, window in enumerate(windows):
        if counts[window] > 1:
            covered.update(range(k, k + 8))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def texts():
    rng = random.Random(9)
    out = [t for _, t, *_ in awkward()]
    for _ in range(60):
        part = words(rng, rng.randrange(6, 14), 4)
        joined = rng.choice([" ", "\n", " \n\t"]).join(rng.choice([part, words(rng, 3, 3)]) for _ in range(rng.randrange(1, 8)))
        out.append(joined + rng.choice(["", " ###", " a|b <c>", "\n\n \n"]))
    return out + ["x " * 40, "a b c d e f g h " * 2, "one\rline\nand\x0bmore"]


def test_counts(spark):
    rows = [(k, t) for k, t in enumerate(texts())]
    got = {r.doc_id: r for r in judge(documents(spark, rows), labels(spark, [])).collect()}
    assert len(got) == len(rows)
    for k, t in rows:
        r = got[k]
        n, *_, repeated = want = brute(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, t
        assert r.base_failed == (n < 20 or 100 * repeated > 30 * n)
        assert r.score == 0 and r.kept == (not r.base_failed)  # nothing is trusted


def test_verdicts(spark):
    rows, quality = corpus()
    got = {r.doc_id: r for r in judge(documents(spark, rows), labels(spark, quality)).collect()}
    assert all(r.kept == (not r.base_failed and r.score >= THRESHOLD) for r in got.values())
    for d, q, _ in quality:
        if not got[d].base_failed:
            assert got[d].kept == bool(q)


def test_scores_against_counting(spark):
    rows, quality = corpus(5)
    trusted = {d for d, q, _ in quality if q}
    pairs = {d: list(zip(["", *t.split()], t.split())) for d, t in rows}
    known = spark.createDataFrame(sorted({p for ps in pairs.values() for p in ps}), "a string, b string")
    bucket = {(r.a, r.b): r.n for r in known.select("a", "b", _bucket("a", "b").alias("n")).collect()}
    assert all(0 <= n < BUCKETS for n in bucket.values())
    raw = Counter(bucket[p] for ps in pairs.values() for p in ps)
    target = Counter(bucket[p] for d, ps in pairs.items() if d in trusted for p in ps)
    ratio = sum(target.values()) / sum(raw.values())
    got = {r.doc_id: r.score for r in judge(documents(spark, rows), labels(spark, quality)).collect()}
    for d, ps in pairs.items():
        logs = [math.log((target[bucket[p]] + 5) / (raw[bucket[p]] * ratio + 5)) for p in ps]
        assert got[d] == pytest.approx(sum(logs) / max(1, len(logs)), abs=1e-9)


def test_a_repeated_word_has_one_mark(spark):
    rows = spark.createDataFrame([("ab", "ab"), ("xab", "xab"), ("xab", "ab"), ("yab", "ab")], "a string, b string")
    same, longer, other, third = [r.n for r in rows.select(_bucket("a", "b").alias("n")).collect()]
    assert same == longer != other == third


def test_awkward_and_empty(spark):
    rows = awkward()
    some = labels(spark, [(6, 1, 0), (6, 1, 0), (13, 1, None), (None, 1, 0), (4, 0, 0)])
    assert judge(documents(spark, rows), some).count() == len(rows)
    assert judge(documents(spark, []), some).count() == 0
    assert judge(documents(spark, []), labels(spark, [])).count() == 0
