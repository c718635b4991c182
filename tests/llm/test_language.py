import random
from pathlib import Path

import numpy as np
import pytest
from llm_texts import awkward, crc, documents

from stratalake.llm.language import UNKNOWN, features, fit, identify, keep_identified, separate, winner

SF_DIR = "/root/testdata/sf0.01"
ALPHABETS = {"en": "the and of to in", "de": "der und schön zu ein", "fr": "le été de où la", "es": "el año qué los más", "xx": "zzk kkz qqk"}


def speech(lang, rng, n):
    return " ".join(rng.choice(ALPHABETS[lang].split()) for _ in range(n))


def labelled(n=40, seed=1):
    rng = random.Random(seed)
    return [(k, speech(lang, rng, rng.randrange(3, 40)), lang) for k, lang in enumerate(list(ALPHABETS) * n)]


def test_separate_finds_a_margin():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5))
    positive = x @ np.array([1.0, -2.0, 0.5, 0, 0]) + 0.3 > 0
    weights = separate(x, positive, epochs=200, penalty=100.0)
    assert np.mean((x @ weights[:-1] + weights[-1] > 0) == positive) > 0.97


def test_winner_breaks_ties_by_name():
    level = {"names": ["a", "b"], "machines": {("a", "b"): np.zeros(3)}}
    assert winner(level, np.zeros(2)) == ("a", 0.5)
    assert winner({"names": ["a"], "machines": {}}, np.zeros(2)) == ("a", 1.0)


def test_long_texts_are_whole():
    text = b"ab " * 500_000 + b"zzz" * 500_000
    assert abs(np.linalg.norm(features(text)) - 1) < 1e-9
    assert not np.allclose(features(text), features(text[:1_500_000]))


def test_rows(spark):
    rows = labelled() + [(900 + k, *r[1:]) for k, r in enumerate(awkward())]
    docs = documents(spark, rows)
    model = fit(docs.where("doc_id < 900"), "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 != 1")
    got = {r.doc_id: r for r in identify(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    held_out = [r for r in rows if r[0] < 900 and crc(r[0], 3) == 1]
    assert np.mean([got[d].lang_pred == lang for d, _, lang in held_out]) > 0.95
    for d, text, *_ in rows:
        assert (got[d].lang_pred == UNKNOWN) == (text is None or not any(c.isalpha() for c in text))
    kept = keep_identified(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.lang_pred != UNKNOWN for r in got.values())


def test_without_labels(spark):
    docs = documents(spark, [(1, "a text"), (2, None)])
    assert fit(docs, "true") is None
    assert {(r.lang_pred, r.score) for r in identify(docs, None).collect()} == {(UNKNOWN, 0.0)}
    assert identify(documents(spark, []), None).count() == 0


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no sample tables here")
def test_held_out_accuracy(spark):
    from stratalake.llm.queries import QUERIES

    found = QUERIES["op10_language"](spark, SF_DIR).where("held_out")
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98


def test_copies_count_once_and_any_division_gives_one_model(spark):
    """A third of the rows are copies of one text: they neither crowd out other texts nor make the sample a matter of luck."""
    rows = labelled(60)
    rows += [(10_000 + k, "the of the of and to", "en") for k in range(len(rows) // 2)]
    docs = documents(spark, rows)
    models = [fit(docs.repartition(n), "true", most=50) for n in (1, 3, 7)]
    for level in ("family", "within"):
        assert str(models[0][level]) == str(models[1][level]) == str(models[2][level])
    got = {r.doc_id: r.lang_pred for r in identify(docs, models[0]).collect()}
    assert np.mean([got[d] == lang for d, _, lang in rows]) > 0.95
