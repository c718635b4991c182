"""The pipeline's rows against a plain version of its stages, on the smallest sample and on awkward rows."""

import math
from pathlib import Path

import pytest
import xxhash
from test_decontamination import brute as brute_contamination
from test_importance import plain_weights
from test_simhash import brute_fingerprint, groups
from llm_texts import awkward, documents

import corpus_pipeline
from stratalake.llm.importance import ENVELOPE, SEED, trusted_ids

SF_DIR = "/root/testdata/sf0.001"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
pytestmark = pytest.mark.skipif(not (Path(SF_DIR).exists() and Path(MODEL).exists()), reason="no samples here")


def drawn(rows, trusted):
    weights = plain_weights(rows, trusted)
    uniform = [((xxhash.xxh64_intdigest((t or "").encode(), SEED) >> 11) + 0.5) / (1 << 53) for _, t in rows]
    keys = [w - math.log(-math.log(u)) for w, u in zip(weights, uniform)]
    k = round(sum(min(1.0, math.exp(min(0.0, w + ENVELOPE))) for w in weights))
    cut = sorted(keys, reverse=True)[k - 1]
    return [row for row, key in zip(rows, keys) if key >= cut - 1e-9]


def one_of_each(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    group = groups(sorted(set(fps)), 2)
    best = {}
    for row, fp in zip(rows, fps):
        order = (row[0] is None, row[0] or 0)
        if group[fp] not in best or order < best[group[fp]][0]:
            best[group[fp]] = (order, row)
    return [row for _, row in best.values()]


def plain(rows, trusted, items):
    import sentencepiece

    rows = drawn(rows, trusted)
    rows = [r for r in rows if r[1] is not None and any(map(str.isalpha, r[1]))]
    rows = one_of_each(rows)
    rows = [r for r in rows if brute_contamination([r], items)[0][2] == 0]
    original = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return sorted(((str(d), original.encode(t)) for d, t in rows), key=str)


def test_smallest_sample(spark):
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    trusted = {r.doc_id for r in trusted_ids(read("labels")).collect()}
    rows = [(r.doc_id, r.text) for r in read("documents").collect()]
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == [*read("documents").columns, "ids", "parity", "round_trip"]
    found = out.collect()
    assert sorted(((str(r.doc_id), list(r.ids)) for r in found), key=str) == plain(rows, trusted, items)
    assert all(r.parity and r.round_trip for r in found)


def test_stages_give_the_columns_they_get(spark):
    docs = documents(spark, awkward())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SF_DIR)
        assert left.columns == docs.columns, name
        assert left.schema.simpleString() == docs.schema.simpleString(), name
        assert stage(spark, documents(spark, []), SF_DIR).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, documents(spark, []), SF_DIR).count() == 0


def test_every_operator_is_registered_once():
    from stratalake.llm.queries import QUERIES

    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
