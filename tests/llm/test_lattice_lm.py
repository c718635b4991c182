import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from llm_texts import awkward, crc, documents, lower, space_words, words

from stratalake.llm.lattice_lm import END, build_lattice, expected_pieces, fit, log_marginals, score
from stratalake.llm.piece_model import BPE, BYTE, NORMAL, UNIGRAM, PieceModel, read_model

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
TOY = PieceModel(
    pieces=[("▁", -1.0, NORMAL), ("a", -2.0, NORMAL), ("b", -2.5, NORMAL), ("ab", -1.5, NORMAL), ("▁a", -1.7, NORMAL)]
    + [("ba", -3.0, NORMAL), ("aba", -2.2, NORMAL)]
    + [(f"<0x{k:02X}>", -9.0, BYTE) for k in range(256)],
    kind=UNIGRAM,
    unknown=0,
    byte_fallback=True,
    charsmap=b"",
    dummy_prefix=True,
    trim_spaces=False,
    escape_spaces=True,
)


def segmentations(text, pieces):
    if not text:
        yield []
    for piece in pieces:
        if text.startswith(piece):
            for rest in segmentations(text[len(piece) :], pieces):
                yield [piece, *rest]


def test_marginals_sum_over_every_segmentation():
    lattice = build_lattice(TOY)
    place = {p: k for k, (p, _, kind) in enumerate(TOY.pieces) if kind == NORMAL}
    texts = ["", "a", "ab", "abab", "aabba", "bbbb", "ababababa"]
    found = log_marginals(lattice, texts)
    for text, got in zip(texts, found):
        total = sum(math.exp(sum(lattice.logp[place[p]] for p in s)) for s in segmentations("▁" + text, place))
        assert got == pytest.approx(math.log(total), abs=1e-9)


def test_unknown_characters_are_spelt_in_bytes():
    lattice = build_lattice(TOY)
    spelt = sum(lattice.logp[lattice.n_pieces + b] for b in "é".encode())
    assert log_marginals(lattice, ["é"])[0] == pytest.approx(lattice.logp[0] + spelt)


def test_weights_are_probabilities():
    for kind in (UNIGRAM, BPE):
        lattice = build_lattice(PieceModel(TOY.pieces, kind, 0, True, b"", True, False, True))
        assert np.exp(lattice.logp).sum() == pytest.approx(1.0)


def test_expected_pieces_are_shares_of_segmentations():
    lattice = build_lattice(TOY)
    place = {p: k for k, (p, _, kind) in enumerate(TOY.pieces) if kind == NORMAL}
    want = np.zeros(len(lattice.logp))
    for text, times in (("abab", 3.0), ("a", 2.0)):
        all_of = list(segmentations("▁" + text, place))
        mass = [math.exp(sum(lattice.logp[place[p]] for p in s)) for s in all_of]
        for s, m in zip(all_of, mass):
            for p in s:
                want[place[p]] += times * m / sum(mass)
    assert expected_pieces(lattice, ["abab", "a"], np.array([3.0, 2.0])) == pytest.approx(want)


def test_rounds_raise_the_likelihood(spark):
    rng = random.Random(5)
    counts = Counter("".join(rng.choice("ab") for _ in range(rng.randrange(1, 9))) for _ in range(300))
    frame = spark.createDataFrame([*counts.items(), (END, 40)], "word string, c long")
    before, likelihood = None, []
    for rounds in (0, 1, 2, 4):
        lattice = fit(build_lattice(TOY), frame, 40, rounds)
        likelihood.append(sum(c * m for c, m in zip(counts.values(), log_marginals(lattice, list(counts)))) + 40 * lattice.logp[-1])
    assert likelihood == sorted(likelihood) and likelihood[-1] > likelihood[0], before


def brute_base(rows):
    tokens = [[*space_words(lower(t)), END] for _, t, *_ in rows]
    counts = Counter(w for (d, *_), ws in zip(rows, tokens) if d is not None and crc(d, 10) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [
        (len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        for ws in tokens
    ]


@pytest.mark.parametrize("hot", [100_000, 3, 0])
def test_documents_against_counting(spark, hot):
    rng = random.Random(6)
    rows = [r for r in awkward() if r[1] is None or len(r[1]) < 9000]
    rows += [(100 + k, words(rng, rng.randrange(40)).title(), "en") for k in range(50)]
    got = score(documents(spark, rows), TOY, "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 10 != 0", 1, hot).collect()
    key = lambda d, n, k, t, b: (str(d), n, k, t, round(b, 6))
    want = sorted(key(d, *b) for (d, *_), b in zip(rows, brute_base(rows)))
    assert sorted(key(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    ends = {r.score for r in got if r.n_tokens == 1}
    assert len(ends) == 1  # only the end of a text


def test_hot_words_do_not_change_scores(spark):
    rows = documents(spark, [(k, words(random.Random(k), 30)) for k in range(40)])
    of = lambda hot: {r.doc_id: r.score for r in score(rows, TOY, "doc_id % 2 = 0", 1, hot).collect()}
    few, many = of(0), of(1000)
    assert few.keys() == many.keys() and all(few[k] == pytest.approx(many[k]) for k in few)


def test_empty(spark):
    assert score(documents(spark, []), TOY, "true", 1).count() == 0
    only_held_out = score(documents(spark, [(1, "a b")]), TOY, "false", 1).first()
    assert only_held_out.train_tokens == 0 and only_held_out.n_known == 0


@pytest.mark.skipif(not Path(MODEL).exists(), reason="no vocabulary here")
def test_public_vocabulary(spark):
    lattice = build_lattice(read_model(MODEL))
    likely, unlikely = log_marginals(lattice, ["the", "xqzj"])
    assert unlikely < likely < 0
