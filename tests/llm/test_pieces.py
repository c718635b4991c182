import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import awkward, documents

from stratalake.llm.piece_model import BYTE, CONTROL, NORMAL, UNKNOWN, read_model
from stratalake.llm.pieces import SEPARATORS, Codec, _codec_parts, chunks, cut, decode, encode, rebuild

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
pytestmark = pytest.mark.skipif(not Path(MODEL).exists(), reason="no vocabulary here")


def tricky_texts(n=400):
    rng = random.Random(8)
    parts = [" ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "a", "the", "Straße", "日本", "▁", "\u0000", "é", "é", "🙂", "1234", "<s>", "</s>", "<unk>", "x" * 30]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(n)]


def unigram_model(path):
    """A unigram model with given scores (nothing is trained)."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    listed = [("<unk>", 0.0, UNKNOWN), ("<s>", 0.0, CONTROL), ("</s>", 0.0, CONTROL)]
    listed += [(f"<0x{k:02X}>", -12.0, BYTE) for k in range(256)]
    listed += [(p, -1.0 - 0.37 * k, NORMAL) for k, p in enumerate(["▁", "▁the", "e", "a", "t", "th", "h", "s", "St", "ra", "r", "1", "23", "▁a", "x", "xx", "4"])]
    for piece, score, kind in listed:
        model.pieces.add(piece=piece, score=score, type=kind)
    model.trainer_spec.model_type = 1
    model.trainer_spec.byte_fallback = True
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.remove_extra_whitespaces = False
    Path(path).write_bytes(model.SerializeToString())
    return str(path)


def original(path):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_ids_of_whole_texts_match_the_original_library(kind, tmp_path):
    path = MODEL if kind == "bpe" else unigram_model(tmp_path / "u.model")
    texts = tricky_texts() + [t or "" for _, t, *_ in awkward() if t is None or len(t) < 20_000]
    codec, theirs = Codec(*_codec_parts(path, True)), original(path)
    whole = rebuild(read_model(path))
    forgetful = Codec(*_codec_parts(path, True), remembered=20)
    halves = [*forgetful.encode(texts[:200]), *forgetful.encode(texts[200:])]
    assert halves == list(codec.encode(texts))
    for text, (packed, same, back) in zip(texts, codec.encode(texts)):
        want = theirs.encode(text)
        assert list(memoryview(packed).cast("i")) == want and same
        assert whole.encode(text, add_special_tokens=False).ids == want
        assert back and whole.decode(want, skip_special_tokens=False) == text.replace("▁", " ")


def test_chunks_join_to_the_text():
    for text in tricky_texts():
        spaced = " " + text.replace("▁", " ")
        parts = chunks(spaced)
        assert "".join(parts) == spaced and all(" " not in c.lstrip(" ") for c in parts)
        assert all(c == "\n" or "\n" not in c for c in parts)


def test_cutting_by_kernels():
    texts = [" " + t.replace("▁", " ") for t in tricky_texts()] + ["", "\x1f a\x1eb"]
    for given in (texts, [*texts, " x".join(SEPARATORS)]):
        begins, parts = cut(pa.array(given))
        parts = parts.to_pylist()
        assert [[c for c in parts[a:b] if c] for a, b in zip(begins, begins[1:])] == [chunks(t) for t in given]


def test_whole_lists_are_decoded():
    """The table of what ids spell says what the tokenizer's decoder says; wrong ids do not decode to the text."""
    codec, whole = Codec(*_codec_parts(MODEL, False)), rebuild(read_model(MODEL))
    texts = tricky_texts()
    spaced = codec.spaced(pa.array(texts))
    lists = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    offsets = np.cumsum([0, *map(len, lists)])
    flat = [i for ids in lists for i in ids]
    assert codec._decodes(pa.array(flat, pa.int32()), offsets, spaced).all()
    wrong = [k for k, ids in enumerate(lists) if ids][::7]
    for k in wrong:
        flat[offsets[k]] = (flat[offsets[k]] + 400) % 30_000
    back = codec._decodes(pa.array(flat, pa.int32()), offsets, spaced)
    for k, ids in enumerate(np.split(np.array(flat), offsets[1:-1])):
        assert back[k] == (whole.decode(ids.tolist(), skip_special_tokens=False) == texts[k].replace("▁", " "))
    assert not back[wrong].any()


def test_frames(spark):
    rows = documents(spark, awkward())
    encoded = encode(rows, MODEL)
    theirs = original(MODEL)
    assert set(encoded.columns) == set(rows.columns) | {"ids", "parity", "round_trip"}
    found = encoded.collect()
    assert len(found) == len(awkward())
    for r in found:
        assert r.parity and r.round_trip and list(r.ids) == theirs.encode(r.text or "")
    back = decode(encoded.select("doc_id", "ids"), MODEL).collect()
    assert sorted(str(r.text) for r in back) == sorted((t or "").replace("▁", " ") for _, t, *_ in awkward())
    assert encode(documents(spark, []), MODEL).count() == 0


def test_a_piece_across_a_cut_is_refused(tmp_path):
    from dataclasses import replace

    model = read_model(unigram_model(tmp_path / "u.model"))
    for piece in ("a▁b", "a\nb"):
        with pytest.raises(ValueError):
            rebuild(replace(model, pieces=model.pieces + [(piece, -1.0, NORMAL)]))
