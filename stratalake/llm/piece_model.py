"""Public subword vocabularies in the SentencePiece format, read from their protobuf."""

from __future__ import annotations

from dataclasses import dataclass

#: Piece types of the format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Model types of the format.
UNIGRAM, BPE = 1, 2
SPACE = "▁"


@dataclass(frozen=True)
class PieceModel:
    pieces: list[tuple[str, float, int]]
    kind: int
    unknown: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    trim_spaces: bool
    escape_spaces: bool


def read_model(path: str) -> PieceModel:
    """The parts of a model file that encoding depends on."""
    from sentencepiece import sentencepiece_model_pb2

    with open(path, "rb") as file:
        model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
    return PieceModel(
        pieces=[(p.piece, p.score, p.type) for p in model.pieces],
        kind=model.trainer_spec.model_type,
        unknown=model.trainer_spec.unk_id,
        byte_fallback=model.trainer_spec.byte_fallback,
        charsmap=model.normalizer_spec.precompiled_charsmap,
        dummy_prefix=model.normalizer_spec.add_dummy_prefix,
        trim_spaces=model.normalizer_spec.remove_extra_whitespaces,
        escape_spaces=model.normalizer_spec.escape_whitespaces,
    )
