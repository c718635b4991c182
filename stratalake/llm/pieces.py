"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed and rebuilt: normaliser, space mark, merges or unigram scores, byte
fallback. No piece has the space mark behind another character, and none a line feed (checked), so
a text's pieces are those of its chunks, cut before runs of space marks and around line feeds. Tasks
therefore encode every different chunk once, in multithreaded batches, and compare its ids with the
original library's; a row is in parity if all its chunks are. Texts are cut, and ids put together, by
Arrow kernels. Whole lists of ids are then decoded, by a table of what every id spells, and compared
with the text; ``decode`` does it with the rebuilt tokenizer. Left over: under a unigram model a text that spells out a byte piece, such as ``<0x41>``, is not in parity.
"""

from __future__ import annotations

import gc
import json
import re
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stratalake.llm.piece_model import BPE, BYTE, CONTROL, SPACE, UNIGRAM, UNKNOWN, USER_DEFINED, PieceModel, read_model

#: Different chunks that a task remembers, twice: lately met ones and earlier ones (some 200 bytes each).
REMEMBERED = 200_000
#: Bytes of text that are cut into chunks together.
PORTION = 1 << 20
#: Chunks encoded in one batch.
BATCH = 8192
#: Threads of a task's batches.
THREADS = 2


def merges(model: PieceModel) -> list[tuple[str, str]]:
    """The merges of a BPE vocabulary, best first: every way to join two pieces into a third."""
    place = {piece: k for k, (piece, _, _) in enumerate(model.pieces)}
    found = []
    for piece, score, kind in model.pieces:
        if kind in (UNKNOWN, CONTROL, BYTE):
            continue
        for cut in range(1, len(piece)):
            if piece[:cut] in place and piece[cut:] in place:
                found.append((-score, place[piece[:cut]], place[piece[cut:]], piece[:cut], piece[cut:]))
    return [(a, b) for *_, a, b in sorted(found, key=lambda m: m[:3])]


def normaliser(model: PieceModel) -> list:
    """Steps from a text to its marked form, in order."""
    from tokenizers import Regex, normalizers

    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.trim_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", SPACE))
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(SPACE))
    return steps


def rebuild(model: PieceModel):
    """The model as a tokenizer: ids of a text, and text of ids."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if any(kind == USER_DEFINED for *_, kind in model.pieces):
        raise ValueError("user-defined pieces are not rebuilt")
    across = re.compile(f"[^{SPACE}]{SPACE}|\n")
    if any(across.search(piece) for piece, _, kind in model.pieces if kind not in (CONTROL, UNKNOWN)):
        raise ValueError("a piece crosses a space mark or a line feed: texts can't be encoded by chunks")
    if model.kind == BPE:
        core = models.BPE(
            {piece: k for k, (piece, _, _) in enumerate(model.pieces)},
            merges(model),
            unk_token=model.pieces[model.unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    elif model.kind == UNIGRAM:
        # A plain space never occurs in a marked text, so no text spells these.
        hidden = (UNKNOWN, CONTROL)
        core = models.Unigram(
            [(f" {piece}" if kind in hidden else piece, score) for piece, score, kind in model.pieces],
            model.unknown,
            model.byte_fallback,
        )
    else:
        raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
    tokenizer = Tokenizer(core)
    tokenizer.normalizer = normalizers.Sequence(normaliser(model))
    tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{SPACE}*[^{SPACE}]*"), "isolated")
    steps = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence(steps + [decoders.Strip(" ", 1, 0)] * model.dummy_prefix)
    return tokenizer


#: What may stand between chunks while a portion is cut: one that none of its texts has.
SEPARATORS = ("\x1f", "\x1e", "\x1d", "\x1c", *map(chr, range(0xFDD0, 0xFDF0)))


def chunks(spaced: str) -> list[str]:
    """A text with spaces for space marks, cut before every run of spaces, and around every line feed."""
    return re.findall(" +[^ \n]*|[^ \n]+|\n", spaced)


def cut(spaced: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Chunks of all texts, some of them empty, and where those of each begin."""
    separator = next((c for c in SEPARATORS if not pc.any(pc.match_substring(spaced, c)).as_py()), None)
    if separator is None:
        parts = [chunks(text) for text in spaced.to_pylist()]
        return np.cumsum([0, *map(len, parts)]), pa.array([c for part in parts for c in part], pa.string())
    parts = pc.replace_substring_regex(spaced, "( +)", separator + "\\1")
    parts = pc.split_pattern(pc.replace_substring(parts, "\n", f"{separator}\n{separator}"), separator)
    return parts.offsets.to_numpy(), parts.values


class Codec:
    """A rebuilt tokenizer beside the original library, in one task."""

    def __init__(
        self, for_chunks: str, normaliser: str | None, original: bytes | None, remembered: int = REMEMBERED
    ) -> None:
        from tokenizers import Tokenizer

        self.remembered = remembered
        self.parts = Tokenizer.from_str(for_chunks)
        self.normaliser = None if normaliser is None else Tokenizer.from_str(normaliser).normalizer
        self.original = None
        if original is not None:
            import sentencepiece

            self.original = sentencepiece.SentencePieceProcessor(model_proto=original)
        vocabulary = sorted(self.parts.get_vocab().items(), key=lambda item: item[1])
        self.spelt = pa.array([_bytes_of(piece) for piece, _ in vocabulary], pa.large_binary())
        # Chunks met lately, and those met before them: what is met again moves back to the first.
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        # Chunks whose ids differ from the original's.
        self.apart: set[str] = set()

    def spaced(self, texts: pa.Array) -> pa.Array:
        """Normalised texts, with a space for every space mark."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if self.normaliser is None:
            marked = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
        else:
            marked = pa.array([t and self.normaliser.normalize_str(t) for t in texts.to_pylist()], pa.string())
        return pc.replace_substring(marked, SPACE, " ")

    def _original_ids(self, new: list[str]) -> list[list[int]]:
        """The original puts a space mark before what it gets; chunks without one go behind a line feed."""
        given = [c[1:].replace(SPACE, " ") if c[0] == SPACE else "\n" + c for c in new]
        ids = self.original.encode(given, num_threads=THREADS)
        mark = [self.parts.token_to_id(SPACE)]
        return [mark if c == SPACE else i if c[0] == SPACE else i[2:] for c, i in zip(new, ids)]

    def learn(self, new: list[str]) -> None:
        marked = [c.replace(" ", SPACE) for c in new]
        ids = [e.ids for e in self.parts.encode_batch_fast(marked, add_special_tokens=False)]
        self.known.update(zip(new, [array("i", i).tobytes() for i in ids]))
        if self.original is not None:
            self.apart.update([c for c, own, other in zip(new, ids, self._original_ids(marked)) if own != other])

    def _remember(self, wanted: list[str]) -> None:
        new = [c for c in wanted if c not in self.known]
        if len(self.known) + len(new) > self.remembered:
            self.earlier, self.known = self.known, {}
            self.apart &= self.earlier.keys()
            new = wanted
        again = [c for c in new if c in self.earlier]
        self.known.update([(c, self.earlier[c]) for c in again])
        new = [c for c in new if c not in self.known]
        for at in range(0, len(new), BATCH):
            self.learn(new[at : at + BATCH])

    def encode_array(self, texts: pa.Array) -> tuple[pa.ListArray, np.ndarray, np.ndarray]:
        """Ids of every text, whether they match the original's, whether they decode to the text."""
        spaced = self.spaced(texts)
        begins, parts = cut(spaced)
        coded = parts.dictionary_encode()
        different = coded.dictionary.to_pylist()
        wanted = [c for c in different if c]
        self._remember(wanted)
        packed = [self.known[c] if c else b"" for c in different]
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        ids_of = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()),
            pa.array(np.frombuffer(b"".join(packed), np.int32), pa.int32()),
        )
        flat = ids_of.take(coded.indices).flatten()
        places = coded.indices.to_numpy(zero_copy_only=False)
        offsets = np.concatenate(([0], np.cumsum(sizes[places])))[begins]
        bad = np.fromiter((c in self.apart for c in different), bool, len(different)) if self.apart else None
        apart = np.zeros(len(places) + 1, np.int64)
        if bad is not None:
            apart[1:] = np.cumsum(bad[places])
        same = apart[begins[1:]] == apart[begins[:-1]]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat), same, self._decodes(flat, offsets, spaced)

    def _decodes(self, ids: pa.Array, offsets: np.ndarray, spaced: pa.Array) -> np.ndarray:
        """Whether each list of ids, decoded as a whole, is the text."""
        spelt = self.spelt.take(ids)
        # All that the ids spell stands in one buffer, one id after another.
        begins = np.frombuffer(spelt.buffers()[1], np.int64)[: len(spelt) + 1][offsets] if len(spelt) else offsets * 0
        decoded = memoryview(spelt.buffers()[2] or b"").cast("B")
        texts = memoryview(b"".join([t.encode() for t in spaced.to_pylist()]))
        ends = np.cumsum(pc.binary_length(spaced).to_numpy(zero_copy_only=False))
        if len(ends) and begins[-1] == ends[-1] and decoded[: ends[-1]] == texts and (begins[1:] == ends).all():
            return np.ones(len(ends), bool)
        starts = [0, *ends.tolist()]
        return np.array(
            [decoded[a:b] == texts[c:d] for a, b, c, d in zip(begins, begins[1:], starts, starts[1:])], bool
        )

    def encode(self, texts: list[str | None]) -> Iterator[tuple[bytes, bool, bool]]:
        """``encode_array`` text by text, ids as 32-bit integers."""
        ids, same, back = self.encode_array(pa.array(texts, pa.string()))
        for own, a, b in zip(ids, same.tolist(), back.tolist()):
            yield own.values.to_numpy().astype(np.int32).tobytes(), a, b


def _bytes_of(piece: str) -> bytes:
    """What a piece spells: its text with spaces for space marks, or its byte."""
    byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
    return bytes.fromhex(byte[1]) if byte else piece.replace(SPACE, " ").encode()


def _codec_parts(model_path: str, verify: bool) -> tuple[str, str | None, bytes | None]:
    """What a task's codec is made of: the tokenizer for chunks, the normaliser unless it only marks spaces."""
    from tokenizers import Tokenizer, models

    model = read_model(model_path)
    original = Path(model_path).read_bytes() if verify else None
    whole = rebuild(model)
    normaliser = None
    if not (model.dummy_prefix and model.escape_spaces) or model.charsmap or model.trim_spaces:
        alone = Tokenizer(models.BPE())
        alone.normalizer = whole.normalizer
        normaliser = alone.to_str()
    spec = json.loads(whole.to_str())
    spec["normalizer"] = spec["pre_tokenizer"] = None
    spec["decoder"]["decoders"] = [d for d in spec["decoder"]["decoders"] if d["type"] != "Strip"]
    return json.dumps(spec), normaliser, original


def _threads(n: int = THREADS) -> None:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    os.environ["RAYON_NUM_THREADS"] = str(n)


def _portions(batch: pa.RecordBatch, place: int, portion: int = PORTION) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``portion`` bytes of text, however long its texts are."""
    lengths = pc.fill_null(pc.binary_length(batch.column(place).cast(pa.string())), 0).to_numpy(zero_copy_only=False)
    number = np.cumsum(lengths + 1) // portion
    edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(edges, edges[1:]):
        if end > begin:
            yield batch.slice(begin, end - begin)


def encode(
    documents: DataFrame, model_path: str, verify: bool = True, remembered: int = REMEMBERED, portion: int = PORTION
) -> DataFrame:
    """``documents`` with ``ids`` (array of int), ``parity`` and ``round_trip``.

    The model file is read on the driver and broadcast. NULL and empty texts have no ids, and are
    in parity. ``round_trip``: the ids decode to the normalised text. Columns of these names in
    ``documents`` are replaced. Smaller ``remembered`` and ``portion`` (bytes of text cut together)
    need less memory in a task and more time; ids are the same.
    """
    added = [
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("parity", T.BooleanType()),
        T.StructField("round_trip", T.BooleanType()),
    ]
    documents = documents.drop(*[f.name for f in added])
    schema = T.StructType(documents.schema.fields + added)
    place = documents.columns.index("text")
    parts = documents.sparkSession.sparkContext.broadcast(_codec_parts(model_path, verify))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _threads()
        codec = Codec(*parts.value, remembered)
        gc.disable()  # nothing here makes cycles, and collections would walk all remembered chunks
        try:
            yield from encoded(codec, batches)
        finally:
            gc.enable()

    def encoded(codec: Codec, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _portions(whole, place, portion):
                ids, same, back = codec.encode_array(batch.column(place))
                yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array(same), pa.array(back)], schema.names)

    return documents.mapInArrow(of_batches, schema)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` with ``text`` made anew from ``ids``; NULL ids give NULL."""
    schema = T.StructType([f for f in encoded.schema if f.name != "text"] + [T.StructField("text", T.StringType())])
    rest = [n for n in schema.names if n != "text"]
    shared = encoded.sparkSession.sparkContext.broadcast(rebuild(read_model(model_path)).to_str())

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        _threads()
        tokenizer = Tokenizer.from_str(shared.value)
        for batch in batches:
            ids = batch.column(batch.schema.names.index("ids")).to_pylist()
            texts = tokenizer.decode_batch([i or [] for i in ids], skip_special_tokens=False)
            texts = [None if i is None else t for i, t in zip(ids, texts)]
            columns = [batch.column(batch.schema.names.index(n)) for n in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], schema.names)

    return encoded.mapInArrow(of_batches, schema)
