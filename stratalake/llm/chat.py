"""Chat formatting at the level of tokens.

Every segment is encoded by itself and reserved ids, beyond the vocabulary, are spliced between:
a turn is ``role, text, end``. No text can yield a reserved id. In the written form a role is
``### User:`` and an end ``</turn>``; where a text contains a control string or a backslash, a
backslash is put before it, which reading back removes. Places of turns and of the loss (the texts
of the assistant) in a conversation's token stream are prefix sums over its turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Written role marks; any other role is written and encoded behind OTHER.
ROLES = {"system": "### System:", "user": "### User:", "assistant": "### Assistant:"}
OTHER = "### Role "
NAMED = ":"
END = "</turn>"
TRAINED = "assistant"
#: Reserved ids after the vocabulary's last, in this order.
RESERVED = (*ROLES, "other", "named", "end")

_CONTROL = re.compile(r"\\|#(?=##)|(?<=##)#|(?<=#)#(?=#)|</turn>")
_ESCAPED = re.compile(r"\\(\\|#|</turn>)")


def escape(text: str) -> str:
    """The text with a backslash before every backslash, end mark, and ``#`` of three or more in a row."""
    return _CONTROL.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group(1), text)


def written(role: str, text: str) -> str:
    """A turn in its written form."""
    mark = ROLES.get(role) or f"{OTHER}{escape(role)}{NAMED}"
    return f"{mark} {escape(text)} {END}\n"


def _tokenizer_json(path: str) -> tuple[str, int]:
    """The tokenizer's definition, and its first free id."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return tokenizer.to_str(), max(tokenizer.get_vocab(with_added_tokens=True).values()) + 1


def _encode_all(tokenizer, texts: list[str]) -> list[list[int]]:
    return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def reserved_ids(tokenizer_path: str) -> dict[str, int]:
    first = _tokenizer_json(tokenizer_path)[1]
    return {name: first + k for k, name in enumerate(RESERVED)}


def format_turns(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per turn, conversations together and in order of turn, role and text.

    ``conv_id, turn, ids`` (reserved and encoded), ``begin`` (of the turn in the conversation's
    token stream), ``loss_begin, loss_end`` (in the same stream; equal where nothing is trained on),
    ``formatted`` (the written form). NULL texts and roles are empty; rows without ``conv_id`` are
    one conversation; repeated rows are turns of their own. Segments are encoded where they are
    read, so a conversation of any length costs its task only the merge.
    """
    spark = conversations.sparkSession
    definition, first = _tokenizer_json(tokenizer_path)
    shared = spark.sparkContext.broadcast((definition, {name: first + k for k, name in enumerate(RESERVED)}))
    schema = T.StructType(
        [
            conversations.schema["conv_id"],
            conversations.schema["turn"],
            T.StructField("role", T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
            T.StructField("n_mark", T.IntegerType()),
            T.StructField("n_loss", T.IntegerType()),
            T.StructField("formatted", T.StringType()),
        ]
    )

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        definition, reserved = shared.value
        tokenizer = Tokenizer.from_str(definition)
        tokenizer.encode_special_tokens = True  # special strings in a text are ordinary text
        for batch in batches:
            roles, texts = (batch.column(k).to_pylist() for k in (2, 3))
            encoded = _encode_all(tokenizer, [escape(t) for t in texts])
            others = [k for k, role in enumerate(roles) if role not in ROLES]
            names = dict(zip(others, _encode_all(tokenizer, [escape(roles[k]) for k in others])))
            ids, marks, losses = [], [], []
            for k, (role, tokens) in enumerate(zip(roles, encoded)):
                mark = [reserved["other"], *names[k], reserved["named"]] if k in names else [reserved[role]]
                ids.append([*mark, *tokens, reserved["end"]])
                marks.append(len(mark))
                losses.append(len(tokens) if role == TRAINED else 0)
            columns = [
                *batch.columns,
                pa.array(ids, pa.list_(pa.int32())),
                pa.array(marks, pa.int32()),
                pa.array(losses, pa.int32()),
                pa.array([written(r, t) for r, t in zip(roles, texts)], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    turns = conversations.select(
        "conv_id",
        "turn",
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    ).mapInArrow(of_batches, schema)
    before = (
        Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    )
    begin = F.coalesce(F.sum(F.size("ids").cast("long")).over(before), F.lit(0))
    return turns.withColumn("begin", begin).select(
        "conv_id",
        "turn",
        "ids",
        "begin",
        (F.col("begin") + F.col("n_mark")).alias("loss_begin"),
        (F.col("begin") + F.col("n_mark") + F.col("n_loss")).alias("loss_end"),
        "formatted",
    )


def read_back(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per conversation of ``format_turns``' rows, from their tokens and masks alone.

    ``conv_id, n_turns, turns_sha256`` (role, line feed, text, line feed of every turn), ``loss_chars,
    loss_sha256`` (of all text under the mask), ``formatted_chars``. Turns are digested as they
    come, so a long conversation needs no more memory than a batch.
    """
    definition, first = _tokenizer_json(tokenizer_path)
    shared = formatted.sparkSession.sparkContext.broadcast((definition, first))
    schema = T.StructType(
        [
            formatted.schema["conv_id"],
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        definition, first = shared.value
        tokenizer = Tokenizer.from_str(definition)
        names = dict(enumerate(RESERVED, first))
        started, conv = False, None
        done: list[tuple] = []

        def text_of(ids: np.ndarray) -> str:
            return unescape(tokenizer.decode(ids.tolist(), skip_special_tokens=False))

        def finish() -> None:
            done.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        for batch in batches:
            for row in range(batch.num_rows):
                conv_id, _, ids, begin, loss_begin, loss_end, form = (c[row] for c in batch.columns)
                conv_id, begin = conv_id.as_py(), begin.as_py()
                if not started or conv_id != conv:
                    if started:
                        finish()
                    started, conv = True, conv_id
                    n_turns, loss_chars, chars, turns, loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                ids = ids.values.to_numpy()
                # Reserved ids delimit the segments: role, (its name,) text, end.
                places = np.flatnonzero(ids >= first)
                role = names[int(ids[0])]
                if role == "other":
                    role = text_of(ids[1 : places[1]])
                text = text_of(ids[places[-2] + 1 : places[-1]])
                under = text_of(ids[loss_begin.as_py() - begin : loss_end.as_py() - begin])
                n_turns += 1
                turns.update(f"{role}\n{text}\n".encode())
                loss.update(under.encode())
                loss_chars += len(under)
                chars += len(form.as_py())
            yield _rows(done, schema, batch)
            done.clear()
        if started:
            finish()
            yield _rows(done, schema, batch)

    return formatted.mapInArrow(of_batches, schema)


def _rows(done: list[tuple], schema: T.StructType, batch: pa.RecordBatch) -> pa.RecordBatch:
    kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    columns = list(zip(*done)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema.names)
