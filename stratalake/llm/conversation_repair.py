"""Repair of conversation structure: the cheapest edits that give a legal order of roles.

Legal are the role initials ``(s?(ua)+)?``. Rows are kept (0), get another role (3) or are deleted
(4; blank and repeated rows must be); rows of the user or assistant without text are inserted
anywhere (3); a row whose text breaks off costs 3 more unless it is deleted. Iterative-deepening A*
looks for the edits: a depth-first search that tries ``D I K R`` in this order under a cost bound that
rises from one pass to the next. What the rest costs at least is read from a relaxed grammar, in which a
conversation may end anywhere, so few passes are needed and few wrong turns taken; states that have
failed with a budget are not entered again with as little. The first accepted path costs least, and is
the least in ASCII order of those.

Rows of a conversation come to one task as a sorted stream, twice: first their initials and faults,
some 30 bytes a row while the search runs, then their texts, digested as they come. So a conversation
of any length needs no memory for its texts. (The digest needs all of its rows in order.)

NULL roles and texts are one space each. A role without characters fits nowhere. Rows of a turn stand
in order of role and text, rows without a turn come first; rows without a ``conv_id`` are one
conversation. A conversation without rows left gives zeros, an empty audit and the digest of an empty
text; an empty table gives no rows. Only the four columns are read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import saved

RELABEL, DELETE, INSERT, BROKEN = 3, 4, 3, 3

#: Faults of a row, the first of them counts.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

#: Where the grammar stands: at its start, after a system row, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: By state: the role due, the state after it, and the state of the relaxed grammar (a user is due, an
#: assistant is due, nothing was said).
DUE = ("user", "user", "assistant", "user")
AFTER = (USER, USER, ASSISTANT, USER)
RELAXED = (2, 0, 1, 0)

Row = tuple[str, int]  # role initial and fault


def _kept(state: int, initial: str) -> int | None:
    """State after a row kept as it is."""
    if initial == "s":
        return SYSTEM if state == START else None
    return AFTER[state] if initial == DUE[state][0] else None


def least_costs(rows: Sequence[Row]) -> array:
    """What rows from ``i`` on cost at least if any end is legal, at ``3 * i`` and the state of the relaxed grammar."""
    costs = array("q", bytes(24 * (len(rows) + 1)))
    user = assistant = start = 0
    for i in range(len(rows) - 1, -1, -1):
        initial, fault = rows[i]
        u, a, s = DELETE + user, DELETE + assistant, DELETE + start
        if fault not in (BLANK, DUPLICATE):
            more = BROKEN if fault == TRUNCATED else 0
            as_user = more + (0 if initial == "u" else RELABEL) + assistant
            u, s = min(u, as_user), min(s, as_user)
            a = min(a, more + (0 if initial == "a" else RELABEL) + user)
            if initial == "s":
                s = min(s, more + user)
        user, assistant, start = min(u, INSERT + a), min(a, INSERT + u), min(s, INSERT + a)
        costs[3 * i], costs[3 * i + 1], costs[3 * i + 2] = user, assistant, start
    return costs


def _edited(rows: Sequence[Row], i: int, state: int, edit: str) -> tuple[int, int, int] | None:
    """Place, state and cost after an edit, None where it cannot be made."""
    if edit == "I":
        return i, AFTER[state], INSERT
    if i == len(rows):
        return None
    initial, fault = rows[i]
    if edit == "D":
        return i + 1, state, DELETE
    if fault in (BLANK, DUPLICATE):
        return None
    more = BROKEN if fault == TRUNCATED else 0
    if edit == "R":
        return i + 1, AFTER[state], RELABEL + more
    after = _kept(state, initial)
    return None if after is None else (i + 1, after, more)


def _within(rows: Sequence[Row], least: array, bound: int) -> str | None:
    """The first edits in ASCII order that cost no more than the bound."""
    failed = array("q", [-1]) * (4 * (len(rows) + 1))  # largest budget that did not suffice, by place and state
    path = [(0, START, 0)]
    tried = bytearray(1)
    edits: list[str] = []
    while path:
        i, state, cost = path[-1]
        if i == len(rows) and state in ENDS:
            return "".join(edits)
        if tried[-1] == 4:
            failed[4 * i + state] = max(failed[4 * i + state], bound - cost)
            path.pop(), tried.pop()
            if edits:
                edits.pop()
            continue
        edit = "DIKR"[tried[-1]]
        tried[-1] += 1
        if (child := _edited(rows, i, state, edit)) is None:
            continue
        j, after, more = child
        left = bound - cost - more
        if least[3 * j + RELAXED[after]] <= left and failed[4 * j + after] < left:
            path.append((j, after, cost + more))
            tried.append(0)
            edits.append(edit)
    return None


def cheapest(rows: Sequence[Row]) -> tuple[int, str]:
    """Cost and initials of the cheapest edits, of equally cheap ones the least in ASCII order."""
    least = least_costs(rows)
    bound = least[RELAXED[START]]
    while (audit := _within(rows, least, bound)) is None:
        bound += 1
    return bound, audit


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults that depend on conversation and turn: of 20 in 5 each another one.

    Dropped, without text, without ``.!?``, twice in a row, or said by the user.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *named).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    drawn = conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"),
    )
    times = F.array_repeat(F.lit(0), F.col("times"))
    return drawn.select("conv_id", "turn", "role", "text", F.explode(times).alias("again")).drop("again")


def _fault(text: Column) -> Column:
    """A row's fault by its text alone."""
    # The last character that is no white space; none in a blank text.
    last = F.right(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    found = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    return found.cast("tinyint")


def repair(turns: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """The audit of every conversation in ``conv_ids``, from its rows in ``turns``.

    ``conv_id, n_rows, gaps, blank, duplicate, truncated, illegal, cost, audit, n_repaired,
    repaired_sha256``.
    """
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    said = F.sha2(F.concat_ws(":", F.length(role), F.concat(role, text)), 256)
    rows = saved(turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.unhex(said).alias("said")))
    # What is said more than once in a conversation, and when first; counted before the shuffle.
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = rows.groupBy("conv_id", "said").agg(F.min(when).alias("first"), F.count("*").alias("times"))
    again = again.where("times > 1").select(F.col("conv_id").alias("of"), F.col("said").alias("words"), "first")
    marked = rows.join(again, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("said") == F.col("words")), "left")
    # Rows of the first turn are told apart where they stand side by side, in the stream.
    later = F.col("words").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    plain = _fault(F.col("text")).alias("plain")
    marked = marked.select("conv_id", "turn", "role", "text", "said", plain, later.alias("later"))
    every = conv_ids.select("conv_id").distinct()
    empty = [F.lit(None).cast(marked.schema[c].dataType).alias(c) for c in marked.columns[1:]]
    stream = every.select("conv_id", F.lit(0).alias("pass"), *empty).unionByName(
        marked.withColumn("pass", F.explode(F.array(F.lit(1), F.lit(2))))
    )
    order = ["conv_id", "pass", "turn", "role", "text"]
    sorted_rows = stream.repartition("conv_id").sortWithinPartitions(*order)
    # Texts of the first pass served the order only.
    spoken = F.when(F.col("pass") == 2, F.col("text")).alias("text")
    return sorted_rows.select("conv_id", "pass", "turn", "role", spoken, "said", "plain", "later").mapInArrow(
        _audits(turns.schema["conv_id"]), _schema(turns.schema["conv_id"])
    )


def _schema(conv_id: T.StructField) -> T.StructType:
    counts = ("n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return T.StructType(
        [T.StructField("conv_id", conv_id.dataType)]
        + [T.StructField(c, T.LongType()) for c in counts]
        + [T.StructField("audit", T.StringType()), T.StructField("n_repaired", T.LongType())]
        + [T.StructField("repaired_sha256", T.StringType())]
    )


class _Conversation:
    """What is known of the conversation that streams by."""

    def __init__(self, conv_id: object):
        self.conv_id = conv_id
        self.initials: list[str] = []
        self.faults = bytearray()
        self.before: tuple | None = None
        self.low = self.high = None
        self.turns = self.illegal = self.cost = 0
        self.audit: str | None = None
        self.at = self.n_repaired = 0
        self.state = START
        self.digest = hashlib.sha256()

    def code(self, turn: object, role: str, said: bytes, plain: int, later: bool) -> None:
        """A row of the first pass."""
        repeated = later or self.before == (turn, said)
        self.before = turn, said
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "?"
        if self.initials:
            self.illegal += self.initials[-1] + initial not in ("su", "ua", "au")
        self.initials.append(initial)
        self.faults.append(DUPLICATE if repeated and plain != BLANK else plain)

    def solve(self) -> None:
        self.cost, self.audit = cheapest(list(zip(self.initials, self.faults)))

    def _write(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.n_repaired else ''}{role}:{text}".encode())
        self.n_repaired += 1

    def _insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._write(DUE[self.state], "")
            self.state = AFTER[self.state]
            self.at += 1

    def text(self, role: str, text: str) -> None:
        """A row of the second pass, as the audit says."""
        if self.audit is None:
            self.solve()
        self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._write(role, text)
            self.state = _kept(self.state, role[:1])
        elif edit == "R":
            self._write(DUE[self.state], text)
            self.state = AFTER[self.state]

    def result(self) -> tuple:
        if self.audit is None:
            self.solve()
        self._insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        faults = [self.faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
        counts = (len(self.initials), gaps, *faults, self.illegal, self.cost)
        return (self.conv_id, *counts, self.audit, self.n_repaired, self.digest.hexdigest())


def _audits(conv_id: T.StructField):
    schema = _schema(conv_id)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        done: list[tuple] = []
        key = pa.null()
        for batch in batches:
            key = batch.schema.field(0).type
            for conv, number, turn, role, text, said, plain, later in zip(*(c.to_pylist() for c in batch.columns)):
                if number == 0:  # every conversation begins with a row of its own
                    if now is not None:
                        done.append(now.result())
                    now = _Conversation(conv)
                elif number == 1:
                    now.code(turn, role, said, plain, later)
                else:
                    now.text(role, text)
            yield as_batch(done, key)
            done = []
        if now is not None:
            yield as_batch([now.result()], key)

    def as_batch(rows: list[tuple], key: pa.DataType) -> pa.RecordBatch:
        kinds = [key, *[pa.int64()] * 7, pa.string(), pa.int64(), pa.string()]
        columns = list(zip(*rows)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema.names)

    return of_batches
