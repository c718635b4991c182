"""URL filters: glob rules over canonical URLs, all of them simulated at once.

The rules become one bit-parallel automaton (extended Shift-And): a bit for every place in every
glob, packed into 64-bit words one rule after another. A byte of the URL moves all places of all
rules by a shift, a mask and an or; a portion of URLs moves together, a byte of each per step. The
automaton has the size of the rules and travels with the task; nothing is shuffled.

A URL that is NULL or has no ``://`` has an empty host and path; no rule of a host fits it. Very long
URLs take a step per byte in constant memory. Rows are judged by themselves: repeated rows and rows
without an id give a row each, an empty table gives none. Only ``page_id`` and ``url`` are read, so
other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import ascii_lower

ALLOW, BLOCK = "allow", "block"

#: URLs that move through the automaton together.
PORTION = 8192


@dataclass(frozen=True)
class HostRule:
    """A host with all its subdomains, and what the path starts with (from its ``/`` on)."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{_literal(self.host)}#{_literal(self.path)}*"


#: Words that close a host for training data where they stand between dots or hyphens.
UNSAFE_WORDS = ("adult", "porn", "xxx", "sex", "casino", "poker", "bets", "betting", "pills", "warez")
#: Endings of paths that are no text.
BINARIES = ("7z", "apk", "bin", "dmg", "exe", "gz", "iso", "jpg", "mp3", "mp4", "png", "rar", "zip")


def unwanted(words: Sequence[str] = UNSAFE_WORDS, endings: Sequence[str] = BINARIES) -> list[str]:
    """Globs of hosts with a label made of one of the words, and of paths with one of the endings."""
    hosts = [f"*{a}{_literal(w)}{b}*#*#*" for w in words for a in ".-" for b in ".-"]
    return hosts + [f"*#*.{_literal(e)}#*" for e in endings]


def _literal(text: str) -> str:
    return "".join("\\" + c if c in "*?\\" else c for c in text)


def host_and_path(url: Column) -> tuple[Column, Column, Column]:
    """Host with A-Z lower-cased, path and query of a URL; empty where it has no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)\??([^#]*)"
    host, path, rest = (F.coalesce(F.regexp_extract(url, pattern, k), F.lit("")) for k in (1, 2, 3))
    return ascii_lower(host), path, rest


class Automaton:
    """Globs (``*`` any text, ``?`` one character, ``\\`` before a character taken as it is) over whole texts."""

    def __init__(self, globs: Sequence[str]):
        places: list[set[int] | range] = []  # bytes that lead into a place; none lead into a start
        starts, finals, loops, wide = [], [], [], []
        for glob in globs:
            starts.append(len(places))
            places.append(set())
            characters = iter(glob)
            for c in characters:
                if c == "*":
                    loops.append(len(places) - 1)
                elif c == "?":
                    wide.append(len(places))
                    places.append({*range(256)} - {*range(0x80, 0xC0)})
                else:
                    places += [{byte} for byte in (next(characters, "\\") if c == "\\" else c).encode()]
            finals.append(len(places) - 1)
        self.words = max(1, -(-len(places) // 64))
        self.finals = finals
        self.start = self._mask(starts)
        enter = np.zeros((256, self.words), np.uint64)
        for place, accepted in enumerate(places):
            for byte in accepted:
                enter[byte, place >> 6] |= np.uint64(1 << (place & 63))
        stay = np.tile(self._mask(loops), (256, 1))
        stay[0x80:0xC0] |= self._mask(wide)  # the later bytes of the character a ``?`` stands for
        self.enter, self.stay = enter, stay

    def _mask(self, places: Sequence[int]) -> np.ndarray:
        mask = np.zeros(self.words, np.uint64)
        for place in places:
            mask[place >> 6] |= np.uint64(1 << (place & 63))
        return mask

    def fits(self, texts: Sequence[bytes]) -> np.ndarray:
        """A row per text and a column per glob: whether the whole text fits it."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        data = np.frombuffer(b"".join(texts), np.uint8)
        order = np.argsort(-lengths, kind="stable")
        begins = (np.cumsum(lengths) - lengths)[order]
        # Texts still running at a step stand first, the longest before the others.
        running = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left")
        state = np.tile(self.start, (len(texts), 1))
        for step, n in enumerate(running):
            now, byte = state[:n], data[begins[:n] + step]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.enter[byte]) | (now & self.stay[byte])
        found = np.empty((len(texts), len(self.finals)), bool)
        for k, place in enumerate(self.finals):
            found[order, k] = (state[:, place >> 6] >> np.uint64(place & 63)) & np.uint64(1) != 0
        return found


def judge(pages: DataFrame, rules: Sequence[HostRule], globs: Sequence[str] | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` of every row.

    The longest of the fitting ``rules`` decides (of equally long ones a blocking one, then the first
    by name). Where none fits, a URL that fits any of ``globs`` is blocked and ``pattern`` is the
    longest of those; else it is allowed. Globs are over ``.host#path#query``, in which ``#`` stands
    in those two places only.
    """
    globs = unwanted() if globs is None else globs
    # The first that fits decides.
    ranked = sorted(set(rules), key=lambda r: (-len(r.name), r.verdict != BLOCK, r.name))
    patterns = sorted(set(globs), key=lambda g: (-len(g), g))
    automaton = Automaton([r.glob for r in ranked] + patterns)
    names = np.array([r.name for r in ranked] + [None], object)
    verdicts = np.array([r.verdict for r in ranked] + [None], object)
    others = np.array([*patterns, None], object)
    fields = [T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict", "pattern")]
    schema = T.StructType([pages.schema["page_id"], *fields])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, PORTION):
                batch = whole.slice(begin, PORTION)
                found = automaton.fits(batch.column(3).cast(pa.binary()).to_pylist())
                rule, other = first(found[:, : len(ranked)]), first(found[:, len(ranked) :])
                verdict = verdicts[rule]
                verdict[rule == len(ranked)] = np.where(other < len(patterns), BLOCK, ALLOW)[rule == len(ranked)]
                pattern = np.where(rule == len(ranked), others[other], None)
                texts = [pa.array(list(c), pa.string()) for c in (names[rule], verdict, pattern)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *texts], schema.names)

    def first(found: np.ndarray) -> np.ndarray:
        """Place of the first true value of each row; one past the last where there is none."""
        return np.hstack([found, np.ones((len(found), 1), bool)]).argmax(axis=1)

    host, path, rest = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"), rest.alias("rest"))
    whole = F.concat(F.lit("."), "host", F.lit("#"), "path", F.lit("#"), "rest")
    return parts.select("page_id", "host", "path", whole.alias("whole")).mapInArrow(of_batches, schema)
