import hashlib
import heapq
import random
import re
import zlib

import pytest

from stratalake.llm.conversation_repair import BLANK, DUPLICATE, TRUNCATED, cheapest, repair
from stratalake.llm.queries import QUERIES

WHITE = "[^\\x20\\x09-\\x0D]"
AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def dijkstra(rows):
    """The least (cost, edits) that uses up all rows and ends legally; every edit with every role."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, edits, i, state = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, edits
        if (i, state) in done:
            continue
        done.add((i, state))
        for role in "ua":
            if (state, role) in AFTER:
                heapq.heappush(heap, (cost + 3, edits + "I", i, AFTER[state, role]))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 4, edits + "D", i + 1, state))
            if fault not in (BLANK, DUPLICATE):
                more = 3 if fault == TRUNCATED else 0
                for role in "ua":
                    if (state, role) in AFTER:
                        heapq.heappush(heap, (cost + 3 + more, edits + "R", i + 1, AFTER[state, role]))
                if (state, initial) in AFTER:
                    heapq.heappush(heap, (cost + more, edits + "K", i + 1, AFTER[state, initial]))
    raise AssertionError("a user and an assistant can always be inserted")


def test_search_against_dijkstra():
    rng = random.Random(1)
    for _ in range(3000):
        likely = rng.choice(["sua?", "ua", "uuua", "ss"])
        rows = [(rng.choice(likely), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(11))]
        assert cheapest(rows) == dijkstra(rows), rows


def test_long_conversations():
    rng = random.Random(2)
    rows = [(rng.choice("suuaa?"), rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(1500)]
    assert cheapest(rows) == dijkstra(rows)
    assert len(cheapest(rows * 20)[1].replace("I", "")) == 30_000
    assert cheapest([("u", 0), ("a", 0)] * 50_000) == (0, "K" * 100_000)


def damaged(rows):
    for conv, turn, role, text, *_ in rows:
        name = [" " if v is None else str(v) for v in (conv, turn)]
        fault = zlib.crc32(":".join(name).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        yield from [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)


def brute(turns, conv_ids):
    by_conv = {c: [] for c in conv_ids}
    for conv, turn, role, text in turns:
        by_conv[conv].append((turn is not None, turn or 0, role, text))
    out = []
    for conv, rows in by_conv.items():
        rows.sort()
        kinds, seen = [], set()
        for *_, role, text in rows:
            last = re.findall(WHITE, text)[-1:]
            fault = 1 if not last else 2 if (role, text) in seen else 3 if last[0] not in ".!?" else 0
            seen.add((role, text))
            kinds.append((role[:1], fault))
        cost, audit = dijkstra(kinds)
        repaired, state, left = [], "", iter(rows)
        for edit in audit:
            due = "assistant" if state == "u" else "user"
            role, text = (due, "") if edit == "I" else next(left)[2:]
            role = due if edit == "R" else role
            if edit != "D":
                repaired.append(f"{role}:{text}")
                state = role[0]
        known = [t for k, t, *_ in rows if k]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        faults = [sum(f == k for _, f in kinds) for k in (1, 2, 3)]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        digest = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
        out.append((conv, gaps, *faults, illegal, cost, audit, digest))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string, audit string, pass string, later string, of string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def sample():
    rng = random.Random(4)
    text = lambda: rng.choice(["Yes.", "No!", "and", "", " \t\n", "what? ", "É ü.\x0b", "\x1c", "long " * 3000 + "."])
    role = lambda: rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
    rows = [(c, t, role(), text()) for c in range(60) for t in range(rng.randrange(1, 12))]
    rows += [(c, rng.choice([None, 0, 3, 9]), role(), rng.choice([text(), None])) for c in (100, 101, None) for _ in range(9)]
    rows += [(200, t, "user" if t % 2 else "assistant", f"turn {t % 40}.") for t in range(700)]
    rows += [(c, 0, "user", "alone.") for c in range(300, 400)]
    return rows + rng.sample(rows, 30)


def test_query(spark, tmp_path):
    rows = sample()
    conversations(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op12_conversation_repair"](spark, str(tmp_path)).drop("n_rows", "n_repaired").collect()
    assert sorted(map(tuple, got), key=str) == brute(list(damaged(rows)), {r[0] for r in rows})
    dropped = {r[0] for r in rows} - {r[0] for r in damaged(rows)}
    assert dropped and all((r.cost, r.audit) == (0, "") for r in got if r.conv_id in dropped)


@pytest.mark.parametrize(
    "roles, audit",
    [("", ""), ("s", "D"), ("su", "KKI"), ("a", "IK"), ("ua", "KK"), ("uu", "KR"), ("sua", "KKK"), ("au", "IKKI")],
)
def test_small(roles, audit):
    assert cheapest([(r, 0) for r in roles])[1] == audit


def test_undamaged_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello."), (2, 0, "user", "Hi."), (2, 0, "user", "Hi.")]
    table = conversations(spark, rows)
    got = {r.conv_id: (r.cost, r.audit, r.n_repaired, r.duplicate) for r in repair(table, table).collect()}
    assert got == {1: (0, "KK", 2, 0), 2: (7, "KDI", 2, 1)}


def test_empty_table(spark):
    table = conversations(spark, [])
    assert repair(table, table).collect() == []
