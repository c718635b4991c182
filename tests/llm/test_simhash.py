import random

import xxhash
from pyspark.sql import functions as F
from llm_texts import awkward, documents, lower, space_words, words

from stratalake.llm.components import components
from stratalake.llm.simhash import BKTree, fingerprint, hex_fingerprint, keep_one, links_within, near_duplicates, shard_links


def brute_fingerprint(text, k=3):
    w = space_words(lower(text))
    shingles = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, radius):
    """Smallest reachable value of each, by comparing all pairs."""
    top = {v: v for v in values}

    def find(v):
        while top[v] != v:
            v = top[v]
        return v

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def clustered(rng, n):
    values = set()
    while len(values) < n:
        v = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            values.add(v)
            v ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
    return sorted(values)


def test_fingerprint():
    rng = random.Random(1)
    for text in [t for _, t, _ in awkward() if t is None or len(t) < 20_000] + [words(rng, n) for n in (2, 3, 4, 500)]:
        got = fingerprint(None if text is None else text.encode())
        assert got % (1 << 64) == brute_fingerprint(text)
    assert fingerprint(b"") == 0


def test_tree_finds_what_a_scan_finds():
    values = clustered(random.Random(2), 400)
    tree = BKTree()
    for v in values:
        tree.add(v)
    for radius in (0, 1, 2, 5):
        for v in values[::7] + [0]:
            assert sorted(tree.within(v, radius)) == [x for x in values if (x ^ v).bit_count() <= radius]


def test_shard_links_connect_without_pairs():
    near = [1 << k for k in range(50)] + [0]
    assert len(shard_links(near, 2)) == len(near) - 1


def test_links_and_components(spark):
    values = clustered(random.Random(3), 600)
    frame = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    found = {r.node: r.root for r in components(links_within(frame, 2)).collect()}
    want = groups(values, 2)
    sets = lambda of: sorted(sorted(k for k in values if of(k) == r) for r in {of(k) for k in values})
    assert sets(lambda v: found.get(signed(v), signed(v))) == sets(lambda v: want[v])


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(0, 120)] + [(1000, k) for k in range(1001, 1300)] + [(5, 5)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[k] == 0 for k in range(1, 121)) and all(found[k] == 1000 for k in range(1001, 1300))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(spark):
    rows = awkward()
    rng = random.Random(4)
    base = words(rng, 120, 1000).split()
    for k in range(60):
        copy = list(base)
        copy[rng.randrange(120)] = f"changed{k % 7}"
        rows.append((100 + k, " ".join(copy), "en"))
    got = near_duplicates(documents(spark, rows)).select("doc_id", hex_fingerprint(F.col("fp")).alias("f"), "component_id")
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    want = groups(sorted(set(fps)), 2)
    lowest = {}
    for (doc_id, *_), fp in zip(rows, fps):
        if doc_id is not None:
            lowest[want[fp]] = min(doc_id, lowest.get(want[fp], doc_id))
    expected = sorted((str(d), f"{fp:016x}", str(lowest.get(want[fp]))) for (d, *_), fp in zip(rows, fps))
    assert sorted((str(r.doc_id), r.f, str(r.component_id)) for r in got.collect()) == expected


def test_keep_one(spark):
    rows = awkward()
    kept = keep_one(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    want = groups(sorted(set(fps)), 2)
    left = kept.collect()
    assert len(left) == len({want[fp] for fp in fps})
    assert [r.doc_id for r in left if r.text == "same text here and there"] == [14]
    assert {r.doc_id for r in left if not space_words(r.text)} == {1}


def test_empty(spark):
    assert near_duplicates(documents(spark, [])).count() == 0
    assert keep_one(documents(spark, [])).count() == 0
