import hashlib
import random

from llm_texts import awkward, documents, item_words, words

from stratalake.llm.decontamination import contamination, keep_clean


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def brute(docs, items, window=10):
    found = []
    for doc_id, text, *_ in docs:
        d, hit, ids = item_words(text), set(), set()
        for item_id, item in items:
            w = item_words(item)
            n = min(window, len(w))
            spans = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
            for k in range(len(d) - n + 1) if spans else []:
                if tuple(d[k : k + n]) in spans:
                    hit.update(range(k, k + n))
                    ids.add(item_id)
        found.append((doc_id, len(d), len(hit), sorted(str(i) for i in ids if i is not None)))
    return sorted(found, key=str)


def compare(spark, docs, items):
    got = contamination(documents(spark, docs), benchmark(spark, items)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in got), key=str) == brute(docs, items)
    assert all(r.n_items == len(r.item_ids) for r in got)


def test_random_texts(spark):
    rng = random.Random(3)
    items = [(k, words(rng, rng.choice([1, 2, 3, 5, 9, 10, 11, 25]), 12)) for k in range(30)]
    items += [(7, "another text of item seven"), (None, words(rng, 12, 12)), (40, None), (41, "..!"), (42, items[0][1])]
    docs = []
    for k in range(60):
        parts = [words(rng, rng.randrange(30), 12)]
        if k % 2:
            parts += [rng.choice(items)[1] or "", words(rng, 5, 12)]
        docs.append((k, rng.choice([" ", " - ", "\n"]).join(parts).upper() if k % 3 else " ".join(parts)))
    compare(spark, docs, items)


def test_common_window_in_all(spark):
    passage = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu"
    compare(spark, [(k, f"{k} {passage} {k}") for k in range(40)], [(k, passage) for k in range(12)])


def test_awkward_and_empty(spark):
    docs = awkward()
    items = [(1, docs[3][1][100:400]), (2, "one"), (3, "été über"), (4, "a" * 5000)]
    compare(spark, docs, items)
    compare(spark, docs, [])
    compare(spark, [], items)


def test_keep_clean(spark):
    docs, items = awkward(), [(2, "one two"), (3, "no id at all")]
    kept = keep_clean(documents(spark, docs), benchmark(spark, items))
    assert kept.columns == documents(spark, docs).columns
    dirty = {(9, "one two"), (None, "no id at all")}
    want = sorted((str(d[:2]) for d in docs if d[:2] not in dirty))
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == want


def test_query_digest(spark, tmp_path):
    from stratalake.llm.queries import QUERIES

    documents(spark, [(1, "x one two y"), (2, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    benchmark(spark, [(10, "one two"), (9, "two")]).write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = {r.doc_id: r for r in QUERIES["op1_decontaminate"](spark, str(tmp_path)).collect()}
    assert rows[1].items_sha256 == hashlib.sha256(b"10,9").hexdigest() and rows[1].contaminated
    assert rows[2].items_sha256 == hashlib.sha256(b"").hexdigest() and not rows[2].contaminated
