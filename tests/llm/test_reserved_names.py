"""Columns that carry names the operators use inside, and the sizes of what they broadcast."""

import itertools

from llm_texts import documents

from stratalake.llm import decontamination
from stratalake.llm.common import free_name
from stratalake.llm.decontamination import contamination, keep_clean
from stratalake.llm.importance import classify, keep_good
from stratalake.llm.licenses import scan
from stratalake.llm.simhash import keep_one

RESERVED = ["__trusted", "__row_key", "__ROW_KEY_", "__found", "__stays", "__folder", "__own", "__nearest"]


def test_free_name():
    assert free_name("a", ["b"]) == "a" and free_name("a", ["A", "a_"]) == "a__"


def test_columns_of_reserved_names_are_kept(spark):
    rows = [(k, f"some words of text number {k} and more of them here") for k in range(8)] + [(3, None), (None, "x")]
    docs = documents(spark, rows, extra=RESERVED)
    labels = spark.createDataFrame([(1, 1), (2, 1), (5, 0)], "doc_id long, quality int")
    bench = spark.createDataFrame([(1, "some words of text number 4 and more of them")], "item_id long, text string")
    for kept, n in ((keep_good(docs, labels), None), (keep_clean(docs, bench), 9), (keep_one(docs), None)):
        assert kept.columns == docs.columns
        found = kept.collect()
        assert found and n in (None, len(found)) and all(r["__row_key"] == r["__trusted"] == "x" for r in found)
    assert classify(docs, labels).count() == len(rows)
    files = docs.withColumnRenamed("source", "path")
    scanned = scan(files)
    assert set(scanned.columns) == {*files.columns, "license", "score", "inherited_from"} - {"text"}
    assert all(r["__own"] == "x" for r in scanned.collect())


def test_what_is_broadcast_is_counted(spark, monkeypatch):
    """Many windows of few different words: few shingles, many rows per window."""
    words = ["a", "b"]
    item = " ".join(w for k in range(9) for p in itertools.product(words, repeat=k + 1) for w in p)[:4000]
    seen = []
    small = decontamination.small

    def counted(frame, rows, bound):
        seen.append((frame.count(), rows))
        return small(frame, rows, bound)

    monkeypatch.setattr(decontamination, "small", counted)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = documents(spark, [(1, item), (2, "a b c")])
    assert [r.n_hit > 0 for r in contamination(docs, bench).orderBy("doc_id").collect()] == [True, False]
    assert len(seen) == 3 and all(rows >= n for n, rows in seen) and seen[2][0] > 100 > seen[0][0]
    # Without room for a broadcast the rows are the same.
    monkeypatch.setattr(decontamination, "BROADCAST_SHINGLES", 3)
    assert [r.n_hit > 0 for r in contamination(docs, bench).orderBy("doc_id").collect()] == [True, False]
    assert keep_clean(docs, bench).count() == 1
