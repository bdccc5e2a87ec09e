import hashlib
import re

import pytest
from pyspark.sql import functions as F

from turnloom.llm.decontam import contamination, item_windows, remove_contaminated

from .cases import SCHEMA, SF, lower, odd_rows

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return ALNUM.findall(lower(text or ""))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, it in items:
        iw = words(it)
        n = min(13, len(iw))
        grams = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if grams else 0):
            if tuple(w[i : i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(str(item))
    sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(w)


ITEMS = [(1, "The cat, sat: on the MAT"), (2, None), (10, "..."), (11, " ".join(f"b{i}" for i in range(20))), (12, " ".join(f"b{i}" for i in range(5, 30))), (11, "solo")]


def rows():
    extra = [
        (50, "x the CAT sat on   the mat y", None, None, 1), (51, "cat sat on the mat", None, None, 1), (52, " ".join(f"b{i}" for i in range(25)), None, None, 1),
        (53, "b0 b1 solo " + "pad " * 100, None, None, 1), (54, "solo", None, None, 1), (54, "solo", None, None, 1),
    ]
    return odd_rows() + extra


def test_against_brute_force(spark):
    docs, bench = spark.createDataFrame(rows(), SCHEMA), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    want = sorted((r[0] if r[0] is not None else -1, *brute(r[1], ITEMS)) for r in rows())
    for limit in (1_000_000, 0):  # broadcast, and joined behind the bitmap
        got = contamination(docs, bench, max_windows=limit).collect()
        assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, got)) == want


def test_real_documents(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [tuple(r) for r in bench.collect()]
    got = {r[0]: tuple(r)[1:] for r in contamination(docs, bench).collect()}
    assert got == {r["doc_id"]: brute(r["text"], items) for r in docs.collect()}
    assert any(r[4] for r in got.values())


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_removal(spark, limit):
    docs, bench = spark.createDataFrame(rows(), SCHEMA), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = docs.withColumn("n_words", F.lit("own"))
    left = remove_contaminated(docs, bench, mode="documents", max_windows=limit)
    assert left.columns == docs.columns
    assert left.count() == sum(not brute(r[1], ITEMS)[4] for r in rows())
    texts = {r["doc_id"]: r["text"] for r in remove_contaminated(docs, bench, mode="spans", max_windows=limit).where("doc_id >= 50").collect()}
    assert texts[50] == "x  y" and texts[51] == "cat sat on the mat" and texts[54] == ""
    both = remove_contaminated(docs, bench, max_windows=limit).where("doc_id >= 50").collect()
    assert {r["doc_id"]: r["text"] for r in both} == {51: texts[51], 53: "b0 b1  " + "pad " * 100}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    assert contamination(docs, none).where("n_hit > 0").count() == 0
    assert contamination(docs.limit(0), none).collect() == [] and item_windows(none).collect() == []
