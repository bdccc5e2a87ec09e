import random

from turnloom.llm import neardup
from turnloom.llm.neardup import components, keep_first, near_duplicates

from .cases import SCHEMA, SF, odd_rows, shingles, similar_components


def check(spark, rows, k):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = near_duplicates(docs, k).collect()
    want = similar_components(rows, k)
    assert len(got) == len(rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r[0], []).append(len(shingles(r[1], k)))
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == want[r["doc_id"]])
            assert r["n_shingles"] in by_id[r["doc_id"]]
    return docs, got


def test_odd_documents(spark):
    docs, _ = check(spark, odd_rows(), 4)
    left = keep_first(docs, 4)
    assert left.columns == docs.columns and {r["text"] is None for r in left.where("doc_id = 0").collect()} == {True}


def test_real_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(spark, rows, 5)


def test_a_large_group_that_one_leader_does_not_link(spark, monkeypatch):
    # copies of one text with 2 to 12 changed words: many are linked through others only
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(90):
        words = list(base)
        for at in rng.sample(range(90), rng.randint(0, 6)):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words), "en", "s", 1))
    check(spark, rows, 3)


def test_recall_at_the_floor_and_without_it(spark, monkeypatch):
    """Texts at a similarity of 0.8 to 0.9: the floor loses no link that floor 0, the exact way, finds."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "SHINGLES", 1500)
    rng = random.Random(8)
    rows = []
    for group in range(12):
        base = [f"g{group}w{i}" for i in range(100)]
        for i in range(14):
            words = list(base)
            for at in rng.sample(range(5, 95), rng.choice([1, 2, 3])):
                words[at] = f"x{i}_{at}"
            rows.append((group * 100 + i, " ".join(words), "en", "s", 1))
    docs, want = spark.createDataFrame(rows, SCHEMA), similar_components(rows, 3)
    for floor in (neardup.FLOOR, 0.0):
        assert {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, 3, floor=floor).collect()} == want
    assert 12 < len(set(want.values())) < len(rows)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
