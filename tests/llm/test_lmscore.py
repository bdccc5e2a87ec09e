import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from turnloom.llm import kernel as K
from turnloom.llm import lmscore as L

from .cases import SCHEMA, SF, WORD, lower, odd_rows


def tokens(text):
    return [*WORD.findall(lower(text or "")), None]


def check_base(docs, got, learn):
    counts = Counter()
    for r in docs:
        if learn(r):
            counts.update(tokens(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = []
    for r in docs:
        t = tokens(r[1])
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t)
        want.append((-1 if r[0] is None else r[0], len(t), sum(counts[x] > 0 for x in t), n, round(base, 4)))
    have = [(-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got]
    assert sorted(have) == sorted(want)


@pytest.mark.parametrize("head", [1 << 20, 50, 0])
def test_base_scores(spark, head):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("own"))
    learn = F.col("doc_id").isNotNull() & (F.coalesce("doc_id", F.lit(0)) % 3 != 1)
    got = L.score(docs, F.lit(False), learn, head=head).collect()
    check_base(rows, got, lambda r: r[0] is not None and r[0] % 3 != 1)
    assert all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in got)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    got = L.score(docs, F.lit(False), F.lit(False)).collect()
    assert all(abs(r["bits_per_byte"] - 8) < 0.2 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in got)
    assert L.score(docs.limit(0), F.lit(False), F.lit(True)).collect() == []


def test_learnt_text_is_cheap(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    strange = docs.select((F.col("doc_id") + 10_000).alias("doc_id"), F.reverse(F.upper("text")).alias("text"))
    got = L.score(docs.union(strange), F.lit(False), (F.col("doc_id") < 10_000) & (F.col("doc_id") % 7 < 6)).withColumn("odd", F.col("doc_id") >= 10_000)
    by = {r["odd"]: r["b"] for r in got.where("(doc_id % 10000) % 7 = 6 and n_tokens > 20").groupBy("odd").agg(F.avg("bits_per_byte").alias("b")).collect()}
    assert by[False] < 3.5 < by[True]


def trained():
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["alpha", "beta", "gämma", "δ"], 60)) for _ in range(40)]
    learner = L.Learner()
    learner.learn(*canonical(texts))
    learner.learn(*canonical(texts[::-1]))
    return L.Model(L.stretch_counts(learner.n[::2], learner.n[1::2]), learner.mixer, np.zeros(0, np.int64), np.zeros(0, np.int64), 1, 1)


def canonical(texts):
    data, offsets, _ = K.buffers(pa.array(texts, pa.string()))
    return L.canonical(K.words(data, offsets))


def test_canonical():
    data, offsets = canonical(["A b\t c", None, " \n", "é"])
    assert [data[a:b].tobytes() for a, b in zip(offsets, offsets[1:], strict=False)] == [b"a b c\n", b"\n", b"\n", "é\n".encode()]


def plain_bits(model, text):
    """Bit by bit, in order, with nothing shared."""
    data = (" ".join(WORD.findall(lower(text or ""))) + "\n").encode()
    total, spent = 0.0, 0.0
    for n, byte in enumerate(data):
        history = (b"\n" * 5 + data[:n])[-5:]
        dear = spent - L.DEAR * n > -16 * (2.5 - L.DEAR)
        own = 0.0
        for i in range(8):
            node = np.array([(1 << i) | (byte >> (8 - i))], np.uint64)
            key = np.array([sum(b << (8 * (j + 1)) for j, b in enumerate(history[::-1]))], np.uint64)
            st = [model.look(a) for a in L.bit_slots(L.slots(key), node)]
            dot, _ = model.mixer.mix(i, st)
            bit = (byte >> (7 - i)) & 1
            own += math.log2(1 + math.exp(-dot[0] if bit else dot[0]))
            p = model.mixer.refine(i, dot)[int(dear), 0]
            total -= math.log2(p if bit else 1 - p)
        spent += own
    return total


def test_shared_prediction_equals_bit_by_bit():
    model = trained()
    texts = ["alpha beta", "", "gämma δ unseen Alpha", "z" * 30, "日本 beta beta beta beta beta", None]
    got = model.bits(*canonical(texts))
    assert np.allclose(got, [plain_bits(model, t) for t in texts], rtol=1e-4)
    # more than 128 byte values: the other sort order
    wide = bytes(range(0x80, 0x100)).decode("latin-1") + "".join(map(chr, range(33, 127)))
    both = model.bits(*canonical([*texts, wide]))
    assert np.allclose(both[:-1], got, rtol=1e-5) and abs(both[-1] - plain_bits(model, wide)) < 0.05 * both[-1]


def test_a_long_text_in_pieces_costs_what_it_costs_whole(monkeypatch):
    model = trained()
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["alpha", "beta", "gämma", "ε", "x" * 70], 80)) + end for end in ("", "  \n", " z")]
    for text in [*texts, " " * 500, "y" * 900]:
        data, offsets, _ = K.buffers(pa.array([text], pa.string()))
        whole = model.read(data, offsets)
        monkeypatch.setattr(L, "CHUNK", 120)
        parts = model.read(data, offsets)
        n = len(list(L.long_pieces(data)))
        monkeypatch.undo()
        assert n > 1 or " " not in text.strip()
        assert [x.tolist() for x in parts[:2] + parts[4:5]] == [x.tolist() for x in whole[:2] + whole[4:5]] and np.allclose(parts[3], whole[3], rtol=1e-5)
        assert sorted(parts[5].tolist()) == sorted(whole[5].tolist())


def test_long_texts_are_learnt_alike_whatever_the_pieces(monkeypatch):
    text = " ".join(np.random.default_rng(6).choice(["alpha", "beta", "gämma"], 400))
    data, offsets, _ = K.buffers(pa.array([text], pa.string()))
    whole, parts = L.Learner(), L.Learner()
    whole.learn(*L.canonical(K.words(data, offsets)))
    monkeypatch.setattr(L, "CHUNK", 300)
    for _, piece, skip in L.long_pieces(data):
        parts.learn(piece, np.array([0, len(piece)]), skip)
    assert parts.n.sum() == whole.n.sum() and np.array_equal(parts.n, whole.n)


def test_tree_of_sums(spark):
    rows = [(1, k, 1, np.full(4, i + 1, "<f4").tobytes()) for i in range(9) for k in range(2)] + [(2, 0, 1, np.full(3, 1.0, "<f8").tobytes())] * 9
    parts = spark.createDataFrame(rows, "kind int, key bigint, n bigint, payload binary").repartition(4)
    got = {(r["kind"], r["key"]): bytes(r["payload"]) for r in L._gather(parts, 2)}
    assert np.frombuffer(got[1, 0], "<f4").tolist() == [45.0] * 4 and np.frombuffer(got[2, 0], "<f8").tolist() == [9.0] * 3
    assert set(got) == {(1, 0), (1, 1), (2, 0)}
