import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from turnloom.llm import kernel as K
from turnloom.llm import langid
from turnloom.llm.queries import op1_language_id

from .cases import SCHEMA, odd_rows


def test_held_out_accuracy(spark):
    # the smallest tables hold about 130 texts to learn from
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = op1_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id")
    r = got.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")), F.min("score"), F.max("score"), F.count("*")).first()
    assert r[0] >= 0.98 and 0 <= r[1] <= r[2] <= 1 and r[3] > 200


def test_odd_documents(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA).withColumn("lang_pred", F.lit("own"))
    got = langid.identify(docs, F.lit(False), F.col("doc_id").isNotNull()).collect()
    assert len(got) == len(odd_rows())
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    for i in (0, 1, 2, 7, 16, 17):
        assert by[i]["lang_pred"] == "und" and by[i]["score"] == 0
    assert by[15]["lang_pred"] in {"en", "de", "fr"} and by[13]["lang_pred"] in {"en", "de", "fr"}


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    assert {r["lang_pred"] for r in langid.identify(docs, F.lit(False), F.lit(False)).collect()} == {"und"}
    assert langid.identify(docs.limit(0), F.lit(False), F.lit(True)).collect() == []


def test_one_language_and_unknown_codes(spark):
    docs = spark.createDataFrame([(1, "abc", "xx", "s", 3), (2, "abd", "xx", "s", 3)], SCHEMA)
    assert {r["lang_pred"] for r in langid.identify(docs, F.lit(False), F.lit(True)).collect()} == {"xx"}
    assert langid.family("pt-BR") == "romance" and langid.family("xx") == "other"


def test_svm_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5)).astype(np.float32)
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0, 1.0, -1.0)
    w = langid.svm(x, y)
    assert ((x @ w[:-1] + w[-1] > 0) == (y > 0)).mean() > 0.97


def plain_margins(model, text):
    """Gram by gram, with nothing vectorised; weights and constants are the model's."""
    data = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalpha() else c for c in text.encode())
    total, out = 0, np.zeros(len(model.machines))
    for order in (2, 3, 4):
        for i in range(len(data) - order + 1):
            slot = (int.from_bytes(data[i : i + order], "little") + order - 1) * 2654435761 % (1 << 32)
            slot = ((slot ^ (slot >> 15)) * 2246822519 % (1 << 32)) >> 20
            out += model.weights[slot]
            total += 1
    return out / max(1, total) + model.bias


def test_margins_equal_those_gram_by_gram(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train(docs)
    texts = ["The cat sat.", "Über allen Gipfeln ist Ruh", "x", "日本語 und mehr", "y z " * 40]
    want = [plain_margins(model, t) for t in texts]
    data, offsets, _ = K.buffers(pa.array(texts))
    assert np.allclose(model._margins(data, offsets), want, atol=1e-6)
    monkeypatch.setattr(K, "CHUNK_BYTES", 16)
    for t, w in zip(texts, want, strict=True):  # one by one, in pieces
        data, offsets, _ = K.buffers(pa.array([t]))
        assert np.allclose(model._margins(data, offsets), [w], atol=1e-6)
