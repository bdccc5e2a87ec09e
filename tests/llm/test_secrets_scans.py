"""A kind's matches are found without a scan that only counts them."""

from pyspark.sql import functions as F

from turnloom.llm.secrets import KINDS, spans

TEXTS = [("", {}), ("no parts", {}), ("A" * 20 + " b" * 40, {}), ("x" * 30, {}), ("TOKEN=abcdefgh stoken: short", {"assign": [(0, 14)]}), ("é ZX12345678901234567 é", {"key_id": [(2, 21)]}), ("see HTTPS://a.b/c://", {"endpoint": [(4, 20)]})]


def test_matches_without_counting(spark):
    df = spark.createDataFrame([(t,) for t, _ in TEXTS], "text string").select("text", *[spans(F.col("text"), k).alias(k) for k in KINDS])
    assert "regexp_count" not in df._jdf.queryExecution().analyzed().toString()
    got = {r["text"]: {k: [(s["start"], s["end"]) for s in r[k]] for k in KINDS if r[k]} for r in df.collect()}
    assert got == dict(TEXTS)
