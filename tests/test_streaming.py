from turnloom.fixtures import AGENT, spans_from_conversations
from turnloom.plans.extract import Config, extract_turns
from turnloom.streaming.pairs import pair_stream

SF = "/root/testdata/sf0.001"


def test_stream_pairs_equal_the_batch(spark, tmp_path):
    spans = spans_from_conversations(spark, SF).where(f"agent_id = '{AGENT}'")
    path = str(tmp_path / "in")
    spans.repartition(3).write.parquet(path)
    x = extract_turns(spans, Config(AGENT))
    stream = spark.readStream.schema(spans.schema).option("maxFilesPerTrigger", 1).parquet(path)
    # one conversation lies hours before the next: the watermark must not drop the earlier one
    query = pair_stream(stream, x.counterparts.select("party"), watermark="300 days").writeStream.format("memory").queryName("pairs").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(180)
    got = {r["turn_id"]: r["agent_response"] for r in spark.table("pairs").where("agent_response is not null").collect()}
    assert got == {r["turn_id"]: r["agent_response"] for r in x.exchange_turns.collect()}
