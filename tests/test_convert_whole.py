"""A conversion's report over more issues than it shows examples of."""

from pyspark.sql import functions as F

from turnloom.fixtures import spans_from_conversations, with_failing_gates
from turnloom.plans.convert import convert, issue_summary
from turnloom.plans.extract import Config, extract_turns

from .test_extract import SCHEMA, entry, leave, rows, span
from .test_project import VERDICT, metric

N = 150


def converted(spark):
    quiet = [span(f"t{i:03}", "m", kind="llm") for i in range(N)]
    asked = [span(f"u{i:03}", "m", 'a "reply_with" b', kind="llm") for i in range(N)]
    return convert(spark, spark.createDataFrame([entry("g1", "r", "q"), leave("g1", "r", "a"), *quiet, *asked], SCHEMA), metric(method="identity"), VERDICT)


def test_all_issues_are_counted(spark):
    report = converted(spark)["report"]
    assert report["issues"]["counts"] == {"no_boundary_span": N, "unsupported_trace_schema": N} and report["extraction"]["issue_rows"] == 2 * N


def test_issues_beyond_the_examples_are_returned(spark):
    made = converted(spark)
    shown = made["report"]["issues"]
    assert len(shown["examples"]) == 100 and shown["examples_truncated"]
    assert {(r["issue_code"], r["trace_id"]) for r in made["issues"].collect()} == {(c, f"{t}{i:03}") for c, t in (("no_boundary_span", "t"), ("unsupported_trace_schema", "u")) for i in range(N)}
    assert [tuple(r) for r in made["counterparts"].collect()] == [("user", 1)]


def test_spans_are_computed_once(spark):
    """Turns, report and issues come from one pass over the spans."""
    passed = spark.sparkContext.accumulator(0)

    def tell(agent):
        passed.add(1)
        return agent

    spans = spark.createDataFrame(rows(), SCHEMA)
    n = spans.count()
    x = extract_turns(spans.withColumn("agent_id", F.udf(tell, "string").asNondeterministic()("agent_id")), Config("A", None))
    x.turns.count(), x.report, issue_summary(x.issues)
    assert passed.value == n


def test_faulty_spans_compute_their_input_once(spark):
    passed = spark.sparkContext.accumulator(0)

    def tell(agent):
        passed.add(1)
        return agent

    spans = spans_from_conversations(spark, "/root/testdata/sf0.001")
    n = spans.count()
    assert with_failing_gates(spans.withColumn("agent_id", F.udf(tell, "string").asNondeterministic()("agent_id"))).count() > 0
    assert passed.value == n
