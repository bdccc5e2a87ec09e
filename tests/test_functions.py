import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnloom.functions import ladders as L
from turnloom.functions import payload as P
from turnloom.functions import search as S
from turnloom.functions import text as X

TEXTS = ["", " a ", "\t b \n", "Straße  ẞ", "ΑΣ ὈΔΥΣΣΕΎΣ", "İI ﬁ ŉ", "a\x1cb", "A  B\nC", None, "ÉTION dÉ", "ẞͅ"]


def test_text_equals_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = df.select("i", X.ident(F.col("t")).alias("id"), X.semantic(F.col("t")).alias("sem"), X.casefold(F.col("t")).alias("cf")).orderBy("i").collect()
    for t, r in zip(TEXTS, got, strict=True):
        import re

        plain = t or ""
        assert r["id"] == plain.strip()
        assert r["sem"] == re.sub(r"\s+", " ", plain.strip()).casefold()
        assert r["cf"] == (None if t is None else t.casefold())


def test_integer(spark):
    values = ["12", " 12 ", "+5", "-3", "12.0", "x", "", None, "1.7e18", "9223372036854775808"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    assert [r[0] for r in df.orderBy("i").select(X.integer(F.col("v"))).collect()] == [12, 12, 5, -3, None, None, None, None, None, None]


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ('{"a": 1}', {"a": 1}),
        ("{'a': None, 'b': True}", {"a": None, "b": True}),
        (json.dumps(json.dumps({"a": 1})), {"a": 1}),
        (json.dumps(json.dumps(json.dumps({"a": 1}))[0:0] or json.dumps({"a": 1})), {"a": 1}),
        ('{"a":1} x', '{"a":1} x'),
        ("plain", "plain"),
        (" plain ", " plain "),
        ("[1, 2", "[1, 2"),
        (5, 5),
    ],
)
def test_decode(value, expected):
    assert P.decode(value) == expected


def test_decode_stops_after_three_rounds():
    text = json.dumps({"a": 1})
    for _ in range(2):
        text = json.dumps(text)
    assert P.decode(text) == {"a": 1}
    assert isinstance(P.decode(json.dumps(text)), str)


@settings(max_examples=60, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=8), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.sampled_from(["message", "content", "sender", "conversation_id", "value", "messages", "response", "body", "stage", "x"]), c, max_size=4), max_leaves=12))
def test_read_never_fails(value):
    P.read(json.dumps(value))
    P.read(repr(value))


CASES = [
    # input, output -> request, response
    ("hello", "fine", ("hello", "input_text"), ("fine", "output_text")),
    ("[1", "ok", ("", ""), ("", "")),
    ('{"query": " q "}', '{"answer": "ok"}', ("q", "input_text.query"), ("ok", "output_text.answer")),
    ('{"message": 5, "question": "q2"}', '{"body": "done"}', ("q2", "input_text.question"), ("", "")),
    ('{"messages": [{"role": "User", "content": "u1"}, {"type": "human", "content": "u2"}, {"role": "ai", "content": "a"}]}', '{"messages": [{"role": "assistant", "content": "x"}, {"role": "tool", "content": "y"}]}', ("u2", "input_text.messages[last human].content"), ("x", "output_text.messages[last assistant].content")),
    ('{"body": {"text": "no", "query": "yes"}}', '{"response": {"body": {"answer": "deep"}}}', ("yes", "input_text.body.query"), ("deep", "output_text.response.body.answer")),
    ('{"body": "direct"}', '{"response": {"answer": "flat", "body": {}}}', ("direct", "input_text.body"), ("flat", "output_text.response.answer")),
    ('{"request": "[1]"}', '{"body": "{\\"z\\": 1}"}', ("", ""), ('{"z": 1}', "output_text.body")),
    ("{'query': 'py'}", "{'agent_response': 'repr'}", ("py", "input_text.query"), ("repr", "output_text.agent_response")),
    (None, None, ("", ""), ("", "")),
]


def test_request_and_response_ladders(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _, _) in enumerate(CASES)], "i int, a string, b string")
    df = df.withColumns({"p": P.payload(F.col("a")), "o": P.payload(F.col("b"))})
    for r in df.select("i", L.request(F.col("p")).alias("q"), L.response(F.col("o")).alias("r")).collect():
        assert tuple(r["q"]) == CASES[r["i"]][2], r
        assert tuple(r["r"]) == CASES[r["i"]][3], r


def test_label_splitting(spark):
    parts = [[("a-1", "two words")], [("tok", "tok2")], [("two words", "x y")], [("метка", "ещё текст")]]
    df = spark.createDataFrame([(i, [{"idx": j, "text": t} for j, t in enumerate(p[0])]) for i, p in enumerate(parts)], "i int, parts array<struct<idx:int,text:string>>")
    assert [r[0] for r in df.orderBy("i").select(L.has_label(F.col("parts"))).collect()] == [True, False, False, True]


def test_search():
    assert S.question('{"x": {"query": "deep"}, "dialog": [{"role": "user", "content": "a"}, ["b is longer", "client"]]}') == "a b is longer"
    assert S.question('{"user_query": ["x", {"value": "y"}]}') == "x y"
    assert S.question('{"main_prompt": "m", "messages": [{"role": "user", "text": "t"}]}') == "m"
    assert S.answer('{"z": {"result": "r"}}') == "r"
    nested = "leaf"
    for _ in range(8):
        nested = {"k": nested} if isinstance(nested, dict) else {"answer": nested}
    assert S.answer(json.dumps(nested)) == ""  # deeper than the limit
    assert S.closings('{"a": {"final_response": ["x", "y"]}, "full_answer": {"text": "t"}}') == [{"text": "x", "path": "$.a.final_response"}, {"text": "t", "path": "$.full_answer"}]
    assert S.message_in("start_agent", '{"goal": {"a": null}}') == "{'a': None}"
    assert S.message_in("llm", '[{"content": "c"}]') == "c"
    assert S.message_in("guard", '{"other": 1}') == "{'other': 1}"
    assert S.message_out("start_agent", '{"summary": ["a", 1]}') == "a\n1"
    assert S.message_out("guard", '{"allowed": true}') == "True"
    assert S.message_out("tool", "not json") == "not json"
