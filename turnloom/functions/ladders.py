"""Which field of a decoded payload wins: ordered choices as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import filled, semantic

#: Answers that only acknowledge.
ACKS = ("ok", "success", "done", "accepted", "processing", "true", "false")
#: Keys in the order in which they are asked.
QUERY_KEYS = ("message", "query", "question", "user_query", "input_query", "text")
NESTED_QUERY_KEYS = QUERY_KEYS[:-1]
ANSWER_KEYS = ("answer", "agent_response", "output_answer", "final_response", "message_to_user")
LABEL = r"(?U)^[\w.:-]{1,64}$"
JOINT = "\n\n"
CHOICE = "struct<text:string,path:string>"


def choose(options: list[tuple[Column, str]]) -> Column:
    """struct(text, path) of the first option with a text; blanks where none has."""
    found = [F.when(filled(text).isNotNull(), F.struct(text.alias("text"), F.lit(path).alias("path"))) for text, path in options]
    return F.coalesce(*found, F.struct(F.lit("").alias("text"), F.lit("").alias("path")))


def plain(text: Column) -> Column:
    """The text unless it looks like a JSON value."""
    return F.when(~F.substring(text, 1, 1).isin("[", "{"), text)


def said(text: Column) -> Column:
    """The text unless it is a mere acknowledgement."""
    return F.when(~semantic(text).isin(*ACKS), text)


def at(fields: Column, key: str) -> Column:
    return F.try_element_at(fields, F.lit(key))


def last_said(messages: Column, *roles: str) -> Column:
    """Content of the last message by one of the roles."""
    return F.try_element_at(F.filter(messages, lambda m: m["role"].isin(*roles)), F.lit(-1))["content"]


def request(p: Column) -> Column:
    """(text, path) of what the user asks in an input payload."""
    is_text, is_object = p["shape"] == "text", p["shape"] == "object"
    top = [(at(p["fields"], k), f"input_text.{k}") for k in QUERY_KEYS]
    inner = []
    for part in ("body", "request"):
        inner.append((plain(at(p["fields"], part)), f"input_text.{part}"))
        inner += [(at(p[part], k), f"input_text.{part}.{k}") for k in NESTED_QUERY_KEYS]
    options = [*top, (last_said(p["messages"], "human", "user"), "input_text.messages[last human].content"), *inner]
    return choose([(F.when(is_text, plain(p["text"])), "input_text"), *[(F.when(is_object, t), path) for t, path in options]])


def response(p: Column) -> Column:
    """(text, path) of what the agent answers in an output payload."""
    is_text, is_object = p["shape"] == "text", p["shape"] == "object"
    top = [(at(p["fields"], k), f"output_text.{k}") for k in ANSWER_KEYS]
    body = [(at(p["body"], k), f"output_text.body.{k}") for k in ANSWER_KEYS]
    has_inner = p["response_body"].isNotNull()
    inner = [(at(p["response_body"], k), f"output_text.response.body.{k}") for k in ANSWER_KEYS]
    outer = [(F.when(~has_inner, at(p["response"], k)), f"output_text.response.{k}") for k in ANSWER_KEYS]
    options = [
        *top,
        (last_said(p["messages"], "assistant", "ai", "agent"), "output_text.messages[last assistant].content"),
        *body,
        (said(at(p["fields"], "body")), "output_text.body"),
        *inner,
        *outer,
        (said(at(p["response"], "body")), "output_text.response.body"),
    ]
    return choose([(F.when(is_text, said(plain(p["text"]))), "output_text"), *[(F.when(is_object, t), path) for t, path in options]])


def joined(parts: Column) -> Column:
    """All text parts of a message, as one text."""
    return F.coalesce(F.array_join(F.transform(parts, lambda x: x["text"]), JOINT), F.lit(""))


def has_label(parts: Column) -> Column:
    """Whether the parts are [label, text...]: the first is one token, the last is not."""
    first, last = F.get(parts, F.lit(0))["text"], F.try_element_at(parts, F.lit(-1))["text"]
    return F.coalesce((F.size(parts) >= 2) & first.rlike(LABEL) & ~last.rlike(LABEL), F.lit(False))


def asks(e: Column) -> Column:
    """A request: said so, or, where nothing is said, one that awaits a reply and is none."""
    act = F.lower(e["performative"])
    return F.coalesce(F.when(act != "", act == "request").otherwise((e["reply_with"] != "") & (e["in_reply_to"] == "")), F.lit(False))


def replies(e: Column) -> Column:
    return F.coalesce((F.lower(e["performative"]) != "request") & (e["in_reply_to"] != ""), F.lit(False))


def incoming(p: Column) -> Column:
    """struct(env, path): the message an input payload carries, or null."""
    return _envelope(p, (("message", "input_text.message"), ("incoming", "input_text.incoming"), ("own", "input_text")))


def outgoing(p: Column) -> Column:
    return _envelope(p, (("outgoing", "output_text.outgoing"), ("own", "output_text")))


def _envelope(p: Column, order: tuple[tuple[str, str], ...]) -> Column:
    return F.coalesce(*[F.when(p[k].isNotNull(), F.struct(p[k].alias("env"), F.lit(path).alias("path"))) for k, path in order])
