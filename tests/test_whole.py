"""Queries that take every row, against plain Python on the smallest tables."""

import re

from turnloom.plans import queries as Q
from turnloom.plans.extract import Config, extract_turns

SF = "/root/testdata/sf0.001"


def user_turns(spark):
    """(conversation, turn, text, answer or None) of each user turn."""
    by = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        by.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    for c, rows in by.items():
        rows.sort(key=lambda r: r[0])
        for (k, role, text), after in zip(rows, [*rows[1:], (None, None, None)], strict=True):
            if role == "user":
                yield c, k, text, after[2] if after[1] == "assistant" else None


def test_lineage_datasets_hold_all_sessions(spark):
    want, sessions = set(), {}
    for c, k, text, ans in user_turns(spark):
        label, f = ("alpha", "beta", "gamma")[k % 3], c % 6
        sessions[f"s{c}"] = sessions.get(f"s{c}", 0) + (f in (0, 2, 3, 4))
        said = lambda *x: {"message": [{"type": "text", "value": y} for y in x]}
        ask = {"performative": "request", "conversation_id": f"c{c}", "reply_with": f"r{k}", "sender": "user", "receiver": "agent", "content": said(text)}
        hand = {"performative": "request", "conversation_id": f"c{c}", "reply_with": f"d{k}", "sender": "agent", "receiver": "worker", "content": said(label, text)}
        pair = {0: (str(ask), str({"outgoing": hand})), 2: (text, "{}" if ans is None else ans), 3: (f"{label} {text}", "{}"), 4: (f"alpha {text}", "{}")}.get(f)
        if pair:
            want.add((f"s{c}", f"t-{c}-{k}", *pair, "", str({"final_response": [ans]}) if f == 4 and ans is not None else None))
    got = [tuple(r) for r in Q.q_lineage_qa(spark, SF).collect()]
    assert len(got) == len(want) and set(got) == want
    assert {r["session_id"]: r["n_turns"] for r in Q.q_lineage_dialogues(spark, SF).collect()} == sessions


def test_semantic_text_of_every_row(spark, tmp_path):
    texts = [None, "", "Straße " * 9 + "STRASSE  ẞ", "x" * 30 + " \t\x1c\n Y\xa0 Ǆ ŉ ﬁ ΑΣ ", "\x85a" + "İ" * 40]
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-1, i, "user", t) for i, t in enumerate(texts)], "conv_id bigint, turn bigint, role string, text string")
    rows.union(odd).write.parquet(f"{tmp_path}/conversations.parquet")
    got = Q.q_semantic_text(spark, str(tmp_path)).collect()
    fold = lambda t: re.sub(r"\s+", " ", (t or "").strip()).casefold()
    assert sorted(tuple(r) for r in got) == sorted((r["conv_id"], r["turn"], fold(r["text"])) for r in rows.union(odd).collect())


def test_sheet_safe_takes_whole_texts(spark, tmp_path):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "=" * 40 + "".join(map(chr, range(1, 40))) + "\x7f\x85é😀" + "\x00z")], "doc_id bigint, text string")
    rows.union(odd).write.parquet(f"{tmp_path}/documents.parquet")
    clean = lambda t: re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ", f"=\x01{t}\x0b.")
    want = {r["doc_id"]: None if r["text"] is None else clean(r["text"]) for r in rows.union(odd).collect()}
    got = Q.q_sheet_safe(spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {r["doc_id"]: r["cell"] for r in got} == want


def test_issues_have_no_limit(spark, monkeypatch):
    columns = "'t' || id trace_id, 'm' span_id, 'A' agent_id, 's' session_id, 'llm' aef_kind, 'x' span_name, 'i' input_text, 'o' output_text, id start_time_ns, id end_time_ns, '' parent_span_id"
    x, made = extract_turns(spark.range(150).selectExpr(*columns.split(", ")), Config("", None)), []
    monkeypatch.setattr(Q, "extract_turns", lambda spans, config: made.append(config.max_issue_examples) or x)
    assert [tuple(r) for r in Q.q_issue_summary(spark, SF).collect()] == [("no_boundary_span", 150)]
    Q.q_issues(spark, SF)
    assert made == [None, None]
