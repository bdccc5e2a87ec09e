"""The driver's contract: names match, and every oracle agrees on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
ENGINE = sorted(n for n in entry.oracle_sql() if n.startswith("q_"))


def plain(rows):
    return sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in rows)


def test_names():
    queries = entry.queries()
    assert set(entry.oracle_sql()) <= set(queries) and all(callable(f) for f in queries.values()) and len(ENGINE) > 20


@pytest.mark.parametrize("name", ["q_all_turns", "q_issues", "q_dialogue_dataset", "q_artifact_scope", "q_span_marks", "q_sheet_safe", "q_semantic_text", "q_payload_forms", "q_request_rungs", "q_response_rungs", "q_table_errors", "q_blob_round_trip", "q_workbook_round_trip", "q_folder_of_parts", "q_lineage_climb", "q_lineage_spans", "q_lineage_report", "q_faulty_turns", "q_faulty_issues"])
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "documents", "pages", "benchmark", "nation", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert plain(map(tuple, df.select(*columns).collect())) == plain(want)
