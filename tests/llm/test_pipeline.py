"""Each stage against its plain version, on the rows its predecessor kept."""

import corpus_pipeline as P
import duckdb
import pytest
from pyspark.sql import functions as F

from turnloom.llm.common import cut
from turnloom.llm.queries import ORACLES, QUERIES

from .cases import CLASHES, SCHEMA, SF, odd_rows, similar_components
from .test_decontam import brute as leak
from .test_quality import brute as counts
from .test_secrets import base


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    steps = dict(P.STAGES)
    assert len(P.STAGES) == 5 and P.ORACLE_SQL is None

    def step(name, docs):
        out = cut(steps[name](spark, docs, SF), name)
        if name != P.STAGES[-1][0]:
            assert out.columns == columns
        return out, {r["doc_id"]: r for r in out.collect()}

    rows = {r["doc_id"]: r for r in docs.collect()}
    out, left = step("quality_rules", docs)
    failed = {i for i, r in rows.items() if (c := counts(r["text"]))[0] < 50 or 100 * c[4] > 50 * c[0]}
    assert set(left) == set(rows) - failed  # too few labels here for a certified cutoff
    comp = similar_components([tuple(r) for r in left.values()], 5)
    out, left = step("minhash_neardup", out)
    assert set(left) == {i for i, c in comp.items() if i == c}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i, r in left.items() if not leak(r["text"], items)[4]}
    out, left = step("decontamination", out)
    assert set(left) == clean
    before = left
    out, left = step("secret_scan", out)
    assert set(left) == set(before) and not any(base(r["text"]) for r in left.values())
    assert all(left[i]["text"] == r["text"] or base(r["text"]) for i, r in before.items())
    mixed = steps["curriculum_mix"](spark, out, SF).collect()
    assert {r["doc_id"] for r in mixed} == set(left) and abs(sum(r["taken"] for r in mixed) - sum(r["size"] for r in mixed)) < 30
    whole = P.run(spark, SF)
    assert whole.agg(F.sum("taken")).first()[0] == sum(r["taken"] for r in mixed)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_a_stage_bears_clashing_columns_and_no_rows(spark, name):
    """A caller's columns come back as they are, whatever their names; an empty table stays empty."""
    stage, names = dict(P.STAGES)[name], [c for c in CLASHES if c not in ("n_words",)]
    docs = spark.createDataFrame(odd_rows(), SCHEMA).withColumns({c: F.concat(F.lit(f"{c} "), F.coalesce("doc_id", F.lit(-1))) for c in names})
    plain = {repr(r["doc_id"]): r for r in stage(spark, spark.createDataFrame(odd_rows(), SCHEMA), SF).collect()}
    got = stage(spark, docs, SF).collect()
    assert {repr(r["doc_id"]) for r in got} == set(plain)
    assert all(r[c] == f"{c} {-1 if r['doc_id'] is None else r['doc_id']}" for r in got for c in names)
    assert stage(spark, docs.limit(0), SF).collect() == []
