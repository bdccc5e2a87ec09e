import hashlib

import pytest
from pyspark.sql import functions as F

from turnloom.llm import mixture as M

from .cases import CLASHES, SCHEMA, SF, WORD, odd_rows


def fill(sizes):
    """Targets by rounds of resharing."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, active, out = float(sum(sizes.values())), set(names), {}
    while active:
        total = sum(weight[s] for s in active)
        over = [s for s in active if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in active}
            break
        for s in over:
            out[s] = 3.0 * sizes[s]
            active.discard(s)
        left -= sum(out[s] for s in over)
    return out


def check(docs, rows):
    got = M.curriculum(docs, keep_text=False).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, _, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want, taken = fill(sizes), {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["taken"] > 0) == (r["position"] is not None) and all(0 <= p <= 1 for p in r["positions"])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, t in taken.items():
        assert abs(t - want[s]) <= 1
    place = [r["position"] for r in got if r["position"] is not None]
    assert place == sorted(place)
    return got


def test_odd_documents(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA).withColumns({"taken": F.lit("own"), "target": F.lit(1)})
    first = check(docs, odd_rows())
    again = M.curriculum(docs.repartition(7), keep_text=False).collect()
    key = lambda rows: sorted((repr(r["doc_id"]), r["size"], r["taken"], repr(r["position"])) for r in rows)
    assert key(first) == key(again)


def test_real_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(docs, [tuple(r) for r in docs.collect()])
    assert M.curriculum(docs).columns[:5] == docs.columns


def test_capped_sources(spark):
    rows = [(i, "w " * n, None, s, 1) for i, (s, n) in enumerate([("a", 3), ("b", 50), ("c", 5), ("d", 1), ("e", 400), (None, 7), ("f", 0)])]
    check(spark.createDataFrame(rows, SCHEMA), rows)


def test_empty_table(spark):
    assert M.curriculum(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "", None, "a", 1), (2, None, None, None, 1)]
    assert {r["target"] for r in M.curriculum(spark.createDataFrame(rows, SCHEMA)).collect()} == {0.0}


def test_schedules_are_inverted(spark):
    knots = [(0.0, 1.0), (0.25, 3.0), (0.5, 0.0), (1.0, 2.0)]
    df = spark.range(101).select((F.col("id") / 100).alias("share"))
    got = df.select("share", M.demand(knots, M.invert(knots, F.col("share"))).alias("back"), M.invert(knots, F.col("share")).alias("t")).collect()
    assert all(abs(r["back"] - r["share"]) < 1e-9 for r in got) and [r["t"] for r in got] == sorted(r["t"] for r in got)
    for bad in ([(0.0, 1.0), (0.0, 2.0)], [(0.0, 0.0), (1.0, 0.0)], [(0.0, -1.0), (1.0, 1.0)]):
        with pytest.raises(ValueError):
            M.demand(bad, F.lit(0.5))


def test_a_late_source_comes_late(spark):
    rows = [(i, "w " * 10, None, "ab"[i % 2], 1) for i in range(400)]
    got = M.curriculum(spark.createDataFrame(rows, SCHEMA), {"a": [(0.0, 1.0), (1.0, 1.0)], "b": [(0.0, 0.0), (1.0, 1.0)]}, cycle=(1.0,)).collect()
    mean = {s: sum(r["position"] for r in got if r["source"] == s) / 200 for s in "ab"}
    assert mean["b"] > mean["a"] + 0.1


def reached(knots, share):
    """The time at which the integral of the weight reaches a share of its whole, by bisection."""

    def area(t):
        out = 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
            x = min(max(t - t0, 0.0), t1 - t0)
            out += x * (w0 + (w0 + (w1 - w0) * x / (t1 - t0))) / 2
        return out

    low, high, want = 0.0, 1.0, share * area(1.0)
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if area(middle) < want else (low, middle)
    return high


def places(rows, shapes):
    """{doc_id: positions} by walking each source's documents in hash order."""
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = {i: len(WORD.findall(t or "")) for i, t, *_ in rows}
    total = {s: sum(sizes[r[0]] for r in rows if r[3] == s) for s in names}
    want, out = fill(total), {}
    for n, s in enumerate(names):
        mine, at = sorted((r[0] for r in rows if r[3] == s), key=lambda i: hashlib.md5(str(i).encode()).hexdigest()), 0
        for i in mine:
            out[i] = [reached(shapes[n % len(shapes)], (at + e * total[s]) / want[s]) for e in range(3) if sizes[i] and at + e * total[s] < int(want[s] + 1e-9)]
            at += sizes[i]
    return out


def test_positions_invert_the_schedules(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    got = {r["doc_id"]: r["positions"] for r in M.curriculum(docs, keep_text=False).collect()}
    want, even = places(rows, M.SHAPES), places(rows, (((0.0, 1.0), (1.0, 1.0)),))
    assert all(got[i] == pytest.approx(want[i], abs=1e-6) for i in want)
    assert any(got[i] != pytest.approx(even[i], abs=1e-2) for i in want)


def test_columns_named_like_the_operator(spark):
    rows = [(i, "w " * (i % 7), None, "ab"[i % 2], 1) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in CLASHES})
    got = M.curriculum(docs).collect()
    assert len(got) == 60 and all(r[c] == c for r in got for c in CLASHES)


def test_the_range_of_a_position(spark):
    for bounds in ([0.5], [0.1, 0.2], [i / 37 for i in range(1, 37)]):
        got = spark.range(201).select((F.col("id") / 200).alias("p")).select("p", M._range_of(F.col("p"), bounds).alias("n")).collect()
        assert all(r["n"] == sum(b <= r["p"] for b in bounds) for r in got)
