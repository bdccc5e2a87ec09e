import math
import re
from collections import Counter

from pyspark.sql import functions as F

from turnloom.llm import quality as Q

from .cases import SCHEMA, WORD, odd_rows

LABELS = "doc_id bigint, quality int, toxic int"


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    win = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen, covered = Counter(win), set()
    for i, x in enumerate(win):
        if seen[x] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def more_rows():
    good = "\n".join(" ".join(f"w{i}{j}" for j in range(12)) for i in range(8))
    return odd_rows() + [
        (60, "a b c a b c", None, None, 1), (61, "a a a a a", None, None, 1), (62, "x\n\nx\n x\nx\r\n", None, None, 1), (63, "#a *b $c %d &e |f <g >h", None, None, 1), (64, good, None, None, 1), (65, good + "\n" + good, None, None, 1),
    ]


def test_counts_against_brute_force(spark):
    rows = more_rows()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("n_words", F.lit("own"))
    got = Q.judge(docs, spark.createDataFrame([], LABELS)).collect()
    want = []
    for r in rows:
        b = brute(r[1])
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        want.append((-1 if r[0] is None else r[0], *b, failed, not failed))
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, got)) == sorted(want)


def test_binomial_tail(spark):
    cases = [(200, 0), (200, 1), (1000, 12), (1000, 20), (50, 3), (5000, 60)]
    df = spark.createDataFrame(cases, "n bigint, k bigint").select("n", "k", Q.binomial_tail(F.col("n"), F.col("k"), 0.02).alias("p"))
    for n, k, p in df.collect():
        exact = sum(math.comb(n, j) * 0.02**j * 0.98 ** (n - j) for j in range(k + 1)) if k <= 0.02 * n else 1.0
        assert math.isclose(p, exact, rel_tol=1e-9)


def labelled(n_good=2500, n_bad=300, share=0.0):
    """Good texts, `share` of which look bad, and bad ones full of symbols, in two languages."""
    text = " ".join(f"word{j}" for j in range(60))
    junk = " ".join(f"w{j}***" for j in range(60))
    rows, labels = [], []
    for i in range(n_good):
        rows.append((i, junk if i < share * n_good else text, "en", "s", 1))
        labels.append((i, 1, 0))
    for i in range(n_bad):
        rows.append((n_good + i, junk, "en", "s", 1))
        labels.append((n_good + i, 0, 0))
    rows += [(10**6, junk, "de", "s", 1), (10**6 + 1, junk, "en", "s", 1), (10**6 + 2, junk, None, "s", 1), (10**6 + 3, text, "en", "s", 1)]
    return rows, [*labels, (0, 1, 0)]


def kept(spark, **how):
    rows, labels = labelled(**how)
    docs, marks = spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(labels, LABELS)
    return docs, marks, {r["doc_id"]: r["kept"] for r in Q.judge(docs, marks).collect()}


def test_certified_cutoffs_reject_junk_of_their_stratum_only(spark):
    docs, marks, got = kept(spark)
    assert not any(got[i] for i in range(2500, 2800)) and all(got[i] for i in range(2500))
    assert got[10**6] and not got[10**6 + 1] and got[10**6 + 2] and got[10**6 + 3]
    left = Q.keep_good(docs, marks)
    assert left.columns == docs.columns and left.count() == sum(got.values())


def test_risk_is_kept(spark):
    # 2 % of the good would be lost, over a quarter of ALPHA: nothing is certified
    _, _, got = kept(spark, share=0.02)
    assert all(got.values())
    # too few labels to be sure of anything
    _, _, got = kept(spark, n_good=300, n_bad=50)
    assert all(got.values())


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    marks = spark.createDataFrame([], LABELS)
    assert Q.judge(docs, marks).collect() == [] and Q.keep_good(docs, marks).collect() == []
