"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Fixed rules fail a text (`base_failed`).  Beyond them each signal of `GRIDS` has a cutoff
by stratum (language), chosen on labelled documents: with n good ones, of which a
cutoff would reject k, the exact binomial tail P(Bin(n, alpha) <= k) is the p-value of
"it rejects more than alpha of the good".  Cutoffs are tried from the loosest to the
tightest and the chain stops at the first that is not significant (fixed-sequence
testing); the level is delta by the number of strata and signals (Bonferroni).
With probability 1 - delta no stratum loses more than `ALPHA` of its good documents to all
cutoffs together.  Of the certified cutoffs, the loosest that rejects the most of the
bad is taken, and only where it rejects a larger share of the bad than of the good.

Running sums, sorts and sets stay within one text's arrays; the only exchanges are
the slim join with the labels and counts by stratum.

Defined results: null or wordless text has zeros and base_failed true; a null language is a
stratum of its own; several labels of a document count as its lowest; without
labels no cutoff is certified; repeated rows are judged each; columns of the input
that are named as its results are replaced by them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import GAP, WORD, cut, packed, row_key, unpacked

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
ALPHA, DELTA = 0.02, 0.05
#: signal -> (its value from the counts, cutoffs from loose to tight); a document above a cutoff is rejected.
GRIDS: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / n_words", (3.0, 2.0, 1.5, 1.0, 0.7, 0.5, 0.35, 0.25, 0.15, 0.1)),
    "long_words": ("word_chars / n_words", (60.0, 40.0, 30.0, 24.0, 20.0, 16.0, 14.0, 12.0)),
    "dup_lines": ("n_dup_lines / n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "repeats": ("n_repeat_words / n_words", (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2)),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(text: Column) -> Column:
    """Words that lie in a window of three words found twice or more (windows by 64-bit hash)."""

    def of_windows(h: Column) -> Column:
        sorted_ = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda x, j: F.get(s, j)["h"].eqNullSafe(x["h"])
            twice = F.filter(s, lambda x, j: same(x, j + 1) | same(x, j - 1))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        step = lambda a, p: F.struct(F.greatest(a["end"], p + 3).alias("end"), (a["n"] + p + 3 - F.greatest(a["end"], p)).alias("n"))
        covered = F.aggregate(_let(sorted_, places), F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step)["n"]
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered)

    def of_words(w: Column) -> Column:
        h = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(_let(h, of_windows))

    return _let(F.split(F.btrim(text, F.lit(SPACES)), GAP, -1), of_words)


def signals(text: Column) -> dict[str, Column]:
    """The counts of a text, and n_lines (lines with a word)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    both = _let(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("own")))
    return {
        "n_words": F.regexp_count(text, F.lit(WORD)).cast("bigint"),
        "word_chars": F.length(F.translate(text, SPACES, "")).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
        "__lines": both,
        "n_repeat_words": _repeat_words(text).cast("bigint"),
    }


def measure(docs: DataFrame) -> DataFrame:
    """docs with COUNTS, n_lines and base_failed."""
    out = docs.drop(*COUNTS, "n_lines", "base_failed", "kept").withColumns(signals(F.col("text")))
    out = out.withColumns({"n_lines": F.col("__lines.all").cast("bigint"), "n_dup_lines": (F.col("__lines.all") - F.col("__lines.own")).cast("bigint")}).drop("__lines")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def binomial_tail(n: Column, k: Column, alpha: float) -> Column:
    """P(Bin(n, alpha) <= k), exact, summed in logarithms; 1 where k is above the mean."""
    odds = math.log(alpha / (1 - alpha))

    def step(a: Column, j: Column) -> Column:
        term = a["term"] + F.log((n - j + 1) / j) + F.lit(odds)
        top = F.greatest(a["sum"], term)
        return F.struct(term.alias("term"), (top + F.log1p(F.exp(F.least(a["sum"], term) - top))).alias("sum"))

    first = n * F.lit(math.log1p(-alpha))
    js = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    log_p = F.aggregate(js, F.struct(first.alias("term"), first.alias("sum")), step)["sum"]
    return F.when(k > n * F.lit(alpha), F.lit(1.0)).otherwise(F.exp(log_p))


def _value(signal: str) -> Column:
    top, below = GRIDS[signal][0].split(" / ")
    return F.when(F.col(below) > 0, F.col(top) / F.col(below)).otherwise(F.lit(0.0))


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, signal, cutoff, n_good, k_good, n_bad, k_bad, p) of the chosen cutoffs."""
    truth = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").alias("quality"))
    known = measured.where("not base_failed").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("stratum"), *[_value(s).alias(s) for s in GRIDS]).join(truth, "doc_id")
    each = []
    for s, (_, grid) in GRIDS.items():
        for i, c in enumerate(grid):
            over = F.col(s) > c
            each.append(F.struct(F.lit(s).alias("signal"), F.lit(i).alias("i"), F.lit(c).alias("cutoff"), F.count_if(over & (F.col("quality") > 0)).alias("k_good"), F.count_if(over & (F.col("quality") <= 0)).alias("k_bad")))
    by = known.groupBy("stratum").agg(F.count_if(F.col("quality") > 0).alias("n_good"), F.count_if(F.col("quality") <= 0).alias("n_bad"), F.array(*each).alias("tests"))
    by = cut(by, "counts")
    strata = max(1, by.count())
    tests = by.select("stratum", "n_good", "n_bad", F.explode("tests").alias("t")).select("stratum", "n_good", "n_bad", "t.*")
    tests = tests.withColumn("p", binomial_tail(F.col("n_good"), F.col("k_good"), alpha / len(GRIDS)))
    chain = Window.partitionBy("stratum", "signal").orderBy("i")
    tests = tests.withColumn("certain", F.max("p").over(chain) <= delta / (strata * len(GRIDS)))
    useful = (F.col("n_bad") > 0) & (F.col("k_bad") * F.col("n_good") > F.col("k_good") * F.col("n_bad"))
    best = tests.where("certain").where(useful).groupBy("stratum", "signal").agg(F.max_by(F.struct("cutoff", "n_good", "k_good", "n_bad", "k_bad", "p"), F.struct(F.col("k_bad"), -F.col("i"))).alias("b"))
    return cut(best.select("stratum", "signal", "b.*"), "cutoffs")


def verdicts(measured: DataFrame, chosen: DataFrame) -> DataFrame:
    """measured with kept."""
    wide = chosen.groupBy("stratum").agg(*[F.max(F.when(F.col("signal") == s, F.col("cutoff"))).alias(f"__{s}") for s in GRIDS])
    wide = cut(wide.withColumnRenamed("stratum", "__stratum"), "wide")
    out = measured.join(wide, F.col("lang").cast("string").eqNullSafe(wide["__stratum"]), "left")
    over = F.lit(False)
    for s in GRIDS:
        over = over | F.coalesce(_value(s) > F.col(f"__{s}"), F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & ~over).drop("__stratum", *[f"__{s}" for s in GRIDS])


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text, lang): doc_id, COUNTS, base_failed, kept."""
    measured = cut(measure(docs.select("doc_id", "text", "lang")).drop("text"), "measured")
    out = verdicts(measured, cutoffs(measured, labels))
    return out.select("doc_id", *COUNTS, "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with their columns.

    Only slim rows are written; the texts go through one exchange, against the keys of what
    is rejected (a row's key is 128 bits of its id, text and language).
    """
    keys = row_key("doc_id", "text", "lang")
    measured = cut(measure(docs.select("doc_id", "text", "lang", *[c.alias(k) for k, c in keys.items()])).drop("text"), "measured")
    gone = verdicts(measured, cutoffs(measured, labels)).where("not kept").select(*keys).distinct()
    return packed(docs, **keys).join(gone.hint("shuffle_hash"), list(keys), "left_anti").select(*unpacked(*docs.columns))
