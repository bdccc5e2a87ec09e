"""URL filters: fixed rules first, else mined association rules.

Spark's FP-growth mines combinations of URL tokens together with the label of labelled
pages; rules {tokens} -> block are pruned by support, by lift and by the lower Wilson
bound of their confidence (a rule that few pages made by chance doesn't pass), and rules
implied by a shorter one of no less confidence are dropped, in Spark, level by level of
their length.  All others are kept, of any number and length.  Pages are matched through
an inverted index (token -> rules; a rule fires when all its tokens were counted), which
is broadcast up to `BROADCAST_RULES` rules; more are joined to the pages, each by the one of
its tokens that fewest rules have.

Tokens: each host suffix, each path segment, the file extension, query keys and the
fragment's presence, with runs of digits as one #.  Frequent tokens that the same labelled
pages hold (told by 128 bits of hashes) are one to the miner: any of them stands for all.

Defined results: a null url or one without :// has an empty host and path, no rule and
no tokens: allow.  Repeated rows are judged each; repeated labels of a page count
as block if any does; without labels no rule is mined; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, map_batches

#: (host, path, verdict); the longest that fits wins.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT = 0.002, 0.6, 1.2
Z = 3.0
#: Up to so many rules are broadcast.
BROADCAST_RULES = 10_000
BLOCK = "label=block"


def split_url(url: str | None) -> tuple[str, str, str]:
    """(host with A-Z lower-cased, path, what follows the path)."""
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    lower = host.translate({c: c + 32 for c in range(65, 91)})
    return lower, path, rest[len(host) + len(path) :]


def tokens(url: str | None) -> list[str]:
    """Distinct tokens of a URL, sorted."""
    host, path, tail = split_url(url)
    if not host and not path and not tail:
        return []
    plain = lambda s: re.sub(r"[0-9]+", "#", s)
    labels = host.split(".")
    out = {"host=" + plain(".".join(labels[i:])) for i in range(len(labels))}
    segments = [s for s in path.split("/") if s]
    out |= {"path=" + plain(s) for s in segments}
    if segments and "." in segments[-1]:
        out.add("ext=" + plain(segments[-1].rsplit(".", 1)[1]))
    query, _, fragment = tail.partition("#")
    out |= {"key=" + plain(p.split("=", 1)[0]) for p in query.removeprefix("?").split("&") if p}
    if fragment:
        out.add("fragment")
    return sorted(out)


@dataclass
class Fixed:
    """The longest of the fixed rules that fits; hosts include their subdomains."""

    rules: tuple[tuple[str, str, str], ...]

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        best: tuple[str | None, str | None] = (None, None)
        for h, p, verdict in self.rules:
            if (host == h or host.endswith("." + h)) and path.startswith(p) and len(h + p) > len(best[0] or ""):
                best = (h + p, verdict)
        return best


class Index:
    """Inverted index of mined rules: a rule fires when each of its tokens is present."""

    def __init__(self, rules: list[tuple[str, ...]]) -> None:
        self.needs = [len(r) for r in rules]
        self.where: dict[str, list[int]] = {}
        for i, rule in enumerate(rules):
            for token in rule:
                self.where.setdefault(token, []).append(i)

    def fires(self, present: list[str]) -> bool:
        met: dict[int, int] = {}
        for token in present:
            for i in self.where.get(token, ()):
                met[i] = met.get(i, 0) + 1
                if met[i] == self.needs[i]:
                    return True
        return False


def _tokens_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [tokens(u) for u in batch.column("url").to_pylist()]
    found = [f + [BLOCK] * b for f, b in zip(found, batch.column("blocked").to_pylist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string()))], names=["items"])


def _same_pages(baskets: DataFrame, least: float) -> dict[str, str]:
    """Token -> first of the tokens that the same baskets hold, for tokens of `least` blocked baskets or more."""
    rows = baskets.withColumn("uid", F.monotonically_increasing_id()).select("uid", F.array_contains("items", BLOCK).cast("int").alias("b"), F.explode("items").alias("t")).where(F.col("t") != BLOCK)
    marks = rows.groupBy("t").agg(F.sum("b").alias("both"), F.count("*").alias("n"), F.bit_xor(F.xxhash64(F.lit(1), "uid")).alias("h1"), F.bit_xor(F.xxhash64(F.lit(2), "uid")).alias("h2"))
    first: dict[tuple, str] = {}
    return {r["t"]: first.setdefault((r["n"], r["h1"], r["h2"]), r["t"]) for r in sorted(marks.where(F.col("both") >= least).collect())}


def _unimplied(sets: DataFrame) -> DataFrame:
    """The passing sets of `sets` (tokens, both, confidence, passes) of which no passing subset has as much confidence.

    Every subset of a frequent set is frequent, so that the best confidence among a set's
    subsets is handed on from sets of one token less.
    """
    key = lambda c: F.array_join(c, "\0")
    sets = cut(sets.withColumn("id", key(F.col("tokens"))), "sets")
    sizes = sorted(r[0] for r in sets.select(F.size("tokens")).distinct().collect())
    kept, below = [], None
    for size in sizes:
        level = sets.where(F.size("tokens") == size)
        if below is None:
            level = level.withColumn("best", F.lit(-1.0))
        else:
            parts = level.select("id", F.explode(F.transform("tokens", lambda t: key(F.array_remove("tokens", t)))).alias("part"))
            best = parts.join(below, "part").groupBy("id").agg(F.max("most").alias("best"))
            level = level.join(best, "id", "left").withColumn("best", F.coalesce("best", F.lit(-1.0)))
        level = cut(level, "level")
        kept.append(level.where(F.col("passes") & (F.col("confidence") > F.col("best"))).select("tokens", "confidence"))
        below = level.select(F.col("id").alias("part"), F.greatest("best", F.when(F.col("passes"), F.col("confidence")).otherwise(-1.0)).alias("most"))
    return cut(reduce(DataFrame.unionByName, kept), "rules")


def learn(pages: DataFrame, bad: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> tuple[dict[str, str], DataFrame | None]:
    """(token -> the token that stands for it, rules (tokens, confidence) over these; None where there is none).

    `bad` has one row (page_id, blocked) per labelled page.  Support is the share of
    labelled pages that hold the tokens and are blocked.
    """
    labelled = pages.select("page_id", "url").join(bad, "page_id")
    baskets = cut(map_batches(labelled.select("url", "blocked"), _tokens_batch, "items array<string>"), "baskets")
    total = baskets.count()
    blocked = baskets.where(F.array_contains("items", BLOCK)).count()
    if not blocked:
        return {}, None
    # tokens of too few blocked pages can't be in a rule, nor can a combination without the label
    same = _same_pages(baskets, min_support * total)
    keep = {*same.values(), BLOCK}
    slim = map_batches(baskets, lambda b: pa.RecordBatch.from_arrays([pa.array([[t for t in x if t in keep] for x in b.column("items").to_pylist()], pa.list_(pa.string()))], names=["items"]), "items array<string>")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(cut(slim.where(F.size("items") > 0), "slim"))
    sets = cut(model.freqItemsets, "itemsets")
    with_label = sets.where(F.array_contains("items", BLOCK) & (F.size("items") > 1)).select(F.array_sort(F.array_remove("items", BLOCK)).alias("tokens"), F.col("freq").alias("both"))
    alone = sets.select(F.array_sort("items").alias("tokens"), F.col("freq").alias("n"))
    rules = with_label.join(alone, "tokens").withColumn("confidence", F.col("both") / F.col("n"))
    p, n = F.col("confidence"), F.col("n")
    lower = (p + Z * Z / (2 * n) - Z * F.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)
    passes = (lower >= min_confidence) & (F.col("confidence") >= MIN_LIFT * blocked / total)
    rules = cut(rules.select("tokens", "confidence", passes.alias("passes")), "candidates")
    return same, _unimplied(rules) if rules.where("passes").count() else None


def mine(pages: DataFrame, bad: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> list[tuple[str, ...]]:
    """The rules of `learn`: token sets whose pages are to be blocked, short ones first."""
    _, rules = learn(pages, bad, min_support, min_confidence)
    rows = rules.collect() if rules is not None else []
    return [tuple(r["tokens"]) for r in sorted(rows, key=lambda r: (len(r["tokens"]), -r["confidence"], r["tokens"]))]


def blocked_ids(labels: DataFrame) -> DataFrame:
    """(page_id, blocked): a page whose document is labelled toxic or of low quality is one to block."""
    bad: Column = (F.coalesce("toxic", F.lit(0)) > 0) | (F.coalesce("quality", F.lit(1)) < 1)
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("page_id")).agg(F.max(bad.cast("int")).alias("blocked"))


OUT = T.StructType([T.StructField("page_id", T.LongType()), *[T.StructField(n, T.StringType()) for n in ("host", "path", "rule", "verdict")], T.StructField("mined", T.BooleanType())])


def _fired(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(uid) of the pages (uid, tokens) that hold all tokens of a rule: joined by the token that fewest rules have."""
    uses = rules.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("uses"))
    named = rules.select(F.monotonically_increasing_id().alias("rule"), F.col("tokens").alias("needs"))
    rarest = cut(named, "needs").withColumn("t", F.explode("needs")).join(uses, "t").groupBy("rule").agg(F.min_by(F.struct("t", "needs"), F.struct("uses", "t")).alias("r")).select("r.*")
    held = pages.select("uid", "tokens", F.explode("tokens").alias("t"))
    return held.join(rarest, (held["t"] == rarest["t"]) & (F.size(F.array_except("needs", "tokens")) == 0), "left_semi").select("uid").distinct()


def judge_urls(pages: DataFrame, bad: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, most: int = BROADCAST_RULES) -> DataFrame:
    """Per row of pages (page_id, url): page_id, host, path, rule, verdict, mined (the method's own verdict is block)."""
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    same, mined = learn(pages, bad)
    few = mined is None or mined.count() <= most
    index = Index([tuple(r["tokens"]) for r in mined.collect()] if few and mined is not None else [])
    shared = pages.sparkSession.sparkContext.broadcast((Fixed(rules), index, same))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fixed, index, same = shared.value
        rows, held = [], []
        for url in batch.column("url").to_pylist():
            host, path, _ = split_url(url)
            rule, verdict = fixed.find(host, path)
            present = sorted({same[t] for t in tokens(url) if t in same})
            fires = index.fires(present)
            rows.append((host, path, rule, verdict or ("block" if fires else "allow"), fires))
            held.append([] if few else present)
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([batch.column("page_id"), *[pa.array(c, pa.string()) for c in cols[:4]], pa.array(cols[4], pa.bool_()), pa.array(held, pa.list_(pa.string()))], names=[*OUT.names, "tokens"])

    out = map_batches(pages, run, T.StructType([*OUT.fields, T.StructField("tokens", T.ArrayType(T.StringType()))]))
    if few:
        return out.drop("tokens")
    out = cut(out.withColumn("uid", F.monotonically_increasing_id()), "judged")
    out = out.join(_fired(out, mined).withColumn("hit", F.lit(True)), "uid", "left").withColumn("mined", F.coalesce("hit", F.lit(False)))
    return out.withColumn("verdict", F.when(F.col("mined") & F.col("rule").isNull(), "block").otherwise(F.col("verdict"))).select(*OUT.names)
