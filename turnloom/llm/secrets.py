"""Secret scans with multipart credential linking, in DataFrame functions only.

Certain kinds (`assign`, `access`, `hex`) are reported wherever they stand.  Weak kinds,
an upper-case key id, a bare mixed-case secret and an endpoint, are reported only
where complementary parts lie in their scope, `SCOPE` code points either side: a
secret needs an identifier or an endpoint, an identifier needs a secret, an endpoint
needs both.  Weak parts have a least length but no greatest.  A weak span that overlaps a certain one is dropped.

Scopes are joined as intervals: every part is put into the buckets of SCOPE code
points that it touches, a weak part into those its scope touches, and an equi-join
on (row, bucket) with the exact interval condition follows.  A bucket holds few parts
by its length, so no text, however long, makes a large group.

Spans have code-point offsets, end exclusive.  Matches come from regexp_extract_all
and the gaps between them from split by the same pattern; offsets are running sums of
both, in blocks of `SUM_BLOCK`.

Defined results: null and empty texts have no spans; rows that repeat are scanned
each for itself; ties of start are ordered by kind as listed; extra columns are
ignored by `find_secrets` and pass through `redact` unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, packed, row_key, unpacked

SCOPE = 256
SUM_BLOCK = 64
KINDS = ("assign", "access", "hex", "key_id", "secret", "endpoint")
BASE = 3
# the first letter is tested before the words are tried
ASSIGN = r"""(?i)(?=[psta])(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind -> (cheap test that any match passes, pattern)
PATTERNS = {
    "assign": (ASSIGN, ASSIGN),
    "access": ("AKIA[A-Z0-9]{12}", "AKIA[A-Z0-9]{12,}"),
    "hex": ("[0-9a-f]{32}", "[0-9a-f]{32,}"),
    "key_id": ("[A-Z0-9]{16}", r"(?<![A-Za-z0-9])(?=[A-Z]*[0-9])(?=[0-9]*[A-Z])[A-Z0-9]{16,}(?![A-Za-z0-9])"),
    "secret": (
        "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24}",
        r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{24,}={0,2}(?![A-Za-z0-9+/_=-])",
    ),
    "endpoint": ("://", r"(?i)https?://[A-Za-z0-9.-]+[^\x00-\x20\"'<>]*"),
}
SPAN = "array<struct<start:int,rank:int,end:int>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(lengths: Column) -> Column:
    """[(start, end)] of the matches from [(gap before, length)], block by block; a block begins at the sum of the blocks before it."""
    last = ((F.size(lengths) - 1) / SUM_BLOCK).cast("int")
    total = lambda c: F.aggregate(F.slice(lengths, c * SUM_BLOCK + 1, F.lit(SUM_BLOCK)), F.lit(0), lambda s, x: s + x["gap"] + x["len"])
    return _let(F.transform(F.sequence(F.lit(0), last), total), lambda sums: _blocks(lengths, sums))


def _blocks(lengths: Column, sums: Column) -> Column:
    def block(_: Column, c: Column) -> Column:
        base = F.aggregate(F.slice(sums, F.lit(1), c), F.lit(0), lambda s, x: s + x)
        first = F.struct(base.alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
        step = lambda s, x: F.struct(
            (s["at"] + x["gap"] + x["len"]).alias("at"),
            F.concat(s["out"], F.array(F.struct((s["at"] + x["gap"]).alias("start"), (s["at"] + x["gap"] + x["len"]).alias("end")))).alias("out"),
        )
        return F.aggregate(F.slice(lengths, c * SUM_BLOCK + 1, F.lit(SUM_BLOCK)), first, step)["out"]

    return F.flatten(F.transform(sums, block))


def spans(text: Column, kind: str) -> Column:
    """array<struct<start, rank, end>> of a kind's matches in text, in order."""
    test, pattern = PATTERNS[kind]
    rank = KINDS.index(kind)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else F.lit(None)

    def place(p: Column) -> Column:
        lengths = F.transform(p["found"], lambda m, i: F.struct(F.length(F.get(p["gaps"], i)).alias("gap"), F.length(m).alias("len")))
        return _let(lengths, lambda le: F.transform(_running(le), lambda s, i: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), ((F.length(F.get(p["value"], i)) >= 8) if kind == "assign" else F.lit(True)).alias("ok"))))

    def made(f: Column) -> Column:
        parts = F.struct(F.split(text, pattern, -1).alias("gaps"), f.alias("found"), value.alias("value"))
        spans = F.transform(F.filter(_let(parts, place), lambda s: s["ok"]), lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))
        return F.when(F.size(f) > 0, spans.cast(SPAN)).otherwise(F.array().cast(SPAN))

    hit = text.contains(test) if kind == "endpoint" else text.rlike(test)
    # the matches themselves tell whether there are any: no scan of its own counts them
    return F.when(hit, _let(found, made)).otherwise(F.array().cast(SPAN)).cast(SPAN)


def scan(docs: DataFrame) -> DataFrame:
    """docs with a row id, and the arrays of certain and of weak spans of their text."""
    by_kind = docs.withColumns({f"__{k}": spans(F.col("text").cast("string"), k) for k in KINDS})
    both = by_kind.withColumn("__certain", F.array_sort(F.concat(*[F.col(f"__{k}") for k in KINDS[:BASE]]))).withColumn("__weak", F.concat(*[F.col(f"__{k}") for k in KINDS[BASE:]]))
    return both.drop(*[f"__{k}" for k in KINDS]).withColumn("__uid", F.monotonically_increasing_id())


def link(scanned: DataFrame) -> DataFrame:
    """(__uid, __linked): the weak spans whose complementary parts co-occur in their scopes."""
    parts = scanned.where((F.size("__weak") > 0) & (F.size("__weak") + F.size("__certain") > 1)).select("__uid", F.explode(F.concat("__certain", "__weak")).alias("p"))
    parts = parts.select("__uid", "p.start", "p.rank", "p.end")
    buckets = lambda a, b: F.explode(F.sequence(F.floor(a / SCOPE), F.floor(b / SCOPE)))
    weak = parts.where(F.col("rank") >= BASE).withColumn("bucket", buckets(F.col("start") - SCOPE, F.col("end") + SCOPE))
    near = parts.select("__uid", F.col("start").alias("s"), F.col("end").alias("e"), F.col("rank").alias("r")).withColumn("bucket", buckets(F.col("s"), F.col("e")))
    meets = (F.col("s") <= F.col("end") + SCOPE) & (F.col("e") >= F.col("start") - SCOPE) & ((F.col("s") != F.col("start")) | (F.col("r") != F.col("rank")))
    joined = weak.join(near, ["__uid", "bucket"]).where(meets)
    role = {name: F.bool_or(F.col("r").isin([KINDS.index(k) for k in kinds])).alias(name) for name, kinds in (("id", ("access", "key_id")), ("key", ("assign", "hex", "secret")), ("place", ("endpoint",)))}
    covered = F.bool_or((F.col("r") < BASE) & (F.col("s") < F.col("end")) & (F.col("e") > F.col("start"))).alias("covered")
    seen = joined.groupBy("__uid", "start", "rank", "end").agg(*role.values(), covered)
    rank = {k: KINDS.index(k) for k in KINDS}
    wanted = (
        F.when(F.col("rank") == rank["secret"], F.col("id") | F.col("place"))
        .when(F.col("rank") == rank["key_id"], F.col("key"))
        .otherwise(F.col("id") & F.col("key"))
    )
    kept = seen.where(wanted & ~F.col("covered"))
    return kept.groupBy("__uid").agg(F.collect_list(F.struct("start", "rank", "end")).cast(SPAN).alias("__linked"))


def _join(array: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    scanned = cut(scan(docs.select("doc_id", "text")).drop("text"), "scanned")
    out = scanned.join(link(scanned), "__uid", "left")
    count = lambda k: F.size(F.filter("__certain", lambda s: s["rank"] == KINDS.index(k))).cast("bigint").alias(f"n_{k}")
    every = F.array_sort(F.concat("__certain", F.coalesce("__linked", F.array().cast(SPAN))))
    return out.select("doc_id", *[count(k) for k in KINDS[:BASE]], F.sha2(_join(F.col("__certain")).cast("binary"), 256).alias("base_sha256"), _join(every).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every reported span of the text replaced by `mark`; overlapping spans become one.

    Only spans are written; the texts go through one exchange, against the rows that
    have spans (a row's key is 128 bits of its id and text).
    """
    keys = row_key("doc_id", "text")
    scanned = cut(scan(docs.select("doc_id", "text", *[c.alias(k) for k, c in keys.items()])).drop("text"), "scanned")
    every = F.array_sort(F.concat("__certain", F.coalesce("__linked", F.array().cast(SPAN))))
    found = scanned.join(link(scanned), "__uid", "left").withColumn("spans", every).where(F.size("spans") > 0)
    found = found.select(*keys, "spans").dropDuplicates(list(keys))
    every = F.col("spans")

    def merge(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), s["rank"].alias("rank"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when(F.size(done) == 0, F.array(s)).when(s["start"] < last["end"], grown).otherwise(F.concat(done, F.array(s))).cast(SPAN)

    def rebuild(m: Column) -> Column:
        piece = lambda s, i: F.concat(_between(F.when(i > 0, F.get(m, i - 1)["end"]).otherwise(F.lit(0)), s["start"]), F.lit(mark))
        return F.concat(F.array_join(F.transform(m, piece), ""), F.substring(F.col("text"), F.element_at(m, -1)["end"] + 1, F.length("text")))

    merged = F.aggregate(every, F.array().cast(SPAN), merge)
    out = packed(docs, text=F.col("text"), **keys).join(found.hint("shuffle_hash"), list(keys), "left")
    clean = F.when(every.isNotNull(), _let(merged, rebuild)).otherwise(F.col("text"))
    return out.select(*[clean.alias(c) if c.lower() == "text" else unpacked(c)[0] for c in docs.columns])


def _between(a: Column, b: Column) -> Column:
    return F.substring(F.col("text"), a + 1, b - a)
