"""Mixing sources to target weights by a time-varying curriculum, in DataFrame functions only.

Each source has a weight that varies over training time t in [0, 1], given by straight
lines between knots: the sources in turn rise, fall or peak in the middle (`SHAPES`), or
follow a schedule of their own.  The integral of a source's weight gives its cumulative
token demand; inverting it at the running token count of the source's documents (in
a fixed hash order, epoch after epoch) assigns each document's training positions,
and documents are range-sorted by position.

Targets share all tokens by weight; no source passes `max_repeats` times its size, the
excess is shared again by weight until none is above (water filling in closed form,
over one row a source).

A document is taken floor(target / size of its source) times, and once more while the
running count lies within what remains; the last document of a source is then taken
in part, so that a source meets its target to the word.  No document is taken more
than `max_repeats` times its size.

Scale: running sums never gather a source in one task.  Documents fall by hash into
about sqrt(rows) runs a source; runs are summed first (before the shuffle), the sums
get a window by source, and only the documents of one run meet in one window: neither
window holds more than about sqrt(rows) rows of a source.  Texts pass two exchanges,
the window's and the range sort's; the ranges are drawn from the runs' positions, so that
the sort needs no sample of the texts.  One slim row a source passes one task.

Defined results: null or blank text has size 0 and is taken 0 words; sources are in
code-point order with null last and weigh 5, 2, 1 in turn; repeated rows are each
a document (equal rows are interchangeable, and ordered by nothing else); all sizes
0 make all targets 0; what is not taken comes last, in hash order; extra columns, of
whatever name, pass through `curriculum`, which adds its own in place of any of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, cut, packed, unpacked

Knots = tuple[tuple[float, float], ...]

CYCLE = (5.0, 2.0, 1.0)
#: Weights over time as (time, weight) knots, each with the integral 1; sources take them in turn.
SHAPES: tuple[Knots, ...] = (
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 0.5), (0.5, 1.5), (1.0, 0.5)),
)
MAX_REPEATS = 3
OWN = ("size", "source_size", "target", "taken", "position", "positions")


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, cycle: tuple[float, ...] = CYCLE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, place, weight, target) of (source, source_size); one row a source."""
    everyone = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(everyone) - 1
    weight = F.element_at(F.array(*map(F.lit, cycle)), (place % len(cycle) + 1).cast("int"))
    s = sizes.withColumn("place", place).withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * max_repeats)
    # sources by how soon they fill; those before the first that can take its share are capped
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum(F.col("source_size").cast("double")).over(Window.partitionBy())
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("turn", F.row_number().over(by_fill)).withColumn("level", level).withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
    # the level of the first that fits holds for all after it
    final = F.min(F.when(F.col("fits"), F.struct(F.col("turn"), F.col("level").alias("level")))).over(Window.partitionBy())
    s = s.withColumn("final", final.getField("level"))
    return s.select("source", "source_size", "place", "weight", F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("final") * F.col("weight"))).alias("target"))


def demand(knots: Knots, t: Column) -> Column:
    """Integral from 0 to t of the piecewise linear weight with these (time, weight) knots, as a share of its whole."""
    parts, whole = F.lit(0.0), 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        if t1 <= t0 or min(w0, w1) < 0:
            raise ValueError("knots need rising times and weights of 0 or more")
        x = F.least(F.greatest(t - t0, F.lit(0.0)), F.lit(t1 - t0))
        parts = parts + x * w0 + x * x * ((w1 - w0) / (t1 - t0) / 2)
        whole += (t1 - t0) * (w0 + w1) / 2
    if whole <= 0:
        raise ValueError("a schedule needs a weight above 0 somewhere")
    return parts / whole


def invert(knots: Knots, share: Column) -> Column:
    """The time at which `demand` reaches a share (0 to 1) of its whole."""
    whole = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False))
    need = share * whole
    out, done = F.lit(float(knots[-1][0])), 0.0
    pieces = []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        area = (t1 - t0) * (w0 + w1) / 2
        slope = (w1 - w0) / (t1 - t0)
        rest = need - done
        # root of w0 x + slope x^2 / 2 = rest, in the form that bears slope 0
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + rest * (2 * slope), F.lit(0.0)))
        x = F.when(F.lit(w0) + root > 0, rest * 2 / (F.lit(w0) + root)).otherwise(F.lit(0.0))
        pieces.append((done + area, F.lit(t0) + F.least(x, F.lit(t1 - t0))))
        done += area
    for reach, x in reversed(pieces):
        out = F.when(need <= reach, x).otherwise(out)
    return out


def curriculum(
    docs: DataFrame, schedules: dict[str | None, Knots] | None = None, cycle: tuple[float, ...] = CYCLE, max_repeats: int = MAX_REPEATS, keep_text: bool = True, shapes: tuple[Knots, ...] = SHAPES
) -> DataFrame:
    """docs with size, source_size, target, taken, position and positions, range-sorted by position.

    Sources in code-point order take the weights of `cycle` and the schedules of `shapes` in turn;
    `schedules` has the knots of those that follow their own.  position is the time of the
    document's first taking (null if it is not taken); `positions` has all of them.  keep_text
    False leaves the text out.
    """
    schedules = schedules or {}
    names = [c for c in docs.columns if c.lower() not in OWN and (keep_text or c.lower() != "text")]
    text, source, id_ = (F.col(c).cast("string") for c in ("text", "source", "doc_id"))
    order = F.md5(F.coalesce(id_, F.concat(F.lit("no id "), F.coalesce(F.xxhash64(text).cast("string"), F.lit("")))))
    runs_log = ((docs.count() or 1).bit_length() + 1) // 2
    run = F.shiftright(F.conv(F.substring(order, 1, 8), 16, 10).cast("bigint"), 32 - runs_log).cast("int")
    base = packed(docs, *names, id=id_, source=source, key=F.coalesce(F.concat(F.lit("s"), source), F.lit("n")), size=words(text), run=run, order=order)
    if not keep_text:
        base = cut(base, "sized")
    plan = _plan(base, schedules, cycle, max_repeats, len(shapes))
    within = Window.partitionBy("key", "run").orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("before") + F.col("inside")
    placed = base.withColumn("inside", F.sum("size").over(within) - F.col("size")).join(plan.drop("n"), ["key", "run"]).withColumn("start", start)
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - full * F.col("source_size")
    part = F.floor(F.least(F.greatest(rest - F.col("start"), F.lit(0.0)), F.col("size").cast("double")))
    times = F.when(F.col("size") > 0, full + F.when(part > 0, 1).otherwise(0)).otherwise(F.lit(0)).cast("int")
    placed = placed.withColumns({"taken": (full * F.col("size") + part).cast("bigint"), "times": times})
    every = F.array(*[_position(schedules, shapes, e) for e in range(max_repeats)])
    placed = placed.withColumn("positions", F.slice(every, F.lit(1), F.col("times"))).withColumn("position", F.get("positions", F.lit(0)))
    bounds, idle = _ranges(plan, schedules, shapes, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    taken = _range_of(F.col("position"), bounds) if bounds else F.lit(0)
    left = len(bounds) + 1 + F.floor(F.conv(F.substring("order", 9, 8), 16, 10).cast("double") / F.lit(2.0**32) * idle)
    ranged = placed.repartitionById(len(bounds) + 1 + idle, F.when(F.col("position").isNotNull(), taken).otherwise(left).cast("int"))
    ranged = ranged.sortWithinPartitions(F.col("position").asc_nulls_last(), F.when(F.col("position").isNull(), F.substring("order", 9, 24)), "id")
    return ranged.select(*unpacked(*names), *OWN)


def _plan(base: DataFrame, schedules: dict[str | None, Knots], cycle: tuple[float, ...], max_repeats: int, shapes: int) -> DataFrame:
    """By run: its words n and those before it, its source's size, target and schedule (`shape`)."""
    sums = cut(base.groupBy("key", "source", "run").agg(F.sum("size").alias("n")), "sums")
    plan = targets(sums.groupBy("source").agg(F.sum("n").alias("source_size")), cycle, max_repeats)
    earlier = F.sum("n").over(Window.partitionBy("key").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    plan = plan.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("key"), "source_size", "target", (F.col("place") % shapes).cast("int").alias("shape"))
    own = F.lit(None).cast("int")
    for i, name in enumerate(schedules):
        own = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(-1 - i)).otherwise(own)
    sums = sums.select("key", "run", "n", F.coalesce(earlier, F.lit(0)).alias("before"), own.alias("own"))
    return cut(sums.join(plan, "key").select("key", "run", "n", "before", "source_size", "target", F.coalesce("own", "shape").alias("shape")), "plan")


def _position(schedules: dict[str | None, Knots], shapes: tuple[Knots, ...], epoch: int) -> Column:
    """The time at which the source's cumulative demand reaches `start` words of an epoch."""
    share = F.when(F.col("target") > 0, F.least((F.col("start") + epoch * F.col("source_size")) / F.col("target"), F.lit(1.0))).otherwise(F.lit(0.0))
    out = F.lit(None).cast("double")
    for number, knots in [*enumerate(shapes), *((-1 - i, k) for i, k in enumerate(schedules.values()))]:
        out = F.when(F.col("shape") == number, invert(knots, share)).otherwise(out)
    return out


def _range_of(position: Column, bounds: list[float]) -> Column:
    """How many of the bounds, in order, are at or below the position: by halving."""
    table = F.array(*map(F.lit, bounds))

    def step(s: Column, _: Column) -> Column:
        middle = F.shiftright(s["low"] + s["high"], 1)
        right = F.get(table, middle) <= position
        halves = F.struct(F.when(right, middle + 1).otherwise(s["low"]).alias("low"), F.when(right, s["high"]).otherwise(middle).alias("high"))
        return F.when(s["low"] < s["high"], halves).otherwise(s)

    first = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(len(bounds).bit_length())), first, step)["low"]


def _ranges(plan: DataFrame, schedules: dict[str | None, Knots], shapes: tuple[Knots, ...], parts: int) -> tuple[list[float], int]:
    """(bounds of position that deal the taken words over `parts` ranges, number of partitions for what is not taken)."""
    runs = plan.withColumn("start", F.col("before")).withColumn("idle", (F.col("before") >= F.col("target")) | (F.col("n") == 0))
    one = runs.agg(F.count("*").alias("runs"), F.sum("n").alias("n"), F.sum(F.when(F.col("idle"), F.col("n"))).alias("idle")).first()
    if not one["n"]:
        return [], 1
    mean = one["n"] / one["runs"]
    busy = runs.where("not idle").withColumn("position", _position(schedules, shapes, 0)).select("position", F.explode(F.sequence(F.lit(1), F.ceil(F.col("n") / mean).cast("int"))))
    found = busy.agg(F.percentile_approx("position", [i / parts for i in range(1, parts)], 10 * max(parts, 100)).alias("b")).first()["b"] if parts > 1 else []
    return sorted(set(found or [])), max(1, -(-parts * (one["idle"] or 0) // one["n"]))
