"""MinHash near-deduplication by fast similarity sketching.

Sets of word shingles are sketched (`kernel.sketch`: hashed bin placement in
rounds, so that every coordinate fills and the estimate keeps its concentration
bounds), cut into bands, and every link is confirmed on the full sets.

How groups of any size are handled, without pairs of all their members:

1. Equal sets (128 bits of set hash and the size) collapse to their least id.
2. In every band bucket the most central member (the one whose buckets are
   largest in sum) is compared with all others: as many pairs as rows.
3. Buckets whose members are by then in one component are settled.  In the rest
   the members are dealt into blocks of about `BLOCK` rows and `SHINGLES` shingles; each pair of
   blocks is one bounded task, which passes over pairs already in one component, over
   those that share an open bucket of a lesser number (they are verified there) and
   over those whose sketches agree in less than `floor` of their coordinates,
   verifies the others on the full sets, and returns a spanning forest only.

A linked pair (similarity 0.8) shares no band with probability
(1 - 0.8^4)^32 < 5e-8, and is passed over in step 3 (128 coordinates, floor
0.58, over six standard deviations) with less than 1e-8; with floor 0 none is passed over.

Defined results: null or blank text has no shingles, links with nothing and is
kept; rows that share a doc_id are one node with the links of all of them; a
row with a null doc_id links with nothing (component_id null, kept true).
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .common import cut, map_batches, quoted

T, BANDS = 128, 32
BLOCK, SHINGLES = 512, 1 << 19
FLOOR = 0.58


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def _sets(batch: pa.RecordBatch, k: int):
    data, offsets, _ = K.buffers(batch.column("text"))
    for a, b in K.chunks(offsets):
        w = K.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        g, r = K.row_grams(K.word_hashes(w), w.first, k)
        yield a, b, *K.row_sets(g, r, b - a)


def _sketches(k: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, s1, s2, bands = [], [], [], []
        for _a, _b, values, offsets in _sets(batch, k):
            n.append(np.diff(offsets))
            for out, salt in ((s1, 0x51ED270B35AE1C4D), (s2, 0x2545F4914F6CDD1D)):
                total = np.zeros(len(values) + 1, K.U64)
                np.cumsum(K.mix(values ^ K.U64(salt)), out=total[1:])
                out.append(np.diff(total[offsets]))
            bands.append(K.bands(K.sketch(values, offsets, T), BANDS))
        sizes, flat = np.concatenate(n), np.concatenate(bands)
        per_row = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes), pa.array(np.concatenate(s1).view(np.int64)), pa.array(np.concatenate(s2).view(np.int64)), _lists(flat[sizes > 0].ravel(), per_row)],
            names=["doc_id", "n_shingles", "s1", "s2", "bands"],
        )

    return run


def _full_sets(k: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets, marks = [], []
        for _a, _b, values, offsets in _sets(batch, k):
            sets.append((values, offsets))
            marks.append((K.sketch(values, offsets, T) & K.U64(0xFF)).astype(np.uint8))
        values = np.concatenate([v for v, _ in sets])
        base = np.cumsum([0] + [len(v) for v, _ in sets])
        offsets = np.concatenate([[0], *[o[1:] + s for (_, o), s in zip(sets, base, strict=False)]])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), _lists(values, offsets), pa.array([m.tobytes() for m in np.concatenate(marks)], pa.binary())], names=["id", "shingles", "marks"]
        )

    return run


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): connected components of the edges by large-star and small-star rounds.

    Each half round is a minimum per node (combined before the shuffle), written and
    joined back to the edges: as both sides of that join are shuffled for it alone, the
    edges of a node with very many neighbours can be split.  It stops when the edges are
    stars round their least ids.
    """
    edges = cut(edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo <> hi").distinct(), "edges")
    while True:
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(edges.select("hi", "lo"))
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).where("lo <> hi").distinct()
        large = cut(large, "edges")
        least = cut(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        joined = large.join(least, "hi")
        small = joined.select(F.col("m").alias("lo"), "hi").union(joined.select("m", F.col("lo").alias("hi"))).where("lo <> hi").distinct()
        fresh = cut(small, "edges")
        sums = [e.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(20,0)"))).first() for e in (edges, fresh)]
        edges = fresh
        if sums[0] == sums[1]:
            break
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(edges.select(F.col("lo"), F.col("lo")).distinct())


def _verify_block(percent: int, floor: float):
    def run(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        comp, chunk = table["component"].to_numpy(), table["chunk"].to_numpy()
        sets = [np.asarray(x) for x in table["shingles"].to_pandas()]
        size = np.array([len(s) for s in sets])
        marks = np.frombuffer(b"".join(table["marks"].to_pylist()), np.uint8).reshape(len(ids), T)
        lo, hi, bucket = table["lo"][0].as_py(), table["hi"][0].as_py(), table["bucket"][0].as_py()
        # the lesser open buckets of each row; this bucket's number, which is none of them, stands where it has fewer
        lesser = [np.array([x for x in opened if x < bucket], np.int64) for opened in table["opened"].to_pylist()]
        width = max(map(len, lesser))
        earlier = np.array([np.concatenate([x, np.full(width - len(x), bucket, np.int64)]) for x in lesser], np.int64).reshape(len(ids), width)
        parent = {c: c for c in comp.tolist()}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        out: list[tuple[int, int]] = []
        right = np.flatnonzero(chunk == hi)
        for i in np.flatnonzero(chunk == lo):
            js = right[right > i] if lo == hi else right
            js = js[(comp[js] != comp[i]) & (100 * np.minimum(size[js], size[i]) >= percent * np.maximum(size[js], size[i]))]
            if len(lesser[i]):
                js = js[~np.isin(earlier[js], lesser[i]).any(axis=1)]
            agree = (marks[js] == marks[i]).sum(axis=1)
            js = js[agree >= floor * T]
            for j in js[np.argsort(-agree[agree >= floor * T], kind="stable")]:
                x, y = root(int(comp[i])), root(int(comp[j]))
                if x != y:
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * both >= percent * (size[i] + size[j] - both):
                        parent[max(x, y)] = min(x, y)
                        out.append((int(ids[i]), int(ids[j])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, floor: float = FLOOR) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Links are pairs whose sets of k-word shingles (A-Z lower-cased; a shorter text is
    one shingle) have 100 * intersection >= percent * union; see the module's text.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sk = cut(map_batches(docs, _sketches(k), "doc_id bigint, n_shingles bigint, s1 bigint, s2 bigint, bands array<bigint>"), "sketches")
    named = sk.where("doc_id is not null and n_shingles > 0")
    # 1. equal sets: every copy points at the least id
    key = ["s1", "s2", "n_shingles"]
    firsts = named.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    firsts = cut(firsts, "firsts")
    copies = named.select("doc_id", *key).join(firsts.select(*key, "rep"), key).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    # 2. buckets, each compared with its most central member
    rows = firsts.select("rep", "n_shingles", F.explode("bands").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("weight")).where("m > 1")
    rows = cut(rows.drop("n_shingles").join(sizes, "bucket"), "buckets")
    central = rows.groupBy("rep").agg(F.sum("m").alias("reach"))
    leaders = rows.join(central, "rep").groupBy("bucket").agg(F.max_by("rep", F.struct("reach", -F.col("rep"))).alias("leader"))
    stars = cut(
        rows.join(leaders, "bucket").where("rep <> leader").select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct(), "stars"
    )
    members = rows.select(F.col("rep").alias("doc_id")).distinct()
    texts = docs.join(members.hint("shuffle_hash"), "doc_id", "left_semi")
    sets = map_batches(texts, _full_sets(k), "id bigint, shingles array<bigint>, marks binary")
    sets = cut(sets, "sets")
    side = lambda x: sets.select(F.col("id").alias(x), F.col("shingles").alias(f"s_{x}"))
    pairs = stars.join(side("a"), "a").join(side("b"), "b")
    both = F.size(F.array_intersect("s_a", "s_b"))
    links = pairs.withColumn("n", both).where(f"100 * n >= {percent} * (size(s_a) + size(s_b) - n)").select("a", "b")
    links = cut(links, "links")
    comp = cut(components(links), "components")
    # 3. buckets not yet of one component, in blocks
    rows = rows.join(comp, F.col("rep") == F.col("id"), "left").select("bucket", "rep", "m", "weight", F.coalesce("component", "rep").alias("component"))
    rows = cut(rows, "members")
    open_ = rows.where("m > 2").groupBy("bucket").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1").select("bucket")
    open_ = cut(open_, "open")
    n_chunks = F.ceil(F.greatest(F.col("m") / BLOCK, F.col("weight") / SHINGLES))
    rows = cut(rows.join(open_, "bucket"), "unsettled")
    opened = rows.groupBy(F.col("rep").alias("id")).agg(F.collect_list("bucket").alias("opened"))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("rep"), n_chunks))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), n_chunks - 1)))
    dealt = dealt.select("bucket", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "chunk", F.col("rep").alias("id"), "component")
    blocks = dealt.join(sets.join(opened, "id"), "id").groupBy("bucket", "lo", "hi")
    more = blocks.applyInArrow(_verify_block(percent, floor), "a bigint, b bigint")
    comp = components(links.union(more).union(copies))
    return (
        sk.join(comp.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))
    )


def keep_first(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that are kept, with their columns.

    Rows that share a doc_id and are kept all stay: they are one document.
    """
    gone = near_duplicates(docs, k, percent).where("not kept").select("doc_id").distinct()
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*map(quoted, docs.columns))
