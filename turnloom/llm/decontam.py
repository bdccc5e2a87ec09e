"""Benchmark decontamination with a broadcast hash set of test n-grams.

Benchmark items become windows of `n` consecutive normalised words (a shorter item
is one window).  Documents are scanned once on Arrow buffers: rolling window
hashes are looked up in the sorted window set, and every hit is verified byte for
byte against the item's window before it counts.

The window set is broadcast only while it is proven small (`MAX_WINDOWS` pairs of a
window and an item, and `MAX_BYTES`, both counted first).  A larger one stays distributed: a Bloom
bitmap of fixed size (`BLOOM_BITS`), built by executors in blocks, is broadcast instead, the windows of documents
that pass it are joined with the window table on the hash and on the words
themselves, and the hits come back as intervals; results are equal.  A document's
text is scanned once, whatever is asked.

Defined results: null or wordless texts have no words, no hits and stay; items
without words (or null) match nothing; rows that repeat are judged each for
itself; extra columns pass through in `remove_contaminated` and are ignored in
`contamination`.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .common import cut, map_batches, packed, unpacked

N = 13
MAX_WINDOWS, MAX_BYTES = 250_000, 64_000_000
BLOOM_BITS, BLOOM_BLOCK = 1 << 26, 1 << 16


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[K.Words, np.ndarray]:
    w = K.words(data, offsets, K.NON_ALNUM, K.LOWER)
    return w, K.word_hashes(w, K.NON_ALNUM)


def _phrase(w: K.Words, i: int, size: int) -> bytes:
    return b" ".join(w.data[a:b].tobytes() for a, b in zip(w.starts[i : i + size], w.ends[i : i + size], strict=True))


def _hashes(h: np.ndarray, size: int) -> np.ndarray:
    return K.grams(h, size).view(np.int64)


def _item_windows(n: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        data, offsets, _ = K.buffers(batch.column("text"))
        ids = batch.column("item_id").cast(pa.string()).to_pylist()
        out: list[tuple] = []
        for a, b in K.chunks(offsets):
            w, h = _words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            for r in range(b - a):
                lo, hi = int(w.first[r]), int(w.first[r + 1])
                size = min(n, hi - lo)
                if size and ids[a + r] is not None:
                    out += [(int(g), size, _phrase(w, lo + i, size), ids[a + r]) for i, g in enumerate(_hashes(h[lo:hi], size))]
        hash_, size, phrase, item = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(hash_, pa.int64()), pa.array(size, pa.int32()), pa.array(phrase, pa.binary()), pa.array(item, pa.string())], names=["hash", "size", "phrase", "item"])

    return run


def item_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """(hash, size, phrase, item): the distinct windows of each item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return map_batches(items, _item_windows(n), "hash bigint, size int, phrase binary, item string").distinct()


def _is_small(windows: DataFrame, most: int) -> bool:
    one = windows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("phrase") + F.octet_length("item")), F.lit(0)).alias("bytes")).first()
    return one["n"] <= most and one["bytes"] <= MAX_BYTES


def _cover(counts: np.ndarray, first: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of each row's words lie in one of the word intervals."""
    depth = np.zeros(int(first[-1]) + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(depth[:-1]) > 0)])
    return hit[first[1:]] - hit[first[:-1]]


def _items_sha(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


class _Scanner:
    def __init__(self, shared) -> None:
        self.shared, self.ready = shared, None

    def __getstate__(self) -> dict:
        return {"shared": self.shared, "ready": None}

    def windows(self) -> dict:
        """By window size: sorted hashes, a bitmap of them, and hash -> [(phrase, items)]."""
        if self.ready is None:
            self.ready = {}
            for size in {row[1] for row in self.shared.value}:
                table: dict[int, list] = {}
                for h, s, phrase, items in self.shared.value:
                    if s == size:
                        table.setdefault(h, []).append((phrase, items))
                keys = np.array(sorted(table), np.int64)
                bitmap = np.zeros(1 << 20, bool)
                bitmap[keys & ((1 << 20) - 1)] = True
                self.ready[size] = (keys, bitmap, table)
        return self.ready

    def scan(self, data: np.ndarray, offsets: np.ndarray):
        """(words, hit starts, hit ends, item sets by row) of one chunk; hits are verified."""
        w, h = _words(data, offsets)
        rows, starts, ends, items = w.rows(), [], [], {}
        for size, (keys, bitmap, table) in self.windows().items():
            g = _hashes(h, size)
            at = np.flatnonzero(bitmap[g & ((1 << 20) - 1)])
            if not len(at):
                continue
            at = at[rows[at] == rows[at + size - 1]]
            at = at[np.isin(g[at], keys)]
            for i in at.tolist():
                phrase = _phrase(w, i, size)
                for known, ids in table[int(g[i])]:
                    if known == phrase:
                        starts.append(i)
                        ends.append(i + size)
                        items.setdefault(int(rows[i]), set()).update(ids)
        return w, np.array(starts, np.int64), np.array(ends, np.int64), items

    def judge(self, batch: pa.RecordBatch):
        """Of one scan by chunk: (first row, words, words hit, item sets, hit intervals) by row of the chunk."""
        data, offsets, _ = K.buffers(batch.column("text"))
        for a, b in K.chunks(offsets):
            w, starts, ends, items = self.scan(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            at: dict[int, list[tuple[int, int]]] = {}
            owner = np.searchsorted(w.first, starts, "right") - 1
            for r, s, e in zip(owner.tolist(), (starts - w.first[owner]).tolist(), (ends - w.first[owner]).tolist(), strict=True):
                at.setdefault(r, []).append((s, e))
            yield a, w.counts, _cover(w.counts, w.first, starts, ends), items, at

    def report(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        words, hits, n_items, sha = [], [], [], []
        for _a, counts, hit, items, _at in self.judge(batch):
            words.append(counts)
            hits.append(hit)
            n_items += [len(items.get(r, ())) for r in range(len(counts))]
            sha += [_items_sha(items[r]) if r in items else NO_ITEMS for r in range(len(counts))]
        words, hits = np.concatenate(words), np.concatenate(hits)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *map(pa.array, (words, hits, np.array(n_items, np.int64), sha, _flags(hits, words)))], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
        )

    def clean(self, batch: pa.RecordBatch, mode: str) -> pa.RecordBatch:
        """The batch without its contaminated rows, and with what is hit in the others cut out, as the mode says."""
        keep, at = [], []
        for _a, counts, hit, _items, where in self.judge(batch):
            keep.append(~_flags(hit, counts) if mode != "spans" else np.ones(len(counts), bool))
            at += [where.get(r, []) for r in range(len(counts))]
        keep = np.concatenate(keep)
        batch = batch.filter(pa.array(keep))
        return _without(batch, [a for a, k in zip(at, keep, strict=True) if k]) if mode != "documents" and batch.num_rows else batch


def _flags(hits: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (hits > 0) & (20 * hits >= words)


def _without(batch: pa.RecordBatch, at: list[list[tuple[int, int]]]) -> pa.RecordBatch:
    """The batch with the word intervals `at` of each row cut out of its text."""
    data, offsets, null = K.buffers(batch.column("text"))
    out: list[bytes | None] = []
    for i, hits in enumerate(at):
        text = data[offsets[i] : offsets[i + 1]].tobytes()
        if hits:
            w, _ = _words(data[offsets[i] : offsets[i + 1]], np.array([0, len(text)]))
            for s, e in _merged(hits)[::-1]:
                text = text[: w.starts[s]] + text[w.ends[e - 1] :]
        out.append(None if null[i] else text)
    place = batch.schema.get_field_index("text")
    return batch.set_column(place, "text", pa.array(out, pa.binary()).cast(batch.schema.field(place).type))


NO_ITEMS = _items_sha(set())


def _merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(hits):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _scanner(spark, windows: DataFrame) -> _Scanner:
    table: dict[tuple, list[str]] = {}
    for r in windows.toLocalIterator():
        table.setdefault((r["hash"], r["size"], bytes(r["phrase"])), []).append(r["item"])
    return _Scanner(spark.sparkContext.broadcast([(*k, items) for k, items in table.items()]))


SCHEMA = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = N, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Per row of docs (doc_id, text): n_words, n_hit, n_items, items_sha256, contaminated."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    windows = cut(item_windows(benchmark, n), "windows")
    if _is_small(windows, max_windows):
        return map_batches(docs, _scanner(docs.sparkSession, windows).report, SCHEMA)
    return _joined(cut(docs.withColumn("uid", F.monotonically_increasing_id()), "numbered"), windows)[0].drop("uid")


def _bitmap(windows: DataFrame) -> np.ndarray:
    """BLOOM_BITS bits of the windows' hashes, set in executors by block, one block a row."""

    def block(table: pa.Table) -> pa.Table:
        bits = np.zeros(BLOOM_BLOCK, np.uint8)
        bits[table["low"].to_numpy() % BLOOM_BLOCK] = 1
        return pa.table({"block": table["block"][:1], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    low = windows.select(F.col("hash").bitwiseAND(F.lit(BLOOM_BITS - 1)).alias("low")).distinct().withColumn("block", F.floor(F.col("low") / BLOOM_BLOCK).cast("int"))
    out = np.zeros(BLOOM_BITS // 8, np.uint8)
    for r in low.groupBy("block").applyInArrow(block, "block int, bits binary").toLocalIterator():
        out[r["block"] * (BLOOM_BLOCK // 8) : (r["block"] + 1) * (BLOOM_BLOCK // 8)] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _joined(docs: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the same result with uid, hits) of docs (uid, doc_id, text), the windows kept distributed behind a Bloom bitmap."""
    spark = docs.sparkSession
    mask = BLOOM_BITS - 1
    bloom = spark.sparkContext.broadcast(_bitmap(windows))
    sizes = [r["size"] for r in windows.select("size").distinct().collect()]

    def candidates(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets, _ = K.buffers(batch.column("text"))
        rows: list[tuple] = []
        for a, b in K.chunks(offsets):
            w, h = _words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            owner = w.rows()
            for size in sizes:
                g = _hashes(h, size)
                low = g & mask
                at = np.flatnonzero(bloom.value[low >> 3] >> (low & 7).astype(np.uint8) & 1)
                at = at[owner[at] == owner[at + size - 1]]
                for i in at.tolist():
                    r = int(owner[i])
                    rows.append((batch.column("uid")[a + r].as_py(), i - int(w.first[r]), int(g[i]), size, _phrase(w, i, size)))
        cols = list(zip(*rows, strict=True)) if rows else [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["uid", "at", "hash", "size", "phrase"])

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets, _ = K.buffers(batch.column("text"))
        n = np.concatenate([_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])[0].counts for a, b in K.chunks(offsets)])
        return pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("doc_id"), pa.array(n)], names=["uid", "doc_id", "n_words"])

    found = map_batches(docs.select("uid", "text"), candidates, "uid bigint, at bigint, hash bigint, size int, phrase binary")
    window = ["hash", "size", "phrase"]
    hits = cut(found.join(windows.select(*window).distinct(), window), "hits")
    spot = hits.select("uid", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("size") - 1)).alias("word")).distinct()
    n_hit = spot.groupBy("uid").agg(F.count("*").alias("n_hit"))
    items = hits.select("uid", *window).distinct().join(windows, window).select("uid", "item").distinct().groupBy("uid").agg(F.array_sort(F.collect_set("item")).alias("ids"))
    items = items.select("uid", F.size("ids").cast("bigint").alias("n_items"), F.sha2(F.concat_ws(",", "ids").cast("binary"), 256).alias("sha"))
    base = map_batches(docs, count, "uid bigint, doc_id bigint, n_words bigint")
    out = base.join(n_hit, "uid", "left").join(items, "uid", "left")
    hit = F.coalesce("n_hit", F.lit(0))
    flag = (hit > 0) & (20 * hit >= F.col("n_words"))
    report = out.select("uid", "doc_id", "n_words", hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("sha", F.lit(NO_ITEMS)).alias("items_sha256"), flag.alias("contaminated"))
    return report, hits


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = N, mode: str = "both", max_windows: int = MAX_WINDOWS) -> DataFrame:
    """docs without what the benchmark holds; all columns as they came, in their order.

    A document is contaminated when words are hit and they are 5 % of its words or more.  Mode
    "documents" drops contaminated documents, "spans" cuts every hit word interval out
    of its text, "both" drops the contaminated and cuts what is hit in the others.
    """
    if mode not in ("documents", "spans", "both"):
        raise ValueError(f"mode is documents, spans or both, not {mode!r}")
    windows = cut(item_windows(benchmark, n), "windows")
    if not _is_small(windows, max_windows):
        return _remove_joined(docs, windows, mode)
    scanner = _scanner(docs.sparkSession, windows)

    held = packed(docs, text=F.col("text").cast("string"))
    return _with_texts(map_batches(held, lambda batch: scanner.clean(batch, mode), held.schema), docs.columns)


def _with_texts(held: DataFrame, columns: list[str]) -> DataFrame:
    """The caller's columns out of (row, text), its text replaced by the other."""
    return held.select(*[F.col("text").alias(c) if c.lower() == "text" else unpacked(c)[0] for c in columns])


def _remove_joined(docs: DataFrame, windows: DataFrame, mode: str) -> DataFrame:
    numbered = cut(packed(docs, text=F.col("text").cast("string"), uid=F.monotonically_increasing_id()), "numbered")
    report, hits = _joined(numbered.select("uid", F.lit(None).cast("bigint").alias("doc_id"), "text"), windows)
    if mode != "spans":
        numbered = numbered.join(report.where("contaminated").select("uid"), "uid", "left_anti")
    if mode == "documents":
        return numbered.select(*unpacked(*docs.columns))
    at = hits.groupBy("uid").agg(F.collect_set(F.struct(F.col("at").alias("s"), (F.col("at") + F.col("size")).alias("e"))).alias("at"))
    numbered = numbered.join(at, "uid", "left").select("row", "text", "at")

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        where = [[(x["s"], x["e"]) for x in r or ()] for r in batch.column("at").to_pylist()]
        return _without(batch.drop_columns(["at"]), where)

    return _with_texts(map_batches(numbered, clean, numbered.drop("at").schema), docs.columns)
