"""Language-model scoring by online logistic context mixing.

The text is normalised (A-Z lower-cased, words joined by one space, a line feed
as its end) and predicted bit by bit.  Hashed contexts of the last 2 to 5 bytes
each keep bit counts; their stretched predictions are combined by logistic mixing,
the weight set gated by the bit's place and by how many of the long contexts were seen;
the mix is refined by an adaptive probability map chosen by what the text has cost
per byte so far.  The sum is the text's total code length.

Training is one pass over all training rows.  Each task goes through its chunks
online: predict with what the task has learned, step the gated weights and the
map, then add the counts.  Bit counts are summed over tasks in a tree of bounded
groups, weights averaged by bytes, map counts summed.  All parts have a fixed
size (`SLOTS`), so what is broadcast doesn't grow; what is gathered grows with tasks.

Word counts of the base score are exact at any vocabulary: the most frequent words,
at most `HEAD` of them, are broadcast, and all other words of a text go through
a join with the remaining counts.  A word is its 64-bit hash.

In a chunk equal (history, byte) windows are predicted once: chunks only bound memory,
and a score doesn't depend on its neighbours.  A text longer than a chunk is read in pieces
cut between words, each with the bytes and the cost before it: memory is bounded by the
chunk (or by the longest word), not by the text.

The weights of the mix are those of online passes over the tasks' rows, averaged: they, and so
`score`, depend on how the input is split into tasks.  Counts and `base_score` don't.

Defined results: null or blank text is its end alone (one token); no training
rows give 8 bits a byte and base_score 0 a token; repeated rows are scored each;
rows with a null id are scored, and are neither held out nor learned from; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .common import cut, map_batches

ORDERS = (2, 3, 4, 5)
SLOTS = (1 << 18, 1 << 19, 1 << 20, 1 << 21)
BASE = np.concatenate([[0], np.cumsum(SLOTS)]).astype(np.int64)
TOTAL = int(BASE[-1])
BLOCK = 1 << 14
GATES, LEVELS, BUCKETS = 4, 2, 33
#: A text is dear once it has cost more bits a byte than this.
DEAR = 2.2
HEAD = 1 << 20
CHUNK = 2_800_000
#: So many distinct words a task merges before it hands them on.
HELD = 1 << 20
FAN_IN = 128
STEPS = 3
#: A task's chunks start small, so that weights learn early, and double up to CHUNK.
FIRST_CHUNK = 125_000
END_HASH = np.int64(0x454E44)
U = K.U64


def canonical(w: K.Words) -> tuple[np.ndarray, np.ndarray]:
    """Normalised bytes of every row, and their offsets."""
    n = len(w.first) - 1
    lengths = w.ends - w.starts
    empty = w.counts == 0
    rows = w.rows()
    sizes = np.bincount(rows, lengths + 1, n).astype(np.int64) + empty
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    out = np.full(offsets[-1], 32, np.uint8)
    out[offsets[1:] - 1] = 10
    if len(rows):
        at = np.cumsum(lengths + 1) - lengths - 1 + np.cumsum(empty)[rows]
        step = np.repeat(at - w.starts, lengths)
        src = np.repeat(w.starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        out[src + step] = w.data[src]
    return out, offsets


def windows(data: np.ndarray, offsets: np.ndarray, bits: int = 8, blank: int = 10) -> np.ndarray:
    """Each byte with its five predecessors (`blank` before the text), as one number of `bits` each."""
    key = data.astype(U)
    for j in range(1, 6):
        key[j:] |= data[: max(0, len(data) - j)].astype(U) << U(bits * j)
    pad = sum(blank << (bits * j) for j in range(6))
    for r in range(5):
        at = offsets[:-1][np.diff(offsets) > r] + r
        own = (1 << (bits * (r + 1))) - 1
        key[at] = (key[at] & U(own)) | U(pad & ~own)
    return key


def distinct(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct windows of 8 bits a byte, index of each byte's window among them, counts).

    Where at most 128 byte values occur, windows take 42 bits and are sorted together
    with their place; else they are sorted by index.  The result is the same set.
    """
    n = len(data)
    used = np.flatnonzero(np.bincount(data, minlength=256) | (np.arange(256) == 10))
    small = len(used) <= 128 and n < 1 << 22
    if small:
        rank = np.zeros(256, np.uint8)
        rank[used] = np.arange(len(used))
        packed = windows(rank[data], offsets, 7, int(rank[10]))
        packed <<= U(22)
        packed |= np.arange(n, dtype=U)
        packed.sort()
        order = (packed & U((1 << 22) - 1)).astype(np.int32)
        packed >>= U(22)
    else:
        packed = windows(data, offsets)
        order = np.argsort(packed)
        packed = packed[order]
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(packed[1:], packed[:-1], out=new[1:])
    inverse = np.empty(n, np.int32)
    inverse[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    at = np.flatnonzero(new)
    keys = packed[at]
    if small:
        keys = sum(used.astype(U)[(keys >> U(7 * j)) & U(127)] << U(8 * j) for j in range(6))
    return keys, inverse, np.diff(np.append(at, n))


def slots(keys: np.ndarray) -> list[np.ndarray]:
    """By order: the hash of the context bytes, ready to take a bit's node."""
    out = []
    for k in ORDERS:
        ctx = (keys >> U(8)) & U((1 << (8 * k)) - 1)
        out.append(K.mix(ctx * U(8) + U(k)))
    return out


def bit_slots(hashes: list[np.ndarray], node: np.ndarray) -> list[np.ndarray]:
    """By order: the table slot of each (context, node of the bit tree)."""
    spread, found = node * U(0x9E3779B97F4A7C15), []
    for h, size, base in zip(hashes, SLOTS, BASE, strict=False):
        x = (h + spread) * U(0xD6E8FEB86659FD93)
        found.append((x >> U(64 - size.bit_length() + 1)).astype(np.int32) + np.int32(base))
    return found


def stretch_counts(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + np.float32(0.4)) / (n0 + np.float32(0.4))).astype(np.float32)


@dataclass
class Mixer:
    """Gated weights (bit, gate, order) and the map's counts (level, bit, bucket, zeros and ones)."""

    weights: np.ndarray
    apm: np.ndarray

    @staticmethod
    def fresh() -> Mixer:
        grid = 1 / (1 + np.exp(-np.linspace(-8, 8, BUCKETS)))
        apm = np.empty((LEVELS, 8, BUCKETS, 2))
        apm[..., 1], apm[..., 0] = 8 * grid, 8 * (1 - grid)
        return Mixer(np.full((8, GATES, len(ORDERS)), 0.3), apm)

    def mix(self, i: int, st: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        gate = (st[-1] != 0).astype(np.int8) + (st[-2] != 0).view(np.int8) + (st[-3] != 0).view(np.int8)
        w = self.weights[i].astype(np.float32)
        dot = np.zeros(len(gate), np.float32)
        for k, s in enumerate(st):
            dot += w[:, k][gate] * s
        return np.clip(dot, -12, 12), gate

    def refine(self, i: int, dot: np.ndarray) -> np.ndarray:
        """LEVELS x len(dot): probability of a one after the map, averaged with the mix."""
        where = (np.clip(dot, -8, 8) + 8) * ((BUCKETS - 1) / 16)
        low = np.minimum(where.astype(np.int32), BUCKETS - 2)
        part = (where - low).astype(np.float32)
        table = (self.apm[:, i, :, 1] / self.apm[:, i].sum(axis=2)).astype(np.float32)
        mapped = table[:, low] * (1 - part) + table[:, low + 1] * part
        return np.clip((mapped + 1 / (1 + np.exp(-dot))) / 2, 1e-5, 1 - 1e-5)


#: A text's excess over DEAR before its first byte: a prior of 16 bytes of 2.5 bits.
PRIOR = 16 * (2.5 - DEAR)


def levels(cost: np.ndarray, offsets: np.ndarray, owed: float = PRIOR) -> np.ndarray:
    """By byte: whether its text has been dear before it; `owed` is the excess before the first byte."""
    gap = cost.astype(np.float64) - DEAR
    total = np.cumsum(gap)
    total -= gap
    return total - np.repeat(total[offsets[:-1]] - owed, np.diff(offsets)) > 0


def long_pieces(text: np.ndarray) -> Iterator[tuple[K.Words, np.ndarray, int]]:
    """(words, canonical bytes, how many of these only tell the history) of a long text's pieces, in order."""
    full = np.flatnonzero(~K.SPACE[text])
    text = text[: full[-1] + 1] if len(full) else text[:0]
    history, done = np.zeros(0, np.uint8), 0
    for part in K.pieces(text, CHUNK):
        done += len(part)
        w = K.words(part, np.array([0, len(part)]))
        if not len(w.starts):
            continue
        data = canonical(w)[0]
        data[-1] = 10 if done == len(text) else 32
        yield w, np.concatenate([history, data]), len(history)
        history = np.concatenate([history, data])[-5:]
    if not len(text):
        yield K.words(text, np.array([0, 0])), np.array([10], np.uint8), 0


def evaluate(keys: np.ndarray, look, mixer: Mixer) -> Iterator[tuple]:
    """By bit of the keys' last byte, for each distinct (history, bits so far): what predicts it.

    Sorted keys with one history and the same first bits are neighbours: they share one
    prediction.  Yields (slots, stretched predictions, mix, gate, where each share starts,
    `pick`, the keys' bit); pick finds a key's value in what shares have for a zero and, after
    these, for a one.
    """
    hashes = slots(keys)
    for i in range(8):
        prefix = keys >> U(8 - i)
        new = np.empty(len(keys), bool)
        new[0] = True
        np.not_equal(prefix[1:], prefix[:-1], out=new[1:])
        first = np.flatnonzero(new)
        node = (prefix[first] & U((1 << i) - 1)) | U(1 << i)
        at = bit_slots([h[first] for h in hashes], node)
        st = [look(a) for a in at]
        bit = (keys >> U(7 - i)).astype(np.uint8) & np.uint8(1)
        share = np.cumsum(new, dtype=np.int32) - np.int32(1)
        yield at, st, *mixer.mix(i, st), first, share + bit * np.int32(len(first)), bit


def plain_bits(dot: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """Bits that each key's bit costs by the mix: log2(1 + e^-dot) for a one, that and dot for a zero."""
    one = np.log2(1 + np.exp(-dot))
    return np.concatenate([one + dot * np.float32(1.442695), one])[pick]


class Learner:
    """One task's online pass."""

    def __init__(self) -> None:
        self.n = np.zeros(2 * TOTAL, np.float32)
        self.mixer, self.steps, self.bytes = Mixer.fresh(), 0, 0

    def look(self, at: np.ndarray) -> np.ndarray:
        both = self.n.view(np.complex64)[at]
        return stretch_counts(both.real, both.imag)

    def rate(self) -> float:
        return 0.3 / (1 + self.steps / 20)

    def learn(self, data: np.ndarray, offsets: np.ndarray, skip: int = 0) -> None:
        """One chunk; its first `skip` bytes are history alone."""
        keys, inverse, counts = distinct(data, offsets)
        counts = counts.astype(np.float32)
        np.subtract.at(counts, inverse[:skip], 1)
        self.steps += 1
        self.bytes += len(data)
        plain, marks = np.zeros(len(keys), np.float32), []
        for i, (at, st, dot, gate, first, pick, bit) in enumerate(evaluate(keys, self.look, self.mixer)):
            plain += plain_bits(dot, pick)
            bucket = (np.rint((np.clip(dot, -8, 8) + 8) * ((BUCKETS - 1) / 16)) * 2).astype(np.uint8)
            marks.append(np.concatenate([bucket, bucket + np.uint8(1)])[pick])
            both = np.add.reduceat(counts, first)
            ones = np.add.reduceat(counts * bit, first)
            # damped Newton steps by weight, each weight set on its own bits; more of them early on
            sides = (gate[:, None] == np.arange(GATES, dtype=np.int8)).astype(np.float32)
            seen = np.stack(st)
            power, mass = ((seen * seen) * both) @ sides, np.maximum(both @ sides, 1)
            for turn in range(STEPS if self.steps <= 8 else 1):
                p = 1 / (1 + np.exp(-(self.mixer.mix(i, st)[0] if turn else dot)))
                push, var = seen @ ((ones - p * both)[:, None] * sides), ((both * p * (1 - p)) @ sides) / mass
                self.mixer.weights[i] += (self.rate() * push / (power * var + 50)).T
            add = np.empty(len(ones), np.complex64)
            add.real, add.imag = both - ones, ones
            for a in at:
                np.add.at(self.n.view(np.complex64), a, add)
        dear = np.bincount(inverse[skip:][levels(plain[inverse], offsets)[skip:]], minlength=len(keys))
        for lv, weight in enumerate((counts - dear, dear)):
            for i, bucket in enumerate(marks):
                self.mixer.apm[lv, i] += np.bincount(bucket, weight, 2 * BUCKETS).reshape(BUCKETS, 2)

    def rows(self) -> Iterator[tuple[int, int, bytes]]:
        both = self.n.reshape(-1, 2).astype("<f4", copy=False)
        for b in range(0, TOTAL, BLOCK):
            part = both[b : b + BLOCK]
            if part.any():
                yield 1, b // BLOCK, part.tobytes()
        yield 2, 0, np.concatenate([[self.bytes], self.mixer.weights.ravel() * self.bytes, self.mixer.apm.ravel()]).astype("<f8").tobytes()


def _merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[: len(keys)]
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


OUT = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64()), ("payload", pa.binary())])


def _word_rows(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.zeros(len(keys), np.int32)), pa.array(keys), pa.array(counts), pa.nulls(len(keys), pa.binary())], schema=OUT)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    learner = None
    keys = counts = np.zeros(0, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        learner = learner or Learner()
        keys, counts = _merge(np.append(keys, END_HASH), np.append(counts, batch.num_rows))
        data, offsets, _ = K.buffers(batch.column("text"))
        a = 0
        while a < batch.num_rows:
            size = min(CHUNK, FIRST_CHUNK << min(learner.steps, 10))
            b = a + next(K.chunks(offsets[a:], size))[1]
            part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            if len(part) > CHUNK:
                chunks = ((w, d, np.array([0, len(d)]), skip) for w, d, skip in long_pieces(part))
            else:
                w = K.words(part, own)
                chunks = ((w, *canonical(w), 0),)
            for w, canon, at, skip in chunks:
                k, c = _merge(np.sort(K.word_hashes(w).view(np.int64)), np.ones(len(w.starts), np.int64))
                keys, counts = _merge(np.concatenate([keys, k]), np.concatenate([counts, c]))
                learner.learn(canon, at, skip)
                if len(keys) > HELD:
                    yield _word_rows(keys, counts)
                    keys = counts = np.zeros(0, np.int64)
            a = b
    if len(keys):
        yield _word_rows(keys, counts)
    if learner:
        held: list[tuple[int, int, bytes]] = []
        for row in learner.rows():
            held.append(row)
            if len(held) == 32 or row[0] == 2:
                kind, key, payload = zip(*held, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(key, pa.int64()), pa.array([1] * len(held), pa.int64()), pa.array(payload, pa.binary())], schema=OUT)
                held = []


def _sum_payloads(table: pa.Table) -> pa.Table:
    kind = table["kind"][0].as_py()
    total = None
    for chunk in table["payload"].chunks:
        for x in chunk:
            a = np.frombuffer(x.as_buffer(), "<f4" if kind == 1 else "<f8").astype(np.float64)
            total = a if total is None else total + a
    data = total.astype("<f4" if kind == 1 else "<f8").tobytes()
    return pa.table({"kind": pa.array([kind], pa.int32()), "key": table["key"][:1], "salt": table["salt"][:1], "payload": pa.array([data], pa.binary())})


def _gather(parts: DataFrame, fan_in: int) -> list:
    """One summed payload per (kind, key), through groups of at most about `fan_in` rows."""
    n = parts.where("kind = 2").count()
    df = parts.where("kind > 0").select("kind", "key", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 40)).alias("salt"), "payload")
    while True:
        groups = max(1, -(-n // fan_in))
        df = df.withColumn("salt", F.pmod("salt", F.lit(groups))).groupBy("kind", "key", "salt").applyInArrow(_sum_payloads, "kind int, key bigint, salt bigint, payload binary")
        if groups == 1:
            return df.select("kind", "key", "payload").collect()
        n = groups


@dataclass
class Model:
    """Everything a scoring task needs, of fixed size but for `head` (at most HEAD words)."""

    stretch: np.ndarray
    mixer: Mixer
    head: np.ndarray
    head_counts: np.ndarray
    tokens: int
    types: int

    def look(self, at: np.ndarray) -> np.ndarray:
        return self.stretch[at]

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of each row of canonical bytes."""
        return self.spend(data, offsets)[0]

    def spend(self, data: np.ndarray, offsets: np.ndarray, skip: int = 0, owed: float = PRIOR) -> tuple[np.ndarray, float]:
        """(code length of each row of canonical bytes, without the first `skip` bytes; the last row's excess by the mix)."""
        keys, inverse, _ = distinct(data, offsets)
        plain, fine = np.zeros(len(keys), np.float32), np.zeros((LEVELS, len(keys)), np.float32)
        for i, (_, _, dot, _, _, pick, _) in enumerate(evaluate(keys, self.look, self.mixer)):
            plain += plain_bits(dot, pick)
            p = self.mixer.refine(i, dot)
            for lv in range(LEVELS):
                fine[lv] -= np.log2(np.concatenate([1 - p[lv], p[lv]]))[pick]
        spent = plain[inverse]
        spent[:skip] = DEAR
        cost = np.where(levels(spent, offsets, owed), fine[1][inverse], fine[0][inverse])
        cost[:skip] = 0
        return np.add.reduceat(cost, offsets[:-1], dtype=np.float64), owed + float((spent.astype(np.float64) - DEAR).sum())

    def known(self, w: K.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """By row: words of the head and their logarithms; the hashes of the others, and how many."""
        h = K.word_hashes(w).view(np.int64)
        # sorted look-ups stay in cache
        order = np.argsort(h)
        at = np.empty(len(h), np.int64)
        at[order] = np.minimum(np.searchsorted(self.head, h[order]), max(0, len(self.head) - 1))
        known = self.head[at] == h if len(self.head) else np.zeros(len(h), bool)
        c = np.where(known, self.head_counts[at], 0) if len(self.head) else np.zeros(len(h))
        total = np.concatenate([[0.0], np.cumsum(np.where(known, np.log10(c + 1.0), 0))])
        seen = np.concatenate([[0], np.cumsum(known)])
        first = np.concatenate([[0], np.cumsum(~known)])[w.first]
        return seen[w.first[1:]] - seen[w.first[:-1]], total[w.first[1:]] - total[w.first[:-1]], h[~known], np.diff(first)

    def read(self, part: np.ndarray, own: np.ndarray) -> list[np.ndarray]:
        """Words, known words, their logarithms, bits, size, unknown hashes and how many of these, by row of a chunk."""
        if len(part) <= CHUNK:
            w = K.words(part, own)
            known, logs, tails, n_tails = self.known(w)
            canon = canonical(w)
            return [w.counts, known, logs, self.bits(*canon), np.diff(canon[1]), tails, n_tails]
        found, owed = [], PRIOR
        for w, data, skip in long_pieces(part):
            known, logs, tails, n_tails = self.known(w)
            bits, owed = self.spend(data, np.array([0, len(data)]), skip, owed)
            found.append([w.counts, known, logs, bits, np.array([len(data) - skip]), tails, n_tails])
        return [np.concatenate(x) if i == 5 else np.sum(x, axis=0) for i, x in enumerate(zip(*found, strict=True))]

    def score(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets, _ = K.buffers(batch.column("text"))
        rows = [self.read(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in K.chunks(offsets, CHUNK)]
        n, known, logs, bits, size, tails, n_tails = (np.concatenate(x) for x in zip(*rows, strict=True))
        tail = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_tails)]).astype(np.int32)), pa.array(tails))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *map(pa.array, (n, known, logs, bits, size)), tail], names=["doc_id", "held_out", "n", "known", "logs", "bits", "size", "tail"])


def fit(train: DataFrame, head: int = HEAD, fan_in: int = FAN_IN) -> tuple[Model, DataFrame | None]:
    """(model, counts of the words beyond its head; None where the head holds them all)."""
    parts = cut(train.select(F.col("text").cast("string").alias("text")).mapInArrow(_learn, "kind int, key bigint, n bigint, payload binary"), "learned")
    words = cut(parts.where("kind = 0").groupBy("key").agg(F.sum("n").alias("c")), "words")
    size = words.groupBy(F.floor(F.log2("c")).alias("b")).agg(F.count("*").alias("types"), F.sum("c").alias("tokens")).orderBy(F.desc("b")).collect()
    types, tokens = sum(r["types"] for r in size), sum(r["tokens"] for r in size)
    held, least = 0, None
    for r in size:
        if held + r["types"] > head:
            break
        held, least = held + r["types"], 2 ** r["b"]
    top = words.where(F.col("c") >= (least if least is not None else 1 << 62)).orderBy("key").toArrow() if held else None
    keys = top["key"].to_numpy() if held else np.zeros(0, np.int64)
    counts = top["c"].to_numpy() if held else np.zeros(0, np.int64)
    n = np.zeros((TOTAL, 2), np.float32)
    mixer = Mixer.fresh()
    for r in _gather(parts, fan_in):
        if r["kind"] == 1:
            part = np.frombuffer(r["payload"], "<f4").reshape(-1, 2)
            n[r["key"] * BLOCK : r["key"] * BLOCK + len(part)] = part
        else:
            flat = np.frombuffer(r["payload"], "<f8")
            shape = mixer.weights.shape
            weights = flat[1 : 1 + mixer.weights.size].reshape(shape) / max(1.0, flat[0])
            mixer = Mixer(weights, flat[1 + mixer.weights.size :].reshape(mixer.apm.shape).copy())
    model = Model(stretch_counts(n[:, 0], n[:, 1]), mixer, keys, counts, int(tokens), int(types))
    rest = words.where(F.col("c") < least) if held and held < types else (words if types and not held else None)
    return model, rest


def score(docs: DataFrame, held_out: Column, learn: Column, head: int = HEAD) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    `learn` marks the training rows.  score is the model's log10 probability of the
    text, bits_per_byte its code length by byte of the normalised text.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), held_out.alias("held_out"), learn.alias("learn"))
    model, rest = fit(docs.where("learn"), head)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    raw = map_batches(docs.select("doc_id", "text", "held_out"), lambda b: shared.value.score(b), "doc_id bigint, held_out boolean, n bigint, known bigint, logs double, bits double, size bigint, tail array<bigint>")
    if rest is None:
        out = raw.withColumns({"more": F.lit(0.0), "also": F.lit(0)})
    else:
        raw = cut(raw.withColumn("uid", F.monotonically_increasing_id()), "scored")
        tails = raw.select("uid", F.explode("tail").alias("key")).groupBy("uid", "key").agg(F.count("*").alias("m"))
        found = tails.join(rest, "key").groupBy("uid").agg(F.sum(F.col("m") * F.log10(F.col("c") + 1)).alias("more"), F.sum("m").alias("also"))
        out = raw.join(found, "uid", "left").withColumns({"more": F.coalesce("more", F.lit(0.0)), "also": F.coalesce("also", F.lit(0))})
    known_end = int(model.tokens > 0)
    end = 0.0
    if known_end:
        at = np.searchsorted(model.head, END_HASH)
        if at < len(model.head) and model.head[at] == END_HASH:
            end = float(np.log10(model.head_counts[at] + 1.0))
        else:
            end = float(np.log10(rest.where(F.col("key") == int(END_HASH)).first()["c"] + 1.0))
    floor = float(np.log10(model.tokens + model.types + 1.0))
    n = F.col("n") + 1
    return out.select(
        "doc_id",
        "held_out",
        n.alias("n_tokens"),
        (F.col("known") + F.col("also") + known_end).cast("bigint").alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.col("more") + F.lit(end) - n * F.lit(floor)).alias("base_score"),
        (-F.col("bits") * F.lit(float(np.log10(2.0)))).alias("score"),
        (F.col("bits") / F.col("size")).alias("bits_per_byte"),
    )
