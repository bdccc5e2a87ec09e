"""Hierarchical language identification.

First a family is predicted, then one-versus-one linear support vector machines
tell the related languages of that family apart.  Features are hashed byte 2-, 3-
and 4-grams of the whole text (A-Z lower-cased, ASCII other than letters as a space), as
shares of the text's grams, so a prediction is one gather and one sum per gram.
A long text is read in pieces, so that memory is bounded by the chunk.

Training: a bounded sample, `PER_LANG` texts a language (`SAMPLE` in all), drawn by
hash of the id from the labelled rows the caller marks; every SVM is trained on
the driver by dual coordinate descent on SAMPLE x DIM numbers at most.

Defined results: a null text or one without a letter is `und` with score 0; with no
labelled rows every text is `und`; rows with a null id are never held out nor
learned from; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .common import map_batches

DIM = 4096
PER_LANG, SAMPLE = 400, 6000
ORDERS = (2, 3, 4)
#: ISO 639-1 codes by family; a code found nowhere here belongs to the family "other".
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "indic": "hi bn ur mr gu pa ne",
    "dravidian": "ta te kn ml",
    "semitic": "ar he am mt",
    "sinitic": "zh",
    "celtic": "ga cy br gd",
    "malayic": "id ms jv tl",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
_MAP = K.LOWER.copy()
_MAP[[i for i in range(128) if not chr(i).isalpha()]] = 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[i for i in range(128) if chr(i).isalpha()]] = True


def family(code: str) -> str:
    return _FAMILY.get(code.lower().split("-")[0].split("_")[0], "other")


def _indices(data: np.ndarray, offsets: np.ndarray, more: int = 0) -> np.ndarray:
    """orders x bytes gram slots; DIM where the gram would leave its text.

    The last `more` bytes belong to the piece that follows: no gram of this one starts there.
    """
    b = _MAP[data].astype(np.uint32)
    n = len(b)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
    out = np.full((len(ORDERS), n), DIM, np.int32)
    code = b.copy()
    for k in range(1, max(ORDERS)):
        code[: max(0, n - k)] |= b[k:] << np.uint32(8 * k)
        if k + 1 in ORDERS:
            slot = (code + np.uint32(k)) * np.uint32(2654435761)
            slot = ((slot ^ (slot >> np.uint32(15))) * np.uint32(2246822519)) >> np.uint32(32 - 12)
            out[ORDERS.index(k + 1)] = np.where(left > k, slot, DIM)
    if more:
        out[:, n - more :] = DIM
    return out


def _pieces(data: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """(piece, bytes of it that the next one begins with) of a text."""
    for a in range(0, max(1, len(data)), K.CHUNK_BYTES):
        part = data[a : a + K.CHUNK_BYTES + max(ORDERS) - 1]
        yield part, max(0, len(part) - K.CHUNK_BYTES)


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    seen = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data], dtype=np.int32)])
    out = seen[offsets[1:]] > seen[offsets[:-1]]
    for i in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        out[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def _features(batch: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets, _ = K.buffers(batch.column("text"))
    rows = []
    for a, b in K.chunks(offsets):
        part, o = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        slots = _indices(part, o) if b - a > 1 else None
        for r, ok in enumerate(_has_letter(part, o)):
            found = [slots[:, o[r] : o[r + 1]]] if slots is not None else (_indices(p, np.array([0, len(p)]), more) for p, more in _pieces(part))
            x = sum(np.bincount(f.ravel(), minlength=DIM + 1)[:DIM] for f in found)
            rows.append((x / max(1, x.sum())).astype(np.float32).tobytes() if ok else None)
    return pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(rows, pa.binary())], names=["lang", "x"])


def svm(x: np.ndarray, y: np.ndarray, c: float = 20.0, rounds: int = 12) -> np.ndarray:
    """Weights (bias last) of an L2 linear SVM with squared hinge loss, by dual coordinate descent."""
    x = np.hstack([x, np.full((len(x), 1), 0.1, np.float32)]).astype(np.float64)
    share = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    slack = 1 / (2 * c * share)
    q = (x * x).sum(axis=1) + slack
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            step = max(alpha[i] - (y[i] * (x[i] @ w) - 1 + slack[i] * alpha[i]) / q[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w += step * y[i] * x[i]
    w[-1] *= 0.1
    return w


@dataclass
class Model:
    """weights: (DIM + 1) x machines, its last row zero; machines: (level, positive, negative)."""

    families: list[str]
    languages: dict[str, list[str]]
    machines: list[tuple[str, str, str]]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets, null = K.buffers(batch.column("text"))
        langs: list[str] = []
        scores: list[np.ndarray] = []
        for a, b in K.chunks(offsets):
            part, o = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            ok = _has_letter(part, o) & bool(self.families)
            margin = self._margins(part, o)
            lang, score = self._decide(margin)
            langs += [x if k else "und" for x, k in zip(lang, ok, strict=True)]
            scores.append(np.where(ok, score, 0.0))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(np.concatenate(scores))], names=["doc_id", "held_out", "lang_pred", "score"])

    def _margins(self, part: np.ndarray, o: np.ndarray) -> np.ndarray:
        n = len(o) - 1
        out = np.zeros((n, len(self.machines)))
        if not len(part) or not self.machines:
            return out + self.bias
        full = np.flatnonzero(np.diff(o) > 0)
        total = np.zeros(n)
        at = o[full]
        # a text longer than a chunk is a chunk of its own: it is read in pieces
        for piece, more in _pieces(part) if n == 1 else ((part, 0),):
            for row in _indices(piece, np.array([0, len(piece)]) if n == 1 else o, more):
                total[full] += np.add.reduceat((row < DIM).astype(np.int64), at)
                for m in range(len(self.machines)):
                    out[full, m] += np.add.reduceat(self.weights[:, m][row], at)
        return out / np.maximum(total, 1)[:, None] + self.bias

    def _vote(self, margin: np.ndarray, level: str, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(winner, its mean pairwise probability): most duels won, then the largest sum of margins."""
        if len(names) == 1:
            return np.zeros(len(margin), np.int64), np.ones(len(margin))
        wins, sums, prob = (np.zeros((len(margin), len(names))) for _ in range(3))
        for m, (lv, p, q) in enumerate(self.machines):
            if lv == level:
                i, j, v = names.index(p), names.index(q), margin[:, m]
                s = 1 / (1 + np.exp(-np.clip(2.5 * v, -50, 50)))
                wins[:, i] += v >= 0
                wins[:, j] += v < 0
                sums[:, i] += v
                sums[:, j] -= v
                prob[:, i] += s
                prob[:, j] += 1 - s
        best = np.argmax(wins + 1e-6 * np.tanh(sums), axis=1)
        return best, prob[np.arange(len(best)), best] / (len(names) - 1)

    def _decide(self, margin: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.families:
            return ["und"] * len(margin), np.zeros(len(margin))
        fam, score = self._vote(margin, "", self.families)
        lang = np.empty(len(margin), object)
        for f, name in enumerate(self.families):
            at = fam == f
            if at.any():
                best, p = self._vote(margin[at], name, self.languages[name])
                lang[at] = np.array(self.languages[name], object)[best]
                score[at] *= p
        return lang.tolist(), score


def train(labelled: DataFrame, per_lang: int = PER_LANG, sample: int = SAMPLE) -> Model:
    """Fit on (doc_id, text, lang): a sample of about `per_lang` texts a language, `sample` in all."""
    labelled = labelled.where("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    each = min(per_lang, sample // max(1, len(counts)))
    pick = F.lit(False)
    for lang, n in sorted(counts.items()):
        pick = pick | ((F.col("lang") == lang) & (F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) < int((1 << 30) * min(1.0, each / n))))
    rows = map_batches(labelled.where(pick).select("lang", "text"), _features, "lang string, x binary").where("x is not null").collect()
    rows = sorted(((r["lang"], bytes(r["x"])) for r in rows), key=lambda r: r)
    if not rows:
        return Model([], {}, [], np.zeros((DIM + 1, 0), np.float32), np.zeros(0))
    lang = np.array([r[0] for r in rows], object)
    x = np.frombuffer(b"".join(r[1] for r in rows), np.float32).reshape(len(rows), DIM)
    scale = 1 / np.sqrt((x * x).sum(axis=1).mean())
    x = x * scale
    fam = np.array([family(v) for v in lang], object)
    families = sorted(set(fam))
    languages = {f: sorted(set(lang[fam == f])) for f in families}
    machines, w = [], []
    for level, names, of in [("", families, fam), *((f, languages[f], lang) for f in families)]:
        for i, p in enumerate(names):
            for q in names[i + 1 :]:
                at = (of == p) | (of == q)
                machines.append((level, p, q))
                w.append(svm(x[at], np.where(of[at] == p, 1.0, -1.0)))
    weights = np.zeros((DIM + 1, len(machines)), np.float32, order="F")
    if w:
        weights[:DIM] = np.array(w)[:, :DIM].T * scale
    return Model(families, languages, machines, weights, np.array([v[-1] for v in w]))


def identify(docs: DataFrame, held_out: Column, learn: Column) -> DataFrame:
    """Per row of docs (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    `learn` marks the rows whose lang may be learned from; lang, source and doc_id
    are never inputs of a prediction.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), held_out.alias("held_out"), learn.alias("learn"))
    shared = docs.sparkSession.sparkContext.broadcast(train(docs.where("learn")))
    return map_batches(docs.select("doc_id", "text", "held_out"), lambda b: shared.value.predict(b), "doc_id bigint, held_out boolean, lang_pred string, score double")
