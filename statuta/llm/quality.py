"""Quality classifier: a linear model on naive Bayes features (NB-SVM).

The indicator of an n-gram is scaled by the log-count ratio of the classes, and
a hinge-loss linear model is fitted to the scaled, length-normalised vectors by
dual coordinate descent.  N-grams (1 to 3) are of words and of word shapes
(case, digits, symbols, length, whether the word repeats the one before), hashed into
``DIM`` places.

Scores depend on the text alone.  The fit uses at most ``SAMPLE`` labelled rows
of each class, the ones whose hashed id is smallest: a documented bound on the
training set.  Everything else runs over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import batches, mixed, spans_hash, words_of

DIM, SAMPLE, ALPHA, COST, EPOCHS = 1 << 18, 4000, 1.0, 1.0, 12

#: Characters whose n-grams a worker holds at once; a longer text is held by itself.
HELD_CHARS = 1 << 18


def _counts(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[end] - total[start]


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, first): the distinct feature ids of each text, one after another, and where each text's begin."""
    all_ids, sizes = [], []
    for a, b in batches(texts, HELD_CHARS):
        data, start, end, first = words_of(texts[a:b])
        n = len(start)
        if n:
            word = spans_hash(data.astype(np.uint64), start, end)
            doc = np.searchsorted(first, np.arange(n), side="right") - 1
            size = end - start
            upper = _counts((data >= 65) & (data <= 90), start, end)
            lower = _counts(((data >= 97) & (data <= 122)) | (data >= 128), start, end)
            digit = _counts((data >= 48) & (data <= 57), start, end)
            symbol = size - upper - lower - digit
            same = np.zeros(n, bool)
            same[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
            case = np.where(upper == 0, np.where(lower > 0, 1, 0), np.where(lower == 0, 2, np.where(upper == 1, 3, 4)))
            shape = case + 5 * (digit > 0) + 10 * np.minimum(symbol, 3) + 40 * np.digitize(size, [2, 4, 8, 16]) + 200 * same
            shape = mixed(shape.astype(np.uint64) + np.uint64(1))
            grams, of = [], []
            for k, base in ((1, word), (2, word), (1, shape), (2, shape), (3, shape)):
                at = np.arange(n - k + 1)
                at = at[doc[at] == doc[at + k - 1]] if n >= k else np.zeros(0, np.int64)
                salt = np.uint64(k if base is word else 16 + k)
                grams.append(mixed(spans_hash(base, at, at + k) + salt) % np.uint64(DIM - 1) + np.uint64(1))
                of.append(doc[at])
            # Place 0 is there for every text, so that empty ones have a score as well.
            grams.append(np.zeros(b - a, np.uint64))
            of.append(np.arange(b - a))
            both = np.unique((np.concatenate(of).astype(np.uint64) << np.uint64(32)) | np.concatenate(grams))
            all_ids.append((both & np.uint64(0xFFFFFFFF)).astype(np.int32))
            sizes.append(np.bincount((both >> np.uint64(32)).astype(np.int64), minlength=b - a))
        else:
            all_ids.append(np.zeros(b - a, np.int32))
            sizes.append(np.ones(b - a, np.int64))
    sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    return (np.concatenate(all_ids) if all_ids else np.zeros(0, np.int32)), np.concatenate([[0], np.cumsum(sizes)])


class NbSvm:
    """weight: by feature id, ratio and linear weight multiplied; square: the ratio squared; bias."""

    def __init__(self, weight: np.ndarray, square: np.ndarray, bias: float):
        self.weight, self.square, self.bias = weight, square, bias

    def margins(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        if len(first) < 2:
            return np.zeros(0)
        dot = np.add.reduceat(self.weight[ids], first[:-1])
        norm = np.sqrt(np.add.reduceat(self.square[ids], first[:-1]))
        return dot / np.maximum(norm, 1e-9) + self.bias


def margins_of(model: NbSvm, texts: pa.Array, rows: int = 256) -> np.ndarray:
    """The margin of each text, ``rows`` of them at a time: a worker that stays idle keeps the memory of its largest step."""
    parts = [model.margins(*features(texts.slice(at, rows).to_pylist())) for at in range(0, len(texts), rows)]
    return np.concatenate(parts) if parts else np.zeros(0)


def fit(rows: list[np.ndarray], labels: np.ndarray, alpha: float = ALPHA, cost: float = COST, epochs: int = EPOCHS) -> NbSvm:
    """Fit to the feature ids of each row and labels 0 or 1; with one class only, every margin has its sign."""
    y = np.where(labels == 1, 1.0, -1.0)
    if not len(rows) or abs(y.sum()) == len(rows):
        return NbSvm(np.zeros(DIM), np.ones(DIM), 1.0 if not len(rows) else float(y[0]))
    p, q = np.full(DIM, alpha), np.full(DIM, alpha)
    for ids, sign in zip(rows, y, strict=True):
        (p if sign > 0 else q)[ids] += 1
    ratio = np.log((p / (np.sum(y > 0) + 2 * alpha)) / (q / (np.sum(y < 0) + 2 * alpha)))
    # The scaled rows are made where they are used: all of them at once would be twice the sample's ids in doubles.
    norms = [max(np.linalg.norm(ratio[i]), 1e-9) for i in rows]
    # A class with fewer rows weighs as much as the other.
    most = cost * len(y) / 2 / np.where(y > 0, np.sum(y > 0), np.sum(y < 0))
    w, bias, dual = np.zeros(DIM), 0.0, np.zeros(len(y))
    rng = np.random.default_rng(3)
    for _ in range(epochs):
        for k in rng.permutation(len(y)):
            ids = rows[k]
            v = ratio[ids] / norms[k]
            slope = y[k] * (w[ids] @ v + bias) - 1.0
            new = min(max(dual[k] - slope / (v @ v + 1.0), 0.0), most[k])
            if new != dual[k]:
                step = (new - dual[k]) * y[k]
                w[ids] += step * v
                bias += step
                dual[k] = new
    model = NbSvm(w * ratio, ratio * ratio, bias)
    model.bias -= _cut(np.array([w[i] @ (ratio[i] / n) for i, n in zip(rows, norms, strict=True)]) + bias, y)
    return model


def _cut(margins: np.ndarray, y: np.ndarray) -> float:
    """Where to cut the training margins: the middle of the gap with the fewest errors, both classes weighing alike."""
    order = np.argsort(margins, kind="stable")
    m, positive = margins[order], y[order] > 0
    below = np.concatenate([[0], np.cumsum(positive)]) / positive.sum()
    above = 1 - np.concatenate([[0], np.cumsum(~positive)]) / (~positive).sum()
    wrong = below + above
    edges = np.concatenate([[m[0] - 1], (m[1:] + m[:-1]) / 2, [m[-1] + 1]])
    gap = np.concatenate([[0], m[1:] - m[:-1], [0]])
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return float(edges[best[np.argmax(gap[best])]])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> NbSvm:
    """Fit on labelled rows whose crc32(doc_id as text) mod 3 is not 1; at most ``sample`` of each class.

    Labels other than 0 and 1 and null ids are left out; an id with both labels
    counts once for each.
    """
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)").where(~_held_out())
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = usable.where("quality = 0").distinct().orderBy(*order).limit(sample).unionByName(usable.where("quality = 1").distinct().orderBy(*order).limit(sample))
    # 2 * sample rows of two numbers: small whatever the input is.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def extract(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_iter:
            ids, first = features(batch.column("text").to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), lists], ["doc_id", "quality", "ids"])

    seen = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "text").mapInArrow(extract, "doc_id long, quality int, ids array<int>")
    table = seen.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "ids").limit(2 * sample).toArrow()
    rows = [np.asarray(r.values) if r.values is not None else np.zeros(0, np.int32) for r in table.column("ids")]
    return fit(rows, table.column("quality").to_numpy())


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_quality(docs: DataFrame, model: NbSvm) -> DataFrame:
    """``docs`` with score (double, 0 to 1) and predicted (int, 1 if score >= 0.5); all rows, other columns unchanged.

    A null text scores like an empty one.  Columns of the input named score or predicted are replaced.
    """
    docs = docs.drop("score", "predicted")
    weight, square, bias = model.weight.astype(np.float32), model.square.astype(np.float32), model.bias
    names = docs.columns

    def run(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = NbSvm(weight.astype(np.float64), square.astype(np.float64), bias)
        for batch in batch_iter:
            margin = margins_of(fitted, batch.column("text"))
            score = 1.0 / (1.0 + np.exp(-np.clip(2.0 * margin, -500, 500)))
            columns = [batch.column(c) for c in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32))], [*names, "score", "predicted"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema], "score double", "predicted int"])
    return docs.mapInArrow(run, schema)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    scored = score_quality(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", _held_out().alias("held_out"), "score", "predicted")
