"""Operator 8, quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_j w_j x_j + 1/2 sum_f [(sum_j v_jf x_j)^2 - sum_j v_jf^2 x_j^2]), which is linear in the
number of features. x holds the square roots of hashed word counts, scaled to unit length, and standardised statistics
of the whole text (the n_chars column, if there is one, is a further feature). Labels are learned from a bounded
sample: per class the SAMPLE rows with the smallest id hash among labelled rows of the learning split. Only their
sparse features reach the driver. Scoring is one pass over whole texts in Arrow batches, without a shuffle.

Defined cases: null text counts as empty and gets a score; null ids are learned from never and are not held out; an id
labelled twice counts with its lower quality; null labels are ignored; without labels of both classes the score
is the constant 0.5; an empty table gives an empty result; extra columns are ignored or pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import crosscheck_columns, remainder, small_batches, table

DIMS = 2048
RANK = 6
#: Labelled rows learned from, per class, at most.
SAMPLE = 3000
THRESHOLD = 0.7
EPOCHS = 12
_SPACES = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_KIND = np.zeros(256, np.int64)  # 0 other, 1 lower, 2 upper, 3 digit, 4 punctuation or symbol, 5 space, 6 non-ASCII
for _name, _code in (("abcdefghijklmnopqrstuvwxyz", 1), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), ("0123456789", 3),
                     ("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", 4), (" \t\n\x0b\x0c\r", 5)):
    _KIND[[ord(c) for c in _name]] = _code
_KIND[128:] = 6
N_STATS = 16


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every white-space word, by prefix sums of byte codes times powers of an odd number."""
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    inside = ~_SPACES[b]
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, np.uint64)
    place = np.arange(len(b), dtype=np.uint64) - np.repeat(start, np.diff(np.append(start, len(b)))).astype(np.uint64) \
        if start[0] == 0 else np.concatenate((np.zeros(start[0], np.uint64), np.arange(start[0], len(b), dtype=np.uint64)
                                              - np.repeat(start, np.diff(np.append(start, len(b)))).astype(np.uint64)))
    h = (b.astype(np.uint64) + np.uint64(1)) * (place * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h[~inside] = 0
    out = np.add.reduceat(h, start)
    return out ^ (out >> np.uint64(32)) ^ (stop - start).astype(np.uint64)


def features(text: str | None, n_chars: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed word dimensions, their values (unit length), and the statistics of one whole text."""
    data = (text or "").encode("utf-8", "replace")
    h = word_hashes(data.lower())
    stats = np.zeros(N_STATS, np.float32)
    lines = data.split(b"\n")
    if len(h):
        kinds = np.bincount(_KIND[np.frombuffer(data, np.uint8)], minlength=7) / len(data)
        stats[:7] = kinds
        b = np.frombuffer(data, np.uint8)
        k = _KIND[b]
        stats[7] = np.log1p(len(h))
        stats[8] = len(data) / len(h)
        stats[9] = len(np.unique(h)) / len(h)
        stats[10] = len(set(lines)) / len(lines)
        stats[11] = np.log1p(len(data) / len(lines))
        symbol = k == 4
        stats[12] = np.count_nonzero(symbol[1:] & symbol[:-1]) / len(h)  # runs of symbols
        stats[13] = np.count_nonzero((k[1:] == 2) & (k[:-1] == 2)) / len(h)  # runs of capitals
        stats[14] = np.bincount((h % np.uint64(4096)).astype(np.int64)).max() / len(h)  # commonest word
    stats[15] = np.log1p(max(0.0, n_chars))
    dims, counts = np.unique((h % np.uint64(DIMS)).astype(np.int64), return_counts=True)
    values = np.sqrt(counts).astype(np.float32)
    if len(values):
        values /= np.sqrt(counts.sum())
    return dims, values, stats


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        got = [features(t, c) for t, c in zip(pdf["text"], pdf["chars"])]
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"], "dims": [g[0] for g in got],
                            "vals": [g[1] for g in got], "stats": [g[2] for g in got]})


class Model:
    """Weights of a fitted machine; calling it on features gives probabilities."""

    def __init__(self, w0=0.0, w=None, v=None, mean=None, std=None):
        d = DIMS + N_STATS
        self.w0, self.w = float(w0), np.zeros(d, np.float32) if w is None else w
        self.v = np.zeros((d, RANK), np.float32) if v is None else v
        self.mean = np.zeros(N_STATS, np.float32) if mean is None else mean
        self.std = np.ones(N_STATS, np.float32) if std is None else std

    def dense(self, got: list) -> np.ndarray:
        x = np.zeros((len(got), DIMS + N_STATS), np.float32)
        for i, (dims, vals, stats) in enumerate(got):
            x[i, dims] = vals
            x[i, DIMS:] = np.clip((stats - self.mean) / self.std, -4, 4) * 0.5
        return x

    def margin(self, x: np.ndarray) -> np.ndarray:
        s = x @ self.v
        return self.w0 + x @ self.w + 0.5 * ((s * s) - (x * x) @ (self.v * self.v)).sum(axis=1)

    def __call__(self, got: list) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.dense(got)), -30, 30)))


def fit(got: list, label: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> Model:
    """Adagrad over mini-batches; classes weigh the same, so the threshold does not move with the sample's balance."""
    if len(set(label.tolist())) < 2:
        return Model()
    stats = np.array([g[2] for g in got])
    rng = np.random.default_rng(seed)
    m = Model(mean=stats.mean(axis=0), std=stats.std(axis=0) + 1e-3,
              v=rng.normal(0, 0.05, (DIMS + N_STATS, RANK)).astype(np.float32))
    weight = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    g0, gw, gv = 1e-6, np.full_like(m.w, 1e-6), np.full_like(m.v, 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(got))
        for at in range(0, len(order), 128):
            idx = order[at:at + 128]
            x = m.dense([got[i] for i in idx])
            err = (1 / (1 + np.exp(-np.clip(m.margin(x), -30, 30))) - label[idx]) * weight[idx] / len(idx)
            s = x @ m.v
            dw = x.T @ err + 1e-5 * m.w
            dv = x.T @ (err[:, None] * s) - m.v * ((x * x).T @ err)[:, None] + 1e-5 * m.v
            d0 = err.sum()
            g0 += d0 * d0
            gw += dw * dw
            gv += dv * dv
            m.w0 -= 0.1 * d0 / np.sqrt(g0)
            m.w -= (0.1 * dw / np.sqrt(gw)).astype(np.float32)
            m.v -= (0.03 * dv / np.sqrt(gv)).astype(np.float32)
    return m


def _chars(docs: DataFrame) -> Column:
    own = F.char_length(F.coalesce("text", F.lit("")))
    return (F.coalesce(F.col("n_chars").cast("double"), own.cast("double")) if "n_chars" in docs.columns
            else own.cast("double"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` rows of each class of the learning split."""
    crosscheck_columns(docs, "doc_id", "text")
    crosscheck_columns(labels, "doc_id", "quality")
    small_batches(docs.sparkSession)
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(remainder(F.col("doc_id"), 4) != 2)
    known = known.groupBy("doc_id").agg(F.min("quality").alias("label"))
    picked = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        picked = part if picked is None else picked.unionByName(part)
    rows = docs.select("doc_id", "text", _chars(docs).alias("chars"))
    rows = rows.join(F.broadcast(picked), "doc_id")  # at most 2 * sample rows of an id and a label
    got = rows.mapInPandas(_extract, "doc_id long, label int, dims array<int>, vals array<float>, stats array<float>")
    got = got.toPandas().drop_duplicates("doc_id").sort_values("doc_id")
    feats = [(np.asarray(d, np.int64), np.asarray(v, np.float32), np.asarray(s, np.float32))
             for d, v, s in zip(got["dims"], got["vals"], got["stats"])]
    return fit(feats, got["label"].to_numpy().astype(np.float64))


def scorer(model: Model):
    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for text, chars in batches:
            got = [features(t, c) for t, c in zip(text, chars)]
            yield pd.Series(model(got) if got else [], dtype="float64")
    return score


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(row: all columns of docs, score)."""
    small_batches(docs.sparkSession)
    return docs.select(F.struct("*").alias("row"), scorer(model)(F.col("text"), _chars(docs)).alias("score"))


def good_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the classifier accepts."""
    return score_documents(docs, model).where(F.col("score") >= threshold).select("row.*")


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = score_documents(docs.select("doc_id", "text", "n_chars"), train(docs, table(spark, sf_dir, "labels")))
    return out.select("row.doc_id", (remainder(F.col("row.doc_id"), 4) == 2).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


ORACLE = None
