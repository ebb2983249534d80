"""Operator 3, language identification by a linear-chain conditional random field over the words of a text.

A word's emission sums weights of hashed affixes and character n-grams and of a lexicon of frequent words; learned
transitions tie neighbouring words. Forward-backward gives every word's posterior, so code-switched text gets a label
per word; a document's language is the label with the largest mean posterior over its words with letters.

The field knows every language of the table and is fitted on a bounded sample: of each language the rows with the
smallest id hash, SAMPLE of them, or with many languages an equal share of ROWS rows, but LEAST in any case; windows of
their words are chained at random into code-switched sequences. Scoring reads whole texts
in Arrow batches without a shuffle. Long texts cost no longer loops: words are cut into blocks, block products of the
4 x 4 (languages squared) transfer matrices are made for all blocks of a batch at once, and only these are chained, so
posteriors are exact whatever a text's length.

Defined cases: null text or text without a letter is 'und' with score 0; rows with null lang or id are not learned
from; without learnable rows every text is 'und'; ties go to the label that sorts first; repeated rows get a row each;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import ID, crosscheck_columns, packed_id, remainder, small_batches, table, unpacked_id

DIMS = 1 << 15
#: Bounds of what is learned from: rows in all, rows of a language and their least number, words of a row's windows, chained
#: sequences (with many languages, so many of each).
ROWS = 8000
SAMPLE = 250
LEAST = 10
WINDOW = 12
#: Windows that the sample takes of a learned row, spread evenly over its whole text (all of a text of up to 240 words).
WINDOWS = 20
SEQUENCES = 4000
SEQUENCES_EACH = 20
LENGTH = 36
LEXICON = 20_000
EPOCHS = 4
BLOCK = 48
#: Characters of a word; longer runs without white space, as in Chinese or Japanese text, are cut into words of this length.
CHUNK = 48
_CACHE = 300_000
#: Words times languages of texts that are tagged together.
_TOGETHER = 1 << 22
_LETTER = re.compile(r"[^\W\d_]")


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of many words: feature numbers, and for each the word it belongs to (ascending).

    A marked word <w> gives its affixes of one to three characters and all two- and three-character n-grams.
    """
    marked = [f"<{w.lower()}>" for w in words]
    size = np.array([len(m) for m in marked], np.int64)
    c = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), size)
    end = np.cumsum(size)
    left = np.repeat(end, size) - np.arange(len(c))  # characters from here to the word's end

    def mix(kind: int, *cols: np.ndarray) -> np.ndarray:
        h = np.full(len(cols[0]), kind, np.uint64)
        for x in cols:
            h = (h ^ x) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return (h % np.uint64(DIMS)).astype(np.int64)
    ids, owners = [], []
    for k in (2, 3):
        at = np.flatnonzero(left >= k)
        ids.append(mix(k, *[c[at + i] for i in range(k)]))
        owners.append(owner[at])
    for k in (1, 2, 3):
        w = np.flatnonzero(size - 2 >= k)
        head, tail = end[w] - size[w] + 1, end[w] - 1 - k
        ids += [mix(10 + k, *[c[head + i] for i in range(k)]), mix(20 + k, *[c[tail + i] for i in range(k)])]
        owners += [w, w]
    ids, owners = np.concatenate(ids), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return ids[order], owners[order]


class Field:
    """Weights: emissions (DIMS x L), lexicon (word -> row of log odds), transitions (L x L)."""

    def __init__(self, labels: list[str]):
        n = len(labels)
        self.labels = labels
        self.w = np.zeros((DIMS, n), np.float32)
        self.lexicon: dict[str, int] = {}
        self.odds = np.zeros((1, n), np.float32)
        self.lex_weight = 1.0
        self.trans = np.zeros((n, n))

    def emissions(self, words: list[str]) -> np.ndarray:
        ids, owner = word_features(words)
        count = np.bincount(owner, minlength=len(words))
        e = np.add.reduceat(self.w[ids], np.cumsum(count) - count, axis=0) / np.sqrt(count)[:, None]
        at = np.array([self.lexicon.get(w.lower(), -1) for w in words])
        return e + np.where((at >= 0)[:, None], self.lex_weight * self.odds[np.maximum(at, 0)], 0.0)


def posteriors(e: np.ndarray, lengths: np.ndarray, trans: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Posterior label probabilities of all words; e: log emissions of the words of all texts, one after another.

    lengths are positive. Words are cut into blocks; blocks are sorted by length, so those with a t-th word are a slice.
    """
    total, n = e.shape
    x = np.exp(e - e.max(axis=1, keepdims=True))
    a = np.exp(trans - trans.max())
    starts = np.cumsum(lengths) - lengths
    blocks = -(-lengths // block)
    text = np.repeat(np.arange(len(lengths)), blocks)
    first = np.cumsum(blocks) - blocks
    no = np.arange(len(text)) - first[text]
    at, size = starts[text] + no * block, np.minimum(block, lengths[text] - no * block)
    order = np.argsort(-size, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))  # where block b of a text is in the sorted arrays
    at, size, nb = at[order], size[order], len(order)
    longest = int(size[0])
    live = np.array([np.searchsorted(-size, -t, side="left") for t in range(longest)])  # blocks longer than t
    spot = np.minimum(at[None, :] + np.arange(longest)[:, None], total - 1)
    xs = x[spot]
    # a block's transfer matrix: the product of trans * emission over its words
    prod = np.tile(np.eye(n), (nb, 1, 1))
    if int(blocks.max()) > 1:
        for t in range(longest):
            m = live[t]
            prod[:m] = (prod[:m].reshape(-1, n) @ a).reshape(m, n, n) * xs[t, :m, None, :]
            if t % 8 == 7 or t == longest - 1:
                prod /= prod.max(axis=(1, 2), keepdims=True)
    # chain blocks: a vector before each block and one after it. The start u with u @ a = 1 stands for a uniform start
    fore, back = np.zeros((nb, n)), np.ones((nb, n))
    fore[place[first]] = np.linalg.lstsq(a.T, np.ones(n), rcond=None)[0]
    for k in range(1, int(blocks.max())):
        b = first[blocks > k] + k
        v = np.einsum("bi,bij->bj", fore[place[b - 1]], prod[place[b - 1]])
        fore[place[b]] = v / np.abs(v).sum(axis=1, keepdims=True)
    last = first + blocks - 1
    for k in range(1, int(blocks.max())):
        b = last[blocks > k] - k
        v = np.einsum("bij,bj->bi", prod[place[b + 1]], back[place[b + 1]])
        back[place[b]] = v / v.sum(axis=1, keepdims=True)
    # inside all blocks at once
    alpha = np.ones((longest, nb, n))
    for t in range(longest):
        m = live[t]
        v = np.maximum((fore[:m] @ a) * xs[t, :m], 1e-300)
        fore[:m] = alpha[t, :m] = v / v.sum(axis=1, keepdims=True)
    for t in range(longest - 1, -1, -1):
        m = live[t]
        alpha[t, :m] *= back[:m]
        v = (xs[t, :m] * back[:m]) @ a.T
        back[:m] = v / v.sum(axis=1, keepdims=True)
    there = np.arange(longest)[:, None] < size[None, :]
    out = np.empty((total, n))
    p = alpha[there]
    out[spot[there]] = p / p.sum(axis=1, keepdims=True)
    return out


def _expectations(e: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word posteriors and summed neighbour posteriors of sequences of one length (forward-backward, scaled)."""
    x, a = np.exp(e - e.max(axis=2, keepdims=True)), np.exp(trans)
    alpha, beta = np.empty_like(x), np.ones_like(x)
    for t in range(x.shape[1]):
        v = x[:, t] if t == 0 else (alpha[:, t - 1] @ a) * x[:, t]
        alpha[:, t] = v / v.sum(axis=1, keepdims=True)
    for t in range(x.shape[1] - 2, -1, -1):
        v = (x[:, t + 1] * beta[:, t + 1]) @ a.T
        beta[:, t] = v / v.sum(axis=1, keepdims=True)
    p = alpha * beta
    n = x.shape[2]
    left, right = alpha[:, :-1].reshape(-1, n), (x * beta)[:, 1:].reshape(-1, n)
    left = left / ((left @ a) * right).sum(axis=1, keepdims=True)
    return (p / p.sum(axis=2, keepdims=True)).reshape(-1, n), a * (left.T @ right)


def fit(texts: list[list[str]], langs: list[str], epochs: int = EPOCHS, seed: int = 3) -> Field | None:
    """Fit on word lists and their languages: log likelihood of chained sequences by Adagrad."""
    labels = sorted(set(langs))
    if not labels:
        return None
    field, rng, n = Field(labels), np.random.default_rng(seed), len(labels)
    of = [labels.index(x) for x in langs]
    seen = Counter((w.lower(), y) for ws, y in zip(texts, of) for w in ws)
    sums = Counter()
    for (w, _), c in seen.items():
        sums[w] += c
    common = sorted((w for w, c in sums.items() if c >= 4), key=lambda w: (-sums[w], w))[:LEXICON]
    field.lexicon = {w: i for i, w in enumerate(common)}
    table_ = np.array([[seen[w, y] + 0.5 for y in range(n)] for w in common] or [[1.0] * n])
    field.odds = np.log(table_ / table_.sum(axis=1, keepdims=True)).astype(np.float32)
    windows = [(ws[i:i + WINDOW], y) for ws, y in zip(texts, of) for i in range(0, len(ws), WINDOW)]
    if not windows:
        return field
    rows, ys = [], []
    by = [[k for k, (_, y) in enumerate(windows) if y == lab] for lab in range(n)]
    by = [x for x in by if x]
    for _ in range(max(SEQUENCES, SEQUENCES_EACH * n)):
        ws, y, group = [], [], by[rng.integers(len(by))]
        while len(ws) < LENGTH:
            if rng.random() < 0.3:
                group = by[rng.integers(len(by))]
            part, lab = windows[group[rng.integers(len(group))]]
            ws += part
            y += [lab] * len(part)
        rows.append(ws[:LENGTH])
        ys.append(y[:LENGTH])
    vocab = {w: i for i, w in enumerate(sorted({w for r in rows for w in r}))}
    ids, owner = word_features(list(vocab))
    count = np.bincount(owner, minlength=len(vocab))
    width = int(count.max())
    idx = np.full((len(vocab), width), DIMS, np.int64)
    idx[owner, np.arange(len(ids)) - np.repeat(np.cumsum(count) - count, count)] = ids
    scale = 1 / np.sqrt(count)
    lex = np.array([field.lexicon.get(w.lower(), -1) for w in vocab])
    lex_row = np.where((lex >= 0)[:, None], field.odds[np.maximum(lex, 0)], 0.0)
    seq, y = np.array([[vocab[w] for w in r] for r in rows]), np.array(ys)
    w = np.zeros((DIMS + 1, n))
    gw, gt, gl = np.full_like(w, 1e-8), np.full((n, n), 1e-8), 1e-8
    step = max(10, min(100, 3200 // n))  # bounds the weights held at once
    for _ in range(epochs):
        for at in range(0, len(seq), step):
            s, lab = seq[at:at + step], y[at:at + step]
            flat = s.ravel()
            e = w[idx[flat]].sum(axis=1) * scale[flat][:, None] + field.lex_weight * lex_row[flat]
            p, dt = _expectations(e.reshape(len(s), LENGTH, n), field.trans)
            err = p.copy()
            err[np.arange(len(flat)), lab.ravel()] -= 1
            np.add.at(dt, (lab[:, :-1].ravel(), lab[:, 1:].ravel()), -1.0)
            dw = np.zeros_like(w)
            cols = idx[flat].ravel()
            for k in range(n):
                dw[:, k] = np.bincount(cols, np.repeat(err[:, k] * scale[flat], width), DIMS + 1)
            dw[DIMS] = 0
            dl = float((err * lex_row[flat]).sum())
            gw += dw * dw
            gt += dt * dt
            gl += dl * dl
            w -= 0.2 * dw / np.sqrt(gw)
            field.trans = field.trans - 0.05 * dt / np.sqrt(gt)
            field.lex_weight -= 0.05 * dl / np.sqrt(gl)
    field.w = w[:DIMS].astype(np.float32)
    return field


class Tagger:
    """Labels the words of many texts at once; keeps emissions of words it has seen."""

    def __init__(self, field: Field):
        self.field, self.ids, self.rows = field, {}, np.zeros((0, len(field.labels)))

    def _emissions(self, texts: list[list[str]]) -> np.ndarray:
        if len(self.ids) > min(_CACHE, (1 << 24) // len(self.field.labels)):
            self.ids, self.rows = {}, np.zeros((0, len(self.field.labels)))
        ids, new = self.ids, []
        for ws in texts:
            for w in ws:
                if w not in ids:
                    ids[w] = len(ids)
                    new.append(w)
        if new:
            self.rows = np.concatenate((self.rows, self.field.emissions(new)))
        return self.rows[[ids[w] for ws in texts for w in ws]]

    def __call__(self, texts: list[list[str]]) -> list[np.ndarray]:
        out, at, held = [], 0, 0
        for i, t in enumerate(texts):
            if i > at and (held + len(t)) * len(self.field.labels) > _TOGETHER:
                out += self._tag(texts[at:i])
                at, held = i, 0
            held += len(t)
        return out + self._tag(texts[at:])

    def _tag(self, texts: list[list[str]]) -> list[np.ndarray]:
        lengths = np.array([len(t) for t in texts], np.int64)
        keep = np.flatnonzero(lengths)
        out = [np.zeros((0, len(self.field.labels)))] * len(texts)
        if len(keep):
            block = max(BLOCK, len(self.field.labels))  # a block's matrix takes no more than its words
            p = posteriors(self._emissions(texts), lengths[keep], self.field.trans, block)
            for i, part in zip(keep, np.split(p, np.cumsum(lengths[keep])[:-1])):
                out[i] = part
        return out


def lettered(text: str | None) -> list[str]:
    """The words of a text that have a letter; a run of more than CHUNK characters is so many words of that length."""
    runs = (text or "").split()
    if any(len(w) > CHUNK for w in runs):
        runs = [w[i:i + CHUNK] for w in runs for i in range(0, len(w), CHUNK)]
    return [w for w in runs if w.isalpha() or _LETTER.search(w)]


def _predict(field: Field | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(field) if field else None
        for pdf in batches:
            texts = [lettered(t) for t in pdf["text"]]
            pred, score, switches = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            for i, p in enumerate(tagger(texts) if tagger else []):
                if len(p):
                    mean = p.mean(axis=0)
                    k = int(mean.argmax())
                    pred[i], score[i] = field.labels[k], min(1.0, float(mean[k]))
                    switches[i] = np.count_nonzero(np.diff(p.argmax(axis=1)))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "no_id": pdf["no_id"], "held_out": pdf["held_out"], "lang_pred": pred, "score": score,
                                "n_words": [len(t) for t in texts], "n_switches": switches})
    return run


def train(docs: DataFrame, sample: int = SAMPLE) -> Field | None:
    """Fit on a sample of every language in the learning split, at most WINDOWS windows of words of each row."""
    crosscheck_columns(docs, "doc_id", "text", "lang")
    rows = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL")
    rows = rows.where(remainder(F.col("doc_id"), 4) != 2).select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    langs, quota = sorted(counts), min(sample, max(LEAST, ROWS // len(counts)))
    # only a share of the hash range that surely has enough rows is put in order
    tops = docs.sparkSession.createDataFrame(
        [(x, min(1.0, (2 * quota + 100) / counts[x]) * 2.0 ** 64 - 2.0 ** 63) for x in langs], "lang string, top double")
    first = rows.join(F.broadcast(tops), "lang").where(F.col("h").cast("double") <= F.col("top"))
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = first.withColumn("no", F.row_number().over(order)).where(F.col("no") <= quota).select("doc_id")
    # quota ids of each language; of each row the words of windows spread over the text come to the driver
    got = docs.select("doc_id", "text", "lang").join(F.broadcast(picked), "doc_id").mapInPandas(
        _windows, "doc_id long, lang string, words array<string>").toPandas()
    got = got[got["lang"].isin(langs)].drop_duplicates(["doc_id", "lang"]).sort_values(["doc_id", "lang"])
    return fit([list(w) for w in got["words"]], list(got["lang"]))


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for text in pdf["text"]:
            ws = lettered(text)
            step = max(WINDOW, -(-len(ws) // WINDOWS))
            out.append([w for i in range(0, len(ws), step) for w in ws[i:i + WINDOW]])
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "lang": pdf["lang"], "words": out})


def identify(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_words, n_switches for every row of docs."""
    small_batches(docs.sparkSession)
    rows = docs.select(*packed_id(F.col("doc_id")), "text", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"))
    out = rows.mapInPandas(_predict(field), f"{ID}, held_out boolean, lang_pred string, score double, n_words long, "
                                            "n_switches long")
    return out.withColumn("doc_id", unpacked_id()).drop("no_id")


def label_words(field: Field, text: str) -> list[tuple[str, str]]:
    """Each lettered word of a text with its most likely label."""
    ws = lettered(text)
    return [(w, field.labels[int(k)]) for w, k in zip(ws, Tagger(field)([ws])[0].argmax(axis=1))]


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    small_batches(spark)
    return identify(docs, train(docs))


ORACLE = None
