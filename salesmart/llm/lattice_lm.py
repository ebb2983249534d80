"""Operator 7, language-model scoring by a subword lattice: the marginal likelihood over all segmentations.

The model draws pieces of an existing vocabulary independently, until the end symbol. A word is written with a leading
boundary mark, which only the first piece of a word can hold, so a text's marginal probability is the product of its
words' marginals and of the end. A word's marginal sums all its segmentations by a forward recursion in log space;
characters that the vocabulary lacks are spelled by its byte pieces. The vocabulary's own scores (merge ranks) give
the piece weights to begin with; corpus word counts of the learning documents then adapt them by
expectation-maximisation over the same lattice. The scores stay in as a prior that grows with the corpus: they make up
SHARE of the pieces counted, so they decide how pieces that the corpus lacks weigh against each other at every size.

Recursions run in blocks of BLOCK places. Scoring keeps the last few alphas only; learning keeps those at each block's
start and makes a block's alphas anew on the way back, so a word of any length takes little memory. Words of up to
WIDE places go through the same recursions many at a time, those of one length together; their pieces are found by 64-bit
polynomial hashes of all substrings (hashes of the vocabulary are checked to be distinct).

The base score needs the learning count of every token. The HOT_WORDS most frequent words (a list of bounded size) are
looked up in the scan; all others are joined with the whole count table, so the result is exact for every word.

Defined cases: null text counts as empty: one end token; null ids are learned from and not held out; repeated rows get
a row each; without learning documents all counts are 0 and the pieces keep their first weights; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import os
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate, groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import (ID, crosscheck_columns, lower_ascii, packed_id, remainder, small_batches, stage, table,
                                  unpacked_id, words)

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ROUNDS = 2
#: Weight of the vocabulary's own scores against corpus counts: a share of the pieces counted, and pieces at least.
SHARE = 0.01
PRIOR = 1000.0
#: Places of a word in one block of the recursions.
BLOCK = 4096
#: Places of a word that goes with others; places of all words in one array; words gathered before they are worked on.
WIDE = 128
PLACES = 1 << 16
GATHERED = 1 << 15
HOT_WORDS = 131072
HOT_CHARS = 64
MARK = "▁"
_CACHE = 400_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _codes(words: list[str], size: int) -> np.ndarray:
    """Code points of words of one length, a row for each."""
    return np.array(words, dtype=f"U{size}").view(np.uint32).reshape(len(words), size)


def _substrings(codes: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """Hashes of the substrings of length 1, 2, ... by their start."""
    keys = last = codes.astype(np.uint64) + np.uint64(1)
    yield keys
    for n in range(2, min(longest, codes.shape[1]) + 1):
        keys = keys[:, :-1] * _FACTOR + last[:, n - 1:]
        yield keys


def _slots(keys: np.ndarray) -> np.ndarray:
    return (keys * _FACTOR) >> np.uint64(44)


def _groups(words: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
    """Words of one length, with the code points of mark and word, in bounded groups."""
    words = sorted(words, key=len)
    for size, same in groupby(words, len):
        same = list(same)
        step = max(1, PLACES // (size + 1))
        for k in range(0, len(same), step):
            part = same[k:k + step]
            yield part, _codes([MARK + w for w in part], size + 1)


class Lattice:
    """Piece weights and the recursions over them."""

    def __init__(self, pieces: list[str], probs: np.ndarray, byte_probs: np.ndarray, end: float):
        self.pieces, self.probs, self.byte_probs, self.end = pieces, probs, byte_probs, end
        self._log = self._places = None

    def _logs(self):
        if self._log is None:
            self._log = {p: math.log(x) for p, x in zip(self.pieces, self.probs.tolist())}
            self._bytes = [math.log(x) for x in self.byte_probs.tolist()]
            self._longest = max(map(len, self.pieces), default=1)
            self._seen: dict[str, float] = {}
            self._tables = {}
            of_length: dict[int, list[int]] = {}
            for k, p in enumerate(self.pieces):
                of_length.setdefault(len(p), []).append(k)
            for n, ks in sorted(of_length.items()):
                keys = list(_substrings(_codes([self.pieces[k] for k in ks], n), n))[-1][:, 0]
                order = np.argsort(keys)
                keys, ks = keys[order], np.array(ks)[order]
                if (keys[1:] == keys[:-1]).any():
                    raise ValueError("two pieces of the vocabulary have one hash")
                maybe = np.zeros(1 << 20, dtype=bool)
                maybe[_slots(keys)] = True
                self._tables[n] = (maybe, keys, ks, np.log(self.probs[ks]))
        return self._log

    def _weights(self, codes: np.ndarray) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray], np.ndarray]:
        """For words of one length: log weights and piece numbers (or -1) by piece length and start; spelled places."""
        weights, pieces = {}, {}
        for n, keys in enumerate(_substrings(codes, self._longest), 1):
            if n in self._tables:
                maybe, known, ks, logs = self._tables[n]
                weights[n], pieces[n] = np.full(keys.shape, -np.inf), np.full(keys.shape, -1)
                row, place = np.nonzero(maybe[_slots(keys)])  # few substrings get as far as the search
                wanted = keys[row, place]
                at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                hit = known[at] == wanted
                weights[n][row[hit], place[hit]], pieces[n][row[hit], place[hit]] = logs[at[hit]], ks[at[hit]]
        if 1 not in weights:
            weights[1], pieces[1] = np.full(codes.shape, -np.inf), np.full(codes.shape, -1)
        spelt = pieces[1] < 0
        for c in np.unique(codes[spelt]):
            weights[1][spelt & (codes == c)] = sum(self._bytes[b] for b in chr(c).encode("utf-8", "replace"))
        return weights, pieces, spelt

    @staticmethod
    def _alphas(weights: dict[int, np.ndarray], size: int) -> list[np.ndarray]:
        alpha = [np.zeros(len(weights[1]))]
        for j in range(1, size + 1):
            alpha.append(np.logaddexp.reduce([alpha[j - n] + w[:, j - n] for n, w in weights.items() if n <= j]))
        return alpha

    def log10_of(self, words: Iterable[str]) -> dict[str, float]:
        """log10 of the marginal probability of each word."""
        self._logs()
        out = {w: self._seen[w] for w in words if w in self._seen}
        new = [w for w in words if w not in out]
        for group, codes in _groups([w for w in new if len(w) < WIDE]):
            got = self._alphas(self._weights(codes)[0], codes.shape[1])[-1] / math.log(10)
            out.update(zip(group, got.tolist()))
        out.update((w, self.log10(w)) for w in new if len(w) >= WIDE)
        return out

    def expect_all(self, times: dict[str, float], counts: np.ndarray, spelled: np.ndarray) -> None:
        """Add the expected counts of words: by piece number, and of bytes."""
        self._logs()
        for group, codes in _groups([w for w in times if len(w) < WIDE]):
            size = codes.shape[1]
            weights, pieces, spelt = self._weights(codes)
            alpha = self._alphas(weights, size)
            n_times = np.array([times[w] for w in group])
            beta = [np.zeros(0)] * size + [np.zeros(len(group))]
            for i in range(size - 1, -1, -1):
                beta[i] = np.logaddexp.reduce([w[:, i] + beta[i + n] for n, w in weights.items() if i + n <= size])
            a, b = np.stack(alpha, 1), np.stack(beta, 1)
            for n, w in weights.items():
                share = n_times[:, None] * np.exp(a[:, :size - n + 1] + w + b[:, n:] - a[:, -1:])
                hit = pieces[n] >= 0
                counts += np.bincount(pieces[n][hit], share[hit], len(counts))
                if n == 1:
                    for c in np.unique(codes[spelt]):
                        for byte in chr(c).encode("utf-8", "replace"):
                            spelled[byte] += share[spelt & (codes == c)].sum()
        for w in times:
            if len(w) >= WIDE:
                one: dict[str, float] = {}
                self.expect(w, times[w], one, spelled)
                for piece, n in one.items():
                    counts[self._place(piece)] += n

    def _place(self, piece: str) -> int:
        if self._places is None:
            self._places = {p: k for k, p in enumerate(self.pieces)}
        return self._places[piece]

    def __getstate__(self):
        return {"pieces": self.pieces, "probs": self.probs, "byte_probs": self.byte_probs, "end": self.end, "_log": None,
                "_places": None}

    def _edges(self, s: str, j: int) -> list[tuple[int, float, str | None]]:
        """Pieces that end at j: (start, log weight, piece, or None for bytes)."""
        log, out = self._logs(), []
        for i in range(max(0, j - self._longest), j):
            w = log.get(s[i:j])
            if w is not None:
                out.append((i, w, s[i:j]))
        if s[j - 1] not in log:
            out.append((j - 1, sum(self._bytes[b] for b in s[j - 1].encode("utf-8", "replace")), None))
        return out

    def _forward(self, s: str, lo: int, before: list[float]) -> tuple[list[float], int, list]:
        """Alphas of the block of places after lo, after the ones before; the first one's place; the block's edges."""
        alpha, first, edges = list(before), lo - len(before) + 1, []
        for j in range(lo + 1, min(lo + BLOCK, len(s)) + 1):
            e = self._edges(s, j)
            v = [alpha[i - first] + w for i, w, _ in e]
            top = max(v)
            alpha.append(top + math.log(sum([math.exp(x - top) for x in v])) if len(v) > 1 else top)
            edges.append(e)
        return alpha, first, edges

    def log10(self, word: str) -> float:
        """log10 of the marginal probability of one word."""
        self._logs()
        got = self._seen.get(word)
        if got is None:
            s, before = MARK + word, [0.0]
            for lo in range(0, len(s), BLOCK):
                before = self._forward(s, lo, before)[0][-self._longest:]
            got = before[-1] / math.log(10)
            if len(word) <= HOT_CHARS:
                if len(self._seen) >= _CACHE:
                    self._seen.clear()
                self._seen[word] = got
        return got

    def expect(self, word: str, times: float, counts: dict[str, float], spelled: np.ndarray) -> None:
        """Add the expected piece counts of a word that occurs so many times."""
        self._logs()
        s, before, heads = MARK + word, [0.0], []
        for lo in range(0, len(s), BLOCK):
            heads.append((lo, before))
            block = self._forward(s, lo, before)
            before = block[0][-self._longest:]
        total, beta = before[-1], {len(s): 0.0}
        for lo, before in reversed(heads):
            alpha, first, edges = block if lo == heads[-1][0] else self._forward(s, lo, before)
            for j in range(lo + len(edges), lo, -1):
                b = beta.pop(j, -math.inf)
                if b == -math.inf:
                    continue
                for i, w, piece in edges[j - lo - 1]:
                    x = w + b
                    share = times * math.exp(alpha[i - first] + x - total)
                    if piece is None:
                        for c in s[j - 1].encode("utf-8", "replace"):
                            spelled[c] += share
                    else:
                        counts[piece] = counts.get(piece, 0.0) + share
                    old = beta.get(i, -math.inf)
                    hi, low = (old, x) if old > x else (x, old)
                    beta[i] = hi if low == -math.inf else hi + math.log1p(math.exp(low - hi))


def read_vocabulary(path: str = VOCABULARY) -> Lattice:
    """Pieces without white space inside; weights from the file's scores: the rank r (score -r) weighs 1 / (r + 10).

    The driver alone reads the file; the tasks get the pieces with their function.
    """
    import sentencepiece
    if not os.path.isfile(path):
        raise FileNotFoundError(f"no vocabulary at {path}: pass the path of a sentencepiece model that the driver can read")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, weights, last = [], [], 1.0
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or MARK in p[1:]:
            continue
        pieces.append(p)
        weights.append(1.0 / (10.0 - sp.get_score(i)))
        last = min(last, weights[-1])
    w = np.array(weights)
    total = w.sum() + 257 * last
    return Lattice(pieces, w / total, np.full(256, last / total), last / total)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over whole texts."""
    return docs.select(F.explode(words(lower_ascii(F.coalesce("text", F.lit(""))))).alias("word")).groupBy("word").agg(
        F.count("*").alias("c"))


def _expected(model: Lattice):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, spelled = np.zeros(len(model.pieces)), np.zeros(256)
        times: dict[str, float] = {}
        for pdf in batches:
            times.update(zip(pdf["word"], pdf["c"].astype(float)))
            if len(times) >= GATHERED:
                model.expect_all(times, counts, spelled)
                times = {}
        model.expect_all(times, counts, spelled)
        some = np.flatnonzero(counts)
        keys = [model.pieces[k] for k in some] + [f"{MARK}{MARK}{b}" for b in range(256)]
        yield pd.DataFrame({"piece": keys, "n": counts[some].tolist() + spelled.tolist()})
    return run


def adapt(model: Lattice, counts: DataFrame, n_docs: int, rounds: int = ROUNDS, share: float = SHARE) -> Lattice:
    """Expectation-maximisation over the word counts; what comes back is one number per vocabulary piece."""
    first = model
    # the count table is small in bytes and dear in work: it is dealt to as many tasks as a shuffle has
    counts = counts.repartition(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    for _ in range(rounds):
        got = counts.mapInPandas(_expected(model), "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        n = {r.piece: r.n for r in got.collect()}
        # pieces counted, and as many ends as documents
        prior = max(PRIOR, share / (1 - share) * (math.fsum(n.values()) + n_docs))
        probs = first.probs * prior + np.array([n.get(p, 0.0) for p in first.pieces])
        spelled = first.byte_probs * prior + np.array([n.get(f"{MARK}{MARK}{b}", 0.0) for b in range(256)])
        end = first.end * prior + n_docs
        total = probs.sum() + spelled.sum() + end
        # nine digits: sums of doubles come in any order
        digits = lambda x: np.array([float(f"{v:.9g}") for v in np.atleast_1d(x / total)])
        model = Lattice(first.pieces, digits(probs), digits(spelled), float(digits(end)[0]))
    return model


def frequent(counts: DataFrame, most: int) -> dict[str, int]:
    """Words with the highest counts, at most so many; counts of one step of a log scale go together."""
    step = F.floor(F.log2("c") * 64).alias("step")
    counts = counts.where(F.char_length("word") <= HOT_CHARS)
    sizes = sorted(counts.groupBy(step).count().collect(), reverse=True)  # at most 64 * 63 steps
    upto = [r.step for r, total in zip(sizes, accumulate(r["count"] for r in sizes)) if total <= most]
    if not upto:
        return {}
    return {r.word: r.c for r in counts.where(step >= upto[-1]).collect()}


def _score(model: Lattice, hot: dict[str, int]):
    of_hot = model.log10_of(hot)
    known = {w.encode(): (of_hot[w], math.log10(c + 1)) for w, c in hot.items()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end = math.log10(model.end)
        scores: dict[bytes, float] = {}
        for pdf in batches:
            out = []
            texts = [Counter((text or "").encode("utf-8", "replace").lower().split()) for text in pdf["text"]]
            new = {w: w.decode("utf-8") for w in set().union(*texts) if w not in known and w not in scores}
            if len(scores) > _CACHE:
                scores = {}
                new = {w: w.decode("utf-8") for w in set().union(*texts) if w not in known}
            made = model.log10_of(new.values())
            scores.update((w, made[word]) for w, word in new.items())
            for ws in texts:
                n_known, total, score, rest, times = 0, 0.0, end, [], []
                for w, tf in ws.items():
                    got = known.get(w)
                    if got is None:
                        score += tf * scores[w]
                        rest.append(w.decode("utf-8"))
                        times.append(tf)
                    else:
                        n_known += tf
                        score += tf * got[0]
                        total += tf * got[1]
                out.append((ws.total() + 1, n_known, total, score, rest, times))
            cols = list(zip(*out)) or [[]] * 6
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "no_id": pdf["no_id"].to_numpy(),
                                "held_out": pdf["held_out"].to_numpy(), "n": cols[0], "known": cols[1], "total": cols[2],
                                "score": cols[3], "rest": cols[4], "times": cols[5]})
    return run


def lm_scores(docs: DataFrame, vocabulary: str = VOCABULARY, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs."""
    crosscheck_columns(docs, "doc_id", "text")
    small_batches(docs.sparkSession)
    docs = docs.select(*packed_id(F.col("doc_id")), "text", (remainder(F.col("doc_id"), 7) == 2).alias("held_out"))
    learn = docs.where("NOT held_out")
    counts = stage(word_counts(learn), "counts")
    n_docs = learn.count()
    size = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n_all, v_all = (size.n or 0) + n_docs, size.v + (n_docs > 0)
    model = adapt(read_vocabulary(vocabulary), counts, n_docs, rounds)
    rows = docs.mapInPandas(_score(model, frequent(counts, HOT_WORDS)),
                            f"{ID}, held_out boolean, n long, known long, total double, score double, "
                            "rest array<string>, times array<int>")
    # the row number is written with the rows, so it is the same whenever they are read
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "scored")
    rest = rows.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x"))
    rest = rest.select("row", F.col("x.rest").alias("word"), F.col("x.times").alias("tf")).join(counts, "word")
    rest = rest.groupBy("row").agg(F.sum(F.col("tf").cast("long")).alias("more"),
                                   F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("plus"))
    out = rows.drop("rest", "times").join(rest, "row", "left")
    one = math.log10(n_all + v_all + 1)
    extra = math.log10(n_docs + 1)  # the end of the text
    base = F.col("total") + F.coalesce("plus", F.lit(0.0)) + F.lit(extra) - F.col("n") * F.lit(one)
    known = F.col("known") + F.coalesce("more", F.lit(0)) + F.lit(int(n_docs > 0))
    return out.select(unpacked_id(), "held_out", F.col("n").alias("n_tokens"), known.cast("long").alias("n_known"),
                      F.lit(n_all).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def query(spark, sf_dir, vocabulary: str = VOCABULARY):
    return lm_scores(table(spark, sf_dir, "documents"), vocabulary)


ORACLE = None
