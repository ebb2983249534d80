"""Blocks of the lattice recursions, the share of the vocabulary's scores, and a missing vocabulary."""

import random

import numpy as np
import pytest

from salesmart.llm import lattice_lm


def lattice():
    return lattice_lm.Lattice(["▁", "▁a", "a", "b", "ab", "ba", "▁ab"], np.array([.1, .1, .2, .1, .2, .1, .1]),
                              np.full(256, 1e-4), 0.05)


def test_blocks_change_nothing(monkeypatch):
    rng = random.Random(3)
    for length in (1, 4, 5, 6, 40, 203):
        word = "".join(rng.choice("abé") for _ in range(length))
        whole, counts, spelled = lattice(), {}, np.zeros(256)
        whole.expect(word, 3.0, counts, spelled)
        want = whole.log10(word)
        for block in (2, 5):
            monkeypatch.setattr(lattice_lm, "BLOCK", block)
            parts, got, got_spelled = lattice(), {}, np.zeros(256)
            parts.expect(word, 3.0, got, got_spelled)
            assert parts.log10(word) == pytest.approx(want)
            assert got == pytest.approx(counts) and got_spelled == pytest.approx(spelled)
        monkeypatch.setattr(lattice_lm, "BLOCK", 4096)


def test_very_long_word_takes_every_character():
    m, counts, spelled = lattice(), {}, np.zeros(256)
    m.expect("ab" * 50_000, 1.0, counts, spelled)
    assert sum(len(k) * v for k, v in counts.items()) == pytest.approx(100_001)
    assert not m._seen or max(map(len, m._seen)) <= lattice_lm.HOT_CHARS


@pytest.mark.parametrize("times", [10 ** 3, 10 ** 9])
def test_vocabulary_scores_keep_their_share_at_every_size(spark, times):
    first = lattice()
    counts = spark.createDataFrame([("aa", times)], "word string, c long")
    got = lattice_lm.adapt(first, counts, 0, rounds=1, share=0.2)
    unseen = [i for i, p in enumerate(first.pieces) if "b" in p]
    share = got.probs[unseen].sum() / first.probs[unseen].sum()
    assert share == pytest.approx(0.2 if times > 10 ** 4 else 1000 / (1000 + 2.5 * times), rel=0.3)
    assert got.probs[unseen] / got.probs[unseen[0]] == pytest.approx(first.probs[unseen] / first.probs[unseen[0]])


def test_a_missing_vocabulary_is_named(spark):
    with pytest.raises(FileNotFoundError, match="/nowhere/v.model"):
        lattice_lm.read_vocabulary("/nowhere/v.model")


def test_many_words_at_a_time_equal_one_by_one():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abéü日") for _ in range(rng.randint(1, 9))) for _ in range(500)})
    words += ["ab" * 63, "ab" * 64, "aé" * 300, "x\0", "\0"]
    one, many = lattice(), lattice()
    got = many.log10_of(words)
    assert got == pytest.approx({w: one.log10(w) for w in words})
    assert many.log10_of(words) == got
    counts, spelled, total, by_bytes = {}, np.zeros(256), np.zeros(len(one.pieces)), np.zeros(256)
    times = {w: float(k % 7 + 1) for k, w in enumerate(words)}
    for w, n in times.items():
        one.expect(w, n, counts, spelled)
    many.expect_all(times, total, by_bytes)
    assert {p: n for p, n in zip(one.pieces, total) if n} == pytest.approx({p: n for p, n in counts.items() if n})
    assert by_bytes == pytest.approx(spelled)


def test_scores_of_the_vocabulary_many_words_at_a_time():
    m, rng = lattice_lm.read_vocabulary(), random.Random(9)
    words = ["".join(rng.choice("etaoinshrdlu,.é9") for _ in range(rng.randint(1, 14))) for _ in range(2000)]
    got = m.log10_of(words)
    other = lattice_lm.read_vocabulary()
    assert got == pytest.approx({w: other.log10(w) for w in words})


def test_frequent_words_stay_within_their_bound(spark):
    counts = spark.createDataFrame([(f"w{i}", 1 + 1000 // (i + 1)) for i in range(500)] + [("z" * 100, 9999)], "word string, c long")
    got = lattice_lm.frequent(counts, 100)
    assert 50 <= len(got) <= 100 and got["w0"] == 1001 and "z" * 100 not in got
    assert lattice_lm.frequent(counts.where("c < 0"), 100) == {} and len(lattice_lm.frequent(counts, 10 ** 4)) == 500
