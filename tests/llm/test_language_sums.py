"""Sums over all segmentations of words of any length."""

import math

import numpy as np
import public_tokenizers
import pytest

from rotorlake.llm import language

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    vocabulary = language.Vocabulary(MODEL)
    counts = np.random.default_rng(0).integers(0, 50, (3, vocabulary.size)).astype(float)
    return language.Model(vocabulary, ["a", "b", "c"], np.array([1.0, 1.0, 2.0]), counts)


def loop_sum(model, word, k):
    """Logs of the sums to each place, one piece at a time, in floating logs."""
    names = {}
    for width, at, piece in model.vocabulary.hits(np.frombuffer(word, np.uint8)):
        for a, p in zip(at.tolist(), piece.tolist(), strict=True):
            names[a, a + width] = math.log(model.chance[p][k])
    logs = [0.0]
    for j in range(1, len(word) + 1):
        terms = [logs[j - 1] + math.log(language.FLOOR)] + [logs[i] + p for i in range(max(0, j - model.vocabulary.longest), j) if (p := names.get((i, j))) is not None]
        top = max(terms)
        logs.append(top + math.log(sum(math.exp(t - top) for t in terms)))
    return logs[-1]


@pytest.mark.parametrize("word", [" theing", " " + "internationalisation" * 4, " " + "漢字仮名交じり文" * 12, " " + "aGVsbG8gd29ybGQ" * 40, " " + "ab" * 700, " " + "\x01\x02" * 200])
def test_parts_of_a_word_multiply_to_the_sum_of_the_whole(model, word):
    raw = word.encode()
    data = np.frombuffer(raw, np.uint8)
    row, flat, starts, ends = language.chunks(model.vocabulary, np.array([0, len(raw)]), data.copy())
    parts = [flat[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    assert b"".join(parts) == raw and (len(parts) == 1) == (len(raw) <= language.WORD or len(parts) == 1)
    got = model._learn(parts)[0].view(np.float32).reshape(-1, 3).astype(np.float64).sum(0)
    for k in range(3):
        assert got[k] == pytest.approx(loop_sum(model, raw, k), rel=1e-5)


def test_both_forms_of_the_sum_agree(model):
    words = np.stack([np.frombuffer((" " + "streaming" * 40)[:200].encode(), np.uint8), np.frombuffer((" " + "xq9Zz" * 80)[:200].encode(), np.uint8)])
    assert np.allclose(model.forward(words), np.stack([model.forward_long(w) for w in words]))


def test_pieces_over_a_cut_are_counted(model):
    counter = language.Counter(model.vocabulary)
    word = b" " + b"the" * 300
    counter.add(["x"], np.array([0, len(word)]), np.frombuffer(word, np.uint8).copy())
    known = np.zeros(model.vocabulary.size)
    for _, _, piece in model.vocabulary.hits(np.frombuffer(word, np.uint8)):
        known += np.bincount(piece, minlength=model.vocabulary.size)
    assert (counter.total["x"] == known).all() and known.sum() > 900
