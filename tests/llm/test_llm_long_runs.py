"""Toxicity in long runs of letters: pieces without blanks and letters written apart."""

import random

import numpy as np
import pytest

from voxtally.llm import toxicity

SYLLABLES = ["the", "ing", "on", "wh"]


def _prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def model():
    rng, texts, labels = random.Random(4), [], []
    for i in range(400):
        words = _prose(rng, 60).split()
        for _ in range(3 * (i % 4 == 0)):
            words[rng.randrange(60)] = rng.choice(["grubbel", "grubbler", "zonkvat", "zonkvats"])
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return toxicity.fit(texts, labels)


def _long(rng, glue, insult):
    """Three runs of more than 200 letters; the insult is written behind the 64th letter or not at all."""
    runs = []
    for _ in range(3):
        words = _prose(rng, 50).rstrip(".").split()
        words[rng.randint(25, 45)] = insult or "theon"
        runs.append(glue.join(words) + ".")
    return " ".join(runs)


@pytest.mark.parametrize("glue", ["", "_", "/", "—"])
def test_an_insult_behind_the_64th_letter_of_a_piece_counts(model, glue):
    rng = random.Random(1)
    bad = model.scores([_long(rng, glue, "grubbel") for _ in range(30)])
    good = model.scores([_long(rng, glue, "") for _ in range(30)])
    assert np.mean(bad >= toxicity.THRESHOLD) >= 0.9 and np.mean(good < toxicity.THRESHOLD) >= 0.9


def test_an_insult_behind_the_64th_letter_written_apart_counts(model):
    rng = random.Random(2)
    apart = lambda insult: " ".join(_long(rng, "", insult).replace(".", "").replace(" ", ""))
    bad, good = (model.scores([apart(w) for _ in range(30)]) for w in ("grubbel", ""))
    assert np.mean(bad >= toxicity.THRESHOLD) >= 0.9 and np.mean(good < toxicity.THRESHOLD) >= 0.9


def test_windows_cover_every_letter():
    for n in (*range(65, 90), 20_000):
        word = "".join(chr(200 + i % 1000) for i in range(n))
        for width, step in toxicity.WINDOWS:
            own = [(at, w) for at, w in toxicity.windows(word) if at % step == 0 and w == word[at : at + width]]
            assert {at + i for at, w in own for i in range(len(w))} == set(range(n))
    assert list(toxicity.windows("x" * 64)) == [(0, "x" * 64)]
