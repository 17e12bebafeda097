"""Words are scored once for all spellings with the same letters."""

import numpy as np

from voxtally.llm import toxicity


def test_words_of_the_same_letters_are_compared_once(monkeypatch):
    toxic = ["you are a blargh. what a blargh!", "such a blargh, go away"] * 30
    clean = ["a fine day to walk. we like it", "the tree is green, go on"] * 30
    model = toxicity.fit(toxic + clean, [1] * 60 + [0] * 60)
    compared, likeness = [], model.likeness
    model.likeness = lambda words: compared.extend(words) or likeness(words)
    scores = model.scores(["blargh blargh. (blargh) blargh!", "tree", None])
    assert compared.count("blargh") == 1
    model.scores(["blargh? tree."])
    assert compared.count("blargh") == 1 and compared.count("tree") == 1
    assert np.allclose(scores, [model.scores([t])[0] for t in ["blargh blargh. (blargh) blargh!", "tree", None]])
    assert scores[0] > scores[1]
