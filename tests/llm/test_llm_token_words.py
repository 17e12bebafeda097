"""Words are tokenised in few calls; the ids are those of whole texts."""

import random
from array import array

import public_tokenizers
from tokenizers import Tokenizer

from voxtally.llm import packing


def test_words_in_one_call_equal_the_library(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(2)
    letters = "abZé́\x01|'s<>.,!?0  \x1c\x85\n#$-_\"\\漢字ß​ﬁÅİñ"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(3000)]
    texts += ["a<|endoftext|>. b", "it's. don't' x'", "a.́b a.́", "w" * 60 + "...", "| |x| \x01", "word word. word, word###"]
    library, calls = Tokenizer.from_file(path), []
    packing._tokenizer(path)[2].clear()
    coded = packing._coded
    monkeypatch.setattr(packing, "_coded", lambda t, words, mark: calls.append(words) or coded(t, words, mark))
    found = list(packing.token_bytes(texts, path, special=True))
    assert found == [array("I", library.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
    assert sum(words.count(b"word") for words in calls) == 1
    assert all(b"word###" not in words for words in calls)
