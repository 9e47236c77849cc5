"""Ids of single words, against the tokenizer."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from codeloom.llm.bpe import WordIds

EMPTY = ([], np.zeros(0, np.int32), np.zeros(0, np.int64))


class NoPattern:
    def findall(self, text):
        raise AssertionError(f"{text!r} was cut again")


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_of_letters_are_not_cut_again(name):
    path = public_tokenizers.path(name)
    words = ["the", "Zqxjv", "UPPER", "a", "internationalisation"]
    known = WordIds(path, *EMPTY)
    known.cut = (known.cut[0], NoPattern())
    flat, places = known.ids([words, [], words[:2]])
    whole = Tokenizer.from_file(path)
    expected = [[i for w in part for i in whole.encode(w, add_special_tokens=False).ids] for part in (words, [], words[:2])]
    assert [flat[a:b].tolist() for a, b in zip(places[:-1], places[1:])] == expected


def test_words_are_forgotten_beyond_the_limit_with_the_same_ids():
    path = public_tokenizers.path("word_bpe_49k.json")
    words = [f"w{i}x" for i in range(50)] + ["It's", "é", "naïve", "Σ", "a1b2", "<|endoftext|>"]
    known, whole = WordIds(path, *EMPTY, limit=7), Tokenizer.from_file(path)
    for _ in range(2):
        for at in range(0, len(words), 5):
            flat, _ = known.ids([words[at:at + 5]])
            assert flat.tolist() == [i for w in words[at:at + 5] for i in whole.encode(w, add_special_tokens=False).ids]
