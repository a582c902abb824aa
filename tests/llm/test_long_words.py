"""Words without end: time and memory of their encoding grow with their length, not its square."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from chatprep.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


def encoder():
    with open(PATH, encoding="utf-8") as file:
        return bpe.TrieEncoder(file.read())


def test_a_long_word_of_short_tokens_needs_little_memory():
    word = "".join(random.Random(3).choices("acgtqxz", k=20_000))
    own = encoder()
    tracemalloc.start()
    ids = own.encode(word)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.frombuffer(ids, "<u4").tolist() == Tokenizer.from_file(PATH).encode(word, add_special_tokens=False).ids
    assert peak < 20e6


def test_words_that_share_a_long_start(monkeypatch):
    monkeypatch.setattr(bpe, "SHARED", 6)
    rng = random.Random(4)
    start = "".join(rng.choices("abenst", k=40))
    words = {start[: rng.randrange(1, 41)] + "".join(rng.choices("abenst中", k=rng.randrange(9))) for _ in range(400)}
    library = Tokenizer.from_file(PATH)
    got = dict(encoder().encode_words(words))
    assert got.keys() == words
    for word, ids in got.items():
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(word, add_special_tokens=False).ids


def test_long_words_are_not_remembered_for_ever(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_CHARACTERS", 1000)
    own, rng = encoder(), random.Random(5)
    for _ in range(20):
        own.encode("".join(rng.choices("acgt", k=400)))
    assert sum(map(len, [*own.known, *own.before])) <= 2000
