"""Operator 12 looks each word of a block of texts up once."""

import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chatprep.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
END = 1


def encoder():
    with open(PATH, encoding="utf-8") as file:
        vocabulary = file.read()
    return token_files.IdEncoder(vocabulary, token_files.id_width(vocabulary, END))


class _Counting(token_files._Known):
    lookups = 0

    def __getitem__(self, key):
        self.lookups += 1
        return super().__getitem__(key)


def encoded(own, texts):
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64())] * 2 + [pa.array(texts, pa.string())],
        names=["id", "row", "text"],
    )
    (out,) = token_files._encoded(lambda: own, END, [])([batch])
    return [np.frombuffer(i, own.width).tolist() for i in out.column("ids").to_pylist()]


def test_a_word_of_many_texts_is_looked_up_once():
    own = encoder()
    own.words_known = _Counting(own._word)
    texts = ["Alpha beta, gamma"] * 500
    ids = encoded(own, texts)
    assert ids == [Tokenizer.from_file(PATH).encode(texts[0], add_special_tokens=False).ids + [END]] * 500
    # Three words, and the two pieces of one of them.
    assert own.words_known.lookups <= 5


@pytest.mark.parametrize("block", [1, 40, 1 << 20])
def test_texts_of_all_kinds_in_blocks(monkeypatch, block):
    monkeypatch.setattr(token_files, "BLOCK", block)
    rng, library = random.Random(6), Tokenizer.from_file(PATH)
    signs = ["it's", "IT'S", "''s", "a1b2", "don't.", "İx", "中文", "é", "Größe", "ß½", "\xa0", "\x1cq",
             "<|endoftext|>", "...", "'", "’re", "\xad", "x" * 90]
    texts = ["", " ", "\n\t a  b \r\n"]
    texts += [rng.choice(" \n").join(rng.choices([*signs, "the", "The,", "of"], k=rng.randrange(9))) for _ in range(300)]
    expected = [library.encode(t, add_special_tokens=False).ids + [END] for t in texts]
    assert encoded(encoder(), texts) == expected
    assert encoded(encoder(), []) == []
