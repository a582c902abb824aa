import random

import pytest

#: Rows that every operator over documents must take: nulls, empty and very long texts, ties, copies.
EDGE_TEXTS = [
    None, "", " \t\n", "A b c\x0bd", "ab  c d", "a b c", "A B C", "x" * 60000, "\U0001f600 é ß",
    "<|endoftext|>", "one two three four " * 3000, "12 + 34 = 46", "\x00\x1c\x85",
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Two of each text, a null identifier, a repeated row, and columns with clashing names."""
    rows = [(i, t, "en", "web", 1) for i, t in enumerate(EDGE_TEXTS * 2)]
    rows += [rows[5], (None, "a b c", None, None, 2), (None, None, None, None, None)]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, names).repartition(3)
    from pyspark.sql import functions as F

    clashing = ("id", "part", "norm", "fp", "hash", "size", "bucket", "spans", "kept", "cell", "row",
                "key", "digest", "shard", "start", "score", "ids", "mix_id", "piece", "label", "fold")
    return df.withColumns({c: F.lit("other") for c in clashing})


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")


@pytest.fixture(scope="session")
def copied_docs():
    """Texts that share passages: (doc_id, text) of short words, some with copies and small edits."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 5))) for _ in range(60)]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(40)) for _ in range(4)]
    docs = []
    for i in range(150):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))
        if rng.random() < 0.5:
            words = rng.choice(passages).split()
            at = rng.randrange(20)
            text += "\n" + " ".join(words[at : at + rng.randrange(5, 40)]) + " " + rng.choice(vocabulary)
        if docs and rng.random() < 0.3:
            text = rng.choice(docs)[1]
            if rng.random() < 0.5:
                text = text.replace(" ", "  ", 3) + rng.choice(["", "\n", " z"])
        docs.append((i * 7 % 150, text))
    return docs
