import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatprep.functions import text as tx
from chatprep.operators import examples as ex

SPACES = [c for c in map(chr, range(0x3001)) if c.isspace()]
ALPHABET = SPACES + list("abzAZ09_-.,!?:;()'\"#$%éüñßİ²Ⅷ中ا€́‿\U0001f600") + ["\n"] * 8
texts = st.lists(st.text(ALPHABET, max_size=40), min_size=20, max_size=40)
few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def clean(text):
    """Character by character."""
    kept = [c for c in " ".join(text.split()) if c.isalnum() or c in "_ " + tx.KEPT_PUNCTUATION]
    return "".join(kept).strip()


def test_whitespace_is_what_python_strips():
    assert sorted(tx.WHITESPACE) == sorted(SPACES)


@few
@given(texts)
def test_strip_words_and_cleaning(over, values):
    def all_of(x):
        return F.struct(
            tx.strip(x).alias("strip"),
            tx.words(x).alias("words"),
            tx.word_count(x).alias("n"),
            tx.clean_text(x).alias("clean"),
            tx.has_more_words(x, 2).alias("more"),
            tx.chunk_topic(x, 3).alias("topic"),
        )

    for value, got in zip(values, over(values, "string", all_of)):
        assert got.strip == value.strip()
        assert got.words == value.split()
        assert got.n == len(value.split())
        assert got.clean == clean(value)
        assert got.more == (len(value.split()) > 2)
        assert got.topic == " ".join(value.split()[:3])


def test_cleaning_examples(over):
    assert over(["\xa0a\n "], "string", tx.strip) == ["a"]
    assert over(["für €ñ_1!", "", None], "string", tx.clean_text) == ["für ñ_1!", "", None]


def sections(text, patterns):
    """Cut the text at its headers; of pieces with the same name the last one stays."""
    pieces = [("general", [])]
    for line in filter(None, map(str.strip, text.split("\n"))):
        names = [name for name, pattern in patterns.items() if re.search(pattern, line)]
        if names:
            pieces.append((names[0], []))
        else:
            pieces[-1][1].append(line)
    return dict(pieces)


def test_sections_example(over):
    text = "x\nOverview\na\nSteps\nb\nOverview\nc"
    assert over([text], "string", ex.section_map) == [
        {"general": ["x"], "steps": ["b"], "overview": ["c"]}
    ]


lines = st.sampled_from(["", " ", "plain", " more text ", "Overview", "the STEPS", "notes: error",
                         "last step", "Important", "requirement"])


@few
@given(st.lists(st.lists(lines, max_size=12).map("\n".join), min_size=20, max_size=40))
def test_sections_against_line_by_line(over, values):
    got = over(values, "string", ex.section_map)
    assert got == [sections(v, tx.SECTION_PATTERNS) for v in values]


def test_section_rows_keep_line_numbers(spark):
    df = spark.createDataFrame([(1, "a\n\nSteps\n b \nc")], "doc_id int, text string")
    got = {tuple(r) for r in ex.section_rows(df).collect()}
    assert got == {(1, "general", 0, "a"), (1, "steps", 3, "b"), (1, "steps", 4, "c")}


def mine(text, per_document=20):
    """The examples of a text that is cleaned before it is split: one at most."""
    whole = clean(text)
    hits = [word for word in tx.USEFUL_WORDS if word in whole.lower()]
    return [whole] if hits and len(whole) > 50 and whole.count(" ") >= 10 else []


def test_training_examples(spark):
    paragraph = "First Install the pump, then tighten every bolt by hand until nothing moves any more."
    rows = [
        (1, paragraph + "\n\n" + paragraph),
        (2, "too short to install"),
        (3, "nothing of interest " * 10),
        (4, "install " + "x" * 60),
        (5, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    whole = ex.make_training_examples(docs).collect()
    assert [(r.doc_id, r.messages[2].content) for r in whole] == [
        (d, c) for d, t in rows for c in mine(t)
    ]
    assert [m.role for m in whole[0].messages] == ["system", "user", "assistant"]
    apart = ex.make_training_examples(docs, ex.MiningRules(clean_first=False)).collect()
    assert [(r.doc_id, r.pos) for r in apart] == [(1, 0), (1, 1)]
    counts = {r.doc_id: r.n_examples for r in ex.examples_per_doc(docs).collect()}
    assert counts == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0}


def test_limit_comes_before_the_word_filter(over):
    long = " ".join(["word"] * 11)
    chunks = ["short one"] * 20 + [long]
    assert over([chunks], "array<string>", tx.limit_chunks) == [[]]
    assert over([chunks[1:]], "array<string>", tx.limit_chunks) == [[long]]


def test_sample_dataset(spark):
    df = ex.sample_dataset(spark)
    assert df.count() == 5
    assert df.first().messages[0].content == ex.DOCUMENTATION_PROMPT
