"""Training examples out of document text.

Everything happens inside a document's row: chunks and sections stay arrays until they are written
out as rows, so no step shuffles.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatprep.functions import text as tx
from chatprep.functions.chat import build_chat, append_turn
from chatprep.schema import CHAT

# The prompt and the question every mined example carries.
DOCUMENTATION_PROMPT = (
    "You are a helpful technical documentation assistant. Provide clear, detailed guidance based "
    "on the documentation."
)
DOCUMENTATION_QUESTION = "Can you explain this process from the documentation?"


@dataclass(frozen=True)
class MiningRules:
    """``clean_first`` cleans before splitting, which turns line breaks into spaces and so leaves
    one chunk per document; without it each chunk is cleaned by itself. ``per_document`` takes only
    so many useful chunks of a document; ``chunks_cut`` counts the others."""

    separator: str = "\n\n"
    indicators: tuple[str, ...] = tx.USEFUL_WORDS
    min_chars: int = 50
    per_document: int | None = None
    min_words: int = 10
    clean_first: bool = True


def filter_nonempty_text(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(F.col(text) != "")


def chunk_rows(df: DataFrame, chunks: Column, keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """One row ``(pos, chunk)`` per element."""
    return df.select(*keep, F.posexplode(chunks).alias("pos", "chunk"))


def section_rows(
    df: DataFrame,
    patterns: Mapping[str, str] = tx.SECTION_PATTERNS,
    text: str = "text",
    keep: Iterable[str] = ("doc_id",),
) -> DataFrame:
    """One row ``(section, pos, line)`` per line that is left in a section."""
    sections = df.select(*keep, F.inline(tx.extract_sections(F.col(text), patterns)))
    return sections.select(*keep, "section", F.inline("lines"))


def section_map(text: Column, patterns: Mapping[str, str] = tx.SECTION_PATTERNS) -> Column:
    """``map<section, array<line>>``, with empty sections."""
    entries = F.transform(
        tx.extract_sections(text, patterns),
        lambda s: F.struct(s["section"], s["lines"]["line"]),
    )
    return F.map_from_entries(entries)


def mined_chunks(text: Column, rules: MiningRules = MiningRules()) -> Column:
    """The chunks of a document that become examples."""
    if rules.clean_first:
        chunks = tx.chunk_text(tx.clean_text(text), rules.separator)
    else:
        chunks = F.transform(tx.chunk_text(text, rules.separator), tx.clean_text)
    useful = tx.useful_chunks(chunks, rules.indicators, rules.min_chars)
    return tx.limit_chunks(useful, rules.per_document, rules.min_words)


def chunks_cut(text: Column, rules: MiningRules) -> Column:
    """How many useful chunks of a document ``per_document`` leaves out."""
    if rules.per_document is None:
        return F.lit(0)
    unlimited = replace(rules, per_document=None, min_words=-1)
    return F.greatest(F.size(mined_chunks(text, unlimited)) - rules.per_document, F.lit(0))


def example_chat(chunk: Column) -> Column:
    opening = build_chat(F.lit(DOCUMENTATION_QUESTION), prompt=DOCUMENTATION_PROMPT)
    return append_turn(opening, "assistant", chunk)


def make_training_examples(
    df: DataFrame,
    rules: MiningRules = MiningRules(),
    text: str = "text",
    keep: Iterable[str] = ("doc_id",),
) -> DataFrame:
    """One row ``(pos, messages)`` per example, ``pos`` counting within the document."""
    chunks = df.select(*keep, F.posexplode(mined_chunks(F.col(text), rules)).alias("pos", "chunk"))
    return chunks.select(*keep, "pos", example_chat(F.col("chunk")).alias("messages"))


def examples_per_doc(
    df: DataFrame,
    rules: MiningRules = MiningRules(),
    text: str = "text",
    keep: Iterable[str] = ("doc_id",),
) -> DataFrame:
    """Number of examples of each document, also where it is 0."""
    return df.select(*keep, F.size(mined_chunks(F.col(text), rules)).alias("n_examples"))


def examples_total(
    df: DataFrame, rules: MiningRules = MiningRules(), text: str = "text"
) -> DataFrame:
    """``(n_documents, n_with_examples, n_examples)`` of a whole table."""
    counted = examples_per_doc(df, rules, text, keep=())
    return counted.agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.count_if(F.col("n_examples") > 0).alias("n_with_examples"),
        F.coalesce(F.sum("n_examples"), F.lit(0)).alias("n_examples"),
    )


SAMPLE_QUESTIONS = (
    ("How do I change the display language?", "Open the preferences, choose Language, then restart."),
    ("Where are the log files kept?", "Log files are kept in the folder named in the settings page."),
    ("How do I add a second user?", "An administrator can add users under Accounts, one at a time."),
    ("What does a red status light mean?", "The last self-test failed. Run the test again to see why."),
    ("How often should filters be replaced?", "Replace filters every six months, sooner in dusty rooms."),
)


def sample_dataset(spark: SparkSession) -> DataFrame:
    """Five question / answer pairs as chat records, to try things out."""
    pairs = spark.createDataFrame(list(SAMPLE_QUESTIONS), "question string, answer string")
    opening = build_chat(F.col("question"), prompt=DOCUMENTATION_PROMPT)
    messages = append_turn(opening, "assistant", F.col("answer"))
    return pairs.select(messages.cast(CHAT["messages"].dataType).alias("messages"))
