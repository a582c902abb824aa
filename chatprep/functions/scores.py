"""Scores and flags of a response text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatprep.functions.binding import let
from chatprep.functions.text import contains_any, has_more_words, word_count, words

SENTENCE_WORD = r"(?U)[^.\s\x1c-\x1f]+"
SENTENCE_END = r"(?U)[.!?][\s\x1c-\x1f]*+\z"

# Phrases looked for in responses.
FORCED_ENDINGS = ("ready for more", "any other questions", "hope this helps", "feel free to ask")
CONVERSATIONAL = (
    "let me",
    "you can",
    "i'd recommend",
    "here's",
    "it's important",
    "you should",
    "consider",
    "think about",
    "remember",
)


def tokens_per_second(tokens: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, tokens / seconds).otherwise(F.lit(0.0))


def response_length(response: Column) -> Column:
    return F.length(response)


def response_words(response: Column) -> Column:
    return word_count(response)


def coherence_score(text: Column) -> Column:
    """Mean of sentence-length, repetition and punctuation scores, in [0, 1]."""
    dots = F.length(text) - F.length(F.replace(text, F.lit("."), F.lit("")))
    per_sentence = F.regexp_count(text, F.lit(SENTENCE_WORD)) / (dots + 1)
    length_score = let(per_sentence, lambda n: F.when(n.between(5, 25), 1.0).otherwise(0.7))

    def repetition(tokens: Column) -> Column:
        # The blank case is cut off below, but may be evaluated: never divide by zero.
        ratio = F.size(F.array_distinct(tokens)) / F.greatest(F.size(tokens), F.lit(1))
        return F.least(ratio * 2, F.lit(1.0))

    repetition_score = let(words(F.lower(text)), repetition)
    well_formed = text.rlike(r"^\p{IsUppercase}") & text.rlike(SENTENCE_END)
    grammar_score = F.when(well_formed, 1.0).otherwise(0.8)
    score = (length_score + repetition_score + grammar_score) / 3
    return F.when(has_more_words(text, 0), score).when(text.isNotNull(), 0.0)


def has_any(text: Column, phrases: Iterable[str] = CONVERSATIONAL) -> Column:
    return contains_any(text, phrases)


def has_none(text: Column, phrases: Iterable[str] = FORCED_ENDINGS) -> Column:
    return ~contains_any(text, phrases)


def has_exact(text: Column, phrase: str) -> Column:
    """Case-sensitive."""
    return F.contains(text, F.lit(phrase))
