"""Numeric answers inside free text."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What an answer looks like, and the conclusions tried in this order.
BOXED = r"\\boxed\{([^}]+)\}"
NUMBER = r"([0-9,]+(?:\.[0-9]+)?)"
CONCLUSIONS = (
    r"(?U)[Tt]herefore,?\s*(?:the\s+)?(?:answer\s+is\s*)?([0-9,]+(?:\.[0-9]+)?)",
    r"(?U)[Ss]o,?\s*(?:the\s+)?(?:answer\s+is\s*)?([0-9,]+(?:\.[0-9]+)?)",
    r"(?U)[Tt]he\s+answer\s+is\s+([0-9,]+(?:\.[0-9]+)?)",
)


def _number(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def _last_match(text: Column, pattern: str) -> Column:
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(-1))


def extract_boxed(text: Column) -> Column:
    r"""Content of the first ``\boxed{...}``, '' if there is none."""
    return F.regexp_extract(text, BOXED, 1)


def boxed_number(text: Column) -> Column:
    r"""First number inside the last ``\boxed{...}``."""
    inside = F.replace(_last_match(text, BOXED), F.lit(","), F.lit(""))
    return F.regexp_extract(inside, NUMBER, 1).try_cast("double")


def conclusion_number(text: Column) -> Column:
    """Number of the last match of the first conclusion phrase that gives one."""
    return F.coalesce(*[_number(_last_match(text, p)) for p in CONCLUSIONS])


def last_number(text: Column) -> Column:
    return _number(_last_match(text, NUMBER))


STRATEGIES = (boxed_number, conclusion_number, last_number)


def extract_first_of(
    text: Column, strategies: Iterable[Callable[[Column], Column]] = STRATEGIES
) -> Column:
    """Result of the first strategy that finds something."""
    return F.coalesce(*[strategy(text) for strategy in strategies])


def extract_answer(text: Column) -> Column:
    return extract_first_of(text, STRATEGIES)
