"""Text helpers that follow Unicode rules for whitespace and letters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatprep.functions.binding import let

# Every character that counts as whitespace: the Unicode property plus U+001C to U+001F.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
WORD = r"(?U)[^\s\x1c-\x1f]+"
# Up to N words from the start of a text; possessive, so that a text is read once and only so far.
LEADING_WORDS = r"(?U)^[\s\x1c-\x1f]*+(?:[^\s\x1c-\x1f]++[\s\x1c-\x1f]*+){%d}"

# What cleaning keeps, besides letters, numbers and the underscore.
KEPT_PUNCTUATION = "-.,!?:;()"
DROPPED = r"[^\p{L}\p{N}_ \-.,!?:;()]"

# Words that mark a passage as worth a training example.
USEFUL_WORDS = (
    "configure",
    "install",
    "setup",
    "procedure",
    "step",
    "process",
    "requirement",
    "specification",
    "troubleshoot",
    "error",
    "problem",
)

# Section headers of technical documents, tried in this order.
SECTION_PATTERNS = {
    "overview": r"(?i)(overview|introduction|summary)",
    "requirements": r"(?i)(requirements?|prerequisites?|specifications?)",
    "steps": r"(?i)(steps?|procedure|instructions?|process)",
    "troubleshooting": r"(?i)(troubleshooting|problems?|issues?|errors?)",
    "notes": r"(?i)(notes?|warnings?|cautions?|important)",
}


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def words(text: Column) -> Column:
    """Whitespace-separated words, without empty ones."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def has_more_words(text: Column, n: int) -> Column:
    """``word_count(text) > n``, reading no further than needed."""
    return text.rlike(LEADING_WORDS % (n + 1))


def contains_any(text: Column, phrases: Iterable[str]) -> Column:
    """True where the lower-cased text holds at least one phrase."""
    def any_of(lowered: Column) -> Column:
        found = [F.contains(lowered, F.lit(p)) for p in phrases]
        return reduce(lambda a, b: a | b, found, F.lit(False))

    return let(F.lower(text), any_of)


def clean_text(text: Column) -> Column:
    """One space per whitespace run, no characters that might interfere, no outer space."""
    spaced = F.regexp_replace(text, SPACE_RUN, " ")
    return strip(F.regexp_replace(spaced, DROPPED, ""))


def chunk_text(text: Column, separator: str = "\n\n") -> Column:
    """Paragraphs of a text. The separator is literal."""
    return F.split(text, r"\Q" + separator + r"\E")


def is_useful_chunk(
    chunk: Column, indicators: Iterable[str] = USEFUL_WORDS, min_chars: int = 50
) -> Column:
    """Longer than ``min_chars`` once stripped, and holding an indicator word."""
    return (F.length(strip(chunk)) > min_chars) & contains_any(chunk, indicators)


def useful_chunks(
    chunks: Column, indicators: Iterable[str] = USEFUL_WORDS, min_chars: int = 50
) -> Column:
    kept = F.filter(chunks, lambda c: is_useful_chunk(c, indicators, min_chars))
    return F.transform(kept, strip)


def limit_chunks(
    chunks: Column, per_document: int | None = 20, min_words: int = 10
) -> Column:
    """The first ``per_document`` chunks (None: all), then those of them with more than
    ``min_words`` words."""
    taken = chunks if per_document is None else F.slice(chunks, 1, per_document)
    return F.filter(taken, lambda c: has_more_words(c, min_words))


def chunk_topic(chunk: Column, n_words: int = 10) -> Column:
    start = F.regexp_extract(chunk, LEADING_WORDS.replace("%d", f"0,{n_words}"), 0)
    return F.array_join(words(start), " ")


def section_of(line: Column, patterns: Mapping[str, str]) -> Column:
    """The first section whose pattern is found in the line, else null."""
    hits = [F.when(line.rlike(pattern), F.lit(name)) for name, pattern in patterns.items()]
    return F.coalesce(*hits)


def extract_sections(
    text: Column, patterns: Mapping[str, str] = SECTION_PATTERNS, default: str = "general"
) -> Column:
    """``array<struct<section, lines array<struct<pos, line>>>>`` of one document.

    A header line opens its section and empties it if it was open before, so a section always ends
    as the lines between its last header and the next header of any kind. That makes each section
    one slice of the document's non-blank lines: no window and no shuffle is needed. Sections whose
    header never occurs are absent; a header without lines gives an empty section.
    """
    numbered = F.transform(
        F.split(text, "\n"), lambda line, i: F.struct(i.alias("pos"), strip(line).alias("line"))
    )
    lines = F.transform(
        F.filter(numbered, lambda x: x["line"] != ""),
        lambda x: F.struct(
            x["pos"].alias("pos"),
            x["line"].alias("line"),
            section_of(x["line"], patterns).alias("header"),
        ),
    )

    def body(rows: Column, start: Column, end: Column) -> Column:
        return F.transform(
            F.slice(rows, start + 1, end - start),
            lambda x: F.struct(x["pos"].alias("pos"), x["line"].alias("line")),
        )

    def entry(name: str, rows: Column, start: Column, end: Column) -> Column:
        return F.struct(F.lit(name).alias("section"), body(rows, start, end).alias("lines"))

    def sections(rows: Column, heads: Column) -> Column:
        def after(index: Column) -> Column:
            later = F.filter(heads, lambda h: h["at"] > index)
            return F.coalesce(F.get(later, F.lit(0))["at"], F.size(rows))

        def opened(name: str) -> Column:
            own = F.filter(heads, lambda h: h["header"] == name)
            last = F.try_element_at(own, F.lit(-1))["at"]
            return let(
                last,
                lambda at: F.when(at.isNotNull(), entry(name, rows, at + 1, after(at))),
            )

        general = entry(default, rows, F.lit(0), after(F.lit(-1)))
        return F.array_compact(F.array(general, *[opened(name) for name in patterns]))

    def heads_of(rows: Column) -> Column:
        return F.filter(
            F.transform(rows, lambda x, i: F.struct(i.alias("at"), x["header"].alias("header"))),
            lambda h: h["header"].isNotNull(),
        )

    return let(lines, lambda rows: let(heads_of(rows), lambda heads: sections(rows, heads)))
