"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
#: N-grams of 1 to 3 characters in a profile; a character takes 21 of the 63 bits of a code.
PROFILE = 300
LONGEST = 3
CHARACTER_BITS = 21
#: Documents per language from which a profile is learned, on average.
LEARN_FROM = 2000
#: Languages whose profiles fit a task's memory for certain.
MOST_LANGUAGES = 1000

#: Characters of a text whose n-grams are counted at a time.
PIECE = 1 << 20

_NO_LETTERS = regex.compile(r"[^\p{L}]+")
#: Signs at which a long text can be cut: they end words, whatever stands around them.
_CUT = regex.compile(r"[\s\u3001\u3002\uff0c]")


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PIECE and (cut := _CUT.search(text, at + PIECE)):
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams inside the text's words, each padded with a blank, and their counts.

    A long text is counted in pieces cut between words; what is kept is one number per different
    n-gram.
    """
    codes, counts = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    for piece in _pieces(text):
        more, numbers = _piece_counts(piece)
        if not len(codes):
            codes, counts = more, numbers
        elif len(more):
            codes, place = np.unique(np.concatenate([codes, more]), return_inverse=True)
            sums = np.zeros(len(codes), dtype=np.int64)
            np.add.at(sums, place, np.concatenate([counts, numbers]))
            counts = sums
    return codes, counts


def _piece_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    words = _NO_LETTERS.sub(" ", text.lower()).strip()
    if not words:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    points = np.frombuffer(f" {words} ".encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint64)
    blank = points == 0x20
    codes = [points[~blank]]
    code = points
    for n in range(2, LONGEST + 1):
        code = (code[:-1] << np.uint64(CHARACTER_BITS)) | points[n - 1 :]
        inside = np.ones(len(code), dtype=bool)
        for i in range(1, n - 1):
            inside &= ~blank[i : i + len(code)]
        codes.append(code[inside])
    return np.unique(np.concatenate(codes), return_counts=True)


def top_grams(text: str, size: int = PROFILE) -> np.ndarray:
    """The text's most frequent n-grams, by count and then code."""
    codes, counts = gram_counts(text)
    return codes[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """Ranks of the n-grams in each language's profile."""

    def __init__(self, ranked: dict[str, list[int]], size: int = PROFILE):
        self.languages = sorted(ranked)
        self.size = size
        self.codes = np.unique(
            np.array([c for codes in ranked.values() for c in codes], dtype=np.uint64)
        )
        # One more row for n-grams that no profile has.
        self.ranks = np.full((len(self.codes) + 1, len(self.languages)), -1, dtype=np.int64)
        for column, language in enumerate(self.languages):
            rows = np.searchsorted(self.codes, np.array(ranked[language], dtype=np.uint64))
            self.ranks[rows, column] = np.arange(len(rows))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of least out-of-place distance, and 1 less the distance's share of the worst."""
        grams = top_grams(text, self.size) if text else ()
        if not len(grams) or not self.languages:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, grams)
        at[at == len(self.codes)] = 0
        at = np.where(self.codes[at] == grams, at, len(self.codes))
        ranks = self.ranks[at]
        moved = np.abs(ranks - np.arange(len(grams))[:, None])
        distance = np.where(ranks < 0, self.size, moved).sum(axis=0)
        best = int(np.argmin(distance))
        return self.languages[best], 1.0 - float(distance[best]) / (self.size * len(grams))


def _sum_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts: dict[str, list] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            parts.setdefault(lang, []).append(gram_counts(text.as_py()))
        for lang, found in parts.items():
            codes, place = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
            counts = np.bincount(
                place, weights=np.concatenate([n for _, n in found]), minlength=len(codes)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(codes), pa.string()),
                    pa.array(codes.view(np.int64), pa.int64()),
                    pa.array(counts.astype(np.int64), pa.int64()),
                ],
                names=["lang", "code", "n"],
            )


def learn_profiles(
    labelled: DataFrame, key: Column, per_language: int = LEARN_FROM, size: int = PROFILE
) -> Profiles:
    """Profiles from rows ``(lang, text)``; rows with a null in either teach nothing.

    Of each language about ``per_language`` documents are used, chosen by the hash ``key`` of their
    identifier, so that learning has a bounded cost. Counts are summed in Spark; the driver gets
    ``size`` n-grams per language, of at most ``MOST_LANGUAGES`` languages (more raise an error).
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return Profiles({}, size)
    spark = labelled.sparkSession
    shares = spark.createDataFrame(
        [(r.lang, min(1.0, per_language / r.n)) for r in counts], "lang string, share double"
    )
    chosen = F.pmod(F.xxhash64(key), F.lit(1_000_003)) < F.col("share") * 1_000_003
    sample = rows.join(F.broadcast(shares), "lang").where(chosen).select("lang", "text")
    sums = (
        sample.mapInArrow(_sum_grams, "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    best = sums.withColumn("place", place).where(F.col("place") <= size)
    ranked: dict[str, list[int]] = {}
    for r in sorted(best.collect(), key=lambda r: r.place):
        ranked.setdefault(r.lang, []).append(r.code)
    return Profiles(ranked, size)


def identified(text: Column, profiles: Profiles) -> Column:
    """Struct ``(lang, score)`` of a text column: whole texts, ``und`` for null or without letter.

    The score is 1 for a text whose n-grams rank as in the profile, 0 if no n-gram is in it.
    """

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [profiles.predict(t) for t in texts]
            yield pd.DataFrame(found, columns=["lang", "score"])

    return predict(text)


def identify(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    folds: int = 3,
    held_out: int = 1,
) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row per input row.

    Profiles come from documents whose ``crc32(doc_id) % folds`` is not ``held_out``. A null text
    or one without letters is ``und`` with score 0, and so is everything if nothing is labelled. A
    null identifier is neither learned from nor held out. An empty table gives no rows.
    """
    fold = F.crc32(F.col(id_column).cast("string")) % folds
    labelled = docs.where(fold != held_out).select(
        F.col(lang_column).alias("lang"), F.col(text_column).alias("text"), F.col(id_column).alias("id")
    )
    profiles = learn_profiles(labelled, F.col("id"))
    return docs.select(
        F.col(id_column),
        F.coalesce(fold == held_out, F.lit(False)).alias("held_out"),
        identified(F.col(text_column), profiles).alias("found"),
    ).select(id_column, "held_out", F.col("found.lang").alias("lang_pred"), "found.score")
