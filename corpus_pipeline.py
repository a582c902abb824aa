"""From raw documents to token ids: five operators in a row, each over all that the one before kept.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; all but the last return the columns
of ``documents``, and extra ones if there are any.

In every stage a null text counts as empty, a null identifier comes after all others, and an empty
table gives no rows. Texts are taken whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatprep.llm import bpe, content_sort, mixing, quality, simhash
from chatprep.llm.common import stored
from chatprep.llm.queries import TOKENIZER


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to ``labels``, does not reject.

    The score depends on the text alone, so rows that share it stay or go together.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for ASCII white space.

    The longest original stays, of equally long ones the smallest identifier; of rows that are equal
    in all of that, one.
    """
    return content_sort.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest identifier, of each component of near copies.

    Fingerprints of 3-word shingles are linked at 3 or fewer differing bits, as operator 10 has it.
    Texts without words have one fingerprint, and so one of them stays.
    """
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, or parts of them, as often as the mix takes them.

    Rows are told apart even if they share an identifier; a null source is a source of its own, and a
    text without words is not taken. A document that is taken in part is a row with that part.
    """
    return mixing.mixed_texts(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with hashes of the ids and of the text decoded from them; one row per
    row of the mix."""
    return bpe.token_digests(docs, TOKENIZER, with_ids=True)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("source mixing", mix_sources),
    ("bpe encoding and decoding", encode),
]

#: The first stage is a fitted network: SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
