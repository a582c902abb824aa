"""What several operators share: words, partitions, stored intermediate tables."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatprep.sources.scratch import scratch_path

#: Characters that separate words, for a regular expression; every other character belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def text_of(column: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(column, F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Later jobs read the files, so a lost executor costs no recomputation, and every job sees the
    same rows even where ``df`` depends on how it was partitioned.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Buckets of hashes for each shuffle partition.
BUCKETS_PER_PARTITION = 4
#: Bytes of text of the documents that are sorted together, and for which there is a bucket of hashes.
GROUP_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20


def dealt_sizes(docs: DataFrame, text_column: str, group: int) -> tuple[int, int]:
    """Into how many groups documents are dealt, and how many buckets their hashes go to.

    Groups have ``group`` documents on average, or ``GROUP_BYTES`` of text where documents are long;
    buckets grow with the text, so that neither gets larger with the table.
    """
    size = F.sum(F.octet_length(text_of(F.col(text_column))))
    n, size = docs.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    parts = max(1, math.ceil(n / group), math.ceil(size / GROUP_BYTES))
    buckets = BUCKETS_PER_PARTITION * shuffle_partitions(docs.sparkSession)
    return parts, max(buckets, math.ceil(size / BUCKET_BYTES))


def pack(values: np.ndarray) -> bytes:
    """Compressed byte planes: sorted hashes share their high bytes, ordinals are small."""
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T.tobytes()
    return pa.compress(planes, codec="zstd", asbytes=True)


def unpack(packed: bytes, dtype: type, number: int) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = pa.decompress(packed, decompressed_size=number * width, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(width, number).T.copy().view(dtype).ravel()
