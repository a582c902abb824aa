"""SimHash near-dedup: pigeonring candidates, Hamming check, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatprep.llm.common import stored, text_of
from chatprep.llm.components import stars

SHINGLE = 3
SEED = 42
#: Fingerprints with so many differing bits at most are linked.
DISTANCE = 3
#: Segments of the ring. A link has a segment from which on every run of ``l`` segments differs in
#: at most ``l * DISTANCE / SEGMENTS`` bits: 0, 1, 2 and 3 bits for runs of 1 to 4 segments.
SEGMENTS = 4
BITS = 64 // SEGMENTS
BUDGETS = tuple(n * DISTANCE // SEGMENTS for n in range(1, SEGMENTS + 1))

#: Fingerprints of a bucket up to which its pairs are joined; larger buckets are cut into tiles.
JOINED = 64
TILE = 1024

#: Shingles hashed at a time, so that a long text needs little memory.
CHUNK = 1 << 16

_LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
_BIT_TABLE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text: a bit is set if over half of the shingles' hashes set it."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    number = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, number, CHUNK):
        part = words[at : min(at + CHUNK, number) + shingle - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), dtype="<u8")
        columns = hashes.view(np.uint8).reshape(-1, 8)
        for i in range(8):
            counts[8 * i : 8 * i + 8] += np.bincount(columns[:, i], minlength=256) @ _BIT_TABLE
    set_bits = np.packbits(counts * 2 > number, bitorder="little")
    return int(set_bits.view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([fingerprint(t.as_py()) for t in batch.column("text")], dtype="<u8")
        names = [n for n in batch.schema.names if n != "text"]
        columns = [*map(batch.column, names), pa.array(values.view("<i8"))]
        yield pa.RecordBatch.from_arrays(columns, names=[*names, "fp"])


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, (i % SEGMENTS) * BITS).bitwiseAND(F.lit((1 << BITS) - 1))


def _keys(fp: Column, reach: bool) -> Column:
    """Per ring position: the position, its segment and the next one, as one number.

    With ``reach``, also the next segments with one more bit set. Of two segments that differ in one
    bit, the one without it reaches the other.
    """
    def of(i: int) -> Column:
        own = F.shiftleft(_segment(fp, i), BITS) + F.lit(i << (2 * BITS)).cast("long")
        after = _segment(fp, i + 1)
        bits = [after.bitwiseOR(F.lit(1 << b).cast("long")) for b in range(BITS)] if reach else []
        return F.transform(F.array_distinct(F.array(after, *bits)), lambda x: own + x)

    return F.explode(F.concat(*map(of, range(SEGMENTS))))


def _run_mask(i: int, length: int) -> int:
    mask = 0
    for s in range(i, i + length):
        mask |= ((1 << BITS) - 1) << ((s % SEGMENTS) * BITS)
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _within_budgets(key: Column, left: Column, right: Column) -> Column:
    """The prefix runs of 3 segments, then the full check (runs of 1 and 2 are in the key)."""
    differing = left.bitwiseXOR(right)
    masks = F.element_at(
        F.array(*[F.lit(_run_mask(i, 3)).cast("long") for i in range(SEGMENTS)]),
        (F.shiftright(key, 2 * BITS) + 1).cast("int"),
    )
    return (F.bit_count(differing.bitwiseAND(masks)) <= BUDGETS[2]) & (
        F.bit_count(differing) <= DISTANCE
    )


def _tile_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links that connect the tile's fingerprints as all its close pairs would: stars, not pairs."""
    fps = np.unique(rows["fp"].to_numpy())
    bits = fps.view(np.uint64)  # bits of negative numbers are not counted as they are
    close = np.empty((len(fps), len(fps)), dtype=bool)
    for at in range(0, len(fps), 256):
        close[at : at + 256] = np.bitwise_count(bits[at : at + 256, None] ^ bits[None, :]) <= DISTANCE
    label = np.arange(len(fps))
    while True:
        lowest = np.array([label[row].min() for row in close], dtype=label.dtype)
        lowest = lowest[lowest]
        if np.array_equal(lowest, label):
            break
        label = lowest
    hung = label != np.arange(len(fps))
    return pd.DataFrame({"a": fps[hung], "b": fps[label[hung]]})


def fingerprint_links(classes: DataFrame) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints ``fp`` (long) that keep what is connected.

    Buckets of at most ``JOINED`` fingerprints are joined, which gives at most ``JOINED`` candidates
    per key. Larger buckets are cut into blocks, every two blocks of a bucket form a tile, and a
    tile gives a star per component in it, at most one link per fingerprint. Memory is that of a tile; a
    bucket of ``n`` distinct fingerprints is copied ``n / TILE`` times into tiles, ``n * n / TILE`` rows.
    """
    fp = F.col("fp")
    index = classes.select("fp", _keys(fp, reach=False).alias("key"))
    probes = classes.select("fp", _keys(fp, reach=True).alias("key"))
    sizes = stored(
        index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > JOINED), "ring-large"
    )
    small = index.join(sizes, "key", "left_anti").select("key", F.col("fp").alias("b"))
    joined = probes.withColumnRenamed("fp", "a").join(small, "key")
    joined = joined.where((F.col("a") != F.col("b")) & _within_budgets(F.col("key"), F.col("a"), F.col("b")))

    large = probes.join(sizes.select("key"), "key", "left_semi")
    blocks = large.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("blocks"))
    dealt = large.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    zero = F.lit(0).cast("long")
    tiles = dealt.select(
        "fp", "key", "block", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("other")
    ).select(
        "fp", "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    tiled = tiles.groupBy("key", "low", "high").applyInPandas(_tile_links, "a long, b long")
    return joined.select("a", "b").unionByName(tiled)


def _marked(docs: DataFrame, id_column: str, text_column: str, *more: Column) -> DataFrame:
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(
        F.col(id_column).alias("id"), text_of(F.col(text_column)).alias("text"), *more
    )
    named = [f"{c} string" for c in rows.columns[2:]]
    return stored(rows.mapInArrow(_fingerprints, ", ".join([f"id {kind}", *named, "fp long"])), "simhash")


def _roots(classes: DataFrame) -> DataFrame:
    """``classes`` with ``root``, one fingerprint for all of a component."""
    hung = stars(fingerprint_links(classes.select("fp")))
    joined = classes.join(hung, F.col("fp") == F.col("a"), "left")
    return joined.withColumn("root", F.coalesce("b", "fp")).drop("a", "b")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row.

    Words are lower-cased in A-Z and split at ASCII white space; a fingerprint is the SimHash of
    all 3-word shingles, repeats included, of the whole text (fewer words: of the sequence; none, or
    a null text: zero, linked like any other). Documents with one fingerprint form a class, and only
    classes are compared. ``component_id`` is the smallest identifier that is reachable over links
    of up to three differing bits; null identifiers are never the smallest (a component of nothing
    else has a null one). Repeated rows give repeated rows; an empty table gives none.
    """
    marked = _marked(docs, id_column, text_column)
    classes = stored(marked.groupBy("fp").agg(F.min("id").alias("smallest")), "simhash-classes")
    rooted = _roots(classes)
    lowest = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest identifier.

    A null identifier comes last, and equal ones go by their text's hash; of equal rows one stays.
    """
    digest = F.sha2(text_of(F.col(text_column)), 256)
    marked = _marked(docs, id_column, text_column, digest.alias("digest"))
    first = F.struct(F.col("id").isNull().alias("none"), "id", "digest")
    classes = stored(marked.groupBy("fp").agg(F.min(first).alias("first")), "simhash-classes")
    winners = _roots(classes).groupBy("root").agg(F.min("first").alias("first"))
    winners = winners.select(F.col("first.id").alias("win_id"), F.col("first.digest").alias("win_digest"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(F.col(id_column).alias("id"), digest.alias("digest"), row)
    same = (F.col("digest") == F.col("win_digest")) & F.col("id").eqNullSafe(F.col("win_id"))
    one = F.row_number().over(Window.partitionBy("digest", "id").orderBy("id"))
    kept = rows.join(winners, same, "left_semi").withColumn("place", one).where("place = 1")
    return kept.select("row.*")
