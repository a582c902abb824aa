"""Which documents each filter of a chain removes, in every order of the filters.

The counts that the filters need come from one pass of a byte transducer over the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatprep.llm.common import stored, text_of

#: Bytes of the documents that are counted together, and that are hashed at a time.
TOGETHER = 1 << 20
#: Keys that rows without an identifier are spread over in a join.
SPREAD = 1024

# The signs that a symbol filter looks for.
SYMBOLS = b"#$%&*|"

#: Classes of bytes. A code point is counted at its first byte, so continuations are a class.
SPACE, CAPITAL, SYMBOL, CONTINUATION, OTHER = range(5)
#: What the transducer says at a byte.
WORD_STARTS, WORD_ENDS, IS_CAPITAL, IS_SYMBOL, CONTINUES = 1, 2, 4, 8, 16
#: Its states: between two words, inside a word.
OUTSIDE, INSIDE = 0, 1


def _classes() -> np.ndarray:
    table = np.full(256, OTHER, dtype=np.uint8)
    table[[0x20, *range(0x09, 0x0E)]] = SPACE
    table[0x41:0x5B] = CAPITAL
    table[list(SYMBOLS)] = SYMBOL
    table[0x80:0xC0] = CONTINUATION
    return table


def _emissions() -> np.ndarray:
    """What is said in each state at a byte of each class."""
    table = np.zeros((2, 5), dtype=np.uint8)
    table[:, CAPITAL] = IS_CAPITAL
    table[:, SYMBOL] = IS_SYMBOL
    table[:, CONTINUATION] = CONTINUES
    table[OUTSIDE, CAPITAL:] |= WORD_STARTS
    table[INSIDE, SPACE] = WORD_ENDS
    return table


CLASS = _classes()
#: The next state depends on the class alone, so all states follow from one look-up per byte.
NEXT = np.array([OUTSIDE, INSIDE, INSIDE, INSIDE, INSIDE], dtype=np.uint8)
EMIT = _emissions()

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def transduce(content: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """What the transducer says at each byte; it begins outside of a word at each of ``starts``."""
    kind = CLASS[content]
    state = np.empty(len(content), dtype=np.uint8)
    state[:1] = OUTSIDE
    state[1:] = NEXT[kind[:-1]]
    state[starts] = OUTSIDE
    return EMIT[state, kind]


def _powers(base: int, number: int) -> np.ndarray:
    """Powers from 0 on, modulo 2**64."""
    powers = np.full(number, base, dtype=np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def _word_hashes(content: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of each span, from running sums over blocks of about ``TOGETHER`` bytes."""
    out = np.empty(len(starts), dtype=np.uint64)
    done = 0
    while done < len(starts):
        low = int(starts[done])
        upto = max(int(np.searchsorted(ends, low + TOGETHER, side="right")), done + 1)
        high = int(ends[upto - 1])
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        block = content[low:high].astype(np.uint64) + np.uint64(1)
        np.cumsum(block * _powers(_BASE, high - low), out=sums[1:])
        first, last = starts[done:upto] - low, ends[done:upto] - low
        # Each span is brought back to the power 0 of its first byte.
        out[done:upto] = (sums[last] - sums[first]) * _powers(_INVERSE, high - low)[first]
        done = upto
    return out


def _equal_spans(
    content: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray
) -> np.ndarray:
    """Whether the bytes of two spans, of one length above 0, are the same."""
    if not len(a):
        return np.empty(0, dtype=bool)
    firsts = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    differ = content[np.repeat(a, lengths) + inside] != content[np.repeat(b, lengths) + inside]
    return ~np.logical_or.reduceat(differ, firsts)


def distinct_spans(
    content: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray
) -> np.ndarray:
    """Which spans are the first of their bytes that their document enters into the table.

    A hash table with open addressing holds spans. All spans step on together: those at a free slot
    claim it, and one of them gets it; the others are compared with the slot's span, document and
    bytes, and are done if these are equal. What is left goes on to the next slot. So equal hashes
    of different words cost a step and nothing else.
    """
    number = len(starts)
    lengths = ends - starts
    key = _word_hashes(content, starts, ends) ^ (owner.astype(np.uint64) * np.uint64(_BASE))
    key ^= key >> np.uint64(31)
    key *= _MIX
    key ^= key >> np.uint64(29)
    size = 1 << max(1, (2 * number - 1).bit_length() if number else 1)
    slot = (key & np.uint64(size - 1)).astype(np.int64)
    table = np.full(size, -1, dtype=np.int64)
    new = np.zeros(number, dtype=bool)
    pending = np.arange(number)
    while len(pending):
        at = slot[pending]
        free = table[at] < 0
        table[at[free]] = pending[free]
        holder = table[at]
        won = holder == pending
        new[pending[won]] = True
        pending, at, holder = pending[~won], at[~won], holder[~won]
        like = (
            (key[holder] == key[pending])
            & (owner[holder] == owner[pending])
            & (lengths[holder] == lengths[pending])
        )
        same = np.zeros(len(pending), dtype=bool)
        same[like] = _equal_spans(
            content, starts[holder[like]], starts[pending[like]], lengths[pending[like]]
        )
        pending, at = pending[~same], at[~same]
        slot[pending] = (at + 1) & (size - 1)
    return new


def count_texts(texts: Sequence[bytes]) -> list[np.ndarray]:
    """Per text: words, distinct words, capitals A-Z, code points, symbols."""
    content = np.frombuffer(b"".join(texts), dtype=np.uint8)
    edges = np.cumsum([0, *map(len, texts)])
    said = transduce(content, edges[:-1][np.diff(edges) > 0])

    def per_text(flag: int) -> tuple[np.ndarray, np.ndarray]:
        places = np.flatnonzero(said & flag)
        return places, np.diff(np.searchsorted(places, edges))

    starts, words = per_text(WORD_STARTS)
    owner = np.repeat(np.arange(len(texts)), words)
    # A word ends at the space behind it or with its text, whichever comes first.
    spaces = np.append(np.flatnonzero(said & WORD_ENDS), len(content))
    ends = np.minimum(spaces[np.searchsorted(spaces, starts)], edges[1:][owner])
    new = distinct_spans(content, starts, ends, owner)
    distinct = np.bincount(owner[new], minlength=len(texts))
    points = np.diff(edges) - per_text(CONTINUES)[1]
    return [words, distinct, per_text(IS_CAPITAL)[1], points, per_text(IS_SYMBOL)[1]]


COUNTS = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        keep = [name for name in batch.schema.names if name != "text"]
        group: list[bytes] = []
        size, first = 0, 0
        for row in range(batch.num_rows):
            group.append(texts[row].as_py().encode("utf-8", "replace"))
            size += len(group[-1])
            if size >= TOGETHER or row + 1 == batch.num_rows:
                columns = [batch.column(name).slice(first, len(group)) for name in keep]
                columns += [pa.array(c.astype(np.int64)) for c in count_texts(group)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *COUNTS])
                group, size, first = [], 0, row + 1


def text_counts(docs: DataFrame, keep: Mapping[str, Column], text_column: str = "text") -> DataFrame:
    """``(*keep, n_words, n_distinct, n_capitals, n_points, n_symbols)``, one row per input row.

    Words are separated by the six ASCII spaces and told apart by case; capitals are ``A`` to ``Z``;
    points are code points. A null text counts as empty. Nothing is shuffled; a long text is held in
    the memory of one task, with about 30 bytes for each of its words.
    """
    rows = docs.select(
        *[c.alias(name) for name, c in keep.items()], text_of(F.col(text_column)).alias("text")
    )
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(_counted, f"{kept}, " + ", ".join(f"{c} long" for c in COUNTS))


def _first_failing(order: Column, step: Column, filters: str) -> tuple[Column, Column]:
    """The bit of the filter at ``step`` of ``order``, and the bits of those before it."""
    bits = F.create_map(*[F.lit(x) for i, f in enumerate(filters) for x in (f, 1 << i)])
    own = bits[F.substr(order, step, F.lit(1))]
    before = F.aggregate(
        F.sequence(F.lit(1), F.lit(len(filters))),
        F.lit(0),
        lambda all_bits, i: F.when(i < step, all_bits + bits[F.substr(order, i, F.lit(1))]).otherwise(all_bits),
    )
    return own, before


def audit_orders(cells: DataFrame, filters: str, part: str = "part") -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley)`` of each part, order of the filters (letters) and step, zeros included.

    ``cells`` has rows ``(part, mask, n, good, toxic)``: how many documents fail exactly the filters
    of the mask (bit ``i`` for letter ``i``), and how many of them are good or toxic. There are at
    most ``2 ** len(filters)`` sums per part, held in one row; nothing is computed per document.
    """
    sums = cells.groupBy(part, "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    parts = sums.groupBy(part).agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    steps = F.sequence(F.lit(1), F.lit(len(filters)))
    placed = parts.select("*", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(steps).alias("step")
    )
    own, before = _first_failing(F.col("filter_order"), F.col("step"), filters)
    placed = placed.withColumn("own", own).withColumn("before", before)

    def total(value: str, where) -> Column:
        def add(so_far: Column, cell: Column) -> Column:
            return so_far + F.when(where(cell["mask"]), cell[value]).otherwise(F.lit(0).cast("long"))

        return F.aggregate("cells", F.lit(0).cast("long"), add)

    def fails(mask: Column, bits: str) -> Column:
        return mask.bitwiseAND(F.col(bits)) != 0

    def here(mask: Column) -> Column:
        return fails(mask, "own") & ~fails(mask, "before")

    # In a share of 1 / k of all orders, a filter is the first of the k that a document fails.
    every = math.factorial(len(filters))
    shapley = F.aggregate(
        "cells",
        F.lit(0).cast("long"),
        lambda so_far, cell: so_far
        + F.when(fails(cell["mask"], "own"), cell["n"] * F.lit(every) / F.bit_count(cell["mask"]))
        .otherwise(F.lit(0))
        .cast("long"),
    )
    return placed.select(
        part,
        "filter_order",
        F.col("step").cast("int").alias("step"),
        total("n", lambda m: ~fails(m, "own") & ~fails(m, "before")).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: fails(m, "own") & fails(m, "before")).alias("redundant"),
        total("n", lambda m: m == F.col("own")).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        shapley.alias("shapley"),
    )


#: Failure conditions on the counts of a text, as SQL expressions.
FILTERS = {
    "A": "n_words < 100",
    "B": "100 * n_distinct < 80 * n_words",
    "C": "100 * n_capitals > 10 * n_points",
    "D": "n_symbols > 0",
}
#: The letter of the filter that drops repeated texts.
REPEATED = "E"


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, str] = FILTERS,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "lang",
) -> DataFrame:
    """How the filters of a chain interact, for each value of ``part_column`` (null: empty string):
    the rows of ``audit_orders`` over ``filters`` and, as last letter, ``E``, which a document fails
    if its text is that of any smaller identifier in the whole table.

    ``labels`` has ``quality`` and ``toxic`` of some documents; of several rows of one document,
    any that says 1 counts. Null texts count as empty, and are equal to each other. A null
    identifier is larger than all others and has no label; rows that share identifier and text
    are counted one by one and do not repeat each other. An empty table gives no rows.

    A document's counts and a 256-bit hash of its text are stored. Rows of one text are summed per
    mask, part and label before they meet by hash, with the number of those that have the smallest
    identifier, so a text of a third of all rows is a few rows there. Rows without an identifier
    are spread in the join with the labels.
    """
    failed = [F.when(F.expr(f), 1 << i).otherwise(0) for i, f in enumerate(filters.values())]
    mask = reduce(Column.__add__, failed, F.lit(0))
    repeated = 1 << len(filters)
    counted = text_counts(
        docs,
        {
            "id": F.col(id_column),
            "part": text_of(F.col(part_column).cast("string")),
            "digest": F.unhex(F.sha2(text_of(F.col(text_column)), 256)),
        },
        text_column,
    )
    rows = stored(counted.select("id", "part", "digest", mask.alias("mask")), "filter-counts")
    single = rows.groupBy("digest", "mask", "part", "id").agg(F.count(F.lit(1)).alias("n"))

    marked = labels.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("is_good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("is_toxic"),
    )
    spread = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(SPREAD))).otherwise(0)
    known = (
        single.withColumn("salt", spread.cast("long"))
        .join(
            marked.withColumn("label_salt", F.lit(0).cast("long")),
            (F.col("id") == F.col("label_id")) & (F.col("salt") == F.col("label_salt")),
            "left",
        )
        .withColumn("is_good", F.coalesce("is_good", F.lit(0)))
        .withColumn("is_toxic", F.coalesce("is_toxic", F.lit(0)))
    )
    # The smallest identifier of a cell, nulls last, and how many rows have it.
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"))
    cells = known.groupBy("digest", "mask", "part", "is_good", "is_toxic").agg(
        F.sum("n").alias("n"), F.min(F.struct(place.alias("place"), F.col("n").alias("n"))).alias("first")
    )
    smallest = F.min("first.place").over(Window.partitionBy("digest"))
    n_first = F.when(F.col("first.place") == F.col("smallest"), F.col("first.n")).otherwise(0)
    # Without an identifier a row is not smaller than another one.
    n_first = F.when(F.col("smallest.none"), F.col("n")).otherwise(n_first)
    split = cells.withColumn("smallest", smallest).select(
        "part",
        "is_good",
        "is_toxic",
        F.inline(
            F.array(
                F.struct(F.col("mask").alias("mask"), n_first.alias("n")),
                F.struct((F.col("mask") + repeated).alias("mask"), (F.col("n") - n_first).alias("n")),
            )
        ),
    )
    counts = split.select(
        "part",
        "mask",
        "n",
        (F.col("n") * F.col("is_good")).alias("good"),
        (F.col("n") * F.col("is_toxic")).alias("toxic"),
    )
    return audit_orders(counts, "".join(filters) + REPEATED)
