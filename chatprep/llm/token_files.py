"""Token ids as files: concatenated id arrays with Elias-Fano encoded document boundaries."""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chatprep.llm.bpe import byte_symbols
from chatprep.llm.common import shuffle_partitions, text_of
from chatprep.sources.scratch import scratch_path

#: Bytes of ids in a segment, unless one document has more, and documents in it.
SEGMENT = 4 << 20
DOCUMENTS = 1 << 16
#: Pieces of text of a generation, whose ids a task remembers, and the characters of such a piece.
REMEMBERED = 400_000
PIECE = 64
#: Characters of the texts whose words are looked up together; a longer text is done on its own.
BLOCK = 4 << 20
#: Ones of the upper bits between two stored positions.
SAMPLE = 256

# ---- encoding with the tokenizer library -------------------------------------------------------


def _class(category: str) -> str:
    """The characters of a general category that normalisation leaves alone, as regex ranges.

    These are printed ASCII, Latin letters and signs below U+0180 and general punctuation. Canonical
    composition changes none of them, their small letters are among them (but for U+0130, which is
    left out), and no version of Unicode has moved one to another category.
    """
    allowed = [*range(0x21, 0x7F), *range(0xA1, 0x130), *range(0x131, 0x180),
               *range(0x2010, 0x2028), *range(0x2030, 0x205F)]
    return "".join(
        re.escape(chr(c)) for c in allowed if unicodedata.category(chr(c)).startswith(category)
    )


# The steps of the tokenizer file that the short way below reproduces.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class _Known(dict):
    """Ids of pieces, worked out when first asked for. Those not used for a generation are forgotten."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode, self.before = encode, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(piece) <= PIECE:
            if len(self) >= REMEMBERED:
                self.before = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class IdEncoder:
    """Encodes texts with the tokenizers library, each different piece of text once.

    A tokenizer file of lower-cased words, split at white space, has pieces that do not depend on
    each other. Words of ordinary characters are split by the file's own pattern, and the library's
    model encodes each different piece; other words are given to the library whole. A piece that is a
    word is its only piece, so words and pieces are remembered together.
    With any other kind of file, the library gets each text whole.
    """

    def __init__(self, vocabulary: str, width: str):
        """``vocabulary``: the content of the tokenizer's file; ``width``: the type of an id."""
        # Spark runs the tasks side by side.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        file = json.loads(vocabulary)
        self.width = width
        self.model = self.tokenizer.model
        self.symbol = {b: c for c, b in byte_symbols().items()}
        steps = [n.get("type") for n in (file.get("normalizer") or {}).get("normalizers", [])]
        cuts = (file.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_pieces = (
            steps == _NORMALIZERS
            and [c.get("type") for c in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"].get("Regex") == _SPLIT
            and not cuts[1]["add_prefix_space"]
            and file.get("post_processor") is None
        )
        letters, numbers = _class("L"), _class("N")
        others = "".join(map(_class, "MPSC"))
        space = r"\x20\x09-\x0D"
        self.ordinary = re.compile(f"[{letters}{numbers}{others}{space}]*")
        self.pieces = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+"
        )
        added = sorted((t["content"] for t in file.get("added_tokens", [])), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.number = [i.to_bytes(np.dtype(width).itemsize, "little") for i in range(self.size(file))]
        self.words_known, self.unusual_known = _Known(self._word), _Known(self._whole)

    @staticmethod
    def size(file: dict) -> int:
        """One more than the largest id of a tokenizer file."""
        added = (t["id"] for t in file.get("added_tokens", []))
        return max(*file["model"]["vocab"].values(), *added) + 1

    def _packed(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.number.__getitem__, ids))

    def _whole(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        """The ids of a word in lower case, or of a piece that the pattern gives."""
        # Letters alone are one piece.
        pieces = [word] if word.isalpha() else self.pieces.findall(word)
        if pieces != [word]:
            return b"".join(map(self.words_known.__getitem__, pieces))
        if not word.isascii():
            word = "".join(map(self.symbol.__getitem__, word.encode()))
        return self._packed([t.id for t in self.model.tokenize(word)])

    def _ordinary(self, text: str) -> bytes:
        # Of all white space, ordinary text has the six ASCII spaces only.
        return b"".join(map(self.words_known.__getitem__, text.lower().split()))

    def _ordinary_block(self, texts: list[str]) -> list[bytes]:
        """The same for many texts, with one look-up for each of their different words."""
        words = pc.ascii_split_whitespace(pa.array([t.lower() for t in texts], pa.string()))
        # A text with blanks at an end has an empty word there, which has no ids.
        places = words.values.dictionary_encode()
        different = places.dictionary.to_numpy(zero_copy_only=False)
        ids = pa.array(list(map(self.words_known.__getitem__, different)), pa.binary())
        per_text = pa.ListArray.from_arrays(words.offsets, ids.take(places.indices))
        return pc.binary_join(per_text, b"").to_pylist()

    def _has_added(self, text: str) -> bool:
        return bool(self.added and self.added.search(text))

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each of the texts, as ``encode`` gives them."""
        held: list[str] = []
        size = 0
        for text in texts:
            if held and size + len(text) > BLOCK:
                yield from self._block(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        yield from self._block(held)

    def _block(self, texts: list[str]) -> Iterator[bytes]:
        together = [
            self.by_pieces and len(t) <= BLOCK and not self._has_added(t)
            and self.ordinary.fullmatch(t) is not None
            for t in texts
        ]
        found = iter(self._ordinary_block([t for t, known in zip(texts, together) if known]))
        for text, known in zip(texts, together):
            yield next(found) if known else self.encode(text)

    def encode(self, text: str) -> bytes:
        """The ids of the text as little-endian unsigned integers of ``width``."""
        if not self.by_pieces or self._has_added(text):
            return self._whole(text)
        if self.ordinary.fullmatch(text):
            return self._ordinary(text)
        return b"".join(
            self._ordinary(chunk) if self.ordinary.fullmatch(chunk) else self.unusual_known[chunk]
            for chunk in re.split(r"[\x20\x09-\x0D]+", text)
            if chunk
        )


def id_width(vocabulary: str, end_id: int) -> str:
    """The type that holds all ids."""
    return "<u2" if max(end_id, IdEncoder.size(json.loads(vocabulary)) - 1) < 1 << 16 else "<u4"


_LOADED: dict[int, IdEncoder] = {}


def _loader(spark: SparkSession, vocabulary: str, width: str) -> Callable[[], IdEncoder]:
    """One encoder per Python worker; the vocabulary, of fixed size, comes from the driver."""
    content = spark.sparkContext.broadcast(vocabulary)

    def load() -> IdEncoder:
        key = hash((content.value, width))
        if key not in _LOADED:
            _LOADED.clear()
            _LOADED[key] = IdEncoder(content.value, width)
        return _LOADED[key]

    return load


# ---- Elias-Fano --------------------------------------------------------------------------------


class EliasFano:
    """A sequence of numbers that never fall, in about ``2 + log2(range / n)`` bits each.

    The lower bits of each number stand side by side. The upper ones are a bit string in which one
    number more is a 1 and one step up is a 0, so number ``i`` has the upper part *(place of the
    i-th 1) - i*. Places of every ``SAMPLE``-th 1 are stored, so selecting one number reads a bounded
    number of ones from there.
    """

    def __init__(self, n: int, first: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.first, self.low_bits = n, first, low_bits
        self.low = np.frombuffer(low, dtype=np.uint8)
        self.high = np.frombuffer(high, dtype=np.uint8)
        self.samples = np.frombuffer(samples, dtype="<u4")

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        if not n:
            return cls(0, 0, 0, b"", b"", b"")
        first = int(values[0])
        # Differences to the first one fit into 64 bits without a sign.
        rest = values.astype(np.int64).view(np.uint64) - np.int64(first).view(np.uint64)
        low_bits = max(int(rest[-1]) // n, 1).bit_length() - 1
        bits = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((rest[:, None] >> bits) & np.uint64(1)).astype(np.uint8), bitorder="little")
        places = (rest >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1, dtype=np.uint8)
        high[places] = 1
        packed = np.packbits(high, bitorder="little")
        return cls(
            n, first, low_bits, low.tobytes(), packed.tobytes(), places[::SAMPLE].astype("<u4").tobytes()
        )

    def parts(self) -> tuple[int, int, int, bytes, bytes, bytes]:
        return (
            self.n, self.first, self.low_bits,
            self.low.tobytes(), self.high.tobytes(), self.samples.tobytes(),
        )

    def _value(self, places: np.ndarray, index: np.ndarray) -> np.ndarray:
        bits = np.arange(self.low_bits)
        at = index[:, None] * self.low_bits + bits
        ones = (self.low[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1)
        low = (ones.astype(np.uint64) << bits.astype(np.uint64)).sum(axis=1, dtype=np.uint64)
        high = (places - index).astype(np.uint64) << np.uint64(self.low_bits)
        return (high + low + np.int64(self.first).view(np.uint64)).view(np.int64)

    def select(self, i: int) -> int:
        """Number ``i``, read from the stored position before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        block, rest = divmod(i, SAMPLE)
        start = int(self.samples[block])
        # Up to the next stored position, where the ones after it begin.
        stop = int(self.samples[block + 1]) if block + 1 < len(self.samples) else len(self.high) * 8 - 1
        window = np.unpackbits(self.high[start >> 3 : (stop >> 3) + 1], bitorder="little")
        ones = np.flatnonzero(window[start & 7 :])
        return int(self._value(np.array([start + ones[rest]]), np.array([i]))[0])

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        return self._value(places, np.arange(self.n))


_EF = "struct<n:int,first:long,low_bits:int,low:binary,high:binary,samples:binary>"
_EF_NAMES = ("n", "first", "low_bits", "low", "high", "samples")
_EF_TYPE = pa.struct(
    [("n", pa.int32()), ("first", pa.int64()), ("low_bits", pa.int32()),
     ("low", pa.binary()), ("high", pa.binary()), ("samples", pa.binary())]
)
#: Columns of the files. ``before`` is the number of ids of the part's earlier segments; ``ends`` are
#: where documents end, counted from the segment's first id.
_SEGMENTS = (
    f"part int, before long, n_ids long, width string, n_docs int, n_without_id int, last_id long,"
    f" doc_ids {_EF}, ends {_EF}, ids binary"
)
_SEGMENT_TYPE = pa.schema(
    [("part", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("width", pa.string()),
     ("n_docs", pa.int32()), ("n_without_id", pa.int32()), ("last_id", pa.int64()),
     ("doc_ids", _EF_TYPE), ("ends", _EF_TYPE), ("ids", pa.binary())]
)


def _fields(sequence: EliasFano) -> dict:
    return dict(zip(_EF_NAMES, sequence.parts()))


def _sequence(fields: dict) -> EliasFano:
    return EliasFano(*[fields[name] for name in _EF_NAMES])


def _segment(
    part: int, before: int, doc_ids: list[int | None], ids: list[bytes], width: str
) -> pa.RecordBatch:
    present = np.array([i for i in doc_ids if i is not None], dtype=np.int64)
    ends = np.cumsum([len(x) for x in ids], dtype=np.int64) // np.dtype(width).itemsize
    row = {
        "part": part,
        "before": before,
        "n_ids": int(ends[-1]),
        "width": width,
        "n_docs": len(doc_ids),
        "n_without_id": len(doc_ids) - len(present),
        "last_id": int(present[-1]) if len(present) else None,
        "doc_ids": _fields(EliasFano.encode(present)),
        "ends": _fields(EliasFano.encode(ends)),
        "ids": b"".join(ids),
    }
    return pa.RecordBatch.from_pylist([row], schema=_SEGMENT_TYPE)


def _segments(width: str, size: int):
    """Consecutive documents of a sorted partition as segments of about ``size`` bytes of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, held, part = 0, 0, 0
        doc_ids: list[int | None] = []
        ids: list[bytes] = []
        for batch in batches:
            for part, doc_id, content in zip(
                batch.column("part").to_pylist(), batch.column("id").to_pylist(), batch.column("ids")
            ):
                content = content.as_py()
                if ids and (held + len(content) > size or len(ids) == DOCUMENTS):
                    yield _segment(part, before, doc_ids, ids, width)
                    before += held // np.dtype(width).itemsize
                    held, doc_ids, ids = 0, [], []
                doc_ids.append(doc_id)
                ids.append(content)
                held += len(content)
        if ids:
            yield _segment(part, before, doc_ids, ids, width)

    return run


# ---- writing and reading -----------------------------------------------------------------------


def _range_starts(keys: DataFrame, parts: int) -> list[tuple]:
    """The smallest ``(has no id, id, row)`` of each range but the first: at most ``parts`` rows."""
    order = [F.asc_nulls_last("id"), F.asc("row")]
    ranged = keys.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id())
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row"))
    starts = ranged.groupBy("range").agg(F.min(place).alias("start")).collect()
    return sorted((r.start.none, r.start.id or 0, r.start.row) for r in starts)[1:]


def _encoded(load: Callable[[], IdEncoder], end_id: int, starts: list[tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load()
        end = end_id.to_bytes(np.dtype(encoder.width).itemsize, "little")
        for batch in batches:
            doc_ids, rows = batch.column("id"), batch.column("row")
            parts = [
                bisect_right(starts, (doc_id is None, doc_id or 0, row))
                for doc_id, row in zip(doc_ids.to_pylist(), rows.to_pylist())
            ]
            texts = (t.as_py() for t in batch.column("text"))
            ids = pa.array((i + end for i in encoder.encode_all(texts)), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), doc_ids, rows, ids], names=["part", "id", "row", "ids"]
            )

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    segment_bytes: int = SEGMENT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encodes all texts and writes their ids below ``path``, in ascending order of identifiers.

    ``path/segments`` holds Parquet files, which Spark commits as a whole, so a lost or repeated
    task leaves no second copy. A row is a segment: the concatenated ids of consecutive documents,
    2 bytes each if the vocabulary allows; the ends of the documents, and their integer identifiers,
    in Elias-Fano form. No document's offset counts beyond its segment, nor a segment's beyond its
    part; ``path/index`` holds one row per part with the number of ids before it. ``tokenizer`` is a
    file of the tokenizers library; ``end_id`` is added to each document.

    A null text has no other id than that. Identifiers that are null come last; rows that share one
    keep the order in which they were read, and any number of them is spread over ranges. An empty
    table gives empty files. A segment has at least one document, so memory is bounded by
    ``segment_bytes`` and the longest text.

    Texts are encoded where they are read; one exchange of ids puts them in order. The ranges come
    from a sort of the identifiers alone; their number is that of the shuffle partitions, and only
    the place where each starts goes through the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.monotonically_increasing_id().alias("row"),
        text_of(F.col(text_column)).alias("text"),
    )
    starts = _range_starts(rows.select("id", "row"), shuffle_partitions(spark))
    with open(tokenizer, encoding="utf-8") as file:
        vocabulary = file.read()
    width = id_width(vocabulary, end_id)
    encoded = rows.mapInArrow(
        _encoded(_loader(spark, vocabulary, width), end_id, starts),
        "part int, id long, row long, ids binary",
    )
    placed = encoded.repartitionById(len(starts) + 1, F.col("part")).sortWithinPartitions(
        "part", F.asc_nulls_last("id"), "row"
    )
    segments = placed.mapInArrow(_segments(width, segment_bytes), _SEGMENTS)
    segments.write.option("compression", "zstd").parquet(f"{path}/segments")

    # One row per part: its size is bounded by their number.
    totals = _read(spark, path).groupBy("part").agg(F.sum("n_ids").alias("total"))
    first = F.sum("total").over(Window.orderBy("part")) - F.col("total")
    totals.select("part", first.alias("first_id")).write.parquet(f"{path}/index")


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SEGMENTS).parquet(f"{path}/segments")


def _documents(with_ids: bool, wanted: frozenset[int] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                doc_ids, ends = _sequence(row["doc_ids"]), _sequence(row["ends"])
                ids = np.frombuffer(row["ids"], dtype=row["width"])
                named = doc_ids.all().tolist() + [None] * row["n_without_id"]
                if wanted is None:
                    chosen: Iterable[int] = range(row["n_docs"])
                    stops = ends.all().tolist()
                    starts = [0, *stops[:-1]]
                else:
                    chosen = [i for i, doc in enumerate(named) if doc in wanted]
                    stops = {i: ends.select(i) for i in chosen}
                    starts = {i: ends.select(i - 1) if i else 0 for i in chosen}
                found: list[list] = [[], [], [], [], []]
                for i in chosen:
                    own = ids[starts[i] : stops[i]].astype("<u4")
                    found[0].append(named[i])
                    found[1].append(row["first_id"] + row["before"] + starts[i])
                    found[2].append(len(own))
                    found[3].append(zlib.crc32(own.tobytes()))
                    if with_ids:
                        found[4].append(own.astype(np.int32))
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids]
                columns = [pa.array(values, kind) for values, kind, _ in zip(found, kinds, names)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read_token_files(
    spark: SparkSession, path: str, with_ids: bool = False, doc_ids: Iterable[int] | None = None
) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each document in the files, and its ``ids`` if
    asked for; ``start`` is the number of ids of all documents before it, ``ids_crc32`` that of its
    ids as little-endian unsigned 32-bit integers.

    ``doc_ids``, a short list, gives only these documents: segments whose range of identifiers
    holds none are not read, and in the others the select structure finds where each starts.
    """
    segments = _read(spark, path)
    if doc_ids is not None:
        doc_ids = frozenset(doc_ids)
        asked = F.array(*[F.lit(i).cast("long") for i in sorted(doc_ids)])
        segments = segments.where(
            F.exists(asked, lambda i: i.between(F.col("doc_ids.first"), F.col("last_id")))
        )
    # One row per part, and there are no more parts than shuffle partitions when it was written.
    index = spark.read.schema("part int, first_id long").parquet(f"{path}/index")
    placed = segments.join(F.broadcast(index), "part")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return placed.mapInArrow(_documents(with_ids, doc_ids), schema)


def token_files(docs: DataFrame, tokenizer: str, end_id: int, **columns: str) -> DataFrame:
    """The documents as they are read from files that are written here, in a fresh shared folder."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer, end_id, **columns)
    return read_token_files(docs.sparkSession, path)
