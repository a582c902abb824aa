"""Byte-level BPE over a trie of words: encodings of shared prefixes are computed once."""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatprep.llm.common import text_of

#: Fixed values of byte-level BPE: how text is split, and the bytes that stand for themselves.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTED = ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF))

#: Characters of a text that are split into words at a time.
PIECE = 1 << 18
#: Distinct words whose encodings a task remembers.
REMEMBERED = 400_000
#: Characters of these words, since words can be long.
REMEMBERED_CHARACTERS = 1 << 23
#: Pairs of tokens of which a task remembers whether they can be neighbours.
REMEMBERED_PAIRS = 1_000_000
#: Characters of the texts whose new words share one trie.
TOGETHER = 1 << 22
#: Bytes of a word that the next words of the trie may share with it.
SHARED = 1 << 10

#: Key of the token in a node of the vocabulary's trie.
END = -1

_CUT = regex.compile(r"(?<=\S) (?=\S)")


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in vocabulary files."""
    own = [b for low, high in PRINTED for b in range(low, high + 1)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class TrieEncoder:
    """Encodes and decodes texts with the vocabulary of a tokenizer file."""

    def __init__(self, vocabulary: str):
        """``vocabulary``: the content of a tokenizers JSON file with a byte-level BPE model."""
        file = json.loads(vocabulary)
        symbols = byte_symbols()
        model = file["model"]
        ids = model["vocab"]
        self.bytes_of = {i: bytes(symbols[c] for c in token) for token, i in ids.items()}
        self.single = {content[0]: i for i, content in self.bytes_of.items() if len(content) == 1}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.bytes_of |= {i: content.encode() for content, i in self.special.items()}
        longest = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self.words = regex.compile(WORDS)

        # The vocabulary as a trie of dicts: byte -> node, and END -> the token that ends there.
        self.root: dict = {}
        for i, content in self.bytes_of.items():
            if i in self.special.values():
                continue
            node = self.root
            for b in content:
                node = node.setdefault(b, {})
            node[END] = i
        self.number = {i: i.to_bytes(4, "little") for i in self.bytes_of}
        self.parts = {whole: (pair, rank) for pair, (rank, whole) in self.merges.items()}
        self.edges: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self.follows: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.known_characters = 0

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that stand at one edge (0 left, 1 right) of ``token`` while it is merged.

        Each comes with the rank of the merge that ends it; the whole token lasts.
        """
        found = self.edges.get((token, side))
        if found is None:
            found, part, until = [], token, float("inf")
            while True:
                found.append((part, until))
                if part not in self.parts:
                    break
                pair, until = self.parts[part]
                part = pair[side]
            self.edges[token, side] = found
        return found

    def can_follow(self, before: int, token: int) -> bool:
        """Whether BPE leaves these two tokens as they are, side by side (-1: start of a word).

        It does unless some merge across the border comes first: one of a part at the right edge
        of the first token with a part at the left edge of the second, of a rank at which neither
        has been merged away. Of equal ranks the leftmost pair is merged first. A sequence of
        tokens is the BPE encoding of its bytes exactly if this holds for each pair of neighbours,
        so the last token of a prefix is all that has to be kept of it.
        """
        if before < 0:
            return True
        key = (before, token)
        found = self.follows.get(key)
        if found is None:
            found = True
            for left, left_until in self.edge(before, 1):
                for right, right_until in self.edge(token, 0):
                    merge = self.merges.get((left, right))
                    if merge and merge[0] < left_until and merge[0] <= right_until:
                        found = False
            if len(self.follows) >= REMEMBERED_PAIRS:
                self.follows.clear()
            self.follows[key] = found
        return found

    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Each distinct word with its ids, as little-endian unsigned 32-bit integers.

        Words in byte order are the leaves of their trie in depth-first order: the path to the next
        word starts with what it shares with the last one, whose states are still on the stack. A
        state is the prefix's last token, where that token starts, and the vocabulary nodes of all
        tokens that may still be growing; the nodes are kept for the first ``SHARED`` bytes only. A
        word's ids are read backwards at its end, so time and memory grow with its length.
        """
        last = array("i", [-1])
        begins = array("q", [0])
        growing: list[list[tuple[int, dict]]] = [[]]
        path = b""
        root, number, can_follow = self.root, self.number, self.can_follow
        for content, word in sorted((w.encode("utf-8", "replace"), w) for w in set(words)):
            shared = 0
            for a, b in zip(path, content):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], begins[shared + 1 :], growing[shared + 1 :]
            open_before = growing[shared]
            for depth in range(shared, len(content)):
                b = content[depth]
                token = None
                open_tokens = []
                for start, node in open_before:
                    node = node.get(b)
                    if node is not None:
                        open_tokens.append((start, node))
                        if token is None:
                            ends = node.get(END)
                            if ends is not None and can_follow(last[start], ends):
                                token, at = ends, start
                node = root[b]
                open_tokens.append((depth, node))
                if token is None:
                    token, at = node[END], depth
                last.append(token)
                begins.append(at)
                if depth < SHARED:
                    growing.append(open_tokens)
                open_before = open_tokens
            path = content[:SHARED]
            ids, at = [], len(content)
            while at:
                ids.append(number[last[at]])
                at = begins[at]
            ids.reverse()
            yield word, b"".join(ids)

    def _split(self, text: str) -> Iterator[str]:
        """Pieces of a long text, cut where a word certainly ends: before a space inside text."""
        at = 0
        while len(text) - at > PIECE and (cut := _CUT.search(text, at + PIECE)):
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def _parts(self, text: str) -> Iterator[list[str] | int]:
        """The words of the text, piece by piece, and the special tokens between them."""
        for i, part in enumerate(self.specials.split(text) if self.specials else [text]):
            if i % 2:
                yield self.special[part]
            else:
                yield from map(self.words.findall, self._split(part))

    def _learn(self, words: set[str]) -> None:
        """Encodes the words that are not known. Those not used for a generation are forgotten."""
        known, before = self.known, self.before
        new = [w for w in words if w not in known]
        characters = sum(map(len, new))
        if (
            len(known) + len(new) > REMEMBERED
            or self.known_characters + characters > REMEMBERED_CHARACTERS
        ):
            self.known, self.before = known, before = {}, known
            new = list(words)
            self.known_characters, characters = 0, sum(map(len, new))
        self.known_characters += characters
        for word in new:
            if word in before:
                known[word] = before[word]
        known.update(self.encode_words(w for w in new if w not in known))

    def _ids(self, parts: Iterable[list[str] | int]) -> bytes:
        known = self.known.__getitem__
        return b"".join(
            self.number[part] if isinstance(part, int) else b"".join(map(known, part))
            for part in parts
        )

    def encode(self, text: str) -> bytes:
        """The ids of the text, as little-endian unsigned 32-bit integers."""
        out = []
        for part in self._parts(text):
            if not isinstance(part, int):
                self._learn(set(part))
            out.append(self._ids([part]))
        return b"".join(out)

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The texts' ids in turn; texts of about ``TOGETHER`` characters share a trie."""
        group: list[list[list[str] | int]] = []
        size = 0

        def flush() -> Iterator[bytes]:
            words = {w for parts in group for part in parts if not isinstance(part, int) for w in part}
            self._learn(words)
            yield from map(self._ids, group)
            group.clear()

        for text in texts:
            if len(text) > PIECE:
                yield from flush()
                yield self.encode(text)
                size = 0
                continue
            group.append(list(self._parts(text)))
            size += len(text)
            if size >= TOGETHER:
                yield from flush()
                size = 0
        yield from flush()

    def decode(self, ids: bytes) -> str:
        content = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        return content.decode("utf-8", "replace")


def _digests(load: Callable[[], TrieEncoder], with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load()
        for batch in batches:
            found: list[list] = [[], [], [], []]
            for ids in encoder.encode_all(t.as_py() for t in batch.column("text")):
                decoded = encoder.decode(ids).encode()
                found[0].append(len(ids) // 4)
                found[1].append(hashlib.sha256(ids).hexdigest())
                found[2].append(hashlib.sha256(decoded).hexdigest())
                if with_ids:
                    found[3].append(np.frombuffer(ids, dtype="<i4"))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
            names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 3 + with_ids]
            columns = [pa.array(values, kind) for values, kind, _ in zip(found, kinds, names)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *names])

    return run


_LOADED: dict[int, TrieEncoder] = {}


def _loader(docs: DataFrame, path: str) -> Callable[[], TrieEncoder]:
    """One encoder per Python worker; the vocabulary, of fixed size, comes from the driver."""
    with open(path, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())

    def load() -> TrieEncoder:
        key = hash(content.value)
        if key not in _LOADED:
            _LOADED.clear()
            _LOADED[key] = TrieEncoder(content.value)
        return _LOADED[key]

    return load


def token_digests(
    docs: DataFrame,
    path: str,
    with_ids: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, one row per input row.

    ``path`` is a tokenizers JSON file with byte-level BPE. Texts are encoded whole, special tokens
    in them recognised, no others added; the ids are decoded again and both are hashed. With
    ``with_ids`` the ids are returned too, as an array. A null text
    counts as empty: no tokens, and the hashes of nothing. Rows keep null and repeated identifiers;
    an empty table gives no rows. Nothing is shuffled.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(F.col(text_column)).alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    out = rows.mapInArrow(
        _digests(_loader(docs, path), with_ids),
        f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
        + ", ids array<int>" * with_ids,
    )
    return out.withColumnRenamed("doc_id", id_column)
