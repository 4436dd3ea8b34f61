"""Byte-level BPE: encoding by a queue of merge ranks, decoding by concatenation.

A text is cut at the added tokens of the vocabulary file and then, by its
pattern, into pieces.  A piece starts as one symbol a byte in a doubly linked
list.  A heap holds the mergeable neighbours by merge rank and place; the lowest
is merged, its right symbol leaves the list, and the two new neighbours enter the
heap.  An entry whose symbols have changed since is stale and skipped, so a piece
of n bytes costs n log n at any length.  Decoding writes the byte strings of the
ids one after another and reads them as UTF-8, broken sequences replaced.

Each Python worker keeps the ids of the distinct pieces it met, within HELD
pieces and HELD_CHARS characters; then it starts anew.  Texts are taken in runs
of TEXT_CHARS, and nothing is shuffled: documents are encoded where they are read.

The pattern's letters, numbers and spaces are those of the library that the
vocabulary comes from; characters that this Python's `regex` counts otherwise
(newer Unicode versions) are found by asking the library once for each character,
and texts that hold one are cut by the library.

Edge cases: a null text is empty and has no ids, null ids give an empty text; the
string of an added token is that token, as in the library; ids outside the
vocabulary are left out when decoding; a text or a piece may be as long as a row;
repeated rows and null doc_ids stay, row by row; an empty table gives an empty
result; all columns other than the text are passed on by encode(), those named
`ids` or `decoded` are replaced.
"""

from __future__ import annotations

import functools
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HELD, HELD_CHARS = 600_000, 32_000_000
TEXT_CHARS = 2 << 20
DECODED_IDS = 1 << 20
PAIR_SHIFT = 32


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: visible
    Latin-1 characters stand for themselves, the others for 256 and up in turn."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    alphabet, extra = [], 256
    for b in range(256):
        if b in shown:
            alphabet.append(chr(b))
        else:
            alphabet.append(chr(extra))
            extra += 1
    return alphabet


def merge(symbols: list[int], ranks: dict[int, int], made: list[int]) -> list[int]:
    """Merge a piece's symbols.  ranks: left id << PAIR_SHIFT | right id -> rank;
    made: rank -> id of the merged symbol."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = []
    for at in range(n - 1):
        rank = ranks.get(symbols[at] << PAIR_SHIFT | symbols[at + 1])
        if rank is not None:
            queue.append(rank << 32 | at)
    heapq.heapify(queue)
    while queue:
        entry = heapq.heappop(queue)
        rank, at = entry >> 32, entry & 0xFFFFFFFF
        right = after[at]
        # stale: the left symbol is gone, or the pair at this place is another one
        if right >= n or symbols[at] < 0 or ranks.get(symbols[at] << PAIR_SHIFT | symbols[right]) != rank:
            continue
        symbols[at], symbols[right] = made[rank], -1
        behind = after[at] = after[right]
        if behind < n:
            before[behind] = at
            rank = ranks.get(symbols[at] << PAIR_SHIFT | symbols[behind])
            if rank is not None:
                heapq.heappush(queue, rank << 32 | at)
        ahead = before[at]
        if ahead >= 0:
            rank = ranks.get(symbols[ahead] << PAIR_SHIFT | symbols[at])
            if rank is not None:
                heapq.heappush(queue, rank << 32 | ahead)
    return [s for s in symbols if s >= 0]


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        import regex
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or cut["type"] != "ByteLevel" or not cut["use_regex"] or (
            cut["add_prefix_space"] or spec["normalizer"] or model["ignore_merges"] or model["dropout"]
        ):
            raise ValueError(f"{path} is no plain byte-level BPE")
        vocabulary, alphabet = model["vocab"], byte_alphabet()
        self.byte_ids = [vocabulary[c] for c in alphabet]
        self.ranks, self.made = {}, []
        for rank, (left, right) in enumerate(model["merges"]):
            self.ranks.setdefault(vocabulary[left] << PAIR_SHIFT | vocabulary[right], rank)
            self.made.append(vocabulary[left + right])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that take their surroundings")
        self.pattern = regex.compile(PATTERN)
        longest = sorted(self.added, key=len, reverse=True)
        self.added_pattern = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self.split_by_library = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.agreed, self.differing = set(map(chr, range(128))), set()
        byte_of = {c: b for b, c in enumerate(alphabet)}
        strings = {i: s for s, i in (vocabulary | self.added).items()}
        parts = [
            bytes(byte_of[c] for c in s) if all(c in byte_of for c in s) else s.encode()
            for s in (strings.get(i, "") for i in range(max(strings) + 1))
        ]
        # one empty string more, for ids outside the vocabulary
        self.sizes = np.array([*map(len, parts), 0], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(parts), np.uint8)
        self._clear()

    def _clear(self) -> None:
        self.numbers, self.held_chars = {}, 0
        self.flat, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _agrees(self, text: str) -> bool:
        """Whether the pattern cuts a text as the library does, by its characters."""
        if text.isascii():
            return True
        met = set(text)
        for c in met - self.agreed - self.differing:
            probe = f"a{c}b 1{c}1 .{c}. {c}{c} x"
            same = [m.span() for m in self.pattern.finditer(probe)] == [
                span for _, span in self.split_by_library(probe)
            ]
            (self.agreed if same else self.differing).add(c)
        return met.isdisjoint(self.differing)

    def pieces(self, text: str) -> list[str | bytes]:
        """Pieces in order; an added token is given as bytes."""
        parts = self.added_pattern.split(text) if self.added_pattern else [text]
        found: list[str | bytes] = []
        for i, part in enumerate(parts):
            if i % 2:
                found.append(part.encode())
            elif self._agrees(part):
                found += self.pattern.findall(part)
            else:
                found += [part[s:e] for _, (s, e) in self.split_by_library(part)]
        return found

    def _ids(self, piece: str | bytes) -> list[int]:
        if isinstance(piece, bytes):
            return [self.added[piece.decode()]]
        symbols = [self.byte_ids[b] for b in piece.encode()]
        return merge(symbols, self.ranks, self.made) if len(symbols) > 1 else symbols

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts in a row, and how many each has."""
        if len(self.numbers) > HELD or self.held_chars > HELD_CHARS:
            self._clear()
        words, ends = [], []
        for text in texts:
            words += self.pieces(text)
            ends.append(len(words))
        new = list(set(words).difference(self.numbers))
        if new:
            found = [self._ids(w) for w in new]
            base = len(self.numbers)
            self.numbers.update(zip(new, range(base, base + len(new)), strict=True))
            self.held_chars += sum(map(len, new))
            counts = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((i for ids in found for i in ids), np.int32, counts.sum())
            self.flat, self.counts = np.concatenate([self.flat, flat]), np.concatenate([self.counts, counts])
        starts = np.cumsum(self.counts) - self.counts
        numbers = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        n = self.counts[numbers]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.repeat(starts[numbers] - upto[:-1], n) + np.arange(upto[-1])]
        return ids, np.diff(upto[np.array([0, *ends])])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The texts of some id lists that lie in a row."""
        last = len(self.sizes) - 1
        ids = np.where((ids < 0) | (ids > last), last, ids).astype(np.int64)
        n = self.sizes[ids]
        upto = np.concatenate([[0], np.cumsum(n)])
        data = self.blob[np.repeat(self.starts[ids] - upto[:-1], n) + np.arange(upto[-1])]
        edges = upto[np.concatenate([[0], np.cumsum(counts)])]
        raw = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(counts), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)]
        )
        try:
            return raw.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([b.as_py().decode("utf-8", "replace") for b in raw], pa.large_string())


@functools.lru_cache(2)
def _codec(path: str) -> Codec:
    """One per Python worker, which serves many tasks."""
    return Codec(path)


def _runs(sizes, most: int):
    """Cut rows into stretches (from, to) of about `most` in size, one row at least."""
    start = held = 0
    for i, size in enumerate(sizes):
        held += size
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def _with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    names = [*batch.schema.names, name]
    return pa.RecordBatch.from_arrays([*batch.columns, column], names)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """The rows without their text and with `ids`, an array of ints."""
    kept = [c for c in docs.columns if c not in (text, "ids")]

    def run(batches):
        codec = _codec(path)
        for b in batches:
            texts = [t or "" for t in b.column(b.num_columns - 1).to_pylist()]
            rest = b.select(list(range(b.num_columns - 1)))
            for s, e in _runs([*map(len, texts)], TEXT_CHARS):
                ids, counts = codec.encode(texts[s:e])
                edges = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(edges), pa.array(ids))
                yield _with_column(rest.slice(s, e - s), "ids", column)

    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.select(*kept, F.col(text).cast("string").alias("ids")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows with `decoded`, the text of their `ids`."""
    kept = [c for c in encoded.columns if c not in ("ids", "decoded")]

    def run(batches):
        codec = _codec(path)
        for b in batches:
            lists = b.column(b.num_columns - 1)
            counts = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            upto = np.concatenate([[0], np.cumsum(counts)])
            for s, e in _runs(counts.tolist(), DECODED_IDS):
                column = codec.decode(flat[upto[s] : upto[e]], counts[s:e]).cast(pa.string())
                yield _with_column(b.slice(s, e - s), "decoded", column)

    fields = [*encoded.select(*kept, "ids").schema.fields, T.StructField("decoded", T.StringType())]
    return encoded.select(*kept, "ids").mapInArrow(run, T.StructType(fields))


def digest(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


__all__ = ["Codec", "merge", "encode", "decode", "digest", "default_vocabulary"]
