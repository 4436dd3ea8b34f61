"""Removal of repeated passages by content-cut blocks and windows.

This stands in for a relative Lempel-Ziv parse: there is no greedy longest match
against reference blocks that runs from factor to factor.  Blocks are joined by
the hash of their whole content, and windows are looked up where contents differ.
Equal windows lie in equal blocks, or in blocks of one anchor, so the words found
are those that a parse with checked factor boundaries would find.

A passage counts as repeated in a document if a window of WINDOW consecutive
words also starts in a document with a smaller doc_id.

Reference blocks.  Every window contains 35 runs of 16 words; the run with the
smallest hash is its anchor.  Consecutive windows with one anchor form a block,
a stretch of text cut by its content: wherever a passage occurs, its inner
blocks are cut alike.  The table of all blocks of all documents (anchor, hash of
the whole block, doc_id, place) is the index.

Known stretches, called factors below.  A document's blocks are looked up by joins
on the index:
- an anchor that only one document has cannot lie in a repeated window;
- a block whose whole content is known from a smaller document is a factor, at
  once for all its windows;
- where an anchor has blocks of different content, a factor ends inside them.
  Only there, and only for the first document of each content, every window is
  hashed and looked up: the check at factor boundaries.
A factor covers at least one window; overlapping factors are merged when the
words they cover are removed.

Volume: about 0.055 blocks a word, and windows only at factor boundaries.
Groupings are sums and minima, so a passage in a third of all documents is
pre-aggregated; joins have one row per key on one side, written before, so that
Spark can split a hot key.  Texts are shuffled twice, by doc_id, to meet the
blocks to be looked up and the spans to be cut.

Edge cases: a null or blank text has no words; a document shorter than a window
keeps all words; an empty table gives an empty result; a row whose doc_id is
null has no place in the order: it keeps its words and is no reference; rows
that repeat a doc_id are one document, each giving a result row; other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.base import stage

WINDOW, RUN = 50, 16
BASE = 0x9E3779B97F4A7C15
CACHED_WORDS = 400_000

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_known: dict[bytes, int] = {}


def _word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_known) > CACHED_WORDS:
        _known.clear()
    for w in set(words).difference(_known):
        _known[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


class Rolling:
    """Hashes of any stretch of a word sequence: a polynomial modulo 2**64 over
    64-bit word hashes, by prefix sums."""

    def __init__(self, words: list[bytes]):
        n = len(words)
        if len(_powers[0]) <= n:
            size = 1 << n.bit_length()
            for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                _powers[k] = np.multiply.accumulate(steps)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_word_hashes(words) * _powers[0][:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * _powers[1][starts]


def _blocks(words: list[bytes], window: int, run: int):
    """anchor hash, content hash, first and last window start of each block."""
    n = len(words) - window + 1
    text = Rolling(words)
    starts = np.arange(len(words) - run + 1)
    runs = text.of(starts, starts + run)
    # leftmost smallest run of each window
    width = window - run + 1
    anchors = np.empty(n, np.int64)
    for at in range(0, n, 1 << 14):
        some = np.lib.stride_tricks.sliding_window_view(runs[at : at + (1 << 14) + width - 1], width)
        anchors[at : at + len(some)] = some[: n - at].argmin(axis=1) + np.arange(at, min(at + len(some), n))
    first = np.concatenate([[0], np.flatnonzero(np.diff(anchors)) + 1])
    last = np.concatenate([first[1:] - 1, [n - 1]])
    anchor = anchors[first]
    content = text.of(first, last + window)
    # equal content has its anchor at one place; the place is mixed in all the same
    content = content * np.uint64(3) + (anchor - first).astype(np.uint64)
    return runs[anchor], content, first, last


def _split(text) -> list[bytes]:
    return (text.as_py() or b"").split()  # on bytes: the six ASCII white space characters


def blocks(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """The index: anchor, content, doc_id, first and last window start."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def find(batches):
        for b in batches:
            ids, texts = b.column(0), b.column(1).cast(pa.binary())
            found, rows = [], []
            for k, text in enumerate(texts):
                words = _split(text)
                if len(words) >= window:
                    found.append(_blocks(words, window, run))
                    rows.append(np.full(len(found[-1][0]), k))
            if found:
                anchor, content, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)),
                        ids.take(pa.array(np.concatenate(rows))),
                        pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                    ],
                    ["anchor", "content", "doc_id", "first", "last"],
                )

    return docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(
        find, f"anchor long, content long, doc_id {id_type}, first int, last int"
    )


def _by_doc(spans: DataFrame, *columns: str) -> DataFrame:
    """Spans of a document as arrays; their number is bounded by its own length."""
    return spans.groupBy("doc_id").agg(F.collect_list(F.struct(*columns)).alias("spans"))


def _boundary_windows(docs: DataFrame, spans: DataFrame, window: int) -> DataFrame:
    """anchor, window hash, doc_id and start of every window in the given blocks."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def find(batches):
        for b in batches:
            texts, lists = b.column(1).cast(pa.binary()), b.column(2)
            for k, text in enumerate(texts):
                rolling = Rolling(_split(text))
                part = lists[k].values
                anchor, first, last = (part.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                sizes = last - first + 1
                starts = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(anchor, sizes)),
                        pa.array(rolling.of(starts, starts + window).view(np.int64)),
                        b.column(0).take(pa.array(np.full(len(starts), k))),
                        pa.array(starts.astype(np.int32)),
                    ],
                    ["anchor", "content", "doc_id", "first"],
                )

    grouped = stage(_by_doc(spans, "anchor", "first", "last"), "boundary-blocks")
    chosen = docs.select("doc_id", "text").join(grouped, "doc_id")
    return chosen.select("doc_id", "text", "spans").mapInArrow(
        find, f"anchor long, content long, doc_id {id_type}, first int"
    )


def repeated_spans(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """doc_id, start and end (exclusive) of word spans made of repeated windows."""
    index = stage(blocks(docs, window, run), "blocks")
    anchors = stage(
        index.groupBy("anchor").agg(
            F.min("doc_id").alias("least"), F.max("doc_id").alias("most"),
            (F.min("content") == F.max("content")).alias("alike"),
        ).where("least < most").select("anchor", "least", "alike"), "anchors",
    )
    shared = stage(index.join(anchors, "anchor"), "shared-blocks")
    mixed = shared.where("NOT alike")
    contents = stage(
        mixed.groupBy("anchor", "content").agg(F.min("doc_id").alias("least")), "contents"
    )
    mixed = stage(mixed.drop("least").join(contents, ["anchor", "content"]), "mixed-blocks")
    whole = shared.where("alike").select("doc_id", "first", "last", "least").unionByName(
        mixed.select("doc_id", "first", "last", "least")
    ).where("doc_id > least").select("doc_id", "first", (F.col("last") + window).alias("end"))

    windows = stage(
        _boundary_windows(docs, mixed.where("doc_id = least").select("doc_id", "anchor", "first", "last"), window),
        "boundary-windows",
    )
    known = stage(
        windows.groupBy("anchor", "content").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most").drop("most"), "known-windows",
    )
    single = windows.join(known, ["anchor", "content"]).where("doc_id > least").select(
        "doc_id", "first", (F.col("first") + window).alias("end")
    )
    return whole.unionByName(single)


def _kept(words: list[bytes], spans) -> list[bytes]:
    """Words outside the spans, an array of (first, end)."""
    if spans is None:
        return words
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, spans.field(0).to_numpy(zero_copy_only=False), 1)
    np.add.at(step, spans.field(1).to_numpy(zero_copy_only=False), -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]


def deduplicate(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """doc_id, n_words and the kept words of each document, joined by one space."""
    spans = stage(_by_doc(repeated_spans(docs, window, run), "first", "end"), "repeated-spans")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for b in batches:
            texts, lists = b.column(1).cast(pa.binary()), b.column(2)
            n_words, n_removed, kept_text = [], [], []
            for k, text in enumerate(texts):
                words = _split(text)
                kept = _kept(words, lists[k].values if lists[k].is_valid else None)
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                kept_text.append(b" ".join(kept))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(kept_text, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    joined = docs.select("doc_id", "text").join(spans, "doc_id", "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        cut, f"doc_id {id_type}, n_words long, n_removed long, kept string"
    )


def digest(deduplicated: DataFrame) -> DataFrame:
    """The kept words as a hash."""
    return deduplicated.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
