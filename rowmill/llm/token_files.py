"""Token ids as flat binary files.

One partition of the documents, sorted by doc_id, gives three files:
``<n>.ids``  the token ids as flat little-endian unsigned integers, 16 bits wide
             if the vocabulary allows, else 32;
``<n>.off``  n_docs + 1 little-endian 64-bit offsets into the ids;
``<n>.doc``  n_docs little-endian 64-bit doc_ids (zero where null; those rows
             come first, and the manifest has their number).
The manifest is a Parquet table with one row per partition; the base of a
partition, the number of ids before it, is a prefix sum over the manifest.

Files are written under a name of the task's own and renamed, so an attempt that
dies leaves nothing under a final name, and a second attempt writes the same
bytes.  They go to the folder that the cluster shares, through Arrow's file
systems; local ones are memory-mapped when read.

A document of many words costs little more than its distinct words: text is cut
at ASCII white space, where the tokenizer cuts too, and each distinct word is
encoded once per task, by the library.

Edge cases: a null text is empty and has the end id alone; rows with equal
doc_id stay, in the order of a hash of their texts; a null doc_id sorts first; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rowmill.llm.base import stage
from rowmill.sources.workdir import new_path

END_ID, END = 1, b" "
CACHED_WORDS = 300_000
CHUNK = 2_000
TEXT_BYTES = 4 << 20
# between an ASCII letter and the ASCII punctuation that ends its word
TAIL = re.compile(rb"(?<=[a-z])(?=[!-/:-@\[-`{-~]+(?:\s|\Z))")


class WordEncoder:
    """Ids of whole texts from the ids of their words, which are kept.

    Words are the stretches between ASCII white space.  For this tokenizer a
    text's ids are its words' ids in order: it normalizes white space, lower-cases
    single characters and never joins across white space.  Spellings are brought
    together before a look-up where that gives the same ids: ASCII letters become
    lower case, and ASCII punctuation after the last ASCII letter of a word is a
    word of its own.  A text with combining marks, which composition may join to
    an ASCII letter first, or with a special token's start is only cut.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = np.uint16 if size <= 1 << 16 else np.uint32
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(size, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._clear()

    def _clear(self):
        # a space is no word; it stands for the end of a text
        self.numbers = {END: 0}
        self.flat, self.sizes = [np.array([END_ID], self.width)], [np.array([1])]

    def _encode(self, texts: list[str]):
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.width) for e in found]

    def _learn(self, new: list[bytes]) -> None:
        """Number new words; their ids follow in the same order."""
        plain, other = [], []
        for w in map(bytes.decode, new):
            (plain if w.isalpha() and (w.isascii() or w.lower().isalpha()) else other).append(w)
        # plain words are one piece each, and a piece ends with an end-of-word id
        for at in range(0, len(plain), CHUNK):
            some = plain[at : at + CHUNK]
            ids = self._encode([" ".join(some)])[0]
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some):
                self._add(some, ids, np.diff(ends, prepend=0))
            else:
                other += some
        for at in range(0, len(other), CHUNK):
            some = other[at : at + CHUNK]
            ids = self._encode(some)
            self._add(some, np.concatenate(ids), np.array([len(x) for x in ids]))

    def _add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        base = len(self.numbers)
        self.numbers.update(zip(map(str.encode, words), range(base, base + len(words)), strict=True))
        self.flat.append(ids)
        self.sizes.append(sizes)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts in a row, each with the end id, and their numbers."""
        if len(self.numbers) > CACHED_WORDS:
            self._clear()
        words, ends = [], []
        for text in texts:
            words += _pieces(text)
            words.append(END)
            ends.append(len(words))
        new = set(words).difference(self.numbers)
        if new:
            self._learn(sorted(new))
        self.flat, self.sizes = [np.concatenate(self.flat)], [np.concatenate(self.sizes)]
        flat, sizes = self.flat[0], self.sizes[0]
        starts = np.cumsum(sizes) - sizes
        numbers = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        n = sizes[numbers]
        upto = np.cumsum(n)
        ids = flat[np.repeat(starts[numbers] - upto + n, n) + np.arange(upto[-1])]
        return ids, np.diff(upto[np.array(ends) - 1], prepend=0)


def _pieces(text: bytes) -> list[bytes]:
    if b"<|" in text or b"\xcc" in text or b"\xcd" in text:
        return text.split()
    return TAIL.sub(b" ", text.lower()).split()


@functools.lru_cache(1)
def _encoder(path: str) -> WordEncoder:
    """One per Python worker, which serves many tasks."""
    return WordEncoder(path)


def _some_texts(column):
    """The texts of a column in lists of about TEXT_BYTES."""
    held, size = [], 0
    for text in column:
        held.append(text.as_py() or b"")
        size += len(held[-1])
        if size >= TEXT_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _place(folder: str):
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        pafs.LocalFileSystem(), folder
    )


def _put(fs, path: str, parts) -> None:
    """Write under another name and rename."""
    own = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    fs.move(own, path)


def write(docs: DataFrame, folder: str, tokenizer_path: str) -> DataFrame:
    """Write the files; returns the manifest: part, n_docs, n_null, n_ids, base."""

    def run(batches):
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), _encoder(tokenizer_path)
        fs, root = _place(folder)
        fs.create_dir(root, recursive=True)
        path, sizes, ids, nulls = f"{root}/{part:06d}", [], [], 0
        own = f"{path}.ids.{uuid.uuid4().hex}"
        with fs.open_output_stream(own) as out:
            for b in batches:
                nulls += b.column(0).null_count
                ids.append(b.column(0).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False))
                for texts in _some_texts(b.column(1).cast(pa.binary())):
                    tokens, n = encoder.encode(texts)
                    sizes.append(n)
                    out.write(tokens.astype(tokens.dtype.newbyteorder("<")).tobytes())
        if not sizes:
            fs.delete_file(own)
            return
        fs.move(own, f"{path}.ids")
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype("<u8")
        _put(fs, f"{path}.off", [offsets.tobytes()])
        _put(fs, f"{path}.doc", [np.concatenate(ids).astype("<i8").tobytes()])
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part], pa.int32()), "n_docs": pa.array([len(offsets) - 1], pa.int64()),
                "n_null": pa.array([nulls], pa.int64()), "n_ids": pa.array([int(offsets[-1])], pa.int64()),
                "width": pa.array([np.dtype(encoder.width).itemsize], pa.int32()),
            }
        )

    # the hash of a text and not the text itself is sampled for the ranges
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    ranged = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    manifest = stage(
        ranged.select("doc_id", "text").mapInArrow(
            run, "part int, n_docs long, n_null long, n_ids long, width int"
        ), "token-manifest",
    )
    # one row per partition of the writing job
    before = F.sum("n_ids").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    return manifest.withColumn("base", F.coalesce(before, F.lit(0)))


def _open(fs, path: str, kind):
    """A file's values: memory-mapped where the file system is local."""
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), kind)


def read(manifest: DataFrame, folder: str, chunk: int = 4096) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""

    def run(batches):
        fs, root = _place(folder)
        for b in batches:
            for row in b.to_pylist():
                path = f"{root}/{row['part']:06d}"
                offsets, doc_ids = _open(fs, f"{path}.off", "<u8"), _open(fs, f"{path}.doc", "<i8")
                ids = _open(fs, f"{path}.ids", f"<u{row['width']}")
                for at in range(0, row["n_docs"], chunk):
                    edges = np.array(offsets[at : at + chunk + 1], np.int64)
                    crcs = [
                        zlib.crc32(ids[s:e].astype("<u4").tobytes())
                        for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)
                    ]
                    absent = np.arange(at, at + len(crcs)) < row["n_null"]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(np.array(doc_ids[at : at + chunk]), pa.int64(), mask=absent),
                            "start": pa.array(edges[:-1] + row["base"], pa.int64()),
                            "n_tokens": pa.array(np.diff(edges), pa.int64()),
                            "ids_crc32": pa.array(crcs, pa.int64()),
                        }
                    )

    # the manifest is tiny, the files are not: a number given is not merged by bytes
    files = manifest.select("part", "n_docs", "n_null", "width", "base")
    dealt = files.repartitionByRange(max(1, files.count()), "part")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer_path: str, folder: str | None = None) -> DataFrame:
    """Write the documents' ids to a new folder and describe what the files hold."""
    folder = folder or new_path(docs.sparkSession, "token-files")
    return read(write(docs, folder, tokenizer_path), folder)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


__all__ = ["WordEncoder", "write", "read", "round_trip", "default_tokenizer"]
