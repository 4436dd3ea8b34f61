"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint sums the bits of the XXH64 values of a text's word shingles.  Two
texts link if their fingerprints differ in at most three of 64 bits.

The search: cut the 64 bits into three parts.  Of at most three differing bits
at most two lie outside the part that holds most of them.  With that part left
out, the two fingerprints are two flips apart at most, and half of that radius
is one flip: every fingerprint emits, for each part, itself and all variants
with one other bit flipped, the part blanked.  Linked fingerprints then share a
variant.  Variants are shuffled and sorted, and colliding fingerprints are
verified on all 64 bits.

Equal fingerprints are one node before the search.  Colliding fingerprints are
joined inside the task that holds them and leave as stars (node, root), never as
pairs; a run of colliding fingerprints is worked through in tiles.

Edge cases: a text without words (null, empty, white space) has fingerprint
zero, which links like any other; fewer words than a shingle are one shingle;
an empty table gives an empty result; a repeated row gives a repeated result
row; rows whose doc_id is null take part, and a component of such rows only has
a null id; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.base import row_hash, small_join, stage
from rowmill.llm.components import connected, merge_labels

SHINGLE, SEED, RADIUS = 3, 42, 3
# bit ranges of the three parts
PARTS = ((0, 21), (21, 42), (42, 64))
TILE = 1024


def text_fingerprint(text: bytes | None) -> int:
    words = (text or b"").lower().split()  # on bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    line, sizes = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    last = min(SHINGLE, len(words)) - 1
    digest, view = xxhash.xxh64_intdigest, memoryview(line)
    spans = zip(starts[: len(words) - last].tolist(), ends[last:].tolist(), strict=True)
    hashes = np.array([digest(view[s:e], SEED) for s, e in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *others: Column) -> DataFrame:
    """doc_id, the fingerprint as a signed 64-bit number, and other values of the row."""

    def run(batches):
        for b in batches:
            texts = b.column("print").cast(pa.binary())
            found = np.fromiter((text_fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
            at = b.schema.get_field_index("print")
            yield b.set_column(at, "print", pa.array(found.view(np.int64)))

    rows = docs.select("doc_id", *others, F.col("text").alias("print"))
    fields = [f for f in rows.schema.fields if f.name != "print"]
    return rows.mapInArrow(run, T.StructType([*fields, T.StructField("print", T.LongType())]))


def variants(prints: DataFrame) -> DataFrame:
    """(variant, print): 132 rows for each fingerprint."""
    one = np.uint64(1)
    flips = []
    for low, high in PARTS:
        blank = np.uint64(((1 << 64) - 1) ^ (((1 << high) - 1) ^ ((1 << low) - 1)))
        kept = [0] + [1 << i for i in range(64) if not low <= i < high]
        flips.append((blank, np.array(kept, np.uint64)))
    del one

    def run(batches):
        for b in batches:
            whole = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(whole), 4096):
                some = whole[at : at + 4096]
                for blank, masks in flips:
                    made = ((some & blank)[:, None] ^ masks[None, :]).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(made.view(np.int64)), pa.array(np.repeat(some, len(masks)).view(np.int64))],
                        ["variant", "print"],
                    )

    return prints.select("print").mapInArrow(run, "variant long, print long")


def _stars(prints: np.ndarray, i: np.ndarray, j: np.ndarray):
    """Spanning stars of the links between fingerprints number i and j."""
    used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    labels = np.arange(len(used))
    merge_labels(labels, at[: len(i)], at[len(i) :])
    off = labels != np.arange(len(used))
    return prints[used[off]], prints[used[labels[off]]]


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= RADIUS


def _run_links(prints: np.ndarray):
    """Links inside one long run of equal variants, tile by tile."""
    prints = np.unique(prints)
    labels = np.arange(len(prints))
    for i in range(0, len(prints), TILE):
        for j in range(i, len(prints), TILE):
            a, b = np.nonzero(_close(prints[i : i + TILE, None], prints[None, j : j + TILE]))
            merge_labels(labels, a + i, b + j)
    off = labels != np.arange(len(prints))
    return prints[off], prints[labels[off]]


def _sorted_links(variant: np.ndarray, prints: np.ndarray):
    """Stars over the verified links of rows sorted by variant."""
    cuts = np.flatnonzero(np.diff(variant)) + 1
    starts = np.concatenate([[0], cuts])
    sizes = np.diff(np.concatenate([starts, [len(variant)]]))
    long = sizes > TILE
    for s, n in zip(starts[long], sizes[long], strict=True):
        yield _run_links(prints[s : s + n])
    if len(cuts) and long.any():
        keep = ~np.repeat(long, sizes)
        variant, prints = variant[keep], prints[keep]
    elif long.any():
        return
    left, right = [], []
    here, step = np.arange(len(variant)), 0
    while len(here):
        step += 1
        here = here[here + step < len(variant)]
        here = here[variant[here] == variant[here + step]]
        hit = here[_close(prints[here], prints[here + step]) & (prints[here] != prints[here + step])]
        left.append(hit)
        right.append(hit + step)
    i, j = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right))
    if len(i):
        # equal fingerprints under several variants are one node
        nodes, at = np.unique(prints, return_inverse=True)
        yield _stars(nodes, at[i], at[j])


def print_links(emitted: DataFrame) -> DataFrame:
    """(a, b): stars that connect all fingerprints within the radius."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out(variant, prints):
            for a, b in _sorted_links(variant, prints):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
                )

        for batch in batches:
            variant = batch.column(0).to_numpy(zero_copy_only=False)
            prints = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(variant):
                continue
            cut = np.searchsorted(variant, variant[-1])  # the last run may go on
            if held and (cut or held[-1][0][-1] != variant[0]):
                held.append((variant[:cut], prints[:cut]))
                yield from out(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held = []
            elif cut:
                yield from out(variant[:cut], prints[:cut])
            held.append((variant[cut:], prints[cut:]))
        if held:
            yield from out(*(np.concatenate(x) for x in zip(*held, strict=True)))

    dealt = emitted.repartition("variant").sortWithinPartitions("variant")
    return dealt.mapInArrow(run, "a long, b long")


def _rooted(prints: DataFrame) -> DataFrame:
    """print and root of every fingerprint, by a table of the rows' fingerprints."""
    classes = stage(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "print-classes")
    roots = connected(print_links(variants(classes)), "a", "b")
    return stage(
        classes.join(roots.withColumnRenamed("node", "print"), "print", "left")
        .select("print", "least", F.coalesce("root", "print").alias("root")), "print-roots",
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of each row."""
    prints = stage(fingerprints(docs), "prints")
    rooted = _rooted(prints)
    least = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "print-components")
    named = stage(rooted.join(least, "root").select("print", "component_id"), "print-named")
    return prints.join(named, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component: the one with the smallest doc_id, null last; of
    several such rows the smallest by a hash of all columns, and of equal rows one."""
    prints = stage(fingerprints(docs, row_hash(docs).alias("same")), "prints")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "same")
    # one candidate a fingerprint, then one a component
    best = prints.groupBy("print").agg(F.min(order).alias("best"))
    kept = _rooted(prints).join(best, "print").groupBy("root").agg(F.min("best").alias("best"))
    kept = stage(kept.select(F.col("best.same").alias("kept")), "kept")
    counts = stage(
        prints.join(kept, F.col("same") == F.col("kept"), "left_semi").groupBy("same").agg(F.count("*").alias("rows")),
        "kept-rows",
    )
    rows = docs.select(F.struct("*").alias("row"), row_hash(docs).alias("same"))
    single = rows.join(counts.where("rows = 1").select("same"), "same", "left_semi")
    many = small_join(rows, stage(counts.where("rows > 1").select("same"), "kept-equal"), ["same"])
    return single.unionByName(many.dropDuplicates(["same"])).select("row.*")
