"""Prefix trie of conversations by range-minimum queries over sorted LCPs.

A conversation is the sequence of its turns' 128-bit hashes (role and text) with
the sizes of the texts; texts themselves are not shuffled.  Equal sequences are
one class with a count and its smallest conv_id.  Classes are sorted as sequences
by a range partitioning, and every task cuts its sorted run into blocks of about
BLOCK_TURNS turns.

In a block, the LCP of each class with the one before it and a sparse table of
minima over these give the members of any prefix: every candidate (class, depth)
binary-searches its left and its right extent, each on its own, by the table.
Candidates of which the class itself is the left end are the nodes.  Members,
smallest conv_id, children, leaves and subtree sums of a node are differences of
prefix sums, or a second sparse table, over its interval.

A node whose interval touches neither end of its block is complete.  The others
are prefixes of the block's first or last class: at most the depth of these two.
They are merged over all blocks by the hash of the prefix, as sums and minima;
so a first turn that a third of all conversations share is one row for each
block.  What such open nodes add to the subtrees of their ancestors is summed up
along the chain of one block each, as all ancestors of an open node are on it.

The digest of the conv_ids that end at a node needs them in order: classes are
range-sorted by conv_id, each task packs its stretch of a class into strings, and
one streaming hash for each class reads these, in bounded memory.

A conversation's turn hashes (24 bytes a turn) are one row, and the node table
has one row for each distinct prefix.

Edge cases: turns with a null number come first; turns of one number are ordered by
role, then by the SHA-256 of the text; a null role or text is empty; repeated rows
are repeated turns; rows without conv_id belong to no conversation and are left
out; a conversation without turns ends at the root; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rowmill.llm.base import small_join, stage

KEY_BYTES = 16
BLOCK_TURNS = 200_000
PACK_CHARS = 1 << 20
SEQUENCE = "array<struct<key:binary,size:int>>"


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and turns, an array of (key, size) in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # the length of the role keeps role and text apart
    whole = F.sha2(F.concat_ws(":", F.length(role).cast("string"), F.concat(role, text)), 256)
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", F.struct(
            F.col("turn"), role.alias("role"), F.sha2(text, 256).alias("order"),
            F.unhex(F.substring(whole, 1, 2 * KEY_BYTES)).alias("key"), F.length(text).alias("size"),
        ).alias("t"),
    )
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t.key.alias("key"), t["size"].alias("size"))).alias("turns")
    )


def rebuilt(logged: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Each conversation with its first h turns exchanged for those of the first
    conversation of its group; h is the crc32 of its conv_id modulo `heads`."""
    base = logged.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    own = logged.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).withColumn("h", h)
    head = F.slice(F.coalesce("head", F.array().cast(SEQUENCE)), F.lit(1), F.col("h"))
    tail = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return own.join(base, "base", "left").select("conv_id", F.concat(head, tail).alias("turns"))


def classes(conversations: DataFrame) -> DataFrame:
    """One row for each distinct sequence: class, keys, sizes, conv_id, n_convs, ends_sha256."""
    keyed = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turns",
        # keys have one width, so their concatenation tells sequences apart
        F.unhex(F.sha2(F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t.key)), "")), 256)).alias("class"),
    )
    keyed = stage(keyed, "sequences")
    one = keyed.groupBy("class").agg(
        F.first("turns").alias("turns"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")
    )
    return stage(one.join(_ends(keyed.select("class", "conv_id")), "class").select(
        F.transform("turns", lambda t: t.key).alias("keys"), F.transform("turns", lambda t: t["size"]).alias("sizes"),
        "conv_id", "n_convs", "ends_sha256",
    ), "classes")


def _stretches(keys: list) -> list[tuple[int, int]]:
    """Runs of equal neighbours as (from, to)."""
    cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
    return list(zip(cuts[:-1], cuts[1:], strict=True)) if keys else []


def _ends(members: DataFrame) -> DataFrame:
    """class and the SHA-256 of its conv_ids, ascending and joined by commas."""

    def pack(batches):
        for b in batches:
            owners, ids = b.column(0).to_pylist(), b.column(1).to_pylist()
            out = []
            for s, e in _stretches(owners):
                for at in range(s, e, PACK_CHARS // 20):
                    some = ids[at : min(e, at + PACK_CHARS // 20)]
                    out.append((owners[s], some[0], ",".join(map(str, some))))
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["class", "first", "ids"])

    def digest(batches):
        now, state = None, None
        for b in batches:
            done = []
            for owner, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if owner == now:
                    state.update(b",")
                else:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = owner, hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield _ends_batch(done)
        if state is not None:
            yield _ends_batch([(now, state.hexdigest())])

    kinds = [pa.binary(), pa.int64(), pa.string()]
    # packed where the sort left them: a class that fills many tasks is few rows from here on
    packed = members.repartitionByRange("class", "conv_id").sortWithinPartitions("class", "conv_id").mapInArrow(
        pack, "class binary, first long, ids string"
    )
    return packed.repartition("class").sortWithinPartitions("class", "first").mapInArrow(
        digest, "class binary, ends_sha256 string"
    )


def _ends_batch(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    owners, digests = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(owners, pa.binary()), pa.array(digests)], ["class", "ends_sha256"])


class SparseTable:
    """Minima of stretches: row k holds the minimum of 2^k neighbours from each place."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << (len(self.rows) - 1) <= len(values):
            last, half = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def least(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Minima over start..end, both included."""
        level = np.frexp((end - start + 1).astype(np.float64))[1] - 1
        out = np.empty(len(start), self.rows[0].dtype)
        for k, row in enumerate(self.rows):
            at = level == k
            out[at] = np.minimum(row[start[at]], row[end[at] - (1 << k) + 1])
        return out

    def extent_right(self, place: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Furthest place with all values after `place`, up to it, at least bound."""
        at = place.copy()
        for k in reversed(range(len(self.rows))):
            row = self.rows[k]
            step = at + 1 <= len(row) - 1
            step[step] = row[at[step] + 1] >= bound[step]
            at[step] += 1 << k
        return at

    def extent_left(self, place: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Furthest place before with all values after it, up to `place`, at least bound."""
        at = place.copy()
        for k in reversed(range(len(self.rows))):
            row = self.rows[k]
            first = at - (1 << k) + 1
            step = first >= 1  # the value at place 0 compares with what is not in the block
            step[step] = row[first[step]] >= bound[step]
            at[step] -= 1 << k
        return at


def _neighbour_lcps(keys: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many first keys each class shares with the one before; 0 for the first."""
    n = len(sizes)
    shared = np.zeros(n, np.int64)
    if n < 2:
        return shared
    common = np.minimum(sizes[1:], sizes[:-1])
    before = np.cumsum(common) - common
    step = np.arange(common.sum()) - np.repeat(before, common)
    differs = keys[np.repeat(starts[1:], common) + step] != keys[np.repeat(starts[:-1], common) + step]
    # the first difference of each pair, or all that there is to compare
    shared[1:] = common
    pair = np.repeat(np.arange(n - 1), common)[differs]
    first, at = np.unique(pair, return_index=True)
    shared[1 + first] = step[differs][at]
    return shared


def _suffix_sums(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each place the sum to the end of its class."""
    total = np.concatenate([[0], np.cumsum(values)])
    return np.repeat(total[starts + sizes], sizes) - total[:-1]


def block_nodes(block: int, keys, sizes, conv_ids, counts, ends) -> dict[str, np.ndarray]:
    """The nodes of a block of sorted classes, those that touch its ends as open
    ones: twice, on the chain of the first class (0) and of the last (1), where the
    second mention of a node adds nothing."""
    n = len(conv_ids)
    lengths = np.fromiter(map(len, keys), np.int64, n)
    flat_keys = np.array([k for ks in keys for k in ks], dtype=object)
    starts = np.cumsum(lengths) - lengths
    lcp = _neighbour_lcps(flat_keys, starts, lengths)
    minima, least_id = SparseTable(lcp), SparseTable(conv_ids)

    # candidates: every depth, the root too, of every class
    depths = lengths + 1
    first = np.cumsum(depths) - depths
    place = np.repeat(np.arange(n), depths)
    depth = np.arange(depths.sum()) - np.repeat(first, depths)
    left, right = minima.extent_left(place, depth), minima.extent_right(place, depth)
    is_node, is_open = left == place, (left == 0) | (right == n - 1)
    node_at = first[left] + depth  # where the candidate's node is listed
    last_size = np.zeros(len(depth), np.int64)
    last_size[depth > 0] = np.fromiter((s for ss in sizes for s in ss), np.int64, lengths.sum())

    members = np.concatenate([[0], np.cumsum(counts)])
    n_convs = members[right + 1] - members[left]
    below = is_node & (depth > 0)
    parent = np.zeros(len(depth), np.int64)
    parent[below] = node_at[np.flatnonzero(below) - 1]
    n_children = np.bincount(parent[below & ~is_open], minlength=len(depth))
    # an inner node's children are all complete; an open one's leaf state is found by merging
    closed = is_node & ~is_open
    leaf = (closed & (n_children == 0)).astype(np.int64)
    saved = np.where(closed, (n_convs - 1) * last_size, 0)

    def subtree(values: np.ndarray) -> np.ndarray:
        """Sum over the nodes below and at each node: what its first class lists
        from the node's depth on, and all that the classes after it list."""
        rows = np.add.reduceat(values, first)
        upto = np.concatenate([[0], np.cumsum(rows)])
        return _suffix_sums(values, first, depths) + upto[right + 1] - upto[left + 1]

    n_leaves, saved_tokens = subtree(leaf), subtree(saved)
    conv_id = least_id.least(left, right)
    end_of = np.full(len(depth), -1)
    end_of[first + lengths] = np.arange(n)  # distinct classes end at nodes of their own

    on_first = np.flatnonzero(place == 0)
    on_last = np.flatnonzero(place == n - 1)
    done = np.flatnonzero(closed)
    listed = np.concatenate([done, on_first, on_last])
    chain = np.concatenate([np.full(len(done), -1), np.zeros(len(on_first)), np.ones(len(on_last))]).astype(np.int64)
    adds = np.ones(len(listed), bool)
    # nodes that hold the whole block are on both chains
    adds[len(done) + len(on_first):] = left[on_last] > 0
    hashes = [None] * len(done) + _prefix_hashes(keys[0]) + _prefix_hashes(keys[-1])
    # the node's own listing holds the sums; the last class may be listed elsewhere
    own = node_at[listed]
    up = np.where(depth[listed] > 0, parent[own], 0)
    up_open = is_open[up] & (chain < 0) & (depth[listed] > 0)
    ends_here = end_of[own]
    return {
        "block": np.full(len(listed), block), "chain": chain, "depth": depth[listed],
        "conv_id": conv_id[own], "n_convs": np.where(adds, n_convs[own], 0),
        "n_children": np.where(adds, n_children[own], 0), "n_leaves": np.where(adds, n_leaves[own], 0),
        "saved_tokens": np.where(adds, saved_tokens[own], 0), "last_size": last_size[own],
        "parent_conv_id": conv_id[up], "parent_chain": np.where(up_open, np.where(left[up] == 0, 0, 1), -1),
        "prefix": hashes, "ends_sha256": [ends[e] if e >= 0 else None for e in ends_here.tolist()],
    }


def _prefix_hashes(keys) -> list[bytes]:
    state = hashlib.sha256()
    found = [state.digest()[:KEY_BYTES]]
    for key in keys:
        state.update(key)
        found.append(state.digest()[:KEY_BYTES])
    return found


NODE = ("block long, chain long, depth long, conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, last_size long, parent_conv_id long, parent_chain long, prefix binary, ends_sha256 string")


def _blocks(sorted_classes: DataFrame, block_turns: int) -> DataFrame:
    names = [part.split()[0] for part in NODE.split(", ")]

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[list] = [[] for _ in range(5)]
        turns = 0
        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            start = 0
            for i, keys in enumerate(columns[0]):
                turns += len(keys) + 1
                if turns >= block_turns:
                    for h, c in zip(held, columns, strict=True):
                        h += c[start : i + 1]
                    yield nodes(number, held)
                    held, turns, start, number = [[] for _ in range(5)], 0, i + 1, number + 1
            for h, c in zip(held, columns, strict=True):
                h += c[start:]
        if held[0]:
            yield nodes(number, held)

    def nodes(number, held):
        keys, sizes, ids, counts, ends = held
        found = block_nodes(number, keys, sizes, np.array(ids, np.int64), np.array(counts, np.int64), ends)
        kinds = {"prefix": pa.binary(), "ends_sha256": pa.string()}
        return pa.RecordBatch.from_arrays([pa.array(found[c], kinds.get(c, pa.int64())) for c in names], names)

    return stage(sorted_classes.mapInArrow(run, NODE), "trie-nodes")


NO_ENDS = hashlib.sha256(b"").hexdigest()
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row for each node; conversations: conv_id and turns as sequences() gives them."""
    found = classes(conversations).repartitionByRange("keys").sortWithinPartitions("keys")
    nodes = _blocks(found.select("keys", "sizes", "conv_id", "n_convs", "ends_sha256"), block_turns)
    mentions = nodes.where("chain >= 0")
    key = ["depth", "prefix"]
    chain = ["block", "chain"]
    # 1. what the blocks know of each open node; its home is one of the chains that mention it
    merged = stage(mentions.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.max("last_size").alias("last_size"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.max("ends_sha256").alias("ends_sha256"),
        F.min(F.struct(*chain)).alias("home"),
    ), "open-nodes")
    # 2. each open node's parent, from the chain of its home; open children are counted there
    along = W.partitionBy(*chain).orderBy("depth")
    above = mentions.select(*chain, *key, F.lag("prefix").over(along).alias("parent"))
    homes = merged.select(*key, "home.block", "home.chain")
    parents = stage(above.join(homes, [*chain, *key], "left_semi").select(*key, "parent"), "open-parents")
    children = parents.where("parent IS NOT NULL").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent").alias("prefix")
    ).agg(F.count("*").alias("open_children"))
    known = stage(
        merged.join(children, key, "left").withColumn(
            "n_children", F.col("n_children") + F.coalesce("open_children", F.lit(0))
        ).drop("open_children"), "open-children",
    )
    # 3. what an open node itself adds goes to all its ancestors along the chain of its home
    own = known.select(
        *key, "home.block", "home.chain", ((F.col("n_convs") - 1) * F.col("last_size")).alias("own_saved"),
        (F.col("n_children") == 0).cast("long").alias("own_leaf"),
    )
    deeper = along.rowsBetween(0, W.unboundedFollowing)
    given = mentions.select(*chain, *key).join(own, [*chain, *key], "left").select(
        *key, F.sum(F.coalesce("own_saved", F.lit(0))).over(deeper).alias("more_saved"),
        F.sum(F.coalesce("own_leaf", F.lit(0))).over(deeper).alias("more_leaves"),
    )
    more = given.groupBy(*key).agg(F.sum("more_saved").alias("more_saved"), F.sum("more_leaves").alias("more_leaves"))
    whole = stage(known.join(more, key).select(
        *key, "conv_id", "n_convs", "n_children", (F.col("n_leaves") + F.col("more_leaves")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("more_saved")).alias("saved_tokens"), "ends_sha256",
    ), "open-whole")
    # 4. the parents' conv_ids: open nodes by prefix, complete ones by the chain of their block
    ids = whole.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"),
                       F.col("conv_id").alias("parent_conv_id"))
    open_rows = whole.join(parents, key).join(ids, ["depth", "parent"], "left")
    chain_ids = stage(mentions.select(*chain, *key).join(whole.select(*key, "conv_id"), key).select(
        "block", F.col("chain").alias("parent_chain"), (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("open_parent"),
    ), "open-chains")
    complete = small_join(
        nodes.where("chain < 0"), chain_ids, ["block", "parent_chain", "depth"], "left"
    ).withColumn("parent_conv_id", F.coalesce("open_parent", "parent_conv_id"))
    return open_rows.select(*RESULT).unionByName(complete.select(*RESULT)).withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))
    )


__all__ = ["sequences", "rebuilt", "classes", "trie", "SparseTable", "block_nodes"]
