"""The trie against a dictionary of all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from rowmill.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def logged(rows):
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            text = text or ""
            order = hashlib.sha256(text.encode()).hexdigest()
            found[c].append((turn is not None, turn or 0, role or "", order, text))
    return {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in found.items()}


def rebuilt(found):
    out = {}
    for c, ts in found.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = found.get(c - c % 100, [])[:h] + ts[h:]
    return out


def brute(found):
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in found.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, ids in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(ids) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            min(ids), len(node), min(members[node[:-1]]) if node else -1, len(ids), children[node], leaves[node],
            saved[node], hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, ids in members.items()
    )


def result(df):
    assert df.columns == prefix_trie.RESULT
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def made_up(seed):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(5000), 250):
        shared = [("user", "hot")] * (rng.random() < 0.5)
        turns = shared + [(rng.choice(["user", "bot"]), rng.choice(["a", "bb", "é日"])) for _ in range(rng.randrange(7))]
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    rows += [(c, i, "user", "same") for c in range(6000, 6120) for i in range(3)]  # copies
    rows += [(7000, i, "user", "long") for i in range(500)]
    rows += [(7001, i, "user", "long") for i in range(400)]
    rows += [(None, 0, "user", "x"), (7002, None, None, None), (7002, 0, "user", None), (7002, 0, None, "t")]
    rows += [(7003, 1, "user", "x"), (7003, 1, "user", "x"), (7003, 1, "bot", "x"), (7003, 1, "bot", "y")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block_turns", [1, 40, 200_000])
def test_against_prefixes(spark, block_turns):
    """Blocks of one class, of a few, and one block give the same nodes."""
    rows = made_up(block_turns)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumnRenamed("turn", "TURN")
    sequences = prefix_trie.sequences(df)
    assert result(prefix_trie.trie(sequences, block_turns)) == brute(logged(rows))


def test_rebuilt(spark):
    rng = random.Random(9)
    rows = [(c, i, "user", rng.choice("ab")) for c in [*range(700), *range(-250, 0)] if c not in (300, 500)
            for i in range(rng.randrange(1, 9))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = prefix_trie.rebuilt(prefix_trie.sequences(df))
    expected = logged(rows)
    plain = {}
    for c, ts in expected.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        plain[c] = expected.get(base, [])[:h] + ts[h:]
    assert any(not ts for ts in plain.values())
    assert result(prefix_trie.trie(got, 60)) == brute(plain)
    positive = {c: ts for c, ts in expected.items() if c >= 0}
    assert {c: plain[c] for c in positive} == rebuilt(positive)


def test_empty(spark):
    assert prefix_trie.trie(prefix_trie.sequences(spark.createDataFrame([], SCHEMA))).collect() == []


def test_sparse_table():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 5, 57)
    table = prefix_trie.SparseTable(values)
    start = rng.integers(0, 57, 300)
    end = np.minimum(56, start + rng.integers(0, 57, 300))
    assert (table.least(start, end) == [values[s : e + 1].min() for s, e in zip(start, end)]).all()
    bound = rng.integers(0, 6, 300)
    for at, low, left, right in zip(start, bound, table.extent_left(start, bound), table.extent_right(start, bound)):
        l = r = at
        while l > 0 and values[l] >= low:
            l -= 1
        while r < 56 and values[r + 1] >= low:
            r += 1
        assert (l, r) == (left, right)


def test_ids_of_a_class_in_many_stretches(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PACK_CHARS", 60)
    rows = [(c, 0, "user", "same" if c % 3 else "other") for c in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert result(prefix_trie.trie(prefix_trie.sequences(df))) == brute(logged(rows))
