"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing
extra columns: every operator and stage against the plain versions."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rowmill.llm import (
    base, chat, components, decontaminate, embedding_dedup, language, mixing, quality, simhash,
    substring_dedup, token_files, toxicity,
)
from tests.llm import brute

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "word string, part int, print long, copies int, spans string, number int, _seed string"
)
EXTRA = ("w", 1, 2, 3, "s", 4, "x")


def documents(spark, rows):
    """(doc_id, text[, lang, source]) rows with columns whose names the operators use too."""
    full = [(*r, *(None,) * (4 - len(r)), None if r[1] is None else len(r[1]), *EXTRA) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def prose(seed, n, vocabulary=4000):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


PASSAGE = prose(1, 70)
LONG = prose(2, 30_000)
ROWS = [
    (1, None, "en", "a"), (2, "", "en", "b"), (3, " \t\n ", None, None), (4, "One", "en", "a"),
    (5, "one two", "en", ""), (6, prose(3, 60) + " " + PASSAGE, "en", "a"),
    (7, PASSAGE + " " + prose(4, 55), "de", "é"), (8, PASSAGE, "de", "z"),
    (9, LONG + " " + PASSAGE, "en", None), (10, LONG, "en", "a"), (11, prose(3, 60), "en", "a"),
    (12, "É é ÀB <|endoftext|> KK it's ..., İx 12,5", "fr", "b"), (13, prose(5, 49), "en", "a"),
    (14, PASSAGE + " " + PASSAGE, "en", "b"), (15, "a " * 200, "en", "b"), (16, "A " * 200, "en", "a"),
    (-5, prose(4, 55) + "\x0b" + PASSAGE.upper(), "de", "\U0001f600"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, ROWS)


@pytest.fixture(params=["broadcast", "shuffle"])
def joins(request, monkeypatch):
    if request.param == "shuffle":
        monkeypatch.setattr(base, "BROADCAST_BYTES", -1)


def empty(df):
    return df.where("false")


def by_id(df, *columns):
    return {r[0]: tuple(r)[1:] for r in df.select(*columns).collect()}


def test_one_of_each_of_rows_with_one_id_or_none(spark):
    """Equal texts leave one row, whatever their ids and other columns."""
    rows = [(None, PASSAGE, lang) for lang in ("en", "de")] + [(None, PASSAGE, "en")] * 5
    rows += [(5, LONG, "en")] * 5 + [(5, prose(77, 80), "en"), (None, "", "fr"), (None, None, "de"), (9, LONG, "en")]
    rows += [(8, prose(78, 90), "en"), (None, prose(78, 90), "en"), (7, prose(78, 90), "de")]
    table = documents(spark, rows)
    got = sorted((r.doc_id or 0, len(r.text or "")) for r in simhash.one_of_each(table).collect())
    assert got == sorted([(0, len(PASSAGE)), (5, len(LONG)), (5, len(prose(77, 80))), (0, 0), (7, len(prose(78, 90)))])
    assert simhash.one_of_each(table).columns == table.columns


def test_simhash(docs):
    got = by_id(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id")
    assert got == brute.simhash([r[:2] for r in ROWS])
    assert simhash.near_duplicates(empty(docs)).count() == 0
    twice = simhash.near_duplicates(docs.union(docs)).groupBy("doc_id").count()
    assert {r["count"] for r in twice.collect()} == {2}


def test_simhash_finds_every_pair_of_flips(spark):
    """All links of a clump of fingerprints and of chains, by brute force."""
    draw = random.Random(9)
    center = draw.getrandbits(64)
    prints = {center ^ sum(1 << b for b in draw.sample(range(64), k)) for k in range(5) for _ in range(60)}
    prints |= {draw.getrandbits(64) for _ in range(100)}
    chain = draw.getrandbits(64)
    for k in range(0, 60, 3):
        chain ^= 7 << k
        prints.add(chain)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "print long")
    links = simhash.print_links(simhash.variants(table))
    got = {r.node: r.root for r in components.connected(links, "a", "b").collect()}
    near = [
        (a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3
    ]
    expected = brute.groups(signed, near)
    assert {n: got.get(n, n) for n in signed} == expected


def test_long_runs_are_tiled(monkeypatch):
    import numpy as np

    monkeypatch.setattr(simhash, "TILE", 4)
    prints = np.array([0, 1, 3, 7, 1 << 40, (1 << 40) + 1, 1 << 50, 15, 31], np.uint64)
    variant = np.array([5] * len(prints))
    links = [(int(x), int(y)) for a, b in simhash._sorted_links(variant, prints) for x, y in zip(a, b)]
    nodes = [int(p) for p in prints]
    near = [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 3]
    assert brute.groups(nodes, links) == brute.groups(nodes, near)


def test_components(spark):
    draw = random.Random(3)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)]
    links += [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2001 + i) for i in range(90)] + [(5, 5)]
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()}
    nodes = {n for link in links for n in link}
    expected = brute.groups(nodes, links)
    assert {n: got.get(n, n) for n in nodes} == expected
    none = components.connected(spark.createDataFrame([], "x long, y long"), "x", "y")
    assert none.count() == 0


def test_substrings(docs, joins):
    got = by_id(substring_dedup.digest(substring_dedup.deduplicate(docs)), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute.substrings([r[:2] for r in ROWS])


def test_substrings_of_random_overlaps(spark):
    """Passages from few words, cut and joined at random: many partial factors."""
    draw = random.Random(7)
    pieces = [prose(100 + k, draw.randrange(5, 90), 60) for k in range(12)]
    rows = [(i, " ".join(draw.choice(pieces) for _ in range(draw.randrange(1, 7)))) for i in range(60)]
    got = by_id(substring_dedup.digest(substring_dedup.deduplicate(documents(spark, rows))), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute.substrings(rows)


def test_substrings_without_id_or_rows(spark, docs):
    assert substring_dedup.deduplicate(empty(docs)).count() == 0
    rows = documents(spark, [(None, PASSAGE), (3, PASSAGE), (3, PASSAGE), (4, PASSAGE)])
    got = sorted((r.doc_id or 0, r.n_removed) for r in substring_dedup.deduplicate(rows).collect())
    assert got == [(0, 0), (3, 0), (3, 0), (4, 70)]


def test_tokens(docs):
    path = token_files.default_tokenizer()
    got = [tuple(r) for r in token_files.round_trip(docs, path).orderBy("doc_id").collect()]
    assert got == brute.tokens([r[:2] for r in ROWS], path)
    assert token_files.round_trip(empty(docs), path).count() == 0


def test_tokens_of_repeated_and_null_ids(spark):
    path = token_files.default_tokenizer()
    rows = documents(spark, [(None, "b"), (2, "x y"), (2, "x y"), (2, "z"), (1, None), (None, "a")])
    got = token_files.round_trip(rows, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 1, 2, 2, 2]
    assert [r.start for r in got] == [0, 2, 4, *[5 + s for s in sorted_starts(got[3:])]]


def sorted_starts(rows):
    at, out = 0, []
    for r in rows:
        out.append(at)
        at += r.n_tokens
    return out


def test_word_encoder_is_the_library():
    import numpy as np

    encoder = token_files.WordEncoder(token_files.default_tokenizer())
    draw = random.Random(4)
    signs = "aAbeÉéßİıſKḰ̀ .,'!?<|>_-09  　\t\n\x1c中مİ\U0001f600"
    for _ in range(3000):
        text = "".join(draw.choice(signs) for _ in range(draw.randrange(0, 40)))
        text += draw.choice(["", " <|endoftext|>", "<|ENDOFTEXT|>.", " don't, I'LL. x's,"])
        expected = [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 1]
        ids, sizes = encoder.encode([text.encode(), b""])
        assert np.array_equal(ids, [*expected, 1]) and sizes.tolist() == [len(expected), 1], repr(text)


ITEMS = [
    (1, prose(3, 60)), (2, PASSAGE), (3, PASSAGE), (3, PASSAGE), (4, "ONE Two"), (5, None), (6, "..."),
    (None, LONG), (7, prose(4, 55)[100:]), (8, "a a a a a a a a a a a a a a a"), (9, "É é"), (10, "one"),
]


def test_contamination(spark, docs, joins):
    items = spark.createDataFrame([(*i, "x", 1) for i in ITEMS], "item_id long, text string, word string, place int")
    found = decontaminate.digest(decontaminate.contamination(docs, items))
    got = by_id(found, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == brute.contamination([r[:2] for r in ROWS], ITEMS)


def test_contamination_of_empty_tables(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination(empty(docs), items).count() == 0
    none = decontaminate.contamination(docs, empty(items)).collect()
    assert len(none) == len(ROWS) and not any(r.contaminated or r.n_items for r in none)
    twice = decontaminate.contamination(docs.union(docs), items)
    assert twice.count() == 2 * len(ROWS)


def test_contamination_of_rows_with_one_id_or_none(spark, con):
    """Every row is judged by its own text, as the SQL over rows does with ids of their own."""
    rows = [(None, PASSAGE), (None, "clean words"), (None, None), (5, PASSAGE), (5, "clean words"), (5, "clean words"),
            (6, PASSAGE)] + [(7, PASSAGE)] * 5000
    docs = documents(spark, rows)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.digest(decontaminate.contamination(docs, items)).collect()
    own = brute.contamination(list(enumerate(t for _, t in rows)), ITEMS)
    expected = sorted(((i, *own[k]) for k, (i, _) in enumerate(rows)), key=repr)
    assert sorted(map(tuple, got), key=repr) == expected
    kept = [(r.doc_id, r.text) for r in decontaminate.clean(docs, items).collect()]
    assert sorted(kept, key=repr) == [(5, "clean words"), (5, "clean words"), (None, "clean words"), (None, None)]


def test_random_contamination(spark):
    draw = random.Random(11)
    items = [(k, prose(300 + k, draw.randrange(1, 30), 12)) for k in range(25)]
    rows = [(k, " ".join(draw.choice([prose(500 + k, 9, 12), draw.choice(items)[1]]) for _ in range(4))) for k in range(40)]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.digest(decontaminate.contamination(documents(spark, rows), table))
    got = by_id(found, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == brute.contamination(rows, items)


def check_mix(df, rows):
    got = df.collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(brute.WORD.findall(text or ""))
    expected, taken, largest = brute.targets(sizes), dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
        assert r.taken == r.copies * r["size"] <= 3 * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= largest[s]
    return got


def test_mixing(docs):
    first = check_mix(mixing.copies(docs), ROWS)
    again = mixing.copies(docs.repartition(7))
    assert sorted((r.doc_id, r.taken) for r in first) == sorted((r.doc_id, r.taken) for r in again.collect())
    assert mixing.copies(empty(docs)).count() == 0


@pytest.mark.parametrize("direct", [1 << 11, 0])
def test_mixing_of_many(spark, direct, monkeypatch):
    """With and without the tree; one source has a third of the rows."""
    monkeypatch.setattr(mixing, "DIRECT", direct)
    draw = random.Random(6)
    rows = [
        (i, prose(i, draw.choice([0, 1, 5, 20, 21, 22, 80])), "en", draw.choice(["a", "a", "b", "c", "d", None]))
        for i in range(1500)
    ]
    got = check_mix(mixing.copies(documents(spark, rows)), rows)
    # far nearer than one document
    by: dict = {}
    for r in got:
        by.setdefault(r.source, [r.target, 0])[1] += r.taken
    assert all(abs(taken - target) <= 25 for target, taken in by.values())


def test_mixing_is_unbiased(spark):
    """Mean copies over many seeds are the rate."""
    total = 0
    for k in range(6):
        rows = [(1000 * k + i, prose(i, 1 + i % 9), "en", "ab"[i % 3 == 0]) for i in range(90)]
        got = mixing.copies(documents(spark, rows)).where("source = 'a'").collect()
        rate = got[0].target / got[0].source_size
        total += sum(r.copies for r in got) / len(got) - rate
    assert abs(total / 6) < 0.05


def test_mixed_rows(spark):
    rows = [(1, "a b c", "en", "x"), (1, "a b c", "en", "x"), (None, "d e", "en", "y"), (2, None, "en", "z"), (3, "q", "en", "x")]
    table = documents(spark, rows)
    got = mixing.mixed(table)
    assert got.columns == table.columns
    expected = {}
    for r in mixing.copies(table).collect():
        expected[r.doc_id] = expected.get(r.doc_id, 0) + r.copies
    assert {k: v for k, v in expected.items() if v} == {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()}


def test_mixed_rows_that_differ_in_another_column(spark):
    """Rows alike in doc_id, source and text take their copies each for itself."""
    rows = [(1, "a b c", lang, "x") for lang in ("en", "de", "fr", "es", None) for _ in range(3)]
    rows += [(i, "w " * 40, "en", "y") for i in range(2, 8)]
    table = documents(spark, rows)
    copies = mixing.copies(table).where("source = 'x'").collect()
    each = {r.copies for r in copies}
    got = [r.lang for r in mixing.mixed(table).collect() if r.source == "x"]
    assert len(got) == sum(r.copies for r in copies) > 0
    for lang in ("en", "de", "fr", "es", None):
        assert 3 * min(each) <= got.count(lang) <= 3 * max(each)
    assert min(each) >= 1 and max(each) <= min(each) + 1


def test_mixing_of_a_source_by_itself(spark):
    """What a source takes does not follow from the number of another's documents."""
    def taken(n):
        rows = [(i, prose(i, 20), "en", "a") for i in range(300)]
        words = 300 * 20
        rows += [(1000 + i, " ".join(["w"] * (words // n)), "en", "b") for i in range(n)]
        found = mixing.copies(documents(spark, rows)).where("source = 'a'").collect()
        return {r.doc_id: r.copies for r in found}

    assert taken(10) == taken(600)


VECTORS = [
    (1, [1.0, 0.0, 0.0, 0.0]), (2, [9.0, 3.0, 3.0, 1.0]), (3, [2.0, 0.0, 0.0, 0.0]), (4, None), (5, []),
    (6, [0.0, 0.0, 0.0, 0.0]), (7, [1.0, None, 0.0, 0.0]), (8, [float("nan"), 1.0, 0.0, 0.0]),
    (9, [float("inf"), 1.0, 0.0, 0.0]), (10, [1.0, 0.0]), (11, [1.0, 0.0]), (12, [-1.0, 0.0, 0.0, 0.0]),
    (13, [1.0, 0.0, 0.0, 0.0]), (14, [0.0, 0.0, 0.0, 0.0]), (15, [0.0, -2.0, 0.0, -0.0]),
]


def vectors(spark, rows):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, node string, cell int")
    return table.repartition(3)


def found_vectors(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def test_vectors(spark, joins):
    got = embedding_dedup.near_duplicates(vectors(spark, VECTORS))
    assert found_vectors(got) == brute.vectors(VECTORS)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.collect())
    assert embedding_dedup.near_duplicates(empty(vectors(spark, VECTORS))).count() == 0


@pytest.mark.parametrize("cell_rows", [4096, 16])
def test_many_vectors(spark, cell_rows, monkeypatch):
    """Near copies of a hot vector, chains and copies, over one and over many cells."""
    import numpy as np

    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", cell_rows)
    draw = np.random.default_rng(2)
    base_rows = draw.normal(size=(60, 64))
    hot = base_rows[0] + draw.normal(size=(80, 64)) * 0.2
    chain = np.cumsum(np.concatenate([base_rows[1:2], draw.normal(size=(40, 64)) * 0.3]), axis=0)
    rows = np.concatenate([base_rows, hot, chain, base_rows[3:6], 2 * base_rows[3:6]]).astype(np.float32)
    listed = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    assert found_vectors(embedding_dedup.near_duplicates(vectors(spark, listed))) == brute.vectors(listed)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_visits_of_many_vectors_are_shuffled_in_rounds(spark, kind, monkeypatch):
    """No shuffle takes more than its bytes, whatever the number of visits."""
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", 16)
    monkeypatch.setattr(embedding_dedup, "ROUND_BYTES", 250_000, raising=False)
    draw, met, shuffled = np.random.default_rng(3), embedding_dedup._met, []

    def seen(rows, *others):
        shuffled.append(rows.count())
        return met(rows, *others)

    monkeypatch.setattr(embedding_dedup, "_met", seen)
    hot = draw.normal(size=32) + draw.normal(size=(100, 32)) * 0.2
    rows = np.concatenate([draw.normal(size=(60, 32)), hot, hot[:9]]).astype(np.float32)
    listed = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    listed += [(500 + i, v) for i, (_, v) in enumerate(VECTORS)]
    given = vectors(spark, listed).withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
    assert found_vectors(embedding_dedup.near_duplicates(given)) == brute.vectors(listed)
    # a row has the vector, its turned coordinates and some numbers
    assert len(shuffled) > 2 and max(shuffled) < 250_000 / (32 * (8 if kind == "float" else 12)) < sum(shuffled) / 2


CHATS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 0, "user", "hi"),
    (4, 5, "user", "hi"), (4, 9, "assistant", "yes"), (5, 0, "user", "hi"), (5, 1, "assistant", "no"),
    (5, 2, None, None), (6, None, "user", ""), (None, 0, "user", "x"), (7, 0, "user", "b"), (7, 0, "user", "a"),
    (8, 0, "user", "a"), (8, 1, "user", "b"), (9, 0, None, ""), (10, 0, "user", "h"), (11, 0, "user", "i" * 50_000),
]


def test_chat(spark):
    table = spark.createDataFrame([(*r, 1, "x") for r in CHATS], "conv_id long, turn long, role string, text string, position int, last string")
    got = by_id(chat.render(table.repartition(3)), "conv_id", "n_turns", "n_logged", "text")
    assert got == brute.conversations(CHATS)
    assert chat.render(empty(table)).count() == 0


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers(spark, docs, module, label):
    known = labels(spark, [(i, i % 2, (i + 1) % 2) for i in range(1, 16)] + [(3, None, None), (None, 1, 1), (4, 0, 1), (4, 1, 1)])
    got = module.classify(docs, known).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in ROWS)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    same = {r.score for r in got if r.doc_id in (1, 2, 3)}
    assert len(same) == 1
    for table in (empty(known), labels(spark, [(7, 1, 1), (9, 1, 1)])):
        flat = {round(r.score, 6) for r in module.classify(docs, table).collect()}
        assert flat <= {0.5} if table.count() == 0 else all(s > 0.99 for s in flat)
    assert module.classify(empty(docs), known).count() == 0
    again = module.classify(documents(spark, [(None, "x"), (1, "y"), (1, "y")]), known).collect()
    assert len(again) == 3 and not any(r.held_out for r in again if r.doc_id is None)


def test_toxicity_counts_and_ratios(spark):
    """Counts, evidence and ratios of n-grams against plain counting."""
    from collections import Counter

    draw = random.Random(8)
    rows = [(f"{'bad word' if k % 4 == 0 else 'fine text'} {draw.choice('abcdef') * 3} é{k % 7}", int(k % 4 == 0), k / 40)
            for k in range(40)]
    counted = toxicity._counts(spark.createDataFrame(rows, "text string, label int, share double")).collect()
    plain = Counter()
    for text, label, share in rows:
        line = f" {' '.join(text.lower().split())} "
        grams = {line[i : i + n] for n in toxicity.SIZES for i in range(len(line) - n + 1)}
        for bucket in {_bucket(g) for g in grams}:
            plain[bucket, ("toxic" if label else "other") + str(int(share >= 0.5))] += 1
    got = {(r.bucket, c): r[c] for r in counted for c in toxicity.CELLS if r[c]}
    assert got == plain
    toxic, other = np.array([10.0, 3, 0, 1]), np.array([0.0, 9, 30, 3])
    ratio = toxicity._ratio(toxic, other, 10, 30)
    assert ratio[0] > 0 > ratio[2] and abs(ratio[1]) < 0.2 and abs(ratio[3]) < 1e-12
    evidence = toxicity._statistic(toxic, other, 10, 30, np.log, toxicity._array_positive)
    for a, b, e in zip(toxic, other, evidence):
        table, n = [(a, 10, a + b), (b, 30, a + b), (10 - a, 10, 40 - a - b), (30 - b, 30, 40 - a - b)], 40
        assert e == pytest.approx(sum(2 * x * math.log(x * n / (r * c)) for x, r, c in table if x))


def _bucket(gram):
    """The hash of one n-gram by whole numbers."""
    h = 0
    for c in gram:
        h = (h * int(toxicity.BASE) + ord(c)) % 2**64
    return (h + len(gram)) * int(toxicity.MIX) % 2**64 >> 44


def test_line_through_log_odds():
    """Log-odds that are twice too sure and off by one are brought back."""
    draw = np.random.default_rng(5)
    true = draw.normal(size=20_000) * 2
    y = (draw.random(20_000) < 1 / (1 + np.exp(-true))).astype(float)
    a, b = toxicity._line(2 * true + 1, y)
    assert a == pytest.approx(0.5, abs=0.03) and b == pytest.approx(-0.5, abs=0.06)
    assert toxicity._line(np.zeros(4), np.array([0.0, 0, 1, 0]))[0] > 0


def test_toxicity_of_a_long_text(monkeypatch):
    """Parts of a text overlap by what the longest n-gram needs."""
    text = prose(9, 300) + " é" * 50
    whole = set(np.concatenate(list(toxicity._hashes(text))).tolist())
    monkeypatch.setattr(toxicity, "CHUNK", 64)
    assert set(np.concatenate(list(toxicity._hashes(text))).tolist()) == whole


def test_language(spark, docs):
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert sorted(got) == sorted(r[0] for r in ROWS)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3))
    assert {r.lang_pred for r in got.values()} <= {"en", "de", "fr", "und"}
    unlearnt = language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert all(r.lang_pred == "und" for r in unlearnt)
    assert language.identify(empty(docs)).count() == 0
    kept = language.recognised(docs)
    assert kept.columns == docs.columns and not {1, 2, 3} & {r.doc_id for r in kept.collect()}


SYLLABLES = {
    "en": "th ing er on re nd in ha the wh".split(), "es": "ción que los ñ de rr as el ado en".split(),
    "de": "sch ung ich ü en ver ge ß keit ein".split(),
    "fi": "kk aa ssa yö än lla isu tta jo hy".split(), "pl": "szcz ów się ż ego prz yk cie ł wa".split(),
}


def speech(lang, seed, n):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randrange(1, 4))) for _ in range(n))


def spoken(spark):
    """Documents in three learnt languages, and of two others without a label."""
    rows = [(i, speech(k, i, 3 + i % 60), k) for j, k in enumerate(("en", "es", "de")) for i in range(j, 3000, 3)]
    rows += [(10_000 + i, speech(k, i, 20 + i % 60), None) for j, k in enumerate(("fi", "pl")) for i in range(j, 200, 2)]
    return rows, documents(spark, [(*r, "s") for r in rows])


def test_language_against_exact_sets(spark):
    """Filters give what sets of all learnt trigrams give, but for false positives."""
    rows, table = spoken(spark)
    sets = {}
    for i, text, lang in rows:
        if lang and zlib.crc32(str(i).encode()) % 5:
            sets.setdefault(lang, set()).update(language.grams(text).tolist())
    got = {r.doc_id: r for r in language.identify(table).collect()}
    assert len(got) == len(rows)
    for i, text, lang in rows:
        found = language.grams(text).tolist()
        shares = {k: sum(g in s for g in found) / len(found) for k, s in sets.items()}
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert abs(r.score - max(shares.values())) < 0.1 and shares[r.lang_pred] >= max(shares.values()) - 0.1
        assert lang is None or r.lang_pred == lang or len(found) < 12


def test_unlearnt_languages_are_rejected(spark):
    rows, table = spoken(spark)
    kept = {r.doc_id for r in language.recognised(table).collect()}
    known = [i for i, _, lang in rows if lang]
    assert sum(i in kept for i in known) >= 0.995 * len(known)  # the shortest have three words
    assert sum(i not in kept for i, _, lang in rows if lang is None) >= 0.9 * 200


def test_letters(spark):
    """Numerals that are no decimal digits are no letters."""
    for text in ("²", "½ ³", "Ⅷ", "12 ٣", "_", ""):
        assert not len(language.grams(text)), text
    assert language.grams("a½b").tolist() == language.grams("a b").tolist()
    table = documents(spark, [(i, speech("en", i, 30), "en", "s") for i in range(50)] + [(99, "½ ³", "en", "s")])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(table).collect()}
    assert got.pop(99) == ("und", 0.0) and {p for p, _ in got.values()} == {"en"}


def test_levels():
    many = [("en", 8, 950, 1), ("en", 8, 980, 999), ("en", 8, 990, 1000), ("en", 4, 700, 5), ("de", 8, 0, 1), ("de", 8, 999, 300)]
    got = language.levels(many)
    assert got["en", 8] == pytest.approx(0.98 - language.SLACK)  # one of two thousand is under it
    assert got["en", 4] == 0 and got["en", 12] == got["en", 8] and got["de", 8] == 0


def test_many_languages(spark):
    """More languages than one mask slice holds."""
    names = [f"l{i:03d}" for i in range(150)]
    rows = [(k * 1000 + i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}q" * 3, n, "s") for k in range(5) for i, n in enumerate(names)]
    got = {r.doc_id: r.lang_pred for r in language.identify(documents(spark, rows)).collect()}
    assert sum(got[r[0]] == r[2] for r in rows) > 0.95 * len(rows)


def test_stages_keep_columns(spark, docs):
    """Each stage over rows with gaps, copies and clashing columns."""
    folder = "/root/testdata/sf0.001"
    messy = docs.unionByName(documents(spark, [(None, "alpha beta gamma", "en", "a"), (6, ROWS[5][1], "en", "a")]))
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, messy, folder)
        assert out.columns == docs.columns, name
        assert out.count() > 0, name
        assert function(spark, empty(messy), folder).count() == 0, name
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, messy, folder).count() == messy.count()
    assert last(spark, empty(messy), folder).count() == 0


@pytest.mark.parametrize("short,long", [(2_000, 100_000), (20_000, 1_000_000)])
def test_mixing_of_one_very_long_document(spark, short, long):
    """Short documents make up for a long one, on both sides of 2,048."""
    for shift in (0, 10**6):  # the long one is drawn anew
        words = F.expr(f"CASE WHEN id = {shift} THEN {long} WHEN id = {shift + 1} THEN {75 * short + long} "
                       "ELSE 60 + pmod(hash(id), 81) END")
        source = F.when(F.col("id") == shift + 1, "a").otherwise("b")
        rows = spark.range(shift, shift + short + 2).withColumn("words", words).select(
            F.col("id").alias("doc_id"), F.expr("repeat('w ', int(words))").alias("text"), source.alias("source")
        )
        got = mixing.copies(rows).where("source = 'b'").agg(
            F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("source_size").alias("words")
        ).first()
        assert 0.2 < got.target / got.words < 0.8
        assert abs(got.taken - got.target) <= 140


def test_mixing_of_rows_alike(spark, monkeypatch):
    """Rows alike are one item with a count, whatever their number; no group holds them one by one."""
    real, held = mixing._groups, []

    def spied(*given):
        out = real(*given)
        held.append(out.agg(F.max(F.size("items"))).first()[0] or 0)
        return out

    monkeypatch.setattr(mixing, "_groups", spied)
    rows = [(None, "a b c", "en", "x")] * 9_000 + [(7, "d e", "en", "x")] * 4 + [(i, prose(i, 9), "en", "y") for i in range(100, 400)]
    table = documents(spark, rows)
    got = check_mix(mixing.copies(table), rows)
    assert max(held) <= 768
    for i in (None, 7):
        alike = [r.copies for r in got if r.doc_id == i]
        assert max(alike) - min(alike) <= 1 and abs(sum(alike) - len(alike) * got_rate(got, "x")) < 1
    assert mixing.mixed(table).where("doc_id IS NULL").count() == sum(r.copies for r in got if r.doc_id is None)


def got_rate(rows, source):
    return next(r.target / r.source_size for r in rows if r.source == source)
