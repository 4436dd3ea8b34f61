"""The registered queries over the given tables: against SQL, plain versions, and
held-out labels."""

from __future__ import annotations

import pytest

import corpus_pipeline
from rowmill.llm import decontaminate, language, mixing, token_files
from rowmill.llm.queries import QUERIES, SQL
from tests.compare import compare
from tests.llm import brute


def rows(spark, folder, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/{name}.parquet").select(*columns).collect()]


@pytest.fixture(scope="module")
def texts(spark, folder):
    return rows(spark, folder, "documents", "doc_id", "text")


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, folder, name):
    result, n = compare(spark, con, folder, QUERIES[name], SQL[name])
    assert result == "ok" and n > 0


def test_simhash(spark, folder, texts):
    got = QUERIES["op10_simhash"](spark, folder).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == brute.simhash(texts)


def test_token_files(spark, folder, texts):
    got = QUERIES["op7_token_files"](spark, folder).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == brute.tokens(texts, token_files.default_tokenizer())


def test_mixing(spark):
    folder = "/root/testdata/sf0.01"  # some fifty documents a source
    given = rows(spark, folder, "documents", "doc_id", "text", "lang", "source")
    sizes: dict = {}
    for _, text, _, source in given:
        sizes[source] = sizes.get(source, 0) + len(brute.WORD.findall(text))
    expected, taken = brute.targets(sizes), dict.fromkeys(sizes, 0)
    got = QUERIES["op3_mixing"](spark, folder).collect()
    for r in got:
        assert r.target == pytest.approx(expected[r.source]) and r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    assert len(got) == len(given)
    assert sum(abs(taken[s] - expected[s]) for s in sizes) < 0.01 * sum(sizes.values())


@pytest.mark.parametrize("name,label,least", [("op5_quality", "quality", 0.93), ("op8_toxicity", "toxic", 0.9)])
def test_classifiers_on_held_out_rows(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    truth = dict(rows(spark, folder, "labels", "doc_id", label))
    got = [r for r in QUERIES[name](spark, folder).collect() if r.held_out and r.doc_id in truth]
    assert len(got) > 50
    assert sum(r.predicted == truth[r.doc_id] for r in got) >= least * len(got)


def test_language_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    truth = dict(rows(spark, folder, "documents", "doc_id", "lang"))
    got = [r for r in QUERIES["op9_language"](spark, folder).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) >= 0.98 * len(got)


def test_pipeline(spark, folder):
    """Each stage on its own input, against the plain version of its operator."""
    docs, items = spark.read.parquet(f"{folder}/documents.parquet"), rows(spark, folder, "benchmark", "item_id", "text")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_duplicates", "decontamination", "mixing", "token_files"]

    def ids(df):
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    def pairs(df):
        return [tuple(r) for r in df.select("doc_id", "text").collect()]

    known = stages["language"](spark, docs, folder)
    filters, least = language.learn_levels(docs)
    predicted = {i: (*filters.predict(t), language.band(len(language.grams(t)))) for i, t in pairs(docs)}
    assert ids(known) == sorted(
        i for i, (lang, score, _, at) in predicted.items() if lang != "und" and score >= least.get((lang, at), 0)
    )
    single = stages["near_duplicates"](spark, known, folder)
    least = brute.simhash(pairs(known))
    assert ids(single) == sorted(i for i, (_, c) in least.items() if i == c)
    clean = stages["decontamination"](spark, single, folder)
    flags = brute.contamination(pairs(single), items)
    assert ids(clean) == sorted(i for i, f in flags.items() if not f[4])
    mix = stages["mixing"](spark, clean, folder)
    copies = {r.doc_id: r.copies for r in mixing.copies(clean).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in mix.groupBy("doc_id").count().collect()} == copies
    last = stages["token_files"](spark, mix, folder).orderBy("start").collect()
    assert [tuple(r) for r in last] == brute.tokens(pairs(mix), token_files.default_tokenizer())
    run = corpus_pipeline.run(spark, folder).orderBy("start").collect()
    assert run == last


def test_native_plans(spark, folder):
    """No Python and no row-by-row join in the operators that are to be native."""
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    for df in (decontaminate.contamination(docs, items), mixing.copies(docs)):
        plan = df._jdf.queryExecution().toString()
        for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan
