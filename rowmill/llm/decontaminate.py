"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of WINDOW words; a shorter item is one window.  A
window occurs in a document if its words stand there in a row.  As sets, that
is full containment of the window's one-word shingles, each with its place.

The join:
- all document words that items hold are counted; that orders the shingles of a
  window by rarity.  For full containment the necessary prefix is the rarest
  shingle alone, so only it is joined: few of a document's words take part;
- neighbouring windows mostly share their rarest word, so what is joined is the
  word and its place in the item.  A match fixes the alignment of the two texts;
- length bound: the document has a window's words at least; positional bound: a
  window that holds the word at this place fits between its start and end;
- each alignment left is verified word by word over the item's windows that hold
  the place, so a long item costs a match no more than a short one.

Only DataFrame operations are used.  Item tables are broadcast if their measured
size is under a limit, else joined by shuffle on the word, with both sides plain
so that Spark splits hot words.  Items of equal words are one item until the
end, so copies in the benchmark multiply nothing but the lists of ids.

Inside the join a document goes by a 128-bit hash of its doc_id and text, so rows
with one doc_id, or none, are judged each by its own text; equal rows are judged
once and counted.

Edge cases: a null or empty text has no words; an item without words is left out;
items of one item_id are one item; items without item_id hit words like any other
and count together as one item that the list of ids lacks; every document row has
a result row, those with a null or repeated doc_id too; without benchmark rows
nothing is hit; an empty documents table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.base import BROADCAST_BYTES, LOWER, UPPER, small_join, stage, words_of

WINDOW = 13
SHARE = 20  # a document is contaminated if SHARE * n_hit >= n_words
BLOCK = 1 << 12
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return words_of(F.translate(text, UPPER, LOWER), BETWEEN)


def item_classes(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item_class, item_words, span) of distinct word sequences, span being the
    words of a window; and (item_class, item_id)."""
    rows = benchmark.select("item_id", words(F.col("text")).alias("item_words"))
    # words hold no space, so the line tells word sequences apart
    rows = rows.where(F.size("item_words") > 0).withColumn("item_class", F.md5(F.array_join("item_words", " ")))
    rows = stage(rows, "items")
    classes = stage(
        rows.groupBy("item_class").agg(F.first("item_words").alias("item_words"))
        .withColumn("span", F.least(F.lit(WINDOW), F.size("item_words"))), "item-classes",
    )
    return classes, stage(rows.select("item_class", "item_id").distinct(), "item-members")


def document_key(doc_id: Column, text: Column) -> Column:
    """A value that rows share if they are equal in doc_id and text, nulls included."""
    named = F.coalesce(F.concat(F.lit("="), doc_id.cast("string")), F.lit(""))
    return F.unhex(F.md5(F.concat(named, F.lit("\n"), F.coalesce(text, F.lit("")))))


def document_words(docs: DataFrame) -> DataFrame:
    """doc, doc_id, n_words, position (from 1) and word.  Position 0 has an empty
    word once for each row."""
    listed = docs.select(
        document_key(F.col("doc_id"), F.col("text")).alias("doc"), "doc_id", words(F.col("text")).alias("all_words")
    )
    return listed.select(
        "doc", "doc_id", F.size("all_words").alias("n_words"),
        F.posexplode(F.concat(F.array(F.lit("")), "all_words")).alias("position", "word"),
    )


def rare_places(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """word, item_class, place: for each window the place of its rarest word."""
    placed = classes.select("item_class", "span", F.posexplode("item_words").alias("place", "word"))
    held = stage(placed.select("word").distinct(), "item-words")
    counts = small_join(document_words(docs).select("word"), held, ["word"]).groupBy("word").agg(
        F.count("*").alias("n")
    )
    ranked = placed.join(stage(counts, "word-counts"), "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    by_item = ranked.groupBy("item_class", "span").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "n", "word"))),
            lambda x: F.struct(x.n.alias("n"), x.word.alias("word"), x.place.alias("place")),
        ).alias("shingles")
    )
    windows = F.transform(
        F.sequence(F.lit(1), F.size("shingles") - F.col("span") + 1),
        lambda s: F.array_min(F.slice("shingles", s, F.col("span"))),
    )
    chosen = by_item.select("item_class", F.inline(windows)).distinct()
    # a word that no document has cannot lead to an occurrence
    return chosen.where("n > 0").select("word", "item_class", "place")


def occurrences(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc, doc_id, n_words, rows) of every document, rows being how many are equal,
    and (doc, item_ids, unnamed, hits) of those with occurring windows; hits are
    (start, end) word spans from 0, unnamed is 1 if items without item_id occur."""
    classes, members = item_classes(benchmark)
    # the item's words that share a window with the place, which may be few of a long item
    low = F.greatest(F.lit(0), F.col("place") - F.col("span") + 1)
    high = F.least(F.size("item_words"), F.col("place") + F.col("span"))
    places = stage(
        rare_places(classes, docs).join(classes, "item_class").select(
            "word", "item_class", "place", "span", F.size("item_words").alias("item_size"), low.alias("low"),
            F.slice("item_words", low + 1, high - low).alias("here"),
        ), "rare-places",
    )
    wanted = places.select("word", "item_class", "place", "span", "item_size")
    marker = docs.sparkSession.range(1).select(
        F.lit("").alias("word"), F.lit(None).cast("string").alias("item_class"),
        F.lit(0).alias("place"), F.lit(0).alias("span"), F.lit(0).alias("item_size"),
    )
    wanted = stage(wanted.unionByName(marker), "wanted-words")
    # alignment: the document position of the item's first word, from 0
    first = F.col("position") - 1 - F.col("place")
    lowest = F.greatest(F.lit(0), F.col("place") - F.col("span") + 1, -first)
    highest = F.least(
        F.col("place"), F.col("item_size") - F.col("span"), F.col("n_words") - first - F.col("span")
    )
    met = stage(
        small_join(document_words(docs), wanted, ["word"])
        .where(F.col("item_class").isNull() | (lowest <= highest))
        .select("doc", "doc_id", "n_words", "item_class", "place", first.alias("first")), "alignments",
    )
    counted = met.where("item_class IS NULL").groupBy("doc").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.count("*").alias("rows")
    )

    aligned = met.where("item_class IS NOT NULL").select("doc", "item_class", "place", "first").distinct()
    known = places.select("item_class", "place", "span", "low", "here")
    aligned = small_join(aligned, known.drop("here"), ["item_class", "place"])
    by_doc = stage(
        aligned.groupBy("doc").agg(
            F.collect_list(F.struct("item_class", "place", "span", (F.col("first") + F.col("low")).alias("first")))
            .alias("alignments")
        ), "aligned-documents",
    )
    keyed = docs.select(document_key(F.col("doc_id"), F.col("text")).alias("doc"), "text")
    # by shuffle at every size: the alignments grow with the documents
    texts = keyed.join(by_doc.hint("merge"), "doc")
    texts = texts.select("doc", "alignments", words(F.col("text")).alias("all_words"))
    # the document's words beside those; `first` is the position of the first, before 0 if there is none
    beside = texts.select(
        "doc",
        F.inline(
            F.transform(
                "alignments",
                lambda a: F.struct(
                    a.item_class.alias("item_class"), a.place.alias("place"), a["first"].alias("first"),
                    F.slice(
                        "all_words", F.greatest(a["first"], F.lit(0)) + 1,
                        F.greatest(F.lit(0), 2 * a["span"] - 1 + F.least(a["first"], F.lit(0))),
                    ).alias("there"),
                ),
            )
        ),
    ).distinct()
    # words of the item that have none beside them, at either end, are unequal
    shift = F.greatest(-F.col("first"), F.lit(0))
    equal = F.transform("here", lambda w, i: F.coalesce(F.get("there", i - shift) == w, F.lit(False)))
    checked = small_join(beside, known, ["item_class", "place"]).withColumn("equal", equal)
    starts = F.filter(
        F.sequence(F.lit(0), F.size("equal") - F.col("span")),
        lambda s: F.forall(F.slice("equal", s + 1, F.col("span")), lambda e: e),
    )
    hits = stage(
        checked.select("doc", "item_class", "span", "first", starts.alias("starts"))
        .where(F.size("starts") > 0)
        .select(
            "doc", "item_class",
            F.transform(
                "starts",
                lambda s: F.struct(
                    (F.col("first") + s).alias("start"), (F.col("first") + s + F.col("span")).alias("end")
                ),
            ).alias("hits"),
        ), "item-hits",
    )
    # equal rows found the same hits, so sets lose nothing
    each = hits.select("doc", F.explode("hits").alias("hit")).distinct()
    spans = each.groupBy("doc").agg(F.array_sort(F.collect_list("hit")).alias("hits"))
    ids = hits.select("doc", "item_class").distinct().join(members, "item_class").groupBy("doc").agg(
        F.collect_set("item_id").alias("item_ids"), F.max(F.col("item_id").isNull().cast("int")).alias("unnamed")
    )
    return counted, spans.join(ids, "doc")


def _covered(hits: Column) -> Column:
    """Words inside a sorted array of spans."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(
        hits, zero,
        lambda a, h: F.struct(
            (a.n + F.greatest(F.lit(0), h.end - F.greatest(a.upto, h.start))).alias("n"),
            F.greatest(a.upto, h.end).alias("upto"),
        ),
        lambda a: a.n,
    )


def _judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc, doc_id, n_words, n_hit, n_items, item_ids, contaminated and rows."""
    counted, found = occurrences(docs, benchmark)
    none = F.array().cast("array<string>")
    joined = counted.join(
        found.select(
            "doc", _covered(F.col("hits")).alias("n_hit"), "unnamed",
            F.array_sort(F.col("item_ids").cast("array<string>")).alias("item_ids"),
        ), "doc", "left",
    )
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        "doc", "doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), "rows",
        F.coalesce("item_ids", none).alias("item_ids"), F.coalesce("unnamed", F.lit(0)).alias("unnamed"),
    ).select(
        "doc", "doc_id", "n_words", "n_hit", (F.size("item_ids") + F.col("unnamed")).cast("long").alias("n_items"),
        "item_ids", ((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "rows",
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, item_ids (sorted strings), contaminated of every row."""
    judged = _judged(docs, benchmark).drop("doc")
    columns = [c for c in judged.columns if c != "rows"]
    # rows that repeat often go out in blocks
    blocks = judged.withColumn("block", F.explode(F.expr(f"sequence(0L, (rows - 1) div {BLOCK})")))
    left = F.least(F.lit(BLOCK).cast("long"), F.col("rows") - F.col("block") * BLOCK)
    return blocks.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), left))).select(*columns)


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that are not contaminated."""
    hit = stage(_judged(docs, benchmark).where("contaminated").select(F.col("doc").alias("hit")), "contaminated")
    rows = docs.select(
        F.struct("*").alias("row"), document_key(F.col("doc_id"), F.col("text")).alias("doc")
    )
    size = hit.count() * 32
    side = F.broadcast(hit) if size <= BROADCAST_BYTES else hit
    return rows.join(side, F.col("doc") == F.col("hit"), "left_anti").select("row.*")
