"""Mixing sources to target weights by pivotal dependent rounding.

Targets.  Sources in code point order (null last) weigh 5, 2, 1 and so on again,
and share all words by weight.  A target stops at REPEATS times its source's
words; the excess is reshared by weight until no target is above its limit.

Rounding.  In a source that takes p times its words every document is due p
copies: the whole part of p is taken at once, the fraction is rounded.  Two
fractional documents are a pair: words move from one to the other, as many as
make one of them integral, in a direction drawn so that each document's expected
copies stay as they were.  The moved mass is measured in words, so the words a
source takes stay exactly at its target until one document is left, which a last
draw rounds.

The reduction tree.  Rows alike in doc_id, source and text are one item with a
count; the whole part of count times p is taken at once, one fraction is left.
Items are dealt by size into bands of BAND_BITS powers of two, and bands are
worked off from the longest documents down, whatever the size of the input:
- a source and size class with more than DIRECT items of its own is dealt by hash
  into small groups, by a number that follows from its own items.  Each group
  pairs its items off in an array expression and hands on at most one; 64 groups
  form one of the next level, until 128 are left;
- what is left of a source's band is settled largest first, each item against
  all smaller ones of the band and against the pool, which is every item of the
  smaller bands together: min(p, 1 - p) of its words can move either way.  The
  pool is then moved by one factor a source, before its own bands are paired.
So short documents still carry fractions when a long one is settled, and what is
left of the mass is less than the smallest documents hold, unless all smaller
documents of a source cannot make up for a long one.  A source with a third of
all rows is many groups on every level.  Levels are written to the shared folder.

Draws are hashes of the paired rows, so a rerun, or a task that runs again,
gives the same copies.  Only DataFrame operations are used.

Edge cases: a null or blank text has size 0 and takes 0 words; a null source is
a source of its own; an empty table gives an empty result; the copies of
repeated rows differ by one at most; a null doc_id is a value like another; other columns are
not read by copies().  mixed() keeps them: of rows alike in doc_id, source and
text every one takes its own copies, in the order of a hash of all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rowmill.llm.base import WORD, row_hash, small_join, stage

WEIGHTS = (5, 2, 1)
REPEATS = 3
FAN_IN_BITS = 6
LAST_BITS = 7
DIRECT = 1 << 8
BAND_BITS = 3
BLOCK = 1 << 12
ORDER_BITS = 12


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and a hash that tells rows apart."""
    return docs.select(
        "doc_id", "source",
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64("doc_id", "source", "text").alias("seed"),
    )


def _weighted(sources: DataFrame) -> DataFrame:
    """Sources with their weights.  Ranks come from a range partitioning and the
    row counts of its partitions, not from one sorted group of all sources."""
    order = F.col("source").asc_nulls_last()
    dealt = stage(
        sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources"
    )
    counts = dealt.groupBy("part").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    bases = stage(counts.select("part", F.coalesce(earlier, F.lit(0)).alias("base")), "source-bases")
    rank = F.col("base") + F.row_number().over(W.partitionBy("part").orderBy(order)) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int"))
    return dealt.join(bases, "part").select("source", "source_size", weight.cast("long").alias("weight"))


def targets(rows: DataFrame) -> DataFrame:
    """source, source_size and target of every source of the measured rows."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = stage(_weighted(sizes), "source-weights")
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    share, full = (total or 0) / (weights or 1), None
    while True:
        above = F.col("weight") * F.lit(share) > REPEATS * F.col("source_size")
        held = sources.where(above).agg(F.count("*"), F.sum("source_size"), F.sum("weight")).first()
        # the limits that hold only grow, so the loop ends when no source joins them
        if held[0] == (full or 0) or held[2] == weights:
            break
        full = held[0]
        share = (total - REPEATS * held[1]) / (weights - held[2])
    limit = REPEATS * F.col("source_size").cast("double")
    return sources.select("source", "source_size", F.least(F.col("weight") * F.lit(share), limit).alias("target"))


_KEEP = ["seed", "doc_id", "source", "size", "source_size", "target", "n", "copies"]
_ITEM = [f"item.{c}" for c in _KEEP]

# One step of a group: the document held so far meets the next one.  room and
# space are the words that complete the held and the next document, have and
# give the words that empty them.
_PAIR_OFF = """aggregate(
  slice(items, 2, size(items)),
  named_struct('held', items[0], 'p', items[0].fraction,
               'done', filter(array(named_struct('item', items[0], 'extra', 0)), d -> false)),
  (a, x) -> transform(array(named_struct(
      'draw', pmod(xxhash64(a.held.seed, x.seed, {level}), 9007199254740992) / 9007199254740992D,
      'room', (1 - a.p) * a.held.size, 'give', x.fraction * x.size,
      'have', a.p * a.held.size, 'space', (1 - x.fraction) * x.size)),
    m -> CASE
      WHEN m.draw * (least(m.room, m.give) + least(m.have, m.space)) < least(m.have, m.space) THEN
        CASE WHEN m.room <= m.give THEN named_struct('held', x,
               'p', greatest(0D, x.fraction - m.room / x.size),
               'done', concat(a.done, array(named_struct('item', a.held, 'extra', 1))))
             ELSE named_struct('held', a.held, 'p', least(1D, a.p + m.give / a.held.size),
               'done', concat(a.done, array(named_struct('item', x, 'extra', 0)))) END
      WHEN m.have <= m.space THEN named_struct('held', x,
               'p', least(1D, x.fraction + m.have / x.size),
               'done', concat(a.done, array(named_struct('item', a.held, 'extra', 0))))
      ELSE named_struct('held', a.held, 'p', greatest(0D, a.p - m.space / a.held.size),
               'done', concat(a.done, array(named_struct('item', x, 'extra', 1)))) END)[0])"""

# The documents that are settled, and the one that goes on unless it is integral.
_HAND_ON = """concat(
  transform(state.done, d -> named_struct('item', d.item, 'extra', d.extra, 'fraction', 0D)),
  array(named_struct('item', state.held,
    'extra', CASE WHEN state.p <= 0 THEN 0 WHEN state.p >= 1 THEN 1 END, 'fraction', state.p)))"""


# The last group of a source's band, largest document first, and the pool of its
# smaller bands as the last entry.  Each document is settled by its own draw, and
# the words that this moves come from, or go to, all that follow, each giving or
# taking in proportion to what it can; up and down moves balance, so every
# document's expected copies stay.  If those that follow are too small, they move
# as far as they can.
_SETTLE = """aggregate(
  sequence(0, size(items) - 1),
  concat(transform(items, x -> x.fraction), array(0.5D)),
  (ps, i) -> CASE WHEN ps[i] <= 0 OR ps[i] >= 1 THEN ps ELSE transform(
    array(named_struct(
      'p', ps[i],
      'up', pmod(xxhash64(items[i].seed, {level}), 9007199254740992) / 9007199254740992D < ps[i],
      'room', aggregate(sequence(i + 1, size(items)), 0D, (t, j) -> t
        + least(ps[j] / (1 - ps[i]), (1 - ps[j]) / ps[i]) * sizes[j]))),
    m -> transform(ps, (p, j) -> CASE
      WHEN j = i THEN CASE WHEN m.up THEN 1D ELSE 0D END
      WHEN j < i OR m.room <= 0 THEN p
      ELSE greatest(0D, least(1D, p + (m.p - CASE WHEN m.up THEN 1D ELSE 0D END)
        * least(p / (1 - m.p), (1 - p) / m.p) * least(1D, sizes[i] / m.room))) END))[0] END)"""


def _groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The documents of each group in an array, largest first."""
    item = F.struct((-F.col("size")).alias("order"), *_KEEP, "fraction")
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("items"))


def _level(rows: DataFrame, keys: list[str], level: int) -> DataFrame:
    """Pair off the documents of each group; extra is null for what goes on."""
    paired = _groups(rows, keys).select(F.expr(_PAIR_OFF.format(level=level)).alias("state"))
    return paired.select(F.inline(F.expr(_HAND_ON))).selectExpr(*_ITEM, "extra", "fraction")


def _named() -> Column:
    """The source as a value that is never null."""
    return F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))


def _due(docs: DataFrame) -> DataFrame:
    """The items: n rows alike, the copies they take at once, and the fraction left."""
    rows = stage(measured(docs), "measured")
    goals = stage(targets(rows).select(_named().alias("named"), "source_size", "target"), "targets")
    alike = rows.groupBy("doc_id", "source", "size", "seed").agg(F.count("*").alias("n"))
    due = small_join(alike.withColumn("named", _named()), goals, ["named"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    due = due.withColumn("due", F.col("n") * rate).withColumn("copies", F.floor("due").cast("long"))
    size_class = F.length(F.bin("size"))
    return stage(
        due.withColumn("fraction", F.col("due") - F.col("copies")).drop("due")
        .withColumn("size_class", size_class)
        .withColumn("band", F.floor((F.col("size_class") - 1) / BAND_BITS).cast("int")), "due",
    )


def _levels(n: int) -> list[int]:
    """Hash bits of the groups on each level for n items, the finest first."""
    if n <= DIRECT:
        return []
    bits = LAST_BITS
    while n >> bits + FAN_IN_BITS:
        bits += FAN_IN_BITS
    return list(range(bits, LAST_BITS - 1, -FAN_IN_BITS))


def _finest() -> Column:
    """The first of _levels(n) as a column, -1 for none."""
    bits, found = LAST_BITS, F.when(F.col("n") <= DIRECT, -1).otherwise(LAST_BITS)
    while bits + FAN_IN_BITS < 63:
        found = F.when(F.shiftright("n", bits + FAN_IN_BITS) > 0, bits + FAN_IN_BITS).otherwise(found)
        bits += FAN_IN_BITS
    return found


def _settled(
    items: DataFrame, pool: DataFrame, counts: DataFrame, most: int, band: int
) -> tuple[list[DataFrame], DataFrame]:
    """The rounded items of a band, and (named, shift): how far each pool moves, -1
    to 1.  counts: named, size_class and n of the band, most being the largest n.
    A level takes the items whose own source and size class reaches it."""
    done, todo = [], items
    finest = stage(counts.select("named", "size_class", _finest().alias("finest")), f"finest-{band}")
    for bits in _levels(most):
        keyed = todo.withColumn("named", _named()).withColumn("size_class", F.length(F.bin("size")))
        keyed = small_join(keyed, finest, ["named", "size_class"]).withColumn(
            "bucket", F.col("seed").bitwiseAND(F.lit((1 << bits) - 1))
        )
        out = stage(
            _level(keyed.where(F.col("finest") >= bits), ["source", "size_class", "bucket"], bits),
            f"pairs-{band}-{bits}",
        )
        done.append(out.where("extra IS NOT NULL"))
        waiting = keyed.where(F.col("finest") < bits)
        todo = out.where("extra IS NULL").select(*_KEEP, "fraction").unionByName(waiting.select(*_KEEP, "fraction"))
    sizes = F.concat(F.transform("items", lambda x: x.size.cast("double")), F.array(2 * F.coalesce("words", F.lit(0.0))))
    last = _groups(todo.withColumn("named", _named()), ["named"]).join(pool, "named", "left")
    last = last.withColumn("sizes", sizes)
    last = stage(last.select("named", "items", F.expr(_SETTLE.format(level=0)).alias("ps")), f"settled-{band}")
    extras = F.transform(
        "items", lambda x, k: F.struct(x.alias("item"), F.get("ps", k).cast("int").alias("extra"))
    )
    done.append(last.select(F.inline(extras)).selectExpr(*_ITEM, "extra"))
    return done, last.select("named", (2 * F.element_at("ps", -1) - 1).alias("shift"))


def _taken(docs: DataFrame) -> DataFrame:
    """The items with the copies that their n rows take together."""
    due = _due(docs)
    open_ = (F.col("fraction") > 0) & (F.col("size") > 0)
    done = [due.where(~open_).withColumn("extra", F.lit(0))]
    counts = stage(
        due.where(open_).groupBy("named", "band", "size_class").agg(F.count("*").alias("n")), "class-counts"
    )
    bands = counts.groupBy("band").agg(F.max("n")).orderBy(F.desc("band")).collect()
    # the fraction that an item has now, by source, band and the fraction it was due
    now = stage(
        due.where(open_).groupBy("named", "band", "fraction").agg(F.sum("size").alias("words"))
        .withColumn("now", F.col("fraction")), "fractions",
    )
    for band, most in bands:
        items = small_join(
            due.where(open_ & (F.col("band") == band)).drop("band"),
            now.where(F.col("band") == band).select("named", "fraction", "now"), ["named", "fraction"],
        ).withColumn("fraction", F.col("now"))
        whole = (F.col("fraction") <= 0) | (F.col("fraction") >= 1)
        done.append(items.where(whole).withColumn("extra", F.col("fraction").cast("int")))
        smaller = now.where(F.col("band") < band)
        reach = F.least("now", 1 - F.col("now"))
        pool = smaller.groupBy("named").agg(F.sum(F.col("words") * reach).alias("words"))
        rounded, shifts = _settled(
            items.where(~whole), pool, counts.where(F.col("band") == band), most, band
        )
        done += rounded
        moved = F.col("now") + F.coalesce("shift", F.lit(0.0)) * reach
        now = stage(
            smaller.join(shifts, "named", "left")
            .withColumn("now", F.greatest(F.lit(0.0), F.least(F.lit(1.0), moved))).drop("shift"), f"fractions-{band}",
        )
    parts = [p.select(*_KEEP, "extra") for p in done]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole.withColumn("copies", F.col("copies") + F.col("extra")).drop("extra")


def _times(rows: DataFrame, n: str) -> DataFrame:
    """Each row n times; a row that repeats often goes out in blocks."""
    blocks = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({n} - 1) div {BLOCK}"))))
    left = F.least(F.lit(BLOCK).cast("long"), F.col(n) - F.col("block") * BLOCK)
    return blocks.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), left))).drop("block", "again")


def copies(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of each row."""
    items = _taken(docs)
    columns = ["doc_id", "source", "size", "source_size", "target", "seed"]
    single = items.where("n = 1").select(*columns, F.col("copies").cast("int").alias("copies"))
    # of n rows alike, copies % n take one copy more
    each, more = F.expr("copies div n"), F.expr("copies % n")
    runs = F.array(
        F.struct(more.alias("run"), (each + 1).cast("int").alias("copies")),
        F.struct((F.col("n") - more).alias("run"), each.cast("int").alias("copies")),
    )
    many = items.where("n > 1").select(*columns, F.inline(runs)).where("run > 0")
    whole = single.unionByName(_times(many, "run").select(*columns, "copies"))
    return whole.withColumn("taken", F.col("copies") * F.col("size"))


def _own_copies(docs: DataFrame) -> DataFrame:
    """same (hash of a whole row), id, key and copies of all rows that are equal in
    every column.  n rows alike in doc_id, source and text take copies div n each;
    the first copies % n of them, in the order of `same`, take one more."""
    rows = docs.select(
        F.col("doc_id").alias("id"), F.xxhash64("doc_id", "source", "text").alias("key"),
        row_hash(docs).alias("same"),
    )
    rows = stage(rows.groupBy("id", "key", "same").agg(F.count("*").alias("rows")), "equal-rows")
    taken = stage(
        _taken(docs).groupBy("doc_id", "seed").agg(F.sum("copies").alias("all"), F.sum("n").alias("n")), "taken"
    )
    alike = rows.join(taken, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("seed")))
    alike = alike.withColumn("bucket", F.shiftright("same.h1", 64 - ORDER_BITS)).drop("doc_id", "seed")
    # rows before a row: those of earlier buckets, and the earlier ones of its own
    sums = alike.groupBy("id", "key", "bucket").agg(F.sum("rows").alias("held"))
    earlier = W.partitionBy("id", "key").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    bases = sums.select(
        F.col("id").alias("base_id"), F.col("key").alias("base_key"), F.col("bucket").alias("base_bucket"),
        F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"),
    )
    within = W.partitionBy("id", "key", "bucket").orderBy("same").rowsBetween(W.unboundedPreceding, -1)
    placed = alike.join(
        bases, F.col("id").eqNullSafe(F.col("base_id")) & (F.col("key") == F.col("base_key"))
        & (F.col("bucket") == F.col("base_bucket")),
    ).withColumn("first", F.col("base") + F.coalesce(F.sum("rows").over(within), F.lit(0)))
    more = F.greatest(F.lit(0), F.least(F.col("rows"), F.col("all") % F.col("n") - F.col("first")))
    return stage(
        placed.select("id", "key", "same", (F.col("rows") * F.expr("all div n") + more).alias("copies"))
        .where("copies > 0"), "own-copies",
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The documents, each row as often as the mix takes it."""
    own = _own_copies(docs).select(
        F.col("id").alias("own_id"), F.col("key").alias("own_key"), F.col("same").alias("own_same"), "copies"
    )
    # rows as one value, so that no column clashes; equal rows are one row here
    keyed = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("doc_id", "source", "text").alias("key"),
        row_hash(docs).alias("same"),
    )
    one = keyed.dropDuplicates(["id", "key", "same"])
    joined = one.join(
        own, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("key") == F.col("own_key"))
        & (F.col("same") == F.col("own_same")),
    )
    return _times(joined.select("row", "copies"), "copies").select("row.*")
