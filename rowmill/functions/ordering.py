"""Repeatable pseudo-random order of rows by a hash of their key.

``rand`` and ``randomSplit`` depend on how the rows are partitioned, so a task
that is run again after a lost executor may decide differently.  A hash of the
key does not.  Selecting "the first k rows in hash order" needs no sort of the
table: ``hash_cuts`` finds the k-th (hash, key) pair by counting hash prefixes,
and the selection is then a filter with literals.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.functions.columns import col, require

HASH_BITS = 32
FIRST_BITS = 8
PREFIX_BITS = 12
FETCH_ROWS = 20_000  # over all open searches of a call
MAX_PREFIXES = 2**18  # counted in one round, over all open searches
MAX_STRATA = 64


def key_hash(key: Column, seed: int | str = 42) -> Column:
    """First 32 bits of md5('seed:key') as a non-negative long; a null key has
    the hash of the empty text, so that no row is lost."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def unit_hash(key: Column, seed: int | str = 42) -> Column:
    """The key hash scaled to [0, 1)."""
    return key_hash(key, seed) / F.lit(float(2**HASH_BITS))


@dataclass(frozen=True)
class Cut:
    """A position in hash order: all rows up to and including (hash, key); a
    null key stands before all others of its hash."""

    hash: int
    key: object

    def reaches(self, h: Column, key: Column) -> Column:
        upto = key.isNull()
        if self.key is not None:
            upto = upto | F.coalesce(key <= F.lit(self.key), F.lit(False))
        return (h < F.lit(self.hash)) | ((h == F.lit(self.hash)) & upto)


@dataclass(frozen=True)
class Stratum:
    value: object
    rows: int
    cuts: tuple[Cut | None, ...]  # None stands for rank 0, before every row


class TooManyStrata(ValueError):
    pass


def hash_cuts(
    df: DataFrame,
    key: str,
    ranks: Callable[[int], list[int]],
    strata: str | None = None,
    seed: int = 42,
) -> list[Stratum]:
    """The (hash, key) pairs that stand at given 1-based ranks, per stratum.

    ``ranks(n)`` gives the wanted ranks for a stratum of n rows.  Each round
    counts rows by a longer hash prefix inside the few prefixes still open; all
    searches share ``MAX_PREFIXES`` counts a round and ``FETCH_ROWS`` rows at
    the end, whatever the number of rows.
    Rows that share a key, null included, fall on the same side.
    """
    require(df, [key] + ([strata] if strata else []))
    s = col(strata) if strata else F.lit(0)
    keyed = df.select(s.alias("s"), key_hash(col(key), seed).alias("h"), col(key).alias("k"))

    shift = HASH_BITS - FIRST_BITS
    most = MAX_STRATA * 2**FIRST_BITS
    counts = _count_prefixes(keyed, shift, shift, most + 1)
    totals: dict = {}
    for (value, _), inside in counts.items():
        totals[value] = totals.get(value, 0) + sum(inside.values())
    if len(totals) > MAX_STRATA:
        raise TooManyStrata(f"more than {MAX_STRATA} strata in {strata}")
    wanted = {v: ranks(n) for v, n in totals.items()}
    # open searches: (stratum, rank) -> (prefix, rows of the stratum before it, rows in it)
    open_at = {
        (v, rank): (0, 0, totals[v]) for v, found in wanted.items() for rank in found if 0 < rank <= totals[v]
    }
    roots: dict = {}
    for (v, _), inside in counts.items():
        roots.setdefault((v, 0), {}).update(inside)
    open_at = _narrow(open_at, roots)

    while shift > 0 and _open_rows(open_at) > FETCH_ROWS:
        searches = len({(v, p) for (v, _), (p, *_) in open_at.items()})
        step = max(1, min(PREFIX_BITS, shift, (MAX_PREFIXES // searches).bit_length() - 1))
        inside = _inside(open_at, shift)
        open_at = _narrow(open_at, _count_prefixes(keyed.filter(inside), shift - step, shift))
        shift -= step

    cuts: dict = {}
    if open_at:
        rows = keyed.filter(_inside(open_at, shift)).groupBy("s", "h", "k").count().collect()
        held: dict = {}
        for r in sorted(rows, key=lambda r: (r["h"], r["k"] is not None, r["k"])):
            held.setdefault((r["s"], r["h"] >> shift), []).append(r)
        for (v, rank), (p, seen, _) in open_at.items():
            for r in held[v, p]:
                seen += r["count"]
                if seen >= rank:
                    cuts[v, rank] = Cut(r["h"], r["k"])
                    break

    def at(value, rank):
        return cuts[value, min(rank, totals[value])] if rank > 0 else None

    return [Stratum(v, totals[v], tuple(at(v, r) for r in wanted[v])) for v in totals]


def _count_prefixes(
    keyed: DataFrame, shift: int, parent: int, most: int | None = None
) -> dict[tuple, dict[int, int]]:
    """(stratum, prefix at the parent's length) -> longer prefix -> rows."""
    counted = keyed.groupBy("s", F.shiftright("h", shift).alias("p")).count()
    rows = (counted.limit(most) if most else counted).collect()
    if most and len(rows) == most:
        raise TooManyStrata(f"more than {MAX_STRATA} strata")
    found: dict = {}
    for r in rows:
        found.setdefault((r["s"], r["p"] >> (parent - shift)), {})[r["p"]] = r["count"]
    return found


def _narrow(open_at: dict, counts: dict[tuple, dict[int, int]]) -> dict:
    """Every open search moved to the longer prefix that holds its rank."""
    ordered = {at: sorted(inside.items()) for at, inside in counts.items()}
    found = {}
    for (v, rank), (p, seen, _) in open_at.items():
        for longer, n in ordered[v, p]:
            if seen + n >= rank:
                found[v, rank] = (longer, seen, n)
                break
            seen += n
        else:
            raise ValueError("the table changed while it was read")
    return found


def _open_rows(open_at: dict) -> int:
    """Rows inside the open prefixes, each counted once."""
    return sum({(v, p): n for (v, _), (p, _, n) in open_at.items()}.values())


def _inside(open_at: dict, shift: int) -> Column:
    """Rows in an open prefix of their stratum; the hash is taken once per row."""
    by_value: dict = {}
    for (value, _), (prefix, *_) in open_at.items():
        by_value.setdefault(value, set()).add(prefix)
    wanted = F.lit(None).cast("array<bigint>")
    for value, prefixes in by_value.items():
        held = F.array(*[F.lit(p).cast("bigint") for p in sorted(prefixes)])
        wanted = F.when(F.col("s").eqNullSafe(F.lit(value)), held).otherwise(wanted)
    return F.array_contains(wanted, F.shiftright("h", shift))


def rank_in_class(
    df: DataFrame,
    key: str,
    label: str,
    output: str,
    size_output: str | None = None,
    seed: int = 42,
    rows_per_bucket: int = 1_000_000,
    same_key_same_rank: bool = False,
) -> DataFrame:
    """1-based rank of each row inside its class, in hash order; rows that share
    a key are numbered on, or all have the rank of their first.

    A window over the class alone would put a class into one task.  The class
    is cut into buckets of hash prefixes; a bucket's offset is a running sum of
    bucket counts and the row number is taken inside the bucket.
    """
    require(df, [key, label])
    rows = df.count()
    bits = max(4, min(20, (max(rows, 1) // rows_per_bucket).bit_length() + 1))
    # inside a struct a null class is a class like any other, and the join below
    # finds the rows where the window has put them
    base = df.withColumns(
        {
            "_s": F.struct(col(label).alias("v")),
            "_h": key_hash(col(key), seed),
            "_b": F.shiftright(key_hash(col(key), seed), HASH_BITS - bits),
        }
    )
    counts = base.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumns(
        {
            "_before": F.coalesce(F.sum("_n").over(before), F.lit(0)),
            "_size": F.sum("_n").over(Window.partitionBy("_s")),
        }
    ).drop("_n")
    inside = Window.partitionBy("_s", "_b").orderBy("_h", col(key))
    number = F.rank() if same_key_same_rank else F.row_number()
    joined = base.withColumn("_rn", number.over(inside)).join(offsets, ["_s", "_b"])
    result = joined.withColumn(output, F.col("_before") + F.col("_rn"))
    if size_output:
        result = result.withColumn(size_output, F.col("_size"))
    return result.drop("_s", "_h", "_b", "_before", "_size", "_rn")
