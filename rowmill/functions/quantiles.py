"""Exact quantiles in a fixed number of passes, without gathering a column's values.

The built-in ``percentile`` keeps every distinct value of a group in one
aggregation buffer.  Here the columns are written once as 64-bit codes whose
order is that of the numbers, and every wanted rank is found by radix selection:
a pass counts the next DIGIT_BITS bits of the codes that share the bits known so
far, for all columns and ranks in one aggregation with map-side counts, and the
running counts say which digit holds the rank.  Once the codes still in question
are few over all ranks, they are fetched instead.  The source is read once, and
the written table at most 1 + 64 / DIGIT_BITS times, whatever the values are: a
value that fills the table is a digit like any other.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.functions.columns import present, require
from rowmill.sources.workdir import stage

DIGIT_BITS = 16
FETCH_ROWS = 50_000  # over all columns and ranks of a call
_SIGN = (1 << 63) - 1


@dataclass(frozen=True)
class _Interval:
    """The codes of a column that share their upper bits."""

    column: int
    prefix: int = 0
    shift: int = 64

    def code(self) -> Column:
        return F.col(f"c{self.column}")

    def inside(self) -> Column:
        """The code if it lies in the interval, else null."""
        if self.shift == 64:
            return self.code()
        return F.when(F.shiftright(self.code(), self.shift) == F.lit(self.prefix).cast("long"), self.code())


@dataclass
class _Search:
    """A rank inside an interval of ``held`` rows."""

    interval: _Interval
    rank: int
    held: int
    found: float | None = None


def order_codes(values: np.ndarray) -> np.ndarray:
    """Signed 64-bit numbers in the order of the doubles; both zeros are one."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ _SIGN, bits)


def code_value(code: int) -> float:
    bits = code ^ _SIGN if code < 0 else code
    return struct.unpack("<d", struct.pack("<q", bits))[0]


def _coded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The present values as codes c0, c1, ..., written once."""
    values = df.select(*[present(df, c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    names = values.columns

    def run(batches):
        for b in batches:
            coded = []
            for c in b.columns:
                absent = c.is_null().to_numpy(zero_copy_only=False)
                coded.append(pa.array(order_codes(c.fill_null(0.0).to_numpy(zero_copy_only=False)), mask=absent))
            yield pa.RecordBatch.from_arrays(coded, names)

    return stage(values.mapInArrow(run, ", ".join(f"{c} long" for c in names)), "quantile-codes")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Iterable[float]
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation, missing values left out."""
    columns, probabilities = list(columns), list(probabilities)
    require(df, columns)
    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    if not columns:
        return result
    codes = _coded(df, columns)
    counts = codes.agg(*[F.count(c) for c in codes.columns]).collect()[0]

    searches: dict[tuple[int, int], _Search] = {}
    positions: dict[tuple[int, int], tuple[int, int, float]] = {}
    for i, n in enumerate(counts):
        for j, p in enumerate(probabilities):
            if n == 0:
                continue
            k = math.floor(p * (n - 1))
            weight = p * (n - 1) - k
            upper = k + 1 if weight else k
            positions[i, j] = (k, upper, weight)
            for rank in {k, upper}:
                searches.setdefault((i, rank), _Search(_Interval(i), rank, n))

    shift = 64
    while open_ := [s for s in searches.values() if s.found is None]:
        # ranks of one interval share its rows
        if sum({s.interval: s.held for s in open_}.values()) <= FETCH_ROWS:
            _fetch(codes, open_)
            break
        shift = max(0, shift - DIGIT_BITS)
        _narrow(codes, open_, shift)

    for (i, j), (k, upper, weight) in positions.items():
        a, b = searches[i, k].found, searches[i, upper].found
        result[columns[i]][j] = a + (b - a) * weight
    return result


def _counted(codes: DataFrame, intervals: Sequence[_Interval], shift: int) -> DataFrame:
    """(t, v, n): how many codes of interval t have the upper bits v."""
    cells = [
        F.struct(F.lit(t).alias("t"), F.shiftright(s.inside(), shift).alias("v")) for t, s in enumerate(intervals)
    ]
    each = codes.select(F.explode(F.array(*cells)).alias("x")).select("x.t", "x.v")
    return each.filter(F.col("v").isNotNull()).groupBy("t", "v").agg(F.count(F.lit(1)).alias("n"))


def _narrow(codes: DataFrame, searches: Sequence[_Search], shift: int) -> None:
    """One pass: find the digit of every search; one row a rank reaches the driver."""
    intervals = list(dict.fromkeys(s.interval for s in searches))
    place = {s: t for t, s in enumerate(intervals)}
    wanted = sorted({(place[s.interval], s.rank) for s in searches})
    ranks = codes.sparkSession.createDataFrame(wanted, "rt int, rank long")
    upto = F.sum("n").over(Window.partitionBy("t").orderBy("v"))
    running = _counted(codes, intervals, shift).withColumn("upto", upto)
    hit = (F.col("t") == F.col("rt")) & (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
    rows = running.join(F.broadcast(ranks), hit).select("t", "rank", "v", "n", "upto").collect()
    digits = {(r["t"], r["rank"]): r for r in rows}
    for s in searches:
        r = digits.get((place[s.interval], s.rank))
        if r is None:
            raise ValueError("the table changed while it was read")
        s.interval = _Interval(s.interval.column, r["v"], shift)
        s.rank, s.held = s.rank - (r["upto"] - r["n"]), r["n"]
        if shift == 0:
            s.found = code_value(r["v"])


def _fetch(codes: DataFrame, searches: Sequence[_Search]) -> None:
    """Resolve searches whose intervals hold few rows, by counting their codes."""
    intervals = list(dict.fromkeys(s.interval for s in searches))
    held: dict[int, list] = {}
    for t, v, n in _counted(codes, intervals, 0).collect():
        held.setdefault(t, []).append((v, n))
    for s in searches:
        seen = 0
        for v, n in sorted(held.get(intervals.index(s.interval), [])):
            seen += n
            if s.rank < seen:
                s.found = code_value(v)
                break
        if s.found is None:
            raise ValueError("the table changed while it was read")
