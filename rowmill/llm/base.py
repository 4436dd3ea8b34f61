"""Helpers that several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.sources.workdir import stage

# The characters between words: space and the five ASCII control characters for white space.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column, between: str = SPACE) -> Column:
    """The words of a text as an array; a null text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), between)
    return F.filter(parts, lambda w: w != "")


def small_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a staged table: broadcast if its measured size is within
    BROADCAST_BYTES, else shuffled.  Both ways give the same rows."""
    size = small.agg(F.sum(F.length(F.to_json(F.struct("*"))) + 32)).first()[0] or 0
    return big.join(F.broadcast(small) if size <= BROADCAST_BYTES else small, on, how)


def crc_share(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo the number of parts; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def row_hash(docs: DataFrame) -> Column:
    """A 128-bit hash that rows share if they are equal in every column."""
    values = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in t else F.col(f"`{c}`") for c, t in docs.dtypes]
    return F.struct(*[F.xxhash64(F.lit(seed), *values).alias(f"h{seed}") for seed in (1, 2)])


__all__ = ["SPACE", "WORD", "UPPER", "LOWER", "table", "words_of", "small_join", "crc_share", "row_hash", "stage"]
