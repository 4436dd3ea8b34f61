"""What the trained text operators share: labelled samples and held-out rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.base import crc_share, stage

THRESHOLD = 0.3


def held_out(parts: int, remainder: int) -> Column:
    """Whether a row is kept from learning; a row without doc_id is not marked
    held out, and no sample takes it."""
    return F.coalesce(crc_share(F.col("doc_id"), parts) == remainder, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, parts: int, remainder: int,
                   most: int, name: str) -> DataFrame:
    """text, label and share (0 to 1, an even hash) of at most `most` labelled
    rows outside the held-out part, in the order of a hash of doc_id.  The rows
    with one doc_id have their largest label; equal texts are one example with
    the label of most of them, else a copied text would count as evidence again
    and again."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(parts, remainder))
    sample = (
        known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    one = texts.groupBy(F.sha2(F.coalesce("text", F.lit("")), 256).alias("key")).agg(
        F.first("text").alias("text"), (F.avg("label") >= 0.5).cast("int").alias("label")
    )
    share = F.pmod(F.xxhash64(F.col("key"), F.lit(7)), F.lit(1000)) / 1000
    return stage(one.select("text", "label", share.alias("share")), name)


def scored(docs: DataFrame, score, parts: int, remainder: int) -> DataFrame:
    """doc_id, held_out, score and predicted; score maps a list of texts to an array."""
    import pyarrow as pa

    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            found = score(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.asarray(found, np.float64))], ["doc_id", "score"]
            )

    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double")
    return rows.select(
        "doc_id", held_out(parts, remainder).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


__all__ = ["held_out", "labelled_texts", "scored", "sigmoid", "THRESHOLD"]
