"""SMOTE: new minority rows between a row and one of its nearest neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import col, is_missing, require
from rowmill.functions.ordering import hash_cuts, key_hash, unit_hash
from rowmill.operators.neighbors import nearest_points
from rowmill.sources.workdir import stage

BLOCK = 10_000


def class_sizes(df: DataFrame, label: str) -> dict:
    return {r[0]: r[1] for r in df.groupBy(col(label)).count().collect()}


def synthetic_rows(
    df: DataFrame,
    key: str,
    label: str,
    features: Sequence[str],
    minority: object,
    need: int,
    k: int = 5,
    seed: int = 42,
    cell_rows: int = 4_000,
) -> DataFrame:
    """``need`` new rows: base, neighbor and new vectors, the label, the key of
    the base and the running number of the new row under that key, from 1.

    Equal rows are one point with a number of copies: copies of a point are its
    own nearest neighbours.  Every row is base equally often, the first rows in
    hash order once more; neighbour and position come from a hash, so a task
    that runs again makes the same rows.
    """
    features = list(features)
    require(df, [key, label, *features])
    incomplete = F.lit(False)
    for f in features:
        incomplete = incomplete | is_missing(df, f)
    vec = F.array(*[col(f).cast("double") for f in features])
    # written once: the minority is read several times below
    rows = stage(
        df.filter(col(label) == F.lit(minority)).select(
            col(key).alias("id"), vec.alias("vec"), incomplete.alias("incomplete")
        ),
        "minority",
    )
    size, bad, unkeyed = rows.agg(
        F.count(F.lit(1)), F.count_if("incomplete"), F.count_if(F.col("id").isNull())
    ).collect()[0]
    if size < 2:
        raise ValueError("oversampling needs at least two rows of the minority class")
    if bad:
        raise ValueError(f"{bad} minority rows have a missing feature: impute first")
    if unkeyed:
        raise ValueError(f"{unkeyed} minority rows have no key")

    each, extra = divmod(need, size)
    cut = hash_cuts(rows, "id", lambda n: [extra], seed=seed)[0].cuts[0]
    again = F.lit(False) if cut is None else cut.reaches(key_hash(F.col("id"), seed), F.col("id"))
    points = (
        rows.select("id", "vec", again.alias("again"))
        .groupBy("vec")
        .agg(
            F.min("id").alias("id"),
            F.count(F.lit(1)).alias("copies"),
            F.count_if("again").alias("again"),
        )
        .select("id", "vec", "copies", (F.col("copies") * each + F.col("again")).alias("wanted"))
    )
    near = nearest_points(points, k, cell_rows)
    own = F.array_repeat("vec", F.least(F.col("copies") - 1, F.lit(k)).cast("int"))
    others = F.flatten(
        F.transform(
            "near", lambda p: F.array_repeat(p["vec"], F.least(p["copies"], F.lit(k)).cast("int"))
        )
    )
    parents = near.filter(F.col("wanted") > 0).select(
        "id", "vec", "wanted", F.slice(F.concat(own, others), 1, k).alias("parents")
    )
    # a point that makes many rows is dealt out in blocks over the cluster
    last_block = F.floor((F.col("wanted") - 1) / BLOCK)
    blocks = parents.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
    if need > BLOCK:
        blocks = blocks.repartition("id", "block")
    start = F.col("block") * BLOCK
    stop = F.least(start + BLOCK, F.col("wanted")) - 1
    drawn = blocks.withColumn("j", F.explode(F.sequence(start, stop)))
    draw = F.concat_ws("/", F.col("id").cast("string"), F.col("j").cast("string"))
    slot = key_hash(draw, f"{seed}n") % F.size("parents")
    placed = drawn.select(
        "id",
        (F.col("j") + 1).alias("copy"),
        F.col("vec").alias("base"),
        F.get("parents", slot.cast("int")).alias("neighbor"),
        unit_hash(draw, f"{seed}u").alias("u"),
    )
    new = F.zip_with("base", "neighbor", lambda a, b: a + (b - a) * F.col("u"))
    return placed.select(
        "base", "neighbor", new.alias("vec"),
        F.lit(minority).cast(df.schema[label].dataType).alias("label"), "id", "copy",
    )


def smote(
    df: DataFrame,
    key: str,
    label: str,
    features: Sequence[str],
    k: int = 5,
    seed: int = 42,
    cell_rows: int = 4_000,
    with_key: bool = False,
) -> DataFrame:
    """Original rows and new minority rows until the classes are equal:
    features as doubles, label, and whether the row is synthetic.

    ``with_key`` puts the key in front, for a new row that of its base, and adds
    ``copy``, 0 for an original and a number from 1 under its key for a new row.
    """
    features = list(features)

    def keyed(name: str, number, *rest):
        before, after = ([col(name).alias(key)], [number.alias("copy")]) if with_key else ([], [])
        return [*before, *rest, *after]

    sizes = class_sizes(df, label)
    largest = max(sizes.values(), default=0)
    result = df.select(
        *keyed(
            key,
            F.lit(0).cast("bigint"),
            *[col(f).cast("double").alias(f) for f in features],
            col(label),
            F.lit(False).alias("synthetic"),
        )
    )
    for value, size in sorted(sizes.items(), key=lambda x: str(x[0])):
        if value is not None and size < largest:
            made = synthetic_rows(df, key, label, features, value, largest - size, k, seed, cell_rows)
            result = result.unionByName(
                made.select(
                    *keyed(
                        "id",
                        F.col("copy"),
                        *[F.get("vec", F.lit(i)).alias(f) for i, f in enumerate(features)],
                        F.col("label").alias(label),
                        F.lit(True).alias("synthetic"),
                    )
                )
            )
    return result
